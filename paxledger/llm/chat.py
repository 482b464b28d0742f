"""Chat transcripts rebuilt from event logs, and rendered reversibly.

A conversation is a log of events in sequence: a message opens, deltas stream in, an edit replaces a
message's text, a regeneration discards an answer and what was streamed of it. The log is partitioned by
conversation and sorted by sequence, and one pass folds it into final messages. A message is rendered as

    ### role: text</turn>

with backslash, ``#`` and ``<`` in role and text (in the role also ``:``) preceded by a backslash, so that the
control strings occur nowhere but as controls, and reading back needs no knowledge of what was written.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of one streamed delta.
DELTA_CHARS = 400
#: The role whose texts are trained on.
LOSS_ROLE = "assistant"

HEAD, COLON, END = "### ", ": ", "</turn>\n"

EVENTS = "conv_id bigint, seq bigint, step int, kind string, role string, text string"
RENDERED = "conv_id bigint, message bigint, formatted string, loss_start int, loss_end int"
DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("<", "\\<")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered message and where in it lies what is trained on: an assistant's text, of other roles nothing (0, 0)."""
    head = HEAD + escape(role).replace(":", "\\:") + COLON
    body = escape(text)
    start, end = (len(head), len(head) + len(body)) if role == LOSS_ROLE else (0, 0)
    return head + body + END, start, end


_MESSAGE = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each message of a rendered transcript, from its characters alone."""
    at, out = 0, []
    for m in _MESSAGE.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no message begins at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no message begins at {at}")
    return out


def fold(events: Iterator[tuple]) -> Iterator[tuple[int | None, int, str, str]]:
    """(conv_id, message, role, text) from events (conv_id, kind, role, text) sorted by conversation and sequence.

    ``open`` begins a message; ``delta`` adds to it; ``edit`` replaces its text; ``regenerate`` empties it, for
    the deltas that follow. Deltas, edits and regenerations before any message of their conversation have
    nothing to act on and are left out. One message is held at a time.
    """
    conv, number, role, parts, begun = None, 0, "", [], False
    for key, kind, who, text in events:
        if kind == "open" or (begun and key != conv):
            if begun:
                yield conv, number, role, "".join(parts)
            if not begun or key != conv:
                number = 0
            else:
                number += 1
            begun, conv, role, parts = kind == "open", key, who, []
            if not begun:
                continue
        elif not begun:
            continue
        elif kind == "delta":
            parts.append(text)
        elif kind == "edit":
            parts = [text]
        elif kind == "regenerate":
            parts = []
    if begun:
        yield conv, number, role, "".join(parts)


def _key(value) -> int | None:
    return None if value is None or value != value else int(value)


def _rendered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def events():
        for b in batches:
            # Ids beyond 2**53 must not pass through a float, which pandas takes for a column with nulls.
            yield from zip(b["conv"], b["kind"], b["role"], b["text"])

    rows, held = [], 0
    for conv, number, role, text in fold(events()):
        formatted, start, end = render(role, text)
        rows.append((conv, number, formatted, start, end))
        held += len(formatted)
        if held > 1 << 21 or len(rows) > 4096:
            yield pd.DataFrame(rows, columns=["conv", "message", "formatted", "loss_start", "loss_end"])
            rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=["conv", "message", "formatted", "loss_start", "loss_end"])


def format_events(events: DataFrame, tie: str | None = None) -> DataFrame:
    """Rendered final messages, a row each: conv_id, message (from 0), formatted, loss_start, loss_end.

    The mask, from loss_start up to loss_end, holds an assistant's text and is empty for all other roles.
    ``events``: conv_id, seq, step, kind, role, text; seq orders a conversation's log and step the events of one
    seq. ``tie`` names a column that orders turns of one seq; other columns are not looked at. A conversation's transcript is its rows' ``formatted`` by ``message``. Rows stay sorted in their
    partition. A long conversation streams through one task a message at a time.
    """
    sent = events.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("conv_id").cast("long").alias("_conv"),
        "seq",
        "step",
        "kind",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        *([F.col(f"`{tie}`").alias("_tie")] if tie else []),
    )
    order = ["_conv", "seq", *(["_tie"] if tie else []), "step"]
    laid = sent.repartition("_conv").sortWithinPartitions(*order).select("conv", "kind", "role", "text")
    out = laid.mapInPandas(_rendered, "conv string, message bigint, formatted string, loss_start int, loss_end int")
    return out.withColumn("conv_id", F.col("conv").cast("long")).drop("conv")


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Read rendered messages back; those of a conversation follow one another."""
    columns = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    out, begun, conv = [], False, None
    turns = loss = None
    n = chars = long = 0
    for b in batches:
        for key, message, formatted, start, end in zip(b["conv"], b["message"], b["formatted"], b["loss_start"], b["loss_end"]):
            if begun and message == 0:
                out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), long))
            if message == 0:
                begun, conv, turns, loss, n, chars, long = True, key, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            long += len(formatted)
            for role, text in parse(formatted):
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
            masked = unescape(formatted[int(start) : int(end)])
            chars += len(masked)
            loss.update(masked.encode())
        if len(out) > 4096:
            yield pd.DataFrame(out, columns=columns)
            out = []
    if begun:
        out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), long))
    if out:
        yield pd.DataFrame(out, columns=columns)


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of each conversation, from the rendered characters and the mask alone. ``rendered`` as ``format_events`` leaves it."""
    kinds = "conv string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    laid = rendered.select(F.col("conv_id").cast("string").alias("conv"), "message", "formatted", "loss_start", "loss_end")
    read = laid.mapInPandas(_digests, kinds)
    return read.select(F.col("conv").cast("long").alias("conv_id"), *[c.split()[0] for c in DIGEST.split(", ")[1:]])


def log_of(conversations: DataFrame) -> DataFrame:
    """The event log behind finished turns: an opening, then deltas of ``DELTA_CHARS`` characters.

    An assistant's turn streams its first delta once more beforehand and is then regenerated; a user's turn is
    opened with a draft that an edit replaces. Null texts and roles are empty. Turns that share a number come in
    order of role and text; repeated rows are turns of their own.
    """
    text: Column = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role: Column = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"), role.alias("role"), text.alias("text")
    )
    first = F.substring("text", 1, DELTA_CHARS)
    # Cut in one pass; a substring from each place on would read a long text over and over.
    deltas = F.transform(
        F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0)),
        lambda part: F.struct(F.lit("delta").alias("kind"), part.alias("text")),
    )
    event = lambda kind, said: F.array(F.struct(F.lit(kind).alias("kind"), said.alias("text")))
    answered = F.concat(event("open", F.lit("")), event("delta", first), event("regenerate", F.lit("")), deltas)
    asked = F.concat(event("open", F.lit("")), event("delta", first), event("edit", first), F.slice(deltas, F.lit(2), F.greatest(F.size(deltas), F.lit(1))))
    # Equal numbers: ordered by what they say, and equal rows kept apart by where they stand in the input.
    tie = F.struct("role", F.sha2("text", 256).alias("sha"), F.monotonically_increasing_id().alias("row")).alias("_tie")
    events = F.posexplode(F.when(F.col("role") == LOSS_ROLE, answered).otherwise(asked)).alias("step", "event")
    return turns.select("conv_id", "seq", "role", tie, "text").select("conv_id", "seq", "_tie", "role", events).select(
        "conv_id", "seq", "_tie", "step", F.col("event.kind").alias("kind"), "role", F.col("event.text").alias("text")
    )


#: A conversation that says the control strings of common templates.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(LOSS_ROLE)).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    ).unionByName(probe)


def op10_event_sourced_chat(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    return read_back(format_events(log_of(with_probe(conversations)), tie="_tie"))


OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, sha256(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, sha256(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
