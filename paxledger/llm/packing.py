"""Packing of tokenised documents by shortest-pack-first over the histogram of piece lengths.

Documents are cut into full sequences and one rest. The histogram of lengths, a few thousand numbers at most,
is packed longest length first, each into the pack with the most room left; packs of the same composition are
one pattern with a count. Patterns are then joined back to the pieces by the rank among pieces of their length.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.llm.common import bins_for, forget, numbered, settle, texts

CAPACITY = 2048
#: Id that ends a document.
END_ID = 1
VOCABULARY = "byte_bpe_50k.tiktoken"

_PIECES = "doc_id bigint, start bigint, length int, ids_crc32 bigint, doc_tokens bigint"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str):
    """The ids of a text by the public byte-level BPE, as the ``tokenizers`` file of the same vocabulary gives them, in a quarter of the time.

    ``path``: the ranks; the ``tokenizers`` file lies beside them. Its added tokens are found inside a text before
    anything else is cut, and have ids of their own.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"added tokens that are not matched as they stand: {added}")
    special = {t["content"]: t["id"] for t in added}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode(text, allowed_special="all")


def _cutter(path: str | None, capacity: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path or vocabulary_path())
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc"], batch["text"]):
                ids = np.array([*encode(text), END_ID], dtype="<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at : at + capacity]
                    rows.append((doc, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            yield pd.DataFrame(rows, columns=["doc", "start", "length", "ids_crc32", "doc_tokens"])

    return cut


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Documents as token ids followed by ``END_ID``, cut into full pieces and a rest: doc_id, start, length, ids_crc32, doc_tokens.

    A null or empty text is the end id alone. ``path``: the vocabulary's place (its
    ``tokenizers`` file lies beside it), by default that of the installed package on the executor.
    """
    plain = texts(docs).select(F.col("doc_id").cast("string").alias("doc"), "text")
    cut = plain.mapInPandas(_cutter(path, capacity), _PIECES.replace("doc_id bigint", "doc string"))
    return cut.select(F.col("doc").cast("long").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens")


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (how many packs, lengths in the pack) that place every length of ``histogram`` exactly.

    Lengths go longest first, each into packs with the most room (the shortest packs). The work follows the
    number of different lengths, not of pieces.
    """
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    done: list[tuple[int, tuple[int, ...]]] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed: list[tuple[int, int, tuple[int, ...]]] = []
        while left:
            room = max((r for r in open_packs if r >= length), default=None)
            if room is None:
                fits = capacity // length
                # Packs of this length alone; a last one takes what doesn't fill a pack.
                if left >= fits:
                    placed.append((capacity - fits * length, left // fits, (length,) * fits))
                if left % fits:
                    placed.append((capacity - (left % fits) * length, 1, (length,) * (left % fits)))
                break
            count, pattern = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            each = min(room // length, -(-left // count))
            used = min(count, left // each)
            placed.append((room - each * length, used, (*pattern, *(length,) * each)))
            left -= used * each
            if count > used:
                open_packs.setdefault(room, []).append((count - used, pattern))
        for room, count, pattern in placed:
            if room:
                open_packs.setdefault(room, []).append((count, pattern))
            else:
                done.append((count, pattern))
    return done + [x for packs in open_packs.values() for x in packs]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple]:
    """(length, first rank, number of packs, first sequence, offset) of each place of each pattern."""
    out, seen, sequence = [], {}, 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            out.append((length, seen.get(length, 0), count, sequence, offset))
            seen[length] = seen.get(length, 0) + count
            offset += length
        sequence += count
    return out


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``. Empty tables give no rows; rows that repeat are documents of their own."""
    spark = docs.sparkSession
    cut = settle(pieces(docs, path, capacity), "pack-pieces")
    # One row a length, and there are no more lengths than ``capacity``.
    histogram = {length: n for length, n in cut.groupBy("length").count().collect()}
    places: dict[int, list[tuple]] = {}
    for length, *place in slots(shortest_pack_first(histogram, capacity)):
        places.setdefault(length, []).append(tuple(place))
    table = spark.createDataFrame(
        sorted(places.items()), "_length int, _slots array<struct<rank:bigint,packs:bigint,sequence:bigint,offset:int>>"
    )
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    ranked = settle(
        numbered(cut, ["length"], bins_for(sum(histogram.values())), F.xxhash64(*order), order, "_rank"), "pack-ranked"
    )
    forget(cut)
    here = F.element_at(F.filter("_slots", lambda s: (s["rank"] <= F.col("_rank")) & (F.col("_rank") < s["rank"] + s["packs"])), 1)
    # The table of places is bounded by the capacity, whatever the number of documents.
    joined = ranked.join(F.broadcast(table), F.col("length") == F.col("_length")).withColumn("_at", here)
    return joined.select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.col("_at.sequence") + F.col("_rank") - F.col("_at.rank")).alias("sequence_id"),
        F.col("_at.offset").cast("long").alias("offset"),
    )


def op8_shortest_pack_first(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return pack(docs)
