"""Exact removal of repeated byte strings with suffix arrays over blocks of the corpus.

A byte goes if a string of ``LENGTH`` bytes that covers it starts somewhere else as well. Windows of that length
that are equal choose the same anchor in them, the least of their ``K``-byte hashes; so only windows whose anchor
occurs twice can repeat, and they meet by it:

1. Runs of windows with one anchor. Runs of equal content are repeats as a whole; where an anchor's runs differ,
2. their windows are cut into slices of ``SLICE``, which meet by the bytes that all windows of a slice share. A slice
   becomes a short string: what lies left of the shared bytes, one symbol for these, what lies right of them.
3. Suffix arrays of blocks of such strings, by linear grouping: suffixes are grouped by their Lyndon prefixes, the
   groups worked off in descending order through previous-smaller pointers, and then each group's order emitted
   in ascending order, without renaming or recursion. Neighbours that agree in a whole window are repeats.
   Slices that share one very common string fill several blocks; the groups that these find meet once more.

Every step groups by content with counts that are summed before the shuffle, so a passage that very many
documents share costs no pairs, and no block grows with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.llm.common import forget, settle, texts

LENGTH = 400
#: Windows that hold a given anchor, and the anchor's bytes.
REACH = 256
K = LENGTH - REACH + 1
#: Windows of a slice; slices of one block of a suffix array at most, and symbols of its text about.
SLICE = 16
BLOCK_SLICES, BLOCK_SYMBOLS = 1024, 1 << 15
#: Bytes of a text that are hashed at a time.
SEGMENT = 1 << 20
#: Bits of the set of documents that may have something to do; a full set leaves none out.
BITS = 1 << 22

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def suffix_array(symbols: list[int]) -> list[int]:
    """Suffix array of ``symbols``, whose last is smaller than all others and occurs once, in linear time."""
    n = len(symbols)
    group = [0] * n
    number = {c: g for g, c in enumerate(sorted(set(symbols)))}
    members: list[list[int]] = [[] for _ in number]
    for i, c in enumerate(symbols):
        g = number[c]
        group[i] = g
        members[g].append(i)
    lower = list(range(-1, len(members) - 1))  # the next lower group of each, and the next higher
    higher = list(range(1, len(members))) + [-1]
    settled = [False] * len(members)
    before = [-1] * n  # the last earlier suffix of a lower group
    current = len(members) - 1
    while current != -1:
        times: dict[int, int] = {}
        alive = []
        for s in members[current]:  # ascending, so an earlier suffix of this group has its pointer
            if group[s] != current:
                continue
            alive.append(s)
            p = s - 1
            while p >= 0 and settled[group[p]]:
                p = before[p]
            if p >= 0 and group[p] == current:
                p = before[p]
            before[s] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        members[current] = alive
        settled[current] = True
        # Prefixes that this group's extends, most times first; each lot forms a group just above those not extended.
        lots: dict[int, dict[int, list[int]]] = {}
        for p, t in times.items():
            lots.setdefault(t, {}).setdefault(group[p], []).append(p)
        for t in sorted(lots, reverse=True):
            for old, moved in lots[t].items():
                new = len(members)
                members.append(moved)
                settled.append(False)
                above = higher[old]
                lower.append(old)
                higher.append(above)
                higher[old] = new
                if above != -1:
                    lower[above] = new
                for p in moved:
                    group[p] = new
        current = lower[current]
    # Groups ascending from the lowest, which holds the end alone.
    free, at, g = [0] * len(members), 0, number[symbols[-1]]
    while g != -1:
        free[g] = at
        at += sum(1 for s in members[g] if group[s] == g)
        g = higher[g]
    out, placed = [-1] * n, [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = True
            s = before[s]
    return out


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash, first window, last window) of each run of windows of ``data`` with one anchor."""
    found = []
    windows = len(data) - LENGTH + 1
    for at in range(0, max(0, windows), SEGMENT):
        part = np.frombuffer(data, np.uint8, min(SEGMENT + LENGTH - 1, len(data) - at), at)
        powers = np.full(len(part) + 1, _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(powers[:-1] * (part.astype(np.uint64) + np.uint64(1)), out=sums[1:])
        back = np.full(len(part) - K + 1, _INVERSE, np.uint64)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        h = (sums[K:] - sums[: len(part) - K + 1]) * back
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        least, place = h, np.arange(len(h), dtype=np.int32)
        step = 1
        while step < REACH:
            right = least[step:] < least[:-step]
            place = np.where(right, place[step:], place[:-step])
            least = np.where(right, least[step:], least[:-step])
            step *= 2
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        ends = np.append(starts[1:], len(place)) - 1
        found.append((place[starts].astype(np.int64) + at, h[place[starts]], starts + at, ends + at))
    if not found:
        none = np.empty(0, np.int64)
        return none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _address(doc, text: str) -> int:
    """Where a row's text is told from others': by its id and content. Equal rows share it, and all else too."""
    return xxhash.xxh3_64_intdigest(f"{doc}\0{text}".encode("utf-8", "surrogatepass")) - (1 << 63)


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, ctx, doc, at): anchor hash, hash of the run's bytes and place in them, row, and packed position."""
    for batch in batches:
        keys, ctxs, docs, ats, held = [], [], [], [], 0
        for doc, text in zip(batch["doc"], batch["text"]):
            data = _bytes(text)
            if len(data) < LENGTH:
                continue
            x, h, lo, hi = anchors(data)
            address = _address(doc, text)
            digest = xxhash.xxh3_64_intdigest
            ctx = [
                digest(data[a : b + LENGTH], seed=p - a) for p, a, b in zip(x.tolist(), lo.tolist(), hi.tolist())
            ]
            keys.append(h.view(np.int64))
            ctxs.append(np.array(ctx, np.uint64).view(np.int64))
            docs.append(np.full(len(x), address, np.int64))
            ats.append((x << 16) | ((x - lo) << 8) | (x - hi))
            held += len(x)
            if held > 1 << 18:
                yield pd.DataFrame({"key": np.concatenate(keys), "ctx": np.concatenate(ctxs), "doc": np.concatenate(docs), "at": np.concatenate(ats)})
                keys, ctxs, docs, ats, held = [], [], [], [], 0
        if held:
            yield pd.DataFrame({"key": np.concatenate(keys), "ctx": np.concatenate(ctxs), "doc": np.concatenate(docs), "at": np.concatenate(ats)})


def unpack(at: int) -> tuple[int, int, int]:
    """(anchor, first window, last window)."""
    x = at >> 16
    return x, x - ((at >> 8) & 255), x - (at & 255)


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Slices of the given runs: row, first window, windows that belong to the run, shared bytes' hash, what lies beside."""
    names = ["doc", "low", "first", "last", "core", "sides"]
    for batch in batches:
        rows = []
        for doc, text, ats in zip(batch["doc"], batch["text"], batch["ats"]):
            data = _bytes(text)
            for at in set(ats.tolist()):
                x, lo, hi = unpack(at)
                for t in range((lo - x + REACH - 1) // SLICE, (hi - x + REACH - 1) // SLICE + 1):
                    low = x - REACH + 1 + SLICE * t
                    high = low + SLICE - 1
                    first, last = max(lo, low) - low, min(hi, high) - low
                    left = data[max(0, low) : high].rjust(SLICE - 1, b"\0")
                    right = data[low + LENGTH : high + LENGTH].ljust(SLICE - 1, b"\0")
                    # Sides that no window of the run reaches are blank, so that they keep no two slices apart.
                    left = b"\0" * first + left[first:]
                    right = right[:last] + b"\0" * (SLICE - 1 - last)
                    core = xxhash.xxh3_128_digest(data[high : low + LENGTH])
                    rows.append((doc, low, first, last, core, left + right))
            if len(rows) > 1 << 16:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)


def _sorted_blocks(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per class of slices a mask of its windows that another class of its block has too.

    Rows come sorted by core and block. A class of a core with several blocks gives a row for each of its
    windows with the window's hash, and others one row with the mask.
    """
    names = ["core", "sides", "first", "last", "mask", "window"]

    def work(held: list[tuple]) -> pd.DataFrame:
        text, cores = [], {}
        for core, sides, *_ in held:
            symbol = cores.setdefault(core, 258 + len(cores))
            text += [1 + b for b in sides[: SLICE - 1]]
            text.append(symbol)
            text += [1 + b for b in sides[SLICE - 1 :]]
            text.append(257)
        text.append(0)
        order = np.array(suffix_array(text))
        width = 2 * SLICE
        # Suffixes that begin a window of the run that they belong to, in their order.
        nr, offset = order // width, order % width
        first, last = np.array([h[2] for h in held]), np.array([h[3] for h in held])
        inner = nr < len(held)
        nr, offset = nr[inner], offset[inner]
        own = (offset >= first[nr]) & (offset <= last[nr])
        nr, offset = nr[own], offset[own]
        symbols = np.array(text)
        view = symbols[(nr * width + offset)[:, None] + np.arange(SLICE)]
        same = (view[1:] == view[:-1]).all(axis=1)
        lot = np.concatenate(([0], np.cumsum(~same)))
        count = np.bincount(lot)[lot]
        wide = np.array([h[4] > 1 for h in held])[nr]
        masks = np.zeros(len(held), np.int64)
        np.bitwise_or.at(masks, nr, np.where(count > 1, 1 << offset, 0))
        out = [(*held[i][:4], int(masks[i]), None) for i in range(len(held)) if held[i][4] == 1 and masks[i]]
        for i, o, v in zip(nr[wide].tolist(), offset[wide].tolist(), view[wide]):
            window = hashlib.blake2b(held[i][0] + v[v < 258].astype(np.uint16).tobytes() + bytes([o]), digest_size=16).digest()
            out.append((*held[i][:4], 1 << o, window))
        return pd.DataFrame(out, columns=names)

    held, mark = [], None
    for batch in rows:
        for row in zip(batch["core"], batch["sides"], batch["first"], batch["last"], batch["blocks"], batch["block"]):
            here = (row[0], row[5])
            if here != mark and len(held) * 2 * SLICE >= BLOCK_SYMBOLS:
                yield work(held)
                held = []
            mark = here
            held.append(row[:5])
    if held:
        yield work(held)


def _bitmap(docs: DataFrame) -> np.ndarray:
    """A set of fixed size that holds every ``doc`` of the given rows, and others by chance."""
    bits = np.zeros(BITS, bool)
    at = docs.select(F.pmod("doc", F.lit(BITS)).cast("int").alias("b")).distinct()
    packed = at.groupBy(F.floor(F.col("b") / 64).cast("int").alias("w")).agg(F.expr("bit_or(shiftleft(1L, b % 64))").alias("v"))
    for w, v in packed.collect():
        for k in range(64):
            if v >> k & 1:
                bits[w * 64 + k] = True
    return bits


def _addressed(plain: DataFrame, bits: np.ndarray | None, inside: bool = True) -> DataFrame:
    """(id, doc, text) of the rows whose address lies in the set, or of the others."""
    shared = plain.sparkSession.sparkContext.broadcast(bits)

    def address(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            doc = np.array([_address(d, t) for d, t in zip(batch["doc"], batch["text"])], np.int64)
            keep = shared.value[doc % BITS] == inside
            yield pd.DataFrame({"id": batch["doc"][keep], "doc": doc[keep], "text": batch["text"][keep]})

    return plain.mapInPandas(address, "id string, doc bigint, text string")


def repeated_windows(plain: DataFrame) -> DataFrame:
    """(doc, at, mask): whole runs with a mask of -1, and slices as their first window and a mask of windows."""
    runs = settle(plain.mapInPandas(_runs, "key bigint, ctx bigint, doc bigint, at bigint"), "suffix-runs")
    often = runs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("low"), F.max("ctx").alias("high")).where("n > 1")
    # Written down before the join, so that a hot key is split there: an aggregate on the same key would keep it whole.
    often = settle(often.select(F.col("key").alias("_key"), (F.col("low") != F.col("high")).alias("mixed")), "suffix-often")
    met = settle(runs.join(often, F.col("key") == F.col("_key")).drop("_key"), "suffix-met")
    forget(runs)
    classes = met.groupBy("key", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "at")).alias("rep"))
    classes = settle(classes.select(F.col("key").alias("_key"), F.col("ctx").alias("_ctx"), "n", "rep"), "suffix-classes")
    judged = settle(
        met.join(classes, (F.col("key") == F.col("_key")) & (F.col("ctx") == F.col("_ctx"))).select(
            "doc",
            "at",
            (F.col("n") > 1).alias("whole"),
            (F.col("mixed") & ((F.col("n") == 1) | (F.struct("doc", "at") == F.col("rep")))).alias("open"),
        ),
        "suffix-judged",
    )
    forget(met, often, classes)
    lists = settle(judged.where("open").groupBy(F.col("doc").alias("_doc")).agg(F.collect_set("at").alias("ats")), "suffix-lists")
    read = _addressed(plain, _bitmap(lists.select(F.col("_doc").alias("doc"))))
    cut = read.join(lists, F.col("doc") == F.col("_doc")).select("doc", "text", "ats").dropDuplicates(["doc"])
    slices = settle(
        cut.mapInPandas(_slices, "doc bigint, low bigint, first int, last int, core binary, sides binary"), "suffix-slices"
    )
    group = ["core", "sides", "first", "last"]
    kinds = settle(slices.groupBy(*group).agg(F.count(F.lit(1)).alias("n")), "suffix-kinds")
    cores = kinds.groupBy("core").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).where("total > 1")
    cores = cores.select(F.col("core").alias("_core"), F.ceil(F.col("kinds") / BLOCK_SLICES).cast("int").alias("blocks"), "kinds")
    shared = kinds.join(cores, F.col("core") == F.col("_core"))
    every = shared.where("n > 1").select(*group, F.lit((1 << SLICE) - 1).cast("bigint").alias("mask"))
    blocks = (
        shared.where("kinds > 1")
        .withColumn("block", F.pmod(F.xxhash64("sides"), F.col("blocks")).cast("int"))
        .repartition("core", "block")
        .sortWithinPartitions("core", "block", "sides", "first", "last")
        .select("core", "sides", "first", "last", "blocks", "block")
    )
    kind = "core binary, sides binary, first int, last int, mask bigint, window binary"
    found = settle(blocks.mapInPandas(_sorted_blocks, kind), "suffix-found")
    wide = found.where("window IS NOT NULL")
    common = wide.groupBy("window").agg(F.count(F.lit(1)).alias("all")).where("all > 1").select(F.col("window").alias("_window"))
    across = wide.join(common, F.col("window") == F.col("_window")).select(*group, "mask")
    masks = settle(
        found.where("window IS NULL").select(*group, "mask").unionByName(across).unionByName(every).groupBy(*group).agg(F.expr("bit_or(mask)").alias("mask")),
        "suffix-masks",
    )
    named = masks.select(*[F.col(c).alias(f"_{c}") for c in group], "mask")
    partial = slices.join(named, [F.col(c) == F.col(f"_{c}") for c in group]).select("doc", F.col("low").alias("at"), F.col("mask").cast("long").alias("mask"), "first", "last")
    # A mask holds windows of the run alone.
    own = F.expr("mask & (shiftleft(1L, last + 1) - shiftleft(1L, first))")
    whole = judged.where("whole").select("doc", "at", F.lit(-1).cast("long").alias("mask"))
    out = settle(whole.unionByName(partial.select("doc", "at", own.alias("mask"))).distinct(), "suffix-repeats")
    forget(judged, slices, kinds, found, masks, lists)
    return out


def removed_spans(length: int, ats: list[int], masks: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the given windows of ``LENGTH`` cover."""
    edge = np.zeros(length + 1, np.int64)
    for at, mask in zip(ats, masks):
        if mask == -1:
            _, lo, hi = unpack(at)
            edge[lo] += 1
            edge[hi + LENGTH] -= 1
        else:
            for k in range(SLICE):
                if mask >> k & 1:
                    edge[at + k] += 1
                    edge[at + k + LENGTH] -= 1
    covered = np.concatenate(([False], np.cumsum(edge[:-1]) > 0, [False]))
    turns = np.flatnonzero(covered[1:] != covered[:-1]).tolist()
    return list(zip(turns[::2], turns[1::2]))


_OUT = "id string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _reduced(with_text: bool):
    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text, ats, masks in zip(batch["id"], batch["text"], batch["ats"], batch["masks"]):
                data = _bytes(text)
                spans = removed_spans(len(data), ats, masks) if ats is not None and len(ats) else []
                kept = b"".join(data[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(data)]))
                rows.append((doc, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])

    return reduce


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, ``kept``: the bytes that stay.

    Every row of ``docs`` is a document, also one that repeats another; a null text is empty, and so is all that
    stays of a document of which another is a copy of at least ``LENGTH`` bytes.
    """
    plain = texts(docs).select(F.col("doc_id").cast("string").alias("doc"), "text")
    repeats = repeated_windows(plain)
    bits = _bitmap(repeats)
    spans = repeats.groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("at", "mask")).alias("s"))
    spans = spans.select("_doc", F.col("s.at").alias("ats"), F.col("s.mask").alias("masks"))
    none = F.array().cast("array<bigint>")
    touched = _addressed(plain, bits).join(spans, F.col("doc") == F.col("_doc"), "left").select("id", "text", F.coalesce("ats", none).alias("ats"), F.coalesce("masks", none).alias("masks"))
    others = _addressed(plain, bits, False).select("id", "text", none.alias("ats"), none.alias("masks"))
    out = touched.mapInPandas(_reduced(with_text), _OUT).unionByName(others.mapInPandas(_reduced(with_text), _OUT))
    more = ["kept"] if with_text else []
    return out.select(F.col("id").cast("long").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", *more)


def op1_lyndon_suffix_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, with_text=False)


#: The contract of op1 in SQL: all windows of 400 bytes, as two hexadecimal digits a byte, told apart by their digests.
OP1_SQL = """
WITH given AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes FROM documents),
sized AS (SELECT doc_id, bytes, length(bytes) // 2 AS n FROM given),
pieces AS (SELECT doc_id, unnest(range(0, n - 399, 512)) AS base, bytes, n FROM sized WHERE n >= 400),
cut AS (SELECT doc_id, base, n, substring(bytes, 2 * base + 1, 2 * (512 + 399)) AS piece FROM pieces),
starts AS (SELECT doc_id, base, piece, unnest(range(0, least(512, n - 399 - base))) AS place FROM cut),
windows AS (SELECT doc_id, base + place AS begun, md5(substring(piece, 2 * place + 1, 800)) AS digest FROM starts),
often AS (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1),
repeats AS (SELECT doc_id, begun FROM windows WHERE digest IN (SELECT digest FROM often)),
steps AS (SELECT doc_id, begun, begun > coalesce(lag(begun) OVER o + 400, -1) AS opens FROM repeats WINDOW o AS (PARTITION BY doc_id ORDER BY begun)),
runs AS (SELECT doc_id, begun, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY begun) AS run FROM steps),
spans AS (SELECT doc_id, min(begun) AS low, max(begun) + 400 AS high FROM runs GROUP BY doc_id, run),
removed AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
edges AS (
    SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS low, low AS high FROM spans
    UNION ALL
    SELECT s.doc_id, coalesce(max(p.high), 0), s.n FROM sized s LEFT JOIN spans p ON p.doc_id = s.doc_id GROUP BY s.doc_id, s.n
),
kept AS (
    SELECT e.doc_id, string_agg(substring(s.bytes, 2 * e.low + 1, 2 * (e.high - e.low)), '' ORDER BY e.low, e.high) AS bytes
    FROM edges e JOIN sized s ON s.doc_id = e.doc_id
    GROUP BY e.doc_id
)
SELECT s.doc_id, s.n AS n_bytes, coalesce(r.n_removed, 0)::BIGINT AS n_removed, coalesce(r.n_spans, 0) AS n_spans,
    sha256(unhex(k.bytes)) AS kept_sha256
FROM sized s JOIN kept k ON k.doc_id = s.doc_id LEFT JOIN removed r ON r.doc_id = s.doc_id
"""
