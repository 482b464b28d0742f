"""Periodic runs of words: maximal stretches that repeat with their smallest period, found on tiles of every scale.

Periods are taken octave by octave. For the periods from g up to 2g a text has a boundary at every g-th word, and
around each boundary lies a tile of a few g words that overlaps its neighbours'. A run that is two periods long holds a
boundary c such that its words at c and one period on agree; two Z-functions of the tile, from the boundary onwards
and back from it, tell for all periods at once how far this goes. What they give is cut at the tile: a fragment.
Boundaries where no window of g/2 words comes again at a distance of the octave need no Z-function; windows are
compared by their hashes, which can only let too many through. A fragment whose period is made of smaller equal parts is no run of that period.

Texts up to ``TILE`` words are tiled in the task that reads them, many together. A longer text is exploded: its lower
octaves into overlapping pieces of ``TILE`` words, each higher octave into pieces of eight times its greatest
period, overlapping by two; pieces are rows, solved wherever Spark puts them. All fragments are shuffled by document
and period and stitched where they overlap by a period, and a document's runs are joined back to its words.

Null and empty texts have no words and no runs. Repeated rows are worked on each; a null doc_id stays null. Runs that
begin together are told apart by their periods. Other columns are left out. A task holds one document and its words at a
time, and the words of short documents up to ``WORDS_AT_ONCE``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paxledger.llm.common import settle, table, texts
from paxledger.llm.ratios import _let, words_of

#: A run has so many words at least, and twice its period.
LEAST_WORDS = 12
#: Words of a text that is tiled in one piece, and of the pieces of longer ones.
TILE = 1 << 16
#: Words of short texts that are worked on together.
WORDS_AT_ONCE = 1 << 19
#: The lowest octave holds all periods below this; the next ones double.
FIRST = 8

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PARTS = "kind int, uid bigint, doc_id bigint, n bigint, text string, sha string, period bigint, start bigint, stop bigint, ids binary"
_FRAGMENT = "uid bigint, period bigint, start bigint, stop bigint"
_ARROW = pa.schema(
    [
        *[(c, t) for c, t in (("kind", pa.int32()), ("uid", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()))],
        *[(c, t) for c, t in (("text", pa.string()), ("sha", pa.string()), ("period", pa.int64()), ("start", pa.int64()))],
        *[(c, t) for c, t in (("stop", pa.int64()), ("ids", pa.binary()))],
    ]
)
#: Kinds of rows that reading documents gives: a document without runs, one to be finished, a fragment, a piece.
PLAIN, OPEN, FRAGMENT, PIECE = range(4)


def z_function(s: list) -> list[int]:
    """For each place how many items from there on equal those from the start on; the list's length for the first."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a * _P) ^ (b + _Q)
    out *= _Q
    return out ^ (out >> np.uint64(31))


def _windows(w: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on; places too near the end are left out."""
    have, length = _mixed(w.view(np.uint64), w.view(np.uint64)), 1
    while 2 * length <= size:
        have, length = _mixed(have[:-length], have[length:]), 2 * length
    if length < size:  # the two halves overlap
        rest = size - length
        have = _mixed(have[:-rest], have[rest:])
    return have


def octaves(longest: int) -> list[tuple[int, int]]:
    """(lowest, highest) period of every octave that a text of ``longest`` words can have runs of."""
    out, low, high = [], 1, FIRST - 1
    while 2 * low <= longest:
        out.append((low, high))
        low, high = high + 1, 2 * high + 1
    return out


def _candidates(w: np.ndarray, n: int, low: int, high: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) wherever a window at the boundary, or one that ends there, comes again a period later."""
    size = 3 if low == 1 else low // 2
    onwards = _windows(w, size)
    marks = np.arange(0, n, step)
    back = marks >= size
    if low == 1:
        hits = []
        for p in range(low, high + 1):
            hit = onwards[marks] == onwards[marks + p]
            hit[back] |= onwards[marks[back] - size] == onwards[marks[back] - size + p]
            hits.append(hit)
        place, period = np.nonzero(np.stack(hits, axis=1))
        return marks[place], period + low
    # The periods of the octave reach from the next boundary to just before the one after it.
    rows = onwards[step : step * (len(marks) + 1)].reshape(len(marks), step)
    hit = rows == onwards[marks][:, None]
    # Windows that end ``size`` words later begin where those of the row before last begin, shifted by ``size``.
    ends = onwards[step - size : step * (len(marks) + 1) - size].reshape(len(marks), step)
    hit[back] |= ends[back] == onwards[marks[back] - size][:, None]
    place, period = np.nonzero(hit)
    return marks[place], period + low


def _merged(found: np.ndarray) -> np.ndarray:
    """Rows (period, start, stop) with those of one period joined where they overlap by a period at least."""
    if not len(found):
        return found
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    out = [list(found[0])]
    for period, start, stop in found[1:].tolist():
        last = out[-1]
        if period == last[0] and start <= last[2] - period:
            last[2] = max(last[2], stop)
        else:
            out.append([period, start, stop])
    return np.array(out, np.int64)


def _primitive(block: np.ndarray) -> bool:
    """Whether a block of words isn't made of several equal parts."""
    p, rest, prime = len(block), len(block), 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            d = p // prime
            if np.array_equal(block[d:], block[:-d]):
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


def solve(segments: list[np.ndarray], only: tuple[int, int] | None = None) -> list[np.ndarray]:
    """For every segment of word numbers (not negative) its fragments: rows (period, start, stop), two periods long at least.

    A segment that is a whole text has one fragment for each run, besides those shorter than ``LEAST_WORDS``.
    ``only`` limits the periods to those of the octaves from one lowest period to one highest.
    """
    found: list[list[np.ndarray]] = [[] for _ in segments]
    for low, high in octaves(max((len(s) for s in segments), default=0)):
        if only and not only[0] <= low <= only[1]:
            continue
        here = [i for i, s in enumerate(segments) if len(s) >= 2 * low]
        lengths = np.array([len(segments[i]) + 1 for i in here])
        starts = np.append(0, np.cumsum(lengths))
        n, step, reach = int(starts[-1]), (4 if low == 1 else low), (16 if low == 1 else 2 * low)
        # A number of its own after every segment and many after the last, so that nothing agrees across them.
        w = np.empty(n + 8 * step + 4 * FIRST, np.int64)
        w[n:] = -1 - np.arange(n, len(w))
        for i, at in zip(here, starts):
            w[at : at + len(segments[i])] = segments[i]
        w[starts[1:] - 1] = -starts[1:]
        at, periods = _candidates(w, n, low, high, step)
        edges = np.append(0, 1 + np.flatnonzero(np.diff(at))) if len(at) else np.empty(0, np.int64)
        rows = []
        for e, until in zip(edges, np.append(edges[1:], len(at))):
            c, ps = int(at[e]), periods[e:until]
            begin = max(0, c - step)
            onwards = np.array(z_function(w[c : c + high + 1 + reach].tolist()))
            behind = w[begin:c][::-1].tolist()
            backwards = np.array(z_function([*behind, None, *w[begin : c + high][::-1].tolist()]))
            ahead = np.minimum(onwards[ps], reach)
            before = np.minimum(backwards[len(behind) + 1 + high - ps], len(behind))
            good = ahead + before >= ps
            rows.append(np.stack([ps, c - before, c + ps + ahead], axis=1)[good])
        if not rows:
            continue
        merged = _merged(np.concatenate(rows))
        if not len(merged):
            continue
        owner = np.searchsorted(starts, merged[:, 1], "right") - 1
        for o, (p, start, stop) in zip(owner.tolist(), merged.tolist()):
            if _primitive(w[start : start + p]):
                found[here[o]].append(np.array([p, start - starts[o], stop - starts[o]]))
    none = np.empty((0, 3), np.int64)
    return [np.stack(f) if f else none for f in found]


def pieces(n: int, tile: int = TILE) -> list[tuple[int, int, int, int]]:
    """(lowest, highest, start, stop) of the overlapping pieces of a text of ``n`` words, from octave to octave."""
    out, base = [], []
    for low, high in octaves(n):
        if low == 1 or 8 * (high + 1) <= tile:
            base.append((low, high))
        else:
            out.append((low, high, 8 * (high + 1), 6 * (high + 1)))
    first, last = base[0][0], base[-1][1]
    size = max(tile, 8 * (last + 1))
    plans = [(first, last, size, size - 2 * (last + 1)), *out]
    cut = []
    for low, high, length, stride in plans:
        start = 0
        while True:
            cut.append((low, high, start, min(n, start + length)))
            if start + length >= n:
                break
            start += stride
    return cut


def _long_enough(found: np.ndarray) -> np.ndarray:
    return found[found[:, 2] - found[:, 1] >= np.maximum(LEAST_WORDS, 2 * found[:, 0])]


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _numbers(words: list[bytes], names: dict[bytes, int]) -> np.ndarray:
    return np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))


def _reader(tile: int):
    """Reads documents: solves those of one piece and cuts the others."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        held: list[tuple] = []
        names: dict[bytes, int] = {}

        def row(kind, uid, doc=None, n=None, text=None, sha=None, period=None, start=None, stop=None, ids=None):
            return (kind, uid, doc, n, text, sha, period, start, stop, ids)

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

        def flush() -> list[tuple]:
            out = []
            for (u, doc, text, words, _), found in zip(held, solve([h[4] for h in held])):
                found = _long_enough(found)
                if not len(found):
                    out.append(row(PLAIN, u, doc, len(words), sha=_sha(words)))
                    continue
                out.append(row(OPEN, u, doc, len(words), text))
                out.extend(row(FRAGMENT, u, period=p, start=s, stop=e) for p, s, e in found.tolist())
            held.clear()
            names.clear()
            return out

        total = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                uid += 1
                words = text.encode("utf-8", "surrogatepass").split()
                if len(words) <= tile:
                    held.append((uid, doc, text, words, _numbers(words, names)))
                    total += len(words) + 1
                    if total >= WORDS_AT_ONCE:
                        yield frame(flush())
                        total = 0
                    continue
                yield frame([row(OPEN, uid, doc, len(words), text)])
                ids = _numbers(words, {}).astype(np.int32)
                for low, high, start, stop in pieces(len(words), tile):
                    # Lowest and highest period travel in the columns of a fragment's period and end.
                    yield frame([row(PIECE, uid, period=low, start=start, stop=high, ids=ids[start:stop].tobytes())])
        if held:
            yield frame(flush())

    return read


def _solve_piece(piece: pd.DataFrame) -> pd.DataFrame:
    out = []
    for uid, low, start, high, ids in zip(piece["uid"], piece["period"], piece["start"], piece["stop"], piece["ids"]):
        (found,) = solve([np.frombuffer(ids, np.int32).astype(np.int64)], (low, high))
        out.extend((uid, p, start + s, start + e) for p, s, e in found.tolist())
    return pd.DataFrame(out, columns=["uid", "period", "start", "stop"]).astype("int64")


def stitched(fragments: DataFrame) -> DataFrame:
    """uid, period, start, stop of the runs: fragments of a document and period joined where they overlap by a period."""
    order = Window.partitionBy("uid", "period").orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = fragments.withColumn("_new", F.coalesce((F.col("start") > reached - F.col("period")).cast("int"), F.lit(1)))
    numbered = begins.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("uid", "period", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return runs.where(F.col("stop") - F.col("start") >= F.greatest(F.lit(LEAST_WORDS), 2 * F.col("period"))).drop("_run")


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words lie in no run (start, length, period) after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "runs"))):
            words = text.encode("utf-8", "surrogatepass").split()
            runs = sorted((r["start"], r["stop"] - r["start"], r["period"]) for r in found or [])
            runs.sort(key=lambda r: (r[0], r[2]))
            best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
            told = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
            kept = kept_words(len(words), runs)
            rows.append((doc, len(words), len(runs), *best, told, " ".join(w.decode("utf-8", "surrogatepass") for w, k in zip(words, kept) if k)))
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        names = ["doc_id", "n_words", "n_runs", "start", "length", "period", "runs_sha256", "collapsed"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names=names)


def documents_and_runs(docs: DataFrame, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Documents (uid, doc_id, n, sha, text) and runs (uid, period, start, stop).

    ``sha`` is the digest of the words of a document without runs; others have their ``text`` instead. Both settled.
    """
    plain = texts(docs)
    parts = settle(plain.mapInArrow(_reader(tile), _PARTS), "runs-parts")
    cut = parts.where(F.col("kind") == PIECE).select("uid", "period", "start", "stop", "ids")
    solved = cut.groupBy("uid", "period", "start").applyInPandas(_solve_piece, _FRAGMENT)
    whole = parts.where(F.col("kind") == FRAGMENT).select("uid", "period", "start", "stop")
    runs = settle(stitched(whole.unionByName(solved)), "runs-stitched")
    return parts.where(F.col("kind").isin(PLAIN, OPEN)).select("uid", "doc_id", "n", "sha", "text"), runs


def collapse(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """doc_id, n_words, n_runs, start, length, period (of the longest run), runs_sha256, collapsed_sha256, collapsed.

    ``collapsed`` are the words left when every run is cut down to its first period; null where a document has no runs
    and stays as it is.
    """
    found, runs = documents_and_runs(docs, tile)
    of_document = runs.groupBy(F.col("uid").alias("_uid")).agg(F.collect_list(F.struct("start", "stop", "period")).alias("runs"))
    finished = (
        found.where("text IS NOT NULL")
        .join(of_document, F.col("uid") == F.col("_uid"), "left")
        .select("doc_id", "text", "runs")
        .mapInArrow(
            _finish,
            "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, runs_sha256 string, collapsed string",
        )
        .withColumn("collapsed_sha256", F.sha2("collapsed", 256))
    )
    none = F.lit(None).cast("bigint")
    without = found.where("text IS NULL").select(
        "doc_id",
        F.col("n").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_runs"),
        *[none.alias(c) for c in ("start", "length", "period")],
        F.sha2(F.lit(""), 256).alias("runs_sha256"),
        F.lit(None).cast("string").alias("collapsed"),
        F.col("sha").alias("collapsed_sha256"),
    )
    return finished.unionByName(without)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, the end of every tenth text (by a hash of its id) made periodic.

    With h the CRC-32 of the decimal id and g = h div 10, where h leaves 0 by division by 10 every word i from a on
    becomes word a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def periodic(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(w, lambda _, i: F.get(w, place(i))), " ")).otherwise(F.lit(""))

    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    plain = texts(docs)
    return plain.select("doc_id", F.when(chosen, _let(words_of(F.col("text")), periodic)).otherwise(F.col("text")).alias("text"))


def op11_scale_tiled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse(with_planted_runs(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )
