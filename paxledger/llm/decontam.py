"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages and weighted by TF-IDF, with document frequencies counted over the whole
corpus. A distributed randomised SVD of their matrix gives a latent space; windows of every document are projected
into it, and those whose cosine to a passage is high are candidates. A candidate is a leak if the longest common
subsequence of words covers most of the passage, or less of it but the passage's answer: its last sentence.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.llm.common import bins_for, numbered, settle, table, texts
from paxledger.llm.suffixes import BITS, _bitmap

#: Words of a passage at most; passages of one item overlap by half.
PASSAGE = 64
#: Items with fewer words can't be told from chance by weights; documents that hold their words side by side are found exactly.
LEAST_WORDS = 5
#: Words of a document's windows, a quarter of which lies between two starts. Passages shorter than these have
#: windows of their own lengths besides, from every word on.
WINDOWS = (16, 24, 32, 48, 64)
#: Hash buckets of words: as features, and for document frequencies of words that no passage has.
FEATURES, DF_BUCKETS = 1 << 18, 1 << 16
#: Passages that share one latent space at most, and the part of its energy that each of them has to keep there.
BLOCK, ENERGY, OVERSAMPLE = 224, 0.98, 16
#: Blocks that one pass over the documents searches: about 4 MB each on every executor.
TOGETHER = 8
#: Windows of a text that are projected together.
LOT = 32
COSINE = 0.45
#: Parts of a passage's words in the common subsequence: alone, and together with that part of the answer.
LCS_ALONE, LCS_WITH_ANSWER, ANSWER = 0.8, 0.6, 0.8

_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-case words as bytes; ASCII signs separate, other characters belong to words."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


@dataclass(frozen=True)
class Passage:
    item_id: int
    words: tuple[bytes, ...]
    answer: tuple[bytes, ...]


def passages_of(item_id: int, text: str) -> list[Passage]:
    """An item's passages. The answer is the last sentence; if there is one sentence only, its last third."""
    words = words_of(text)
    sentences = [w for w in map(words_of, re.split(r"(?<=[.!?])\s+", text.strip())) if w]
    answer = sentences[-1] if len(sentences) > 1 else words[-(-2 * len(words) // 3) :]
    if len(words) <= PASSAGE:
        return [Passage(item_id, tuple(words), tuple(answer))]
    starts = [*range(0, len(words) - PASSAGE, PASSAGE // 2), len(words) - PASSAGE]
    # Of a long item the answer lies in the last passage; elsewhere the passage's own end takes its place.
    cut = [words[s : s + PASSAGE] for s in starts]
    return [Passage(item_id, tuple(w), tuple(answer[-PASSAGE:] if w is cut[-1] else w[-PASSAGE // 3 :])) for w in cut]


def common_words(a: tuple[bytes, ...], b: list[bytes]) -> int:
    """Length of the longest common subsequence of words, by bit-parallel rows."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


#: Sorted hashes of the passages' words and their inverse document frequencies.
Own = tuple[np.ndarray, np.ndarray]


def places(h: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``h`` lies in the sorted ``among``, and whether it does."""
    if not len(among):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(among, h), len(among) - 1)
    return at, among[at] == h


def weights(h: np.ndarray, idf: np.ndarray, own: Own | None) -> np.ndarray:
    """Weights of words. A bucket's words are at least as rare as the bucket, so a window's length is never overrated."""
    weight = idf[h & np.uint32(DF_BUCKETS - 1)]
    if own is not None:
        at, held = places(h, own[0])
        weight[held] = own[1][at[held]]
    return weight


def _document_frequencies(shared):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        total, rows = np.zeros(DF_BUCKETS + len(own), np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                h = hashes(list(set(words_of(text))))
                # A place that comes up several times in one text is counted once.
                total[h & np.uint32(DF_BUCKETS - 1)] += 1
                at, held = places(h, own)
                total[DF_BUCKETS + at[held]] += 1
                rows += 1
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(held, -1), "df": np.append(total[held], rows)})

    return count


def _vocabulary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"h": np.unique(hashes([w for words in batch["words"] for w in words.split()])).astype(np.int64)})


def idf_table(docs: DataFrame, passages: DataFrame) -> tuple[np.ndarray, Own]:
    """Inverse document frequencies over all of ``docs``: of each word of ``passages``, and of buckets for all others."""
    vocabulary = passages.select("words").mapInPandas(_vocabulary, "h bigint").distinct().collect()
    own = np.sort(np.array([r.h for r in vocabulary], np.uint32))
    shared = docs.sparkSession.sparkContext.broadcast(own)
    counted = texts(docs).select("text").mapInPandas(_document_frequencies(shared), "bucket bigint, df bigint")
    df = np.zeros(DF_BUCKETS + len(own) + 1)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("df")).collect():
        df[bucket] = n
    n = df[-1]
    idf = np.log((n + 1) / (df[:-1] + 1)) + 1e-3
    return idf[:DF_BUCKETS], (own, idf[DF_BUCKETS:])


def vector(words, idf: np.ndarray, own: Own | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights of a passage, of length one."""
    h = hashes(list(words))
    feature, first, count = np.unique(h & np.uint32(FEATURES - 1), return_index=True, return_counts=True)
    weight = count * weights(h[first], idf, own)
    norm = np.sqrt((weight**2).sum())
    return feature.astype(np.int64), weight / (norm or 1.0)


def _noise(features: np.ndarray, dims: int) -> np.ndarray:
    """Rows of the random test matrix: a row follows from its feature alone, so that tasks agree."""
    return np.stack([np.random.default_rng([20_240_603, int(f)]).standard_normal(dims) for f in features])


def _summed(key: str, value: str):
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch[key], batch[value]):
                total[k] = total[k] + v if k in total else np.array(v)
        if total:
            yield pd.DataFrame({key: list(total), value: [v.tolist() for v in total.values()]})

    return add


def latent_space(passages: DataFrame, idf: np.ndarray, own: Own) -> tuple[np.ndarray, np.ndarray]:
    """(features, basis) of the right singular vectors of the passages' matrix A, by randomised SVD.

    ``passages``: words of one block. Tasks sum up A'(A R) for a random R, of which the driver keeps a row
    for each feature of the block; an orthogonal basis Q of its columns, then Q'A'AQ, again summed up by tasks,
    whose eigenvectors turn Q into singular vectors, by falling energy. A block has no more passages than there are
    dimensions, so that only those without energy are left out.
    """
    dims = BLOCK + OVERSAMPLE

    def rows(batches):
        for batch in batches:
            for words in batch["words"]:
                yield vector(words.split(), idf, own)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for feature, weight in rows(batches):
            y = weight @ _noise(feature, dims)
            for f, w in zip(feature.tolist(), weight):
                total[f] = total.get(f, 0.0) + w * y
        if total:
            yield pd.DataFrame({"feature": list(total), "row": [v.tolist() for v in total.values()]})

    kind = "feature bigint, row array<double>"
    summed = passages.mapInPandas(spread, kind).repartition("feature").mapInPandas(_summed("feature", "row"), kind)
    # At most PASSAGE * BLOCK features, whatever the size of the benchmark.
    got = sorted((r.feature, r.row) for r in summed.collect())
    if not got:
        return np.empty(0, np.int64), np.empty((0, 0), np.float32)
    features = np.array([f for f, _ in got])
    q, _ = np.linalg.qr(np.array([r for _, r in got]))

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((q.shape[1], q.shape[1]))
        for feature, weight in rows(batches):
            z = weight @ q[np.searchsorted(features, feature)]
            total += np.outer(z, z)
        yield pd.DataFrame({"at": range(len(total)), "row": total.tolist()})

    kind = "at bigint, row array<double>"
    parts = passages.mapInPandas(gram, kind).repartition("at").mapInPandas(_summed("at", "row"), kind)
    g = np.array([r.row for r in sorted(parts.collect(), key=lambda r: r.at)])
    value, turn = np.linalg.eigh(g)
    value, turn = np.maximum(value[::-1], 0), turn[:, ::-1]
    keep = value > 1e-12 * value.sum()
    return features, (q @ turn[:, keep]).astype(np.float32)


def shortened(latent: np.ndarray) -> np.ndarray:
    """Passages in as many dimensions as leave each of them ``ENERGY``, scaled so that a passage's own text has cosine one."""
    kept = np.cumsum(latent.astype(np.float64) ** 2, axis=1)
    keep = min(latent.shape[1], 1 + int((kept < ENERGY).sum(axis=1).max()))
    return (latent[:, :keep] / kept[:, keep - 1 : keep]).astype(np.float32)


@dataclass(frozen=True)
class Index:
    """One block of passages in its latent space."""

    passages: list[Passage]
    latent: np.ndarray  # a row for each passage
    row_of: np.ndarray  # of the basis for each feature, -1 for those without
    basis: np.ndarray
    idf: np.ndarray
    own: Own | None = None

    def _reach(self, latent: np.ndarray) -> np.ndarray:
        """For each feature the most that it adds to the product of a window with one of the passages, for a weight of one."""
        most = np.zeros(FEATURES)
        held = self.row_of >= 0
        for at in range(0, len(self.basis), 4096):
            part = np.abs(self.basis[at : at + 4096] @ latent.T).max(axis=1)
            most[np.flatnonzero(held)[at : at + 4096]] = part
        return most

    @cached_property
    def searched(self) -> list[tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray]]:
        """(lengths and steps of windows, numbers of the passages they are compared with, their rows, their reach)."""
        sizes = np.array([len(p.words) for p in self.passages])
        every, short = np.arange(len(sizes)), np.flatnonzero(sizes < WINDOWS[0])
        kinds = [([(n, n // 4) for n in WINDOWS], every), ([(n, 1) for n in np.unique(sizes[short]).tolist()], short)]
        return [(windows, which, self.latent[which], self._reach(self.latent[which])) for windows, which in kinds if len(which)]

    @cached_property
    def _weight_of(self) -> np.ndarray:
        """Room for one weight a feature; what it holds means nothing between two texts."""
        return np.empty(FEATURES)

    def candidates(self, h: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
        """(start, length, cosine, passage) for each window and passage of at least ``COSINE``.

        A window's product with any passage is at most the sum of what its words add at most, and its length at
        least the root of their squares; only windows for which that leaves room are projected. They are so in lots first,
        and one by one where that leaves room again.
        """
        feature_of = h & np.uint32(FEATURES - 1)
        weight = weights(h, self.idf, self.own)
        energy = np.concatenate(([0.0], np.cumsum(weight**2)))
        for windows, which, latent, reach in self.searched:
            most = np.concatenate(([0.0], np.cumsum(weight * reach[feature_of])))
            yield from self._candidates(windows, which, latent, feature_of, weight, energy, most)

    def _may_reach(self, start, end, latent, feature_of, weight) -> np.ndarray:
        """Whether each window may reach the cosine with one of the passages; a margin is left for rounding."""
        may = np.empty(len(start), bool)
        for lot in (slice(i, i + LOT) for i in range(0, len(start), LOT)):
            sizes = end[lot] - start[lot]
            window = np.repeat(np.arange(len(sizes)), sizes)
            word = np.arange(len(window)) + (start[lot] - np.cumsum(sizes) + sizes)[window]
            feature, nr = np.unique(feature_of[word], return_inverse=True)
            summed = np.bincount(window * len(feature) + nr, weight[word], len(sizes) * len(feature)).reshape(len(sizes), -1)
            row = self.row_of[feature]
            known = row >= 0
            z = summed[:, known].astype(np.float32) @ self.basis[row[known]]
            may[lot] = (z @ latent.T).max(axis=1) >= (COSINE - 1e-3) * np.sqrt((summed**2).sum(axis=1))
        # Words of one feature count with the weight of a window's first of them: where weights differ, nothing is ruled out.
        self._weight_of[feature_of] = weight
        odd = self._weight_of[feature_of] != weight
        if odd.any():
            mixed = np.concatenate(([0], np.cumsum(np.isin(feature_of, feature_of[odd]))))
            may |= mixed[end] - mixed[start] > 1
        return may

    def _candidates(self, windows, which, latent, feature_of, weight, energy, most) -> Iterator[tuple[int, int, float, int]]:
        starts = [np.arange(0, max(1, len(weight) - length + step), step) for length, step in windows]
        start = np.concatenate(starts)
        end = np.minimum(start + np.repeat([length for length, _ in windows], [len(x) for x in starts]), len(weight))
        room = np.flatnonzero(most[end] - most[start] >= COSINE * np.sqrt(energy[end] - energy[start]) - 1e-6)
        if not len(room):
            return
        start, end = start[room], end[room]
        may = self._may_reach(start, end, latent, feature_of, weight)
        for s, e in zip(start[may].tolist(), end[may].tolist()):
            feature, first, count = np.unique(feature_of[s:e], return_index=True, return_counts=True)
            w = count * weight[s:e][first]
            norm = np.sqrt((w**2).sum())
            r = self.row_of[feature]
            known = r >= 0
            if not norm or not known.any():
                continue
            z = (w[known] / norm).astype(np.float32) @ self.basis[r[known]]
            cosine = latent @ z
            for p in np.flatnonzero(cosine >= COSINE):
                yield s, e, float(cosine[p]), int(which[p])

    def leaks(self, words: list[bytes], h: np.ndarray) -> Iterator[tuple[int, float, int, int, int, int]]:
        """(item_id, cosine, common words, words, common words of the answer, words of the answer), the best of each item."""
        best: dict[int, tuple] = {}
        seen: dict[tuple[int, int, int], tuple[int, int]] = {}
        for s, e, cosine, p in self.candidates(h):
            passage = self.passages[p]
            n = len(passage.words)
            reach = -(-n // 4)
            low, high = max(0, min(s, e - n) - reach), max(e, s + n) + reach
            if (p, low, high) in seen:
                continue
            seen[p, low, high] = (0, 0)
            span = words[low:high]
            common = common_words(passage.words, span)
            if common < LCS_WITH_ANSWER * n:
                continue
            answered = common_words(passage.answer, span) if passage.answer else 0
            if common >= LCS_ALONE * n or answered >= ANSWER * len(passage.answer) > 0:
                hit = (passage.item_id, cosine, common, n, answered, len(passage.answer))
                if passage.item_id not in best or hit[2] / n > best[passage.item_id][2] / best[passage.item_id][3]:
                    best[passage.item_id] = hit
        yield from best.values()


def leaks_of(indexes: list[Index], text: str) -> Iterator[tuple[int, float, int, int, int, int]]:
    """The leaks of a text under each of the indexes; its words are taken once."""
    words = words_of(text)
    if words:
        h = hashes(words)
        for index in indexes:
            yield from index.leaks(words, h)


def in_lots(indexes: Iterator[Index]) -> Iterator[list[Index]]:
    """Up to ``TOGETHER`` indexes at a time, for one pass over the documents."""
    while lot := list(islice(indexes, TOGETHER)):
        yield lot


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (item, at, b" ".join(p.words), b" ".join(p.answer))
            for item, text in zip(batch["item_id"], batch["text"])
            for at, p in enumerate(passages_of(item, text))
            if len(p.words) >= LEAST_WORDS
        ]
        yield pd.DataFrame(rows, columns=["item_id", "at", "words", "answer"])


def build_indexes(docs: DataFrame, benchmark: DataFrame) -> Iterator[Index]:
    """An index for each block of the benchmark."""
    items = settle(
        benchmark.select(
            F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
        ).where("item_id IS NOT NULL").distinct(),
        "leak-items",
    )
    # Passages, not items, are dealt to blocks: a long item fills several.
    cut = settle(items.mapInPandas(_cut, "item_id bigint, at bigint, words binary, answer binary"), "leak-passages")
    total = cut.count()
    if not total:
        return
    idf, own = idf_table(docs, cut)
    blocks = -(-total // BLOCK)
    order = ["item_id", "at", "words"]
    dealt = cut.withColumn("_block", F.lit(0))
    if blocks > 1:
        nr = numbered(cut, [], bins_for(total), F.xxhash64(*order), order, "_nr")
        dealt = settle(nr.withColumn("_block", F.floor(F.col("_nr") / BLOCK)), "leak-blocks")
    for block in range(blocks):
        part = dealt.where(F.col("_block") == block).select("item_id", "words", "answer")
        features, basis = latent_space(part, idf, own)
        passages = [Passage(r.item_id, tuple(bytes(r.words).split()), tuple(bytes(r.answer).split())) for r in part.collect()]
        row_of = np.full(FEATURES, -1, np.int32)
        row_of[features] = np.arange(len(features))
        latent = shortened(np.stack([w.astype(np.float32) @ basis[row_of[f]] for f, w in (vector(p.words, idf, own) for p in passages)]))
        yield Index(passages, latent, row_of, basis[:, : latent.shape[1]], idf, own)


_HITS = "doc_id bigint, item_id bigint, cosine double, common int, words int, answer_common int, answer_words int"


def _search(shared):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(doc, *hit) for doc, text in zip(batch["doc"], batch["text"]) for hit in leaks_of(shared.value, text)]
            yield pd.DataFrame(rows, columns=["doc", *[c.split()[0] for c in _HITS.split(", ")[1:]]])

    return search


def _short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        held = [(item, words_of(text)) for item, text in zip(batch["item_id"], batch["text"])]
        rows = [(item, b" ".join(words), len(words)) for item, words in held if 0 < len(words) < LEAST_WORDS]
        yield pd.DataFrame(rows, columns=["item_id", "sequence", "words"])


def _sequences(lengths: list[int], shared):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc"], batch["text"]):
                words = words_of(text)
                held = {b" ".join(words[i : i + n]) for n in lengths for i in range(len(words) - n + 1)}
                rows += [(doc, x) for x in held if shared.value[zlib.crc32(x) % BITS]]
                if len(rows) > 1 << 16:
                    yield pd.DataFrame(rows, columns=["doc", "sequence"])
                    rows = []
            yield pd.DataFrame(rows, columns=["doc", "sequence"])

    return cut


def exact_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """(doc, item_id, words) for items of fewer than ``LEAST_WORDS`` words that a document holds side by side; None without such items.

    A set of fixed size leaves out most sequences that are no item's before documents and items are joined.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    short = settle(items.where("item_id IS NOT NULL").mapInPandas(_short, "item_id bigint, sequence binary, words int").distinct(), "leak-short")
    lengths = [r.words for r in short.select("words").distinct().collect()]
    if not lengths:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(short.select(F.crc32("sequence").alias("doc"))))
    plain = texts(docs).select(F.col("doc_id").cast("string").alias("doc"), "text")
    held = plain.mapInPandas(_sequences(lengths, shared), "doc string, sequence binary")
    return held.join(short, "sequence").select("doc", "item_id", "words")


def find_leaks(docs: DataFrame, benchmark: DataFrame, short_items: bool = False) -> DataFrame:
    """(doc_id, item_id) and the evidence, for each document that holds a passage of a benchmark item.

    The benchmark is the stated set of queries, searched in blocks against every window of every whole document.
    Items of fewer than ``LEAST_WORDS`` words are left out unless ``short_items``: then a document that holds their
    words side by side is reported, ``exact``, with a cosine of 1. Null or empty texts, documents or items, match
    nothing. Rows that repeat in ``docs`` are reported once.
    """
    spark = docs.sparkSession
    plain = texts(docs).select(F.col("doc_id").cast("string").alias("doc"), "text")
    found = spark.createDataFrame([], _HITS.replace("doc_id bigint", "doc string"))
    for lot in in_lots(build_indexes(docs, benchmark)):
        shared = spark.sparkContext.broadcast(lot)
        found = found.unionByName(plain.mapInPandas(_search(shared), _HITS.replace("doc_id bigint", "doc string")))
    found = found.withColumn("exact", F.lit(False))
    short = exact_leaks(docs, benchmark) if short_items else None
    if short is not None:
        none = F.lit(0).alias
        found = found.unionByName(short.select(
            "doc", "item_id", F.lit(1.0).alias("cosine"), F.col("words").alias("common"), "words", none("answer_common"), none("answer_words"), F.lit(True).alias("exact")
        ))
    best = F.max_by(F.struct("cosine", "common", "words", "answer_common", "answer_words", "exact"), F.struct(F.col("common") / F.col("words"), "cosine"))
    grouped = found.groupBy(F.col("doc").cast("long").alias("doc_id"), "item_id").agg(best.alias("b"))
    return grouped.select("doc_id", "item_id", "b.*")


def _clean(shared):
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([next(leaks_of(shared.value, t), None) is None for t in batch], dtype=bool)

    return clean(F.coalesce(F.col("text").cast("string"), F.lit("")))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that hold no benchmark passage.

    Items of fewer than ``LEAST_WORDS`` words remove nothing: their words stand in clean documents as well.
    """
    for lot in in_lots(build_indexes(docs.select("doc_id", "text"), benchmark)):
        docs = docs.where(_clean(docs.sparkSession.sparkContext.broadcast(lot)))
    return docs


def op3_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)
