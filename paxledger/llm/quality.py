"""Quality by compression: which of two dictionaries, of good or of bad text, makes a text smaller.

A dictionary is trained on texts of either label. Each text is compressed in blocks under both, and the
difference of the two sizes, in parts of the text's own compressed size, becomes a probability by a logistic
curve fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.llm.common import settle, table, texts

#: Most labelled texts of either label that are learnt from, those with the smallest hashes of their id.
SAMPLE = 1500
#: Most bytes of them in all that come to the driver, half for each label; texts beyond are left out whole.
SAMPLE_BYTES = 48 << 20
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 512
LEVEL = 3
#: Features of an empty text: no difference, no help, not compressible.
NO_TEXT = (0.0, 1.0, 1.0)


@dataclass(frozen=True)
class Model:
    """Dictionaries of good and bad text, and the curve: intercept, then a weight for each feature."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def blocks(text: str) -> list[bytes]:
    """The text's bytes in blocks, which begin anew so that the dictionary counts for all of a long text."""
    data = text.encode()
    return [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]


class Sizes:
    def __init__(self, good: bytes, bad: bytes):
        use = lambda d: zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_AUTO) if d else None,
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
        )
        self.packers = [use(good), use(bad), use(b"")]

    def features(self, text: str) -> tuple[float, float, float]:
        """Normalised difference of sizes (higher: nearer to good text), how far either dictionary helps, and how
        far the text compresses by itself, which tells repetition."""
        good = bad = plain = size = 0
        g, b, p = self.packers
        for block in blocks(text):
            good += len(g.compress(block))
            bad += len(b.compress(block))
            plain += len(p.compress(block))
            size += len(block)
        if not plain:
            return NO_TEXT
        return (bad - good) / plain, min(good, bad) / plain, plain / size


def dictionary(samples: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the texts' own bytes where there are too few to train one."""
    parts = [b for t in samples for b in blocks(t)]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:size]


def _row(features: tuple[float, float, float]) -> list[float]:
    return [1.0, *features]


def fit_curve(rows: list[list[float]], labels: list[int], share: float, ridge: float = 1e-3) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a slight ridge; ``share`` is that of good texts in the population."""
    x, y = np.array(rows, dtype=float), np.array(labels, dtype=float)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def train(examples: list[tuple[str, int]], share: float) -> Model:
    """Dictionaries from every second text of each label, the curve from the others.

    ``share``: of good texts among all that could be learnt from, of which ``examples`` may hold as many of either label.
    """
    good = [t for t, label in examples if label == 1]
    bad = [t for t, label in examples if label == 0]
    g, b = dictionary(good[::2]), dictionary(bad[::2])
    if not good or not bad:
        # One label alone: its share is all that can be learnt.
        share = (len(good) + 1) / (len(examples) + 2)
        return Model(g, b, (math.log(share / (1 - share)), 0.0, 0.0, 0.0))
    sizes = Sizes(g, b)
    seen = [(t, 1) for t in good[1::2]] + [(t, 0) for t in bad[1::2]]
    if len({label for _, label in seen}) < 2:
        seen = examples
    return Model(g, b, fit_curve([_row(sizes.features(t)) for t, _ in seen], [label for _, label in seen], share))


def held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[str, int]], float]:
    """At most ``SAMPLE`` learnable texts of either label, in a fixed order, and the share of good labels among all.

    Only ``quality`` and the text are used. A document that labels name with both qualities, or none, is not learnt from.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .where("quality = _most AND doc_id IS NOT NULL")
        .where(~held_out())
    )
    known = settle(known, "quality-known")
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("quality"), F.lit(0))).first()
    key = F.xxhash64("doc_id")
    chosen = known.where("quality = 1").orderBy(key, "doc_id").limit(SAMPLE).unionByName(
        known.where("quality = 0").orderBy(key, "doc_id").limit(SAMPLE)
    )
    plain = texts(docs)
    # At most 2 * SAMPLE rows of two numbers.
    ids = F.broadcast(settle(chosen.select(F.col("doc_id").alias("_id"), "quality"), "quality-sample"))
    found = plain.join(ids, F.col("doc_id") == F.col("_id")).select("doc_id", "quality", "text")
    found = found.withColumn("_bytes", F.octet_length("text")).groupBy("doc_id", "quality").agg(F.min_by("text", F.struct("_bytes", "text")).alias("text"))
    out, room = [], {0: SAMPLE_BYTES // 2, 1: SAMPLE_BYTES // 2}
    for row in found.orderBy(key, "doc_id").toLocalIterator():
        cost = len(row.text.encode())
        if cost <= room[row.quality]:
            room[row.quality] -= cost
            out.append((row.text, row.quality))
    return out, (good + 1) / (n + 2)


def _scorer(model: Model):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(model.good, model.bad)
        w = np.array(model.weights)
        for batch in batches:
            x = np.array([_row(sizes.features(t)) for t in batch["text"]]).reshape(-1, len(w))
            out = batch.drop(columns="text")
            out["score"] = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
            yield out

    return score


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels of documents whose crc32(doc_id as text) leaves 1 by division by 3 are never learnt from. Empty and
    null texts have no difference and get the curve's value there. Repeated rows are scored each.
    """
    model = train(*sample(docs, labels))
    plain = texts(docs).select(F.col("doc_id").cast("string").alias("doc"), "text")
    scored = plain.mapInPandas(_scorer(model), "doc string, score double")
    return scored.select(F.col("doc").cast("long").alias("doc_id"), "score").select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that the classifier doesn't reject."""
    model = train(*sample(docs, labels))

    @F.pandas_udf("boolean")
    def good(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = Sizes(model.good, model.bad)
        w = np.array(model.weights)
        for batch in batches:
            yield pd.Series([float(np.dot(_row(sizes.features(t)), w)) >= 0 for t in batch], dtype=bool)

    return docs.where(good(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
