"""Hard negatives by exact inner-product search with coordinate pruning over length buckets.

Vectors are scaled to integers and dealt to buckets of vectors of nearly one length; a bucket holds, for every
coordinate, its vectors in the order of that coordinate of their directions. A question is an anchor with windows of
scores. If a score must reach t, the direction of a vector of a bucket with greatest length l must keep to an angle of
arccos(t / |anchor| l) with the anchor, which bounds each of its coordinates: on the anchor's ``FOCUS`` largest
coordinates the ranges of feasible values are looked up in the sorted lists, what lies in all of them is a candidate,
and candidates are verified with exact inner products. Buckets that can't reach t are not met at all.

Questions come in blocks and meet buckets as cells, each a task's work of bounded size that returns its best few rows
a window. The bucket that promises most is searched first, and what it yields bounds the search of all others.

Every stated anchor is held against all rows, in blocks; the work grows with their product where directions are too
alike for pruning. Only rows of equal dimension meet.

Rows with a null label, a null vector, or a null or non-finite component take no part. A null vec_id is no anchor, and
comes last among equal scores. Repeated rows are rows of their own: a copy of an anchor may be its positive, and every
copy of an anchor is asked for. Among rows of equal score and id any comes first. Zero vectors score 0. Scaled
components and scores beyond 64 bits are cut to what 64 bits hold. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paxledger.llm.common import forget, settle, table

#: Components are multiplied by this and rounded down.
SCALE = 256
#: Vectors of a bucket differ in length by this factor at most.
GROWTH = 1.1
#: Bytes of the vectors of a bucket and of a block of anchors, as 64-bit numbers, on average.
BUCKET_BYTES, BLOCK_BYTES = 1 << 22, 1 << 21
#: Coordinates of an anchor that are looked up.
FOCUS = 6
#: Anchors whose scores are held at once.
CHUNK = 256
#: Allowance for rounding in bounds made of floating-point numbers.
SLACK = 1e-9

LOWEST, HIGHEST = -(2**63), 2**63 - 1
_FOUND = "arow bigint, slot int, score bigint, vec_id bigint, row bigint"
_HELD = "dim int, n bigint, longest double, shortest double, ids binary, known binary, labels binary, rows binary, vecs binary, width int"


def integer_vectors(rows: DataFrame) -> DataFrame:
    """row, vec_id, label, v, dim, length of the rows that take part; ``row`` numbers them. Settled."""
    x = F.col("embedding").cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    scaled = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), x.alias("x")
    ).where(F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    v = F.transform("x", lambda c: F.floor(F.lit(float(SCALE)) * c))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    numbered = scaled.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", v.alias("v"))
    return settle(numbered.select("*", F.size("v").alias("dim"), length.alias("length")), "negatives-vectors")


def _dealt(rows: DataFrame, group: list[str], size: int) -> DataFrame:
    """``rows`` with ``_part``: rows of a group dealt to as many parts as keep each near ``size`` bytes."""
    per_group = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_n") * F.greatest("dim", F.lit(1)) * 8 / size)).cast("bigint")
    return rows.join(per_group, group).withColumn("_part", F.pmod(F.xxhash64("row"), parts)).drop("_n")


def _held(frame: pd.DataFrame) -> dict:
    """The arrays of a group of rows as bytes, numbers in the narrowest type that fits."""
    v = np.stack([np.asarray(x, np.int64) for x in frame["v"]])
    most = max(int(v.max(initial=0)), -int(v.min(initial=0)) - 1)
    kind = next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
    known = frame["vec_id"].notna().to_numpy()
    return {
        "dim": v.shape[1],
        "n": len(v),
        "longest": float(frame["length"].max()),
        "shortest": float(frame["length"].min()),
        "ids": frame["vec_id"].fillna(HIGHEST).astype(np.int64).to_numpy().tobytes(),
        "known": known.tobytes(),
        "labels": frame["label"].to_numpy(np.int64).tobytes(),
        "rows": frame["row"].to_numpy(np.int64).tobytes(),
        "vecs": v.astype(kind).tobytes(),
        "width": kind().itemsize,
    }


class _Rows:
    """A group of rows, read back."""

    def __init__(self, held: pd.Series):
        self.n, self.dim = int(held["n"]), int(held["dim"])
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[int(held["width"])]
        self.v = np.frombuffer(held["vecs"], kind).reshape(self.n, self.dim)
        self.ids, self.labels, self.rows = (np.frombuffer(held[c], np.int64) for c in ("ids", "labels", "rows"))
        self.known = np.frombuffer(held["known"], bool)
        self.longest, self.shortest = float(held["longest"]), float(held["shortest"])
        plain = self.v.astype(np.float64)
        self.lengths = np.sqrt((plain * plain).sum(axis=1))
        self.directions = plain / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.most = float(np.abs(plain).max(initial=0))


def _bucket(frame: pd.DataFrame) -> pd.DataFrame:
    held = _held(frame)
    v = np.stack([np.asarray(x, np.float64) for x in frame["v"]])
    lengths = np.sqrt((v * v).sum(axis=1))
    directions = v / np.where(lengths > 0, lengths, 1)[:, None]
    held["orders"] = np.argsort(directions, axis=0, kind="stable").T.astype(np.int32).tobytes()
    return pd.DataFrame([held])


def buckets(vectors: DataFrame, size: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``vectors`` in buckets of nearly one length, with their sorted coordinate lists. Settled."""
    kind = F.when(F.col("length") > 0, F.floor(F.log(GROWTH, F.col("length")))).otherwise(F.lit(-1)).cast("bigint")
    dealt = _dealt(vectors.withColumn("_class", kind), ["dim", "_class"], size)
    built = dealt.groupBy("dim", "_class", "_part").applyInPandas(_bucket, f"{_HELD}, orders binary")
    return settle(built.withColumn("bucket", F.monotonically_increasing_id()), "negatives-buckets")


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    held = _held(frame)
    los, his = (np.stack([np.asarray(x, np.int64) for x in frame[c]]) for c in ("los", "his"))
    least = np.where(los <= his, los, HIGHEST).min(axis=1).astype(np.float64)
    # What a vector's length must be for the least demanding anchor.
    reach = np.where(least > 0, least / np.maximum(frame["length"].to_numpy(np.float64), 1e-300), -np.inf).min()
    held |= {"slots": los.shape[1], "los": los.tobytes(), "his": his.tobytes(), "reach": float(reach)}
    return pd.DataFrame([held])


def blocks(anchors: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """Anchors with windows (``los``, ``his``: arrays of one size for all) in blocks. Settled."""
    asked = anchors.where(F.exists(F.arrays_zip("los", "his"), lambda w: w["los"] <= w["his"]))
    dealt = _dealt(asked, ["dim"], size)
    built = dealt.groupBy("dim", "_part").applyInPandas(_block, f"{_HELD}, slots int, los binary, his binary, reach double")
    return settle(built.withColumn("block", F.monotonically_increasing_id()), "negatives-blocks")


def feasible(a: _Rows, at: np.ndarray, least: np.ndarray, b: _Rows, orders: np.ndarray) -> list[np.ndarray | None]:
    """For each anchor ``at`` of ``a`` the rows of ``b`` that may score ``least`` or more, None meaning all."""
    lengths = a.lengths[at]
    reach = lengths * np.where(least > 0, b.longest, b.shortest)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach > 0, least / reach, np.where(least > 0, np.inf, -np.inf))
    cosine = cosine - SLACK * (1 + np.abs(np.where(np.isfinite(cosine), cosine, 0)))
    angle = np.arccos(np.clip(cosine, -1, 1))
    q = a.directions[at]
    focus = np.argsort(-np.abs(q), axis=1, kind="stable")[:, :FOCUS]
    own = np.arccos(np.clip(np.take_along_axis(q, focus, axis=1), -1, 1))
    low = np.cos(np.minimum(np.pi, own + angle[:, None])) - SLACK
    high = np.cos(np.maximum(0.0, own - angle[:, None])) + SLACK
    start, stop = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f in np.unique(focus):
        values = b.directions[orders[f], f]
        rows, place = np.nonzero(focus == f)
        start[rows, place] = np.searchsorted(values, low[rows, place], "left")
        stop[rows, place] = np.searchsorted(values, high[rows, place], "right")
    out: list[np.ndarray | None] = []
    for i in range(len(at)):
        if cosine[i] > 1:
            out.append(np.empty(0, np.int64))
            continue
        narrow = [(stop[i, j] - start[i, j], j) for j in range(focus.shape[1]) if stop[i, j] - start[i, j] < b.n]
        if not narrow or cosine[i] <= -1:
            out.append(None)
            continue
        met = np.zeros(b.n, np.int8)
        for _, j in narrow:
            met[orders[focus[i, j], start[i, j] : stop[i, j]]] += 1
        out.append(np.flatnonzero(met == len(narrow)))
    return out


def products(q: np.ndarray, p: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of all rows of ``q`` and ``p``; ``most`` bounds the size of a product's sum."""
    if most < 2**53:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return q.astype(np.int64) @ p.astype(np.int64).T
    whole = q.astype(object) @ p.astype(object).T
    return np.clip(whole, LOWEST, HIGHEST).astype(np.int64) if q.shape[1] else np.zeros((len(q), len(p)), np.int64)


def _best(scores: np.ndarray, at: np.ndarray, b: _Rows, k: int) -> np.ndarray:
    """The ``k`` first of the rows ``at`` by falling score, then id."""
    if len(at) > k:
        at_least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= at_least]
    return at[np.lexsort((b.rows[at], b.ids[at], ~b.known[at], -scores[at].astype(object)))][:k]


def _cell(k: int, same: bool):
    """Searches one block of anchors in one bucket."""

    def search(block: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(block) and len(bucket):
            a, b = _Rows(block.iloc[0]), _Rows(bucket.iloc[0])
            slots = int(block["slots"].iloc[0])
            los, his = (np.frombuffer(block[c].iloc[0], np.int64).reshape(a.n, slots) for c in ("los", "his"))
            orders = np.frombuffer(bucket["orders"].iloc[0], np.int32).reshape(b.dim, b.n)
            least = np.where(los <= his, los, HIGHEST).min(axis=1)
            most = float(a.dim) * a.most * b.most
            for begin in range(0, a.n, CHUNK):
                at = np.arange(begin, min(a.n, begin + CHUNK))
                places = feasible(a, at, least[at].astype(np.float64), b, orders)
                verified = sum(b.n if c is None else len(c) for c in places)
                whole = products(a.v[at], b.v, most) if 4 * verified > b.n * len(at) else None
                for i, x in enumerate(at):
                    c = places[i]
                    if c is not None and not len(c):
                        continue
                    if whole is not None:
                        scores = whole[i]
                    else:
                        scores = np.zeros(b.n, np.int64)
                        here = slice(None) if c is None else c
                        scores[here] = products(a.v[x : x + 1], b.v[here], most)[0]
                    fit = (b.labels == a.labels[x]) == same
                    fit &= (b.rows != a.rows[x]) & (scores >= least[x])
                    rows = np.flatnonzero(fit) if c is None else c[fit[c]]
                    for slot in range(slots):
                        inside = rows[(scores[rows] >= los[x, slot]) & (scores[rows] <= his[x, slot])]
                        for r in _best(scores, inside, b, k):
                            found.append((a.rows[x], slot, scores[r], b.ids[r] if b.known[r] else None, b.rows[r]))
        out = pd.DataFrame(found, columns=["arow", "slot", "score", "vec_id", "row"])
        return out.astype({"arow": "int64", "slot": "int32", "score": "int64", "vec_id": "Int64", "row": "int64"})

    return search


def search(asked: DataFrame, held: DataFrame, k: int, same: bool) -> DataFrame:
    """The ``k`` best rows (``rank`` from 1) of every anchor and window, among rows of the same label or of others.

    ``asked`` are blocks, ``held`` buckets.
    """
    wide, deep = asked.select("block", "dim", "reach"), held.select("bucket", F.col("dim").alias("_dim"), "longest")
    can = F.col("reach") * (1 - SLACK) <= F.col("longest")
    cells = settle(wide.join(deep, (F.col("dim") == F.col("_dim")) & can).select("block", "bucket"), "negatives-cells")
    left, right = asked.join(cells, "block"), held.join(cells, "bucket")
    key = ["block", "bucket"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_cell(k, same), _FOUND)
    best = Window.partitionBy("arow", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return settle(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "negatives-found")


def _tightened(anchors: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Windows raised to the k-th score found in each: what lies below it can't be among the k best."""
    kth = found.where(F.col("rank") == k).groupBy(F.col("arow").alias("row")).agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("_kth")
    )
    raised = F.transform("los", lambda lo, i: F.greatest(lo, F.coalesce(F.try_element_at("_kth", i), lo)))
    return anchors.join(kth, "row", "left").withColumn("los", F.when(F.col("_kth").isNull(), F.col("los")).otherwise(raised)).drop("_kth")


def _all_best(anchors: DataFrame, held: DataFrame, first: DataFrame, k: int, same: bool, block_bytes: int) -> DataFrame:
    seeds = search(blocks(anchors, block_bytes), first, k, same)
    return search(blocks(_tightened(anchors, seeds, k), block_bytes), held, k, same)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    share: tuple[int, int] = (50, 95),
    bucket_bytes: int = BUCKET_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, embedding and label; ``is_anchor`` and ``label`` are expressions over vec_id and label. For
    every anchor and each of its best ``positives`` rows of the same label: the best ``negatives`` rows of another
    label whose score lies within ``share`` hundredths of the positive's.
    """
    vectors = integer_vectors(rows.withColumn("label", label))
    held = buckets(vectors, bucket_bytes)
    # Of each dimension the bucket that promises most.
    top = held.groupBy("dim").agg(F.max_by("bucket", F.col("n") * F.col("longest")).alias("bucket")).select("bucket")
    first = held.join(top, "bucket")
    window = lambda at: F.array(F.lit(at).cast("bigint"))
    anchors = vectors.where(F.coalesce(is_anchor, F.lit(False)))
    liked = _all_best(anchors.select("*", window(LOWEST).alias("los"), window(HIGHEST).alias("his")), held, first, positives, True, block_bytes)

    of_score = lambda hundredths, rounded: rounded(F.col("score").cast("decimal(20,0)") * hundredths / F.lit(100)).cast("bigint")
    bounds = liked.groupBy(F.col("arow").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("rank", of_score(share[0], F.ceil).alias("lo"), of_score(share[1], F.floor).alias("hi")))).alias("_w")
    )
    slots = F.sequence(F.lit(0), F.lit(positives - 1))
    side = lambda name, none: F.transform(slots, lambda i: F.coalesce(F.get("_w", i)[name], F.lit(none).cast("bigint")))
    asking = anchors.join(bounds, "row").select(*anchors.columns, side("lo", HIGHEST).alias("los"), side("hi", LOWEST).alias("his"))
    disliked = _all_best(settle(asking, "negatives-asking"), held, first, negatives, False, block_bytes)
    forget(held)
    pairs = liked.select("arow", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("arow"), F.col("vec_id").alias("anchor_id"))
    return (
        disliked.select("arow", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(pairs, ["arow", "slot"])
        .join(named, "arow")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def op13_lemp_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, b.r AS br, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(coalesce(list_inner_product(a.e, b.e), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, br) AS nth FROM s WHERE same)
  WHERE nth <= 5),
neg AS (
  SELECT pos.anchor_id, pos.vec_id AS positive_id, s.vec_id AS negative_id, pos.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY pos.ar, pos.nth ORDER BY s.score DESC, s.vec_id NULLS LAST, s.br) AS rank
  FROM pos JOIN s ON s.ar = pos.ar AND NOT s.same AND 50 * pos.score <= 100 * s.score AND 100 * s.score <= 95 * pos.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3"""
