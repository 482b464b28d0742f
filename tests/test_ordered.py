"""The ordered operators against brute force, with one key holding most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from paxledger.operators import ordered
from paxledger.operators.ordered import interval_hits, least_overlapping, running_sums, start_hits

HOT = [1, 1, 1, 1, 2, 3]


@pytest.mark.parametrize(("bits", "levels"), [(3, 2), (2, 3), (20, 1), (24, 2)])
def test_running_sums(spark, bits, levels):
    rng = random.Random(7)
    rows = [(rng.choice(HOT), i * 7 - 500, rng.randint(-3, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = {(r.k, r.o): (r.s, r.n) for r in running_sums(df, ["k"], "o", {"s": F.col("v"), "n": F.lit(1)}, bits, levels).collect()}
    before = {(k, o): [v2 for k2, o2, v2 in rows if k2 == k and o2 <= o] for k, o, _ in rows}
    assert got == {key: (sum(vs), len(vs)) for key, vs in before.items()}


def _intervals(rng, n):
    rows = []
    for i in range(n):
        start = rng.randint(0, 60) * 10**9
        rows.append((i, rng.choice(HOT), start, start + rng.randint(0, 8) * 10**9))
    return rows


def test_interval_and_start_hits(spark):
    rows = _intervals(random.Random(3), 90)
    df = spark.createDataFrame(rows, "id long, k long, a long, b long")
    hits = {r.id: r.hits for r in interval_hits(df.where("id % 2 = 0"), df, ["k"], "a", "b").collect()}
    assert hits == {
        i: sum(1 for j, k2, c, e in rows if j % 2 == 0 and k2 == k and c <= b and e >= a) for i, k, a, b in rows
    }
    hits = {r.id: r.hits for r in start_hits(df.withColumn("lends", F.expr("id % 3 > 0")), ["k"], "a", "b", "lends").collect()}
    assert hits == {i: sum(1 for j, k2, c, e in rows if j % 3 > 0 and k2 == k and c <= a <= e) for i, k, a, b in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_least_overlapping(spark, seed):
    rng = random.Random(seed)
    rows = [(*r, rng.randint(0, 10**6)) for r in _intervals(rng, 120)]
    df = spark.createDataFrame(rows, "id long, k long, a long, b long, seq long")
    got = {r.id: r.least for r in least_overlapping(df, ["k"], "a", "b", "seq", ["id"]).collect()}
    assert got == {i: min(s for j, k2, c, e, s in rows if k2 == k and c <= b and e >= a) for i, k, a, b, _ in rows}


@pytest.mark.parametrize("whole", [0, 2**20])
def test_hot_keys_go_in_blocks_with_the_same_outcome(spark, monkeypatch, whole):
    """Rows that come twice and missing keys and moments, with windows of whole keys and of blocks."""
    monkeypatch.setattr(ordered, "WHOLE_ROWS", whole)
    rng = random.Random(5)
    rows = [(*r, rng.randint(0, 10**6)) for r in _intervals(rng, 60)]
    odd = [(90, None, 0, 5, 1), (91, 1, None, None, 1)]
    df = spark.createDataFrame([*rows, *rows[:9], *odd], "id long, k long, a long, b long, seq long")
    touch = lambda p, q: p[1] == q[1] and p[2] <= q[3] and q[2] <= p[3]
    all_ = [*rows, *rows[:9]]
    got = sorted((r.id, r.hits) for r in interval_hits(df, df, ["k"], "a", "b").collect())
    assert got == sorted((p[0], sum(touch(p, q) for q in all_)) for p in all_)
    lent = df.withColumn("lends", F.expr("id % 3 > 0 AND a IS NOT NULL"))
    got = sorted((r.id, r.hits) for r in start_hits(lent, ["k"], "a", "b", "lends").collect())
    assert got == sorted((p[0], sum(q[0] % 3 > 0 and p[1] == q[1] and q[2] <= p[2] <= q[3] for q in all_)) for p in all_)
    got = {r.id: r.least for r in least_overlapping(df, ["k"], "a", "b", "seq", ["id"]).collect()}
    assert got == {p[0]: min(q[4] for q in all_ if touch(p, q)) for p in all_}
    events, probes = df.select("k", F.col("a").alias("at"), "seq"), df.select("id", "k", F.col("b").alias("at"))
    got = sorted(((r.id, r.seq) for r in ordered.next_after(events, probes, ["k"], "at", "seq").collect()), key=repr)
    after = lambda p: min(((q[2], q[4]) for q in all_ if p[1] == q[1] and q[2] > p[3]), default=(0, None))[1]
    assert got == sorted([*((p[0], after(p)) for p in all_), (90, None), (91, None)], key=repr)


def test_one_shuffle_where_no_key_is_hot(spark):
    df = spark.createDataFrame(_intervals(random.Random(4), 40), "id long, k long, a long, b long")
    lent = df.withColumn("lends", F.lit(True))
    for rows in (interval_hits(df, df, ["k"], "a", "b"), start_hits(lent, ["k"], "a", "b", "lends")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan
