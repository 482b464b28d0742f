"""Periodic runs, n-gram ratios and hard negatives against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paxledger.llm import negatives, queries, ratios, runs
from tests.llm import nasty

# --- periodic runs -----------------------------------------------------------------------------------


def plain_runs(words) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by comparing every word with every other."""
    names: dict = {}
    a = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    out = []
    for p in range(1, len(a) // 2 + 1):
        change = np.diff(np.concatenate([[0], (a[:-p] == a[p:]).astype(int), [0]]))
        for s, k in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1)):
            e = k + p
            if e - s >= max(12, 2 * p) and all((a[s : e - q] != a[s + q : e]).any() for q in range(1, p)):
                out.append((int(s), int(e - s), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng: random.Random, most: int) -> list[int]:
    n, letters = rng.randint(0, most), rng.choice([1, 2, 3, 6, 60])
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 2)):
        if n:
            a = rng.randrange(n)
            p, stop = rng.randint(1, max(1, (n - a) // 2)), rng.randint(a, n)
            for i in range(a, stop):
                w[i] = w[a + (i - a) % p]
    return w


def as_rows(found) -> list[tuple[int, int, int]]:
    return sorted(((s, e - s, p) for p, s, e in runs._long_enough(found).tolist()), key=lambda r: (r[0], r[2]))


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = some_words(rng, 40)
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert runs.z_function(s) == want


def test_solver():
    rng = random.Random(2)
    for _ in range(250):
        many = [np.array(some_words(rng, 170), np.int64) for _ in range(rng.randint(1, 4))]
        assert [as_rows(f) for f in runs.solve(many)] == [plain_runs(s.tolist()) for s in many]


def test_pieces_hold_every_run():
    rng = random.Random(3)
    for _ in range(120):
        s = np.array(some_words(rng, 400), np.int64)
        found = [np.empty((0, 3), np.int64)]
        if len(s) > 16:
            for low, high, start, stop in runs.pieces(len(s), 32):
                (part,) = runs.solve([s[start:stop]], (low, high))
                found.append(part + np.array([0, start, start]))
            assert as_rows(runs._merged(np.concatenate(found))) == plain_runs(s.tolist())


def test_one_word_many_times():
    (found,) = runs.solve([np.zeros(50_000, np.int64)])
    assert as_rows(found) == [(0, 50_000, 1)]


RUNNY = [
    *nasty.TEXTS,
    (20, "la " * 11),
    (21, "la " * 12),
    (22, " ".join(["x", *"one two three four five six seven".split() * 2, "y"])),
    (23, " ".join("a b c".split() * 5 + "a b".split() + "q r s".split() * 6)),
    (24, ("p q " * 8 + "z ") * 9),
    (25, nasty.prose(21, 700) + " " + (nasty.prose(22, 300) + " ") * 3),
    (25, nasty.prose(21, 700) + " " + (nasty.prose(22, 300) + " ") * 3),
]


def told(words: list[bytes]) -> tuple:
    found = plain_runs(words)
    keep = np.ones(len(words), bool)
    for s, n, p in found:
        keep[s + p : s + n] = False
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    left = b" ".join(w for w, k in zip(words, keep) if k)
    return len(found), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("tile", [runs.TILE, 64])
def test_collapse(spark, tile):
    rows = [(i, t) for i, t in RUNNY if len((t or "").split()) < 3000]
    got = runs.collapse(nasty.documents(spark, rows), tile)
    columns = ["doc_id", "n_runs", "start", "length", "period", "runs_sha256", "collapsed_sha256"]
    want = Counter((i, *told((t or "").encode().split())) for i, t in rows)
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == want
    texts = {(r.doc_id, r.collapsed) for r in got.where("collapsed IS NOT NULL").collect()}
    assert (21, "la") in texts and (22, "x one two three four five six seven y") in texts


def test_long_text_in_pieces(spark):
    """A long document is cut into rows; runs that cross pieces come out whole."""
    given = nasty.documents(spark, [(1, nasty.LONG + " " + ("u " + nasty.prose(31, 1500) + " ") * 4), (2, "w " * 20_000)])
    one, many = (sorted(map(tuple, runs.collapse(given, t).collect())) for t in (runs.TILE, 1 << 10))
    assert one == many and [r[2] for r in one] == [1, 1] and one[0][5] == 1501


def test_runs_of_nothing(spark):
    assert runs.collapse(nasty.nothing(spark)).count() == 0


def test_planted_runs(spark):
    rows = [(i, nasty.prose(i, 1 + i % 97)) for i in range(60)] + [(None, "a b c"), (14, None), (38, "")]
    got = {(r.doc_id, r.text) for r in runs.with_planted_runs(nasty.documents(spark, rows)).collect()}
    want = set()
    for i, t in rows:
        w, h = (t or "").split(), zlib.crc32(str(i).encode()) if i is not None else 1
        g, n = h // 10, len((t or "").split())
        if h % 10 == 0:
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
            want.add((i, " ".join(w)))
        else:
            want.add((i, t or ""))
    assert got == want


# --- n-gram ratios -----------------------------------------------------------------------------------

JUDGED = [
    *nasty.TEXTS,
    *[(100 + i, nasty.prose(40 + i, 60)) for i in range(30)],
    *[(200 + i, " | ".join(nasty.prose(80 + i, 40).upper().split())) for i in range(10)],
    (300, "one two three four five six seven eight " * 2 + nasty.prose(9, 40)),
    (301, "same line here\nsame line here\n\n\nother\nsame line here\n \t\n \t\n" + nasty.prose(10, 30)),
    (302, "# * $ % & | < > ## " + nasty.prose(11, 30)),
    (303, " ".join("a b c d e f g h i".split() * 3)),
    (304, " ".join("a b c d e f g h".split())),
    (305, "tab\tand\x0bline\x0cand\rreturn " + nasty.prose(12, 30)),
]
MARKS = [*[(100 + i, 1) for i in range(20)], (100, 1), (101, 0), (200, 0), (201, 0), (None, 1), (999, 1), (102, None)]


def marks(spark, rows=MARKS):
    return spark.createDataFrame([(i, q, 0, "x") for i, q in rows], "doc_id bigint, quality int, toxic int, text string")


def counted(text: str) -> tuple:
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    signs = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), signs, len(lines) - len(set(lines)), len(hit), failed


def grams(text: str) -> list[int]:
    m = [zlib.crc32(w.encode()) for w in re.split("[\x20\x09-\x0d]+", text) if w]
    size = ratios.BUCKETS
    return [x % size for x in m] + [size + ((a >> 16) * 40503 + b % size) % size for a, b in zip(m, m[1:])]


def verdicts(rows, labels) -> Counter:
    trusted = {i for i, _ in labels if i is not None} - {i for i, q in labels if q == 0}
    trusted = {i for i in trusted if all(q == 1 for j, q in labels if j == i and q is not None) and any(q == 1 for j, q in labels if j == i)}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t or ""))
        if i in trusted:
            target.update(grams(t or ""))
    all_raw, all_target, k = sum(raw.values()), sum(target.values()), ratios.PSEUDO
    weight = {b: round(1000 * np.log((target[b] + k) / (n * all_target / all_raw + k))) for b, n in raw.items()}
    out = Counter()
    for i, t in rows:
        g, signs = grams(t or ""), counted(t or "")
        total = sum(weight[b] for b in g)
        out[(i, *signs, not signs[-1] and total >= ratios.THRESHOLD * len(g), len(g), total)] += 1
    return out


def test_judge(spark):
    got = ratios.judge(nasty.documents(spark, JUDGED), marks(spark)).collect()
    assert Counter(tuple(r) for r in got) == verdicts(JUDGED, MARKS)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[100 + i] for i in range(30)) and not any(kept[200 + i] for i in range(10))


def test_judge_sql(spark):
    con = duckdb.connect()
    con.register("d", pd.DataFrame(JUDGED, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("l", pd.DataFrame(MARKS, columns=["doc_id", "quality"]).astype("Int64"))
    con.execute("CREATE VIEW documents AS FROM d; CREATE VIEW labels AS FROM l")
    got = con.execute(ratios.OP12_SQL)
    names = [c[0] for c in got.description]
    want = ratios.judge(nasty.documents(spark, JUDGED), marks(spark))
    assert names == want.columns
    assert Counter(got.fetchall()) == Counter(tuple(r) for r in want.collect())


def test_judge_without_labels_or_documents(spark):
    assert ratios.judge(nasty.nothing(spark), marks(spark)).count() == 0
    got = ratios.judge(nasty.documents(spark), marks(spark, [])).collect()
    assert len(got) == len(nasty.TEXTS) and {r.llr_total for r in got} == {0}
    assert all(r.kept != r.base_failed for r in got)


def test_repeated_words_of_a_very_long_text(spark):
    long = "alpha beta gamma delta " * 100_000
    (row,) = ratios.judge(nasty.documents(spark, [(1, long)]), marks(spark)).collect()
    assert (row.n_words, row.n_repeat_words, row.base_failed) == (400_000, 400_000, True)


# --- hard negatives ----------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, row string, v int, dim string, score int, slot int, `a.b` int"


def embedded(spark, rows):
    return spark.createDataFrame([(i, e, c, "r", 1, "d", 2, 3, 4) for i, e, c in rows], VECTORS).repartition(3)


def scaled(x: float) -> int:
    return int(np.floor(256 * float(np.float32(x))))


def plain_negatives(rows, moved=True) -> Counter:
    ok = []
    for i, e, c in rows:
        if c is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        ok.append((i, [scaled(x) for x in e], (c + 1) % 10 if moved and i is not None and i % 7 == 0 else c))
    last = lambda i: (i is None, i)
    out: Counter = Counter()
    for at, (i, e, c) in enumerate(ok):
        if i is None or i % 50:
            continue
        scores = [(sum(x * y for x, y in zip(e, f)), j, d) for k, (j, f, d) in enumerate(ok) if k != at and len(f) == len(e)]
        scores.sort(key=lambda s: (-s[0], last(s[1])))
        for p, j, _ in [s for s in scores if s[2] == c][:5]:
            fit = [s for s in scores if s[2] != c and 50 * p <= 100 * s[0] <= 95 * p][:3]
            for rank, (n, m, _) in enumerate(fit, 1):
                out[i, j, rank, m, p, n] += 1
    return out


def random_vectors(seed: int, n: int, dim: int, spread: float, alike: float) -> list:
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, dim))
    out = []
    for i in range(n):
        v = rng.normal(size=dim) + alike * middle[rng.integers(6)]
        v *= np.exp(spread * rng.normal()) / np.linalg.norm(v)
        out.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(10))))
    return out


def mined(spark, rows, **sizes) -> Counter:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(embedded(spark, rows), F.col("vec_id") % 50 == 0, moved, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in got.collect())


@pytest.mark.parametrize("spread, alike", [(0.0, 0.0), (0.0, 4.0), (1.5, 2.0)])
def test_negatives(spark, spread, alike):
    rows = random_vectors(3, 420, 12, spread, alike)
    want = plain_negatives(rows)
    assert want and mined(spark, rows) == want
    # Many buckets and blocks, so that seeds bound what the others have to look at.
    assert mined(spark, rows, bucket_bytes=12 * 8 * 60, block_bytes=12 * 8 * 3) == want


def test_negatives_of_awkward_rows(spark):
    rows = random_vectors(4, 160, 4, 0.5, 1.0)
    same = [0.5, 0.25, -0.125, 1.0]
    rows += [(1000 + i, same, i % 3) for i in range(40)] + [(1000, same, 1)] * 3
    rows += [(50, None, 1), (100, same, None), (150, [0.5, None, 0.1, 0.2], 1), (200, [float("nan"), 0.0, 0.0, 0.0], 1)]
    rows += [(250, [float("inf"), 0.0, 0.0, 0.0], 1), (300, [0.0] * 4, 2), (301, [0.0] * 4, 2), (350, [], 3), (351, [], 3), (352, [], 4)]
    rows += [(None, same, 1), (None, same, 2), (400, [1.0, 2.0], 5), (401, [2.0, 1.0], 5), (402, [1.0, 1.0], 6), (-50, same, 0)]
    want = plain_negatives(rows)
    assert mined(spark, rows) == want == mined(spark, rows, bucket_bytes=4 * 8 * 20, block_bytes=4 * 8 * 2)


def test_large_components(spark):
    rows = [(i, [1e6 * x for x in e], c) for i, e, c in random_vectors(5, 110, 6, 0.1, 1.0)]
    assert mined(spark, rows) == plain_negatives(rows)
    huge = [(i, [1e30, -1e30, 1.0], i % 3) for i in range(120)]
    assert all(abs(p) < 2**63 for *_, p, _ in mined(spark, huge))


def test_no_vectors(spark):
    assert mined(spark, []) == Counter()
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == Counter()


def test_pruning_keeps_what_counts():
    """Coordinate lists leave every row that reaches the score, and leave out most others where directions differ."""
    frame = pd.DataFrame(random_vectors(6, 600, 8, 0.0, 6.0), columns=["vec_id", "e", "label"])
    frame["v"] = [np.array([scaled(x) for x in e], np.int64) for e in frame["e"]]
    frame["length"] = [float(np.linalg.norm(v)) for v in frame["v"]]
    frame["row"] = frame["vec_id"]
    held = negatives._bucket(frame[["row", "vec_id", "label", "v", "length"]]).iloc[0]
    b = negatives._Rows(held)
    orders = np.frombuffer(held["orders"], np.int32).reshape(b.dim, b.n)
    scores = b.v.astype(np.int64) @ b.v.astype(np.int64).T
    least = np.full(b.n, 0.9 * 256 * 256)
    found = negatives.feasible(b, np.arange(b.n), least, b, orders)
    for i, c in enumerate(found):
        assert set(np.flatnonzero(scores[i] >= least[i])) <= set(range(b.n) if c is None else c)
    assert np.mean([b.n if c is None else len(c) for c in found]) < b.n / 2


@pytest.mark.parametrize("name", ["op12_ngram_ratio", "op13_lemp_negatives"])
def test_queries_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    got = con.execute(queries.SQL[name])
    df = queries.QUERIES[name](spark, folder)
    assert [c[0] for c in got.description] == df.columns
    assert Counter(got.fetchall()) == Counter(tuple(r) for r in df.collect())


def test_runs_query(spark):
    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_scale_tiled_runs"](spark, folder).collect()
    planted = {r.doc_id: r.text for r in runs.with_planted_runs(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    assert len(got) == len(planted)
    for r in got:
        words = planted[r.doc_id].encode().split()
        if len(words) < 2500:
            n, start, length, period, a, b = told(words)
            milli = 1000 * length // period if n else None
            assert tuple(r) == (r.doc_id, n, start, length, period, milli, a, b)
