"""Quality, leaks, packing, chat, archives and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import _plain, connect
from paxledger.llm import archive, chat, decontam, packing, quality, queries
from paxledger.llm.common import table
from tests.llm import nasty

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(_plain(v) for v in r) for r in df.select(*columns).collect())
    result = connect(FOLDER).execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == Counter(tuple(_plain(r[names.index(c)]) for c in columns) for r in result.fetchall())


# Quality


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in quality.op2_compression_quality(spark, folder).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    assert len(out) == 1000
    for d, r in out.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    judged = [(out[d].predicted, q) for d, q in labels if out[d].held_out]
    assert np.mean([p == q for p, q in judged]) > 0.93
    good = [p for p, q in judged if q == 1]
    assert np.mean(good) > 0.95


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame(
        [(i, int(i != 11), 0) for i in range(16)] + [(5, 1, 0), (12, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    docs = nasty.documents(spark)
    out = quality.score_quality(docs, labels)
    assert out.count() == len(nasty.TEXTS) and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.score_quality(docs, labels.limit(0)).count() == len(nasty.TEXTS)
    assert quality.score_quality(nasty.nothing(spark), labels).count() == 0
    held = {r.doc_id for r in labels.where(quality.held_out()).collect()}
    sampled, _ = quality.sample(docs, labels)
    assert held and not {t for t, _ in sampled} & {t for d, t in nasty.TEXTS if d in held and t not in (nasty.PAGE, nasty.SECRET)}


# Leaks

ITEMS = [(i, (nasty.prose(800 + i, 20 + i) + ". " + nasty.prose(900 + i, 8) + ".").capitalize()) for i in range(25)]


def paraphrase(text: str, every: int) -> str:
    words = text.split()
    return " ".join("reworded" if i % every == 2 and i < len(words) - 9 else w for i, w in enumerate(words))


def leak_cases():
    rng = random.Random(9)
    docs, want = [], set()
    for i, text in ITEMS:
        held = {0: text, 1: text.upper(), 2: paraphrase(text, 7), 3: paraphrase(text, 5)}[i % 4]
        docs.append((i, nasty.prose(1000 + i, rng.randint(0, 300)) + " " + held + " " + nasty.prose(1100 + i, rng.randint(0, 300))))
        want.add((i, i))
    docs += [(500 + i, nasty.prose(2000 + i, 400)) for i in range(60)]
    return docs, want


def test_leaks(spark):
    docs, want = leak_cases()
    bench = spark.createDataFrame(ITEMS + [(90, None), (91, ""), (92, "the of"), (None, "x y z u v w")], "item_id bigint, text string")
    found = decontam.find_leaks(nasty.documents(spark, docs + nasty.TEXTS), bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == want
    assert all(0 < r.cosine <= 1.0001 and r.common <= r.words for r in found)
    assert decontam.find_leaks(nasty.documents(spark, docs), bench.limit(0)).count() == 0
    assert decontam.find_leaks(nasty.nothing(spark), bench).count() == 0
    clean = decontam.without_leaks(nasty.documents(spark, docs), bench)
    assert sorted(r.doc_id for r in clean.collect()) == list(range(500, 560))


def test_leaks_of_short_items(spark):
    short = [(92, "the of"), (93, "The, of!"), (94, "Zoë's"), (95, "quite rare words"), (96, "a"), (97, "ab ab ab ab"), (98, None), (None, "the")]
    docs = nasty.TEXTS + [(600, "x quite-rare words."), (601, "quite rare wordsmith"), (602, "the\nof"), (602, "the\nof"), (603, "often")]
    bench = spark.createDataFrame(short + ITEMS[:4], "item_id bigint, text string")
    found = decontam.find_leaks(nasty.documents(spark, docs), bench, short_items=True).collect()
    want = set()
    for d, text in docs:
        held = decontam.words_of(text or "")
        for item, sought in short:
            n = len(words := decontam.words_of(sought or ""))
            if item is not None and n and any(held[i : i + n] == words for i in range(len(held) - n + 1)):
                want.add((d, item, n, True))
    assert {(r.doc_id, r.item_id, r.words, r.exact) for r in found} == want and len(found) == len(want)
    assert {i for _, i, *_ in want} == {92, 93, 94, 95, 96, 97}
    assert decontam.exact_leaks(nasty.documents(spark), bench.where("item_id < 90")) is None
    assert decontam.find_leaks(nasty.nothing(spark), bench, short_items=True).count() == 0


def test_leaks_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 30)
    docs, want = leak_cases()
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(nasty.documents(spark, docs), bench).collect()} == want


def test_leaks_of_a_very_long_item(spark):
    """An item of 900 passages, with its words parted by signs alone: every passage finds its own text."""
    words = [f"w{i}q" for i in range(450 * decontam.PASSAGE)]
    bench = spark.createDataFrame([(1, "-".join(words)), *ITEMS[:3]], "item_id bigint, text string")
    docs = [(i, nasty.prose(3000 + i, 20) + " " + " ".join(words[s : s + decontam.PASSAGE])) for i, s in enumerate(range(0, len(words), 2880))]
    docs += [(500 + i, nasty.prose(2000 + i, 400)) for i in range(9)]
    frame = nasty.documents(spark, docs)
    indexes = list(decontam.build_indexes(frame, bench))
    assert sum(len(x.passages) for x in indexes) == 902 and all(len(x.passages) <= decontam.BLOCK for x in indexes)
    for x in indexes:
        for p, row in zip(x.passages, x.latent):
            feature, weight = decontam.vector(p.words, x.idf, x.own)
            assert row @ (weight.astype(np.float32) @ x.basis[x.row_of[feature]]) > 0.99
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(frame, bench).collect()} == {(i, 1) for i in range(10)}


def test_leaks_of_short_items(spark):
    """Items of 5 to 15 words that many documents use, verbatim among words that no other document has."""
    items = [(n, " ".join(f"item{n}x{k}" for k in range(n))) for n in range(5, 16)]
    docs = [(n, " ".join(f"rare{n}y{k}" for k in range(41)) + f" {t} " + " ".join(f"rare{n}z{k}" for k in range(41))) for n, t in items]
    used = sorted({w for _, t in items for w in t.split()})
    docs += [(100 + i, " ".join(f"{w} {nasty.prose(5000 + 997 * i + k, 20)}" for k, w in enumerate(used))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = nasty.documents(spark, docs)
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(frame, bench).collect()} == {(n, n) for n, _ in items}


def test_frequencies_by_word(spark, monkeypatch):
    """Words of passages have their own frequencies, however full the buckets are."""
    monkeypatch.setattr(decontam, "DF_BUCKETS", 1)
    frame = nasty.documents(spark, [(i, f"often{i % 2} only{i}") for i in range(10)])
    passages = spark.createDataFrame([(bytearray(b"often1 only3 never"),)], "words binary")
    idf, own = decontam.idf_table(frame, passages)
    assert idf.tolist() == [np.log(11 / 11) + 1e-3]
    got = decontam.weights(decontam.hashes([b"often1", b"only3", b"never", b"only4"]), idf, own)
    assert np.allclose(got, np.log(11 / np.array([6, 2, 1, 11])) + 1e-3)


def small_index(seed: int = 5) -> tuple[decontam.Index, list[str]]:
    """An index of a few passages, in the space of their own features, where words have different weights."""
    idf = np.random.default_rng(seed).uniform(1, 9, decontam.DF_BUCKETS)
    texts = [nasty.prose(seed * 100 + k, 60) for k in range(8)]
    passages = [p for k, t in enumerate(texts) for p in decontam.passages_of(k, t)]
    vectors = [decontam.vector(p.words, idf) for p in passages]
    features = np.unique(np.concatenate([f for f, _ in vectors]))
    row_of = np.full(decontam.FEATURES, -1, np.int32)
    row_of[features] = np.arange(len(features))
    dense = np.zeros((len(passages), len(features)), np.float32)
    for k, (f, w) in enumerate(vectors):
        dense[k, row_of[f]] = w
    return decontam.Index(passages, dense, row_of, np.eye(len(features), dtype=np.float32), idf), texts


def test_windows_without_leaks_are_not_taken_one_by_one(monkeypatch):
    index, texts = small_index()
    words = decontam.words_of(texts[0])
    word = max(words, key=lambda w: index.idf[zlib.crc32(w) & decontam.DF_BUCKETS - 1] * (words.count(w) == 1))
    h = decontam.hashes([word] * 4000)
    assert index.searched
    calls, real = [], np.unique
    monkeypatch.setattr(decontam.np, "unique", lambda *a, **k: (calls.append(1), real(*a, **k))[1])
    assert not list(index.candidates(h))
    windows = sum(4000 // step for lots, *_ in index.searched for _, step in lots)
    assert len(calls) < windows / 10


@pytest.mark.parametrize("features", [1 << 18, 64])
def test_bound_of_lots_loses_nothing(monkeypatch, features):
    monkeypatch.setattr(decontam, "FEATURES", features)  # with few of them, words of different weights share one
    index, texts = small_index()
    rng = random.Random(3)
    given = [nasty.prose(k, 50) + " " + " ".join(w if rng.random() < 0.7 else "other" for w in t.split()) for k, t in enumerate(texts)] * 4
    given = [" ".join(g.split()[k:]) + " " + nasty.prose(900 + k, 400) for k, g in enumerate(given)]
    hashed = [decontam.hashes(decontam.words_of(t)) for t in given]
    got = [list(index.candidates(h)) for h in hashed]
    monkeypatch.setattr(decontam.Index, "_may_reach", lambda self, start, *more: np.ones(len(start), bool))
    assert got == [list(index.candidates(h)) for h in hashed] and sum(map(len, got)) > 100


def test_candidates_against_brute_force():
    """Recall of the latent search: windows whose full TF-IDF cosine is well above the threshold are candidates."""
    docs, _ = leak_cases()
    idf = np.full(decontam.DF_BUCKETS, 3.0)
    passages = [p for i, t in ITEMS for p in decontam.passages_of(i, t)]
    vectors = [decontam.vector(p.words, idf) for p in passages]
    features = np.unique(np.concatenate([f for f, _ in vectors]))
    dense = np.zeros((len(passages), len(features)))
    for row, (f, w) in zip(dense, vectors):
        row[np.searchsorted(features, f)] = w
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    keep = 1 + int(np.searchsorted(np.cumsum(s**2), decontam.ENERGY * (s**2).sum()))
    basis = vt[:keep].T.astype(np.float32)
    row_of = np.full(decontam.FEATURES, -1, np.int32)
    row_of[features] = np.arange(len(features))
    index = decontam.Index(passages, dense.astype(np.float32) @ basis, row_of, basis, idf)
    hit = total = 0
    for _, text in docs:
        h = decontam.hashes(decontam.words_of(text))
        got = {(s, e, p) for s, e, _, p in index.candidates(h)}
        for length in decontam.WINDOWS:
            for s in range(0, max(1, len(h) - length + length // 4), length // 4):
                e = min(s + length, len(h))
                f, first, n = np.unique(h[s:e] & np.uint32(decontam.FEATURES - 1), return_index=True, return_counts=True)
                w = n * 3.0
                full = np.zeros(len(features))
                known = row_of[f] >= 0
                full[row_of[f][known]] = w[known] / np.sqrt((w**2).sum())
                for p in np.flatnonzero(dense @ full >= decontam.COSINE + 0.03):
                    total += 1
                    hit += (s, e, int(p)) in got
    assert total > 50 and hit >= 0.9 * total


def test_common_words():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 12))]
        b = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 12))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert decontam.common_words(tuple(a), b) == t[-1][-1]


# Packing


def test_packs_are_exact_and_tight():
    rng = random.Random(5)
    for trial in range(60):
        hist = Counter(rng.randint(1, 64) for _ in range(rng.randint(0, 400)))
        packs = packing.shortest_pack_first(dict(hist), 64)
        assert all(n > 0 and sum(p) <= 64 for n, p in packs)
        placed = Counter()
        for n, p in packs:
            for x in p:
                placed[x] += n
        assert placed == hist
        used = sum(n for n, _ in packs)
        assert used <= 1.25 * -(-sum(k * v for k, v in hist.items()) // 64) + 1


def test_packing(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    given = nasty.TEXTS * 2
    out = packing.pack(nasty.documents(spark, given)).collect()
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = Counter()
    for d, t in given:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 2048):
            piece = np.array(ids[s : s + 2048], "<u4")
            want[d, s, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(nasty.nothing(spark)).count() == 0


def test_ids_of_added_tokens():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    encode = packing.encoder(packing.vocabulary_path())
    assert encode("hello <|endoftext|> world") == [31373, 220, 50256, 995]
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rng = random.Random(3)
    bits = ["<|endoftext|>", "<|endoftext", "<|", "|>", "hello", " ", "  ", "\n", "'s", "é", "🎉", "12", ""]
    for text in [t or "" for _, t in nasty.TEXTS] + ["".join(rng.choices(bits, k=12)) for _ in range(500)]:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


# Chat


def test_chat_round_trip(spark):
    odd = [
        (1, 0, "user", chat.PROBE_TEXT), (1, 1, "assistant", None), (1, 1, "assistant", "b" * 1000), (1, 2, None, "</turn>\n### x: y"),
        (2, 5, "sys:tem\\", "\\"), (2, 7, "assistant", "é🎉" * 300), (2, 7, "assistant", "é🎉" * 300), (None, 0, "assistant", "#"), (3, None, "user", ""),
        (2**53 + 1, 0, "assistant", "far"),
    ]
    frame = spark.createDataFrame([(*r, 1, "x") for r in odd], "conv_id bigint, turn bigint, role string, text string, seq int, step string")
    got = {r.conv_id: r for r in chat.op10_event_sourced_chat(spark, frame).collect()}
    by = defaultdict(list)
    for c, turn, role, text in [*odd, (-7, 0, "user", chat.PROBE_TEXT), (-7, 1, "assistant", chat.PROBE_TEXT)]:
        by[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{t[2]}\n{t[4]}\n" for t in turns)
        loss = "".join(t[4] for t in turns if t[2] == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_events_fold():
    log = [
        (1, "delta", "a", "lost"), (1, "open", "user", ""), (1, "delta", "user", "a"), (1, "delta", "user", "b"), (1, "edit", "user", "c"),
        (1, "delta", "user", "d"), (1, "open", "assistant", ""), (1, "delta", "assistant", "x"), (1, "regenerate", "assistant", ""),
        (1, "delta", "assistant", "y"), (2, "edit", "u", "lost"), (2, "open", "u", ""),
    ]
    assert list(chat.fold(iter(log))) == [(1, 0, "user", "cd"), (1, 1, "assistant", "y"), (2, 0, "u", "")]


def test_rendering_is_reversible():
    rng = random.Random(8)
    signs = ["#", "<", "\\", ":", " ", "\n", "/", "turn>", "### ", "</turn>\n", "a", "é"]
    for _ in range(2000):
        turns = [tuple("".join(rng.choice(signs) for _ in range(rng.randint(0, 8))) for _ in range(2)) for _ in range(rng.randint(0, 4))]
        assert chat.parse("".join(chat.render(*t)[0] for t in turns)) == turns
        for role, text in [*turns, *[("assistant", t) for _, t in turns]]:
            formatted, start, end = chat.render(role, text)
            assert chat.unescape(formatted[start:end]) == (text if role == "assistant" else "")


def test_mask_holds_assistants_only(spark):
    """A very long turn, read linearly; users' rows have no mask; a caller's own column called _tie means nothing."""
    long = "ab é🎉 </turn>\\ #" * 350_000
    frame = spark.createDataFrame(
        [(1, 0, "user", "hello"), (1, 1, "assistant", long), (1, 2, "system", "x")], "conv_id bigint, turn bigint, role string, text string"
    )
    log = chat.log_of(frame)
    rows = {r.message: r for r in chat.format_events(log.withColumn("_tie", F.lit("z"))).collect()}
    assert [(rows[i].loss_start, rows[i].loss_end) for i in (0, 2)] == [(0, 0), (0, 0)]
    assert chat.unescape(rows[1].formatted[rows[1].loss_start : rows[1].loss_end]) == long
    (told,) = chat.read_back(chat.format_events(log, tie="_tie")).collect()
    assert (told.loss_chars, told.loss_sha256) == (len(long), hashlib.sha256(long.encode()).hexdigest())


def test_empty_conversations(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert [r.conv_id for r in chat.op10_event_sourced_chat(spark, none).collect()] == [-7]


# Archives


def test_audit_finds_what_differs(spark):
    rows = [(i % 2900 if i % 11 else None, f"http://h/{i}", "<p>" + "x" * (i % 50) if i % 13 else None) for i in range(3000)]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id bigint, url string, html string, place int, node int")
    leaves = archive.settle(archive.layout(pages), "leaves")
    assert leaves.count() == 3000 and leaves.select("file", "nr").distinct().count() == 3000
    hurt = {5, 6, 1024, 2999}
    replica = leaves.withColumn("record_sha256", F.when(F.col("place").isin(*hurt), F.lit("0")).otherwise(F.col("record_sha256"))).where("place <> 77")
    found = archive.audit(leaves, replica)
    assert {r.place for r in found.where("NOT intact").collect()} == hurt | {77}
    assert archive.audit(leaves, leaves).where("NOT intact").count() == 0
    assert archive.op6_merkle_audit(spark, pages.limit(0)).count() == 0


def test_audit_of_trees_of_different_heights(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x") for i in range(17)], "page_id bigint, url string, html string")
    leaves = archive.settle(archive.layout(pages), "leaves")
    assert [r.place for r in archive.audit(leaves, leaves.where("place < 16")).where("NOT intact").collect()] == [16]
    assert archive.audit(leaves.where("place < 16"), leaves).where("NOT intact").count() == 0


# Pipeline


def test_pipeline(spark):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = table(spark, FOLDER, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = archive.settle(stage(spark, docs, FOLDER), f"test-{name}")
        assert docs.columns == names
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before) and len(after) > 0.8 * len(before)
        if name == "secret_scans":
            assert set(after) == set(before) and after != before
            assert not any(re.search("AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", t) for t in after.values())
        else:
            assert all(before[d] == t for d, t in after.items()) and len(after) < len(before)
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    tokens = {r.doc_id: (r.n, r.doc_tokens) for r in last.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("doc_tokens")).collect()}
    assert set(tokens) == set(before) and all(a == b for a, b in tokens.values())
    assert corpus_pipeline.run(spark, FOLDER).count() == last.count()
