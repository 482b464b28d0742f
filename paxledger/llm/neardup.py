"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

A signature has ``COMPONENTS`` b-bit minima, in ``CHUNKS`` chunks. Two signatures that differ in fewer than
``2 * CHUNKS`` components differ in one at most within some chunk (pigeonhole), so that every such pair meets
under a key of that chunk with one component left out: the chunk's allowed error, enumerated. Pairs that meet
are held to the distance, then confirmed on the full shingle sets.

Equal sets are one node from the start. Under each key, nodes are first compared with one of them, so a group of
n copies costs n comparisons; what this joins need not be compared again. Only nodes under one key that are still
in different components are then compared with one another, in blocks of bounded size, by how many elements
their sets can share and by longer signatures. Of a block only the nodes that may have a partner go on; with them go
their full sets, and what comes out are the links of a forest: at most one a node, whatever the number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paxledger.llm.common import forget, settle, spare, texts

WORDS = 4
#: Likeness of linked sets, as a fraction.
LINK = (80, 100)
COMPONENTS, CHUNKS = 60, 15
CHUNK = COMPONENTS // CHUNKS
#: Every pair of signatures that differ in so many components or fewer is found. At a Jaccard of 0.8 a pair
#: differs in more with a probability of about one in a million.
DISTANCE = 2 * CHUNKS - 1
#: Nodes of a block in the last comparison and elements of their sets, about, and different nodes to compare with under
#: the keys of one group.
BLOCK, BLOCK_ELEMENTS, LEADERS = 2048, 1 << 20, 2
#: A longer signature of bytes, for what is left to the last comparison, and in how many of its components a pair
#: may differ: 5.2 standard deviations above the mean at a Jaccard of 0.8, which one pair in ten million exceeds.
WIDE, WIDE_DISTANCE = 512, 149

_RNG = np.random.default_rng(20_240_602)
_A = _RNG.integers(0, 1 << 64, COMPONENTS + WIDE, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 64, COMPONENTS + WIDE, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles. bytes.lower and bytes.split are ASCII only."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in tokens], np.uint64)
    size = min(words, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + n]) * _P
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _minima(shingles: np.ndarray, functions: slice) -> np.ndarray:
    a, b = _A[functions], _B[functions]
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, (1 << 16) // len(a))
    for at in range(0, len(shingles), step):
        block = shingles[at : at + step, None] * a
        block += b
        np.minimum(least, block.min(axis=0), out=least)
    return least ^ (least >> np.uint64(32))


def signature(shingles: np.ndarray) -> bytes:
    """b-bit minima (b = 16) of the set under ``COMPONENTS`` hash functions."""
    return _minima(shingles, slice(0, COMPONENTS)).astype(np.uint16).tobytes()


def wide_signature(shingles: np.ndarray) -> bytes:
    """8-bit minima under ``WIDE`` further functions."""
    return _minima(shingles, slice(COMPONENTS, None)).astype(np.uint8).tobytes()


def _signed(words: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text, key in zip(batch["doc"], batch["text"], batch["text_key"]):
                s = shingle_set(text, words)
                held = (xxhash.xxh3_128_digest(s.tobytes()), signature(s)) if len(s) else (None, None)
                rows.append((doc, len(s), *held, key))
            yield pd.DataFrame(rows, columns=["doc", "n", "set_key", "sig", "text_key"])

    return sign


def signature_keys(sigs: np.ndarray) -> np.ndarray:
    """The keys of each signature: a row of one for each chunk and component left out, always in the same order."""
    parts = sigs.reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
    salt = np.random.default_rng(7).integers(0, 1 << 64, (CHUNKS, CHUNK), dtype=np.uint64)
    keys = np.empty(parts.shape, np.uint64)
    for out in range(CHUNK):
        key = np.zeros(parts.shape[:2], np.uint64)
        for c in range(CHUNK):
            if c != out:
                key = (key << np.uint64(16)) | parts[:, :, c]
        key = (key ^ salt[:, out]) * _P
        keys[:, :, out] = key ^ (key >> np.uint64(31))
    return keys.reshape(-1, CHUNKS * CHUNK).view(np.int64)


def _sigs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, COMPONENTS)


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in (batch[i : i + 4096] for i in range(0, len(batch), 4096)):
            keys = signature_keys(_sigs(part["sig"]))
            yield pd.DataFrame({"key": keys.reshape(-1), "node": np.repeat(part["node"].to_numpy(), keys.shape[1])})


def _distance(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in pairs:
        near = (_sigs(p["sa"]) != _sigs(p["sb"])).sum(axis=1) <= DISTANCE
        yield pd.DataFrame({"a": p["a"][near], "b": p["b"][near]})


def _confirmed(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in pairs:
        keep = []
        for x, y in zip(p["xa"], p["xb"]):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
            keep.append(can_link(len(a), len(b), shared))
        keep = np.array(keep, dtype=bool)
        yield pd.DataFrame({"a": p["a"][keep], "b": p["b"][keep]})


def _sets(words: int):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "shingles": [shingle_set(t, words).tobytes() for t in batch["text"]]})

    return make


def _elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(element, node) for each shingle, as 32 bits of its hash: shingles that fall together count as shared."""
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch[at : at + 256]
            each = [np.unique(np.frombuffer(x, np.uint64).astype(np.uint32)).view(np.int32) for x in part["shingles"]]
            yield pd.DataFrame(
                {"element": np.concatenate(each), "node": np.repeat(part["node"].to_numpy(), [len(x) for x in each])}
            )


def _wide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        wide = [wide_signature(np.frombuffer(x, np.uint64)) for x in batch["shingles"]]
        yield pd.DataFrame({"node": batch["node"], "n": batch["n"], "common": batch["common"], "wide": wide})


def can_link(na, nb, shared):
    """Whether sets of ``na`` and ``nb`` elements that share ``shared`` at most can be linked."""
    return LINK[1] * shared >= LINK[0] * (na + nb - shared)


def _by_block(rows: Iterator[pd.DataFrame], work) -> Iterator[pd.DataFrame]:
    """``work`` on the rows of each (key, i, j), which follow one another."""
    held = None
    for batch in rows:
        batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if batch.empty:
            continue
        group = batch[["key", "i", "j"]].to_numpy()
        starts = np.append(0, 1 + np.flatnonzero((group[1:] != group[:-1]).any(axis=1)))
        out = [work(batch.iloc[s:e]) for s, e in zip(starts, starts[1:])]
        if out:
            yield pd.concat(out)
        held = batch.iloc[starts[-1] :]
    if held is not None and len(held):
        yield work(held)


def _may_link(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nodes of each (key, i, j) that may be near one in another component, by sizes and signatures.

    A pair that meets under several keys counts under the first of them only.
    """

    def compare(held: pd.DataFrame) -> pd.DataFrame:
        key, i, j = held["key"].iloc[0], held["i"].iloc[0], held["j"].iloc[0]
        node, comp, block, n, common = (held[c].to_numpy() for c in ("node", "comp", "block", "n", "common"))
        sig = _sigs(held["sig"])
        wide = np.frombuffer(b"".join(held["wide"]), np.uint8).reshape(-1, WIDE)
        right = np.flatnonzero(block == j)
        met = np.zeros(len(held), bool)
        # Most nodes may lie in one component. These are compared with the others only, and within a block from there.
        each, many = np.unique(comp, return_counts=True)
        main = comp == each[many.argmax()]
        others = right[~main[right]]
        for x in np.flatnonzero((block == i) & ~(main & (i == j))):
            y = others if main[x] else right
            y = y[(comp[y] != comp[x]) & (main[y] | (node[y] > node[x]) | (i != j))]
            y = y[can_link(n[x], n[y], np.minimum(common[x], common[y]))]
            y = y[(sig[y] != sig[x]).sum(axis=1) <= DISTANCE]
            y = y[(wide[y] != wide[x]).sum(axis=1) <= WIDE_DISTANCE]
            if len(y):
                same = signature_keys(sig[y]) == (mine := signature_keys(sig[x : x + 1])[0])
                y = y[mine[same.argmax(axis=1)] == key]
                met[y] = True
                met[x] |= len(y) > 0
        return held.loc[met, ["key", "i", "j", "node", "comp", "block", "n", "sig", "wide"]]

    return _by_block(rows, compare)


def _forest(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between the components of each (key, i, j), confirmed on full sets: no more than it takes to join them."""

    def join(held: pd.DataFrame) -> pd.DataFrame:
        key, i, j = held["key"].iloc[0], held["i"].iloc[0], held["j"].iloc[0]
        node, comp, block, n = (held[c].to_numpy() for c in ("node", "comp", "block", "n"))
        comp, sig = comp.copy(), _sigs(held["sig"])
        keys = signature_keys(sig)
        wide = np.frombuffer(b"".join(held["wide"]), np.uint8).reshape(-1, WIDE)
        sets = [np.frombuffer(x, np.uint64) for x in held["shingles"]]
        right = np.flatnonzero(block == j)
        links = []
        for x in np.flatnonzero(block == i):
            y = right[(node[right] > node[x]) | (i != j)]
            y = y[can_link(n[x], n[y], np.minimum(n[x], n[y]))]
            y = y[(comp[y] != comp[x])]
            y = y[(sig[y] != sig[x]).sum(axis=1) <= DISTANCE]
            y = y[(wide[y] != wide[x]).sum(axis=1) <= WIDE_DISTANCE]
            # As before, a pair is looked at under the first key that it meets under.
            y = y[keys[x][(keys[y] == keys[x]).argmax(axis=1)] == key]
            for other in y:
                if comp[other] == comp[x]:
                    continue
                shared = len(np.intersect1d(sets[x], sets[other], assume_unique=True))
                if can_link(n[x], n[other], shared):
                    links.append((min(node[x], node[other]), max(node[x], node[other])))
                    comp[comp == comp[other]] = comp[x]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return _by_block(rows, join)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of ``edges`` (a, b) reaches, by alternating stars.

    Large star: a node's larger neighbours are tied to the smallest neighbour; small star: its smaller ones are.
    Either keeps components and brings nodes nearer to their smallest; when nothing changes, every component is
    a star. The rounds grow with the logarithm of a component's length, and no component is gathered.
    """
    edges = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars"
    )
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("m", "u").alias("m"))
        large = settle(
            both.where("v > u").join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "stars-large",
        )
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m")
        tied = large.join(low, F.col("u") == F.col("_u"))
        small = settle(
            tied.select("u", F.col("m").alias("v"))
            .unionByName(tied.select(F.col("v").alias("u"), F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            "stars-small",
        )
        forget(edges, large)
        edges, before, seen = small, seen, state(small)
        if seen == before:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp"))).groupBy("node").agg(F.min("comp").alias("comp"))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    sa = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    sb = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "xa", "xb").mapInPandas(_confirmed, "a bigint, b bigint")


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    sa = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa"))
    sb = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInPandas(_distance, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, with_text_key: bool = False, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; if wanted, the text's SHA-256 and a component's number.

    ``words`` are the words of a shingle. Texts without words have no shingles and stand alone. Rows of equal sets are one class whatever their ids; a
    null doc_id counts as larger than any other. Repeated rows come back as often as they are given.
    """
    plain = texts(docs)
    signed = settle(
        plain.select(F.col("doc_id").cast("string").alias("doc"), "text", F.sha2("text", 256).alias("text_key"))
        .mapInPandas(_signed(words), "doc string, n bigint, set_key binary, sig binary, text_key string")
        .select(F.col("doc").cast("long").alias("doc_id"), "n", "set_key", "sig", "text_key"),
        "near-signed",
    )
    # Classes of equal sets get a number each; the table that holds them is written before anything uses it.
    classes = (
        signed.where("n > 0")
        .groupBy("set_key")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("k"), F.min("sig").alias("sig"))
        .select("set_key", "sig", F.col("k.doc_id").alias("at"), F.col("k.text_key").alias("at_key"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = settle(classes, "near-nodes")
    keys = nodes.select("node", "sig").mapInPandas(_keys, "key bigint, node bigint")
    turn = F.pmod(F.col("key"), F.lit(LEADERS))
    led = keys.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min_by("node", F.xxhash64("node", turn)).alias("leader")).where("many > 1")
    led = settle(led.withColumnRenamed("key", "_key"), "near-led")
    shared = settle(keys.join(led, F.col("key") == F.col("_key")).select("key", "node", "leader"), "near-shared")

    met = shared.where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    first = settle(_near(met, nodes), "near-first")
    # Texts of nodes that share a key, read once more for their sets: by id and text, since an id may be null or have several.
    wanted = shared.select("node").distinct().join(nodes, "node").select("node", F.col("at").alias("_at"), F.col("at_key").alias("_key"))
    keyed = plain.join(wanted, F.col("doc_id").eqNullSafe(F.col("_at")) & (F.sha2("text", 256) == F.col("_key")))
    sets = settle(keyed.select("node", "text").mapInPandas(_sets(words), "node bigint, shingles binary").distinct(), "near-sets")
    links = settle(_links(first, sets), "near-links")
    comps = settle(components(links), "near-comps")

    def mixed(rows: DataFrame) -> DataFrame:
        """Rows of keys that still hold nodes of different components."""
        apart = rows.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most")
        apart = settle(apart.select(F.col("key").alias("_key")), "near-apart")
        return rows.join(apart, F.col("key") == F.col("_key")).drop("_key")

    placed = settle(shared.join(comps, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp")), "near-placed")
    left = settle(mixed(placed), "near-left")
    forget(shared, placed, led)
    # An element that no other node left has can't be shared with any: it counts against every pair of its node.
    of_left = sets.join(left.select("node").distinct(), "node", "left_semi")
    lone = (
        of_left.mapInPandas(_elements, "element int, node bigint")
        .groupBy("element")
        .agg(F.count(F.lit(1)).alias("df"), F.min("node").alias("node"))
        .where("df = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("lone"))
    )
    size = (F.octet_length("shingles") / 8).cast("bigint")
    sized = of_left.select("node", "shingles", size.alias("n")).join(lone, "node", "left").select(
        "node", "shingles", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("common")
    )
    able = sized.where(F.lit(LINK[1]) * F.col("common") >= F.lit(LINK[0]) * F.col("n"))
    sized = settle(able.mapInPandas(_wide, "node bigint, n bigint, common bigint, wide binary"), "near-sized")
    left = mixed(left.join(sized.select("node", "n"), "node"))
    # Each row goes to every block of its key, so blocks are counted over what is left there, not over all that met.
    blocks = left.groupBy("key").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("_blocks")
    )
    several = settle(blocks.where("_blocks > 1").select(F.col("key").alias("_key"), "_blocks"), "near-blocks")
    dealt = left.join(several, F.col("key") == F.col("_key"), "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1))).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("_blocks")).cast("int")
    )
    spread = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "key", "node", "comp", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j")
    )
    grouped = (
        spread.join(nodes.select("node", "sig").join(sized, "node"), "node")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .select("key", "i", "j", "node", "comp", "block", "sig", "n", "common", "wide")
    )
    found = settle(
        grouped.mapInPandas(_may_link, "key bigint, i int, j int, node bigint, comp bigint, block int, n bigint, sig binary, wide binary"),
        "near-found",
    )
    full = (
        found.join(sets, "node")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .select("key", "i", "j", "node", "comp", "block", "n", "sig", "wide", "shingles")
    )
    more = settle(full.mapInPandas(_forest, "a bigint, b bigint").distinct(), "near-more")
    forget(sets)
    if not more.isEmpty():
        comps = settle(components(links.unionByName(more)), "near-comps")
    least = (
        nodes.join(comps, "node", "left")
        .select("set_key", "node", "at", F.coalesce("comp", "node").alias("comp"))
    )
    named = least.groupBy("comp").agg(F.min("at").alias("component_id"))
    ids = least.join(named, "comp").select(F.col("set_key").alias("_set"), "component_id", "comp")
    more_columns = ["text_key", "comp"] if with_text_key else []
    return signed.join(ids, F.col("set_key") == F.col("_set"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("_set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(
            F.when(F.col("_set").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id"))), F.lit(False)
        ).alias("kept"),
        *more_columns,
    )


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs``, with their columns: of each component the row with the smallest doc_id, and all without words.

    Where rows of a component share that id, or have none, that with the smallest hash of its text stays, and of
    equal rows one.
    """
    found = near_duplicates(docs.select("doc_id", "text"), True, words)
    id_, key, turn = spare(docs, "_kept_id", "_kept_key", "_turn")
    grouped = found.where("comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("k"))
    alone = found.where("comp IS NULL").select("doc_id", "text_key", F.lit(True).alias("alone"))
    kept = settle(
        grouped.select(F.col("k.doc_id").alias("doc_id"), F.col("k.text_key").alias("text_key"), F.lit(False).alias("alone"))
        .unionByName(alone)
        .distinct()
        .select(F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.col("alone").alias("alone")),
        "near-kept",
    )
    hashed = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    stay = docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(kept[id_]) & (hashed == kept[key]))
    order = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    numbered_rows = stay.withColumn(turn, F.row_number().over(Window.partitionBy(id_, key).orderBy(order)))
    return numbered_rows.where(kept["alone"] | (F.col(turn) == 1)).select(*[docs[f"`{c}`"] for c in docs.columns])


def op4_multi_index_hamming(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


#: The contract of op4 in SQL: sets compared wherever they share a shingle, components by what each document reaches.
OP4_SQL = r"""
WITH RECURSIVE taken AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS w1, generate_subscripts(words, 1) AS nr FROM taken WHERE len(words) > 0),
following AS (
    SELECT doc_id, n, nr, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
    FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY nr)
),
shingles AS (
    SELECT DISTINCT doc_id, concat_ws(' ', w1, w2, w3, w4) AS shingle FROM following WHERE w4 IS NOT NULL OR (n < 4 AND nr = 1)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT x, y FROM shared s JOIN sizes a ON a.doc_id = s.x JOIN sizes b ON b.doc_id = s.y
    WHERE 100 * s.n >= 80 * (a.n + b.n - s.n)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, e.y FROM reached r JOIN both_ways e ON e.x = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
