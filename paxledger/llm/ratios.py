"""Quality rules: a base of counted signs, and a hashed n-gram likelihood ratio against trusted documents.

Words and pairs of neighbouring words fall into ``2 * BUCKETS`` hash buckets. Two multinomials over the buckets, one
of the trusted documents (those that ``labels`` marks good and never bad) and one of the whole corpus, give every
bucket a weight: the logarithm of the ratio of its counts, with ``PSEUDO`` added to both, in thousandths. A document's
weights are added up and held against ``THRESHOLD`` times their number, in integers, so that equal texts get equal
verdicts wherever they are computed. DataFrame functions throughout.

Counts are reduced on the map side to at most one row a bucket and task. The weights are one array of fixed size, read
by a scalar subquery. Texts are shuffled once, to meet their labels.

Null texts count as empty. Texts without words have no n-grams and fail the base rule. A null doc_id is never trusted.
Repeated rows are counted and judged each; without labels, or without documents, all weights are 0. Other columns of
``docs`` are left out. A text is worked on as one array of its words, which a task must hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.llm.common import settle, table, texts

#: Buckets of words, and as many again of pairs of words.
BUCKETS = 1 << 16
#: Added to the count in trusted documents and to the count expected there: rare buckets weigh little.
PSEUDO = 20
#: Least mean weight of a document that is kept, in thousandths.
THRESHOLD = -50
#: Words of a window that may repeat, fewest words, and the most of them in repeats, in hundredths.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

# What parts words, and signs that are counted.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` made once and not once for each element that needs it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    plain = text
    for blank in BLANKS[1:]:
        plain = F.replace(plain, F.lit(blank), F.lit(BLANKS[0]))
    return F.filter(F.split(plain, BLANKS[0], -1), lambda w: w != "")


def _pair(a: Column, b: Column) -> Column:
    return (F.lit(BUCKETS) + (F.shiftright(a, 16) * 40503 + b % BUCKETS) % BUCKETS).cast("int")


def numbers(words: Column) -> Column:
    return F.transform(words, lambda w: F.crc32(w))


def buckets(words: Column) -> Column:
    """The bucket of each word, then of each pair of neighbours."""

    def both(m: Column) -> Column:
        pairs = F.zip_with(F.slice(m, 1, F.greatest(F.size(m) - 1, F.lit(0))), F.slice(m, 2, F.size(m)), _pair)
        return F.concat(F.transform(m, lambda x: (x % BUCKETS).cast("int")), pairs)

    return _let(numbers(words), both)


def total_weight(words: Column, given: Column) -> Column:
    """The sum of ``given``, the weights in order of the buckets, over the buckets of ``words``."""
    none = F.lit(0).cast("bigint")

    def added(m: Column) -> Column:
        # The last word has no word after it.
        pair = lambda x, i: F.coalesce(F.get(given, _pair(x, F.get(m, i + 1))), F.lit(0).cast("smallint"))
        each = F.transform(m, lambda x, i: F.get(given, (x % BUCKETS).cast("int")).cast("int") + pair(x, i))
        return F.aggregate(each, none, lambda s, x: s + x)

    return _let(numbers(words), added)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many of ``words`` lie in windows of ``window`` words that occur twice or more. ``words`` is read many times over."""

    def hashed(size: int) -> Column:
        """A hash of the ``size`` words from each place on."""
        n = F.greatest(F.size(words) - size + 1, F.lit(0))
        parts = lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)])
        return F.slice(F.transform(words, parts), 1, n)

    def covered(found: Column) -> Column:
        """Length of the union of windows, given their windows sorted as (hash, place)."""
        again = lambda e, j: (F.get(found, j + 1)["h"] == e["h"]) | ((j > 0) & (F.get(found, F.greatest(j - 1, F.lit(0)))["h"] == e["h"]))
        places = F.array_sort(F.transform(F.filter(found, lambda e, j: F.coalesce(again(e, j), F.lit(False))), lambda e: e["i"]))
        gain = lambda a, b: F.coalesce(F.least(F.lit(window), b - a), F.lit(window))
        gains = lambda p: F.zip_with(p, F.slice(p, 2, F.size(p)), gain)
        return F.aggregate(_let(places, gains), F.lit(0).cast("bigint"), lambda s, g: s + g)

    def of_windows(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, _let(ordered, covered)).otherwise(F.lit(0).cast("bigint"))

    # A window that occurs twice begins with a half that does; few texts have any.
    repeats = _let(hashed(window // 2), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    enough = (F.size(words) > window) & repeats
    return F.when(enough, _let(hashed(window), of_windows)).otherwise(F.lit(0).cast("bigint"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    with_word = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return _let(with_word, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row, ``weights``: the weight of every bucket in thousandths, as an array in order of the buckets."""
    marks = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_quality"))
    trusted = marks.where("_id IS NOT NULL").groupBy("_id").agg(F.min("_quality").alias("_least")).where("_least = 1")
    # Shuffled at every size: labels may be as many as documents, and a table of them is not to be sent to every task.
    marked = texts(docs).join(trusted.hint("merge"), F.col("doc_id") == F.col("_id"), "left")
    grams = marked.select(
        F.col("_id").isNotNull().alias("trusted"), F.explode(_let(words_of(F.col("text")), buckets)).alias("bucket")
    )
    counts = settle(
        grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if("trusted").alias("target")), "ratio-counts"
    )
    all_raw, all_target = (counts.agg(F.sum(c)).scalar().cast("double") for c in ("raw", "target"))
    expected = F.col("raw").cast("double") * all_target / all_raw
    ratio = F.log((F.col("target").cast("double") + F.lit(float(PSEUDO))) / (expected + F.lit(float(PSEUDO))))
    each = counts.select("bucket", F.round(F.lit(1000.0) * ratio).cast("smallint").alias("weight"))
    full = docs.sparkSession.range(2 * BUCKETS).withColumnRenamed("id", "bucket").join(each, "bucket", "left")
    listed = F.array_sort(F.collect_list(F.struct("bucket", F.coalesce("weight", F.lit(0).cast("smallint")).alias("weight"))))
    return settle(full.agg(F.transform(listed, lambda e: e["weight"]).alias("weights")), "ratio-weights")


def judge(docs: DataFrame, labels: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_grams, llr_total.

    ``llr_total`` is the sum of the document's weights in thousandths and ``n_grams`` their number. A document that
    passes the base rule is kept if its mean weight reaches ``threshold``.
    """
    table_of = weights(docs, labels)
    text = F.col("text")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            repeated_words(w).alias("n_repeat_words"),
            _let(F.col("_weights"), lambda given: total_weight(w, given)).alias("llr_total"),
        )

    counted = texts(docs).withColumn("_weights", table_of.scalar()).select(
        "doc_id",
        _let(words_of(text), of_words).alias("_w"),
        F.char_length(F.translate(text, BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
    )
    n, repeated, total = F.col("_w.n_words"), F.col("_w.n_repeat_words"), F.col("_w.llr_total")
    failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)
    n_grams = F.greatest(2 * n - 1, F.lit(0))
    return counted.select(
        "doc_id",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeated.alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & (total >= threshold * n_grams)).alias("kept"),
        n_grams.alias("n_grams"),
        total.alias("llr_total"),
    )


def op12_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
trusted AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
w AS (
  SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k:
           CASE WHEN c % 2 = 0 THEN c // 2 ELSE xor(c // 2, 3988292384) END, n)) AS t),
m AS (
  SELECT rid, i, word, m FROM w JOIN (
    SELECT word, xor(4294967295, list_reduce(
             list_transform(range(length(h) // 2), lambda k: CAST('0x' || substr(h, CAST(2 * k + 1 AS INT), 2) AS BIGINT)),
             lambda c, b: xor(c // 256, t[CAST(xor(c, b) % 256 AS INT) + 1]), 4294967295)) AS m
    FROM (SELECT DISTINCT word, hex(encode(word)) AS h FROM w), crc) USING (word)),
g AS (
  SELECT rid, m % {BUCKETS} AS bucket FROM m
  UNION ALL
  SELECT rid, {BUCKETS} + ((before // {BUCKETS}) * 40503 + m % {BUCKETS}) % {BUCKETS}
  FROM (SELECT rid, m, lag(m) OVER (PARTITION BY rid ORDER BY i) AS before FROM m) WHERE before IS NOT NULL),
c AS (
  SELECT bucket, count(*) AS raw, count(*) FILTER (WHERE t.doc_id IS NOT NULL) AS target
  FROM g JOIN d USING (rid) LEFT JOIN trusted t ON t.doc_id = d.doc_id GROUP BY bucket),
wt AS (
  SELECT bucket, CAST(round(1000.0::DOUBLE * ln((target::DOUBLE + {PSEUDO}.0::DOUBLE)
    / (raw::DOUBLE * (SELECT sum(target) FROM c)::DOUBLE / (SELECT sum(raw) FROM c)::DOUBLE + {PSEUDO}.0::DOUBLE))) AS BIGINT) AS weight
  FROM c),
s AS (SELECT rid, CAST(sum(weight) AS BIGINT) AS llr_total FROM g JOIN wt USING (bucket) GROUP BY rid),
win AS (
  SELECT rid, i, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS seen,
         count(*) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS size
  FROM w),
again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, seen) AS times FROM win WHERE size = {WINDOW}) WHERE times >= 2),
rep AS (
  SELECT rid, CAST(sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) AS BIGINT) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM again) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
n AS (SELECT rid, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars FROM w GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(llr_total, 0) AS llr_total
  FROM d LEFT JOIN n USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN s USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
         AND llr_total >= {THRESHOLD} * greatest(2 * n_words - 1, 0) AS kept,
       CAST(greatest(2 * n_words - 1, 0) AS BIGINT) AS n_grams, llr_total
FROM f"""
