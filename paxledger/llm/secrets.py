"""Secret scans over an incremental blob ledger, in DataFrame functions only.

A version of a file is addressed by the SHA-256 of its content. The ledger holds which (blob, rule, rule
version) triples were scanned and what was found there; a scan reads only blobs with triples that the
ledger lacks, appends, and joins the findings back to every path that holds the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paxledger.llm.common import settle, spare, texts, work_folder

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
PEM = r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; one is kept if its group ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


#: For ``access`` and ``hex`` the least length is part of the pattern: such a run either has the length from
#: its first character on or nowhere, so leftmost matches are the same as those of ``+`` filtered by length.
RULES = (
    Rule("assign", 1, ASSIGN, 2, 12),
    Rule("access", 1, ACCESS),
    Rule("hex", 1, HEX),
    Rule("pem", 1, PEM),
)
#: For redaction a private key is its head, its base64 body and, if there is one, its END line.
PEM_KEY = PEM + r"[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,32}PRIVATE KEY-----)?"
REDACTED = (*RULES[:3], Rule("pem", 2, PEM_KEY))
BASE = ("assign", "access", "hex")

_SCANNED = "blob string, kind string, version int"
_FOUND = "blob string, kind string, version int, start int, end int"


def _hits(rule: Rule):
    """Per match: its number, the length of the text before it since the last match, its own length, its group's.

    Splitting by a pattern and extracting it walk over the same matches, so gaps and matches alternate.
    """
    text, pattern = F.col("text"), F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    rows = F.transform(
        F.arrays_zip(gaps.alias("gap"), matches.alias("hit"), judged.alias("judged")),
        lambda x, i: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            i.alias("nr"),
            F.length(x["gap"]).alias("gap"),
            F.length(x["hit"]).alias("long"),
            F.length(x["judged"]).alias("judged"),
        ),
    )
    return F.when(F.array_contains("todo", rule.kind) & F.col("text").rlike(rule.pattern), rows).otherwise(F.slice(rows, 1, 0))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


class Ledger:
    """Two growing tables below ``path``: what was scanned and what was found. One folder per increment."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        for name, schema in (("scanned", _SCANNED), ("found", _FOUND)):
            self._empty(schema).write.mode("append").parquet(f"{self.path}/{name}")

    def _empty(self, schema: str) -> DataFrame:
        return self.spark.range(0).selectExpr(*[f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in (c.split() for c in schema.split(", "))])

    def scanned(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/scanned", _SCANNED)

    def found(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/found", _FOUND)

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan what is new among ``versions`` (doc_id, text); returns (doc_id, blob), a row for each version.

        Findings are written before the list of what was scanned, so a run that breaks off in between scans
        those blobs again; ``findings`` counts equal spans once.
        """
        plain = texts(versions)
        hashed = plain.select("doc_id", "text", F.sha2("text", 256).alias("blob"))
        paths = settle(hashed.select("doc_id", "blob"), "secret-paths")
        wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
        pairs = paths.groupBy("blob").agg(F.min("doc_id").alias("at")).select("blob", "at", F.inline(wanted))
        unseen = settle(
            pairs.join(self.scanned().distinct(), ["blob", "kind", "version"], "left_anti")
            .groupBy("blob", "at")
            .agg(F.collect_set("kind").alias("todo")),
            "secret-unseen",
        )
        # The text of a blob is read at one of its paths; both keys are needed to spread a blob with many paths.
        to_read = unseen.select(F.col("blob").alias("_blob"), F.col("at").alias("_at"), "todo")
        new = hashed.join(to_read, (F.col("blob") == F.col("_blob")) & F.col("doc_id").eqNullSafe(F.col("_at")))
        hits = new.select("blob", F.inline(F.concat(*[_hits(r) for r in rules]))).where("long IS NOT NULL").distinct()
        so_far = Window.partitionBy("blob", "kind").orderBy("nr").rowsBetween(Window.unboundedPreceding, 0)
        ended = hits.withColumn("end", F.sum(F.col("gap") + F.col("long")).over(so_far).cast("int"))
        least = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.least)])
        kept = ended.where(F.col("judged") >= least[F.col("kind")]).select(
            "blob", "kind", "version", (F.col("end") - F.col("long")).cast("int").alias("start"), "end"
        )
        kept.write.mode("append").parquet(f"{self.path}/found")
        done = unseen.select("blob", F.inline(wanted), "todo").where("array_contains(todo, kind)").drop("todo")
        done.write.mode("append").parquet(f"{self.path}/scanned")
        return paths

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Per blob with findings under the given rule versions: its spans by start, then kind as listed."""
        order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
        current = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
        return (
            self.found()
            .where(F.col("version") == current[F.col("kind")])
            .groupBy("blob")
            .agg(F.array_sort(F.collect_set(F.struct("start", order[F.col("kind")].alias("nr"), "end", "kind"))).alias("spans"))
        )


def scan_secrets(docs: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans) for each row of ``docs``; spans are structs (start, nr, end, kind) in code points.

    A null text is empty and has no spans. Equal texts are scanned once, whatever their number; repeated
    rows come back as often as they are given. Without a ledger a new one is begun in the shared folder.
    """
    ledger = ledger or Ledger(docs.sparkSession, work_folder(docs.sparkSession, "ledger"))
    paths = ledger.scan(docs, rules)
    # Written down before the join, so that a blob with very many paths is split there.
    found = settle(ledger.findings(rules), "secret-findings")
    none = F.slice(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("nr"), F.lit(0).alias("end"), F.lit("").alias("kind"))), 1, 0)
    return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def redacted(text, spans, mark: str = "[SECRET]"):
    """``text`` with each maximal run of overlapping or touching spans replaced by ``mark``."""
    # Ends of earlier spans, so that each span knows where the text before it begins.
    ends = F.transform(spans, lambda s: s["end"])
    pieces = F.transform(
        spans,
        lambda s, i: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.when(i == 0, F.lit(0)).otherwise(F.array_max(F.slice(ends, F.lit(1), F.greatest(i, F.lit(1))))).alias("at"),
        ),
    )
    body = F.transform(
        pieces,
        lambda p, i: F.when(
            (i == 0) | (p["start"] > p["at"]), F.concat(F.substring(text, p["at"] + 1, p["start"] - p["at"]), F.lit(mark))
        ).otherwise(F.lit("")),
    )
    last = F.array_max(ends)
    rest = F.substring(text, last + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(body, ""), rest))


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with their columns, secrets in ``text`` replaced by a mark and ``n_chars`` counted anew."""
    blob_, doc_, spans_ = spare(docs, "_blob", "_doc", "_spans")
    found = scan_secrets(docs.select("doc_id", "text"), rules=REDACTED).where(F.size("spans") > 0)
    found = found.select(F.col("blob").alias(blob_), F.col("spans").alias(spans_), F.col("doc_id").alias(doc_)).distinct()
    blob = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    joined = docs.join(found, (blob == F.col(blob_)) & F.col("doc_id").cast("long").eqNullSafe(F.col(doc_)), "left")
    text = F.when(F.col(spans_).isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col(spans_)))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_secret_ledger(spark: SparkSession, docs: DataFrame) -> DataFrame:
    found = scan_secrets(docs)
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", name), ",").alias("spans"),
    )


OP5_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
h AS (
  SELECT doc_id, text, kind, nr, string_split_regex(text, pat) AS gaps, regexp_extract_all(text, pat) AS hits,
         regexp_extract_all(text, pat, grp) AS judged, least
  FROM t, (VALUES
    ('assign', 0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1, 12),
    ('access', 1, 'AKIA[A-Z0-9]+', 0, 18),
    ('hex', 2, '[0-9a-f]+', 0, 16),
    ('pem', 3, '-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----', 0, 1)) AS r(kind, nr, pat, grp, least)
),
e AS (
  SELECT doc_id, kind, nr, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, judged FROM h
),
l AS (
  SELECT doc_id, kind, nr, least, i, length(gaps[i]) AS gap, length(hits[i]) AS long, length(judged[i]) AS judged FROM e
),
s AS (
  SELECT *, CAST(sum(gap + long) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop FROM l
),
k AS (SELECT doc_id, kind, nr, stop - long AS start, stop FROM s WHERE judged >= least),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nr) FILTER (nr < 3), '') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nr) AS spans
  FROM k GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (doc_id)
"""
