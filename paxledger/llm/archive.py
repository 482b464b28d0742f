"""Fixity audit of WARC replicas by Merkle trees over ordered offset ranges.

Pages become WARC response records, which lie one after another in archive files. A leaf is a record: its
offset, length and SHA-256. A node stands for an ordered range of ``FAN`` children. Two replicas are compared
from the root down: only children of nodes that differ are joined, so a sound replica costs one comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paxledger.llm.common import bins_for, forget, numbered, settle

#: Children of a node, and records of an archive file.
FAN = 16
FILE_RECORDS = 1024


def record_bytes(url, body):
    """A WARC 1.1 response record as text; Content-Length counts the bytes of the body."""
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def layout(pages: DataFrame) -> DataFrame:
    """Leaves of a replica: page_id, file, nr in the file, place (over all), start, length, record_sha256.

    Records are ordered by page_id, then hash, so that the order doesn't depend on how the table is dealt out;
    nulls come first. A null url or html counts as empty. Repeated rows are records of their own.
    """
    record = record_bytes(F.coalesce(F.col("url").cast("string"), F.lit("")), F.coalesce(F.col("html").cast("string"), F.lit("")))
    leaves = pages.select(F.col("page_id").cast("long").alias("page_id"), record.alias("_record")).select(
        "page_id", F.octet_length("_record").cast("long").alias("length"), F.sha2("_record", 256).alias("record_sha256")
    )
    order = [F.col("page_id").asc_nulls_first(), "record_sha256"]
    hashed = settle(leaves, "warc-leaves")
    bins = bins_for(hashed.count())
    # Ranges by sampled bounds, written down with their number before anything depends on it.
    ranged = settle(hashed.repartitionByRange(bins, *order).withColumn("_range", F.spark_partition_id()), "warc-ranges")
    forget(hashed)
    bins = max(bins, 1 + (ranged.agg(F.max("_range")).first()[0] or 0))
    placed = numbered(ranged, [], bins, F.col("_range"), order, "place").drop("_range")
    placed = placed.withColumn("file", F.floor(F.col("place") / FILE_RECORDS).cast("long"))
    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).withColumn(
        "nr", (F.col("place") % FILE_RECORDS).cast("int")
    )


def _grown(levels: list[DataFrame], label: str) -> list[DataFrame]:
    """``levels`` and one more above them."""
    above = levels[-1].groupBy(F.floor(F.col("node") / FAN).cast("long").alias("_up")).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda x: x["digest"]), ""), 256).alias("digest")
    )
    return [*levels, settle(above.withColumnRenamed("_up", "node"), f"{label}-{len(levels)}")]


def tree(leaves: DataFrame, label: str) -> list[DataFrame]:
    """Levels of the tree from the leaves up to one root: (node, digest). ``leaves``: place, start, length, record_sha256.

    A node's digest covers its children's digests in order, and a leaf's its offset range and hash.
    """
    digest = F.sha2(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("start", "length", "record_sha256")]), 256)
    levels = [settle(leaves.select(F.col("place").alias("node"), digest.alias("digest")), f"{label}-0")]
    while True:
        levels = _grown(levels, label)
        if levels[-1].count() <= 1:
            return levels


def mismatches(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """Places of leaves that differ, found by descending from the root through differing nodes only."""
    suspects = None
    for level, (a, b) in enumerate(zip(reversed(ours), reversed(theirs))):
        if suspects is not None:
            a = a.join(suspects, F.floor(F.col("node") / FAN) == F.col("up"), "left_semi")
            b = b.join(suspects, F.floor(F.col("node") / FAN) == F.col("up"), "left_semi")
        other = b.select(F.col("node").alias("_node"), F.col("digest").alias("_digest"))
        differ = a.join(other, F.col("node") == F.col("_node"), "full").where(~F.col("digest").eqNullSafe(F.col("_digest")))
        suspects = settle(differ.select(F.coalesce("node", "_node").alias("up")), f"warc-differ-{level}")
        if level == 0 and suspects.isEmpty():
            break
    return suspects.select(F.col("up").alias("place"))


def audit(leaves: DataFrame, replica: DataFrame) -> DataFrame:
    """``leaves`` with ``intact``: whether the replica's record at that place has the same range and bytes."""
    ours, theirs = tree(leaves, "warc-ours"), tree(replica, "warc-theirs")
    # Trees of different heights get the same one, so that nodes of one level cover the same places.
    while len(ours) < len(theirs):
        ours = _grown(ours, "warc-ours")
    while len(theirs) < len(ours):
        theirs = _grown(theirs, "warc-theirs")
    sound = mismatches(ours, theirs) if ours[-1].count() else ours[0].select(F.col("node").alias("place")).limit(0)
    bad = sound.select(F.col("place").alias("_bad"))
    return leaves.join(bad, F.col("place") == F.col("_bad"), "left").withColumn("intact", F.col("_bad").isNull()).drop("_bad")


def op6_merkle_audit(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Audit of a replica in which every record whose page_id leaves 5 by division by 97 has lost its last byte.

    The given tables hold no second replica, so the damage is stated here and its place is to be found.
    """
    leaves = settle(layout(pages), "warc-layout")
    record = record_bytes(F.coalesce(F.col("url").cast("string"), F.lit("")), F.coalesce(F.col("html").cast("string"), F.lit("")))
    hurt = F.pmod(F.col("page_id"), F.lit(97)) == 5
    damaged = pages.select(
        F.col("page_id").cast("long").alias("_page"),
        F.sha2(record, 256).alias("_was"),
        F.when(hurt, F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record).alias("_record"),
    ).select(
        "_page", "_was", F.octet_length("_record").cast("long").alias("length"), F.sha2("_record", 256).alias("record_sha256")
    )
    where = leaves.select("page_id", "place", "start", F.col("record_sha256").alias("_sha"))
    replica = (
        where.join(damaged.distinct(), F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_sha") == F.col("_was")))
        .select("place", "start", "length", "record_sha256")
    )
    return audit(leaves, replica).select("page_id", "file", "nr", "start", "length", "record_sha256", "intact")


OP6_SQL = """
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
    || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10)
    || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
), l AS (
  SELECT page_id, strlen(record) AS length, sha256(record) AS record_sha256,
    row_number() OVER (ORDER BY page_id NULLS FIRST, sha256(record)) - 1 AS place
  FROM r
)
SELECT page_id, CAST(place // 1024 AS BIGINT) AS file, CAST(place % 1024 AS INTEGER) AS nr,
  CAST(coalesce(sum(length) OVER (PARTITION BY place // 1024 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
  CAST(length AS BIGINT) AS length, record_sha256, coalesce(page_id % 97 <> 5, TRUE) AS intact
FROM l
"""
