"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paxledger.session import settle, work_folder

__all__ = ["folder", "forget", "numbered", "settle", "spare", "table", "texts", "work_folder"]

#: Rows that one window of ``numbered`` holds on average, whatever the size of the group.
ROWS_PER_BIN = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of one batch that goes to Python: documents may be long, and a worker holds a batch several times over.
BATCH_ROWS = 1000


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` without nulls, and the named further columns; all others go.

    Lowers the session's rows for each Arrow batch to ``BATCH_ROWS`` where they are at Spark's default.
    """
    conf = docs.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(f"`{c}`") for c in more],
    )


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def folder(df: DataFrame) -> str | None:
    """The folder that a settled table lies in."""
    files = df.inputFiles()
    return files[0].rpartition("/")[0] if files else None


def forget(*settled: DataFrame) -> None:
    """Delete settled tables that nothing reads any more. Only folders that ``settle`` made are touched."""
    for df in settled:
        path = folder(df)
        if path and "/paxledger/" in path:
            jvm = df.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def bins_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_BIN))


def numbered(
    df: DataFrame, group: Sequence[str], bins: int, spread: Column, order: Sequence[Column | str], name: str
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in a column ``name``, without one task a group.

    ``spread`` is a long that deals the rows of a group out to ``bins`` bins. Bins come one after another,
    and rows within a bin by ``order``; a window holds one bin of one group. ``df`` is read twice: settle it
    if it is dear. Null group values form a group. Rows that are equal in ``order`` come in any order.
    """
    dealt = df.withColumn("_bin", F.pmod(spread, F.lit(bins)).cast("int"))
    keys = [*group, "_bin"]
    offsets = (
        dealt.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*[F.col(c).alias(f"_o{c}") for c in keys], "_rows")
    )
    before = Window.partitionBy(*[f"_o{c}" for c in group]).orderBy("_o_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    same = [ranked[c].eqNullSafe(offsets[f"_o{c}"]) for c in keys]
    return ranked.join(offsets, same).select(*df.columns, (F.col("_before") + F.col("_rank")).cast("long").alias(name))
