"""Booking requests as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from paxledger.operators.joins import BOOKING
from paxledger.plans.admission import REQUEST, admit_rows, row_checks
from paxledger.plans.changes import upsert_edit
from paxledger.session import scratch, settle
from paxledger.sources.schema import REQUEST_SCHEMA, TABLES
from paxledger.sources.versions import Store, current


#: Files of a micro-batch, so that a backlog comes in several.
FILES_PER_BATCH = 64


def read_requests(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Requests from Parquet files as they arrive in ``folder``, so many files at a time."""
    return spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stream_row_rules(stream: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """The stream with ``accepted`` and ``broken`` under the rules a request breaks alone. Keeps no state."""
    return row_checks(t, stream.select(*REQUEST)).select(*REQUEST, (F.size("broken") == 0).alias("accepted"), "broken")


def stream_row_rules_live(stream: DataFrame, base: str, out: str, checkpoint: str) -> StreamingQuery:
    """The same against the tables as they are when a micro-batch comes, until the source is exhausted.

    ``base`` holds versions (or plain tables): a desk that a version adds between two batches is known to the second.
    Every batch is one version's work throughout, and has a folder below ``<out>/checked`` that a replay writes anew.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        checked = stream_row_rules(batch, current(batch.sparkSession, base))
        checked.write.mode("overwrite").parquet(_batch_folder(out, "checked", batch_id))

    return (
        stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _batch_folder(out: str, kind: str, batch_id: int) -> str:
    return f"{out}/{kind}/batch={batch_id}"


def accepted_before(spark: SparkSession, out: str, batch_id: int | None = None) -> DataFrame:
    """Accepted requests of all batches, or of those before ``batch_id``. Only their folders are read."""
    schema = StructType([*REQUEST_SCHEMA.fields, StructField("batch", LongType())])
    rows = spark.read.schema(schema).option("basePath", f"{out}/accepted").parquet(f"{out}/accepted")
    return rows if batch_id is None else rows.where(F.col("batch") < batch_id)


def current_bookings(bookings: DataFrame, accepted: DataFrame) -> DataFrame:
    """Stored bookings with the accepted requests of all batches applied, later batches over earlier."""
    fresh = (
        accepted.groupBy(*BOOKING)
        .agg(F.max_by(F.struct("balienummer", "inchecktijdstip", "stoel"), F.struct("batch", "seq")).alias("_last"))
        .select(*BOOKING, "_last.balienummer", "_last.inchecktijdstip", "_last.stoel")
    )
    return bookings.join(fresh, BOOKING, "left_anti").unionByName(fresh).select(*TABLES["passagier_voor_vlucht"].names)


def booked(spark: SparkSession, base: str, out: str) -> Store:
    """The bookings that a stream keeps up: version 0 are those of ``base``, version n + 1 those after batch n."""
    state = Store(spark, f"{out}/bookings")
    if not state.versions():
        name = "passagier_voor_vlucht"
        source = Store(spark, base)
        if source.versions():
            state.adopt_from(source, [name])
        else:
            state.adopt({name: f"{base}/{name}"})
    return state


def stream_admit(stream: DataFrame, base_path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Admit each micro-batch against the stored tables and all batches before it, until the source is
    exhausted.

    A batch adds a folder of accepted and a folder of rejected requests named after its number, and a version of the
    bookings below ``<out>/bookings``, of which it writes only the files that it touches. It meets the bookings of the
    version before its own, never the batches themselves, so what it reads doesn't grow with their number. Parent
    tables are those of ``base_path`` when the batch comes, if that folder holds versions. A replayed batch starts
    from the version before its own, forgets later ones and writes over its own folders, so it comes out the same.
    """

    def admit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = booked(spark, base_path, out)
        state.rewind(batch_id)
        t = current(spark, base_path).replacing(passagier_voor_vlucht=state.read(batch_id)["passagier_voor_vlucht"])
        # Everything is written from one result; the batch's work folders go when it is.
        with scratch(spark):
            decided = settle(admit_rows(t, batch), "decided")
            accepted = decided.where("accepted").select(*REQUEST)
            accepted.write.mode("overwrite").parquet(_batch_folder(out, "accepted", batch_id))
            decided.where("not accepted").select(*REQUEST, "broken").write.mode("overwrite").parquet(
                _batch_folder(out, "rejected", batch_id)
            )
            state.apply([upsert_edit(accepted)], version=batch_id)

    return (
        stream.writeStream.foreachBatch(admit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
