"""Change history: what a row was before it was updated or deleted."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxledger.functions.scalars import micros
from paxledger.operators.ordered import next_after
from paxledger.sources.schema import TABLES

#: Values of the column ``actie``.
ACTIONS = ["update", "delete"]
HISTORY_COLUMNS = ["timestamp", "actie"]


def _as_of(moment: str | Column) -> Column:
    return F.to_timestamp_ntz(F.lit(moment)) if isinstance(moment, str) else moment


def history_rows(before: DataFrame, after: DataFrame, keys: list[str], as_of: str | Column) -> DataFrame:
    """Rows of ``before`` that ``after`` no longer has, or has with other values, as they were.

    Both are snapshots of one table with unique ``keys``. Each side is shuffled once, by key.
    """
    values = [c for c in before.columns if c not in keys]
    later = after.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_kept"))
    same = F.lit(True)
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    action = F.when(F.col("_kept").isNull(), "delete").when(~same, "update")
    return (
        before.join(later, keys, "left")
        .select(*before.columns, _as_of(as_of).alias("timestamp"), action.alias("actie"))
        .where(F.col("actie").isNotNull())
    )


def history_all(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], as_of: str | Column) -> dict[str, DataFrame]:
    """History rows of every table both sides have, by table name."""
    return {
        name: history_rows(before[name], after[name], list(spec.key), as_of)
        for name, spec in TABLES.items()
        if name in before and name in after
    }


def history_columns(table: str) -> list[tuple[str, str]]:
    """Name and type of the columns of a table's history: its own, then the moment and the action."""
    own = [(c.name, c.type.simpleString()) for c in TABLES[table].columns]
    return [*own, ("timestamp", "timestamp_ntz"), ("actie", "string")]


def as_of_state(current: DataFrame, history: DataFrame, keys: list[str], ts: str | Column) -> DataFrame:
    """The table as it was at ``ts``.

    The first history row after ``ts`` holds a key's values at that moment; a key without one has not
    changed since. Inserts are not logged, so a key that came only after ``ts`` shows with its first known
    values.
    """
    values = [c for c in current.columns if c not in keys]
    then = (
        history.where(F.col("timestamp") > _as_of(ts))
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*values), "timestamp").alias("_then"))
        .select(*keys, *[F.col(f"_then.{c}").alias(c) for c in values])
    )
    unchanged = current.join(then, keys, "left_anti").select(*current.columns)
    return unchanged.unionByName(then)


def arrivals(before: DataFrame, after: DataFrame, keys: list[str], as_of: str | Column) -> DataFrame:
    """Keys that ``after`` has and ``before`` has not, with the ``timestamp`` of their coming: the log of inserts."""
    return after.join(before.select(*keys), keys, "left_anti").select(*keys, _as_of(as_of).alias("timestamp"))


def as_of_many(probes: DataFrame, current: DataFrame, history: DataFrame, arrived: DataFrame, keys: list[str]) -> DataFrame:
    """Rows as they were, each at a moment of its own: ``probes`` with the values that their key had at ``moment``.

    ``probes`` has the keys and ``moment`` and may have more columns. ``history`` are the rows that ``history_rows``
    logs, ``arrived`` those of ``arrivals``, over any number of changes. The first thing that befell a key after the
    moment tells: an update or delete has the values until then, an arrival says that there was no such row; a key
    that nothing befell is as it is now. Probes of keys that were not there come back without values, ``present`` being
    false. Exact for every key and moment as long as every change is logged.
    """
    values = [c for c in current.columns if c not in keys]
    none = F.struct(*[F.lit(None).cast(current.schema[c].dataType).alias(c) for c in values])
    moment = micros(F.col("timestamp")).alias("_at")
    # At one moment, what ends there comes before what begins.
    ended = history.select(*keys, moment, F.struct(F.lit(0).alias("kind"), F.struct(*values).alias("old")).alias("_event"))
    begun = arrived.select(*keys, moment, F.struct(F.lit(1).alias("kind"), none.alias("old")).alias("_event"))
    asked = probes.withColumn("_at", micros(F.col("moment")))
    met = next_after(ended.unionByName(begun), asked, keys, "_at", "_event")
    now = current.select(*keys, F.struct(*values).alias("_now"), F.lit(True).alias("_held"))
    kind = F.col("_event.kind")
    told = met.join(now, keys, "left").select(
        *probes.columns,
        F.when(kind.isNull(), F.col("_now")).when(kind == 0, F.col("_event.old")).alias("_then"),
        F.when(kind.isNull(), F.coalesce("_held", F.lit(False))).otherwise(kind == 0).alias("present"),
    )
    return told.select(*probes.columns, *[F.col(f"_then.{c}").alias(c) for c in values], "present")
