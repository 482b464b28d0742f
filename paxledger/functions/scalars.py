"""Scalar functions the rules and changes use. All stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(column: Column) -> Column:
    """A missing count reads as 0."""
    return F.coalesce(column, F.lit(0))


def add_days(moment: Column, days: int) -> Column:
    """``moment`` moved by whole days."""
    return moment + F.make_dt_interval(F.lit(days))


def year_boundaries(start: Column, end: Column) -> Column:
    """How many New Year's Days lie between the two moments (not whole years elapsed)."""
    return F.year(end) - F.year(start)


def trim_char(column: str | Column) -> Column:
    """Fixed-width text without its padding, so that equal values compare equal."""
    return F.rtrim(F.col(column) if isinstance(column, str) else column)


def micros(moment: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, taken from its calendar fields.

    A cast through a zoned timestamp would repeat or skip an hour at clock changes and so break order.
    """
    day = F.unix_date(moment.cast("date")).cast("bigint") * F.lit(86_400_000_000)
    minutes = (F.hour(moment) * 60 + F.minute(moment)).cast("bigint") * F.lit(60_000_000)
    seconds = (F.date_part(F.lit("SECOND"), moment) * F.lit(1_000_000)).cast("bigint")
    return day + minutes + seconds


def labels(**flags: Column) -> Column:
    """The names of the flags that are true, in the order given."""
    return F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]))


def describe(**parts: Column) -> Column:
    """'name=value' pairs joined with blanks; a missing value prints as 'null'."""
    pieces = [F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("null"))) for name, value in parts.items()]
    return F.concat_ws(" ", *pieces)


def key_map(*columns: str) -> Column:
    """Key columns as a map from name to text."""
    pairs: list[Column] = []
    for name in columns:
        pairs += [F.lit(name), F.col(name).cast("string")]
    return F.create_map(*pairs)
