"""Audits of keys and column constraints, which Parquet itself does not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxledger.functions.scalars import or_zero


def pk_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once or contain NULL, with their number of rows."""
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where((F.col("n_rows") > 1) | incomplete)


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values of an alternate key that occur more than once; NULL counts as a value."""
    return df.groupBy(column).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def fk_orphans(child: DataFrame, parent: DataFrame, columns: list[str], parent_columns: list[str] | None = None) -> DataFrame:
    """Child rows whose key has no parent. A NULL in any key column lets the row pass."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns or columns, columns)])
    return child.where(complete).join(known, columns, "left_anti").select(*child.columns)


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of NULLs per required column, one row per column that has any. One pass over the table."""
    counted = df.select(*[F.col(c).isNull().cast("bigint").alias(c) for c in columns]).agg(
        *[or_zero(F.sum(c)).alias(c) for c in columns]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns])
    return counted.select(F.inline(pairs)).where("n_null > 0")


def not_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that lack a required column."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def check_in_list(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose value is outside a fixed list. As in a CHECK constraint, NULL passes."""
    return df.where(~F.col(column).isin(values))
