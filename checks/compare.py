"""Run queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare <folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from checks.oracle import sql
from checks.queries import QUERIES
from paxledger.session import build_session

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("n", format(value.normalize(), "f"))
    if isinstance(value, float):
        return ("n", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, (datetime, date)):
        return ("t", value.isoformat())
    return value


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str | None:
    """What differs between the two results, or None."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = con.execute(sql()[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    if got == expected:
        return None
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} rows against {sum(expected.values())}; "
        f"only in Spark {list(extra)[:2]}, only in SQL {list(missing)[:2]}"
    )


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    wrong = 0
    for name in names or QUERIES:
        if name not in sql():
            print(f"{name:34} no SQL", flush=True)
            continue
        begun = time.time()
        try:
            found = difference(spark, con, folder, name)
        except (duckdb.Error, PySparkException) as error:
            found = f"{type(error).__name__} {error}"
        wrong += found is not None
        print(f"{name:34} {time.time() - begun:6.1f}s {'same' if found is None else 'DIFFERS: ' + found}", flush=True)
    print(f"{wrong} differ")
    return wrong


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
