"""Load the twelve tables from Parquet or JDBC, and write new versions of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.functions.scalars import trim_char
from paxledger.session import prepare
from paxledger.sources.schema import TABLES


#: Tables whose rows follow the number of flights, passengers and bookings.
GROWING = ("vlucht", "inchecken_voor_vlucht", "passagier", "passagier_voor_vlucht", "object")


class Tables(Mapping[str, DataFrame]):
    """The tables by name. A table's plan is built when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def replacing(self, **tables: DataFrame) -> Tables:
        """The same tables with some of them exchanged; the others keep their plans."""
        kept = {name: (lambda n=name: self[n]) for name in self._builders}
        return Tables({**kept, **{name: (lambda d=df: d) for name, df in tables.items()}})


def conform(df: DataFrame, table: str) -> DataFrame:
    """Declared column order, with blanks trimmed from the right of fixed-width text."""
    spec = TABLES[table]
    return df.select(*[trim_char(c).alias(c) if c in spec.char_columns else df[c] for c in spec.names])


def incoming(df: DataFrame, table: str, prefix: str = "") -> DataFrame:
    """Rows on their way into ``table``, with blanks trimmed from the right of fixed-width text as stored rows
    have it, so that ``'KL '`` meets ``'KL'``. ``prefix`` stands before the column names (``new_gatecode``)."""
    fixed = {f"{prefix}{c}" for c in TABLES[table].char_columns}
    return df.select(*[trim_char(F.col(c)).alias(c) if c in fixed else F.col(c) for c in df.columns])


def lacks(table: str, columns: Iterable[str]) -> Column:
    """Whether one of ``columns`` that ``table`` requires is missing."""
    needed = [F.col(c).isNull() for c in columns if c in TABLES[table].required]
    return reduce(Column.__or__, needed, F.lit(False))


def load_tables(spark: SparkSession, folder: str) -> Tables:
    """Read ``<folder>/<table>`` Parquet with the declared types. Turns on the session settings of ``session.prepare``."""
    prepare(spark)
    return Tables(
        {
            name: (lambda n=name: conform(spark.read.schema(TABLES[n].schema).parquet(f"{folder}/{n}"), n))
            for name in TABLES
        }
    )


def load_jdbc(
    spark: SparkSession,
    url: str,
    names: Mapping[str, str],
    properties: Mapping[str, str],
    split: Mapping[str, tuple[str, int, int, int]] | None = None,
) -> Tables:
    """Read the tables from a live database.

    ``names`` maps a table to its name in the database. ``split`` maps a table to
    (column, lower, upper, parts); such a table is read over ``parts`` connections, each with its own
    key range. Rows outside the bounds are still read, by the first and last part. The tables that grow
    with the business (``GROWING``) need a split, the others come over one connection. Connection options
    come from the caller. Like every loader it turns on the session settings of ``session.prepare``.
    """
    prepare(spark)
    split = split or {}
    unsplit = [n for n in GROWING if n in names and n not in split]
    if unsplit:
        raise ValueError(f"give a split for {', '.join(unsplit)}: one connection would read all of it")

    def read(name: str) -> DataFrame:
        if name in split:
            column, lower, upper, parts = split[name]
            raw = spark.read.jdbc(
                url, names[name], column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=dict(properties)
            )
        else:
            raw = spark.read.jdbc(url, names[name], properties=dict(properties))
        typed = raw.select(*[raw[c.name].cast(c.type).alias(c.name) for c in TABLES[name].columns])
        return conform(typed, name)

    return Tables({name: (lambda n=name: read(n)) for name in names})


def scan_desks(t: Mapping[str, DataFrame]) -> DataFrame:
    """Every desk."""
    return scan(t, "balie")


def scan(t: Mapping[str, DataFrame], table: str) -> DataFrame:
    """All rows of one table, columns named one by one."""
    return t[table].select(*TABLES[table].names)


def write_version(df: DataFrame, path: str, by: list[str] | None = None, append: bool = False) -> str:
    """Write a table version below ``path`` and return the path.

    A version goes to its own path; overwriting the path being read would destroy the input. ``by``
    clusters the rows on those columns, so that file statistics let later reads skip files: it is a
    range layout, so one hot value is spread over several files rather than sent to one task.
    """
    out = df
    if by:
        out = df.repartitionByRange(*by, *[c for c in df.columns if c not in by]).sortWithinPartitions(*by)
    out.write.mode("append" if append else "errorifexists").parquet(path)
    return path


def write_tables(t: Mapping[str, DataFrame], folder: str) -> str:
    """Write every table to ``<folder>/<table>``. The jobs are independent, so a few run side by side."""
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda name: write_version(t[name], f"{folder}/{name}"), t))
    return folder
