"""Tables kept as versions: files that never change, and for every version the list of files it is made of.

    <folder>/data/<table>/<write>/part-*.parquet      rows; a write adds a folder and touches no other
    <folder>/versions/<number>/                       Parquet: table, file, n_rows

A change finds the files that hold rows it touches, writes what becomes of those and names all others again. The
list of the next version is written aside and moved into place by one rename, after its files are complete: a reader
sees the version before or the one after, of all tables together, and a broken-off change leaves only files that no
list names. Of two changes made from one version the second fails. The file system's rename must not replace an
existing folder (HDFS and local ones don't; plain object stores have no such rename).

A list has a row a file, so it is as small as the tables are against a file's rows; the names of a table's files pass
through the driver, as for any table that Spark reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.session import delete, place, prepare, settle
from paxledger.sources.schema import TABLES
from paxledger.sources.tables import Tables, conform, load_tables

_LIST = "table string, file string, place string, n_rows bigint"
#: Files with less than this share of a table's mean rows a file are small; more of them than this are written together.
SMALL, MOST_SMALL = 0.25, 8


#: The whole path of a row's file.
_PLACE = "_metadata.file_path"


def _file(place: str) -> Column:
    """Folder and name of a file, which tell it from all others: writes have folders and Spark's files names of their own.
    Taken once a file, from paths that are grouped already, and never once a row."""
    return F.substring_index(place, "/", -2).alias("file")


class Outdated(Exception):
    """The version that a change started from isn't the newest any more."""


@dataclass(frozen=True)
class Edit:
    """A change of one table: rows whose ``on`` columns are in ``keys`` are what ``rewrite`` changes or leaves out,
    given any part of the table; ``added`` are new rows."""

    table: str
    keys: DataFrame | None = None
    on: tuple[str, ...] = ()
    rewrite: Callable[[DataFrame], DataFrame] | None = None
    added: DataFrame | None = None

    def applied(self, rows: DataFrame) -> DataFrame:
        """The whole of a table after the change."""
        out = self.rewrite(rows) if self.rewrite else rows
        return out if self.added is None else out.unionByName(self.added.select(*rows.columns))


class Store:
    """Versions of tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder.rstrip("/")

    # --- versions ---

    def versions(self) -> list[int]:
        files, where = place(self.spark, f"{self.folder}/versions")
        if not files.exists(where):
            return []
        return sorted(int(s.getPath().getName()) for s in files.listStatus(where))

    def version(self) -> int:
        """The newest version."""
        held = self.versions()
        if not held:
            raise FileNotFoundError(f"no version below {self.folder}")
        return held[-1]

    def files(self, version: int | None = None) -> DataFrame:
        """table, file, place, n_rows of a version, the newest unless told."""
        at = self.version() if version is None else version
        return self.spark.read.schema(_LIST).parquet(f"{self.folder}/versions/{at}")

    def read(self, version: int | None = None) -> Tables:
        """The tables as of a version, the newest unless told."""
        at = self.version() if version is None else version
        listed: dict[str, list[str]] = {}
        for r in self.files(at).select("table", "place").collect():
            listed.setdefault(r["table"], []).append(r["place"])
        names = [n for n in TABLES if n in listed]
        return Tables({n: (lambda n=n: self._rows(n, listed[n])) for n in names})

    def _rows(self, table: str, places: Iterable[str | None]) -> DataFrame:
        # Files of adopted tables have whole paths.
        paths = [p if p.startswith(("/", "file:")) or "://" in p else f"{self.folder}/data/{p}" for p in places if p]
        schema = TABLES[table].schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def rewind(self, version: int) -> None:
        """Forget all versions after this one. Their files stay, and no list names them."""
        for later in reversed([v for v in self.versions() if v > version]):
            delete(self.spark, f"{self.folder}/versions/{later}")

    def _switch(self, listed: DataFrame, version: int) -> int:
        aside = f"{self.folder}/pending/{uuid.uuid4().hex}"
        listed.select("table", "file", "place", "n_rows").coalesce(1).write.parquet(aside)
        files, where = place(self.spark, f"{self.folder}/versions")
        files.mkdirs(where)
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), self.spark._jsparkSession.sessionState().newHadoopConf())
        path = jvm.org.apache.hadoop.fs.Path
        _, target = place(self.spark, f"{self.folder}/versions/{version}")
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        if files.exists(target):
            raise Outdated(f"version {version} of {self.folder} exists")
        context.rename(path(aside), target, plain)
        return version

    # --- writing ---

    def _written(self, df: DataFrame, table: str, by: list[str] | None = None, files: int | None = None) -> DataFrame:
        """Write rows of a table as new files, and list them."""
        folder = f"{self.folder}/data/{table}/{uuid.uuid4().hex}"
        out = conform(df, table)
        if by:
            # Ranges are found in a pass of their own: what they are of is worked out once.
            out = settle(out, "to-cluster")
            order = [*by, *[c for c in out.columns if c not in by]]
            out = (out.repartitionByRange(files, *order) if files else out.repartitionByRange(*order)).sortWithinPartitions(*by)
        elif files:
            out = out.repartition(files)
        out.write.parquet(folder)
        return self._listed(table, folder, own=True)

    def _listed(self, table: str, folder: str, own: bool) -> DataFrame:
        rows = self.spark.read.schema(TABLES[table].schema).parquet(folder)
        counted = rows.groupBy(F.col(_PLACE).alias("place")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("file", _file("place"))
        at = F.concat(F.lit(f"{table}/"), "file") if own else F.col("place")
        listed = counted.select(F.lit(table).alias("table"), "file", at.alias("place"), "n_rows")
        # A table without rows has no files but one entry, so that the version names it.
        empty = self.spark.createDataFrame([(table, "", None, 0)], _LIST)
        return listed.unionByName(empty)

    def create(self, tables: Mapping[str, DataFrame], by: Mapping[str, list[str]] | None = None, files: int | None = None) -> int:
        """Write tables as version 0. ``by`` clusters a table's rows by ranges of columns, into so many files if told."""
        if self.versions():
            raise Outdated(f"{self.folder} holds versions already")
        by = by or {}
        with ThreadPoolExecutor(4) as pool:
            listed = list(pool.map(lambda n: self._written(tables[n], n, by.get(n), files if n in by else None), list(tables)))
        return self._switch(_together(listed), 0)

    def adopt(self, folders: Mapping[str, str]) -> int:
        """Make tables that lie in folders elsewhere version 0, without copying them."""
        if self.versions():
            raise Outdated(f"{self.folder} holds versions already")
        return self._switch(_together([self._listed(n, f, own=False) for n, f in folders.items()]), 0)

    def adopt_from(self, other: Store, tables: Iterable[str]) -> int:
        """Make tables of another store, as they are there now, version 0, without copying them."""
        if self.versions():
            raise Outdated(f"{self.folder} holds versions already")
        far = F.when(F.col("place").rlike("^(/|file:|[a-z0-9]+://)"), F.col("place")).otherwise(F.concat(F.lit(f"{other.folder}/data/"), "place"))
        return self._switch(other.files().where(F.col("table").isin(list(tables))).withColumn("place", far), 0)

    def touched(self, edit: Edit, version: int | None = None) -> DataFrame:
        """file, of the files that hold rows of the edit's keys. Only the key columns of the table are read."""
        rows = self.read(version)[edit.table]
        held = rows.select(*edit.on, F.col(_PLACE).alias("_place"))
        met = held.join(edit.keys.select(*edit.on).distinct(), list(edit.on), "left_semi").select("_place").distinct()
        return met.select(_file("_place"))

    def apply(self, edits: Iterable[Edit], by: Mapping[str, list[str]] | None = None, version: int | None = None) -> int:
        """Carry out edits of different tables on the newest version, and make the outcome the next one.

        Of each table only the files with rows of the edit's keys are written anew, and small files where there are
        more than ``MOST_SMALL``. ``version`` is the one that the edits were made from; if it isn't the newest any
        more, ``Outdated`` is raised and nothing changes.
        """
        start = self.version() if version is None else version
        if start != self.version():
            raise Outdated(f"{self.folder} is at version {self.version()}, not {start}")
        edits, by = list(edits), by or {}
        if len({e.table for e in edits}) < len(edits):
            raise ValueError("several edits of one table")
        before = self.files(start)
        listed = {}
        for r in before.collect():
            listed.setdefault(r["table"], {})[r["file"]] = r
        kept = before.where(~F.col("table").isin([e.table for e in edits]))
        with ThreadPoolExecutor(4) as pool:
            after = list(pool.map(lambda e: self._edited(e, listed.get(e.table, {}), start, by.get(e.table)), edits))
        return self._switch(_together([kept, *after]), start + 1)

    def _edited(self, edit: Edit, held: dict, version: int, by: list[str] | None) -> DataFrame:
        full = {f: r for f, r in held.items() if f}
        old = [r["file"] for r in self.touched(edit, version).collect()] if edit.keys is not None else []
        mean = sum(r["n_rows"] for r in full.values()) / max(1, len(full))
        small = [f for f, r in full.items() if r["n_rows"] < SMALL * mean and f not in old]
        if len(small) > MOST_SMALL:
            old += small
        rows = self._rows(edit.table, [full[f]["place"] for f in old])
        out = edit.applied(rows)
        gone = set(old)
        stay = self.spark.createDataFrame([tuple(r) for f, r in held.items() if f not in gone], _LIST)
        if not old and edit.added is None:
            return stay
        n = sum(full[f]["n_rows"] for f in old) or mean
        files = max(1, round(n / mean)) if mean else None
        return stay.unionByName(self._written(out, edit.table, by, files)).dropDuplicates(["table", "file"])


def _together(lists: list[DataFrame]) -> DataFrame:
    out = lists[0]
    for listed in lists[1:]:
        out = out.unionByName(listed)
    return out.dropDuplicates(["table", "file"])


def current(spark: SparkSession, folder: str) -> Tables:
    """The tables in ``folder`` as they are now: the newest version where it holds versions, else ``<folder>/<table>``."""
    store = Store(spark, folder)
    return store.read() if store.versions() else load_tables(spark, folder)
