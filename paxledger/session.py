"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Joins split a hot key at run time. Forced, because a join followed by a grouping on its own key
#: would otherwise stay whole to save a shuffle, and send all rows of a hot key to one task.
REPLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Turn on the run-time settings that the plans count on, in a session made elsewhere."""
    for key, value in REPLANNING.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "paxledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with runtime re-planning on. Sizes (executors, memory, initial shuffle partitions)
    stay with the cluster's own configuration unless passed in ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **REPLANNING,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    # Local mode without the setting: one folder per session, remembered in the session itself.
    root = tempfile.mkdtemp(prefix="paxledger-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared folder; never reused, so a retry cannot meet old files."""
    path = f"{_shared_root(spark)}/paxledger/{label}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


#: Work folders of the innermost ``scratch`` of this thread; other threads have their own.
_scope: ContextVar[list[str] | None] = ContextVar("paxledger_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end every work folder that this thread makes inside. What is still to be read must be written
    elsewhere by then. Work of other threads, another stream's for one, is left alone."""
    made: list[str] = []
    outer = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in made:
            delete(spark, path)


def place(spark: SparkSession, path: str):
    """The file system that ``path`` lies in, and the path, as Hadoop has them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def delete(spark: SparkSession, path: str) -> None:
    files, where = place(spark, path)
    files.delete(where, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage with a table that outlives any executor, computes the input once, and gives the
    optimiser real sizes for its broadcast decisions. Used where a result feeds several later passes.
    """
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
