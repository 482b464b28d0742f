"""Connected components of rows that share keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxledger.session import settle


def linked(rows: DataFrame) -> DataFrame:
    """(node, component) of every node of ``rows`` (node, key): nodes with a key in common, directly or through others,
    have the smallest of them as their component.

    Every node is tied to the smallest node of each of its keys, so that a key of n nodes is n ties and not n * n.
    Then ties are pulled straight in turns: a node's larger neighbours to its smallest one, and its smaller ones too.
    The rounds grow with the logarithm of the longest way between two nodes, and no key or component is gathered.
    """
    rows = rows.where("key IS NOT NULL").select(F.col("node").cast("bigint").alias("node"), "key").distinct()
    least = rows.groupBy("key").agg(F.min("node").alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    tied = rows.join(least, "key").where("node <> _least").select(F.col("node").alias("u"), F.col("_least").alias("v"))
    ties = settle(tied.distinct(), "ties")
    seen = None
    while True:
        now = tuple(ties.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
        both = ties.unionByName(ties.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("_m")).withColumnRenamed("u", "_u")
        up = both.where("v > u").join(near, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        up = settle(up.where("u <> v"), "ties-up")
        low = up.groupBy("u").agg(F.min("v").alias("_m")).withColumnRenamed("u", "_u")
        down = up.join(low, F.col("u") == F.col("_u"))
        pulled = down.select("u", F.col("_m").alias("v")).unionByName(down.select(F.col("v").alias("u"), F.col("_m").alias("v")))
        ties = settle(pulled.where("u <> v").distinct(), "ties")
    found = ties.groupBy("u").agg(F.min("v").alias("_component")).withColumnRenamed("u", "_node")
    nodes = rows.select("node").distinct()
    return nodes.join(found, F.col("node") == F.col("_node"), "left").select("node", F.coalesce("_component", "node").alias("component"))
