"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows lie in source blocks. How many rows each block sends to each shard is drawn from the multivariate
hypergeometric law, the law that these counts have under a uniform permutation of all rows, with the shard
sizes fixed beforehand. Each block is permuted and cut by its row of the matrix, and each shard is permuted
again. All of it is DataFrame work; the driver draws one small row of counts a block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paxledger.llm.common import ROWS_PER_BIN, bins_for, forget, numbered, settle

SHARDS = 8
SEED = 20_240_601


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows out of ``good + bad`` are good; sizes may exceed 1e9, where numpy's own stops.

    Inversion over the log probabilities around the mode. Those further out than forty standard deviations
    (or 64) are below the resolution of a double and left out.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    sigma = (draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    reach = int(40 * sigma) + 64
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    step = np.log((good - k[:-1]) * (draws - k[:-1])) - np.log((k[:-1] + 1) * (bad - draws + k[:-1] + 1))
    log_p = np.concatenate(([0.0], np.cumsum(step)))
    weight = np.cumsum(np.exp(log_p - log_p.max()))
    return int(k[min(len(k) - 1, int(np.searchsorted(weight, rng.random() * weight[-1], side="right")))])


def communication_matrix(blocks: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard: row sums are ``blocks``, column sums are ``sizes``."""
    if sum(blocks) != sum(sizes):
        raise ValueError("blocks and shards hold different numbers of rows")
    rng = np.random.default_rng(seed)
    left, matrix = list(sizes), []
    for rows in blocks:
        drawn, rest, need = [], sum(left), rows
        for room in left:
            rest -= room
            take = hypergeometric(rng, room, rest, need)
            drawn.append(take)
            need -= take
        left = [room - take for room, take in zip(left, drawn)]
        matrix.append(drawn)
    return matrix


def shuffle_to_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = ROWS_PER_BIN) -> DataFrame:
    """Every row of ``docs`` with its ``shard`` and its ``slot`` there, uniformly at random.

    Law ``rows``: shard sizes differ by one row at most, the lower shards being the larger ones. The result
    follows from the rows, where they stand in the input, and ``seed``; rows are written down with a number first, so a
    task that runs again deals them as before, and equal rows go to all blocks. A null text has size 1 and the checksum of no bytes; a null ``doc_id`` is a value like others; repeated rows get
    places of their own; an empty table gives none. Columns other than ``doc_id`` and ``text`` are not carried.
    """
    spark = docs.sparkSession
    salt = lambda n: F.xxhash64(F.lit(seed + n), "_row", "doc_id", "text_crc32", "size")
    rows = settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("text_crc32"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-rows",
    )
    total = rows.count()
    blocks = max(1, -(-total // block_rows))
    placed = rows.withColumn("_block", F.pmod(salt(0), F.lit(blocks)).cast("int"))
    counts = dict(placed.groupBy("_block").count().collect())
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([counts.get(b, 0) for b in range(blocks)], sizes, seed)
    ends = [(b, np.cumsum(row).tolist()) for b, row in enumerate(matrix)]
    table = spark.createDataFrame(ends, "_b int, _ends array<bigint>")
    local = Window.partitionBy("_block").orderBy(salt(1), "_row")
    sent = (
        placed.withColumn("_rank", F.row_number().over(local) - 1)
        .join(table, F.col("_block") == F.col("_b"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "_row",
            F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).cast("int").alias("shard"),
        )
    )
    sent = settle(sent, "shard-sent")
    forget(rows)
    return numbered(sent, ["shard"], bins_for(total), salt(2), [salt(3), "_row"], "slot").drop("_row")


def op7_hypergeometric_shards(spark, docs: DataFrame) -> DataFrame:
    return shuffle_to_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
