"""Ordered operators that no single key can overload.

A window over one key puts all rows of that key into one task. Here the order column is cut into
blocks by its upper bits, each block is summed on its own, and a block starts from the sum of the
blocks before it. A window then holds one block of one key, or one sum per block of a key.

Where it is counted first that no key has more than ``WHOLE_ROWS`` rows, the key's rows go through one window as they
are, which takes one shuffle in place of some ten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paxledger.session import settle

#: Arrival numbers: at most 2**24 rows in a block, and 2**24 blocks up to number 2**48.
SEQUENCE_BITS = 24
#: Microseconds: a block is 18 minutes, at most 322,000 moments of 1/300 second; a century has 3 million blocks.
MOMENT_BITS = 30

#: Most rows of a key that go through one window without blocks; a window of more rows than fit spills.
WHOLE_ROWS = 2**20
#: Groups of keys that are counted together.
_KEY_GROUPS = 2**16


def _no_hot_key(rows: DataFrame, keys: list[str], most: int | None = None) -> bool:
    """Whether no key has more than ``most`` rows. Counted are groups of keys, reduced before the shuffle, so that the
    count of a key's group is the most it can have."""
    group = F.pmod(F.xxhash64(*keys), F.lit(_KEY_GROUPS)).alias("_group")
    largest = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return (largest or 0) <= (WHOLE_ROWS if most is None else most)


def _given(*columns: str) -> Column:
    """Whether none of ``columns`` is missing, as an equi-join needs them."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def running_sums(
    df: DataFrame, keys: list[str], order: str, sums: dict[str, Column], bits: int = SEQUENCE_BITS, levels: int = 2
) -> DataFrame:
    """``df`` with inclusive running sums per ``keys`` in ascending ``order``.

    ``order`` is BIGINT and distinct within a key (aggregate first where it is not). ``sums`` maps each
    new column to the BIGINT expression to add up. A block spans ``2**bits`` order values; a further level
    cuts the blocks themselves into blocks, for an order column with a very wide and full range.
    """
    valued = df.select("*", *[e.cast("bigint").alias(n) for n, e in sums.items()])
    return _running(valued, keys, order, list(sums), bits, levels)


def _running(df: DataFrame, keys: list[str], order: str, names: list[str], bits: int, levels: int) -> DataFrame:
    if levels == 1:
        upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({n: F.sum(n).over(upto) for n in names})

    block = f"_block{levels}"
    placed = df.withColumn(block, F.shiftright(order, bits))
    per_block = placed.groupBy(*keys, block).agg(*[F.sum(n).alias(n) for n in names])
    through = _running(per_block.withColumns({f"_own_{n}": F.col(n) for n in names}), keys, block, names, bits, levels - 1)
    before = through.select(*keys, block, *[(F.col(n) - F.col(f"_own_{n}")).alias(f"_before_{n}") for n in names])

    upto = Window.partitionBy(*keys, block).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        placed.join(before, [*keys, block])
        .withColumns({n: F.sum(n).over(upto) + F.col(f"_before_{n}") for n in names})
        .select(*df.columns)
    )


def next_after(events: DataFrame, probes: DataFrame, keys: list[str], at: str, value: str, bits: int = MOMENT_BITS) -> DataFrame:
    """``probes`` with ``value`` of the first of ``events`` of the same keys that is later, NULL where there is none.

    Both sides have the BIGINT ``at``; later means greater. Of events at one moment the least value counts. Keys compare
    as in a join. With a key of very many rows only one row a key and moment is ordered, in blocks of ``2**bits``, and
    then one row a block.
    """
    none = F.lit(None).cast(events.schema[value].dataType)
    probe = F.struct(*probes.columns).alias("_probe")
    rows = settle(
        events.where(_given(*keys, at)).select(*keys, at, value, F.lit(None).cast(probes.schema).alias("_probe"))
        .unionByName(probes.select(*keys, at, none.alias(value), probe)),
        "next-rows",
    )
    if _no_hot_key(rows.where(_given(*keys, at)), keys):
        # Latest first: what lies behind a row in time has gone before it.
        later = Window.partitionBy(*keys).orderBy("_back").rangeBetween(Window.unboundedPreceding, -1)
        first = F.min(F.when(F.col(value).isNotNull(), F.struct(at, value))).over(later)
        told = rows.where(_given(*keys, at)).withColumn("_back", -F.col(at)).withColumn("_first", first)
        found = told.where("_probe IS NOT NULL").select("_probe.*", F.col(f"_first.{value}").alias(value))
        return found.unionByName(rows.where(~_given(*keys, at)).select("_probe.*", none.alias(value)))
    events, probes = rows.where("_probe IS NULL").select(*keys, at, value), rows.where("_probe IS NOT NULL").select("_probe.*")
    marks = events.select(*keys, at, value).unionByName(probes.select(*keys, at, none.alias(value)))
    marks = settle(marks.groupBy(*keys, at).agg(F.min(value).alias(value)).withColumn("_block", F.shiftright(at, bits)), "next-marks")
    following = lambda *by: Window.partitionBy(*by).rowsBetween(1, Window.unboundedFollowing)
    in_block = marks.withColumn("_next", F.first(value, ignorenulls=True).over(following(*keys, "_block").orderBy(at)))
    firsts = marks.groupBy(*keys, "_block").agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(at))).alias("_first"))
    beyond = firsts.withColumn("_beyond", F.first("_first", ignorenulls=True).over(following(*keys).orderBy("_block"))).drop("_first")
    found = in_block.join(beyond, [*keys, "_block"]).select(*keys, at, F.coalesce("_next", "_beyond").alias(value))
    return probes.join(found, [*keys, at], "left").select(*probes.columns, value)


def _moments(rows: DataFrame, keys: list[str], *marks: tuple[str, Column, Column]) -> DataFrame:
    """One row per mark (column of the moment, what opens there, what closes there) of each row."""
    parts = [
        F.struct(F.col(at).alias("_at"), opened.cast("bigint").alias("_opened"), closed.cast("bigint").alias("_closed"))
        for at, opened, closed in marks
    ]
    return rows.select(*keys, F.inline(F.array(*parts)))


def _counts(keys: list[str]) -> dict[str, Column]:
    """What opened up to a row's moment and what closed before it, over the rows of its key in one window."""
    order = Window.partitionBy(*keys).orderBy("_at")
    through = F.sum("_opened").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.sum("_closed").over(order.rangeBetween(Window.unboundedPreceding, -1))
    return {"_starts_through": F.coalesce(through, F.lit(0)), "_ends_before": F.coalesce(before, F.lit(0))}


def _per_moment(marks: DataFrame, keys: list[str]) -> DataFrame:
    return marks.groupBy(*keys, "_at").agg(F.sum("_opened").alias("_opened"), F.sum("_closed").alias("_closed"))


def interval_hits(
    intervals: DataFrame, probes: DataFrame, keys: list[str], start: str, end: str, out: str = "hits"
) -> DataFrame:
    """``probes`` with the number of ``intervals`` of the same keys that each one touches.

    Both sides carry closed BIGINT ranges ``[start, end]`` with start <= end. A range misses the probe
    if it ends before the probe starts, or starts after the probe ends; so the hits are the starts up to
    the probe's end less the ends before the probe's start. Two running counts give that without
    pairing any rows. With a key of very many rows only one row per key and moment enters them.
    """
    one, none = F.lit(1), F.lit(0)
    given = _given(*keys, start, end)
    rows = settle(
        intervals.where(_given(*keys)).select(*keys, start, end, F.lit(None).cast(probes.schema).alias("_probe"))
        .unionByName(probes.where(given).select(*keys, start, end, F.struct(*probes.columns).alias("_probe"))),
        "hit-rows",
    )
    if _no_hot_key(rows, keys, WHOLE_ROWS // 2):
        asked = F.col("_probe").isNotNull()
        lent = (~asked).cast("bigint")
        mark = lambda at, opened, closed, role: F.struct(
            F.col(at).alias("_at"), opened.alias("_opened"), closed.alias("_closed"), F.when(asked, F.lit(role)).alias("_role")
        )
        zero = F.lit(0).cast("bigint")
        marks = rows.select(*keys, "_probe", F.inline(F.array(mark(start, lent, zero, 0), mark(end, zero, lent, 1)))).where("_at IS NOT NULL")
        seen = marks.withColumns(_counts(keys)).where("_role IS NOT NULL")
        # Both marks of a probe lie with its key, so that they meet without another shuffle.
        part = F.when(F.col("_role") == 1, F.col("_starts_through")).otherwise(-F.col("_ends_before"))
        met = seen.groupBy(*keys, "_probe").agg(F.sum(part).alias("_hits"), F.sum("_role").cast("int").alias("_times"))
        return met.select(F.inline(F.array_repeat("_probe", F.col("_times"))), F.expr("_hits div _times").alias(out))
    intervals, probes = rows.where("_probe IS NULL").select(*keys, start, end), rows.where("_probe IS NOT NULL").select("_probe.*")
    marks = _moments(intervals, keys, (start, one, none), (end, none, one)).unionByName(
        _moments(probes, keys, (start, none, none), (end, none, none))
    )
    counted = running_sums(
        settle(_per_moment(marks, keys), "moments"),
        keys,
        "_at",
        {"_starts_through": F.col("_opened"), "_ends_through": F.col("_closed")},
        MOMENT_BITS,
    ).withColumn("_ends_before", F.col("_ends_through") - F.col("_closed"))
    at_start = counted.select(*keys, F.col("_at").alias(start), "_ends_before")
    at_end = counted.select(*keys, F.col("_at").alias(end), "_starts_through")
    return (
        probes.join(at_start, [*keys, start])
        .join(at_end, [*keys, end])
        .withColumn(out, F.col("_starts_through") - F.col("_ends_before"))
        .select(*probes.columns, out)
    )


def start_hits(df: DataFrame, keys: list[str], start: str, end: str, counts: str, out: str = "hits") -> DataFrame:
    """``df`` with the number of its ranges, of the same keys, that contain the row's own start.

    Only rows where the BOOLEAN ``counts`` holds lend their range, itself included; those have
    start <= end. Starts are required, ends only of rows that count.
    """
    lends = F.col(counts).cast("bigint")
    df = settle(df.where(_given(*keys, start)), "trips")
    if _no_hot_key(df, keys, WHOLE_ROWS // 2):
        zero, row = F.lit(0).cast("bigint"), F.struct(*df.columns)
        opens = F.struct(F.col(start).alias("_at"), lends.alias("_opened"), zero.alias("_closed"), row.alias("_row"))
        closes = F.struct(F.col(end).alias("_at"), zero.alias("_opened"), lends.alias("_closed"), F.lit(None).cast(df.schema).alias("_row"))
        # A row that lends nothing has no end to count.
        ends = F.when(F.col(counts), closes)
        held = [F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)]
        marks = df.select(*held, F.inline(F.array_compact(F.array(opens, ends)))).where("_at IS NOT NULL")
        seen = marks.withColumns(_counts([f"_key{i}" for i in range(len(keys))])).where("_row IS NOT NULL")
        return seen.select("_row.*", (F.col("_starts_through") - F.col("_ends_before")).alias(out))
    marks = _moments(df, keys, (start, lends, F.lit(0)), (end, F.lit(0), lends)).where(F.col("_at").isNotNull())
    counted = running_sums(
        _per_moment(marks, keys), keys, "_at", {"_starts": F.col("_opened"), "_ends": F.col("_closed")}, MOMENT_BITS
    ).select(*keys, F.col("_at").alias(start), (F.col("_starts") - F.col("_ends") + F.col("_closed")).alias(out))
    return df.join(counted, [*keys, start]).select(*df.columns, out)


#: Dyadic tree nodes of a row whose start has rank ``_p`` and whose end has rank ``_q``. A node is
#: (level, position) and covers 2**level ranks. ``_cover`` are the largest nodes that together make up
#: [_p, _q]; ``_above`` are all nodes that contain _p.
_FIRST = "shiftright(_p + shiftleft(1L, k) - 1L, k)"
_STOP = "shiftright(_q + 1L, k)"
_COVER = f"""
    flatten(transform(sequence(0, _height), k -> filter(array(
        if({_FIRST} % 2 = 1 and {_FIRST} < {_STOP}, struct(k as level, {_FIRST} as node), null),
        if({_STOP} % 2 = 1 and {_FIRST} < {_STOP}, struct(k as level, {_STOP} - 1L as node), null)
    ), x -> x is not null)))
"""
_ABOVE = "transform(sequence(0, _height), k -> struct(k as level, shiftright(_p, k) as node))"


def _ranked_whole(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Different rows of ``df`` with the ranks of their start (``_p``) and end (``_q``) among the starts of their key, and the
    number of these (``_starts``), from one window a key."""
    mark = lambda at, opens: F.struct(F.col(at).alias("_at"), F.lit(opens).alias("_opens"))
    held = [f"_key{i}" for i in range(len(keys))]
    marks = df.select(
        *[F.col(c).alias(h) for c, h in zip(keys, held)], F.struct(*df.columns).alias("_row"), F.inline(F.array(mark(start, 1), mark(end, 0)))
    )
    # A moment counts once, however many rows start there.
    again = F.row_number().over(Window.partitionBy(*held, "_at", "_opens").orderBy("_opens"))
    first = marks.withColumn("_first", ((F.col("_opens") == 1) & (again == 1)).cast("bigint"))
    upto = Window.partitionBy(*held).orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    told = first.withColumns({"_rank": F.sum("_first").over(upto), "_starts": F.sum("_first").over(Window.partitionBy(*held))})
    of = lambda opens: F.max(F.when(F.col("_opens") == opens, F.col("_rank")))
    return (
        told.groupBy(*held, "_row")
        .agg(of(1).alias("_p"), of(0).alias("_q"), F.max("_starts").alias("_starts"))
        .select("_row.*", "_p", "_q", "_starts")
    )


def _ranked_in_blocks(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The same where a key has very many rows."""
    one, none = F.lit(1), F.lit(0)
    marks = (
        _moments(df, keys, (start, one, none), (end, none, none))
        .groupBy(*keys, "_at")
        .agg(F.max("_opened").alias("_first"))
    )
    # Ranks count from 1; a row's end ranks as the last start at or before it.
    ranks = running_sums(marks, keys, "_at", {"_rank": F.col("_first")}, MOMENT_BITS)
    tops = marks.groupBy(*keys).agg(F.sum("_first").alias("_starts"))
    return (
        df.join(ranks.select(*keys, F.col("_at").alias(start), F.col("_rank").alias("_p")), [*keys, start])
        .join(ranks.select(*keys, F.col("_at").alias(end), F.col("_rank").alias("_q")), [*keys, end])
        .join(tops, keys)
    )


def least_overlapping(
    df: DataFrame, keys: list[str], start: str, end: str, value: str, identity: list[str], out: str = "least"
) -> DataFrame:
    """``identity`` columns with the least ``value`` among the rows of the same keys whose closed range
    touches the row's own, itself included.

    Starts are ranked per key. Two ranges touch exactly when one contains the start of the other, so
    each row is laid on a dyadic tree over the ranks twice: as the few nodes its range is made of, and
    as the nodes above its start. Minima per node, met on equal nodes, give the answer in n log n rows;
    rows are never paired with each other.
    """
    df = df.where(_given(*keys, start, end))
    needed = [*keys, *[c for c in dict.fromkeys([*identity, start, end, value]) if c not in keys]]
    if _no_hot_key(df, keys, WHOLE_ROWS // 2):
        ranked = _ranked_whole(df.select(*needed), keys, start, end)
    else:
        ranked = _ranked_in_blocks(df.select(*needed), keys, start, end)
    ranked = settle(ranked.withColumn("_height", F.ceil(F.log2(F.col("_starts") + 1)).cast("int")), "ranked")
    names = [*keys, *[c for c in identity if c not in keys]]

    def laid(nodes: str, role: int) -> Column:
        return F.transform(F.expr(nodes), lambda n: F.struct(n["level"].alias("level"), n["node"].alias("node"), F.lit(role).alias("role")))

    # Role 0 is a range's cover, role 1 the nodes above its start.
    rows = ranked.select(*names, F.col(value).alias("_value"), F.explode(F.concat(laid(_COVER, 0), laid(_ABOVE, 1))).alias("_n")).select(
        *names, "_value", "_n.level", "_n.node", "_n.role"
    )
    per_node = rows.groupBy(*keys, "level", "node", "role").agg(F.min("_value").alias("_least"))
    opposite = per_node.withColumn("role", F.lit(1) - F.col("role"))
    return (
        rows.join(opposite, [*keys, "level", "node", "role"])
        .groupBy(*names)
        .agg(F.min("_least").alias(out))
    )
