"""Deleting and renaming keys along the foreign keys."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxledger.session import settle
from paxledger.sources.schema import FOREIGN_KEYS, TABLES, children_of
from paxledger.sources.tables import incoming
from paxledger.sources.versions import Edit


@dataclass(frozen=True)
class Change:
    """What becomes of the tables that change, as edits, and the parent keys left alone."""

    edits: list[Edit]
    refused: DataFrame
    before: Mapping[str, DataFrame]

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        """New versions of the tables that change. ``Store.apply`` takes the edits instead, and writes touched files only."""
        return {e.table: e.applied(self.before[e.table]) for e in self.edits}


def delete_cascade(t: Mapping[str, DataFrame], table: str, keys: DataFrame) -> Change:
    """Delete rows of ``table`` by primary key, with their children where the foreign key cascades.

    A key that some child refers to without cascading is refused; the other keys are deleted.
    """
    pk = list(TABLES[table].key)
    wanted = settle(incoming(keys.select(*pk), table).distinct(), "delete-keys")
    barred = [
        _referred(wanted, t[fk.child], dict(zip(fk.parent_columns, fk.columns)))
        for fk in children_of(table)
        if not fk.delete_cascades
    ]
    refused = settle(reduce(DataFrame.unionByName, barred).distinct(), "delete-refused") if barred else wanted.limit(0)
    allowed = settle(wanted.join(refused, pk, "left_anti") if barred else wanted, "delete-allowed")
    edits: list[Edit] = []
    _remove(t, table, allowed, pk, edits)
    return Change(edits, refused, t)


def _referred(keys: DataFrame, child: DataFrame, columns: dict[str, str]) -> DataFrame:
    # A key that very many children refer to is one row by the time it is joined.
    used = child.select(*[F.col(c).alias(p) for p, c in columns.items()]).distinct()
    return keys.join(used, list(columns), "left_semi")


def _remove(t: Mapping[str, DataFrame], table: str, keys: DataFrame, on: list[str], edits: list[Edit]) -> None:
    rows = t[table]
    edits.append(Edit(table, keys, tuple(on), lambda part: part.join(keys, on, "left_anti").select(*part.columns)))
    cascading = [fk for fk in children_of(table) if fk.delete_cascades]
    if not cascading:
        return
    gone = keys if on == list(TABLES[table].key) else rows.join(keys, on, "left_semi").select(*TABLES[table].key)
    for fk in cascading:
        child_keys = gone.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_columns, fk.columns)])
        _remove(t, fk.child, child_keys, list(fk.columns), edits)


def rekey_cascade(t: Mapping[str, DataFrame], table: str, mapping: DataFrame) -> Change:
    """Rename primary keys of ``table`` and carry the new keys into its children, all at once: keys may be swapped.

    ``mapping`` has the key columns and, for each, ``new_<column>``. Refused are keys that some child refers
    to without cascading, keys given two new values, new keys that are wanted twice or lack a part, and new keys
    that a foreign key of the table itself finds no parent for. A new key that exists is fine if its holder is
    renamed too; it is refused if the holder keeps it, for whatever reason.
    """
    pk = list(TABLES[table].key)
    new = [f"new_{c}" for c in pk]
    pairs = settle(incoming(incoming(mapping.select(*pk, *new), table), table, "new_").distinct(), "rekey-pairs")
    twice_old = pairs.groupBy(*pk).agg(F.count("*").alias("_n")).where("_n > 1").select(*pk)
    twice_new = pairs.groupBy(*new).agg(F.count("*").alias("_n")).where("_n > 1").select(*new)
    moving = pairs.where(~reduce(Column.__and__, [F.col(c) == F.col(n) for c, n in zip(pk, new)])).select(*pk).distinct()
    # Keys that stay where they are, whatever becomes of the others.
    staying = t[table].select(*pk).join(moving, pk, "left_anti").select(*[F.col(c).alias(n) for c, n in zip(pk, new)])
    bars = [
        pairs.join(twice_old, pk, "left_semi"),
        pairs.join(twice_new, new, "left_semi"),
        pairs.join(moving, pk, "left_semi").join(staying, new, "left_semi"),
        pairs.where(reduce(Column.__or__, [F.col(c).isNull() for c in new])),
        *[
            pairs.join(
                t[fk.parent].select(*[F.col(p).alias(f"new_{c}") for p, c in zip(fk.parent_columns, fk.columns)]).distinct(),
                [f"new_{c}" for c in fk.columns],
                "left_anti",
            )
            for fk in FOREIGN_KEYS
            if fk.child == table and set(fk.columns) <= set(pk)
        ],
        *[
            _referred(pairs, t[fk.child], dict(zip(fk.parent_columns, fk.columns)))
            for fk in children_of(table)
            if not fk.update_cascades
        ],
    ]
    # Both lists go into every table that changes; they are written once.
    barred = settle(reduce(DataFrame.unionByName, [b.select(*pk) for b in bars]).distinct(), "rekey-barred")
    held = t[table].select(*pk).join(moving, pk, "left_semi")
    refused = _with_followers(pairs.join(moving, pk, "left_semi"), held, barred, pk, new)
    allowed = settle(pairs.join(refused, pk, "left_anti"), "rekey-allowed")
    edits: list[Edit] = []
    _rename(t, table, allowed, dict(zip(pk, new)), edits)
    return Change(edits, refused, t)


def _with_followers(pairs: DataFrame, held: DataFrame, barred: DataFrame, pk: list[str], new: list[str]) -> DataFrame:
    """``barred`` keys and those that want a key which one of them keeps, at once or through any number of others.

    A key that is not barred has one new value, which no other wants: renames form chains and cycles. Each key
    looks one step ahead, then two, four and so on, so that the rounds grow with the logarithm of the longest chain.
    """
    stays = barred.join(held, pk, "left_semi").withColumn("_kept", F.lit(True))
    key = lambda columns: F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)]))
    kept = settle(stays.select(key(pk).alias("_key")).distinct(), "rekey-kept")
    named = lambda keys: keys.select(F.from_json("_key", _key_type(barred, pk)).alias("_k")).select(
        *[F.col(f"_k.k{i}").alias(c) for i, c in enumerate(pk)]
    )
    open_pairs = pairs.join(barred, pk, "left_anti")
    ends = lambda rows: rows.select(key(pk).alias("_from"), key(new).alias("_to"))
    ahead = settle(ends(open_pairs.join(held, pk, "left_semi")), "rekey-ahead")
    lost = barred
    while not kept.isEmpty():
        met = settle(ahead.join(kept, F.col("_to") == F.col("_key"), "left").select("_from", "_to", F.col("_key").isNotNull().alias("_met")), "rekey-met")
        hit = met.where("_met").select(F.col("_from").alias("_key"))
        if hit.isEmpty():
            break
        # Whoever wants a key that was met is met as well; the others look twice as far.
        lost = lost.unionByName(named(hit))
        kept = settle(kept.unionByName(hit), "rekey-kept")
        left = met.where("not _met").select("_from", "_to")
        step = left.select(F.col("_from").alias("_via"), F.col("_to").alias("_next"))
        ahead = settle(left.join(step, F.col("_to") == F.col("_via"), "left").select("_from", F.coalesce("_next", "_to").alias("_to")), "rekey-ahead")
    # Renames of keys that the table doesn't hold keep nothing from anyone.
    absent = ends(open_pairs.join(held, pk, "left_anti")).join(kept, F.col("_to") == F.col("_key"), "left_semi")
    lost = lost.unionByName(named(absent.select(F.col("_from").alias("_key"))))
    return settle(lost.distinct(), "rekey-refused")


def _key_type(rows: DataFrame, pk: list[str]) -> str:
    return ", ".join(f"k{i} {rows.schema[c].dataType.simpleString()}" for i, c in enumerate(pk))


def _rename(t: Mapping[str, DataFrame], table: str, mapping: DataFrame, columns: dict[str, str], edits: list[Edit]) -> None:
    renames = mapping.select(*columns, *columns.values())

    def renamed(rows: DataFrame) -> DataFrame:
        return rows.join(renames, list(columns), "left").select(
            *[F.coalesce(columns[c], c).alias(c) if c in columns else F.col(c) for c in rows.columns]
        )

    edits.append(Edit(table, renames, tuple(columns), renamed))
    for fk in FOREIGN_KEYS:
        touched = [c for c in fk.parent_columns if c in columns]
        if fk.parent == table and fk.update_cascades and touched:
            own = dict(zip(fk.parent_columns, fk.columns))
            child = mapping.select(
                *[F.col(p).alias(own[p]) for p in touched], *[F.col(columns[p]).alias(f"new_{own[p]}") for p in touched]
            )
            _rename(t, fk.child, child, {own[p]: f"new_{own[p]}" for p in touched}, edits)
