"""A ledger of open violations, kept up from the keys that a change touched.

A ledger is a report of ``audit_all``. After a change of bookings and baggage, what it says about touched bookings,
their flights, their passengers and their items is struck out, and those alone are judged anew.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxledger.operators.joins import BOOKING
from paxledger.plans import audit
from paxledger.plans.admission import near_bookings
from paxledger.session import settle
from paxledger.sources.schema import FOREIGN_KEYS
from paxledger.sources.tables import Tables

_BOOKINGS, _ITEMS = "passagier_voor_vlucht", "object"
FLIGHT, PASSENGER, ITEM = ["vluchtnummer"], ["passagiernummer"], ["volgnummer"]


def _of_table(name: str) -> list[str]:
    """Rules of a table's rows by themselves and of its keys."""
    return [f"pk:{name}", f"not_null:{name}", *[f"fk:{fk.name}" for fk in FOREIGN_KEYS if fk.child == name]]


#: What a change touches, the key columns that tell it, and the rules whose lines it can change.
SCOPES: dict[str, tuple[list[str], list[str]]] = {
    "booking": (BOOKING, ["rule01_pair_null", "rule03_late_checkin", "rule08b_booking_desk", *_of_table(_BOOKINGS)]),
    "flight": (FLIGHT, ["rule04_over_capacity", "rule07_seat_unique"]),
    "passenger": (PASSENGER, ["rule10_overlap"]),
    "owner": (BOOKING, ["rule05_baggage_limit"]),
    "item": (ITEM, _of_table(_ITEMS)),
}


def _mark(parts: list[Column]) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def touched_keys(
    before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], bookings: DataFrame, items: DataFrame
) -> dict[str, DataFrame]:
    """Per scope the keys that a change touched, from the ``bookings`` and ``items`` (volgnummer) that it names. Settled.

    Items of touched bookings count as touched, for they may have lost their booking; owners are the bookings that
    a touched item had before or has after.
    """
    booked = settle(bookings.select(*BOOKING).distinct(), "touched-bookings")
    held = before[_ITEMS].select(*ITEM, *BOOKING).unionByName(after[_ITEMS].select(*ITEM, *BOOKING))
    named = held.join(items.select(*ITEM).distinct(), ITEM, "left_semi")
    carried = held.join(booked, BOOKING, "left_semi")
    return {
        "booking": booked,
        "flight": booked.select(*FLIGHT).distinct(),
        "passenger": booked.select(*PASSENGER).distinct(),
        "owner": settle(named.select(*BOOKING).distinct(), "touched-owners"),
        "item": settle(items.select(*ITEM).unionByName(carried.select(*ITEM)).distinct(), "touched-items"),
    }


def struck_out(ledger: DataFrame, touched: Mapping[str, DataFrame]) -> DataFrame:
    """The lines of ``ledger`` that a change can't have altered."""
    stale = [
        touched[scope].select(F.lit(scope).alias("_scope"), _mark([F.col(c) for c in columns]).alias("_mark"))
        for scope, (columns, _) in SCOPES.items()
    ]
    scope, mark = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (columns, rules) in SCOPES.items():
        mine = F.col("rule").isin(rules)
        scope = F.when(mine, F.lit(name)).otherwise(scope)
        mark = F.when(mine, _mark([F.col("key")[c] for c in columns])).otherwise(mark)
    lines = ledger.withColumns({"_scope": scope, "_mark": mark})
    return lines.join(reduce(DataFrame.unionByName, stale), ["_scope", "_mark"], "left_anti").select(*ledger.columns)


def judged_anew(after: Tables, touched: Mapping[str, DataFrame]) -> DataFrame:
    """Lines about what a change touched. Bookings of touched flights and passengers and touched baggage are read once."""
    near = near_bookings(after[_BOOKINGS], touched["booking"], "ledger-near")
    carried = (
        after[_ITEMS].join(touched["item"].withColumn("_i", F.lit(True)), ITEM, "left").join(touched["owner"].withColumn("_o", F.lit(True)), BOOKING, "left")
    )
    things = settle(carried.where("_i OR _o").select(*after[_ITEMS].columns), "ledger-items")
    items = things.join(touched["item"], ITEM, "left_semi")
    owners = items.select(*BOOKING).distinct()
    of = lambda rows, scope: rows.join(touched[scope], SCOPES[scope][0], "left_semi")
    views = {
        "booking": after.replacing(**{_BOOKINGS: of(near, "booking")}),
        "flight": after.replacing(**{_BOOKINGS: of(near, "flight")}),
        "passenger": after.replacing(**{_BOOKINGS: of(near, "passenger")}),
        "owner": after.replacing(**{_ITEMS: of(things, "owner")}),
        "item": after.replacing(**{_ITEMS: items, _BOOKINGS: after[_BOOKINGS].join(owners, BOOKING, "left_semi")}),
    }
    found = []
    for scope, (_, rules) in SCOPES.items():
        business = audit.rule_reports(views[scope], [r for r in rules if r in audit.BUSINESS_RULES])
        found.extend(business.values())
        for table in (n for n in (_BOOKINGS, _ITEMS) if f"pk:{n}" in rules):
            found.extend([audit.table_reports(views[scope], table), *audit.group_reports(views[scope], [table])])
    return reduce(DataFrame.unionByName, found)


def audit_after(
    ledger: DataFrame, before: Mapping[str, DataFrame], after: Tables, bookings: DataFrame, items: DataFrame
) -> DataFrame:
    """The ledger after a change: what ``audit_all(after)`` gives, from ``ledger``, the report of ``before``.

    ``bookings`` has the keys of all bookings added, changed or removed, ``items`` the numbers of all such baggage; other
    tables must be the same. Keys have no nulls.
    """
    touched = touched_keys(before, after, bookings, items)
    return struck_out(ledger, touched).unionByName(judged_anew(after, touched))
