"""Grouped audits. Every group is reduced on the map side before it is shuffled or joined."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxledger.operators.joins import BOOKING, scalar_count_join

#: Most baggage items one booking may have.
MAX_ITEMS = 3


def flight_load(t: Mapping[str, DataFrame]) -> DataFrame:
    """Booked flights with their capacity and number of bookings."""
    counts = t["passagier_voor_vlucht"].groupBy("vluchtnummer").agg(F.count("*").alias("n_bookings"))
    return counts.join(t["vlucht"].select("vluchtnummer", "max_aantal_psgrs"), "vluchtnummer").select(
        "vluchtnummer", "max_aantal_psgrs", "n_bookings"
    )


def baggage_totals(t: Mapping[str, DataFrame]) -> DataFrame:
    """Number and weight of items per booking."""
    return (
        t["object"]
        .groupBy(*BOOKING)
        .agg(F.count("*").alias("n_items"), F.sum("gewicht").cast("bigint").alias("total_weight"))
    )


def baggage_over_count(t: Mapping[str, DataFrame]) -> DataFrame:
    """Bookings with too many items."""
    return (
        t["object"].groupBy(*BOOKING).agg(F.count("*").alias("n_items")).where(F.col("n_items") > MAX_ITEMS)
    )


def baggage_over_weight(t: Mapping[str, DataFrame]) -> DataFrame:
    """Bookings whose baggage is heavier than their flight allows per person."""
    return (
        _totals_with_limit(t, "inner")
        .where(F.col("total_weight") > F.col("max_ppgewicht"))
        .select(*BOOKING, "max_ppgewicht", "total_weight")
    )


def baggage_limit_combined(t: Mapping[str, DataFrame]) -> DataFrame:
    """Bookings over the item count or over the weight, with both figures. Of an unknown flight only the
    item count is known."""
    too_many = F.col("n_items") > MAX_ITEMS
    too_heavy = F.coalesce(F.col("total_weight") > F.col("max_ppgewicht"), F.lit(False))
    return (
        _totals_with_limit(t, "left")
        .select(
            *BOOKING, "n_items", "total_weight", "max_ppgewicht", too_many.alias("too_many"), too_heavy.alias("too_heavy")
        )
        .where("too_many or too_heavy")
    )


def _totals_with_limit(t: Mapping[str, DataFrame], how: str) -> DataFrame:
    return baggage_totals(t).join(t["vlucht"].select("vluchtnummer", "max_ppgewicht"), "vluchtnummer", how)


def duplicate_seats(t: Mapping[str, DataFrame], with_null: bool = True) -> DataFrame:
    """(flight, seat) pairs held by two or more bookings. ``with_null`` counts missing seats as a seat."""
    bookings = t["passagier_voor_vlucht"]
    if not with_null:
        bookings = bookings.where(F.col("stoel").isNotNull())
    return bookings.groupBy("vluchtnummer", "stoel").agg(F.count("*").alias("n_bookings")).where("n_bookings >= 2")


def desks_per_airline(t: Mapping[str, DataFrame]) -> DataFrame:
    """Airlines with their number of desks."""
    return scalar_count_join(
        t["maatschappij"].select("maatschappijcode", "naam"), t["inchecken_bij_maatschappij"], "maatschappijcode", "n_desks"
    )
