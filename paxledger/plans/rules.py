"""The ten business rules. Each function returns the violating rows.

The rule text is the default. ``as_written`` reproduces the enforcing or auditing statement where that
does something else than its text says.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxledger.operators.aggregates import baggage_limit_combined, duplicate_seats, flight_load
from paxledger.operators.joins import (
    BOOKING,
    anti_desk_allowed,
    anti_desk_of_flight,
    booked_flights,
    global_exists_gate,
    interval_overlap,
    join_late_checkin,
    join_timely_checkin,
)
from paxledger.sources.schema import TABLES


def rule01_pair_null(t: Mapping[str, DataFrame]) -> DataFrame:
    """Check-in time and seat are both known or both unknown."""
    lone = F.col("inchecktijdstip").isNull() != F.col("stoel").isNull()
    return t["passagier_voor_vlucht"].where(lone).select(*TABLES["passagier_voor_vlucht"].names)


def rule02_changed_booked_flights(
    before: DataFrame, after: DataFrame, bookings: DataFrame, as_written: bool = False
) -> DataFrame:
    """Flights changed while they had bookings.

    ``before`` and ``after`` are flight tables; ``changed`` names the columns that differ. As written, any
    flight of ``after`` (the rows an update touched) counts, changed or not.
    """
    if as_written:
        return after.select("vluchtnummer").join(booked_flights(bookings), "vluchtnummer", "left_semi")
    others = [c for c in TABLES["vlucht"].names if c != "vluchtnummer"]
    old = before.select("vluchtnummer", *[F.col(c).alias(f"_old_{c}") for c in others])
    differing = [F.when(~F.col(c).eqNullSafe(F.col(f"_old_{c}")), F.lit(c)) for c in others]
    return (
        after.join(old, "vluchtnummer")
        .select("vluchtnummer", F.concat_ws(",", *differing).alias("changed"))
        .where(F.col("changed") != "")
        .join(booked_flights(bookings), "vluchtnummer", "left_semi")
    )


def rule03_late_checkin(t: Mapping[str, DataFrame], as_written: bool = False) -> DataFrame:
    """Check-in lies before departure. The audit as written lists the rows that comply."""
    return join_timely_checkin(t) if as_written else join_late_checkin(t)


def rule04_over_capacity(t: Mapping[str, DataFrame], as_written: bool = False) -> DataFrame:
    """No flight has more bookings than places. The audit as written lists every booked flight."""
    load = flight_load(t)
    return load if as_written else load.where(F.col("n_bookings") > F.col("max_aantal_psgrs"))


def rule05_baggage_limit(t: Mapping[str, DataFrame]) -> DataFrame:
    """At most three items per booking, and no more weight than the flight allows per person."""
    return baggage_limit_combined(t)


def rule06_weight_budget(t: Mapping[str, DataFrame], as_written: bool = False) -> DataFrame:
    """Places times weight per person fit the flight's total. As written an exact fit is refused too."""
    worst = (F.col("max_aantal_psgrs") * F.col("max_ppgewicht")).cast("decimal(18,2)")
    over = worst >= F.col("max_totaalgewicht") if as_written else worst > F.col("max_totaalgewicht")
    return t["vlucht"].where(over).select(
        "vluchtnummer", "max_aantal_psgrs", "max_ppgewicht", "max_totaalgewicht", worst.alias("worst_weight")
    )


def rule07_seat_unique(t: Mapping[str, DataFrame], as_written: bool = False) -> DataFrame:
    """No seat of a flight is given twice.

    As written every seated booking violates as soon as any flight anywhere has two equal or two missing
    seats.
    """
    if not as_written:
        return duplicate_seats(t, with_null=False)
    seated = t["passagier_voor_vlucht"].where(F.col("stoel").isNotNull()).select(*BOOKING, "stoel")
    return global_exists_gate(seated, duplicate_seats(t, with_null=True))


def rule08a_desk_allowed(t: Mapping[str, DataFrame]) -> DataFrame:
    """Desks of a flight are permitted for its airline and its destination."""
    return anti_desk_allowed(t)


def rule08b_booking_desk(t: Mapping[str, DataFrame], as_written: bool = False) -> DataFrame:
    """Bookings use a desk of their flight.

    As written one valid booking lets all others through, and a missing desk is invalid.
    """
    if not as_written:
        return anti_desk_of_flight(t)
    bookings = t["passagier_voor_vlucht"]
    valid = bookings.join(t["inchecken_voor_vlucht"], ["vluchtnummer", "balienummer"], "left_semi")
    return bookings.where(~valid.exists()).select(*BOOKING, "balienummer")


def rule09_airline_has_desk(t: Mapping[str, DataFrame]) -> DataFrame:
    """Every airline has a desk."""
    served = t["inchecken_bij_maatschappij"].select("maatschappijcode").distinct()
    return t["maatschappij"].join(served, "maatschappijcode", "left_anti").select("maatschappijcode", "naam")


def rule10_overlap(t: Mapping[str, DataFrame]) -> DataFrame:
    """No booking departs during another flight of the same passenger."""
    return interval_overlap(t)
