"""Join shapes the rules are made of.

No side is marked for broadcast: Spark does that by measured size, and re-plans or splits a hot key at
run time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxledger.functions.scalars import micros, or_zero
from paxledger.operators.ordered import start_hits

BOOKING = ["passagiernummer", "vluchtnummer"]


def join_booking_flight(t: Mapping[str, DataFrame]) -> DataFrame:
    """Bookings with their flight's limits and times."""
    flights = t["vlucht"].select("vluchtnummer", "max_aantal_psgrs", "vertrektijdstip", "aankomsttijdstip")
    return t["passagier_voor_vlucht"].join(flights, "vluchtnummer").select(
        *BOOKING, "balienummer", "inchecktijdstip", "stoel", "max_aantal_psgrs", "vertrektijdstip", "aankomsttijdstip"
    )


def join_search_chain(t: Mapping[str, DataFrame]) -> DataFrame:
    """Passengers, their flights, and every desk that serves each flight."""
    return (
        t["passagier_voor_vlucht"]
        .select(*BOOKING)
        .join(t["passagier"].select("passagiernummer", "naam"), "passagiernummer")
        .join(t["inchecken_voor_vlucht"], "vluchtnummer")
        .select("passagiernummer", "naam", "vluchtnummer", "balienummer")
    )


def join_late_checkin(t: Mapping[str, DataFrame]) -> DataFrame:
    """Bookings checked in at or after departure. A missing moment on either side is no match."""
    return _checkin_against_departure(t, F.col("inchecktijdstip") >= F.col("vertrektijdstip"))


def join_timely_checkin(t: Mapping[str, DataFrame]) -> DataFrame:
    """Bookings checked in before departure."""
    return _checkin_against_departure(t, F.col("inchecktijdstip") < F.col("vertrektijdstip"))


def _checkin_against_departure(t: Mapping[str, DataFrame], keep: Column) -> DataFrame:
    bookings = t["passagier_voor_vlucht"].where(F.col("inchecktijdstip").isNotNull())
    flights = t["vlucht"].where(F.col("vertrektijdstip").isNotNull()).select("vluchtnummer", "vertrektijdstip")
    return (
        bookings.select(*BOOKING, "inchecktijdstip")
        .join(flights, "vluchtnummer")
        .where(keep)
        .select(*BOOKING, "inchecktijdstip", "vertrektijdstip")
    )


def semi_flights_with_bookings(t: Mapping[str, DataFrame]) -> DataFrame:
    """Flights that have at least one booking."""
    return t["vlucht"].join(booked_flights(t["passagier_voor_vlucht"]), "vluchtnummer", "left_semi").select(
        "vluchtnummer", "gatecode", "maatschappijcode", "luchthavencode", "vliegtuigtype"
    )


def booked_flights(bookings: DataFrame) -> DataFrame:
    """Flight numbers that occur in bookings, reduced before they are joined to anything."""
    return bookings.select("vluchtnummer").distinct()


def anti_desk_allowed(t: Mapping[str, DataFrame]) -> DataFrame:
    """Desks of a flight that are not permitted for its airline or not for its destination.

    One pass over the desk list with two lookups, each on both of its keys. A desk of an unknown flight
    is permitted by neither.
    """
    flights = t["vlucht"].select("vluchtnummer", "maatschappijcode", "luchthavencode")
    by_airline = t["inchecken_bij_maatschappij"].distinct().withColumn("_airline", F.lit(True))
    by_airport = t["inchecken_voor_bestemming"].distinct().withColumn("_airport", F.lit(True))
    return (
        t["inchecken_voor_vlucht"]
        .join(flights, "vluchtnummer", "left")
        .join(by_airline, ["balienummer", "maatschappijcode"], "left")
        .join(by_airport, ["balienummer", "luchthavencode"], "left")
        .select(
            "balienummer",
            "vluchtnummer",
            F.col("_airline").isNull().alias("not_for_airline"),
            F.col("_airport").isNull().alias("not_for_destination"),
        )
        .where("not_for_airline or not_for_destination")
    )


def anti_desk_of_flight(t: Mapping[str, DataFrame]) -> DataFrame:
    """Bookings whose desk is not in the flight's desk list. No desk is no violation."""
    return (
        t["passagier_voor_vlucht"]
        .where(F.col("balienummer").isNotNull())
        .join(t["inchecken_voor_vlucht"], ["vluchtnummer", "balienummer"], "left_anti")
        .select(*BOOKING, "balienummer")
    )


def interval_overlap(t: Mapping[str, DataFrame]) -> DataFrame:
    """Bookings whose flight departs during another flight of the same passenger.

    Counted per passenger with running sums over moments, so a passenger with very many bookings is
    neither paired up nor held in one task.
    """
    flights = t["vlucht"].where(F.col("vertrektijdstip").isNotNull()).select(
        "vluchtnummer", "vertrektijdstip", "aankomsttijdstip"
    )
    trips = (
        t["passagier_voor_vlucht"]
        .select(*BOOKING)
        .distinct()
        .join(flights, "vluchtnummer")
        .select(
            *BOOKING,
            "vertrektijdstip",
            "aankomsttijdstip",
            micros(F.col("vertrektijdstip")).alias("_from"),
            micros(F.col("aankomsttijdstip")).alias("_to"),
            F.coalesce(F.col("aankomsttijdstip") >= F.col("vertrektijdstip"), F.lit(False)).alias("_lasts"),
        )
    )
    # Only a flight that does not end before it starts can contain a moment; every such one contains its own start.
    return (
        start_hits(trips, ["passagiernummer"], "_from", "_to", counts="_lasts")
        .where(F.col("hits") > F.col("_lasts").cast("int"))
        .select(*BOOKING, "vertrektijdstip", "aankomsttijdstip")
    )


def scalar_count_join(parents: DataFrame, children: DataFrame, key: str, out: str) -> DataFrame:
    """``parents`` with the number of their children, 0 where there are none."""
    counts = children.groupBy(key).agg(F.count("*").alias(out))
    return parents.join(counts, key, "left").withColumn(out, or_zero(F.col(out)))


def global_exists_gate(df: DataFrame, witnesses: DataFrame) -> DataFrame:
    """``df`` if there is any row in ``witnesses``, else nothing. Planned as a scalar subquery."""
    return df.where(witnesses.exists())
