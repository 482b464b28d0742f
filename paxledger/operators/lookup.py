"""Desk-clerk lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def passenger_search(
    t: Mapping[str, DataFrame], text: str, desk: int, wildcards: bool = True, ignore_case: bool = False
) -> DataFrame:
    """Passengers whose name contains ``text``, with each flight of theirs that the desk serves.

    The desk is taken from the flight's desk list, not from the booking. With ``wildcards`` the signs
    ``%`` and ``_`` in the text match any run and any sign, as in an unescaped LIKE; without, the text is
    literal. An upper-case insensitive collation is what ``ignore_case`` stands for.
    """
    name = F.col("naam")
    if wildcards:
        # A backslash has no meaning to an unescaped LIKE, but is the escape sign of Spark's.
        pattern = "%" + text.replace("\\", "\\\\") + "%"
        hit = name.ilike(pattern) if ignore_case else name.like(pattern)
    else:
        hit = F.lower(name).contains(text.lower()) if ignore_case else name.contains(text)
    people = t["passagier"].where(hit).select("passagiernummer", "naam")
    served = t["inchecken_voor_vlucht"].where(F.col("balienummer") == desk).select("vluchtnummer", "balienummer")
    return (
        t["passagier_voor_vlucht"]
        .select("passagiernummer", "vluchtnummer")
        .join(people, "passagiernummer")
        .join(served, "vluchtnummer")
        .select("passagiernummer", "naam", "vluchtnummer", "balienummer")
    )


def baggage_of_booking(t: Mapping[str, DataFrame], passenger: int, flight: int) -> DataFrame:
    """Baggage items of one booking."""
    mine = (F.col("passagiernummer") == passenger) & (F.col("vluchtnummer") == flight)
    return t["object"].where(mine).select("volgnummer", "passagiernummer", "vluchtnummer", "gewicht")


def booking_detail(t: Mapping[str, DataFrame], passenger: int, flight: int | None = None) -> DataFrame:
    """A passenger with the booking on ``flight``; without a flight, with every booking of theirs."""
    people = t["passagier"].where(F.col("passagiernummer") == passenger)
    bookings = t["passagier_voor_vlucht"].where(F.col("passagiernummer") == passenger)
    if flight is not None:
        bookings = bookings.where(F.col("vluchtnummer") == flight)
    return people.join(bookings, "passagiernummer").select(
        "passagiernummer", "naam", "geslacht", "geboortedatum", "vluchtnummer", "balienummer", "inchecktijdstip", "stoel"
    )


def bookings_of_flight(t: Mapping[str, DataFrame], flight: int) -> DataFrame:
    """Bookings of one flight, provided the flight exists."""
    flights = t["vlucht"].where(F.col("vluchtnummer") == flight).select("vluchtnummer")
    bookings = t["passagier_voor_vlucht"].where(F.col("vluchtnummer") == flight)
    return bookings.join(flights, "vluchtnummer", "left_semi").select(
        "passagiernummer", "vluchtnummer", "balienummer", "inchecktijdstip", "stoel"
    )
