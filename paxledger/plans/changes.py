"""Set-based changes: a batch of changes in, a new table version (and what was refused) out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxledger.functions.scalars import add_days, labels, or_zero
from paxledger.operators.aggregates import MAX_ITEMS, baggage_totals
from paxledger.operators.joins import BOOKING, booked_flights
from paxledger.session import settle
from paxledger.sources.schema import FOREIGN_KEYS, TABLES
from paxledger.sources.tables import incoming, lacks
from paxledger.sources.versions import Edit

#: Total weight given to flights whose places times weight per person exceed their limit.
BACKFILL_TOTAL_WEIGHT = 9000


def last_per_booking(requests: DataFrame) -> DataFrame:
    """The final request per booking. Reduced on the map side, so a booking asked for very often costs
    no more than one row per input split."""
    return (
        requests.groupBy(*BOOKING)
        .agg(F.max_by(F.struct("balienummer", "inchecktijdstip", "stoel"), "seq").alias("_last"))
        .select(*BOOKING, "_last.balienummer", "_last.inchecktijdstip", "_last.stoel")
    )


def upsert_edit(accepted: DataFrame) -> Edit:
    """The accepted requests as a change of the stored bookings."""
    fresh = last_per_booking(accepted)
    return Edit("passagier_voor_vlucht", fresh, tuple(BOOKING), lambda rows: rows.join(fresh, BOOKING, "left_anti"), fresh)


def upsert_bookings(bookings: DataFrame, accepted: DataFrame) -> DataFrame:
    """Bookings after the accepted requests: an existing booking takes over desk, time and seat of its
    last request, a new one is added."""
    fresh = last_per_booking(accepted)
    return bookings.join(fresh, BOOKING, "left_anti").unionByName(fresh)


def add_baggage(t: Mapping[str, DataFrame], items: DataFrame) -> DataFrame:
    """``items`` with ``accepted`` and, where refused, the broken rules.

    Items carry ``seq`` (their order of arrival, unique), booking and weight. They are taken one at a time in
    that order: an item is refused if it would break the item count or the weight limit, and uses nothing up
    then. The next item that a booking can take is the first after its last whose weight fits what is left,
    so as many passes as a booking may have items decide all of them, each a minimum that is reduced before
    the shuffle. An item of no booking, or without a weight, is refused for that.
    """
    limits = t["vlucht"].select("vluchtnummer", "max_ppgewicht")
    known = t["passagier_voor_vlucht"].select(*BOOKING).distinct()
    asked = settle(items.select("seq", *BOOKING, F.col("gewicht").cast("bigint").alias("gewicht")).where("gewicht IS NOT NULL"), "items")
    none: Column = F.array().cast("array<bigint>")
    state = (
        asked.select(*BOOKING)
        .distinct()
        .join(known, BOOKING, "left_semi")
        .join(baggage_totals(t), BOOKING, "left")
        .join(limits, "vluchtnummer", "left")
        .select(
            *BOOKING,
            or_zero(F.col("n_items")).alias("_n"),
            or_zero(F.col("total_weight")).alias("_weight"),
            F.col("max_ppgewicht").alias("_limit"),
            F.lit(-(2**63)).cast("bigint").alias("_last"),
            none.alias("_taken"),
        )
    )
    for step in range(MAX_ITEMS):
        state = settle(state, f"baggage-{step}")
        fits = F.coalesce(F.col("_weight") + F.col("gewicht") <= F.col("_limit"), F.lit(True))
        following = (
            asked.join(state, BOOKING)
            .where((F.col("_n") < MAX_ITEMS) & (F.col("seq") > F.col("_last")) & fits)
            .groupBy(*BOOKING)
            .agg(F.min(F.struct("seq", "gewicht")).alias("_next"))
        )
        got = F.col("_next").isNotNull()
        state = state.join(following, BOOKING, "left").select(
            *BOOKING,
            (F.col("_n") + got.cast("int")).alias("_n"),
            (F.col("_weight") + or_zero(F.col("_next.gewicht"))).alias("_weight"),
            "_limit",
            F.coalesce("_next.seq", F.lit(2**63 - 1)).alias("_last"),
            F.when(got, F.array_append("_taken", F.col("_next.seq"))).otherwise(F.col("_taken")).alias("_taken"),
        )
    taken = settle(state.select(*BOOKING, "_taken"), "baggage-taken")
    lacking = lacks("object", ["gewicht", *BOOKING])
    full = ~lacking & F.col("_taken").isNotNull() & ~F.array_contains("_taken", F.col("seq"))
    return (
        items.join(taken, BOOKING, "left")
        .join(known.withColumn("_booked", F.lit(True)), BOOKING, "left")
        .withColumn("broken", labels(not_null=lacking, fk_booking=F.col("_booked").isNull(), rule05_baggage_limit=full))
        .select(*items.columns, (F.size("broken") == 0).alias("accepted"), "broken")
    )


def remove_baggage(objects: DataFrame, ids: DataFrame) -> DataFrame:
    """Baggage without the items whose ``volgnummer`` is in ``ids``."""
    return objects.join(ids.select("volgnummer").distinct(), "volgnummer", "left_anti").select(*objects.columns)


def remove_baggage_edit(ids: DataFrame) -> Edit:
    """The same as a change of the stored baggage."""
    return Edit("object", ids, ("volgnummer",), lambda rows: remove_baggage(rows, ids))


@dataclass(frozen=True)
class Registration:
    airlines: DataFrame
    desks: DataFrame
    refused: DataFrame


def register_airline(t: Mapping[str, DataFrame], batch: DataFrame) -> Registration:
    """New airlines, each together with its first desk.

    ``batch`` has seq (unique), balienummer, maatschappijcode and naam. The desk must exist; code and name must
    be new. Requests are taken one at a time in order of ``seq``; one that is refused stands in nobody's way.
    In rounds: of the requests still open, the first of both its code and its name is taken, and those that
    share either with one taken are refused, until none is open.
    """
    desks = t["balie"].select("balienummer").distinct().withColumn("_desk", F.lit(True))
    codes = t["maatschappij"].select("maatschappijcode").distinct().withColumn("_code", F.lit(True))
    names = t["maatschappij"].select("naam").distinct().withColumn("_name", F.lit(True))
    asked = incoming(batch, "maatschappij")
    checked = settle(
        asked.join(desks, "balienummer", "left").join(codes, "maatschappijcode", "left").join(names, "naam", "left"), "airlines"
    )
    lacking = lacks("maatschappij", ["maatschappijcode", "naam"]) | F.col("balienummer").isNull()
    old_code, old_name = F.col("_code").isNotNull(), F.col("_name").isNotNull()
    fit = ~lacking & F.col("_desk").isNotNull() & ~old_code & ~old_name
    pending = settle(checked.where(fit).select("seq", "maatschappijcode", "naam"), "airlines-open")
    taken = pending.limit(0)
    while not pending.isEmpty():
        code = pending.groupBy("maatschappijcode").agg(F.min("seq").alias("_of_code"))
        name = pending.groupBy("naam").agg(F.min("seq").alias("_of_name"))
        first = (F.col("seq") == F.col("_of_code")) & (F.col("seq") == F.col("_of_name"))
        won = settle(
            pending.join(code, "maatschappijcode").join(name, "naam").where(first).select(*pending.columns), "airlines-won"
        )
        taken = taken.unionByName(won)
        pending = settle(
            pending.join(won.select("maatschappijcode"), "maatschappijcode", "left_anti").join(won.select("naam"), "naam", "left_anti"),
            "airlines-open",
        )
    by_code = taken.select("maatschappijcode", F.col("seq").alias("_by_code"))
    by_name = taken.select("naam", F.col("seq").alias("_by_name"))
    decided = (
        checked.join(by_code, "maatschappijcode", "left")
        .join(by_name, "naam", "left")
        .withColumn(
            "broken",
            labels(
                not_null=lacking,
                fk_desk=F.col("balienummer").isNotNull() & F.col("_desk").isNull(),
                pk_airline=old_code | F.coalesce(F.col("_by_code") < F.col("seq"), F.lit(False)),
                unique_name=old_name | F.coalesce(F.col("_by_name") < F.col("seq"), F.lit(False)),
            ),
        )
        .select(*batch.columns, "broken")
    )
    decided = settle(decided, "airlines-decided")
    passed = decided.where(F.size("broken") == 0)
    return Registration(
        airlines=passed.select("maatschappijcode", "naam"),
        desks=passed.select("balienummer", "maatschappijcode"),
        refused=decided.where(F.size("broken") > 0),
    )


@dataclass(frozen=True)
class FlightUpdate:
    flights: DataFrame
    refused: DataFrame


def guard_flight_update(
    t: Mapping[str, DataFrame], updates: DataFrame, as_written: bool = False
) -> FlightUpdate:
    """Flights of ``t`` after ``updates``, which hold ``vluchtnummer`` and new values, NULL meaning 'keep'.

    Refused, with the reasons, is an update that would change a booked flight (as written, any update of one),
    give a flight values that no parent table knows, or places and weights beyond the flight's total; and all
    updates of a flight that is given several different ones. Updates of unknown flights touch nothing.
    """
    flights = t["vlucht"]
    changes = [c for c in updates.columns if c != "vluchtnummer"]
    booked = booked_flights(t["passagier_voor_vlucht"]).withColumn("_booked", F.lit(True))
    asked = incoming(updates, "vlucht").distinct()
    several = asked.groupBy("vluchtnummer").agg(F.count("*").alias("_times"))
    renamed = asked.select("vluchtnummer", *[F.col(c).alias(f"_new_{c}") for c in changes]).join(several, "vluchtnummer")
    merged = flights.join(renamed, "vluchtnummer").join(booked, "vluchtnummer", "left")
    differs: Column = F.lit(as_written)
    after = {c: F.col(c) for c in flights.columns}
    for c in changes:
        new = F.coalesce(f"_new_{c}", c)
        after[c] = new
        differs = differs | ~F.col(c).eqNullSafe(new)
    unknown: Column = F.lit(False)
    for fk in FOREIGN_KEYS:
        column = fk.columns[0]
        if fk.child == "vlucht" and column in changes:
            parent = t[fk.parent].select(F.col(fk.parent_columns[0]).alias(f"_new_{column}")).distinct()
            merged = merged.join(parent.withColumn(f"_held_{column}", F.lit(True)), f"_new_{column}", "left")
            unknown = unknown | (F.col(f"_new_{column}").isNotNull() & F.col(f"_held_{column}").isNull())
    worst = after["max_aantal_psgrs"] * after["max_ppgewicht"]
    weighed = any(c in changes for c in ("max_aantal_psgrs", "max_ppgewicht", "max_totaalgewicht"))
    too_heavy = F.coalesce(worst > after["max_totaalgewicht"], F.lit(False)) if weighed else F.lit(False)
    # A flight that is too heavy already may be changed as long as it doesn't get worse.
    was = F.coalesce(F.col("max_aantal_psgrs") * F.col("max_ppgewicht") - F.col("max_totaalgewicht"), F.lit(0))
    worse = too_heavy & (worst - after["max_totaalgewicht"] > F.greatest(was, F.lit(0)))
    reasons = labels(
        pk_flight=F.col("_times") > 1,
        rule02_changed_booked_flights=F.col("_booked").isNotNull() & differs,
        fk_flight=unknown,
        rule06_weight_budget=worse,
    )
    judged = settle(
        merged.select("vluchtnummer", *[after[c].alias(f"_after_{c}") for c in changes], *[f"_new_{c}" for c in changes], reasons.alias("broken")),
        "flight-updates",
    )
    good = judged.where(F.size("broken") == 0).select("vluchtnummer", *[f"_after_{c}" for c in changes], F.lit(True).alias("_good"))
    values = [F.when(F.col("_good"), F.col(f"_after_{c}")).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in flights.columns]
    refused = judged.where(F.size("broken") > 0).select("vluchtnummer", *[F.col(f"_new_{c}").alias(c) for c in changes], "broken")
    return FlightUpdate(flights=flights.join(good, "vluchtnummer", "left").select(*values), refused=refused)


def backfill_flights(flights: DataFrame, as_of: str, as_written: bool = False) -> DataFrame:
    """Flights made fit for the weight rule and for required times.

    Over-budget flights get a larger total weight; a missing departure becomes the day before ``as_of``,
    a missing arrival the day after departure. As written the arrival is filled first, so a flight
    without either keeps no arrival.
    """
    over = F.col("max_aantal_psgrs") * F.col("max_ppgewicht") > F.col("max_totaalgewicht")
    weight = F.when(over, F.lit(BACKFILL_TOTAL_WEIGHT).cast("decimal(5,0)")).otherwise(F.col("max_totaalgewicht"))
    yesterday = add_days(F.to_timestamp_ntz(F.lit(as_of)), -1)
    departure = F.coalesce(F.col("vertrektijdstip"), yesterday)
    start = F.col("vertrektijdstip") if as_written else departure
    arrival = F.coalesce(F.col("aankomsttijdstip"), add_days(start, 1))
    replaced = {"max_totaalgewicht": weight, "vertrektijdstip": departure, "aankomsttijdstip": arrival}
    return flights.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in TABLES["vlucht"].names])
