"""Admitting booking requests against the stored bookings.

Requests have seq (order of arrival, unique in a batch), passagiernummer, vluchtnummer, balienummer,
inchecktijdstip and stoel; a request for a stored booking is an update of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paxledger.functions.scalars import labels, micros, or_zero
from paxledger.operators.aggregates import duplicate_seats, flight_load
from paxledger.operators.joins import BOOKING
from paxledger.operators.graph import linked
from paxledger.operators.ordered import interval_hits, least_overlapping, running_sums
from paxledger.plans import keys, rules
from paxledger.plans.changes import upsert_bookings
from paxledger.session import settle
from paxledger.sources.schema import FOREIGN_KEYS, TABLES
from paxledger.sources.tables import incoming, lacks

REQUEST = ["seq", *BOOKING, "balienummer", "inchecktijdstip", "stoel"]
PASSENGER = ["passagiernummer"]


def _mark(name: str) -> Column:
    return F.lit(True).alias(name)


def row_checks(t: Mapping[str, DataFrame], requests: DataFrame) -> DataFrame:
    """``requests`` with ``broken``: the rules a request breaks by itself.

    Lookups only, so it serves batches and streams alike. The stored tables must hold their primary keys:
    a key stored twice would double the requests that meet it.
    """
    flights = t["vlucht"].select("vluchtnummer", "vertrektijdstip", _mark("_flight"))
    people = t["passagier"].select("passagiernummer", _mark("_person"))
    desks = t["balie"].select("balienummer", _mark("_desk"))
    desk_list = t["inchecken_voor_vlucht"].select("vluchtnummer", "balienummer", _mark("_listed"))
    has_desk = F.col("balienummer").isNotNull()
    return (
        incoming(requests, "passagier_voor_vlucht")
        .join(flights, "vluchtnummer", "left")
        .join(people, "passagiernummer", "left")
        .join(desks, "balienummer", "left")
        .join(desk_list, ["vluchtnummer", "balienummer"], "left")
        .withColumn(
            "broken",
            labels(
                not_null=lacks("passagier_voor_vlucht", BOOKING),
                fk_passagier=F.col("_person").isNull(),
                fk_vlucht=F.col("_flight").isNull(),
                fk_balie=has_desk & F.col("_desk").isNull(),
                rule01_pair_null=F.col("inchecktijdstip").isNull() != F.col("stoel").isNull(),
                rule03_late_checkin=F.coalesce(F.col("inchecktijdstip") >= F.col("vertrektijdstip"), F.lit(False)),
                rule08b_booking_desk=has_desk & F.col("_listed").isNull(),
            ),
        )
        .select(*requests.columns, "broken")
    )


def _clean() -> Column:
    return F.size("broken") == 0


def capacity_cutoff(flights: DataFrame, bookings: DataFrame, asked: DataFrame, newcomers: DataFrame) -> DataFrame:
    """Per flight of ``asked`` the places left (``free``) and the arrival number of the newcomer who takes the
    last of them (``cutoff``, NULL while the flight is not full).

    ``newcomers`` has vluchtnummer and seq, one row per passenger not yet on the flight. Once a flight is
    full it stays full, so this one number decides every request. Newcomers are ranked in blocks of
    arrival numbers, never a whole flight at once.
    """
    numbers = asked.select("vluchtnummer").distinct()
    # Counted first: a full flight is one row by the time it is joined.
    taken = bookings.groupBy("vluchtnummer").agg(F.count("*").alias("_taken"))
    free = (
        flights.select("vluchtnummer", "max_aantal_psgrs")
        .join(numbers, "vluchtnummer", "left_semi")
        .join(taken, "vluchtnummer", "left")
        .select("vluchtnummer", (F.col("max_aantal_psgrs") - or_zero(F.col("_taken"))).alias("free"))
    )
    ranked = running_sums(newcomers.select("vluchtnummer", "seq"), ["vluchtnummer"], "seq", {"_rank": F.lit(1)})
    last = (
        ranked.join(free, "vluchtnummer")
        .where(F.col("_rank") == F.col("free"))
        .select("vluchtnummer", F.col("seq").alias("cutoff"))
    )
    return free.join(last, "vluchtnummer", "left")


def admit_capacity(flights: DataFrame, bookings: DataFrame, requests: DataFrame, as_written: bool = False) -> DataFrame:
    """``requests`` with ``accepted``, as if they came one at a time in order of ``seq`` under the capacity
    rule alone.

    A request of a passenger who is on the flight already needs no place. As written it is refused like
    any other once the flight is full. Requests for unknown flights are refused.
    """
    pairs = (
        requests.groupBy(*BOOKING)
        .agg(F.min("seq").alias("_first"))
        .join(bookings.select(*BOOKING, _mark("_stored")).distinct(), BOOKING, "left")
    )
    newcomers = pairs.where(F.col("_stored").isNull()).select("vluchtnummer", F.col("_first").alias("seq"))
    limits = capacity_cutoff(flights, bookings, requests, newcomers)
    rows = requests.join(limits, "vluchtnummer", "left")
    if as_written:
        decided = rows.withColumn("accepted", _has_place(F.col("seq")))
    else:
        decided = rows.join(pairs, BOOKING, "left").withColumn(
            "accepted", F.col("free").isNotNull() & (F.col("_stored").isNotNull() | _has_place(F.col("_first")))
        )
    return decided.select(*requests.columns, "accepted")


def _has_place(arrival: Column) -> Column:
    in_time = F.col("cutoff").isNull() | (arrival <= F.col("cutoff"))
    return F.coalesce((F.col("free") > 0) & in_time, F.lit(False))


def _spans(pairs: DataFrame, flights: DataFrame) -> DataFrame:
    """Pairs with the time they take, in microseconds; a flight that ends before it starts, or has no end,
    takes its moment of departure. Pairs without a departure drop out: they can meet nothing."""
    start, end = micros(F.col("vertrektijdstip")), micros(F.col("aankomsttijdstip"))
    times = flights.where(F.col("vertrektijdstip").isNotNull()).select(
        "vluchtnummer", start.alias("_from"), F.greatest(start, end).alias("_to")
    )
    return pairs.join(times, "vluchtnummer")


def stored_overlaps(bookings: DataFrame, flights: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (passenger, flight) whose flight meets another stored flight of the passenger."""
    people = pairs.select(*PASSENGER).distinct()
    stored = bookings.select(*BOOKING).join(people, PASSENGER, "left_semi").distinct()
    mine = stored.withColumn("_own", F.lit(1))
    asked = _spans(pairs.select(*BOOKING).join(mine, BOOKING, "left"), flights)
    hits = interval_hits(_spans(stored, flights), asked, PASSENGER, "_from", "_to")
    return hits.where(F.col("hits") > F.coalesce("_own", F.lit(0))).select(*BOOKING)


#: Before every and after every arrival number.
_NEVER, _ALWAYS = 2**62, -(2**62)


def near_bookings(bookings: DataFrame, asked: DataFrame, label: str = "near") -> DataFrame:
    """Stored bookings of the flights and of the passengers that ``asked`` names: all that can speak against it. Settled."""
    flights = asked.select("vluchtnummer").distinct().withColumn("_flight", F.lit(True))
    people = asked.select(*PASSENGER).distinct().withColumn("_person", F.lit(True))
    marked = bookings.join(flights, "vluchtnummer", "left").join(people, PASSENGER, "left")
    return settle(marked.where(F.col("_flight") | F.col("_person")).select(*bookings.columns), label)


def _seat_conflicts(stored: DataFrame, likely: DataFrame, probes: DataFrame) -> DataFrame:
    """(seq, seat_sure, seat_likely) of probes whose seat another passenger holds, surely or likely, when they arrive.

    ``likely`` are requests that are accepted (``_sure``) or may be. A booking holds a seat from the request that
    gave it until its next one: surely until the next likely one, likely until the next sure one. Holdings are
    counted, those of the passenger's own deducted; they are never paired with requests.
    """
    seat = ["vluchtnummer", "stoel"]
    given = stored.select(*BOOKING, "stoel", F.lit(_ALWAYS).alias("seq"), F.lit(True).alias("_sure"))
    events = given.unionByName(likely.select(*BOOKING, "stoel", "seq", "_sure"))
    wanted = probes.where(F.col("stoel").isNotNull())
    claims = events.where(F.col("stoel").isNotNull()).select(*seat, "passagiernummer").unionByName(wanted.select(*seat, "passagiernummer"))
    contested = claims.groupBy(*seat).agg(F.min("passagiernummer").alias("_a"), F.max("passagiernummer").alias("_b"))
    contested = settle(contested.where("_a <> _b").select(*seat), "contested")
    mine = settle(wanted.join(contested, seat, "left_semi").select("seq", *BOOKING, "stoel"), "claims")
    if mine.isEmpty():
        return mine.select("seq", F.lit(False).alias("seat_sure"), F.lit(False).alias("seat_likely")).limit(0)
    holders = events.join(contested, seat, "left_semi").select(*BOOKING).distinct()
    later = Window.partitionBy(*BOOKING).orderBy("seq").rowsBetween(1, Window.unboundedFollowing)
    timed = events.join(holders, BOOKING, "left_semi").select(
        "*",
        F.coalesce(F.min("seq").over(later), F.lit(_NEVER)).alias("_next_likely"),
        F.coalesce(F.min(F.when(F.col("_sure"), F.col("seq"))).over(later), F.lit(_NEVER)).alias("_next_sure"),
    )
    held = timed.where(F.col("stoel").isNotNull()).join(contested, seat, "left_semi")
    # Four counts at once: holdings that are sure and likely, each of all passengers and of one's own.
    kind = lambda sure, own, until: F.when(
        F.col("_sure") | F.lit(not sure),
        F.struct(F.lit(sure).alias("_kind"), (F.col("passagiernummer") if own else F.lit(None).cast("bigint")).alias("_own"), F.col(until).alias("_to")),
    )
    spans = F.array_compact(
        F.array(*[kind(s, o, u) for s, u in ((True, "_next_likely"), (False, "_next_sure")) for o in (False, True)])
    )
    keys = [*seat, "_kind", "_scope"]
    scope = F.coalesce(F.col("_own").cast("string"), F.lit("all"))
    intervals = held.select(*seat, (F.col("seq") + 1).alias("_from"), F.inline(spans)).withColumn("_scope", scope).where("_from <= _to")
    asks = F.array(*[F.struct(F.lit(s).alias("_kind"), o.alias("_own")) for s in (True, False) for o in (F.lit(None).cast("bigint"), F.col("passagiernummer"))])
    probing = mine.select("seq", *seat, F.inline(asks)).withColumn("_scope", scope).select("seq", *keys, "_own", F.col("seq").alias("_from"), F.col("seq").alias("_to"))
    counted = interval_hits(intervals.select(*keys, "_from", "_to"), probing, keys, "_from", "_to")
    others = lambda sure: F.sum(
        F.when(F.col("_kind") == F.lit(sure), F.when(F.col("_own").isNull(), F.col("hits")).otherwise(-F.col("hits"))).otherwise(0)
    ) > 0
    return counted.groupBy("seq").agg(others(True).alias("seat_sure"), others(False).alias("seat_likely"))


def _conflicts(
    flights: DataFrame, stored: DataFrame, likely: DataFrame, probes: DataFrame, some_sure: bool = True, some_open: bool = True
) -> DataFrame:
    """``probes`` with what speaks against each when it arrives, surely (``*_sure``) or likely (``*_likely``).

    ``likely``: requests accepted so far (``_sure``) and those still open. A rule speaks surely if the accepted
    ones alone break it whatever becomes of the open ones, and not even likely if it holds though all of them
    are accepted. For the earliest open request the two are the same. Where there are no accepted ones yet, or no
    open ones any more, half of the work is left out.
    """
    unasked = probes.select(*BOOKING, F.lit(None).cast("bigint").alias("seq"), F.lit(False).alias("_sure"))
    pairs = settle(
        likely.select(*BOOKING, "seq", "_sure")
        .unionByName(unasked)
        .groupBy(*BOOKING)
        .agg(F.min("seq").alias("seq"), F.min(F.when(F.col("_sure"), F.col("seq"))).alias("_sure_seq"))
        .join(stored.select(*BOOKING, _mark("_stored")).distinct(), BOOKING, "left"),
        "pairs",
    )
    fresh = pairs.where(F.col("_stored").isNull())
    several = fresh.groupBy(*PASSENGER).agg(F.count("*").alias("_n")).where("_n > 1").select(*PASSENGER)
    firsts = [F.coalesce("seq", F.lit(_NEVER)).alias("seq"), F.coalesce("_sure_seq", F.lit(_NEVER)).alias("_sure_first")]
    spans = settle(_spans(fresh.select(*BOOKING, *firsts).join(several, PASSENGER, "left_semi"), flights), "spans")
    def met(value: str, out: str) -> DataFrame:
        return least_overlapping(spans, PASSENGER, "_from", "_to", value, BOOKING, out=out)

    def full(newcomers: DataFrame, out: str) -> DataFrame:
        return capacity_cutoff(flights, stored, probes, newcomers).withColumnRenamed("cutoff", out)

    sure = fresh.where(F.col("_sure_seq").isNotNull()).select("vluchtnummer", F.col("_sure_seq").alias("seq"))
    if some_open:
        meets = met("seq", "_met_likely")
        rooms = full(fresh.where("seq IS NOT NULL").select("vluchtnummer", "seq"), "_full_likely")
        if some_sure:
            meets = meets.join(met("_sure_first", "_met_sure"), BOOKING, "left")
            rooms = rooms.join(full(sure, "_full_sure").drop("free"), "vluchtnummer", "left")
        else:
            none = F.lit(None).cast("bigint")
            meets, rooms = meets.withColumn("_met_sure", none), rooms.withColumn("_full_sure", none)
    else:
        meets = met("_sure_first", "_met_sure").withColumn("_met_likely", F.col("_met_sure"))
        rooms = full(sure, "_full_sure").withColumn("_full_likely", F.col("_full_sure"))
    before = lambda c: F.coalesce(F.col(c) < F.col("seq"), F.lit(False))
    there = F.col("_stored").isNotNull()
    rows = (
        probes.join(pairs.select(*BOOKING, "_stored", F.col("seq").alias("_first"), "_sure_seq"), BOOKING, "left")
        .join(meets, BOOKING, "left")
        .join(rooms, "vluchtnummer", "left")
        .join(_seat_conflicts(stored, likely, probes), "seq", "left")
    )
    sure_there, likely_there = there | before("_sure_seq"), there | before("_first")
    out_of_room = lambda cutoff: (F.col("free") <= 0) | before(cutoff)
    return rows.select(
        *probes.columns,
        F.coalesce("seat_sure", F.lit(False)).alias("seat_sure"),
        F.coalesce("seat_likely", F.lit(False)).alias("seat_likely"),
        (~sure_there & before("_met_sure")).alias("overlap_sure"),
        (~sure_there & before("_met_likely")).alias("overlap_likely"),
        (~likely_there & out_of_room("_full_sure")).alias("capacity_sure"),
        (~sure_there & out_of_room("_full_likely")).alias("capacity_likely"),
    )


def _any(kind: str) -> Column:
    return F.col(f"seat_{kind}") | F.col(f"overlap_{kind}") | F.col(f"capacity_{kind}")


#: Requests and bookings of a contest that is decided in one go.
CONTEST_ROWS = 4096

_HELD = "array<struct<p:bigint,f:bigint,s:string,dep:bigint,arr:bigint>>"
_EXTRA = "array<struct<f:bigint,until:bigint>>"
_VERDICTS = "array<struct<seq:bigint,seat_sure:boolean,overlap_sure:boolean,capacity_sure:boolean>>"


def _step(state: Column, e: Column) -> Column:
    """What is held after event ``e``, a booking that is given or a request that is judged."""
    held, extra = state["held"], state["extra"]
    own = lambda h: (h["p"] == e["p"]) & (h["f"] == e["f"])
    there = F.exists(held, own)
    taken = e["s"].isNotNull() & F.exists(held, lambda h: F.coalesce((h["f"] == e["f"]) & (h["s"] == e["s"]) & (h["p"] != e["p"]), F.lit(False)))
    meets = lambda h: (h["p"] == e["p"]) & (h["f"] != e["f"]) & (h["dep"] <= e["arr"]) & (e["dep"] <= h["arr"])
    late = F.exists(held, lambda h: F.coalesce(meets(h), F.lit(False)))
    used = F.size(F.filter(extra, lambda x: (x["f"] == e["f"]) & (x["until"] >= e["seq"])))
    crowded = F.coalesce(e["room"] - used <= 0, F.lit(False))
    seen = F.struct(there.alias("there"), taken.alias("seat"), (~there & late).alias("late"), (~there & crowded).alias("full"))

    def after(v: Column) -> Column:
        bad = e["open"] & (v["seat"] | v["late"] | v["full"])
        mine = F.array(F.struct(e["p"].alias("p"), e["f"].alias("f"), e["s"].alias("s"), e["dep"].alias("dep"), e["arr"].alias("arr")))
        new = F.array(F.struct(e["f"].alias("f"), e["until"].alias("until")))
        told = F.array(F.struct(e["seq"].alias("seq"), v["seat"].alias("seat_sure"), v["late"].alias("overlap_sure"), v["full"].alias("capacity_sure")))
        return F.struct(
            F.when(bad, held).otherwise(F.concat(F.filter(held, lambda h: ~own(h)), mine)).cast(_HELD).alias("held"),
            F.when(e["open"] & ~bad & ~v["there"], F.concat(extra, new)).otherwise(extra).cast(_EXTRA).alias("extra"),
            F.when(e["open"], F.concat(state["out"], told)).otherwise(state["out"]).cast(_VERDICTS).alias("out"),
        )

    # A one-element array, so that what is seen is worked out once.
    return F.element_at(F.transform(F.array(seen), after), 1)


def decide_contests(flights: DataFrame, stored: DataFrame, taken: DataFrame, open_: DataFrame, limit: int = CONTEST_ROWS) -> DataFrame:
    """(seq, seat_sure, overlap_sure, capacity_sure) of the requests ``open_``: what speaks against each when it arrives.

    ``taken`` are requests accepted whatever becomes of the open ones; ``capacity_likely`` marks open ones whose flight
    may be full. Open requests bear on one another through their passenger, a seat that one asks for or has, or a flight
    that may be full. What hangs together is a contest; its requests are taken in order of ``seq`` among the bookings
    of its passengers and seats, in one pass over an array, contests side by side. Those with more than ``limit``
    requests and bookings are left out.
    """
    given = settle(
        stored.select(*BOOKING, "stoel", F.lit(_ALWAYS).alias("seq")).unionByName(taken.select(*BOOKING, "stoel", "seq")), "given"
    )
    full = open_.where("capacity_likely").select("vluchtnummer").distinct()
    seat = lambda: F.to_json(F.struct("vluchtnummer", "stoel"))
    keys_of = [
        open_.select(F.col("seq").alias("node"), F.concat(F.lit("p"), F.col("passagiernummer").cast("string")).alias("key")),
        open_.join(full, "vluchtnummer", "left_semi").select(F.col("seq").alias("node"), F.concat(F.lit("f"), F.col("vluchtnummer").cast("string")).alias("key")),
        open_.where("stoel IS NOT NULL").select(F.col("seq").alias("node"), seat().alias("key")),
        open_.select(F.col("seq").alias("node"), *BOOKING)
        .join(given.where("stoel IS NOT NULL").select(*BOOKING, "stoel"), BOOKING)
        .select("node", seat().alias("key")),
    ]
    contest = linked(reduce(DataFrame.unionByName, keys_of)).select(F.col("node").alias("seq"), F.col("component").alias("contest"))

    first = taken.groupBy(*BOOKING).agg(F.min("seq").alias("_until"))
    new = first.join(stored.select(*BOOKING).distinct(), BOOKING, "left_anti").select("vluchtnummer", F.col("_until").alias("seq"), F.lit(1).alias("_new"))
    arriving = open_.join(full, "vluchtnummer", "left_semi").select("vluchtnummer", "seq", F.lit(0).alias("_new"))
    counted = running_sums(
        new.join(full, "vluchtnummer", "left_semi").unionByName(arriving), ["vluchtnummer"], "seq", {"_before": F.col("_new")}
    ).where("_new = 0")
    places = flights.select("vluchtnummer", "max_aantal_psgrs").join(full, "vluchtnummer", "left_semi")
    there = stored.join(full, "vluchtnummer", "left_semi").groupBy("vluchtnummer").agg(F.count("*").alias("_there"))
    room = F.col("max_aantal_psgrs") - or_zero(F.col("_there")) - F.col("_before")
    rooms = counted.join(places, "vluchtnummer").join(there, "vluchtnummer", "left").select("seq", room.cast("bigint").alias("room"))
    nodes = settle(
        open_.select("seq", *BOOKING, "stoel")
        .join(contest, "seq")
        .join(rooms, "seq", "left")
        .join(first, BOOKING, "left")
        .select("contest", "seq", *BOOKING, "stoel", F.lit(True).alias("open"), "room", F.coalesce("_until", F.lit(_NEVER)).alias("until")),
        "contest-nodes",
    )

    of_people = nodes.select("contest", *PASSENGER).distinct().join(given, PASSENGER)
    asked = nodes.where("stoel IS NOT NULL").select("contest", "vluchtnummer", "stoel").distinct()
    holders = asked.join(given, ["vluchtnummer", "stoel"]).select("contest", *BOOKING).distinct()
    columns = ["contest", "seq", *BOOKING, "stoel"]
    context = of_people.select(*columns).unionByName(holders.join(given, BOOKING).select(*columns)).distinct()
    none = F.lit(None).cast("bigint")
    events = nodes.unionByName(context.select(*columns, F.lit(False).alias("open"), none.alias("room"), none.alias("until")))
    start, end = micros(F.col("vertrektijdstip")), micros(F.col("aankomsttijdstip"))
    times = flights.select("vluchtnummer", start.alias("dep"), F.greatest(start, end).alias("arr"))
    event = F.struct(
        F.col("seq"), F.col("passagiernummer").alias("p"), F.col("vluchtnummer").alias("f"), F.col("stoel").alias("s"), "dep", "arr", "open", "room", "until"
    )
    events = settle(events.join(times, "vluchtnummer", "left").select("contest", event.alias("e")), "contest-events")
    small = events.groupBy("contest").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= limit).select("contest")
    gathered = events.join(small, "contest", "left_semi").groupBy("contest").agg(F.array_sort(F.collect_list("e")).alias("events"))
    zero = F.struct(*[F.array().cast(kind).alias(name) for name, kind in (("held", _HELD), ("extra", _EXTRA), ("out", _VERDICTS))])
    verdicts = F.aggregate("events", zero, _step, lambda state: state["out"])
    return settle(gathered.select(F.inline(verdicts)), "contest-verdicts")


def admit_rows(t: Mapping[str, DataFrame], requests: DataFrame, limit: int = CONTEST_ROWS) -> DataFrame:
    """``requests`` with ``accepted`` and ``broken``, the rules that speak against a refused one when it arrives.

    The outcome is that of taking requests one at a time in order of ``seq``: a refused one stands in nobody's
    way, and an accepted update gives up the seat that the booking had. What no request that may be accepted opposes
    is accepted, what an accepted one surely opposes is refused; the others bear on one another, and are decided
    contest by contest (``decide_contests``), however long they wait for one another. Only contests of more than
    ``limit`` rows are taken up again among what is decided by then; each turn decides the earliest of them at least.
    """
    flights = t["vlucht"]
    checked = settle(row_checks(t, incoming(requests.select(*REQUEST), "passagier_voor_vlucht")), "checked")
    clean = checked.where(_clean())
    stored = near_bookings(t["passagier_voor_vlucht"], clean)
    mine = clean.select(*BOOKING).distinct()
    against = settle(stored_overlaps(stored, flights, mine).withColumn("_meets", F.lit(True)), "meets-stored")
    rows = settle(clean.select("seq", *BOOKING, "stoel").join(against, BOOKING, "left"), "clean")
    pending = rows.where(F.col("_meets").isNull()).select("seq", *BOOKING, "stoel")
    taken = pending.limit(0)
    begun = False
    while not pending.isEmpty():
        likely = taken.withColumn("_sure", F.lit(True)).unionByName(pending.withColumn("_sure", F.lit(False)))
        judged = settle(_conflicts(flights, stored, likely, pending, some_sure=begun), "judged")
        taken = settle(taken.unionByName(judged.where(~_any("likely")).select(*pending.columns)), "taken")
        left = settle(judged.where(_any("likely") & ~_any("sure")).select(*pending.columns, "capacity_likely"), "open")
        if left.isEmpty():
            break
        decided = decide_contests(flights, stored, taken, left, limit)
        won = decided.where(~_any("sure")).select("seq")
        taken = settle(taken.unionByName(left.join(won, "seq", "left_semi").select(*pending.columns)), "taken")
        pending = settle(left.join(decided, "seq", "left_anti").select(*pending.columns), "open")
        begun = True
    refused = rows.join(taken.select("seq"), "seq", "left_anti")
    final = _conflicts(flights, stored, taken.withColumn("_sure", F.lit(True)), refused, some_open=False)
    verdicts = final.select(
        "seq",
        labels(
            rule07_seat_unique=F.col("seat_sure"),
            rule10_overlap=F.col("overlap_sure") | F.col("_meets").isNotNull(),
            rule04_over_capacity=F.col("capacity_sure"),
        ).alias("_later"),
    )
    none = F.array().cast("array<string>")
    return (
        checked.join(verdicts, "seq", "left")
        .withColumn("broken", F.when(_clean(), F.coalesce("_later", none)).otherwise(F.col("broken")))
        .select(*REQUEST, _clean().alias("accepted"), "broken")
    )


@dataclass(frozen=True)
class Statement:
    """``accepted`` is the whole batch or nothing; ``violations`` has rule, passagiernummer, vluchtnummer."""

    accepted: DataFrame
    violations: DataFrame


def _orphans(column: str, parent: str) -> Callable[[Mapping[str, DataFrame], DataFrame], DataFrame]:
    return lambda t, touched: keys.fk_orphans(touched, t[parent], [column])


def _of_booking(check: Callable[..., DataFrame]) -> Callable[[Mapping[str, DataFrame], DataFrame], DataFrame]:
    """The rule on the touched bookings alone; it looks at no other booking."""
    return lambda t, touched: check(t.replacing(passagier_voor_vlucht=touched))


def _over_capacity(t: Mapping[str, DataFrame], touched: DataFrame) -> DataFrame:
    full = flight_load(t).where(F.col("n_bookings") > F.col("max_aantal_psgrs"))
    return touched.join(full, "vluchtnummer", "left_semi")


def _shared_seats(t: Mapping[str, DataFrame], touched: DataFrame) -> DataFrame:
    seat = ["vluchtnummer", "stoel"]
    near = t["passagier_voor_vlucht"].join(touched.select(*seat).distinct(), seat, "left_semi")
    return touched.join(duplicate_seats(t.replacing(passagier_voor_vlucht=near), with_null=False), seat, "left_semi")


def _overlapping(t: Mapping[str, DataFrame], touched: DataFrame) -> DataFrame:
    return stored_overlaps(t["passagier_voor_vlucht"], t["vlucht"], touched)


#: Rules of a statement: each gets the tables as they would be after it and the bookings it touched.
STATEMENT_RULES: dict[str, Callable[[Mapping[str, DataFrame], DataFrame], DataFrame]] = {
    "fk_passagier": _orphans("passagiernummer", "passagier"),
    "fk_vlucht": _orphans("vluchtnummer", "vlucht"),
    "fk_balie": _orphans("balienummer", "balie"),
    "not_null": lambda t, touched: touched.where(lacks("passagier_voor_vlucht", BOOKING)),
    "rule01_pair_null": _of_booking(rules.rule01_pair_null),
    "rule03_late_checkin": _of_booking(rules.rule03_late_checkin),
    "rule04_over_capacity": _over_capacity,
    "rule07_seat_unique": _shared_seats,
    "rule08b_booking_desk": _of_booking(rules.rule08b_booking_desk),
    "rule10_overlap": _overlapping,
}

#: What the row triggers do as written: see the rules of the same name. Rule 7 looks at the whole table then.
STATEMENT_RULES_AS_WRITTEN: dict[str, Callable[[Mapping[str, DataFrame], DataFrame], DataFrame]] = {
    **STATEMENT_RULES,
    "rule07_seat_unique": lambda t, touched: touched.where(F.col("stoel").isNotNull()).where(
        duplicate_seats(t.replacing(passagier_voor_vlucht=t["_all_bookings"]), with_null=True).exists()
    ),
    "rule08b_booking_desk": _of_booking(lambda t: rules.rule08b_booking_desk(t, as_written=True)),
    "rule10_overlap": lambda t, touched: rules.rule10_overlap(t).join(touched, BOOKING, "left_semi"),
}


def admit_statement(
    t: Mapping[str, DataFrame], batch: DataFrame, names: list[str] | None = None, as_written: bool = False
) -> Statement:
    """Take the whole batch if the stored bookings with it break none of the rules, else nothing.

    Only what the batch touches is judged: stored violations elsewhere do not stop it.
    """
    checks = STATEMENT_RULES_AS_WRITTEN if as_written else STATEMENT_RULES
    batch = incoming(batch, "passagier_voor_vlucht")
    # What the batch can break lies in the bookings of its flights and passengers; no more is written down.
    near = near_bookings(t["passagier_voor_vlucht"], batch)
    after = settle(upsert_bookings(near, batch), "after")
    touched = settle(after.join(batch.select(*BOOKING).distinct(), BOOKING, "left_semi"), "touched")
    everything = upsert_bookings(t["passagier_voor_vlucht"], batch)
    state = t.replacing(passagier_voor_vlucht=after, _all_bookings=everything)
    found = [
        checks[name](state, touched).select(F.lit(name).alias("rule"), *BOOKING) for name in (names or list(checks))
    ]
    return _judged(batch, found)


def _keyed(rows: DataFrame, table: str, rule: str) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), *TABLES[table].key)


def _row_violations(t: Mapping[str, DataFrame], table: str, batch: DataFrame) -> list[DataFrame]:
    """What a batch of whole rows of ``table`` breaks by itself: NOT NULL, its keys, its foreign keys."""
    key = list(TABLES[table].key)
    twice = batch.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    found = [_keyed(batch.where(lacks(table, batch.columns)), table, "not_null"), _keyed(twice, table, "pk")]
    for fk in FOREIGN_KEYS:
        if fk.child == table:
            orphans = keys.fk_orphans(batch, t[fk.parent], list(fk.columns), list(fk.parent_columns))
            found.append(_keyed(orphans, table, f"fk_{fk.parent}"))
    return found


def _judged(batch: DataFrame, found: list[DataFrame]) -> Statement:
    violations = settle(reduce(DataFrame.unionByName, found), "violations")
    return Statement(accepted=batch.where(~violations.exists()), violations=violations)


def admit_desks(t: Mapping[str, DataFrame], batch: DataFrame) -> Statement:
    """Desks of flights (rows of ``inchecken_voor_vlucht``), new or changed, taken whole or not at all.

    A desk must be one of the flight's airline and of its destination (rule 8a). A row that is stored already
    is judged like any other and taken once. ``violations`` has rule, balienummer, vluchtnummer.
    """
    table = "inchecken_voor_vlucht"
    rows = settle(incoming(batch.select(*TABLES[table].names), table), "desks")
    barred = rules.rule08a_desk_allowed(t.replacing(inchecken_voor_vlucht=rows.distinct()))
    return _judged(rows, [*_row_violations(t, table, rows), _keyed(barred, table, "rule08a_desk_allowed")])


def admit_flights(t: Mapping[str, DataFrame], batch: DataFrame) -> Statement:
    """Flights as whole rows, new ones and new values of stored ones, taken whole or not at all.

    Booked flights keep their values (rule 2), and places times weight per person stays within the total (rule 6).
    ``violations`` has rule and vluchtnummer.
    """
    table = "vlucht"
    rows = settle(incoming(batch.select(*TABLES[table].names), table), "flights")
    stored = t[table].join(rows.select("vluchtnummer").distinct(), "vluchtnummer", "left_semi")
    changed = rules.rule02_changed_booked_flights(stored, rows, t["passagier_voor_vlucht"])
    heavy = rules.rule06_weight_budget(t.replacing(vlucht=rows))
    return _judged(
        rows,
        [
            *_row_violations(t, table, rows),
            _keyed(changed, table, "rule02_changed_booked_flights"),
            _keyed(heavy, table, "rule06_weight_budget"),
        ],
    )


def _stored_too(t: Mapping[str, DataFrame], table: str, rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose values of ``columns`` a stored row has. Stored rows are cut to those of the batch first."""
    held = t[table].join(rows.select(*columns).distinct(), columns, "left_semi").select(*columns).distinct()
    return rows.join(held, columns, "left_semi")


def admit_table(t: Mapping[str, DataFrame], table: str, batch: DataFrame) -> Statement:
    """New rows of any table as one statement that inserts them, taken whole or not at all.

    Refused are a missing required value (``not_null``), a key that is stored or comes twice (``pk``), an alternate key
    that is stored or comes twice (``unique_<column>``) and unknown parents (``fk_<parent>``). Missing values break
    ``not_null`` only. ``violations`` has the rule and the key of each row that breaks it, once for each rule. For tables
    with rules of their own (bookings, baggage, flights, their desks, airlines with desks) these judge on top of it.
    """
    spec = TABLES[table]
    key = list(spec.key)
    rows = settle(incoming(batch.select(*spec.names), table), table)
    complete = rows.where(~lacks(table, key))
    found = [*_row_violations(t, table, rows), _keyed(_stored_too(t, table, complete, key), table, "pk")]
    for column in spec.unique:
        twice = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n")).where("_n > 1")
        shared = rows.join(twice, column, "left_semi").unionByName(_stored_too(t, table, rows, [column]))
        found.append(_keyed(shared, table, f"unique_{column}"))
    return _judged(rows, [reduce(DataFrame.unionByName, found).distinct()])
