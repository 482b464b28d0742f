"""Every operator as a query over the driver tables: name -> (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.functions import scalars
from paxledger.operators import aggregates, joins, lookup
from paxledger.plans import admission, audit, cascade, changes, history, keys, ledger, rules
from paxledger.session import settle, work_folder
from paxledger.sources.projection import StarSource, project, project_handled, project_requests
from paxledger.sources.schema import FOREIGN_KEYS, TABLES
from paxledger.sources.tables import Tables, load_tables, scan, scan_desks, write_tables, write_version
from paxledger.sources.versions import Edit, Store
from paxledger.streaming import bookings as stream

Query = Callable[[SparkSession, str], DataFrame]

# Values of lookups, fixed so that the SQL can name them.
SEARCH, DESK, PASSENGER, FLIGHT = "00007", 3, 0, 24
AS_OF, FIRST_CHANGE, BETWEEN, SECOND_CHANGE = (
    "2002-03-01 12:00:00",
    "2002-01-01 00:00:00",
    "2002-01-15 00:00:00",
    "2002-02-01 00:00:00",
)


def _on_tables(function: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, folder: function(project(spark, folder), **options)


def _joined(broken: Column) -> Column:
    return F.array_join(broken, ",")


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _stored(spark: SparkSession, folder: str) -> Tables:
    """The projected tables written to the shared folder and loaded with their declared types."""
    return load_tables(spark, write_tables(project(spark, folder), work_folder(spark, "tables")))


def _key_text(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns or TABLES[table].key]
    return df.select(F.lit(table).alias("table_name"), F.concat_ws("|", *parts).alias("row_key"))


# --- sources and sinks -------------------------------------------------------------------------------


def loaded_tables(spark: SparkSession, folder: str) -> DataFrame:
    t = _stored(spark, folder)
    return _union(t[n].agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n in t)


def written_version(spark: SparkSession, folder: str) -> DataFrame:
    path = write_version(project(spark, folder)["vlucht"], work_folder(spark, "vlucht"), by=["luchthavencode"])
    return spark.read.parquet(path)


def loaded_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of every table, as text."""
    t = _stored(spark, folder)
    return _union(_key_text(t[n], n, TABLES[n].names) for n in t)


def _store(spark: SparkSession, tables: dict[str, DataFrame]) -> Store:
    """Tables as version 0, bookings clustered by flight."""
    store = Store(spark, work_folder(spark, "store"))
    store.create(tables, by={"passagier_voor_vlucht": ["vluchtnummer"]})
    return store


def version_between(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings change twice; asked for are those between the two changes."""
    store = _store(spark, {"passagier_voor_vlucht": project(spark, folder)["passagier_voor_vlucht"]})
    name = "passagier_voor_vlucht"
    people = store.read()[name].select("passagiernummer").distinct()
    moved = people.where("passagiernummer % 17 = 0 OR passagiernummer % 13 = 0")
    store.apply([Edit(name, moved, ("passagiernummer",), _without_every_17th)])
    store.apply([Edit(name, people.where("passagiernummer % 11 = 0"), ("passagiernummer",), _unseated)])
    return store.read(1)[name]


def upserted_files(spark: SparkSession, folder: str) -> DataFrame:
    store = _store(spark, {"passagier_voor_vlucht": project_handled(spark, folder)})
    store.apply([changes.upsert_edit(project_requests(spark, folder))])
    return store.read()["passagier_voor_vlucht"]


def removed_from_files(spark: SparkSession, folder: str) -> DataFrame:
    t = project(spark, folder)
    store = _store(spark, {"object": t["object"]})
    over = rules.rule05_baggage_limit(t).select(*joins.BOOKING)
    store.apply([changes.remove_baggage_edit(t["object"].join(over, joins.BOOKING, "left_semi").select("volgnummer"))])
    return store.read()["object"]


def _after(store: Store, change: cascade.Change, columns: dict[str, list[str]]) -> DataFrame:
    """The tables of a change, read back from the version that it made, and the keys refused."""
    store.apply(change.edits)
    after = store.read()
    parts = [_key_text(after[e.table], e.table, columns.get(e.table)) for e in change.edits]
    return _union([*parts, _key_text(change.refused, "refused", change.refused.columns)])


def deleted_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """Passengers of one market segment go from the stored tables, in one version."""
    t = project(spark, folder)
    store = _store(spark, {n: t[n] for n in ("passagier", "passagier_voor_vlucht", "object")})
    gone = StarSource(spark, folder).raw("customer").where(F.col("c_mktsegment") == "BUILDING")
    keys_gone = gone.select(F.col("c_custkey").alias("passagiernummer"))
    return _after(store, cascade.delete_cascade(store.read(), "passagier", keys_gone), {})


_DESK_COLUMNS = {"passagier_voor_vlucht": [*joins.BOOKING, "balienummer"]}


def _turned(spark: SparkSession, t: Tables) -> DataFrame:
    """Desks 0 to 2, 3 to 5 and so on pass their numbers round."""
    desk = F.col("balienummer")
    return t["balie"].select(desk, (desk - desk % 3 + (desk + 1) % 3).cast("int").alias("new_balienummer"))


def turned_desks(spark: SparkSession, folder: str) -> DataFrame:
    t = project(spark, folder)
    return _remaining(t, cascade.rekey_cascade(t, "balie", _turned(spark, t)), _DESK_COLUMNS)


def turned_in_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same in the stored tables, in one version."""
    t = project(spark, folder)
    names = [fk.child for fk in FOREIGN_KEYS if fk.parent == "balie"]
    store = _store(spark, {n: t[n] for n in ("balie", *names)})
    held = store.read()
    return _after(store, cascade.rekey_cascade(held, "balie", _turned(spark, held)), _DESK_COLUMNS)


# --- scalar functions --------------------------------------------------------------------------------


def scalar_functions(spark: SparkSession, folder: str) -> DataFrame:
    departure, arrival = F.col("vertrektijdstip"), F.col("aankomsttijdstip")
    return project(spark, folder)["vlucht"].select(
        "vluchtnummer",
        scalars.add_days(arrival, 30).alias("month_later"),
        scalars.year_boundaries(departure, scalars.add_days(arrival, 30)).alias("new_years"),
        scalars.or_zero(F.when(F.col("max_aantal_psgrs") > 10, F.col("max_aantal_psgrs"))).alias("large_or_zero"),
        scalars.trim_char(F.concat("gatecode", F.lit("  "))).alias("gate"),
        F.concat("luchthavencode", F.lit("/"), F.col("vluchtnummer").cast("string")).alias("label"),
        scalars.micros(arrival).alias("arrival_micros"),
    )


# --- changes -----------------------------------------------------------------------------------------


def _flight_updates(spark: SparkSession, folder: str) -> DataFrame:
    """New gates for all flights, some of them the old ones, and more places on the small aircraft, too many on some."""
    return StarSource(spark, folder).raw("part").select(
        F.col("p_partkey").alias("vluchtnummer"),
        F.char((F.lit(65) + (F.col("p_partkey") + F.col("p_size")) % 5).cast("int")).alias("gatecode"),
        F.when(F.col("p_size") < 10, F.col("p_size") + 18).alias("max_aantal_psgrs"),
    )


def changed_booked_flights(spark: SparkSession, folder: str, as_written: bool = False) -> DataFrame:
    t = project(spark, folder)
    free = t.replacing(passagier_voor_vlucht=t["passagier_voor_vlucht"].where(F.lit(False)))
    after = changes.guard_flight_update(free, _flight_updates(spark, folder)).flights
    return rules.rule02_changed_booked_flights(t["vlucht"], after, t["passagier_voor_vlucht"], as_written)


def guarded_update(spark: SparkSession, folder: str, as_written: bool = False) -> DataFrame:
    t = project(spark, folder)
    done = changes.guard_flight_update(t, _flight_updates(spark, folder), as_written)
    columns = ["vluchtnummer", "gatecode", "max_aantal_psgrs"]
    return done.flights.select(F.lit("flight").alias("kind"), *columns, F.lit("").alias("broken")).unionByName(
        done.refused.select(F.lit("refused").alias("kind"), *columns, _joined(F.col("broken")).alias("broken"))
    )


def _flights_with_gaps(t: Tables) -> DataFrame:
    """Flights of small aircraft lack a departure, those of the smallest and largest an arrival."""
    size = F.col("max_aantal_psgrs")
    return t["vlucht"].withColumns(
        {
            "vertrektijdstip": F.when(size > 5, F.col("vertrektijdstip")),
            "aankomsttijdstip": F.when((size > 2) & (size < 46), F.col("aankomsttijdstip")),
        }
    )


def backfilled(spark: SparkSession, folder: str, as_written: bool = False) -> DataFrame:
    return changes.backfill_flights(_flights_with_gaps(project(spark, folder)), AS_OF, as_written)


def missing_values(spark: SparkSession, folder: str) -> DataFrame:
    return keys.not_null_violations(_flights_with_gaps(project(spark, folder)), TABLES["vlucht"].required)


def removed_baggage(spark: SparkSession, folder: str) -> DataFrame:
    """Take out all baggage of the bookings over their limit."""
    t = project(spark, folder)
    over = rules.rule05_baggage_limit(t).select(*joins.BOOKING)
    ids = t["object"].join(over, joins.BOOKING, "left_semi").select("volgnummer")
    return changes.remove_baggage(t["object"], ids)


def registered_airlines(spark: SparkSession, folder: str) -> DataFrame:
    """Every supplier asks to become an airline: with known and unknown desks, old and new codes and names."""
    star = StarSource(spark, folder)
    nations = star.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    number = F.col("s_suppkey")
    batch = star.raw("supplier").join(nations, "s_nationkey").select(
        number.alias("seq"),
        (number % 60 + 1).cast("int").alias("balienummer"),
        # Some codes come padded, as fixed-width text does.
        F.concat(F.lpad((number % 40).cast("string"), 2, "0"), F.when(number % 3 == 0, F.lit(" ")).otherwise(F.lit(""))).alias("maatschappijcode"),
        F.when(number % 7 == 0, F.col("n_name"))
        .otherwise(F.concat(F.lit("Air "), (number % 30).cast("string")))
        .alias("naam"),
    )
    done = changes.register_airline(project(spark, folder), batch)
    none = F.lit(None)
    return _union(
        [
            done.airlines.select(
                F.lit("airline").alias("kind"), "maatschappijcode", "naam", none.cast("int").alias("balienummer"), F.lit("").alias("broken")
            ),
            done.desks.select(
                F.lit("desk").alias("kind"), "maatschappijcode", none.cast("string").alias("naam"), "balienummer", F.lit("").alias("broken")
            ),
            done.refused.select(
                F.lit("refused").alias("kind"), "maatschappijcode", "naam", "balienummer", _joined(F.col("broken")).alias("broken")
            ),
        ]
    )


def _baggage_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every numbered line of an order brings an item of its whole quantity; open orders meet bookings not stored."""
    star = StarSource(spark, folder)
    owners = star.requests().select(F.col("seq").alias("l_orderkey"), *joins.BOOKING)
    # Line numbers repeat within an order: those lines are one item.
    lines = star.raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("int").alias("gewicht"))
    arrival = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return lines.join(owners, "l_orderkey").select(arrival.alias("seq"), *joins.BOOKING, "gewicht")


def added_baggage(spark: SparkSession, folder: str) -> DataFrame:
    """Items arrive for the handled bookings, which so far have their lightest items only."""
    t = project(spark, folder)
    handled = project_handled(spark, folder)
    stored = t["object"].where(F.col("gewicht") <= 2)
    done = changes.add_baggage(
        t.replacing(passagier_voor_vlucht=handled, object=stored), _baggage_requests(spark, folder)
    )
    return done.withColumn("broken", _joined(F.col("broken")))


def upserted(spark: SparkSession, folder: str) -> DataFrame:
    return changes.upsert_bookings(project_handled(spark, folder), project_requests(spark, folder))


def _remaining(t: Tables, change: cascade.Change, columns: dict[str, list[str]]) -> DataFrame:
    parts = [_key_text(df, name, columns.get(name)) for name, df in change.tables.items()]
    return _union([*parts, _key_text(change.refused, "refused", change.refused.columns)])


def deleted_passengers(spark: SparkSession, folder: str) -> DataFrame:
    """Passengers of one market segment go, with their bookings and baggage."""
    t = project(spark, folder)
    gone = StarSource(spark, folder).raw("customer").where(F.col("c_mktsegment") == "BUILDING")
    return _remaining(t, cascade.delete_cascade(t, "passagier", gone.select(F.col("c_custkey").alias("passagiernummer"))), {})


def deleted_flights(spark: SparkSession, folder: str) -> DataFrame:
    """All flights are to go; the booked ones are refused."""
    t = project(spark, folder)
    return _remaining(t, cascade.delete_cascade(t, "vlucht", t["vlucht"].select("vluchtnummer")), {})


def renumbered_desks(spark: SparkSession, folder: str) -> DataFrame:
    """All desks get new numbers, here and in the four tables that name them."""
    t = project(spark, folder)
    mapping = t["balie"].select("balienummer", (F.col("balienummer") + 1000).alias("new_balienummer"))
    done = cascade.rekey_cascade(t, "balie", mapping)
    return _remaining(t, done, {"passagier_voor_vlucht": [*joins.BOOKING, "balienummer"]})


def _coded(t: Tables, code: Column) -> DataFrame:
    return _remaining(t, cascade.rekey_cascade(t, "luchthaven", t["luchthaven"].select("luchthavencode", code.alias("new_luchthavencode"))), {})


def renamed_airports(spark: SparkSession, folder: str) -> DataFrame:
    """All airports get new codes, in two batches on the same tables; those that flights go to are refused. Codes of the
    first keep two signs of the old ones, and those that several airports want are refused too; the second keeps all."""
    t = project(spark, folder)
    whole = _coded(t, F.concat(F.lit("X"), "luchthavencode"))
    short = _coded(t, F.concat(F.lit("X"), F.substring("luchthavencode", 2, 2)))
    return short.unionByName(whole.withColumn("table_name", F.concat(F.lit("whole:"), "table_name")))


# --- admission ---------------------------------------------------------------------------------------


def _at_handled(spark: SparkSession, folder: str) -> Tables:
    """The tables as they stand when the requests arrive: bookings of handled orders, written once."""
    return project(spark, folder).replacing(passagier_voor_vlucht=settle(project_handled(spark, folder), "handled"))


def capacity(spark: SparkSession, folder: str, as_written: bool = False) -> DataFrame:
    t = _at_handled(spark, folder)
    return admission.admit_capacity(
        t["vlucht"], t["passagier_voor_vlucht"], project_requests(spark, folder), as_written
    ).select("seq", *joins.BOOKING, "accepted")


def _decided(df: DataFrame) -> DataFrame:
    return df.select("seq", *joins.BOOKING, "accepted", _joined(F.col("broken")).alias("broken"))


def admitted_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(admission.admit_rows(_at_handled(spark, folder), project_requests(spark, folder)))


def statement_violations(spark: SparkSession, folder: str, as_written: bool = False) -> DataFrame:
    """The requests as one statement: what speaks against it."""
    return admission.admit_statement(
        _at_handled(spark, folder), project_requests(spark, folder), as_written=as_written
    ).violations


def refused_statement(spark: SparkSession, folder: str) -> DataFrame:
    """The requests as one statement under all rules: refused as a whole."""
    return admission.admit_statement(_at_handled(spark, folder), project_requests(spark, folder)).accepted


def accepted_statement(spark: SparkSession, folder: str) -> DataFrame:
    """The requests as one statement under the foreign keys only: taken as a whole."""
    names = ["fk_passagier", "fk_vlucht", "fk_balie"]
    return admission.admit_statement(_at_handled(spark, folder), project_requests(spark, folder), names).accepted


def _desk_requests(spark: SparkSession, folder: str) -> DataFrame:
    """The next desk for every desk and flight of the list."""
    desk = F.col("balienummer") % 50 + 1
    return project(spark, folder)["inchecken_voor_vlucht"].select(desk.cast("int").alias("balienummer"), "vluchtnummer")


def desk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return admission.admit_desks(project(spark, folder), _desk_requests(spark, folder)).violations


def desks_taken(spark: SparkSession, folder: str) -> DataFrame:
    """Those of the next desks that the airline and the destination have, as one statement."""
    t = project(spark, folder)
    flights = t["vlucht"].select("vluchtnummer", "maatschappijcode", "luchthavencode")
    fit = (
        _desk_requests(spark, folder)
        .join(flights, "vluchtnummer")
        .join(t["inchecken_bij_maatschappij"], ["balienummer", "maatschappijcode"], "left_semi")
        .join(t["inchecken_voor_bestemming"], ["balienummer", "luchthavencode"], "left_semi")
        .join(t["balie"], "balienummer", "left_semi")
    )
    return admission.admit_desks(t, fit).accepted


def _airport_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every airport again under a new code and name: some keep either, share a name or a code, or have no name."""
    number = F.col("luchthavencode").cast("int")
    code = F.when(number % 4 == 0, F.col("luchthavencode")).when(number % 7 == 0, "NNN").otherwise(F.concat(F.lit("N"), "luchthavencode"))
    name = (
        F.when(number % 5 == 0, F.col("naam"))
        .when(number % 5 == 1, F.concat(F.lit("Twin "), F.floor(number / 10).cast("string")))
        .when(number % 5 == 2, F.lit(None))
        .otherwise(F.concat(F.lit("New "), "naam"))
    )
    return project(spark, folder)["luchthaven"].select(code.alias("luchthavencode"), name.alias("naam"), "land")


def airports_judged(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that is refused, with what speaks against it, and one that is taken."""
    t = project(spark, folder)
    whole = admission.admit_table(t, "luchthaven", _airport_rows(spark, folder))
    new = t["luchthaven"].withColumns({c: F.concat(F.lit("N"), c) for c in ("luchthavencode", "naam")})
    fit = admission.admit_table(t, "luchthaven", new)
    shown = lambda batch, rows, rule: rows.select(F.lit(batch).alias("batch"), rule.alias("rule"), "luchthavencode")
    return _union(
        [shown(name, made.violations, F.col("rule")) for name, made in (("mixed", whole), ("fit", fit))]
        + [shown(name, made.accepted, F.lit("accepted")) for name, made in (("mixed", whole), ("fit", fit))]
    )


def destination_desk_violations(spark: SparkSession, folder: str) -> DataFrame:
    """The desks of destinations again: a third as they are stored, a third with unknown desks, a third with unknown airports."""
    t = project(spark, folder)
    turn = F.col("balienummer") % 3
    batch = t["inchecken_voor_bestemming"].select(
        F.when(turn == 1, F.col("balienummer") + 1000).otherwise(F.col("balienummer")).cast("int").alias("balienummer"),
        F.when(turn == 2, F.concat(F.lit("X"), "luchthavencode")).otherwise(F.col("luchthavencode")).alias("luchthavencode"),
    )
    return admission.admit_table(t, "inchecken_voor_bestemming", batch).violations


def passenger_violations(spark: SparkSession, folder: str) -> DataFrame:
    """All passengers again: some under their own numbers, some two by two under one, some without a name."""
    t = project(spark, folder)
    number = F.col("passagiernummer")
    batch = t["passagier"].select(
        F.when(number % 7 == 0, number).when(number % 13 == 0, F.lit(2_000_000_000) + F.floor(number / 26)).otherwise(F.lit(1_000_000_000) + number)
        .cast("long").alias("passagiernummer"),
        F.when(number % 11 != 0, F.col("naam")).alias("naam"),
        "geslacht",
        "geboortedatum",
    )
    return admission.admit_table(t, "passagier", batch).violations


def _flight_rows(spark: SparkSession, folder: str, new: bool) -> DataFrame:
    """Every flight again with another gate and more places, or as a new flight with its own number."""
    flights = project(spark, folder)["vlucht"]
    if new:
        return flights.where("max_aantal_psgrs * max_ppgewicht <= max_totaalgewicht").withColumn("vluchtnummer", -1 - F.col("vluchtnummer"))
    gate = F.char((F.lit(65) + (F.col("vluchtnummer") + F.col("max_aantal_psgrs")) % 6).cast("int"))
    return flights.withColumns({"gatecode": gate, "max_aantal_psgrs": F.col("max_aantal_psgrs") + F.col("vluchtnummer").cast("int") % 2})


def flight_violations(spark: SparkSession, folder: str) -> DataFrame:
    return admission.admit_flights(project(spark, folder), _flight_rows(spark, folder, new=False)).violations


def flights_taken(spark: SparkSession, folder: str) -> DataFrame:
    return admission.admit_flights(project(spark, folder), _flight_rows(spark, folder, new=True)).accepted


# --- history -----------------------------------------------------------------------------------------


def _without_every_17th(before: DataFrame) -> DataFrame:
    """One passenger in seventeen withdraws; one in thirteen moves to desk 1."""
    return before.where(F.col("passagiernummer") % 17 != 0).withColumn(
        "balienummer", F.when(F.col("passagiernummer") % 13 == 0, 1).otherwise(F.col("balienummer"))
    )


def _unseated(before: DataFrame) -> DataFrame:
    """A later change: one passenger in eleven gives the seat back."""
    back = F.col("passagiernummer") % 11 == 0
    return before.withColumns({c: F.when(~back, F.col(c)) for c in ("inchecktijdstip", "stoel")})


def booking_history(spark: SparkSession, folder: str) -> DataFrame:
    before = project(spark, folder)["passagier_voor_vlucht"]
    return history.history_rows(before, _without_every_17th(before), joins.BOOKING, AS_OF)


def all_history(spark: SparkSession, folder: str, whole: bool = False) -> DataFrame:
    """History of every table between the stored state and the one after withdrawals, flight updates and the
    removal of baggage over the limit: keys, or ``whole`` rows as they were. Items with the same number are one item
    here: history needs keys."""
    t = project(spark, folder)
    items = t["object"].groupBy("volgnummer").agg(
        F.min("passagiernummer").alias("passagiernummer"),
        F.min("vluchtnummer").alias("vluchtnummer"),
        F.sum("gewicht").cast("int").alias("gewicht"),
    )
    over = rules.rule05_baggage_limit(t).select(*joins.BOOKING)
    before = t.replacing(object=items)
    updates = _flight_updates(spark, folder)
    after = before.replacing(
        passagier_voor_vlucht=_without_every_17th(before["passagier_voor_vlucht"]),
        vlucht=changes.guard_flight_update(before, updates).flights,
        maatschappij=before["maatschappij"].join(rules.rule09_airline_has_desk(before), "maatschappijcode", "left_anti"),
        object=items.join(over, joins.BOOKING, "left_anti").select(*TABLES["object"].names),
    )
    made = history.history_all(before, after, AS_OF)
    if whole:
        marks = [F.col("timestamp").cast("string"), F.col("actie")]
        return _union(
            df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in TABLES[name].names], *marks).alias("row_text"))
            for name, df in made.items()
        )
    return _union(
        df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[F.col(c).cast("string") for c in TABLES[name].key]).alias("row_key"), "timestamp", "actie")
        for name, df in made.items()
    )


def state_between(spark: SparkSession, folder: str) -> DataFrame:
    first = project(spark, folder)["passagier_voor_vlucht"]
    second = _without_every_17th(first)
    third = _unseated(second)
    log = history.history_rows(first, second, joins.BOOKING, FIRST_CHANGE).unionByName(
        history.history_rows(second, third, joins.BOOKING, SECOND_CHANGE)
    )
    return history.as_of_state(third, log, joins.BOOKING, BETWEEN)


def _state_at_start(spark: SparkSession, folder: str) -> DataFrame:
    first = project(spark, folder)["passagier_voor_vlucht"]
    second = _without_every_17th(first)
    log = history.history_rows(first, second, joins.BOOKING, FIRST_CHANGE)
    return history.as_of_state(second, log, joins.BOOKING, "2001-12-31 00:00:00")


#: Moments to ask for: long before, at, just before and after the changes.
MOMENTS = ("2001-01-01 00:00:00", "2001-12-31 23:59:59", FIRST_CHANGE, BETWEEN, SECOND_CHANGE, AS_OF)


def states_at_many_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Every booking at six moments, in one join. One passenger in nineteen comes with the second change only."""
    last = settle(project(spark, folder)["passagier_voor_vlucht"], "bookings")
    there = F.col("passagiernummer") % 19 != 0
    first = last.where(there)
    second = _without_every_17th(first)
    third = _unseated(second).unionByName(last.where(~there))
    log = history.history_rows(first, second, joins.BOOKING, FIRST_CHANGE).unionByName(
        history.history_rows(second, third, joins.BOOKING, SECOND_CHANGE)
    )
    came = history.arrivals(first, second, joins.BOOKING, FIRST_CHANGE).unionByName(
        history.arrivals(second, third, joins.BOOKING, SECOND_CHANGE)
    )
    moment = F.explode(F.array(*[F.to_timestamp_ntz(F.lit(m)) for m in MOMENTS])).alias("moment")
    # Rows that came into being with the log itself are asked for too: all of them existed at some time.
    return history.as_of_many(last.select(*joins.BOOKING, moment), third, log, came, joins.BOOKING)


# --- audits ------------------------------------------------------------------------------------------


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    t = project(spark, folder)
    return keys.pk_duplicates(t["object"], list(TABLES["object"].key))


def shared_values(spark: SparkSession, folder: str) -> DataFrame:
    """Airport names, which must differ, and countries, which need not."""
    t = project(spark, folder)
    return _union(
        keys.unique_violations(t["luchthaven"], c).select(F.lit(c).alias("column_name"), F.col(c).alias("value"), "n_rows")
        for c in ("naam", "land")
    )


def orphaned_bookings(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings that would lose their passenger if one market segment went without its bookings."""
    t = project(spark, folder)
    customers = StarSource(spark, folder).raw("customer").where(F.col("c_mktsegment") != "BUILDING")
    left = customers.select(F.col("c_custkey").alias("passagiernummer"))
    return keys.fk_orphans(t["passagier_voor_vlucht"], left, ["passagiernummer"])


def orphan_counts(spark: SparkSession, folder: str) -> DataFrame:
    t = project(spark, folder)
    return _union(
        keys.fk_orphans(t[fk.child], t[fk.parent], list(fk.columns), list(fk.parent_columns))
        .agg(F.count("*").alias("n_orphans"))
        .select(F.lit(fk.name).alias("foreign_key"), "n_orphans")
        for fk in FOREIGN_KEYS
    )


def unlisted_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as if they were history rows: two of three with an action that is listed."""
    third = F.col("event_id") % 3
    action = F.when(third == 0, "update").when(third == 1, "delete").otherwise(F.col("event_type")).alias("actie")
    events = StarSource(spark, folder).raw("events").select("event_id", action)
    return keys.check_in_list(events, "actie", history.ACTIONS)


def literal_search(spark: SparkSession, folder: str) -> DataFrame:
    """Names that hold a percent sign, searched for with one that is no wildcard."""
    t = project(spark, folder)
    marked = t["passagier"].withColumn("naam", F.translate("naam", "#", "%"))
    return lookup.passenger_search(t.replacing(passagier=marked), text="%0000000", desk=DESK, wildcards=False)


def _lines(report: DataFrame) -> DataFrame:
    pairs = F.transform(F.map_entries("key"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    return report.select("rule", F.col("table").alias("table_name"), F.array_join(pairs, ",").alias("row_key"), "detail")


def full_audit(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(audit.audit_all(_stored(spark, folder)))


def audit_after_change(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings are withdrawn and moved, some baggage goes: the ledger of before, kept up from what that touched."""
    before = _stored(spark, folder)
    book = settle(audit.audit_all(before), "ledger")
    people, number = F.col("passagiernummer"), F.col("volgnummer")
    bookings = before["passagier_voor_vlucht"]
    after = before.replacing(
        passagier_voor_vlucht=settle(_without_every_17th(bookings), "after-bookings"),
        object=settle(before["object"].where(number % 10 != 3), "after-items"),
    )
    touched = bookings.where((people % 17 == 0) | (people % 13 == 0))
    return _lines(ledger.audit_after(book, before, after, touched, before["object"].where(number % 10 == 3)))


# --- streaming ---------------------------------------------------------------------------------------


def _written_requests(spark: SparkSession, folder: str) -> str:
    return write_version(project_requests(spark, folder), work_folder(spark, "requests"))


def streamed_row_rules(spark: SparkSession, folder: str) -> DataFrame:
    requests = stream.read_requests(spark, _written_requests(spark, folder))
    out = work_folder(spark, "row-rules")
    query = (
        stream.stream_row_rules(requests, _stored(spark, folder))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", work_folder(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _decided(spark.read.parquet(out))


#: Desks that are there from the start; the others are set up between two lots.
FIRST_DESKS = 25


def streamed_live_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Requests with even numbers come while desks are missing, those with odd numbers after they were set up."""
    t = project(spark, folder)
    desks = t["balie"]
    first = F.col("balienummer") <= FIRST_DESKS
    store = _store(spark, {**{n: t[n] for n in t if n != "balie"}, "balie": desks.where(first)})
    requests = settle(project_requests(spark, folder), "requests")
    inbox, out, progress = (work_folder(spark, n) for n in ("inbox", "live-rules", "progress"))
    for odd in (0, 1):
        if odd:
            store.apply([Edit("balie", added=desks.where(~first))])
        write_version(requests.where(F.col("seq") % 2 == odd), inbox, append=True)
        stream.stream_row_rules_live(stream.read_requests(spark, inbox, 10_000), store.folder, out, progress).awaitTermination()
    return _decided(spark.read.parquet(f"{out}/checked"))


def streamed_admission(spark: SparkSession, folder: str) -> DataFrame:
    """The requests arrive in three lots, in order of their numbers; each run of the stream takes up the next."""
    base = write_tables(_at_handled(spark, folder), work_folder(spark, "base"))
    requests = settle(project_requests(spark, folder), "requests")
    bounds = requests.agg(F.expr("percentile_approx(seq, array(0.3, 0.7))")).first()[0] or [0, 0]
    lot = F.when(F.col("seq") <= bounds[0], 0).when(F.col("seq") <= bounds[1], 1).otherwise(2)
    inbox, out, progress = (work_folder(spark, n) for n in ("inbox", "admission", "progress"))
    for n in range(3):
        write_version(requests.where(lot == n), inbox, append=True)
        stream.stream_admit(stream.read_requests(spark, inbox, 10_000), base, out, progress).awaitTermination()
    rejected = spark.read.option("basePath", f"{out}/rejected").parquet(f"{out}/rejected")
    return _union(
        [
            stream.accepted_before(spark, out).select(
                "seq", *joins.BOOKING, F.lit(True).alias("accepted"), F.lit("").alias("broken")
            ),
            rejected.select("seq", *joins.BOOKING, F.lit(False).alias("accepted"), _joined(F.col("broken")).alias("broken")),
        ]
    )


def _gate(spark: SparkSession, folder: str) -> DataFrame:
    """Seated bookings, provided some seat is taken twice anywhere."""
    t = project(spark, folder)
    seated = t["passagier_voor_vlucht"].where(F.col("stoel").isNotNull()).select(*joins.BOOKING, "stoel")
    return joins.global_exists_gate(seated, aggregates.duplicate_seats(t, with_null=False))


def _booking_counts(spark: SparkSession, folder: str) -> DataFrame:
    t = project(spark, folder)
    flights = t["vlucht"].select("vluchtnummer", "max_aantal_psgrs")
    return joins.scalar_count_join(flights, t["passagier_voor_vlucht"], "vluchtnummer", "n_bookings")


QUERIES: dict[str, Query] = {
    # sources and sinks
    "load_tables": loaded_tables,
    "scan_desks": _on_tables(scan_desks),
    "scan_flights": _on_tables(scan, table="vlucht"),
    "scan_bookings": _on_tables(scan, table="passagier_voor_vlucht"),
    "scan_passengers": _on_tables(scan, table="passagier"),
    "scan_desk_flights": _on_tables(scan, table="inchecken_voor_vlucht"),
    "scan_desk_airlines": _on_tables(scan, table="inchecken_bij_maatschappij"),
    "scan_desk_airports": _on_tables(scan, table="inchecken_voor_bestemming"),
    "write_version": written_version,
    "load_tables_rows": loaded_rows,
    "write_version_as_of": version_between,
    # lookups
    "passenger_search": _on_tables(lookup.passenger_search, text=SEARCH, desk=DESK),
    "passenger_search_literal": literal_search,
    "passenger_search_wildcards": _on_tables(lookup.passenger_search, text="0%7_", desk=DESK),
    "passenger_search_ignore_case": _on_tables(lookup.passenger_search, text="cUSTOMER#0000000", desk=DESK, ignore_case=True),
    "baggage_of_booking": _on_tables(lookup.baggage_of_booking, passenger=PASSENGER, flight=FLIGHT),
    "booking_detail": _on_tables(lookup.booking_detail, passenger=PASSENGER, flight=FLIGHT),
    "booking_detail_all": _on_tables(lookup.booking_detail, passenger=PASSENGER),
    "bookings_of_flight": _on_tables(lookup.bookings_of_flight, flight=FLIGHT),
    # joins
    "join_booking_flight": _on_tables(joins.join_booking_flight),
    "join_search_chain": _on_tables(joins.join_search_chain),
    "join_late_checkin": _on_tables(joins.join_late_checkin),
    "semi_flights_with_bookings": _on_tables(joins.semi_flights_with_bookings),
    "anti_desk_allowed": _on_tables(joins.anti_desk_allowed),
    "anti_desk_of_flight": _on_tables(joins.anti_desk_of_flight),
    "interval_overlap": _on_tables(joins.interval_overlap),
    "scalar_count_join": _booking_counts,
    "global_exists_gate": _gate,
    # aggregates
    "flight_load": _on_tables(aggregates.flight_load),
    "baggage_over_count": _on_tables(aggregates.baggage_over_count),
    "baggage_over_weight": _on_tables(aggregates.baggage_over_weight),
    "baggage_limit_combined": _on_tables(aggregates.baggage_limit_combined),
    "duplicate_seats": _on_tables(aggregates.duplicate_seats),
    "desks_per_airline": _on_tables(aggregates.desks_per_airline),
    "scalar_functions": scalar_functions,
    # rules
    "rule01_pair_null": _on_tables(rules.rule01_pair_null),
    "rule02_changed_booked_flights": changed_booked_flights,
    "rule02_as_written": lambda s, d: changed_booked_flights(s, d, as_written=True),
    "rule03_late_checkin": _on_tables(rules.rule03_late_checkin),
    "rule03_as_written": _on_tables(rules.rule03_late_checkin, as_written=True),
    "rule04_over_capacity": _on_tables(rules.rule04_over_capacity),
    "rule04_as_written": _on_tables(rules.rule04_over_capacity, as_written=True),
    "rule05_baggage_limit": _on_tables(rules.rule05_baggage_limit),
    "rule06_weight_budget": _on_tables(rules.rule06_weight_budget),
    "rule06_as_written": _on_tables(rules.rule06_weight_budget, as_written=True),
    "rule07_seat_unique": _on_tables(rules.rule07_seat_unique),
    "rule07_as_written": _on_tables(rules.rule07_seat_unique, as_written=True),
    "rule08a_desk_allowed": _on_tables(rules.rule08a_desk_allowed),
    "rule08b_booking_desk": _on_tables(rules.rule08b_booking_desk),
    "rule08b_as_written": _on_tables(rules.rule08b_booking_desk, as_written=True),
    "rule09_airline_has_desk": _on_tables(rules.rule09_airline_has_desk),
    "rule10_overlap": _on_tables(rules.rule10_overlap),
    # keys and constraints
    "pk_duplicates": duplicate_keys,
    "unique_violations": shared_values,
    "fk_orphans": orphaned_bookings,
    "fk_orphan_counts": orphan_counts,
    "not_null_violations": missing_values,
    "check_in_list": unlisted_actions,
    "audit_all": full_audit,
    "audit_after": audit_after_change,
    "audit_summary": lambda s, d: audit.audit_summary(_stored(s, d)),
    # changes
    "admit_statement": statement_violations,
    "admit_statement_as_written": lambda s, d: statement_violations(s, d, as_written=True),
    "admit_statement_refused": refused_statement,
    "admit_statement_accepted": accepted_statement,
    "admit_desks": desk_violations,
    "admit_desks_accepted": desks_taken,
    "admit_airports": airports_judged,
    "admit_destination_desks": destination_desk_violations,
    "admit_passengers": passenger_violations,
    "admit_flights": flight_violations,
    "admit_flights_accepted": flights_taken,
    "admit_rows": admitted_rows,
    "admit_capacity": capacity,
    "admit_capacity_as_written": lambda s, d: capacity(s, d, as_written=True),
    "upsert_bookings": upserted,
    "upsert_touched_files": upserted_files,
    "remove_baggage_touched_files": removed_from_files,
    "delete_cascade_touched_files": deleted_from_files,
    "rekey_swap": turned_desks,
    "rekey_swap_touched_files": turned_in_files,
    "add_baggage": added_baggage,
    "remove_baggage": removed_baggage,
    "register_airline": registered_airlines,
    "guard_flight_update": guarded_update,
    "guard_flight_update_as_written": lambda s, d: guarded_update(s, d, as_written=True),
    "backfill_flights": backfilled,
    "backfill_flights_as_written": lambda s, d: backfilled(s, d, as_written=True),
    "delete_cascade": deleted_passengers,
    "delete_cascade_refused": deleted_flights,
    "rekey_cascade": renumbered_desks,
    "rekey_cascade_refused": renamed_airports,
    # history
    "history_rows": booking_history,
    "history_all": all_history,
    "history_all_rows": lambda s, d: all_history(s, d, whole=True),
    "as_of_state": state_between,
    "as_of_state_start": _state_at_start,
    "as_of_many": states_at_many_moments,
    # streaming
    "stream_row_rules": streamed_row_rules,
    "stream_row_rules_live": streamed_live_rules,
    "stream_admit": streamed_admission,
}
