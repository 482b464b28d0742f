"""Changes, cascades, history, lookups, sources."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from airport import ROWS, airport, at, flight, found, requests

from paxledger.functions.scalars import add_days, micros, year_boundaries
from paxledger.operators import lookup
from paxledger.plans import changes, history
from paxledger.plans.cascade import delete_cascade, rekey_cascade
from paxledger.plans.keys import fk_orphans
from paxledger.session import work_folder
from paxledger.sources.schema import FOREIGN_KEYS, TABLES
from paxledger.sources.tables import conform, load_jdbc, load_tables, scan_desks, write_tables, write_version
from pyspark.sql import functions as F

BOOKING = ["passagiernummer", "vluchtnummer"]


def test_upsert_takes_the_last_request(spark):
    t = airport(spark)
    after = changes.upsert_bookings(
        t["passagier_voor_vlucht"],
        requests(spark, (13, 5317, 1, "2004-02-05 20:00", "80"), (13, 5317, 3, None, None), (850, 5316, 1, None, None)),
    )
    rows = {(r.passagiernummer, r.vluchtnummer): r for r in after.collect()}
    assert len(rows) == after.count() == 7
    assert (rows[13, 5317].balienummer, rows[13, 5317].stoel) == (3, None)
    assert rows[850, 5316].balienummer == 1 and rows[850, 5317].stoel == "75"


ITEM = "seq long, passagiernummer long, vluchtnummer long, gewicht int"


def test_add_baggage_one_at_a_time(spark):
    rng = random.Random(5)
    bookings = [(p, 1, None, None, None) for p in range(80)]
    stored = [(i, p, 1, rng.randint(1, 9)) for i, p in enumerate(rng.choices(range(80), k=60))]
    items = [(i, rng.choice([0, 0, 0, *range(85)]), 1, rng.choice([None, *range(-2, 13)])) for i in range(400)]
    t = airport(
        spark, vlucht=[flight(1, "2004-01-01 00:00", "2004-01-02 00:00")], passagier_voor_vlucht=bookings, object=stored
    )
    got = {r.seq: ",".join(r.broken) for r in changes.add_baggage(t, spark.createDataFrame(items, ITEM)).collect()}
    count, weight, expected = defaultdict(int), defaultdict(int), {}
    for _, p, _, w in stored:
        count[p] += 1
        weight[p] += w
    for seq, p, _, w in items:
        reasons = ["not_null"] * (w is None) + ["fk_booking"] * (p >= 80)
        if not reasons and (count[p] >= 3 or weight[p] + w > 20):
            reasons = ["rule05_baggage_limit"]
        if not reasons:
            count[p] += 1
            weight[p] += w
        expected[seq] = ",".join(reasons)
    assert got == expected


def test_a_refused_item_uses_nothing_up(spark):
    t = airport(spark)
    items = spark.createDataFrame([(1, 13, 5317, 15), (2, 13, 5317, 10), (3, 13, 5317, 3)], ITEM)
    assert {r.seq: r.accepted for r in changes.add_baggage(t, items).collect()} == {1: True, 2: False, 3: True}


def test_remove_baggage(spark):
    t = airport(spark)
    left = changes.remove_baggage(t["object"], spark.createDataFrame([(2,), (2,), (99,)], "volgnummer long"))
    assert found(left, "volgnummer") == [(1,), (3,)]


def test_register_airline(spark):
    batch = spark.createDataFrame(
        [
            (1, 1, "TT", "Test"), (2, 99, "UU", "Unknown desk"), (3, 2, "KL ", "Other"), (4, 2, "VV", "KLM"), (5, 2, "TT ", "Again"),
            (6, 2, "WW", "Test"), (7, 2, "XX", "Again"), (8, 2, "WW", "Free"), (9, 1, "YY", "Free"), (10, 1, None, "No code"), (11, 1, "YY", "Last"),
        ],
        "seq long, balienummer int, maatschappijcode string, naam string",
    )
    done = changes.register_airline(airport(spark), batch)
    assert found(done.airlines, "maatschappijcode", "naam") == [("TT", "Test"), ("WW", "Free"), ("XX", "Again"), ("YY", "Last")]
    assert found(done.desks, "balienummer", "maatschappijcode") == [(1, "TT"), (1, "YY"), (2, "WW"), (2, "XX")]
    assert {r.seq: r.broken for r in done.refused.collect()} == {
        2: ["fk_desk"], 3: ["pk_airline"], 4: ["unique_name"], 5: ["pk_airline"], 6: ["unique_name"], 9: ["unique_name"], 10: ["not_null"],
    }


def test_register_airline_one_at_a_time(spark):
    rng = random.Random(6)
    rows = [(i, 1, f"{rng.randint(0, 30):02}", f"n{rng.randint(0, 30)}") for i in range(150)]
    batch = spark.createDataFrame(rows, "seq long, balienummer int, maatschappijcode string, naam string")
    codes, names, want = set(), set(), []
    for _, _, code, name in rows:
        if code not in codes and name not in names:
            codes.add(code)
            names.add(name)
            want.append((code, name))
    assert found(changes.register_airline(airport(spark), batch).airlines, "maatschappijcode", "naam") == sorted(want)


def test_guarded_update_keeps_the_table_valid(spark):
    t = airport(spark)
    updates = spark.createDataFrame(
        [(5314, "C ", 110), (5315, "D", None), (5316, None, 9999), (5320, "C", 90), (5320, "C", 80), (9999, "C", 1)],
        "vluchtnummer long, gatecode string, max_aantal_psgrs int",
    )
    done = changes.guard_flight_update(t, updates)
    assert {(r.vluchtnummer, *r.broken) for r in done.refused.collect()} == {
        (5315, "fk_flight"), (5316, "rule06_weight_budget"), (5320, "pk_flight"),
    }
    assert done.flights.count() == 6
    assert {r.vluchtnummer: r.max_aantal_psgrs for r in done.flights.collect()}[5314] == 110
    assert {r.gatecode for r in done.flights.collect()} == {"C"}


def test_renamed_keys_need_parents(spark):
    pairs = spark.createDataFrame(
        [(850, 5317, 850, 9999), (11, 5317, 11, 5316)],
        "passagiernummer long, vluchtnummer long, new_passagiernummer long, new_vluchtnummer long",
    )
    done = rekey_cascade(airport(spark), "passagier_voor_vlucht", pairs)
    assert found(done.refused, *BOOKING) == [(850, 5317)]
    assert (11, 5316) in found(done.tables["passagier_voor_vlucht"], *BOOKING)


def test_backfill(spark):
    rows = [
        flight(1, None, None), flight(2, "2004-01-01 00:00", None), flight(3, None, "2004-01-05 00:00"),
        flight(4, "2004-01-01 00:00", "2004-01-02 00:00", places=200),
    ]
    t = airport(spark, vlucht=rows)
    columns = ("vluchtnummer", "vertrektijdstip", "aankomsttijdstip", "max_totaalgewicht")
    spec = {r[0]: r[1:] for r in changes.backfill_flights(t["vlucht"], "2004-02-10 12:00:00").select(*columns).collect()}
    assert spec[1] == (at("2004-02-09 12:00"), at("2004-02-10 12:00"), 2500)
    assert spec[2] == (at("2004-01-01 00:00"), at("2004-01-02 00:00"), 2500)
    assert spec[3][:2] == (at("2004-02-09 12:00"), at("2004-01-05 00:00"))
    assert spec[4][2] == 9000
    written = {r[0]: r[1:] for r in changes.backfill_flights(t["vlucht"], "2004-02-10 12:00:00", as_written=True).select(*columns).collect()}
    assert written[1] == (at("2004-02-09 12:00"), None, 2500)


def _orphans(t):
    return [
        fk.name
        for fk in FOREIGN_KEYS
        if fk_orphans(t[fk.child], t[fk.parent], list(fk.columns), list(fk.parent_columns)).count()
    ]


@pytest.mark.parametrize(
    ("table", "keys", "refused"),
    [
        ("passagier", [(850,), (11,)], []),
        ("vlucht", [(5314,), (5317,)], [(5317,)]),
        ("balie", [(1,), (2,), (3,), (4,)], [(1,), (3,)]),
        ("maatschappij", [("KL",)], [("KL",)]),
        ("gate", [("C",)], [("C",)]),
        ("passagier_voor_vlucht", [(850, 5317)], []),
        ("object", [(1,)], []),
    ],
)
def test_delete_cascade(spark, table, keys, refused):
    t = airport(spark)
    pk = list(TABLES[table].key)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t[table].schema if f.name in pk)
    done = delete_cascade(t, table, spark.createDataFrame(keys, schema))
    assert found(done.refused, *pk) == refused
    after = t.replacing(**done.tables)
    assert set(found(t[table], *pk)) - set(found(after[table], *pk)) == set(keys) - set(refused)
    assert _orphans(after) == []


def test_delete_cascade_reaches_grandchildren(spark):
    done = delete_cascade(airport(spark), "passagier", spark.createDataFrame([(850,)], "passagiernummer long"))
    assert found(done.tables["object"], "volgnummer") == [(3,)]
    assert (850, 5317) not in found(done.tables["passagier_voor_vlucht"], *BOOKING)


def test_rekey_cascade(spark):
    t = airport(spark)
    mapping = spark.createDataFrame([(1, 101), (2, 3), (3, 103), (4, 103)], "balienummer int, new_balienummer int")
    done = rekey_cascade(t, "balie", mapping)
    # 2 would take a number in use; 3 and 4 want the same one.
    assert found(done.refused, "balienummer") == [(2,), (3,), (4,)]
    after = t.replacing(**done.tables)
    assert found(after["balie"], "balienummer") == [(2,), (3,), (4,), (101,)]
    assert (850, 5317, 101) in found(after["passagier_voor_vlucht"].where("balienummer is not null"), *BOOKING, "balienummer")
    assert _orphans(after) == []


def test_rekey_refuses_no_action(spark):
    t = airport(spark)
    people = rekey_cascade(t, "passagier", spark.createDataFrame([(850, 851), (1555, 1556)], "passagiernummer long, new_passagiernummer long"))
    assert found(people.refused, "passagiernummer") == [(850,)]
    assert (1556,) in found(people.tables["passagier"], "passagiernummer")
    pair = spark.createDataFrame([(850, 5317, 850, 5316)], "passagiernummer long, vluchtnummer long, new_passagiernummer long, new_vluchtnummer long")
    moved = rekey_cascade(t, "passagier_voor_vlucht", pair)
    assert found(moved.tables["object"], "volgnummer", "vluchtnummer") == [(1, 5316), (2, 5316), (3, 5317)]


def test_history_and_state(spark):
    before = airport(spark)["passagier_voor_vlucht"]
    mid = before.where("passagiernummer != 850").withColumn("balienummer", F.when(F.col("passagiernummer") == 11, 1).otherwise(F.col("balienummer")))
    after = mid.withColumn("stoel", F.when(F.col("passagiernummer") != 12, F.col("stoel")))
    first = history.history_rows(before, mid, BOOKING, "2004-01-01 00:00:00")
    assert found(first, "passagiernummer", "actie", "timestamp") == [(11, "update", at("2004-01-01 00:00")), (850, "delete", at("2004-01-01 00:00"))]
    second = history.history_rows(mid, after, BOOKING, "2004-01-02 00:00:00")
    log = first.unionByName(second)
    state = lambda ts: {tuple(r) for r in history.as_of_state(after, log, BOOKING, ts).select(*before.columns).collect()}
    assert state("2003-12-31 00:00:00") == {tuple(r) for r in before.collect()}
    assert state("2004-01-01 00:00:00") == {tuple(r) for r in mid.collect()}
    assert state("2004-01-03 00:00:00") == {tuple(r) for r in after.collect()}
    assert [name for name, _ in history.history_columns("gate")] == ["gatecode", "timestamp", "actie"]
    t = airport(spark)
    made = history.history_all(t, t.replacing(passagier_voor_vlucht=mid), "2004-01-01 00:00:00")
    assert {n: df.count() for n, df in made.items() if df.count()} == {"passagier_voor_vlucht": 2}
    assert first.columns == [c for c, _ in history.history_columns("passagier_voor_vlucht")]


def test_lookups(spark):
    people = [(1, "Jan 100% Jansen", "M", at("1970-01-01 00:00")), (2, "jan_b", "V", at("1970-01-01 00:00")), (3, "Jan\\c", "M", at("1970-01-01 00:00"))]
    t = airport(spark, passagier=people, passagier_voor_vlucht=[(n, 5316, 3, None, None) for n in (1, 2, 3)] + [(1, 5314, 1, None, None)])
    search = lambda text, **o: [r[0] for r in found(lookup.passenger_search(t, text, 1, **o), "passagiernummer", "vluchtnummer")]
    # Desk 1 serves 5316 but not 5314, whatever desk the bookings name.
    assert search("Jan") == [1, 3]
    assert search("Jan", ignore_case=True) == [1, 2, 3]
    assert search("%") == [1, 2, 3] and search("%", wildcards=False) == [1]
    assert search("n_b") == [2] and search("J_n", wildcards=False) == []
    assert search("\\c") == [3]
    t = airport(spark)
    assert found(lookup.baggage_of_booking(t, 850, 5317), "volgnummer") == [(1,), (2,)]
    assert found(lookup.booking_detail(t, 850, 5317), "naam", "stoel") == [("Passenger 850", "75")]
    assert found(lookup.booking_detail(t, 850), "vluchtnummer") == [(5317,)]
    assert len(found(lookup.bookings_of_flight(t, 5317), "passagiernummer")) == 5
    assert found(lookup.bookings_of_flight(t, 9999), "passagiernummer") == []


def test_scalars(spark):
    row = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.5' AS a, timestamp_ntz'2004-03-28 02:30:00.000123' AS b").select(
        micros(F.col("a")).alias("ma"), micros(F.col("b")).alias("mb"), add_days(F.col("b"), -30).alias("d"), year_boundaries(F.col("a"), F.col("b")).alias("y")
    ).first()
    assert (row.ma, row.mb, row.y) == (-500000, 1080441000000123, 35)
    assert row.d == at("2004-02-27 02:30:00.000123")


def test_tables_round_trip(spark):
    t = airport(spark, gate=[("C ",)], passagier_voor_vlucht=[(850, 5316, 1, at("2004-01-31 08:00"), "97 ")])
    stored = load_tables(spark, write_tables(t, work_folder(spark, "airport")))
    assert set(stored) == set(TABLES)
    for name in TABLES:
        assert stored[name].schema == TABLES[name].schema
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, conform(t[name], name).collect()))
    assert found(stored["passagier_voor_vlucht"], "stoel") == [("97",)]
    assert found(scan_desks(stored), "balienummer") == [(1,), (2,), (3,), (4,)]


def test_write_version(spark):
    flights = airport(spark)["vlucht"]
    path = write_version(flights, work_folder(spark, "vlucht"), by=["gatecode"])
    assert spark.read.parquet(path).count() == len(ROWS["vlucht"])
    with pytest.raises(Exception, match="(?i)already exists"):
        write_version(flights, path)
    write_version(flights, path, append=True)
    assert spark.read.parquet(path).count() == 2 * len(ROWS["vlucht"])


def test_jdbc_options_reach_the_reader(spark):
    asked = []

    class Reader:
        conf = spark.conf

        @property
        def read(self):
            return self

        def jdbc(self, url, table, **options):
            asked.append((url, table, options))
            return airport(spark)[{"Passagier": "passagier", "Gate": "gate"}[table]]

    t = load_jdbc(
        Reader(), "jdbc:sqlserver://host", {"passagier": "Passagier", "gate": "Gate"}, {"user": "u"},
        split={"passagier": ("passagiernummer", 0, 1000, 8)},
    )
    assert asked == []
    assert t["passagier"].schema == TABLES["passagier"].schema and t["gate"].count() == 1
    assert asked == [
        ("jdbc:sqlserver://host", "Passagier", {"column": "passagiernummer", "lowerBound": 0, "upperBound": 1000, "numPartitions": 8, "properties": {"user": "u"}}),
        ("jdbc:sqlserver://host", "Gate", {"properties": {"user": "u"}}),
    ]


def test_rows_as_of_moments_of_their_own(spark):
    """A table of two numbers, changed at random; every key asked for at every moment, before, at and between changes."""
    rng = random.Random(4)
    schema, keys = "k long, v int, w string", ["k"]
    states, moments = [{}], [f"2004-01-{d:02d} 00:00:00" for d in range(2, 10)]
    log = came = None
    for m in moments:
        now = dict(states[-1])
        for k in range(8):
            step = rng.random()
            if step < 0.25:
                now.pop(k, None)
            elif step < 0.55:
                now[k] = (rng.choice([None, 1, 2]), rng.choice([None, "a"]))
        before, after = (spark.createDataFrame([(k, *v) for k, v in s.items()], schema) for s in (states[-1], now))
        h, a = history.history_rows(before, after, keys, m), history.arrivals(before, after, keys, m)
        log, came = (h, a) if log is None else (log.unionByName(h), came.unionByName(a))
        states.append(now)
    asked = [(k, at(t)) for k in range(9) for m in moments for t in (m, m.replace(" 00:", " 07:"))] + [(k, at("2003-01-01")) for k in range(9)]
    probes = spark.createDataFrame(asked, "k long, moment timestamp_ntz")
    got = {(r.k, r.moment): (r.present, r.v, r.w) for r in history.as_of_many(probes, after, log, came, keys).collect()}
    want = {}
    for k, t in asked:
        s = states[sum(at(m) <= t for m in moments)]
        want[k, t] = (k in s, *s.get(k, (None, None)))
    assert got == want
