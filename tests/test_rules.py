"""One violator and one near miss per rule, and the statements as written."""

from __future__ import annotations

from decimal import Decimal

import pytest
from airport import ROWS, airport, at, flight, found
from pyspark.sql import functions as F

from paxledger.plans import audit, keys, rules
from paxledger.plans.changes import guard_flight_update

BOOKING = ("passagiernummer", "vluchtnummer")


def bookings(*extra):
    return {"passagier_voor_vlucht": ROWS["passagier_voor_vlucht"] + list(extra)}


def test_nothing_broken(spark):
    assert found(audit.audit_all(airport(spark)), "rule") == []
    summary = dict(found(audit.audit_summary(airport(spark)), "rule", "n_violations"))
    assert set(summary.values()) == {0}
    assert len(summary) == 10 + 12 + 2 + 12 + 14


def test_rule01(spark):
    t = airport(spark, **bookings((850, 5315, 1, at("2004-01-31 08:00"), None), (850, 5316, 1, None, "20"), (11, 5316, 1, None, None)))
    assert found(rules.rule01_pair_null(t), *BOOKING) == [(850, 5315), (850, 5316)]


def test_rule02(spark):
    t = airport(spark)
    after = t["vlucht"].withColumn("max_aantal_psgrs", F.when(F.col("vluchtnummer").isin(5314, 5317), 110).otherwise(F.col("max_aantal_psgrs")))
    booked = t["passagier_voor_vlucht"]
    assert found(rules.rule02_changed_booked_flights(t["vlucht"], after, booked), "vluchtnummer", "changed") == [
        (5317, "max_aantal_psgrs")
    ]
    assert found(rules.rule02_changed_booked_flights(t["vlucht"], after, booked, as_written=True), "vluchtnummer") == [(5317,), (5321,)]
    updates = spark.createDataFrame([(5314, 110), (5317, 110), (5321, 100)], "vluchtnummer long, max_aantal_psgrs int")
    spec = guard_flight_update(t, updates)
    assert found(spec.refused, "vluchtnummer") == [(5317,)]
    assert (5314, 110) in found(spec.flights, "vluchtnummer", "max_aantal_psgrs")
    assert (5317, 100) in found(spec.flights, "vluchtnummer", "max_aantal_psgrs")
    assert found(guard_flight_update(t, updates, as_written=True).refused, "vluchtnummer") == [(5317,), (5321,)]


def test_rule03_equal_moment_violates(spark):
    t = airport(spark, **bookings((1002, 5316, 1, at("2004-02-01 23:00"), "1"), (1555, 5316, 1, at("2004-02-01 22:59"), "2")))
    assert found(rules.rule03_late_checkin(t), *BOOKING) == [(1002, 5316)]
    assert (1555, 5316) in found(rules.rule03_late_checkin(t, as_written=True), *BOOKING)


def test_rule04(spark):
    full = airport(spark, **bookings((850, 5315, 1, None, None)))
    assert found(rules.rule04_over_capacity(full), "vluchtnummer") == []
    over = airport(spark, **bookings((850, 5315, 1, None, None), (1002, 5315, 1, None, None)))
    assert found(rules.rule04_over_capacity(over), "vluchtnummer", "n_bookings") == [(5315, 2)]
    assert found(rules.rule04_over_capacity(over, as_written=True), "vluchtnummer") == [(5315,), (5317,), (5321,)]


@pytest.mark.parametrize(
    ("extra", "expected"),
    [
        ([(9, 850, 5317, 5)], []),  # exactly the weight allowed
        ([(9, 850, 5317, 6)], [(850, 5317, False, True)]),
        ([(9, 850, 5317, 1), (10, 850, 5317, 1)], [(850, 5317, True, False)]),
    ],
)
def test_rule05(spark, extra, expected):
    t = airport(spark, object=ROWS["object"] + extra)
    assert found(rules.rule05_baggage_limit(t), *BOOKING, "too_many", "too_heavy") == expected


def test_rule06_exact_fit_only_as_written(spark):
    flights = [
        flight(1, "2004-01-01 00:00", "2004-01-02 00:00", places=120, total=2400),
        flight(2, "2004-01-01 00:00", "2004-01-02 00:00", places=120, total=20),
    ]
    t = airport(spark, vlucht=flights)
    assert found(rules.rule06_weight_budget(t), "vluchtnummer", "worst_weight") == [(2, Decimal("2400.00"))]
    assert found(rules.rule06_weight_budget(t, as_written=True), "vluchtnummer") == [(1,), (2,)]


def test_rule07_missing_seats_are_free(spark):
    assert found(rules.rule07_seat_unique(airport(spark)), "stoel") == []
    # As written the two unseated passengers of 5317 already condemn every seated one.
    assert len(found(rules.rule07_seat_unique(airport(spark), as_written=True), *BOOKING)) == 3
    t = airport(spark, **bookings((1002, 5317, 3, at("2004-02-05 22:00"), "75"), (1002, 5316, 1, at("2004-02-01 22:00"), "76")))
    assert found(rules.rule07_seat_unique(t), "vluchtnummer", "stoel", "n_bookings") == [(5317, "75", 2)]


def test_rule08a(spark):
    t = airport(spark, inchecken_voor_vlucht=ROWS["inchecken_voor_vlucht"] + [(2, 5314), (4, 5314), (1, 9999)])
    assert found(rules.rule08a_desk_allowed(t), "balienummer", "vluchtnummer", "not_for_airline", "not_for_destination") == [
        (1, 9999, True, True),
        (2, 5314, False, True),
        (4, 5314, True, True),
    ]


def test_rule08b(spark):
    t = airport(spark, **bookings((850, 5314, 2, None, None), (11, 5314, 3, None, None)))
    assert found(rules.rule08b_booking_desk(t), *BOOKING) == [(850, 5314)]
    assert found(rules.rule08b_booking_desk(t, as_written=True), *BOOKING) == []
    alone = airport(spark, passagier_voor_vlucht=[(850, 5314, 2, None, None), (11, 5314, None, None, None)])
    assert found(rules.rule08b_booking_desk(alone, as_written=True), *BOOKING) == [(11, 5314), (850, 5314)]


def test_rule09(spark):
    t = airport(spark, maatschappij=ROWS["maatschappij"] + [("TT", "MaatschappijTest")])
    assert found(rules.rule09_airline_has_desk(t), "maatschappijcode") == [("TT",)]


def test_rule10(spark):
    # 5321 spans the departure of 5316 and of 5320; 5320 departs at the very moment 5316 arrives.
    t = airport(spark, **bookings((1500, 5316, 1, None, None), (850, 5316, 1, None, None), (850, 5320, 1, None, None)))
    assert found(rules.rule10_overlap(t), *BOOKING) == [(850, 5320), (1500, 5316)]


def test_rule10_missing_times(spark):
    flights = ROWS["vlucht"] + [flight(1, None, "2004-02-02 00:00"), flight(2, "2004-02-02 00:00", None), flight(3, "2004-02-02 01:00", "2004-01-01 00:00")]
    extra = [(1500, n, 1, None, None) for n in (1, 2, 3)]
    t = airport(spark, vlucht=flights, **bookings(*extra))
    # Both depart during 5321; neither lasts, so neither contains the other.
    assert found(rules.rule10_overlap(t), *BOOKING) == [(1500, 2), (1500, 3)]


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "c"), (3, None), (4, None)], "k int, v string")
    assert {(r.k, r.n_rows) for r in keys.pk_duplicates(df, ["k"]).collect()} == {(1, 2), (None, 1)}
    assert {(r.v, r.n_rows) for r in keys.unique_violations(df, "v").collect()} == {("c", 2), (None, 2)}
    assert found(keys.not_null_violations(df, ["k", "v"]), "column_name", "n_null") == [("k", 1), ("v", 2)]
    assert found(keys.not_null_violations(df.limit(0), ["k", "v"]), "column_name") == []
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert found(keys.fk_orphans(df, parent, ["k"], ["id"]), "k") == [(3,), (4,)]
    assert {r.k for r in keys.check_in_list(df, "v", ["a", "b"]).collect()} == {None, 2}


def test_audit_names_the_rule(spark):
    t = airport(
        spark,
        **bookings((850, 5316, 1, at("2004-02-01 20:00"), None), (77, 5316, None, None, None)),
        object=ROWS["object"] + [(3, 850, 5317, 1), (9, 850, 5314, 1)],
    )
    report = {(r.rule, r.table, tuple(sorted(r.key.items()))) for r in audit.audit_all(t).collect()}
    assert report == {
        ("rule01_pair_null", "passagier_voor_vlucht", (("passagiernummer", "850"), ("vluchtnummer", "5316"))),
        ("fk:passagier_voor_vlucht(passagiernummer)->passagier", "passagier_voor_vlucht", (("passagiernummer", "77"), ("vluchtnummer", "5316"))),
        ("pk:object", "object", (("volgnummer", "3"),)),
        ("fk:object(passagiernummer,vluchtnummer)->passagier_voor_vlucht", "object", (("volgnummer", "9"),)),
    }
