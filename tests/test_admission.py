"""Admission against one-at-a-time models on many random cases, packed side by side into one batch."""

from __future__ import annotations

import random
from collections import defaultdict

from airport import ROWS, airport, at, flight, found, frame, requests
from pyspark.sql import functions as F

from paxledger.operators import graph
from paxledger.plans import admission, rules
from paxledger.plans.changes import upsert_bookings
from paxledger.sources.schema import REQUEST_SCHEMA, TABLES

BOOKING = ("passagiernummer", "vluchtnummer")


def verdicts(df):
    return {r.seq: ",".join(r.broken) for r in df.collect()}


def test_each_rule_refuses_its_own(spark):
    t = airport(spark)
    batch = requests(
        spark,
        (850, 5315, 1, None, None),  # takes the only place
        (1002, 5315, 1, None, None),  # none left
        (850, 5316, 1, "2004-02-01 22:25", None),  # moment without seat
        (1002, 5317, 3, "2004-02-05 22:00", "20"),
        (1555, 5317, 3, "2004-02-05 22:00", "75"),  # taken in the stored bookings
        (1500, 5317, 3, "2004-02-05 22:00", "20"),  # taken by request 4
        (1555, 5316, 1, "2004-02-01 23:00", "97"),  # checks in at departure
        (1555, 5316, 3, "2004-02-01 12:00", "97"),  # desk of another flight
        (1500, 5316, 1, "2004-02-01 12:00", "3"),  # already flying 5321
        (11, 5316, 1, None, None),
        (11, 5320, 1, None, None),  # departs as request 10 arrives
        (850, 5317, 1, "2004-02-05 22:00", "75"),  # an update that keeps its seat
        (77, 5316, 5, None, None),  # unknown passenger and desk
        (850, 9999, None, None, None),  # unknown flight
        (1002, 5317, 3, "2004-02-05 22:10", "20"),  # request 4 again
    )
    assert verdicts(admission.admit_rows(t, batch)) == {
        1: "",
        2: "rule04_over_capacity",
        3: "rule01_pair_null",
        4: "",
        5: "rule07_seat_unique",
        6: "rule07_seat_unique",
        7: "rule03_late_checkin",
        8: "rule08b_booking_desk",
        9: "rule10_overlap",
        10: "",
        11: "rule10_overlap",
        12: "",
        13: "fk_passagier,fk_balie,rule08b_booking_desk",
        14: "fk_vlucht",
        15: "",
    }


def _random_cases(cases, seed):
    """Flights, stored bookings and requests of small worlds that share no flight and no passenger."""
    rng = random.Random(seed)
    flights, stored, asked = [], [], []
    for case in range(cases):
        numbers = [case * 10 + i for i in range(5)]
        for n in numbers:
            start = rng.randint(0, 20)
            end = start + rng.randint(0, 5)
            flights.append(flight(n, f"2004-01-{start + 1:02} 00:00", f"2004-01-{end + 1:02} 00:00", places=rng.randint(0, 4)))
        for person in range(case * 10, case * 10 + 4):
            for n in numbers:
                if rng.random() < 0.15:
                    stored.append((person, n, None, None, None))
            for _ in range(rng.randint(0, 4)):
                seat = rng.choice(["1", "2", None])
                asked.append((person, rng.choice(numbers), None, at("2003-12-31 00:00") if seat else None, seat))
    held = {(f, s) for _, f, _, _, s in stored}
    assert held
    seated = set()
    for i, (p, f, d, _, _) in enumerate(stored):
        seat = rng.choice(["1", "2", None])
        if seat and (f, seat) not in seated:
            seated.add((f, seat))
            stored[i] = (p, f, d, at("2003-12-31 00:00"), seat)
    rng.shuffle(asked)
    return flights, stored, [(i + 1, *r) for i, r in enumerate(asked)]


def _world(spark, cases, seed):
    flights, stored, asked = _random_cases(cases, seed)
    people = [(n, str(n), "M", at("1970-01-01 00:00")) for n in range(cases * 10)]
    t = airport(spark, vlucht=flights, passagier_voor_vlucht=stored, passagier=people)
    return t, frame(spark, asked, REQUEST_SCHEMA), flights, stored, asked


def _capacity_model(flights, stored, asked, as_written):
    places = {f[0]: f[5] for f in flights}
    held = {(p, f) for p, f, *_ in stored}
    accepted = {}
    for seq, p, f, *_ in asked:
        room = places[f] > sum(1 for q, g in held if g == f)
        accepted[seq] = room or (not as_written and (p, f) in held)
        if accepted[seq]:
            held.add((p, f))
    return accepted


def test_capacity_matches_one_at_a_time(spark):
    t, batch, flights, stored, asked = _world(spark, 150, seed=1)
    for as_written in (False, True):
        got = admission.admit_capacity(t["vlucht"], t["passagier_voor_vlucht"], batch, as_written)
        assert {r.seq: r.accepted for r in got.collect()} == _capacity_model(flights, stored, asked, as_written)


def test_capacity_unknown_flight(spark):
    t = airport(spark)
    got = admission.admit_capacity(t["vlucht"], t["passagier_voor_vlucht"], requests(spark, (850, 9999, None, None, None)))
    assert [r.accepted for r in got.collect()] == [False]


def _one_at_a_time(flights, stored, asked):
    """Requests in order against the bookings as they stand."""
    spans = {f[0]: (f[8], max(f[8], f[9])) for f in flights}
    places = {f[0]: f[5] for f in flights}
    held = {(p, f): s for p, f, _, _, s in stored}
    meets = lambda f, g: f != g and spans[f][0] <= spans[g][1] and spans[g][0] <= spans[f][1]
    out = {}
    for seq, p, f, _, _, s in asked:
        reasons = []
        if s and any(g == f and t == s and q != p for (q, g), t in held.items()):
            reasons.append("rule07_seat_unique")
        if any(q == p and meets(g, f) for q, g in held):
            reasons.append("rule10_overlap")
        if (p, f) not in held and sum(g == f for _, g in held) >= places[f]:
            reasons.append("rule04_over_capacity")
        out[seq] = ",".join(reasons)
        if not reasons:
            held[p, f] = s
    return out


def test_rows_match_one_at_a_time_and_break_nothing_new(spark):
    t, batch, flights, stored, asked = _world(spark, 160, seed=2)
    decided = admission.admit_rows(t, batch).cache()
    got = verdicts(decided)
    assert got == _one_at_a_time(flights, stored, asked)
    assert {"", "rule07_seat_unique", "rule10_overlap", "rule04_over_capacity"} <= set(got.values())
    assert {r.seq for r in decided.where("accepted").collect()} == {s for s, b in got.items() if not b}
    assert decided.count() == len(asked)

    after = t.replacing(passagier_voor_vlucht=upsert_bookings(t["passagier_voor_vlucht"], decided.where("accepted")))
    for rule, columns in (
        (rules.rule04_over_capacity, ["vluchtnummer"]),
        (rules.rule07_seat_unique, ["vluchtnummer", "stoel"]),
        (rules.rule10_overlap, list(BOOKING)),
    ):
        before, now = set(found(rule(t), *columns)), set(found(rule(after), *columns))
        assert now <= before


def test_nothing_is_refused_over_a_refused_request(spark):
    """Flight 5321 meets 5316 and 5320; a seat asked for in vain stays free, one given up becomes free."""
    t = airport(spark)
    batch = requests(
        spark,
        (11, 5316, 1, None, None),
        (11, 5321, 1, "2004-02-01 12:00", "9"),  # refused: meets 5316
        (12, 5321, 1, "2004-02-01 12:00", "9"),  # the seat is still free
        (850, 5317, 1, "2004-02-05 20:00", "80 "),  # leaves seat 75
        (1002, 5317, 1, "2004-02-05 20:00", "75"),
        (1555, 5317, 1, "2004-02-05 20:00", "75  "),
        (None, 5317, None, None, None),
    )
    assert verdicts(admission.admit_rows(t, batch)) == {
        1: "", 2: "rule10_overlap", 3: "", 4: "", 5: "", 6: "rule07_seat_unique", 7: "not_null,fk_passagier",
    }


def test_statement_is_all_or_nothing(spark):
    t = airport(spark)
    good = requests(spark, (1002, 5317, 3, "2004-02-05 22:00", "20"), (850, 5316, 1, None, None))
    done = admission.admit_statement(t, good)
    assert found(done.violations, "rule") == [] and done.accepted.count() == 2
    mixed = requests(spark, (1002, 5317, 3, "2004-02-05 22:00", "75"), (850, 5316, 1, None, None))
    done = admission.admit_statement(t, mixed)
    assert found(done.violations, "rule", *BOOKING) == [("rule07_seat_unique", 1002, 5317)]
    assert done.accepted.count() == 0
    # The seat is no obstacle where the rule is left out.
    assert admission.admit_statement(t, mixed, ["rule10_overlap"]).accepted.count() == 2


def test_statement_as_written(spark):
    t = airport(spark)
    # Two unseated passengers on 5317 stop any seated booking; one valid desk excuses another.
    batch = requests(spark, (1002, 5316, 1, "2004-02-01 22:00", "20"), (850, 5316, 3, None, None))
    done = admission.admit_statement(t, batch, as_written=True)
    assert found(done.violations, "rule", *BOOKING) == [("rule07_seat_unique", 1002, 5316)]
    assert found(admission.admit_statement(t, batch).violations, "rule", *BOOKING) == [("rule08b_booking_desk", 850, 5316)]
    # A new flight that starts first and runs into a stored one is missed as written.
    early = requests(spark, (1500, 5316, 1, None, None))
    later = t.replacing(
        passagier_voor_vlucht=t["passagier_voor_vlucht"].where("vluchtnummer != 5321").unionByName(
            spark.createDataFrame([(1500, 5320, 1, None, None)], t["passagier_voor_vlucht"].schema)
        )
    )
    names = ["rule10_overlap"]
    assert admission.admit_statement(later, early, names, as_written=True).accepted.count() == 1
    assert admission.admit_statement(later, early, names).accepted.count() == 0


def test_stored_violations_elsewhere_do_not_stop_a_statement(spark):
    t = airport(spark, passagier_voor_vlucht=ROWS["passagier_voor_vlucht"] + [(1555, 5316, 3, None, "1")])
    done = admission.admit_statement(t, requests(spark, (850, 5316, 1, None, None)))
    assert done.violations.where(F.col("passagiernummer") == 1555).count() == 0
    assert done.accepted.count() == 1


def _chain(spark, n):
    """Everyone on a flight moves to the seat of the one who moved just before."""
    people = [(k, f"P{k}", "M", ROWS["passagier"][0][3]) for k in range(n)]
    moment = ROWS["passagier_voor_vlucht"][0][3]
    stored = [(k, 5314, 3, moment, f"{k:03d}") for k in range(n)]
    t = airport(spark, passagier=people, passagier_voor_vlucht=stored, vlucht=[flight(5314, "2004-03-01 10:00", "2004-03-01 12:00", places=2000)])
    asked = [(k, 5314, 3, "2004-02-05 20:00", f"{k - 1:03d}" if k else "X00") for k in range(n)]
    # Whoever asks for a seat that isn't free yet is refused.
    return t, requests(spark, *asked, (n - 1, 5314, 3, "2004-02-05 20:00", "001"), (5, 5314, 3, "2004-02-05 20:00", f"{n - 1:03d}"))


def test_a_chain_takes_no_more_turns_than_its_logarithm(spark, monkeypatch):
    turns = {}
    plain = admission.settle
    for n in (20, 500):
        made = []
        monkeypatch.setattr(admission, "settle", lambda df, label, made=made: made.append(label) or plain(df, label))
        monkeypatch.setattr(graph, "settle", lambda df, label, made=made: made.append(label) or plain(df, label))
        t, batch = _chain(spark, n)
        got = verdicts(admission.admit_rows(t, batch))
        assert got == {**{k: "" for k in range(1, n + 1)}, n + 1: "rule07_seat_unique", n + 2: ""}
        turns[n] = made
    assert turns[500].count("judged") == 1
    # Five doublings of the length: a few turns more to find what hangs together, nothing else.
    assert len(turns[500]) <= len(turns[20]) + 14
    assert [x for x in turns[500] if not x.startswith("ties")] == [x for x in turns[20] if not x.startswith("ties")]


def test_contests_too_large_are_taken_up_again(spark):
    t, batch, flights, stored, asked = _world(spark, 24, seed=5)
    want = _one_at_a_time(flights, stored, asked)
    assert verdicts(admission.admit_rows(t, batch, limit=9)) == want


def test_linked(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(60), rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("01")) for _ in range(70)]
    rows += [(100 + i, f"k{i}") for i in range(40)] + [(101 + i, f"k{i}") for i in range(40)] + [(200, None)]
    got = {r.node: r.component for r in graph.linked(spark.createDataFrame(rows, "node long, key string")).collect()}
    want = {n: n for n, k in rows if k is not None}
    while True:
        of_key = {}
        for n, k in rows:
            if k is not None:
                of_key[k] = min(of_key.get(k, 10**9), want[n])
        after = {n: min(of_key[k] for m, k in rows if m == n and k is not None) for n in want}
        if after == want:
            break
        want = after
    assert got == want


def _judge(spark, table, *rows):
    t = airport(spark)
    made = admission.admit_table(t, table, frame(spark, list(rows), TABLES[table].schema))
    return found(made.violations, "rule", *TABLES[table].key), made.accepted.count()


def test_new_rows_of_plain_tables_are_taken_whole(spark):
    assert _judge(spark, "luchthaven", ("AMS", "Schiphol", None), ("CDG", "Roissy", "F")) == ([], 2)
    assert _judge(spark, "passagier", (1, "A", "M", at("1970-01-01 00:00"))) == ([], 1)
    assert _judge(spark, "inchecken_bij_maatschappij", (4, "KL")) == ([], 1)
    assert _judge(spark, "luchthaven") == ([], 0)


def test_keys_and_names_of_plain_tables_are_unique(spark):
    assert _judge(spark, "luchthaven", ("DUB", "Other", None), ("AMS", "Schiphol", None)) == ([("pk", "DUB")], 0)
    assert _judge(spark, "luchthaven", ("AMS", "Dublin", None)) == ([("unique_naam", "AMS")], 0)
    twins = ("AMS", "Twin", None), ("CDG", "Twin", None), ("LHR", "Heathrow", None)
    assert _judge(spark, "luchthaven", *twins) == ([("unique_naam", "AMS"), ("unique_naam", "CDG")], 0)
    # A row given three times over breaks each rule once; a code with blanks is the stored one.
    assert _judge(spark, "maatschappij", *[("KL ", "KLM")] * 3) == ([("pk", "KL"), ("unique_naam", "KL")], 0)
    assert _judge(spark, "balie", (4,), (5,), (5,)) == ([("pk", 4), ("pk", 5)], 0)


def test_missing_values_and_parents_of_plain_tables(spark):
    assert _judge(spark, "luchthaven", ("AMS", None, None), ("CDG", None, None)) == ([("not_null", "AMS"), ("not_null", "CDG")], 0)
    assert _judge(spark, "gate", (None,)) == ([("not_null", None)], 0)
    wrong = (9, "KL"), (4, "TT"), (1, "KL")
    assert _judge(spark, "inchecken_bij_maatschappij", *wrong) == ([("fk_balie", 9, "KL"), ("fk_maatschappij", 4, "TT"), ("pk", 1, "KL")], 0)
