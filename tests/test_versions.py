"""Versions of tables: what a change rewrites, what readers see, permutations of keys."""

from __future__ import annotations

import random
import threading

import pytest
from airport import ROWS, airport, at, frame, requests
from pyspark.sql import functions as F

from paxledger.plans import changes
from paxledger.plans.cascade import delete_cascade, rekey_cascade
from paxledger.session import scratch, settle, work_folder
from paxledger.sources.schema import TABLES
from paxledger.sources.tables import write_tables
from paxledger.sources.versions import Edit, Outdated, Store, current

BOOKING = ["passagiernummer", "vluchtnummer"]


def many_bookings(spark, flights=50, each=20):
    rows = [(p, f, None, None, None) for f in range(flights) for p in range(each)]
    return frame(spark, rows, TABLES["passagier_voor_vlucht"].schema)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def stored(spark, tables, **options):
    store = Store(spark, work_folder(spark, "store"))
    assert store.create(tables, **options) == 0
    return store


def places(store, table, version=None):
    return {r.file: r.n_rows for r in store.files(version).where(F.col("table") == table).collect() if r.file}


def test_a_batch_rewrites_the_files_it_touches(spark):
    bookings = many_bookings(spark)
    store = stored(spark, {"passagier_voor_vlucht": bookings}, by={"passagier_voor_vlucht": ["vluchtnummer"]}, files=50)
    before = places(store, "passagier_voor_vlucht")
    assert len(before) == 50
    held = store.read()["passagier_voor_vlucht"]
    (one,) = held.where("vluchtnummer = 7 AND passagiernummer = 3").select("_metadata.file_path").collect()
    batch = requests(spark, (3, 7, 1, "2004-02-05 20:00", "80"))
    assert store.apply([changes.upsert_edit(batch)]) == 1
    after = places(store, "passagier_voor_vlucht")
    assert {one.file_path.rpartition("/")[2]} == {f.rpartition("/")[2] for f in set(before) - set(after)}
    assert len(set(after) - set(before)) == 1
    assert rows_of(store.read()["passagier_voor_vlucht"]) == rows_of(changes.upsert_bookings(bookings, batch))
    assert rows_of(store.read(0)["passagier_voor_vlucht"]) == rows_of(bookings)


def test_new_rows_alone_rewrite_nothing(spark):
    store = stored(spark, {"passagier_voor_vlucht": many_bookings(spark)}, by={"passagier_voor_vlucht": ["vluchtnummer"]}, files=10)
    before = places(store, "passagier_voor_vlucht")
    store.apply([changes.upsert_edit(requests(spark, (999, 7, None, None, None)))])
    after = places(store, "passagier_voor_vlucht")
    assert set(before) < set(after) and sum(after.values()) == 1001


def test_removing_nothing_writes_no_files(spark):
    store = stored(spark, airport(spark))
    before = places(store, "object")
    store.apply([changes.remove_baggage_edit(spark.createDataFrame([(77,)], "volgnummer long"))])
    assert places(store, "object") == before and store.versions() == [0, 1]


def test_small_files_are_written_together(spark):
    store = stored(spark, {"passagier_voor_vlucht": many_bookings(spark)}, by={"passagier_voor_vlucht": ["vluchtnummer"]}, files=5)
    for n in range(25):
        store.apply([changes.upsert_edit(requests(spark, (1000 + n, 7, None, None, None)))])
    assert len(places(store, "passagier_voor_vlucht")) < 20
    assert store.read()["passagier_voor_vlucht"].count() == 1025


def test_a_broken_off_change_leaves_the_version_before(spark, monkeypatch):
    store = stored(spark, airport(spark))
    rows = rows_of(store.read()["object"])

    def stop(*_):
        raise RuntimeError("power cut")

    monkeypatch.setattr(Store, "_switch", stop)
    with pytest.raises(RuntimeError):
        store.apply([changes.remove_baggage_edit(spark.createDataFrame([(1,)], "volgnummer long"))])
    monkeypatch.undo()
    assert store.versions() == [0] and rows_of(store.read()["object"]) == rows
    # The files that it left are named by no list, and the same change goes through later.
    assert store.apply([changes.remove_baggage_edit(spark.createDataFrame([(1,)], "volgnummer long"))]) == 1
    assert rows_of(store.read()["object"]) == [r for r in rows if r[0] != 1]


def test_the_second_of_two_changes_of_one_version_fails(spark):
    store = stored(spark, airport(spark))
    gone = lambda n: [changes.remove_baggage_edit(spark.createDataFrame([(n,)], "volgnummer long"))]
    store.apply(gone(1), version=0)
    with pytest.raises(Outdated):
        store.apply(gone(2), version=0)
    with pytest.raises(Outdated):
        store._switch(store.files(0), 1)
    assert sorted(r.volgnummer for r in store.read()["object"].collect()) == [2, 3]


def test_a_reader_keeps_its_version_and_empty_tables_have_one(spark):
    store = stored(spark, airport(spark, object=[]))
    held = store.read()
    assert held["object"].count() == 0 and held["object"].columns == TABLES["object"].names
    store.apply([Edit("object", added=frame(spark, [(5, 850, 5317, 7)], TABLES["object"].schema))])
    assert held["object"].count() == 0 and store.read()["object"].count() == 1
    store.apply([changes.remove_baggage_edit(spark.createDataFrame([(5,)], "volgnummer long"))])
    assert store.read()["object"].count() == 0 and store.read(1)["object"].count() == 1


def test_adopted_tables_are_not_copied(spark):
    base = write_tables(airport(spark), work_folder(spark, "base"))
    store = Store(spark, work_folder(spark, "adopted"))
    store.adopt({n: f"{base}/{n}" for n in TABLES})
    assert all(r.place.startswith("file:") for r in store.files().where("place IS NOT NULL").collect())
    for n in TABLES:
        assert rows_of(store.read()[n]) == rows_of(airport(spark)[n])
    assert set(current(spark, base)) == set(current(spark, store.folder)) == set(TABLES)


def test_rewinding(spark):
    store = stored(spark, airport(spark))
    for n in (1, 2):
        store.apply([changes.remove_baggage_edit(spark.createDataFrame([(n,)], "volgnummer long"))])
    store.rewind(1)
    assert store.versions() == [0, 1] and store.read()["object"].count() == 2


@pytest.mark.parametrize("table, key", [("passagier", 850), ("vlucht", 5320), ("balie", 2)])
def test_deleting_through_versions(spark, table, key):
    store = stored(spark, airport(spark))
    t = store.read()
    name = TABLES[table].key[0]
    done = delete_cascade(t, table, t[table].where(F.col(name) == key).select(name))
    want = {n: rows_of(df) for n, df in done.tables.items()}
    store.apply(done.edits)
    after = store.read()
    assert {n: rows_of(after[n]) for n in want} == want
    assert all(rows_of(after[n]) == rows_of(t[n]) for n in TABLES if n not in want)


# --- permutations of keys ---


def rekeyed(spark, pairs, **tables):
    t = airport(spark, **tables)
    return rekey_cascade(t, "balie", spark.createDataFrame(pairs, "balienummer int, new_balienummer int"))


def test_a_swap_and_a_cycle(spark):
    done = rekeyed(spark, [(1, 2), (2, 3), (3, 1)])
    turn = {1: 2, 2: 3, 3: 1}
    assert done.refused.count() == 0
    for n in ("balie", "inchecken_bij_maatschappij", "inchecken_voor_bestemming", "inchecken_voor_vlucht"):
        want = sorted((turn.get(r[0], r[0]), *r[1:]) for r in ROWS[n])
        assert sorted(map(tuple, done.tables[n].collect())) == want
    booked = {(r.passagiernummer, r.vluchtnummer): r.balienummer for r in done.tables["passagier_voor_vlucht"].collect()}
    assert booked == {(r[0], r[1]): turn.get(r[2], r[2]) for r in ROWS["passagier_voor_vlucht"]}


def test_a_swap_through_versions(spark):
    store = stored(spark, airport(spark))
    done = rekey_cascade(store.read(), "balie", spark.createDataFrame([(1, 3), (3, 1)], "balienummer int, new_balienummer int"))
    want = {n: rows_of(df) for n, df in done.tables.items()}
    store.apply(done.edits)
    assert {n: rows_of(store.read()[n]) for n in want} == want


def settled_renames(held, pairs):
    """Refused keys, by letting refusals spread until nothing changes."""
    olds, news = [a for a, _ in pairs], [b for _, b in pairs]
    refused = {a for a, b in pairs if olds.count(a) > 1 or news.count(b) > 1}
    moving = {a for a, b in pairs if a != b}
    while True:
        more = {a for a, b in pairs if a != b and b in held and (b not in moving or b in refused)}
        if more <= refused:
            return refused
        refused |= more


def test_renames_at_random(spark):
    rng = random.Random(9)
    for _ in range(6):
        held = set(rng.sample(range(40), 25))
        pairs = list({(rng.randrange(44), rng.randrange(44)) for _ in range(14)})
        # Some chains that end at a key that stays, and some that don't.
        line = rng.sample(sorted(held), 9)
        pairs = list(dict.fromkeys([*pairs, *zip(line, line[1:])]))
        done = rekeyed(spark, pairs, balie=[(n,) for n in held])
        refused = settled_renames(held, pairs)
        assert {r[0] for r in done.refused.collect()} == refused
        to = {a: b for a, b in pairs if a not in refused}
        after = sorted(r[0] for r in done.tables["balie"].collect())
        assert after == sorted(to.get(n, n) for n in held) and len(set(after)) == len(after)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    from paxledger.plans import cascade

    made = []
    plain = cascade.settle
    monkeypatch.setattr(cascade, "settle", lambda df, label: made.append(label) or plain(df, label))
    n = 300
    done = rekeyed(spark, [(i, i + 1) for i in range(n)], balie=[(i,) for i in range(n + 1)])
    assert done.refused.count() == n  # the last of them stays where it is
    assert made.count("rekey-met") <= 12


# --- work folders of threads ---


def test_scratch_leaves_other_threads_alone(spark):
    inside, written = threading.Event(), threading.Event()
    kept = {}

    def other():
        inside.wait()
        kept["table"] = settle(spark.range(5).toDF("n"), "other")
        written.set()

    worker = threading.Thread(target=other)
    worker.start()
    with scratch(spark):
        mine = settle(spark.range(3).toDF("n"), "mine")
        inside.set()
        written.wait()
        with scratch(spark):
            pass
        late = settle(spark.range(2).toDF("n"), "late")
    worker.join()
    assert kept["table"].count() == 5
    for gone in (mine, late):
        with pytest.raises(Exception, match="(?i)not.exist"):
            gone.collect()


def test_moments_survive(spark):
    """Timestamps and decimals come back as they were."""
    store = stored(spark, airport(spark))
    assert rows_of(store.read()["vlucht"]) == rows_of(airport(spark)["vlucht"])
    assert store.read()["passagier_voor_vlucht"].where(F.col("inchecktijdstip") == F.lit(at("2004-02-05 20:00"))).count() == 3


def test_names_of_files_are_taken_once_a_file(spark):
    store = stored(spark, {"passagier_voor_vlucht": many_bookings(spark)}, by={"passagier_voor_vlucht": ["vluchtnummer"]}, files=10)
    one = requests(spark, (3, 7, None, None, None)).select(*BOOKING)
    met = store.touched(Edit("passagier_voor_vlucht", one, tuple(BOOKING)))
    listed = store._listed("passagier_voor_vlucht", store.folder + "/data/passagier_voor_vlucht/*", own=True)
    for rows in (met, listed):
        # Text is cut where paths are grouped already: no line below the last grouping does it.
        plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
        last = max(i for i, line in enumerate(plan) if "Aggregate" in line)
        assert not any("regexp" in line or "substring_index" in line for line in plan[last + 1 :])
    names = {r.file for r in listed.collect() if r.file}
    assert names == set(places(store, "passagier_voor_vlucht"))
    assert {r.file for r in met.collect()} < names and met.count() == 1
