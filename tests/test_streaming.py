"""Streams over files, with a replayed batch."""

from __future__ import annotations

from airport import airport, requests

from paxledger.plans.changes import upsert_bookings
from paxledger.session import work_folder
from paxledger.sources.tables import load_tables, write_tables
from paxledger.streaming import bookings as stream

FILES = [
    [(850, 5315, 1, None, None), (1002, 5315, 1, None, None), (11, 5316, 1, None, None)],
    [(1002, 5315, 1, None, None), (11, 5320, 1, None, None), (11, 5316, 1, "2004-02-01 20:00", "7")],
    [(12, 5316, 1, "2004-02-01 20:00", "7"), (850, 5315, 1, "2004-01-31 20:00", "3")],
]


def _source(spark):
    folder = work_folder(spark, "requests")
    for rows in FILES:
        requests(spark, *rows).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_row_rules(spark):
    checked = stream.stream_row_rules(stream.read_requests(spark, _source(spark), 1), airport(spark))
    out = work_folder(spark, "out")
    checked.writeStream.format("parquet").option("path", out).option("checkpointLocation", work_folder(spark, "cp")).trigger(
        availableNow=True
    ).start().awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 8 and rows.where("accepted").count() == 8


def _read(spark, out, kind):
    rows = spark.read.option("basePath", f"{out}/{kind}").parquet(f"{out}/{kind}")
    return sorted((r.batch, r.passagiernummer, r.vluchtnummer, r.stoel) for r in rows.collect())


def test_batches_build_on_each_other_and_replay(spark):
    base, out, folder = write_tables(airport(spark), work_folder(spark, "base")), work_folder(spark, "out"), _source(spark)

    def run():
        source = stream.read_requests(spark, folder, files_per_batch=1)
        stream.stream_admit(source, base, out, work_folder(spark, "cp")).awaitTermination()
        return _read(spark, out, "accepted"), _read(spark, out, "rejected")

    accepted, rejected = run()
    assert len(accepted) + len(rejected) == 8
    assert {b for b, *_ in accepted} | {b for b, *_ in rejected} == {0, 1, 2}
    # One place on 5315; 11 cannot fly 5320 after 5316; seat 7 of 5316 goes to whoever came first.
    booked = stream.current_bookings(load_tables(spark, base)["passagier_voor_vlucht"], stream.accepted_before(spark, out))
    flying = {(r.passagiernummer, r.vluchtnummer): r.stoel for r in booked.collect()}
    assert sum(1 for _, f in flying if f == 5315) == 1
    assert not ((11, 5316) in flying and (11, 5320) in flying)
    assert [s for (_, f), s in flying.items() if f == 5316].count("7") == 1
    # The same files from the start, over the same folders: nothing is added twice.
    assert run() == (accepted, rejected)


def test_later_batches_win(spark):
    t = airport(spark)
    stored = t["passagier_voor_vlucht"]
    one = requests(spark, (13, 5317, 1, "2004-02-05 20:00", "80"))
    two = requests(spark, (13, 5317, 3, None, None))
    from pyspark.sql import functions as F

    both = one.withColumn("batch", F.lit(0)).unionByName(two.withColumn("batch", F.lit(1)))
    got = stream.current_bookings(stored, both)
    step = upsert_bookings(upsert_bookings(stored, one), two)
    assert sorted(map(str, got.collect())) == sorted(map(str, step.select(*got.columns).collect()))


def test_what_a_batch_reads_does_not_grow(spark, monkeypatch):
    """Twenty batches, each of one new booking and one changed: files read stay few, whatever came before."""
    from pyspark.sql import functions as F

    from paxledger.plans.admission import REQUEST

    read = []

    def all_accepted(t, batch):
        read.append(t["passagier_voor_vlucht"].inputFiles())
        return batch.select(*REQUEST, F.lit(True).alias("accepted"), F.array().cast("array<string>").alias("broken"))

    monkeypatch.setattr(stream, "admit_rows", all_accepted)
    base, out, folder = write_tables(airport(spark), work_folder(spark, "base")), work_folder(spark, "out"), work_folder(spark, "in")
    for n in range(20):
        requests(spark, (2000 + n, 5317, 1, None, None), (850, 5317, 3, None, None)).coalesce(1).write.mode("append").parquet(folder)
    stream.stream_admit(stream.read_requests(spark, folder, 1), base, out, work_folder(spark, "cp")).awaitTermination()
    assert len(read) == 20
    assert not any("/accepted/" in f for files in read for f in files)
    assert max(map(len, read)) <= len(read[0]) + 16
    state = stream.booked(spark, base, out)
    assert state.versions() == list(range(21)) and state.read()["passagier_voor_vlucht"].count() == 6 + 20
    # Versions of the past are still there: after four batches there were four new bookings.
    assert state.read(4)["passagier_voor_vlucht"].where("passagiernummer >= 2000").count() == 4


def test_a_desk_added_between_two_batches(spark):
    from paxledger.sources.schema import TABLES
    from paxledger.sources.versions import Edit, Store

    from airport import frame

    store = Store(spark, work_folder(spark, "store"))
    store.create(airport(spark))
    folder, out, progress = (work_folder(spark, n) for n in ("in", "out", "cp"))
    asked = (1002, 5317, 9, None, None)

    def arrive(run):
        requests(spark, asked).coalesce(1).write.mode("append").parquet(folder)
        run(stream.read_requests(spark, folder, 1), store.folder, out, progress).awaitTermination()

    arrive(stream.stream_row_rules_live)
    store.apply(
        [
            Edit("balie", added=frame(spark, [(9,)], TABLES["balie"].schema)),
            Edit("inchecken_voor_vlucht", added=frame(spark, [(9, 5317)], TABLES["inchecken_voor_vlucht"].schema)),
        ]
    )
    arrive(stream.stream_row_rules_live)
    rows = spark.read.option("basePath", f"{out}/checked").parquet(f"{out}/checked")
    assert {r.batch: sorted(r.broken) for r in rows.collect()} == {0: ["fk_balie", "rule08b_booking_desk"], 1: []}


def test_a_settled_table_beside_a_running_batch(spark, monkeypatch):
    """What another thread settles while a batch runs is still there when the batch's folders are deleted."""
    from paxledger.session import settle

    kept = []

    def with_neighbour(t, batch):
        import threading

        worker = threading.Thread(target=lambda: kept.append(settle(spark.range(7).toDF("n"), "neighbour")))
        worker.start()
        worker.join()
        return batch.selectExpr("*", "true AS accepted", "CAST(array() AS array<string>) AS broken")

    monkeypatch.setattr(stream, "admit_rows", with_neighbour)
    base, folder = write_tables(airport(spark), work_folder(spark, "base")), work_folder(spark, "in")
    requests(spark, (2000, 5317, 1, None, None)).coalesce(1).write.parquet(folder)
    stream.stream_admit(stream.read_requests(spark, folder, 1), base, work_folder(spark, "out"), work_folder(spark, "cp")).awaitTermination()
    assert kept[0].count() == 7
