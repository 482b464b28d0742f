"""Registered queries against their SQL, and the shape of their plans.

ORACLE_SF_DIR picks the data (default sf0.001).
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
#: These write tables or run a stream before they return, so their plan is not the whole story.
EAGER = {
    "load_tables", "write_version", "audit_all", "audit_summary", "admit_rows", "admit_statement",
    "admit_statement_as_written", "admit_statement_refused", "admit_statement_accepted", "admit_capacity",
    "admit_capacity_as_written", "stream_row_rules", "stream_admit", "add_baggage", "register_airline", "guard_flight_update",
    "admit_desks", "admit_desks_accepted", "admit_flights", "admit_flights_accepted", "guard_flight_update_as_written", "rule02_changed_booked_flights", "rule02_as_written", "history_all", "delete_cascade",
    "delete_cascade_refused", "rekey_cascade", "rekey_cascade_refused", "load_tables_rows", "write_version_as_of",
    "upsert_touched_files", "remove_baggage_touched_files", "delete_cascade_touched_files", "rekey_swap",
    "rekey_swap_touched_files", "stream_row_rules_live", "as_of_many", "audit_after", "history_all_rows",
    "admit_airports", "admit_destination_desks", "admit_passengers",
}
#: Compared on every run; ORACLE_ALL=1 compares the rest as well.
CORE = {
    "scan_bookings", "write_version", "passenger_search", "booking_detail", "bookings_of_flight", "join_search_chain",
    "scalar_count_join", "global_exists_gate", "flight_load", "duplicate_seats", "scalar_functions", "rule01_pair_null",
    "rule02_changed_booked_flights", "rule03_late_checkin", "rule04_over_capacity", "rule05_baggage_limit",
    "rule06_weight_budget", "rule07_seat_unique", "rule08a_desk_allowed", "rule08b_booking_desk", "rule09_airline_has_desk",
    "rule10_overlap", "pk_duplicates", "fk_orphans", "not_null_violations", "admit_capacity", "admit_desks", "admit_flights_accepted", "admit_rows", "audit_all", "upsert_bookings", "add_baggage",
    "register_airline", "guard_flight_update", "backfill_flights", "delete_cascade", "rekey_cascade", "history_rows",
    "as_of_state", "load_tables_rows", "write_version_as_of", "upsert_touched_files", "delete_cascade_touched_files",
    "rekey_swap_touched_files", "stream_row_rules_live", "as_of_many", "audit_after",
    "admit_airports", "admit_destination_desks", "admit_passengers",
}
COMPARED = [n for n in QUERIES if n in CORE or os.environ.get("ORACLE_ALL")]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", COMPARED)
def test_same_as_sql(spark, con, name):
    assert difference(spark, con, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 35


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_plan_scales(spark, name):
    """No pairing without a key, no window over everything, no Python in the way."""
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        if " Window " in line:
            assert "SinglePartition" not in below


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["passenger_search"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(c_name,00007)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    detail = QUERIES["booking_detail"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,0)" in detail
    assert "l_extendedprice" not in detail
