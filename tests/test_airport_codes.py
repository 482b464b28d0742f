"""Airports with new codes: those that flights go to and those that want one code together are refused."""

from __future__ import annotations

import duckdb

from checks import oracle
from checks.compare import difference
from checks.queries import QUERIES

TABLES = {
    "region": "SELECT 0::BIGINT AS r_regionkey, 'R' AS r_name",
    "nation": "SELECT i AS n_nationkey, 'N' || i AS n_name, 0::BIGINT AS n_regionkey FROM range(2) t(i)",
    # Numbers 1 to 110: 1 and 101 end in the same two signs, 11 does so alone.
    "supplier": "SELECT i AS s_suppkey, 'S' || i AS s_name, i % 2 AS s_nationkey FROM range(1, 111) t(i)",
    "part": "SELECT i AS p_partkey, 'B' AS p_brand, CAST(i % 5 + 1 AS INT) AS p_size FROM range(1, 8) t(i)",
    "customer": "SELECT 1::BIGINT AS c_custkey, 'C' AS c_name, 'BUILDING' AS c_mktsegment",
    "orders": """SELECT 1::BIGINT AS o_orderkey, 1::BIGINT AS o_custkey, 'O' AS o_orderstatus, '5-LOW' AS o_orderpriority,
                        TIMESTAMP '2000-01-01' AS o_orderdate""",
    "lineitem": """SELECT 1::BIGINT AS l_orderkey, i AS l_partkey, i AS l_suppkey, CAST(i AS INT) AS l_linenumber, 1.0::DOUBLE AS l_quantity
                   FROM range(1, 8) t(i)""",
    "events": "SELECT 1::BIGINT AS event_id, 'x' AS event_type",
}


def test_codes_wanted_twice_are_refused(spark, tmp_path):
    con = duckdb.connect()
    for name, rows in TABLES.items():
        con.execute(f"COPY ({rows}) TO '{tmp_path}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    rows = {(r.table_name, r.row_key) for r in QUERIES["rekey_cascade_refused"](spark, str(tmp_path)).collect()}
    assert {("refused", "001"), ("refused", "101"), ("luchthaven", "X11")} <= rows
    assert {("whole:luchthaven", "X001"), ("whole:luchthaven", "X101")} <= rows
    assert ("refused", "003") in rows and ("whole:refused", "003") in rows
    assert "rekey_cascade_refused" in oracle.sql()
    assert difference(spark, con, str(tmp_path), "rekey_cascade_refused") is None
