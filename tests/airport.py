"""A small hand-made airport: every rule has something near it, nothing breaks one."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from paxledger.sources.schema import REQUEST_SCHEMA, TABLES
from paxledger.sources.tables import Tables


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def flight(number, departs, arrives, places=100, total=2500, each="20.00"):
    return (
        number, "C", "KL", "DUB", "Boeing 747", places, Decimal(total), Decimal(each),
        at(departs) if departs else None, at(arrives) if arrives else None,
    )


ROWS = {
    "balie": [(1,), (2,), (3,), (4,)],
    "gate": [("C",)],
    "maatschappij": [("KL", "KLM")],
    "inchecken_bij_maatschappij": [(1, "KL"), (2, "KL"), (3, "KL")],
    "luchthaven": [("DUB", "Dublin", None)],
    "inchecken_voor_bestemming": [(1, "DUB"), (3, "DUB")],
    "vliegtuig": [("Boeing 747",)],
    "vlucht": [
        flight(5314, "2004-03-01 10:00", "2004-03-01 12:00"),
        flight(5315, "2004-02-01 06:00", "2004-02-01 08:00", places=1),
        flight(5316, "2004-02-01 23:00", "2004-02-02 03:00"),
        flight(5317, "2004-02-05 23:00", "2004-02-06 01:00"),
        flight(5320, "2004-02-02 03:00", "2004-02-02 05:00"),
        flight(5321, "2004-02-01 20:00", "2004-02-03 20:00"),
    ],
    "inchecken_voor_vlucht": [(3, 5314), (1, 5315), (1, 5316), (1, 5317), (3, 5317), (1, 5320), (1, 5321)],
    "passagier": [(n, f"Passenger {n}", "M", at("1970-01-01 00:00")) for n in (850, 1002, 1500, 1555, 11, 12, 13, 14)],
    "passagier_voor_vlucht": [
        (850, 5317, 1, at("2004-02-05 20:00"), "75"),
        (11, 5317, 3, at("2004-02-05 20:00"), "76"),
        (12, 5317, 1, at("2004-02-05 20:00"), "77"),
        (13, 5317, None, None, None),
        (14, 5317, None, None, None),
        (1500, 5321, 1, None, None),
    ],
    "object": [(1, 850, 5317, 5), (2, 850, 5317, 10), (3, 11, 5317, 20)],
}


def frame(spark, rows, schema):
    """Rows as a local relation, which Spark plans with its true size."""
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], type=field.type) for i, field in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def airport(spark, **changed) -> Tables:
    rows = {**ROWS, **changed}
    return Tables({n: (lambda n=n: frame(spark, rows[n], TABLES[n].schema)) for n in TABLES})


def requests(spark, *rows):
    """Requests numbered in the order given: (passenger, flight, desk, moment, seat)."""
    return frame(
        spark, [(i, p, f, d, at(m) if m else None, s) for i, (p, f, d, m, s) in enumerate(rows, 1)], REQUEST_SCHEMA
    )


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
