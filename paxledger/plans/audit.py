"""All rules and constraints in one report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxledger.functions.scalars import describe, key_map
from paxledger.operators.joins import BOOKING
from paxledger.plans import keys, rules
from paxledger.sources.schema import FOREIGN_KEYS, TABLES

#: rule -> (function, table it is about, key columns, columns worth showing)
BUSINESS_RULES = {
    "rule01_pair_null": (rules.rule01_pair_null, "passagier_voor_vlucht", BOOKING, ["inchecktijdstip", "stoel"]),
    "rule03_late_checkin": (rules.rule03_late_checkin, "passagier_voor_vlucht", BOOKING, ["inchecktijdstip", "vertrektijdstip"]),
    "rule04_over_capacity": (rules.rule04_over_capacity, "vlucht", ["vluchtnummer"], ["n_bookings", "max_aantal_psgrs"]),
    "rule05_baggage_limit": (rules.rule05_baggage_limit, "passagier_voor_vlucht", BOOKING, ["n_items", "total_weight", "max_ppgewicht"]),
    "rule06_weight_budget": (rules.rule06_weight_budget, "vlucht", ["vluchtnummer"], ["worst_weight", "max_totaalgewicht"]),
    "rule07_seat_unique": (rules.rule07_seat_unique, "passagier_voor_vlucht", ["vluchtnummer", "stoel"], ["n_bookings"]),
    "rule08a_desk_allowed": (
        rules.rule08a_desk_allowed,
        "inchecken_voor_vlucht",
        ["balienummer", "vluchtnummer"],
        ["not_for_airline", "not_for_destination"],
    ),
    "rule08b_booking_desk": (rules.rule08b_booking_desk, "passagier_voor_vlucht", BOOKING, ["balienummer"]),
    "rule09_airline_has_desk": (rules.rule09_airline_has_desk, "maatschappij", ["maatschappijcode"], ["naam"]),
    "rule10_overlap": (rules.rule10_overlap, "passagier_voor_vlucht", BOOKING, ["vertrektijdstip", "aankomsttijdstip"]),
}

REQUIRED = {name: spec.required for name, spec in TABLES.items()}


def _report(rule: str, table: str, df: DataFrame, key: list[str], shown: list[str]) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"),
        F.lit(table).alias("table"),
        key_map(*key).alias("key"),
        describe(**{c: F.col(c) for c in shown}).alias("detail"),
    )


def rule_reports(t: Mapping[str, DataFrame], only: list[str] | None = None) -> dict[str, DataFrame]:
    """Violations of the business rules, or of some, by rule, all in the same four columns."""
    asked = {n: BUSINESS_RULES[n] for n in (BUSINESS_RULES if only is None else only)}
    return {name: _report(name, table, check(t), key, shown) for name, (check, table, key, shown) in asked.items()}


def table_reports(t: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Violations of NOT NULL and of the foreign keys of one table, in one pass over it.

    Each parent comes as its distinct keys, so a parent row that is stored twice doubles nothing.
    """
    spec, rows = TABLES[name], t[name]
    required = REQUIRED[name]
    found = [(f"not_null:{name}", reduce(Column.__or__, [F.col(c).isNull() for c in required]), required)]
    for i, fk in enumerate(k for k in FOREIGN_KEYS if k.child == name):
        names = [f"_{i}_{p}" for p in fk.parent_columns]
        parents = t[fk.parent].select(*[F.col(p).alias(n) for p, n in zip(fk.parent_columns, names)]).distinct()
        rows = rows.join(parents.withColumn(f"_{i}", F.lit(True)), [F.col(c) == F.col(n) for c, n in zip(fk.columns, names)], "left")
        given = reduce(Column.__and__, [F.col(c).isNotNull() for c in fk.columns])
        found.append((f"fk:{fk.name}", given & F.col(f"_{i}").isNull(), list(fk.columns)))
    lines = [
        F.when(
            broken,
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(name).alias("table"),
                key_map(*spec.key).alias("key"),
                describe(**{c: F.col(c) for c in shown}).alias("detail"),
            ),
        )
        for rule, broken, shown in found
    ]
    return rows.select(F.inline(F.array_compact(F.array(*lines))))


def group_reports(t: Mapping[str, DataFrame], only: list[str] | None = None) -> list[DataFrame]:
    """Violations of primary and unique keys, of all tables or of some."""
    found = []
    for name, spec in TABLES.items():
        if only is not None and name not in only:
            continue
        found.append(_report(f"pk:{name}", name, keys.pk_duplicates(t[name], list(spec.key)), list(spec.key), ["n_rows"]))
        for column in spec.unique:
            found.append(_report(f"unique:{name}.{column}", name, keys.unique_violations(t[name], column), [column], ["n_rows"]))
    return found


def rule_names(with_changes: bool = False) -> list[str]:
    """Every rule and constraint that a report can name."""
    tables = [(n, s) for n, s in TABLES.items()]
    return [
        *BUSINESS_RULES,
        *(["rule02_changed_booked_flights"] if with_changes else []),
        *[f"pk:{n}" for n, _ in tables],
        *[f"unique:{n}.{c}" for n, s in tables for c in s.unique],
        *[f"not_null:{n}" for n, _ in tables],
        *[f"fk:{fk.name}" for fk in FOREIGN_KEYS],
    ]


def audit_all(t: Mapping[str, DataFrame], before: DataFrame | None = None) -> DataFrame:
    """Every violation of every rule and constraint. Give it stored tables (``load_tables``): each of its branches
    reads its own columns of them. Rule 2 is about a change: it takes part if ``before``, the flights as they
    were, is given."""
    parts = [*rule_reports(t).values(), *group_reports(t), *[table_reports(t, name) for name in TABLES]]
    if before is not None:
        changed = rules.rule02_changed_booked_flights(before, t["vlucht"], t["passagier_voor_vlucht"])
        parts.append(_report("rule02_changed_booked_flights", "vlucht", changed, ["vluchtnummer"], ["changed"]))
    return reduce(DataFrame.unionByName, parts)


def audit_summary(t: Mapping[str, DataFrame], before: DataFrame | None = None, report: DataFrame | None = None) -> DataFrame:
    """Number of violations per rule and constraint, 0 where there are none: counts over ``report``, a result of
    ``audit_all`` for the same tables, or over one made here."""
    lines = audit_all(t, before) if report is None else report
    counts = lines.groupBy("rule").agg(F.count("*").alias("_n"))
    names = lines.sparkSession.createDataFrame([(n,) for n in rule_names(before is not None)], "rule string")
    return names.join(counts, "rule", "left").select("rule", F.coalesce("_n", F.lit(0)).alias("n_violations"))
