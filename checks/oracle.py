"""The same queries in SQL, over the same driver tables.

Named parts below are put in front of a query as WITH parts, only those it needs. They are written
without regard to speed: pairs are joined to pairs where the Spark side counts or ranks.
"""

from __future__ import annotations

import re

from checks.queries import AS_OF, DESK, FIRST_CHANGE, FIRST_DESKS, FLIGHT, MOMENTS, PASSENGER, SEARCH, SECOND_CHANGE
from paxledger.sources.schema import FOREIGN_KEYS, TABLES

def _padded(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {width}, '0') END"


PARTS: dict[str, str] = {
    # --- projection ---
    "booking_src": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, min(l_partkey) AS fl, min(l_suppkey) AS su
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority""",
    "requests": """
        SELECT o_orderkey AS seq, o_custkey AS passagiernummer, fl AS vluchtnummer,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(1 + su % 50 AS INT) END AS balienummer,
               CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS inchecktijdstip,
               CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT' THEN NULL
                    ELSE lpad(CAST(o_orderkey % 60 AS VARCHAR), 3, '0') END AS stoel,
               o_orderstatus AS status
        FROM booking_src""",
    "passagier_voor_vlucht": """
        SELECT passagiernummer, vluchtnummer, min(balienummer) AS balienummer, min(inchecktijdstip) AS inchecktijdstip,
               min(stoel) AS stoel
        FROM requests GROUP BY passagiernummer, vluchtnummer""",
    "handled": """
        SELECT passagiernummer, vluchtnummer, min(balienummer) AS balienummer, min(inchecktijdstip) AS inchecktijdstip,
               min(stoel) AS stoel
        FROM requests WHERE status = 'F' GROUP BY passagiernummer, vluchtnummer""",
    "object": """
        SELECT l_orderkey * 8 + l_linenumber AS volgnummer, o_custkey AS passagiernummer, fl AS vluchtnummer,
               CAST(l_quantity AS INT) AS gewicht
        FROM lineitem JOIN booking_src ON l_orderkey = o_orderkey""",
    "parts": """
        SELECT *, p_partkey % (SELECT count(*) FROM nation) AS airline, p_partkey % (SELECT count(*) FROM supplier) AS d FROM part""",
    "vlucht": f"""
        SELECT p_partkey AS vluchtnummer, chr(CAST(65 + p_partkey % 5 AS INT)) AS gatecode,
               {_padded("airline", 2)} AS maatschappijcode, {_padded("(d - d % 3)", 3)} AS luchthavencode,
               p_brand AS vliegtuigtype, p_size AS max_aantal_psgrs,
               CAST(2500 AS DECIMAL(5,0)) AS max_totaalgewicht, CAST(60 + p_partkey % 60 AS DECIMAL(5,2)) AS max_ppgewicht,
               TIMESTAMP '1998-01-01' + to_days(CAST((p_partkey * 37) % 1400 AS INT)) AS vertrektijdstip,
               TIMESTAMP '1998-01-01' + to_days(CAST((p_partkey * 37) % 1400 AS INT))
                   + to_days(CAST(1 + p_partkey % 7 AS INT)) AS aankomsttijdstip
        FROM parts""",
    "passagier": """
        SELECT c_custkey AS passagiernummer, c_name AS naam, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'V' END AS geslacht,
               TIMESTAMP '1950-01-01' + to_days(CAST(c_custkey % 20000 AS INT)) AS geboortedatum
        FROM customer""",
    "balie": "SELECT DISTINCT p_size AS balienummer FROM part",
    "gate": "SELECT chr(65 + r_regionkey) AS gatecode FROM region",
    "maatschappij": "SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS maatschappijcode, n_name AS naam FROM nation",
    "luchthaven": f"""
        SELECT {_padded("s_suppkey", 3)} AS luchthavencode, s_name AS naam, n_name AS land
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "vliegtuig": "SELECT DISTINCT p_brand AS vliegtuigtype FROM part",
    "desk_lines": """
        SELECT DISTINCT CAST(1 + (l_suppkey + l_linenumber) % 50 AS INT) AS desk, l_partkey,
               l_partkey % (SELECT count(*) FROM nation) AS airline, l_partkey % (SELECT count(*) FROM supplier) AS d FROM lineitem""",
    "inchecken_bij_maatschappij": f"""
        SELECT DISTINCT desk AS balienummer, {_padded("airline", 2)} AS maatschappijcode FROM desk_lines
        WHERE (desk + airline) % 4 <> 0 AND airline IN
              (SELECT n_nationkey FROM nation WHERE n_name <> (SELECT max(n_name) FROM nation))""",
    "inchecken_voor_bestemming": f"""
        SELECT DISTINCT desk AS balienummer, {_padded("(d - d % 3)", 3)} AS luchthavencode FROM desk_lines
        WHERE (desk + d - d % 3) % 4 <> 0""",
    "inchecken_voor_vlucht": """
        SELECT DISTINCT CAST(1 + (l_suppkey + l_linenumber) % 50 AS INT) AS balienummer, l_partkey AS vluchtnummer FROM lineitem""",
    "airport_rows": """
        SELECT CASE WHEN CAST(luchthavencode AS INT) % 4 = 0 THEN luchthavencode WHEN CAST(luchthavencode AS INT) % 7 = 0 THEN 'NNN'
                    ELSE 'N' || luchthavencode END AS luchthavencode,
               CASE CAST(luchthavencode AS INT) % 5 WHEN 0 THEN naam WHEN 1 THEN 'Twin ' || CAST(CAST(luchthavencode AS INT) // 10 AS VARCHAR)
                    WHEN 2 THEN NULL ELSE 'New ' || naam END AS naam
        FROM luchthaven""",
    "passenger_rows": """
        SELECT CASE WHEN passagiernummer % 7 = 0 THEN passagiernummer WHEN passagiernummer % 13 = 0 THEN 2000000000 + passagiernummer // 26
                    ELSE 1000000000 + passagiernummer END AS passagiernummer,
               CASE WHEN passagiernummer % 11 <> 0 THEN naam END AS naam
        FROM passagier""",
    # --- rules ---
    "trips": """
        SELECT passagiernummer, vluchtnummer, vertrektijdstip, aankomsttijdstip
        FROM passagier_voor_vlucht JOIN vlucht USING (vluchtnummer)""",
    "rule01_pair_null": """
        SELECT passagiernummer, vluchtnummer, balienummer, inchecktijdstip, stoel FROM passagier_voor_vlucht
        WHERE (inchecktijdstip IS NULL AND stoel IS NOT NULL) OR (inchecktijdstip IS NOT NULL AND stoel IS NULL)""",
    "rule03_late_checkin": """
        SELECT passagiernummer, vluchtnummer, inchecktijdstip, vertrektijdstip
        FROM passagier_voor_vlucht JOIN vlucht USING (vluchtnummer) WHERE inchecktijdstip >= vertrektijdstip""",
    "flight_load": """
        SELECT vluchtnummer, max_aantal_psgrs, count(*) AS n_bookings
        FROM passagier_voor_vlucht JOIN vlucht USING (vluchtnummer) GROUP BY vluchtnummer, max_aantal_psgrs""",
    "rule04_over_capacity": "SELECT * FROM flight_load WHERE n_bookings > max_aantal_psgrs",
    "rule05_baggage_limit": """
        SELECT passagiernummer, vluchtnummer, n_items, total_weight, max_ppgewicht, n_items > 3 AS too_many,
               coalesce(total_weight > max_ppgewicht, false) AS too_heavy
        FROM (SELECT passagiernummer, vluchtnummer, count(*) AS n_items, CAST(sum(gewicht) AS BIGINT) AS total_weight
              FROM object GROUP BY passagiernummer, vluchtnummer) LEFT JOIN vlucht USING (vluchtnummer)
        WHERE n_items > 3 OR total_weight > max_ppgewicht""",
    "rule06_weight_budget": """
        SELECT vluchtnummer, max_aantal_psgrs, max_ppgewicht, max_totaalgewicht,
               CAST(max_aantal_psgrs * max_ppgewicht AS DECIMAL(18,2)) AS worst_weight
        FROM vlucht WHERE max_aantal_psgrs * max_ppgewicht > max_totaalgewicht""",
    "rule07_seat_unique": """
        SELECT vluchtnummer, stoel, count(*) AS n_bookings FROM passagier_voor_vlucht WHERE stoel IS NOT NULL
        GROUP BY vluchtnummer, stoel HAVING count(*) >= 2""",
    "rule08a_desk_allowed": """
        SELECT balienummer, vluchtnummer,
               NOT EXISTS (SELECT 1 FROM vlucht v JOIN inchecken_bij_maatschappij b USING (maatschappijcode)
                           WHERE v.vluchtnummer = i.vluchtnummer AND b.balienummer = i.balienummer) AS not_for_airline,
               NOT EXISTS (SELECT 1 FROM vlucht v JOIN inchecken_voor_bestemming b USING (luchthavencode)
                           WHERE v.vluchtnummer = i.vluchtnummer AND b.balienummer = i.balienummer) AS not_for_destination
        FROM inchecken_voor_vlucht i
        WHERE NOT EXISTS (SELECT 1 FROM vlucht v JOIN inchecken_bij_maatschappij b USING (maatschappijcode)
                          WHERE v.vluchtnummer = i.vluchtnummer AND b.balienummer = i.balienummer)
           OR NOT EXISTS (SELECT 1 FROM vlucht v JOIN inchecken_voor_bestemming b USING (luchthavencode)
                          WHERE v.vluchtnummer = i.vluchtnummer AND b.balienummer = i.balienummer)""",
    "rule08b_booking_desk": """
        SELECT passagiernummer, vluchtnummer, balienummer FROM passagier_voor_vlucht p
        WHERE balienummer IS NOT NULL AND NOT EXISTS (SELECT 1 FROM inchecken_voor_vlucht i
              WHERE i.vluchtnummer = p.vluchtnummer AND i.balienummer = p.balienummer)""",
    "rule09_airline_has_desk": """
        SELECT maatschappijcode, naam FROM maatschappij
        WHERE maatschappijcode NOT IN (SELECT maatschappijcode FROM inchecken_bij_maatschappij)""",
    "rule10_overlap": """
        SELECT passagiernummer, vluchtnummer, vertrektijdstip, aankomsttijdstip FROM trips a
        WHERE EXISTS (SELECT 1 FROM trips b WHERE b.passagiernummer = a.passagiernummer AND b.vluchtnummer <> a.vluchtnummer
                      AND a.vertrektijdstip BETWEEN b.vertrektijdstip AND b.aankomsttijdstip)""",
    # --- changes ---
    "flight_updates": """
        SELECT p_partkey AS vluchtnummer, chr(CAST(65 + (p_partkey + p_size) % 5 AS INT)) AS new_gate,
               CASE WHEN p_size < 10 THEN p_size + 18 END AS new_places
        FROM part""",
    "flight_changes": """
        SELECT vluchtnummer, gatecode, max_aantal_psgrs, new_gate, new_places, new_gate IS DISTINCT FROM gatecode AS gate_differs,
               new_places IS NOT NULL AND new_places <> max_aantal_psgrs AS places_differ,
               coalesce(new_places, max_aantal_psgrs) * max_ppgewicht - max_totaalgewicht
                 > greatest(max_aantal_psgrs * max_ppgewicht - max_totaalgewicht, 0) AS worse,
               vluchtnummer IN (SELECT vluchtnummer FROM passagier_voor_vlucht) AS booked
        FROM vlucht JOIN flight_updates USING (vluchtnummer)""",
    "gaps": """
        SELECT * REPLACE (CASE WHEN max_aantal_psgrs > 5 THEN vertrektijdstip END AS vertrektijdstip,
                          CASE WHEN max_aantal_psgrs > 2 AND max_aantal_psgrs < 46 THEN aankomsttijdstip END AS aankomsttijdstip)
        FROM vlucht""",
    "airline_requests": """
        SELECT s_suppkey AS seq, CAST(s_suppkey % 60 + 1 AS INT) AS balienummer,
               lpad(CAST(s_suppkey % 40 AS VARCHAR), 2, '0') AS maatschappijcode,
               CASE WHEN s_suppkey % 7 = 0 THEN n_name ELSE 'Air ' || CAST(s_suppkey % 30 AS VARCHAR) END AS naam
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "airline_new": """
        SELECT *, concat_ws(',', CASE WHEN balienummer NOT IN (SELECT balienummer FROM balie) THEN 'fk_desk' END,
                            CASE WHEN maatschappijcode IN (SELECT maatschappijcode FROM maatschappij) THEN 'pk_airline' END,
                            CASE WHEN naam IN (SELECT naam FROM maatschappij) THEN 'unique_name' END) AS reason
        FROM airline_requests""",
    "airline_fit": "SELECT *, row_number() OVER (ORDER BY seq) AS i FROM airline_new WHERE reason = ''",
    "airline_steps": """
        SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, CAST([] AS VARCHAR[]) AS codes, CAST([] AS VARCHAR[]) AS names, false AS ok
        UNION ALL
        SELECT f.i, f.seq,
               CASE WHEN list_contains(codes, maatschappijcode) OR list_contains(names, naam) THEN codes ELSE list_append(codes, maatschappijcode) END,
               CASE WHEN list_contains(codes, maatschappijcode) OR list_contains(names, naam) THEN names ELSE list_append(names, naam) END,
               NOT (list_contains(codes, maatschappijcode) OR list_contains(names, naam))
        FROM airline_steps s JOIN airline_fit f ON f.i = s.i + 1""",
    "airline_taken": "SELECT f.* FROM airline_fit f JOIN airline_steps s ON s.seq = f.seq WHERE s.ok",
    "airline_decided": """
        SELECT seq, balienummer, maatschappijcode, naam,
               concat_ws(',', CASE WHEN balienummer NOT IN (SELECT balienummer FROM balie) THEN 'fk_desk' END,
                 CASE WHEN maatschappijcode IN (SELECT maatschappijcode FROM maatschappij) OR EXISTS (SELECT 1 FROM airline_taken a
                      WHERE a.maatschappijcode = r.maatschappijcode AND a.seq < r.seq) THEN 'pk_airline' END,
                 CASE WHEN naam IN (SELECT naam FROM maatschappij) OR EXISTS (SELECT 1 FROM airline_taken a
                      WHERE a.naam = r.naam AND a.seq < r.seq) THEN 'unique_name' END) AS reason
        FROM airline_requests r""",
    "last_requests": """
        SELECT passagiernummer, vluchtnummer, balienummer, inchecktijdstip, stoel FROM requests
        QUALIFY row_number() OVER (PARTITION BY passagiernummer, vluchtnummer ORDER BY seq DESC) = 1""",
    "after_upsert": """
        SELECT * FROM last_requests UNION ALL SELECT * FROM handled h WHERE NOT EXISTS (SELECT 1 FROM last_requests l
        WHERE l.passagiernummer = h.passagiernummer AND l.vluchtnummer = h.vluchtnummer)""",
    "segment": "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'",
    "items": """
        SELECT l_orderkey * 8 + l_linenumber AS seq, o_custkey AS passagiernummer, fl AS vluchtnummer, CAST(sum(l_quantity) AS INT) AS gewicht
        FROM lineitem JOIN booking_src ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_linenumber, o_custkey, fl""",
    "items_booked": """
        SELECT i.*, row_number() OVER (PARTITION BY i.passagiernummer, i.vluchtnummer ORDER BY i.seq) AS nr
        FROM items i SEMI JOIN handled USING (passagiernummer, vluchtnummer)""",
    "baggage_steps": """
        SELECT passagiernummer, vluchtnummer, CAST(0 AS BIGINT) AS nr, CAST(NULL AS BIGINT) AS seq, CAST(coalesce(n_items, 0) AS BIGINT) AS n,
               CAST(coalesce(total_weight, 0) AS BIGINT) AS w, max_ppgewicht AS most, false AS ok
        FROM (SELECT DISTINCT passagiernummer, vluchtnummer FROM items_booked)
        LEFT JOIN (SELECT passagiernummer, vluchtnummer, count(*) AS n_items, sum(gewicht) AS total_weight FROM object
                   WHERE gewicht <= 2 GROUP BY ALL) USING (passagiernummer, vluchtnummer)
        LEFT JOIN vlucht USING (vluchtnummer)
        UNION ALL
        SELECT passagiernummer, vluchtnummer, k.nr, k.seq, CASE WHEN s.n < 3 AND s.w + k.gewicht <= s.most THEN s.n + 1 ELSE s.n END,
               CASE WHEN s.n < 3 AND s.w + k.gewicht <= s.most THEN s.w + k.gewicht ELSE s.w END, s.most, s.n < 3 AND s.w + k.gewicht <= s.most
        FROM baggage_steps s JOIN items_booked k USING (passagiernummer, vluchtnummer) WHERE k.nr = s.nr + 1""",
    # --- admission ---
    "checked": """
        SELECT r.seq, r.passagiernummer, r.vluchtnummer, r.balienummer, r.inchecktijdstip, r.stoel,
               v.vertrektijdstip AS dep, greatest(v.vertrektijdstip, v.aankomsttijdstip) AS arr, v.max_aantal_psgrs AS places,
               concat_ws(',',
                 CASE WHEN r.passagiernummer NOT IN (SELECT passagiernummer FROM passagier) THEN 'fk_passagier' END,
                 CASE WHEN v.vluchtnummer IS NULL THEN 'fk_vlucht' END,
                 CASE WHEN r.balienummer IS NOT NULL AND r.balienummer NOT IN (SELECT balienummer FROM balie) THEN 'fk_balie' END,
                 CASE WHEN (r.inchecktijdstip IS NULL) <> (r.stoel IS NULL) THEN 'rule01_pair_null' END,
                 CASE WHEN r.inchecktijdstip >= v.vertrektijdstip THEN 'rule03_late_checkin' END,
                 CASE WHEN r.balienummer IS NOT NULL AND i.balienummer IS NULL THEN 'rule08b_booking_desk' END) AS broken
        FROM requests r LEFT JOIN vlucht v USING (vluchtnummer)
        LEFT JOIN inchecken_voor_vlucht i ON i.vluchtnummer = r.vluchtnummer AND i.balienummer = r.balienummer""",
    "clean": "SELECT *, row_number() OVER (ORDER BY seq) AS i FROM checked WHERE broken = ''",
    "admit_steps": """
        SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, (SELECT list({'p': passagiernummer, 'f': vluchtnummer, 's': stoel,
                 'dep': vertrektijdstip, 'arr': greatest(vertrektijdstip, aankomsttijdstip)}) FROM handled JOIN vlucht USING (vluchtnummer)) AS held,
               false AS seat_bad, false AS time_bad, false AS room_bad
        UNION ALL
        SELECT i, seq, CASE WHEN seat_bad OR time_bad OR room_bad THEN held
                 ELSE list_append(list_filter(held, lambda h: h.p <> p OR h.f <> f), {'p': p, 'f': f, 's': s, 'dep': dep, 'arr': arr}) END,
               seat_bad, time_bad, room_bad
        FROM (SELECT c.i, c.seq, t.held, c.passagiernummer AS p, c.vluchtnummer AS f, c.stoel AS s, c.dep, c.arr,
                coalesce(len(list_filter(t.held, lambda h: h.f = c.vluchtnummer AND h.s = c.stoel AND h.p <> c.passagiernummer)) > 0, false) AS seat_bad,
                len(list_filter(t.held, lambda h: h.p = c.passagiernummer AND h.f <> c.vluchtnummer AND h.dep <= c.arr AND c.dep <= h.arr)) > 0 AS time_bad,
                len(list_filter(t.held, lambda h: h.p = c.passagiernummer AND h.f = c.vluchtnummer)) = 0
                  AND len(list_filter(t.held, lambda h: h.f = c.vluchtnummer)) >= c.places AS room_bad
              FROM admit_steps t JOIN clean c ON c.i = t.i + 1)""",
    "admitted": """
        SELECT c.seq, c.passagiernummer, c.vluchtnummer, c.broken = '' AND NOT seat_bad AND NOT time_bad AND NOT room_bad AS accepted,
               CASE WHEN c.broken <> '' THEN c.broken ELSE concat_ws(',', CASE WHEN seat_bad THEN 'rule07_seat_unique' END,
                 CASE WHEN time_bad THEN 'rule10_overlap' END, CASE WHEN room_bad THEN 'rule04_over_capacity' END) END AS broken
        FROM checked c LEFT JOIN admit_steps a ON a.seq = c.seq""",
    "handled_counts": "SELECT vluchtnummer, count(*) AS taken FROM handled GROUP BY vluchtnummer",
    "arrivals": """
        SELECT r.seq, r.passagiernummer, r.vluchtnummer, max_aantal_psgrs AS places, coalesce(taken, 0) AS taken,
               h.passagiernummer IS NOT NULL AS stored,
               min(r.seq) OVER (PARTITION BY r.passagiernummer, r.vluchtnummer) AS first_seq
        FROM requests r LEFT JOIN vlucht USING (vluchtnummer) LEFT JOIN handled_counts USING (vluchtnummer)
        LEFT JOIN handled h ON h.passagiernummer = r.passagiernummer AND h.vluchtnummer = r.vluchtnummer""",
    "newcomers": "SELECT vluchtnummer, seq FROM arrivals WHERE NOT stored AND seq = first_seq",
    "after_trips": """
        SELECT passagiernummer, vluchtnummer, vertrektijdstip AS dep, aankomsttijdstip AS arr
        FROM after_upsert JOIN vlucht USING (vluchtnummer)""",
    "touched": "SELECT * FROM last_requests",
    "statement_plain": """
        SELECT 'rule01_pair_null' AS rule, passagiernummer, vluchtnummer FROM touched
        WHERE (inchecktijdstip IS NULL) <> (stoel IS NULL)
        UNION ALL SELECT 'rule03_late_checkin', passagiernummer, vluchtnummer FROM touched JOIN vlucht USING (vluchtnummer)
        WHERE inchecktijdstip >= vertrektijdstip
        UNION ALL SELECT 'rule04_over_capacity', passagiernummer, vluchtnummer FROM touched WHERE vluchtnummer IN
              (SELECT vluchtnummer FROM after_upsert JOIN vlucht USING (vluchtnummer)
               GROUP BY vluchtnummer, max_aantal_psgrs HAVING count(*) > max_aantal_psgrs)
        UNION ALL SELECT 'fk_passagier', passagiernummer, vluchtnummer FROM touched
        WHERE passagiernummer NOT IN (SELECT passagiernummer FROM passagier)
        UNION ALL SELECT 'fk_vlucht', passagiernummer, vluchtnummer FROM touched
        WHERE vluchtnummer NOT IN (SELECT vluchtnummer FROM vlucht)
        UNION ALL SELECT 'fk_balie', passagiernummer, vluchtnummer FROM touched
        WHERE balienummer IS NOT NULL AND balienummer NOT IN (SELECT balienummer FROM balie)""",
    "desk_requests": "SELECT CAST(balienummer % 50 + 1 AS INT) AS balienummer, vluchtnummer FROM inchecken_voor_vlucht",
    "desk_judged": """
        SELECT r.*, EXISTS (SELECT 1 FROM inchecken_bij_maatschappij b WHERE b.balienummer = r.balienummer AND b.maatschappijcode = v.maatschappijcode)
            AND EXISTS (SELECT 1 FROM inchecken_voor_bestemming b WHERE b.balienummer = r.balienummer AND b.luchthavencode = v.luchthavencode) AS fits,
          v.vluchtnummer IS NOT NULL AS flies, r.balienummer IN (SELECT balienummer FROM balie) AS stands
        FROM desk_requests r LEFT JOIN vlucht v ON v.vluchtnummer = r.vluchtnummer""",
    "flight_rows": """
        SELECT * REPLACE (chr(CAST(65 + (vluchtnummer + max_aantal_psgrs) % 6 AS INT)) AS gatecode,
                          CAST(max_aantal_psgrs + vluchtnummer % 2 AS INT) AS max_aantal_psgrs) FROM vlucht""",
    # --- history ---
    "second": """
        SELECT * REPLACE (CASE WHEN passagiernummer % 13 = 0 THEN 1 ELSE balienummer END AS balienummer)
        FROM passagier_voor_vlucht WHERE passagiernummer % 17 <> 0""",
    "object_unique": """
        SELECT volgnummer, min(passagiernummer) AS passagiernummer, min(vluchtnummer) AS vluchtnummer,
               CAST(sum(gewicht) AS INT) AS gewicht FROM object GROUP BY volgnummer""",
    "flights_after": """
        SELECT vluchtnummer, CASE WHEN booked AND (gate_differs OR places_differ) OR worse THEN gatecode ELSE new_gate END AS gatecode,
               CASE WHEN booked AND (gate_differs OR places_differ) OR worse THEN max_aantal_psgrs
                    ELSE coalesce(new_places, max_aantal_psgrs) END AS max_aantal_psgrs
        FROM flight_changes""",
}


def with_parts(query: str, changed: dict[str, str] | None = None) -> str:
    """The query with the parts it names, directly or through other parts, in order of need. A ``changed`` part is what
    its SQL says of the part as it was, there called ``before_<part>``."""
    order: list[str] = []
    asked: set[str] = set()

    def need(sql: str) -> None:
        for name in PARTS:
            if name not in asked and re.search(rf"\b{name}\b", re.sub(r"'[^']*'", "", sql)):
                asked.add(name)
                need(PARTS[name])
                order.append(name)

    need(query)
    if not order:
        return query
    parts = []
    for name in order:
        if changed and name in changed:
            parts += [f"before_{name} AS ({PARTS[name]})", f"{name} AS ({changed[name]})"]
        else:
            parts.append(f"{name} AS ({PARTS[name]})")
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + query


def _scan(table: str) -> str:
    return f"SELECT {', '.join(TABLES[table].names)} FROM {table}"


def _keys(table: str, source: str | None = None, columns: list[str] | None = None) -> str:
    parts = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in columns or TABLES[table].key)
    return f"SELECT '{table}' AS table_name, {parts} AS row_key FROM {source or table}"


def _search(condition: str) -> str:
    return f"""
        SELECT passagiernummer, naam, vluchtnummer, i.balienummer FROM passagier
        JOIN passagier_voor_vlucht USING (passagiernummer) JOIN inchecken_voor_vlucht i USING (vluchtnummer)
        WHERE {condition} AND i.balienummer = {DESK}"""


def _detail(*columns: str) -> str:
    return " || ' ' || ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'null')" for c in columns)


def _row_key(columns: tuple[str, ...] | list[str]) -> str:
    return " || ',' || ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'null')" for c in columns)


_BOOKING = ("passagiernummer", "vluchtnummer")
_RULE_REPORTS = {
    "rule01_pair_null": ("passagier_voor_vlucht", _BOOKING, ("inchecktijdstip", "stoel")),
    "rule03_late_checkin": ("passagier_voor_vlucht", _BOOKING, ("inchecktijdstip", "vertrektijdstip")),
    "rule04_over_capacity": ("vlucht", ("vluchtnummer",), ("n_bookings", "max_aantal_psgrs")),
    "rule05_baggage_limit": ("passagier_voor_vlucht", _BOOKING, ("n_items", "total_weight", "max_ppgewicht")),
    "rule06_weight_budget": ("vlucht", ("vluchtnummer",), ("worst_weight", "max_totaalgewicht")),
    "rule07_seat_unique": ("passagier_voor_vlucht", ("vluchtnummer", "stoel"), ("n_bookings",)),
    "rule08a_desk_allowed": ("inchecken_voor_vlucht", ("balienummer", "vluchtnummer"), ("not_for_airline", "not_for_destination")),
    "rule08b_booking_desk": ("passagier_voor_vlucht", _BOOKING, ("balienummer",)),
    "rule09_airline_has_desk": ("maatschappij", ("maatschappijcode",), ("naam",)),
    "rule10_overlap": ("passagier_voor_vlucht", _BOOKING, ("vertrektijdstip", "aankomsttijdstip")),
}


def _report(rule: str, table: str, key, shown, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, {_row_key(key)} AS row_key, {_detail(*shown)} AS detail FROM {source}"
    )


def _orphans(fk) -> str:
    pairs = " AND ".join(f"p.{p} = c.{c}" for p, c in zip(fk.parent_columns, fk.columns))
    full = " AND ".join(f"c.{c} IS NOT NULL" for c in fk.columns)
    return f"(SELECT * FROM {fk.child} c WHERE {full} AND NOT EXISTS (SELECT 1 FROM {fk.parent} p WHERE {pairs}))"


def _audit_parts() -> dict[str, str]:
    parts = {rule: _report(rule, table, key, shown, rule) for rule, (table, key, shown) in _RULE_REPORTS.items()}
    for name, spec in TABLES.items():
        keys = ", ".join(spec.key)
        no_key = " OR ".join(f"{c} IS NULL" for c in spec.key)
        doubles = f"(SELECT {keys}, count(*) AS n_rows FROM {name} GROUP BY {keys} HAVING count(*) > 1 OR {no_key})"
        parts[f"pk:{name}"] = _report(f"pk:{name}", name, spec.key, ("n_rows",), doubles)
        for column in spec.unique:
            doubles = f"(SELECT {column}, count(*) AS n_rows FROM {name} GROUP BY {column} HAVING count(*) > 1)"
            parts[f"unique:{name}.{column}"] = _report(f"unique:{name}.{column}", name, (column,), ("n_rows",), doubles)
        missing = " OR ".join(f"{c} IS NULL" for c in spec.required)
        source = f"(SELECT * FROM {name} WHERE {missing})"
        parts[f"not_null:{name}"] = _report(f"not_null:{name}", name, spec.key, spec.required, source)
    for fk in FOREIGN_KEYS:
        parts[f"fk:{fk.name}"] = _report(f"fk:{fk.name}", fk.child, TABLES[fk.child].key, fk.columns, _orphans(fk))
    return parts


def _union(*queries: str) -> str:
    return "\nUNION ALL ".join(queries)


def _backfill(start: str) -> str:
    return f"""
        SELECT * REPLACE (CAST(CASE WHEN max_aantal_psgrs * max_ppgewicht > max_totaalgewicht THEN 9000
                                    ELSE max_totaalgewicht END AS DECIMAL(5,0)) AS max_totaalgewicht,
                          coalesce(vertrektijdstip, TIMESTAMP '{AS_OF}' - to_days(1)) AS vertrektijdstip,
                          coalesce(aankomsttijdstip, {start} + to_days(1)) AS aankomsttijdstip)
        FROM gaps"""


def _guard(barred: str) -> str:
    return f"""
        SELECT 'flight' AS kind, vluchtnummer, CASE WHEN {barred} OR worse THEN gatecode ELSE new_gate END AS gatecode,
               CASE WHEN {barred} OR worse THEN max_aantal_psgrs ELSE coalesce(new_places, max_aantal_psgrs) END AS max_aantal_psgrs, '' AS broken
        FROM flight_changes
        UNION ALL SELECT 'refused', vluchtnummer, new_gate, new_places,
               concat_ws(',', CASE WHEN {barred} THEN 'rule02_changed_booked_flights' END, CASE WHEN worse THEN 'rule06_weight_budget' END)
        FROM flight_changes WHERE {barred} OR worse"""


def _history(before: str, after: str, keys: list[str], values: list[str], moment: str, columns: str) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    differs = " OR ".join(f"a.{v} IS DISTINCT FROM b.{v}" for v in values)
    return f"""
        SELECT {columns}, TIMESTAMP '{moment}' AS "timestamp", CASE WHEN a.{keys[0]} IS NULL THEN 'delete' ELSE 'update' END AS actie
        FROM {before} b LEFT JOIN {after} a ON {on} WHERE a.{keys[0]} IS NULL OR {differs}"""


_PVV_VALUES = ["balienummer", "inchecktijdstip", "stoel"]
_SEATED = "SELECT passagiernummer, vluchtnummer, stoel FROM passagier_voor_vlucht WHERE stoel IS NOT NULL"
_ADMITTED = "SELECT seq, passagiernummer, vluchtnummer, accepted, broken FROM admitted"

def _old_row(table: str, alias: str, action: str) -> str:
    """A history row as text: all its values, the moment and the action."""
    parts = [f"coalesce(CAST({alias}.{c} AS VARCHAR), 'null')" for c in TABLES[table].names]
    return f"'{table}' AS table_name, " + " || '|' || ".join([*parts, f"'{AS_OF}'", action]) + " AS row_text"


_TURNED = _union(
    *[
        _keys(n, f"(SELECT * REPLACE (balienummer - balienummer % 3 + (balienummer + 1) % 3 AS balienummer) FROM {n})", columns)
        for n, columns in (
            ("balie", None),
            ("inchecken_bij_maatschappij", None),
            ("inchecken_voor_bestemming", None),
            ("inchecken_voor_vlucht", None),
            ("passagier_voor_vlucht", [*_BOOKING, "balienummer"]),
        )
    ]
)

QUERY_SQL: dict[str, str] = {
    "load_tables": _union(*[f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TABLES]),
    "scan_desks": _scan("balie"),
    "scan_flights": _scan("vlucht"),
    "scan_bookings": _scan("passagier_voor_vlucht"),
    "scan_passengers": _scan("passagier"),
    "scan_desk_flights": _scan("inchecken_voor_vlucht"),
    "scan_desk_airlines": _scan("inchecken_bij_maatschappij"),
    "scan_desk_airports": _scan("inchecken_voor_bestemming"),
    "write_version": _scan("vlucht"),
    "load_tables_rows": _union(*[_keys(n, None, TABLES[n].names) for n in TABLES]),
    "write_version_as_of": "SELECT * FROM second",
    "passenger_search": _search(f"naam LIKE '%{SEARCH}%'"),
    "passenger_search_literal": _search("contains(naam, '#0000000')").replace("naam, vlucht", "replace(naam, '#', '%') AS naam, vlucht"),
    "passenger_search_wildcards": _search("naam LIKE '%0%7_%'"),
    "passenger_search_ignore_case": _search("naam ILIKE '%cUSTOMER#0000000%'"),
    "baggage_of_booking": f"{_scan('object')} WHERE passagiernummer = {PASSENGER} AND vluchtnummer = {FLIGHT}",
    "booking_detail": f"""
        SELECT passagiernummer, naam, geslacht, geboortedatum, vluchtnummer, balienummer, inchecktijdstip, stoel
        FROM passagier JOIN passagier_voor_vlucht USING (passagiernummer)
        WHERE passagiernummer = {PASSENGER} AND vluchtnummer = {FLIGHT}""",
    "booking_detail_all": f"""
        SELECT passagiernummer, naam, geslacht, geboortedatum, vluchtnummer, balienummer, inchecktijdstip, stoel
        FROM passagier JOIN passagier_voor_vlucht USING (passagiernummer) WHERE passagiernummer = {PASSENGER}""",
    "bookings_of_flight": f"""
        SELECT p.* FROM vlucht v JOIN passagier_voor_vlucht p ON p.vluchtnummer = v.vluchtnummer WHERE v.vluchtnummer = {FLIGHT}""",
    "join_booking_flight": """
        SELECT passagiernummer, vluchtnummer, balienummer, inchecktijdstip, stoel, max_aantal_psgrs, vertrektijdstip, aankomsttijdstip
        FROM passagier_voor_vlucht JOIN vlucht USING (vluchtnummer)""",
    "join_search_chain": """
        SELECT passagiernummer, naam, vluchtnummer, i.balienummer FROM passagier
        JOIN passagier_voor_vlucht USING (passagiernummer) JOIN inchecken_voor_vlucht i USING (vluchtnummer)""",
    "join_late_checkin": "SELECT * FROM rule03_late_checkin",
    "semi_flights_with_bookings": """
        SELECT vluchtnummer, gatecode, maatschappijcode, luchthavencode, vliegtuigtype FROM vlucht
        WHERE vluchtnummer IN (SELECT vluchtnummer FROM passagier_voor_vlucht)""",
    "anti_desk_allowed": "SELECT * FROM rule08a_desk_allowed",
    "anti_desk_of_flight": "SELECT * FROM rule08b_booking_desk",
    "interval_overlap": "SELECT * FROM rule10_overlap",
    "scalar_count_join": """
        SELECT vluchtnummer, max_aantal_psgrs, (SELECT count(*) FROM passagier_voor_vlucht p
               WHERE p.vluchtnummer = v.vluchtnummer) AS n_bookings FROM vlucht v""",
    "global_exists_gate": f"{_SEATED} AND EXISTS (SELECT 1 FROM rule07_seat_unique)",
    "flight_load": "SELECT * FROM flight_load",
    "baggage_over_count": """
        SELECT passagiernummer, vluchtnummer, count(*) AS n_items FROM object GROUP BY ALL HAVING count(*) > 3""",
    "baggage_over_weight": """
        SELECT passagiernummer, vluchtnummer, max_ppgewicht, CAST(sum(gewicht) AS BIGINT) AS total_weight
        FROM object JOIN vlucht USING (vluchtnummer) GROUP BY passagiernummer, vluchtnummer, max_ppgewicht
        HAVING sum(gewicht) > max_ppgewicht""",
    "baggage_limit_combined": "SELECT * FROM rule05_baggage_limit",
    "duplicate_seats": """
        SELECT vluchtnummer, stoel, count(*) AS n_bookings FROM passagier_voor_vlucht GROUP BY vluchtnummer, stoel HAVING count(*) >= 2""",
    "desks_per_airline": """
        SELECT maatschappijcode, naam, coalesce((SELECT count(*) FROM inchecken_bij_maatschappij b
               WHERE b.maatschappijcode = m.maatschappijcode), 0) AS n_desks FROM maatschappij m""",
    "scalar_functions": """
        SELECT vluchtnummer, aankomsttijdstip + to_days(30) AS month_later,
               CAST(year(aankomsttijdstip + to_days(30)) - year(vertrektijdstip) AS INT) AS new_years,
               CASE WHEN max_aantal_psgrs > 10 THEN max_aantal_psgrs ELSE 0 END AS large_or_zero, gatecode AS gate,
               luchthavencode || '/' || CAST(vluchtnummer AS VARCHAR) AS label, epoch_us(aankomsttijdstip) AS arrival_micros
        FROM vlucht""",
    **{name: f"SELECT * FROM {name}" for name in _RULE_REPORTS},
    "rule02_changed_booked_flights": """
        SELECT vluchtnummer, concat_ws(',', CASE WHEN gate_differs THEN 'gatecode' END,
                                       CASE WHEN places_differ THEN 'max_aantal_psgrs' END) AS changed
        FROM flight_changes WHERE booked AND (gate_differs OR places_differ) AND NOT worse""",
    "rule02_as_written": "SELECT vluchtnummer FROM flight_changes WHERE booked",
    "rule03_as_written": """
        SELECT passagiernummer, vluchtnummer, inchecktijdstip, vertrektijdstip
        FROM passagier_voor_vlucht JOIN vlucht USING (vluchtnummer) WHERE inchecktijdstip < vertrektijdstip""",
    "rule04_as_written": "SELECT * FROM flight_load",
    "rule06_as_written": """
        SELECT vluchtnummer, max_aantal_psgrs, max_ppgewicht, max_totaalgewicht,
               CAST(max_aantal_psgrs * max_ppgewicht AS DECIMAL(18,2)) AS worst_weight
        FROM vlucht WHERE max_aantal_psgrs * max_ppgewicht >= max_totaalgewicht""",
    "rule07_as_written": f"""
        {_SEATED} AND EXISTS (SELECT 1 FROM passagier_voor_vlucht GROUP BY vluchtnummer, stoel HAVING count(*) >= 2)""",
    "rule08b_as_written": """
        SELECT passagiernummer, vluchtnummer, balienummer FROM passagier_voor_vlucht
        WHERE NOT EXISTS (SELECT 1 FROM passagier_voor_vlucht JOIN inchecken_voor_vlucht USING (vluchtnummer, balienummer))""",
    "pk_duplicates": "SELECT volgnummer, count(*) AS n_rows FROM object GROUP BY volgnummer HAVING count(*) > 1",
    "unique_violations": _union(
        *[
            f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n_rows FROM luchthaven GROUP BY {c} HAVING count(*) > 1"
            for c in ("naam", "land")
        ]
    ),
    "fk_orphans": "SELECT * FROM passagier_voor_vlucht WHERE passagiernummer IN (SELECT c_custkey FROM segment)",
    "fk_orphan_counts": _union(
        *[f"SELECT '{fk.name}' AS foreign_key, count(*) AS n_orphans FROM {_orphans(fk)}" for fk in FOREIGN_KEYS]
    ),
    "not_null_violations": "SELECT * FROM ("
    + _union(
        *[
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM gaps"
            for c in TABLES["vlucht"].required
        ]
    )
    + ") WHERE n_null > 0",
    "check_in_list": """
        SELECT event_id, event_type AS actie FROM events WHERE event_id % 3 = 2 AND event_type NOT IN ('update', 'delete')""",
    "audit_all": _union(*_audit_parts().values()),
    "audit_summary": _union(
        *[f"SELECT '{rule}' AS rule, count(*) AS n_violations FROM ({sql})" for rule, sql in _audit_parts().items()]
    ),
    "admit_statement": """
        SELECT * FROM statement_plain
        UNION ALL SELECT 'rule07_seat_unique', passagiernummer, vluchtnummer FROM touched WHERE (vluchtnummer, stoel) IN
              (SELECT (vluchtnummer, stoel) FROM after_upsert WHERE stoel IS NOT NULL GROUP BY vluchtnummer, stoel HAVING count(*) >= 2)
        UNION ALL SELECT 'rule08b_booking_desk', passagiernummer, vluchtnummer FROM touched t WHERE balienummer IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM inchecken_voor_vlucht i WHERE i.vluchtnummer = t.vluchtnummer AND i.balienummer = t.balienummer)
        UNION ALL SELECT 'rule10_overlap', passagiernummer, vluchtnummer FROM touched t JOIN after_trips a USING (passagiernummer, vluchtnummer)
              WHERE EXISTS (SELECT 1 FROM after_trips b WHERE b.passagiernummer = a.passagiernummer AND b.vluchtnummer <> a.vluchtnummer
                            AND a.dep <= b.arr AND b.dep <= a.arr)""",
    "admit_statement_as_written": """
        SELECT * FROM statement_plain
        UNION ALL SELECT 'rule07_seat_unique', passagiernummer, vluchtnummer FROM touched WHERE stoel IS NOT NULL AND EXISTS
              (SELECT 1 FROM after_upsert GROUP BY vluchtnummer, stoel HAVING count(*) >= 2)
        UNION ALL SELECT 'rule08b_booking_desk', passagiernummer, vluchtnummer FROM touched
              WHERE NOT EXISTS (SELECT 1 FROM touched JOIN inchecken_voor_vlucht USING (vluchtnummer, balienummer))
        UNION ALL SELECT 'rule10_overlap', passagiernummer, vluchtnummer FROM touched t JOIN after_trips a USING (passagiernummer, vluchtnummer)
              WHERE EXISTS (SELECT 1 FROM after_trips b WHERE b.passagiernummer = a.passagiernummer AND b.vluchtnummer <> a.vluchtnummer
                            AND a.dep BETWEEN b.dep AND b.arr)""",
    "admit_statement_refused": """
        SELECT seq, passagiernummer, vluchtnummer, balienummer, inchecktijdstip, stoel FROM requests
        WHERE NOT EXISTS (SELECT 1 FROM statement_plain)""",
    "admit_statement_accepted": """
        SELECT seq, passagiernummer, vluchtnummer, balienummer, inchecktijdstip, stoel FROM requests
        WHERE NOT EXISTS (SELECT 1 FROM statement_plain WHERE rule LIKE 'fk_%')""",
    "admit_desks": """
        SELECT 'rule08a_desk_allowed' AS rule, balienummer, vluchtnummer FROM desk_judged WHERE NOT fits
        UNION ALL SELECT 'fk_vlucht', balienummer, vluchtnummer FROM desk_judged WHERE NOT flies
        UNION ALL SELECT 'fk_balie', balienummer, vluchtnummer FROM desk_judged WHERE NOT stands
        UNION ALL SELECT 'pk', balienummer, vluchtnummer FROM desk_requests GROUP BY ALL HAVING count(*) > 1""",
    "admit_desks_accepted": "SELECT balienummer, vluchtnummer FROM desk_judged WHERE fits AND flies AND stands",
    "admit_airports": """
        SELECT 'mixed' AS batch, 'not_null' AS rule, luchthavencode FROM airport_rows WHERE naam IS NULL GROUP BY ALL
        UNION ALL SELECT 'mixed', 'pk', luchthavencode FROM airport_rows GROUP BY luchthavencode
                  HAVING count(*) > 1 OR luchthavencode IN (SELECT luchthavencode FROM luchthaven)
        UNION ALL SELECT DISTINCT 'mixed', 'unique_naam', luchthavencode FROM airport_rows a
                  WHERE naam IN (SELECT naam FROM luchthaven) OR (SELECT count(*) FROM airport_rows b WHERE b.naam = a.naam) > 1
        UNION ALL SELECT 'fit', 'accepted', 'N' || luchthavencode FROM luchthaven""",
    "admit_destination_desks": """
        SELECT 'pk' AS rule, balienummer, luchthavencode FROM inchecken_voor_bestemming WHERE balienummer % 3 = 0
        UNION ALL SELECT 'fk_balie', CAST(balienummer + 1000 AS INT), luchthavencode FROM inchecken_voor_bestemming WHERE balienummer % 3 = 1
        UNION ALL SELECT 'fk_luchthaven', balienummer, 'X' || luchthavencode FROM inchecken_voor_bestemming WHERE balienummer % 3 = 2
        UNION ALL SELECT 'fk_balie', balienummer, CASE WHEN balienummer % 3 = 2 THEN 'X' ELSE '' END || luchthavencode
                  FROM inchecken_voor_bestemming WHERE balienummer % 3 <> 1 AND balienummer NOT IN (SELECT balienummer FROM balie)
        UNION ALL SELECT 'fk_luchthaven', CAST(CASE WHEN balienummer % 3 = 1 THEN balienummer + 1000 ELSE balienummer END AS INT), luchthavencode
                  FROM inchecken_voor_bestemming WHERE balienummer % 3 <> 2 AND luchthavencode NOT IN (SELECT luchthavencode FROM luchthaven)""",
    "admit_passengers": """
        SELECT 'not_null' AS rule, passagiernummer FROM passenger_rows WHERE naam IS NULL GROUP BY ALL
        UNION ALL SELECT 'pk', passagiernummer FROM passenger_rows GROUP BY passagiernummer
                  HAVING count(*) > 1 OR passagiernummer IN (SELECT passagiernummer FROM passagier)""",
    "admit_flights": """
        SELECT 'rule02_changed_booked_flights' AS rule, vluchtnummer FROM flight_rows n JOIN vlucht v USING (vluchtnummer)
        WHERE (n.gatecode <> v.gatecode OR n.max_aantal_psgrs <> v.max_aantal_psgrs) AND vluchtnummer IN (SELECT vluchtnummer FROM passagier_voor_vlucht)
        UNION ALL SELECT 'rule06_weight_budget', vluchtnummer FROM flight_rows WHERE max_aantal_psgrs * max_ppgewicht > max_totaalgewicht
        UNION ALL SELECT 'fk_gate', vluchtnummer FROM flight_rows WHERE gatecode NOT IN (SELECT gatecode FROM gate)
        UNION ALL SELECT 'fk_maatschappij', vluchtnummer FROM flight_rows WHERE maatschappijcode NOT IN (SELECT maatschappijcode FROM maatschappij)
        UNION ALL SELECT 'fk_luchthaven', vluchtnummer FROM flight_rows WHERE luchthavencode NOT IN (SELECT luchthavencode FROM luchthaven)""",
    "admit_flights_accepted": """
        SELECT * REPLACE (-1 - vluchtnummer AS vluchtnummer) FROM vlucht WHERE max_aantal_psgrs * max_ppgewicht <= max_totaalgewicht""",
    "admit_rows": _ADMITTED,
    "admit_capacity": """
        SELECT seq, passagiernummer, vluchtnummer, places IS NOT NULL AND (stored OR taken + (SELECT count(*) FROM newcomers n
               WHERE n.vluchtnummer = a.vluchtnummer AND n.seq < a.first_seq) < places) AS accepted FROM arrivals a""",
    "admit_capacity_as_written": """
        SELECT seq, passagiernummer, vluchtnummer, places IS NOT NULL AND taken + (SELECT count(*) FROM newcomers n
               WHERE n.vluchtnummer = a.vluchtnummer AND n.seq < a.seq) < places AS accepted FROM arrivals a""",
    "upsert_bookings": "SELECT * FROM after_upsert",
    "upsert_touched_files": "SELECT * FROM after_upsert",
    "add_baggage": """
        SELECT i.seq, i.passagiernummer, i.vluchtnummer, i.gewicht, coalesce(b.ok, false) AS accepted,
               CASE WHEN b.seq IS NULL THEN 'fk_booking' WHEN NOT b.ok THEN 'rule05_baggage_limit' ELSE '' END AS broken
        FROM items i LEFT JOIN baggage_steps b ON b.seq = i.seq""",
    "remove_baggage": """
        SELECT * FROM object WHERE volgnummer NOT IN (SELECT volgnummer FROM object
               JOIN rule05_baggage_limit USING (passagiernummer, vluchtnummer))""",
    "register_airline": """
        SELECT 'airline' AS kind, maatschappijcode, naam, CAST(NULL AS INT) AS balienummer, '' AS broken FROM airline_decided WHERE reason = ''
        UNION ALL SELECT 'desk', maatschappijcode, NULL, balienummer, '' FROM airline_decided WHERE reason = ''
        UNION ALL SELECT 'refused', maatschappijcode, naam, balienummer, reason FROM airline_decided WHERE reason <> ''""",
    "guard_flight_update": _guard("(booked AND (gate_differs OR places_differ))"),
    "guard_flight_update_as_written": _guard("booked"),
    "backfill_flights": _backfill(f"coalesce(vertrektijdstip, TIMESTAMP '{AS_OF}' - to_days(1))"),
    "backfill_flights_as_written": _backfill("vertrektijdstip"),
    "delete_cascade": _union(
        *[
            _keys(n) + " WHERE passagiernummer NOT IN (SELECT c_custkey FROM segment)"
            for n in ("passagier", "passagier_voor_vlucht", "object")
        ]
    ),
    "delete_cascade_refused": _union(
        *[
            _keys(n) + " WHERE vluchtnummer IN (SELECT vluchtnummer FROM passagier_voor_vlucht)"
            for n in ("vlucht", "inchecken_voor_vlucht")
        ],
        """SELECT 'refused' AS table_name, CAST(vluchtnummer AS VARCHAR) AS row_key FROM vlucht
           WHERE vluchtnummer IN (SELECT vluchtnummer FROM passagier_voor_vlucht)""",
    ),
    "rekey_cascade": _union(
        *[
            _keys(n, f"(SELECT * REPLACE (balienummer + 1000 AS balienummer) FROM {n})", columns)
            for n, columns in (
                ("balie", None),
                ("inchecken_bij_maatschappij", None),
                ("inchecken_voor_bestemming", None),
                ("inchecken_voor_vlucht", None),
                ("passagier_voor_vlucht", [*_BOOKING, "balienummer"]),
            )
        ]
    ),
    "rekey_cascade_refused": _union(
        _keys(
            "luchthaven",
            """(SELECT CASE WHEN luchthavencode IN (SELECT luchthavencode FROM vlucht) OR n > 1 OR x IN (SELECT luchthavencode FROM luchthaven)
                       THEN luchthavencode ELSE x END AS luchthavencode
                FROM (SELECT luchthavencode, 'X' || substr(luchthavencode, 2, 2) AS x,
                             count(*) OVER (PARTITION BY substr(luchthavencode, 2, 2)) AS n FROM luchthaven))""",
        ),
        _keys(
            "inchecken_voor_bestemming",
            """(SELECT balienummer, CASE WHEN luchthavencode IN (SELECT luchthavencode FROM vlucht)
                       OR (SELECT count(*) FROM luchthaven l WHERE substr(l.luchthavencode, 2, 2) = substr(b.luchthavencode, 2, 2)) > 1
                       THEN luchthavencode ELSE 'X' || substr(luchthavencode, 2, 2) END AS luchthavencode
                FROM inchecken_voor_bestemming b)""",
        ),
        """SELECT 'refused' AS table_name, luchthavencode AS row_key FROM (SELECT luchthavencode,
                  count(*) OVER (PARTITION BY substr(luchthavencode, 2, 2)) AS n FROM luchthaven)
           WHERE luchthavencode IN (SELECT luchthavencode FROM vlucht) OR n > 1""",
        *[
            "SELECT 'whole:' || table_name AS table_name, row_key FROM (" + part + ")"
            for part in (
                *[
                    _keys(
                        n,
                        f"""(SELECT * REPLACE (CASE WHEN luchthavencode IN (SELECT luchthavencode FROM vlucht)
                                                    THEN luchthavencode ELSE 'X' || luchthavencode END AS luchthavencode) FROM {n})""",
                    )
                    for n in ("luchthaven", "inchecken_voor_bestemming")
                ],
                """SELECT 'refused' AS table_name, luchthavencode AS row_key FROM luchthaven
                   WHERE luchthavencode IN (SELECT luchthavencode FROM vlucht)""",
            )
        ],
    ),
    "rekey_swap": _TURNED,
    "rekey_swap_touched_files": _TURNED,
    "history_rows": _history(
        "passagier_voor_vlucht", "second", list(_BOOKING), _PVV_VALUES, AS_OF,
        "b.passagiernummer, b.vluchtnummer, b.balienummer, b.inchecktijdstip, b.stoel",
    ),
    "history_all": _union(
        _history(
            "passagier_voor_vlucht", "second", list(_BOOKING), _PVV_VALUES, AS_OF,
            "'passagier_voor_vlucht' AS table_name, CAST(b.passagiernummer AS VARCHAR) || '|' || CAST(b.vluchtnummer AS VARCHAR) AS row_key",
        ),
        _history(
            "vlucht", "flights_after", ["vluchtnummer"], ["gatecode", "max_aantal_psgrs"], AS_OF,
            "'vlucht' AS table_name, CAST(b.vluchtnummer AS VARCHAR) AS row_key",
        ),
        f"""SELECT 'maatschappij' AS table_name, maatschappijcode AS row_key, TIMESTAMP '{AS_OF}' AS "timestamp", 'delete' AS actie
            FROM rule09_airline_has_desk""",
        f"""SELECT 'object' AS table_name, CAST(volgnummer AS VARCHAR) AS row_key, TIMESTAMP '{AS_OF}' AS "timestamp", 'delete' AS actie
            FROM object_unique JOIN rule05_baggage_limit USING (passagiernummer, vluchtnummer)""",
    ),
    "history_all_rows": _union(
        f"""SELECT {_old_row('passagier_voor_vlucht', 'b', "CASE WHEN a.passagiernummer IS NULL THEN 'delete' ELSE 'update' END")}
            FROM passagier_voor_vlucht b LEFT JOIN second a USING (passagiernummer, vluchtnummer)
            WHERE a.passagiernummer IS NULL OR a.balienummer IS DISTINCT FROM b.balienummer""",
        f"""SELECT {_old_row('vlucht', 'b', "'update'")} FROM vlucht b JOIN flights_after a USING (vluchtnummer)
            WHERE a.gatecode IS DISTINCT FROM b.gatecode OR a.max_aantal_psgrs IS DISTINCT FROM b.max_aantal_psgrs""",
        f"SELECT {_old_row('maatschappij', 'b', chr(39) + 'delete' + chr(39))} FROM rule09_airline_has_desk b",
        f"""SELECT {_old_row('object', 'b', "'delete'")} FROM object_unique b
            JOIN (SELECT passagiernummer, vluchtnummer FROM rule05_baggage_limit) USING (passagiernummer, vluchtnummer)""",
    ),
    "as_of_state": "SELECT * FROM second",
    "as_of_state_start": "SELECT * FROM passagier_voor_vlucht",
    "as_of_many": f"""
        SELECT k.passagiernummer, k.vluchtnummer, k.moment,
               CASE WHEN alive THEN s.balienummer END AS balienummer, CASE WHEN alive THEN s.inchecktijdstip END AS inchecktijdstip,
               CASE WHEN alive THEN s.stoel END AS stoel, s.alive AS present
        FROM (SELECT passagiernummer, vluchtnummer, unnest([{", ".join(f"TIMESTAMP '{m}'" for m in MOMENTS)}]) AS moment
              FROM passagier_voor_vlucht) k
        ASOF JOIN (
          SELECT passagiernummer, vluchtnummer, TIMESTAMP '1900-01-01' AS since, passagiernummer % 19 <> 0 AS alive, balienummer, inchecktijdstip, stoel
          FROM passagier_voor_vlucht
          UNION ALL
          SELECT passagiernummer, vluchtnummer, TIMESTAMP '{FIRST_CHANGE}', passagiernummer % 19 <> 0 AND passagiernummer % 17 <> 0,
                 CASE WHEN passagiernummer % 13 = 0 THEN 1 ELSE balienummer END, inchecktijdstip, stoel
          FROM passagier_voor_vlucht
          UNION ALL
          SELECT passagiernummer, vluchtnummer, TIMESTAMP '{SECOND_CHANGE}', passagiernummer % 19 = 0 OR passagiernummer % 17 <> 0,
                 CASE WHEN passagiernummer % 13 = 0 AND passagiernummer % 19 <> 0 THEN 1 ELSE balienummer END,
                 CASE WHEN passagiernummer % 11 <> 0 OR passagiernummer % 19 = 0 THEN inchecktijdstip END,
                 CASE WHEN passagiernummer % 11 <> 0 OR passagiernummer % 19 = 0 THEN stoel END
          FROM passagier_voor_vlucht) s
        ON k.passagiernummer = s.passagiernummer AND k.vluchtnummer = s.vluchtnummer AND k.moment >= s.since""",
    "stream_row_rules": "SELECT seq, passagiernummer, vluchtnummer, broken = '' AS accepted, broken FROM checked",
    "stream_row_rules_live": f"""
        SELECT seq, passagiernummer, vluchtnummer, broken = '' AS accepted, broken FROM (
          SELECT seq, passagiernummer, vluchtnummer, CASE
                 WHEN seq % 2 = 0 AND balienummer > {FIRST_DESKS} AND broken NOT LIKE '%fk_balie%'
                 THEN concat_ws(',', 'fk_balie', nullif(broken, '')) ELSE broken END AS broken
          FROM checked)""",
    "stream_admit": _ADMITTED,
}


def sql() -> dict[str, str]:
    same = {"remove_baggage_touched_files": "remove_baggage", "delete_cascade_touched_files": "delete_cascade"}
    queries = {**QUERY_SQL, **{name: QUERY_SQL[other] for name, other in same.items()}}
    out = {name: with_parts(query) for name, query in queries.items()}
    out["audit_after"] = with_parts(
        QUERY_SQL["audit_all"],
        {
            "passagier_voor_vlucht": """
                SELECT * REPLACE (CASE WHEN passagiernummer % 13 = 0 THEN 1 ELSE balienummer END AS balienummer)
                FROM before_passagier_voor_vlucht WHERE passagiernummer % 17 <> 0""",
            "object": "SELECT * FROM before_object WHERE volgnummer % 10 <> 3",
        },
    )
    return out
