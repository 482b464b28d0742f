"""Check-in tables derived from a star schema of orders, parts and suppliers.

Parts play flights, customers passengers, orders booking requests and order lines baggage. Order
lines are reduced per order before they meet the orders, so the join sees one row per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paxledger.session import prepare
from paxledger.sources.schema import TABLES
from paxledger.sources.tables import Tables


def _padded(column: Column, width: int) -> Column:
    """Zeros in front up to ``width``; a longer number keeps all its digits."""
    text = column.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def _moment(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def _plus_days(text: str, days: Column) -> Column:
    return _moment(text) + F.make_dt_interval(days.cast("int"))


class StarSource:
    """The driver tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = prepare(spark), folder

    def raw(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    def requests(self) -> DataFrame:
        """One booking request per order, numbered by order key."""
        lines = (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_partkey").alias("fl"), F.min("l_suppkey").alias("su"))
        )
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return (
            self.raw("orders")
            .join(lines, "o_orderkey")
            .select(
                F.col("o_orderkey").alias("seq"),
                F.col("o_custkey").alias("passagiernummer"),
                F.col("fl").alias("vluchtnummer"),
                F.when(priority == "5-LOW", F.lit(None)).otherwise((F.col("su") % 50 + 1).cast("int")).alias("balienummer"),
                F.when(status == "O", F.lit(None)).otherwise(F.col("o_orderdate")).alias("inchecktijdstip"),
                F.when((status == "O") & (priority != "1-URGENT"), F.lit(None))
                .otherwise(_padded(F.col("o_orderkey") % 60, 3))
                .alias("stoel"),
                status.alias("status"),
            )
        )

    def bookings(self, status: str | None = None) -> DataFrame:
        """Requests folded to one booking per passenger and flight, optionally of one order status."""
        rows = self.requests()
        if status is not None:
            rows = rows.where(F.col("status") == status)
        return rows.groupBy("passagiernummer", "vluchtnummer").agg(
            F.min("balienummer").alias("balienummer"),
            F.min("inchecktijdstip").alias("inchecktijdstip"),
            F.min("stoel").alias("stoel"),
        )

    def baggage(self) -> DataFrame:
        owners = self.requests().select("seq", "passagiernummer", "vluchtnummer")
        return (
            self.raw("lineitem")
            .select(
                F.col("l_orderkey").alias("seq"),
                (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("volgnummer"),
                F.col("l_quantity").cast("int").alias("gewicht"),
            )
            .join(owners, "seq")
            .select("volgnummer", "passagiernummer", "vluchtnummer", "gewicht")
        )

    def flights(self) -> DataFrame:
        number = F.col("p_partkey")
        departure = _plus_days("1998-01-01", number * 37 % 1400)
        return self.raw("part").select(
            number.alias("vluchtnummer"),
            F.char((number % 5 + 65).cast("int")).alias("gatecode"),
            _padded(self._airline(number), 2).alias("maatschappijcode"),
            _padded(self._airport(number), 3).alias("luchthavencode"),
            F.col("p_brand").alias("vliegtuigtype"),
            F.col("p_size").alias("max_aantal_psgrs"),
            F.lit(2500).cast("decimal(5,0)").alias("max_totaalgewicht"),
            (number % 60 + 60).cast("decimal(5,2)").alias("max_ppgewicht"),
            departure.alias("vertrektijdstip"),
            (departure + F.make_dt_interval((number % 7 + 1).cast("int"))).alias("aankomsttijdstip"),
        )

    def passengers(self) -> DataFrame:
        number = F.col("c_custkey")
        return self.raw("customer").select(
            number.alias("passagiernummer"),
            F.col("c_name").alias("naam"),
            F.when(number % 2 == 0, "M").otherwise("V").alias("geslacht"),
            _plus_days("1950-01-01", number % 20000).alias("geboortedatum"),
        )

    def desks(self) -> DataFrame:
        return self.raw("part").select(F.col("p_size").alias("balienummer")).distinct()

    def airlines(self) -> DataFrame:
        return self.raw("nation").select(
            _padded(F.col("n_nationkey"), 2).alias("maatschappijcode"), F.col("n_name").alias("naam")
        )

    def airports(self) -> DataFrame:
        nations = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("land"))
        return (
            self.raw("supplier")
            .join(nations, "s_nationkey")
            .select(_padded(F.col("s_suppkey"), 3).alias("luchthavencode"), F.col("s_name").alias("naam"), "land")
        )

    def _lines(self) -> DataFrame:
        """Desk and flight of every order line, and the numbers of the flight's airline and airport."""
        flight = F.col("l_partkey")
        return self.raw("lineitem").select(
            ((F.col("l_suppkey") + F.col("l_linenumber")) % 50 + 1).cast("int").alias("balienummer"),
            flight.alias("vluchtnummer"),
            self._airline(flight).alias("airline"),
            self._airport(flight).alias("airport"),
        )

    def _airline(self, flight: Column) -> Column:
        return flight % self.raw("nation").agg(F.count("*")).scalar()

    def _airport(self, flight: Column) -> Column:
        """Flights go to every third airport."""
        number = flight % self.raw("supplier").agg(F.count("*")).scalar()
        return number - number % 3

    def desk_airlines(self) -> DataFrame:
        """Desks meet the airlines of the flights they serve, but for some, and for the airline that is last by name."""
        last = self.raw("nation").agg(F.max("n_name")).scalar()
        served = self.raw("nation").where(F.col("n_name") != last).select(F.col("n_nationkey").alias("airline"))
        pairs = self._lines().select("balienummer", "airline").distinct().where((F.col("balienummer") + F.col("airline")) % 4 != 0)
        return pairs.join(served, "airline", "left_semi").select("balienummer", _padded(F.col("airline"), 2).alias("maatschappijcode"))

    def desk_airports(self) -> DataFrame:
        """Desks meet the airports of the flights they serve, but for some."""
        pairs = self._lines().select("balienummer", "airport").distinct().where((F.col("balienummer") + F.col("airport")) % 4 != 0)
        return pairs.select("balienummer", _padded(F.col("airport"), 3).alias("luchthavencode"))

    def desk_flights(self) -> DataFrame:
        return self._lines().select("balienummer", "vluchtnummer").distinct()


def project(spark: SparkSession, folder: str) -> Tables:
    """The twelve check-in tables over the driver tables in ``folder``, as lazy plans."""
    s = StarSource(spark, folder)
    builders = {
        "balie": s.desks,
        "gate": lambda: s.raw("region").select(F.char((F.col("r_regionkey") + 65).cast("int")).alias("gatecode")),
        "maatschappij": s.airlines,
        "inchecken_bij_maatschappij": s.desk_airlines,
        "luchthaven": s.airports,
        "inchecken_voor_bestemming": s.desk_airports,
        "vliegtuig": lambda: s.raw("part").select(F.col("p_brand").alias("vliegtuigtype")).distinct(),
        "vlucht": s.flights,
        "inchecken_voor_vlucht": s.desk_flights,
        "passagier": s.passengers,
        "passagier_voor_vlucht": s.bookings,
        "object": s.baggage,
    }
    assert set(builders) == set(TABLES)
    return Tables(builders)


def project_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a booking request."""
    return StarSource(spark, folder).requests().drop("status")


def project_handled(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings of the orders already handled: the stored state that the requests arrive at."""
    return StarSource(spark, folder).bookings(status="F")
