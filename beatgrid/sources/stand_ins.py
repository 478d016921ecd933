"""The star-schema test tables seen as incidents, raw reports, populations and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.functions import calendar as cal


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly incidents from ``events``; 21 areas."""
    hour_ts = cal.hour_start(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("incident_id"),
        F.pmod("user_id", F.lit(21)).cast("int").alias("area"),
        "ts",
        hour_ts.alias("hour_ts"),
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("category"),
        "value",
        "props",
    )


def event_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1000 residents per user seen in the area."""
    return (
        table(spark, sf_dir, "events")
        .select(F.pmod("user_id", F.lit(21)).cast("int").alias("area"), "user_id")
        .distinct()
        .groupBy("area")
        .agg((F.count("user_id") * 1000).alias("population"))
    )


def order_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily incidents from ``orders``; the area is the customer's nation."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    date = F.to_date("o_orderdate")
    hour = (F.col("o_orderkey") % 24).cast("int")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("incident_id"),
        F.col("c_nationkey").alias("area"),
        date.alias("date"),
        hour.alias("hour"),
        cal.hour_stamp(date, hour).alias("hour_ts"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderstatus").alias("code"),
        F.col("o_totalprice").alias("price"),
        F.col("c_acctbal").alias("balance"),
    )


def order_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1000 residents per customer in 1995, growing by 10 per customer and year."""
    years = F.explode(F.sequence(F.lit(1995), F.lit(2002)))
    return (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("area"))
        .agg(F.count("*").alias("customers"))
        .select("area", "customers", years.alias("year"))
        .select(
            "area",
            "year",
            (F.col("customers") * (1000 + 10 * (F.col("year") - 1995))).alias("population"),
        )
    )


def event_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-like readings per (area, date, hour) from the events that are no clicks; hours with
    clicks only have none. Whole cents, so that the mean does not depend on the row order."""
    rows = table(spark, sf_dir, "events").filter(F.col("event_type") != "click")
    return (
        rows.groupBy(
            (F.col("user_id") % 21).cast("int").alias("area"),
            F.to_date("ts").alias("date"),
            F.hour("ts").alias("hour"),
        )
        .agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
        .select(
            "area", "date", "hour", (F.expr("cents div n") / 100).alias("temp"), F.col("n").cast("double").alias("wspeed")
        )
    )


def line_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents of two large areas with one hour a month: many rows in each area-hour. One incident
    per order and line number, as these repeat in the table."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    lines = lines.agg(F.min("l_suppkey").alias("supplier"), F.min("l_shipdate").alias("shipped"))
    return lines.select(
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("incident_id"),
        (F.col("supplier") % 2).cast("int").alias("area"),
        F.to_date(F.date_trunc("month", "shipped")).alias("date"),
        F.date_trunc("month", "shipped").cast("timestamp_ntz").alias("hour_ts"),
    )


def line_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_suppkey") % 2).cast("int").alias("area"))
        .agg((F.count_distinct("l_suppkey") * 1000).alias("population"))
    )


def order_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-like readings per incident id, in the raw layout; cut to four digits."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("DR_NO"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("discount"),
        )
        .select(
            "DR_NO",
            (F.expr("quantity * 10000 div n") / 10000).cast("string").alias("Temp"),
            (F.expr("discount * 100 div n") / 10000).cast("string").alias("Wspeed"),
        )
    )


def named_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg((F.count("*") * 1000).alias("population"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.upper("n_name").alias("area"))
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("area", "population")


def ship_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-like readings per (area, date) from shipments of the area's suppliers.

    Means of whole numbers cut to four digits, so that they do not depend on the row order.
    """
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_discount"
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("area"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("discount"),
        )
        .select(
            "area",
            "date",
            (F.expr("quantity * 10000 div n") / 10000).alias("temp"),
            (F.expr("discount * 100 div n") / 10000).alias("wspeed"),
        )
    )


def raw_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports in the raw column layout, with nulls, bad dates and invalid codes mixed in."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    us_date = F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        k.alias("DR_NO"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 2), "yyyy-MM-dd").alias("Date Rptd"),
        F.when(k % 101 == 0, "n/a")
        .when(k % 103 == 0, F.lit(None).cast("string"))
        .otherwise(us_date)
        .alias("DATE OCC"),
        ((k % 24) * 100 + k % 60).cast("int").alias("TIME OCC"),
        F.col("c_nationkey").alias("AREA"),
        F.lower("n_name").alias("AREA NAME"),
        (k % 2 + 1).cast("int").alias("Part 1-2"),
        (k % 9 * 100).cast("double").alias("Crm Cd"),
        F.lower("o_orderpriority").alias("Crm Cd Desc"),
        F.when(c % 7 != 0, F.col("o_orderpriority")).alias("Mocodes"),
        F.floor(F.col("c_acctbal") / 80).cast("int").alias("Vict Age"),
        F.element_at(
            F.array(*[F.lit(v) for v in ("M", "F", "X", "H", "-", None)]), (c % 6 + 1).cast("int")
        ).alias("Vict Sex"),
        F.element_at(
            F.array(*[F.lit(v) for v in ("W", "B", "H", "A", "O", "K", None)]),
            (c % 7 + 1).cast("int"),
        ).alias("Vict Descent"),
        F.when(c % 61 != 0, (c % 50).cast("double")).alias("Premis Cd"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("Premis Desc"),
        F.when(k % 3 == 0, (k % 500).cast("double")).alias("Weapon Used Cd"),
        F.when(k % 3 == 0, F.lit("tool")).alias("Weapon Desc"),
        F.when(k % 97 != 0, F.lower("o_orderstatus")).alias("Status"),
        F.lower("o_orderstatus").alias("Status Desc"),
        F.lit(None).cast("double").alias("Crm Cd 4"),
        F.lit(None).cast("string").alias("Cross Street"),
        F.col("o_totalprice").alias("LAT"),
        F.col("c_acctbal").alias("LON"),
    )
