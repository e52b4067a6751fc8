"""Bridge tables: the driver's raw tables in ``coverage_metrics`` shape.

Each bridge is a profiler call (a single group-by over the raw table) plus a
domain dimension built from the matching master table.  Rates stay
unrounded.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.operators.profile import profile
from domainpulse.sources.files import read_table


def events_metrics(spark: SparkSession, base: str) -> DataFrame:
    ev = read_table(spark, base, "events")
    return profile(
        ev,
        domain_id=F.concat(F.lit("U"), F.col("user_id").cast("string")),
        event_time=F.col("ts"),
        null_when=F.col("event_type") == "error",
        stale_when=F.hour("ts") < 12,
        update_lag=F.lit(24) - F.max(F.hour("ts")),
        # distinct event types per (user, day): a set bounded by the event-type
        # vocabulary, so one partial aggregate and one shuffle (count_distinct
        # would add a second shuffle keyed by the type)
        missing_fields=F.lit(5) - F.size(F.collect_set("event_type")),
    )


def events_domains(spark: SparkSession, base: str) -> DataFrame:
    cust = read_table(spark, base, "customer")
    nation = read_table(spark, base, "nation")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("domain_id"),
        F.col("c_name").alias("domain_name"),
        F.col("c_mktsegment").alias("owner_team"),
        F.col("n_name").alias("data_source"),
    )


def lineitem_metrics(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    orders = read_table(spark, base, "orders")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey)
    lag_days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return profile(
        joined,
        domain_id=F.concat(F.lit("S"), F.col("l_suppkey").cast("string")),
        event_time=F.col("l_shipdate"),
        null_when=F.col("l_returnflag") == "R",
        stale_when=F.col("l_linestatus") == "F",
        update_lag=F.max(lag_days),
        missing_fields=F.count_if(F.col("l_tax") == 0),
    )


def lineitem_dates(spark: SparkSession, base: str, days: int = 7) -> DataFrame:
    """The last day of ``lineitem_metrics``, as one row: the newest line item that has its order.

    Only the newest days' order keys meet the orders.  If none of them has
    one, the next days before are taken, eight times as many each time.
    """
    shipped = F.to_date("l_shipdate")
    li = read_table(spark, base, "lineitem").select("l_orderkey", shipped.alias("snapshot_date"))
    orders = read_table(spark, base, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    first, upto = li.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    last = None
    while last is None and upto is not None and upto >= first:
        since = max(first, upto - dt.timedelta(days=days - 1)) if days < (upto - first).days else first
        recent = li.where(F.col("snapshot_date").between(F.lit(since), F.lit(upto)))
        last = recent.join(orders, "l_orderkey", "left_semi").agg(F.max("snapshot_date")).first()[0]
        upto, days = since - dt.timedelta(days=1), days * 8
    return spark.createDataFrame([(last,)], "snapshot_date date")


def lineitem_domains(spark: SparkSession, base: str) -> DataFrame:
    """Suppliers with a positive balance only: plants the orphans that the quality checks look for."""
    return lineitem_suppliers(spark, base, F.col("s_acctbal") > 0)


def lineitem_suppliers(spark: SparkSession, base: str, which: Column | None = None) -> DataFrame:
    """All suppliers as domains."""
    sup = read_table(spark, base, "supplier")
    sup = sup if which is None else sup.where(which)
    nation = read_table(spark, base, "nation")
    region = read_table(spark, base, "region")
    return (
        sup.join(nation, sup.s_nationkey == nation.n_nationkey, "left")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
        .select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("domain_id"),
            F.col("s_name").alias("domain_name"),
            F.col("r_name").alias("owner_team"),
            F.col("n_name").alias("data_source"),
        )
    )


def events_keys(spark: SparkSession, base: str) -> DataFrame:
    """Raw (domain, day) key per event row: exercises the duplicate check."""
    ev = read_table(spark, base, "events")
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("domain_id"),
        F.to_date("ts").alias("snapshot_date"),
    )
