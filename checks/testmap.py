"""The given test tables read as profiles, device lookup and launches (FIXTURES.md, 3).

By fixed arithmetic on their keys some users have no id, some apps no date, some models two
names, and some names a second, an unreadable or no launch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from launchtide.functions import yyyymm
from launchtide.operators import device_lookup, launches
from launchtide.schemas import Labels
from launchtide.sinks import shared_path

BRAND = "Brand#1"
LABELS = Labels(device_brand=BRAND)
COUNTRY = "XX"
# Spark names a partition's directory after its column.
DIRECTORY = "{country}/month={month}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile per order line, as ``month, ifa, device, app``.

    The customer is the user and the part the device. A line has ``l_linenumber``
    apps: one first seen at the ship date, each next one a week later; the last app of
    every 61st order has no date, and every fiftieth customer no id. Profiles are built
    from their own line, without a group that one customer could fill.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    platform = (
        F.when(F.col("l_returnflag") == "N", "Android")
        .when(F.col("l_returnflag") == "A", "android")
        .otherwise("iOS")
    )
    last = F.expr("l_shipdate + make_dt_interval(7 * (l_linenumber - 1))")
    weekly = F.sequence("l_shipdate", last, F.expr("interval 7 days"))
    undated = F.col("l_orderkey") % 61 == 0
    # A line has as many weeks as its number; to take their size would make them again for each.
    seen = F.transform(weekly, lambda time, i: F.when(~undated | (i < F.col("l_linenumber") - 1), time))
    user = F.when(F.col("o_custkey") % 50 != 7, F.col("o_custkey")).cast("string")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        yyyymm(F.col("l_shipdate")).alias("month"),
        user.alias("ifa"),
        F.struct(
            platform.alias("platform"), F.col("l_partkey").cast("string").alias("device_model")
        ).alias("device"),
        F.arrays_zip(seen.alias("first_seen")).alias("app"),
    )


def raw_device_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts but every tenth, as the raw device table; the gap leaves unknown models.

    Every fifteenth model is listed again by a name that sorts before its own.
    """
    part = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 10 != 0)
    again = part.filter(F.col("p_partkey") % 15 == 4)
    names = part.select("p_brand", "p_name", "p_partkey").union(
        again.select("p_brand", F.concat(F.lit("A "), "p_name"), "p_partkey")
    )
    return names.select(
        F.col("p_brand").alias("Retail Branding"),
        F.col("p_name").alias("Marketing Name"),
        F.col("p_partkey").cast("string").alias("Model"),
    )


def raw_launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A launch for each part name, a week after the launch of the part numbered before.

    By the name's least part number modulo 12: 3 has a second, earlier launch, 5 a second one
    that cannot be read, 7 only one that cannot be read, 9 none. Half of the second names
    of models were launched three days later.
    """
    first = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("k"))
    k = F.col("k")

    def day(shift: int) -> Column:
        return F.date_add(F.lit("1995-01-01").cast("date"), (k * 7 + shift).cast("int")).cast("string")

    rows = first.select(
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.col("p_name").alias("Name"), F.when(k % 12 == 7, "soon").when(k % 12 != 9, day(0)).alias("Release_Date")),
                    F.when(k % 12 == 3, F.struct(F.col("p_name").alias("Name"), day(-10).alias("Release_Date"))),
                    F.when(k % 12 == 5, F.struct(F.col("p_name").alias("Name"), F.lit("soon").alias("Release_Date"))),
                    F.when(k % 30 == 4, F.struct(F.concat(F.lit("A "), "p_name").alias("Name"), day(3).alias("Release_Date"))),
                ),
                lambda row: row.isNotNull(),
            )
        ).alias("row")
    )
    return rows.select("row.*")


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_lookup(raw_device_lookup(spark, sf_dir))


def launch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return launches(raw_launches(spark, sf_dir))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach."""
    return shared_path(spark, name)


def stored_profiles(spark: SparkSession, sf_dir: str) -> str:
    """Write all profiles, a directory per month, and return the base path."""
    base = scratch(spark, "profiles")
    (
        profiles(spark, sf_dir)
        .hint("rebalance", "month")
        .write.partitionBy("month")
        .parquet(f"{base}/{COUNTRY}")
    )
    return base
