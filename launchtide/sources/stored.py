"""Reads of the month-wise tables written by :mod:`launchtide.sinks`."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchtide.schemas import DELTAS, HISTOGRAM, USER_SETS, require


def _of_months(table: DataFrame, months: Iterable[int] | None) -> DataFrame:
    """Keep some months; the filter on the partition column prunes directories."""
    return table if months is None else table.filter(F.col("month").isin(list(months)))


def read_histograms(
    spark: SparkSession, path: str, months: Iterable[int] | None = None
) -> DataFrame:
    """Month-wise histograms as ``month, delta, count``."""
    stored = spark.read.schema(HISTOGRAM).parquet(path)
    return _of_months(stored, months).select("month", "delta", "count")


def read_user_sets(
    spark: SparkSession, path: str, months: Iterable[int] | None = None
) -> DataFrame:
    """Month-wise sets of users as ``month, delta, bucket, users``."""
    stored = spark.read.schema(USER_SETS).parquet(path)
    return _of_months(stored, months).select("month", "delta", "bucket", "users")


def read_deltas(spark: SparkSession, path: str, months: Iterable[int] | None = None) -> DataFrame:
    """Month-wise user deltas as ``month, ifa, name, launch, first_seen, delta``."""
    stored = spark.read.parquet(path)
    require(stored.schema, DELTAS, "delta table")
    return _of_months(stored, months).select(
        "month", "ifa", "name", "launch", "first_seen", "delta"
    )
