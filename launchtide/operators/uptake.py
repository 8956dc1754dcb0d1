"""A user's first launched device and the days from its launch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.operators.devices import earliest_launches
from launchtide.operators.joins import BROADCAST_BYTES, join_lookup

USER = ("ifa",)
MONTH_USER = ("month", "ifa")


def join_launches(
    enriched: DataFrame, launches: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add the launch date by marketing name; names without a launch row go."""
    return join_lookup(enriched, launches.select("name", "launch"), "name", "inner", broadcast_bytes)


def first_rows(launched: DataFrame, by: Sequence[str] = USER) -> DataFrame:
    """The earliest row of each user, or of each user and month.

    Undated rows come first; rows seen at the same time are ordered by name and
    launch, one that cannot be read last, so the outcome does not depend on where rows lie. Ordering by time covers
    ordering by date. Spark keeps one row per key and task ahead of the shuffle, so a
    user with very many rows puts no load on one task.
    """
    order = Window.partitionBy(*by).orderBy(
        "first_seen", "name", F.col("launch").asc_nulls_last()
    )
    return (
        launched.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") == 1)
        .select(*by, "name", "launch", "first_seen", F.to_date("first_seen").alias("date"))
    )


def first_device(
    enriched: DataFrame,
    launches: DataFrame,
    by: Sequence[str] = USER,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """First launched device by user: the columns of ``by`` and ``name, launch, first_seen, date``.

    Of the launches of one name only the least could be chosen, so a name listed many
    times adds no rows.
    """
    return first_rows(join_launches(enriched, earliest_launches(launches), broadcast_bytes), by)


def launch_delta(first: DataFrame) -> DataFrame:
    """Add ``delta``, the whole days from launch to first sighting."""
    return first.withColumn("delta", F.datediff("date", "launch"))


def non_negative(deltas: DataFrame) -> DataFrame:
    """Drop users first seen before the launch, and those with either date missing."""
    return deltas.filter(F.col("delta") >= 0)
