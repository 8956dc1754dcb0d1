"""The computation step by step, without the package's shortcuts, to compare results and times.

Every app is exploded, every sighting joined to the whole lookup, and each band is
its own filter in a union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.schemas import NOT_DETECTED, PLATFORM, Band, Labels


def plain_deltas(
    profiles: DataFrame,
    lookup: DataFrame,
    launches: DataFrame,
    brand: str,
    by: Sequence[str] = ("ifa",),
) -> DataFrame:
    seen = (
        profiles.withColumn("one_app", F.explode("app"))
        .select(*by, "device.*", F.col("one_app.first_seen").alias("first_seen"))
        .filter(F.lower("platform").like(PLATFORM))
    )
    enriched = (
        seen.join(lookup, seen.device_model == lookup.model, "left")
        .select(*by, "first_seen", "brand", "name")
        .fillna(NOT_DETECTED)
    )
    launched = (
        enriched.filter(F.col("brand") == brand)
        .join(launches, "name")
        .withColumn("date", F.to_date("first_seen"))
    )
    launch = F.col("launch").asc_nulls_last()
    order = Window.partitionBy(*by).orderBy("date", "first_seen", "name", launch)
    ranked = launched.withColumn("rank", F.row_number().over(order))
    deltas = ranked.filter("rank = 1").withColumn("delta", F.datediff("date", "launch"))
    return deltas.filter(~F.col("delta").cast("string").like("%-%")).drop("rank", "brand")


def plain_segments(deltas: DataFrame, bands: Sequence[Band], labels: Labels) -> DataFrame:
    union = None
    for band in bands:
        kept = deltas
        if band.lo is not None:
            kept = kept.filter(F.col("delta") >= band.lo)
        if band.hi is not None:
            kept = kept.filter(F.col("delta") <= band.hi)
        rows = kept.select(
            F.lit(labels.quarter).alias("quarter"),
            F.lit(labels.adoption_type).alias("adoption_type"),
            "ifa",
            F.lit(band.segment_id).alias("segment_id"),
            F.lit(band.segment).alias("segment"),
            F.lit(labels.device_brand).alias("device_brand"),
            F.col("name").alias("device_name"),
            F.col("launch").alias("launch_date"),
            "first_seen",
            "delta",
        )
        union = rows if union is None else union.union(rows)
    return union
