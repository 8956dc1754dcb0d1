"""The device and launch lookup tables, and what they add to a sighting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchtide.operators.joins import BROADCAST_BYTES, join_lookup
from launchtide.schemas import NOT_DETECTED


def device_lookup(raw: DataFrame) -> DataFrame:
    """The raw device table as ``model, brand, name``."""
    return raw.select(
        F.col("Model").alias("model"),
        F.col("Retail Branding").alias("brand"),
        F.col("Marketing Name").alias("name"),
    )


def launches(raw: DataFrame) -> DataFrame:
    """The raw launch table as ``name, launch``; a date that cannot be read is null."""
    return raw.select(
        F.col("Name").alias("name"), F.try_to_date("Release_Date").alias("launch")
    )


def of_brand(lookup: DataFrame, brand: str) -> DataFrame:
    """The lookup rows of one brand, missing text filled."""
    return lookup.fillna(NOT_DETECTED, ["brand", "name"]).filter(F.col("brand") == brand)


def enrich(
    sightings: DataFrame,
    lookup: DataFrame,
    brand: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add brand and marketing name by model: (``month``,) ``ifa, first_seen, brand, name``.

    Every sighting stays, a model listed twice gives two rows, and missing text is
    ``Not Detected``, the user's id included. With ``brand`` only its rows are kept;
    the lookup is then cut down before the join.
    """
    if brand in (None, NOT_DETECTED):
        how, names = "left", lookup
    else:
        how, names = "inner", of_brand(lookup, brand)
    names = names.select(F.col("model").alias("device_model"), "brand", "name")
    leading = [name for name in ("month", "ifa") if name in sightings.columns]
    needed = sightings.select(*leading, "device_model", "first_seen")
    rows = (
        join_lookup(needed, names, "device_model", how, broadcast_bytes)
        .select(*leading, "first_seen", "brand", "name")
        .fillna(NOT_DETECTED, ["ifa", "brand", "name"])
    )
    return rows.filter(F.col("brand") == brand) if brand == NOT_DETECTED else rows


def earliest_launches(launches: DataFrame) -> DataFrame:
    """One ``name, launch`` row per name, the least readable launch; null if none is."""
    return launches.groupBy("name").agg(F.min("launch").alias("launch"))


def launched_models(lookup: DataFrame, launches: DataFrame, brand: str) -> DataFrame:
    """One ``model, name, launch`` row for each model of ``brand`` with a launch.

    Where a model has several names, or a name several launches, all would share one
    sighting and its date, so :func:`launchtide.operators.uptake.first_rows` would
    settle on the least name and then the least launch. That choice is made here,
    before the large join, which then adds no rows.
    """
    if brand == NOT_DETECTED:
        raise ValueError("sightings without a lookup row have no model: use enrich, first_device")
    return (
        of_brand(lookup, brand)
        .filter(F.col("model").isNotNull())
        .select("model", "name")
        .join(earliest_launches(launches), "name")
        .groupBy("model")
        .agg(F.min(F.struct("name", "launch")).alias("least"))
        .select("model", "least.*")
    )
