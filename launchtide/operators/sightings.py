"""From nested profiles to dated device sightings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchtide.functions import earliest, earliest_unless_null
from launchtide.schemas import PLATFORM

FIRST, SKIP = "first", "skip"
KEEP, DROP = "keep", "drop"


def on_platform(
    profiles: DataFrame, platform: str = PLATFORM, null_users: str = KEEP
) -> DataFrame:
    """Profiles of one platform, whatever its case; a prefix such as ``androidtv`` is another."""
    chosen = profiles.filter(F.lower("device.platform") == platform.lower())
    return chosen.filter(F.col("ifa").isNotNull()) if null_users == DROP else chosen


def _leading(profiles: DataFrame) -> list[str]:
    return [name for name in ("month", "ifa") if name in profiles.columns]


def sightings(
    profiles: DataFrame,
    platform: str = PLATFORM,
    null_dates: str = FIRST,
    null_users: str = KEEP,
) -> DataFrame:
    """One row per app of a profile: (``month``,) ``ifa, platform, device_model, first_seen``.

    Null and empty app arrays give no row.
    """
    exploded = on_platform(profiles, platform, null_users).select(
        *_leading(profiles), "device.platform", "device.device_model", F.explode("app").alias("app")
    )
    rows = exploded.withColumn("first_seen", F.col("app.first_seen")).drop("app")
    return rows.filter(F.col("first_seen").isNotNull()) if null_dates == SKIP else rows


def earliest_sightings(
    profiles: DataFrame,
    platform: str = PLATFORM,
    null_dates: str = FIRST,
    null_users: str = KEEP,
) -> DataFrame:
    """The first of each profile's :func:`sightings`, without exploding its apps.

    All apps of a profile share user and device, so only the earliest can be a
    user's first sighting. An undated app counts as earliest unless
    ``null_dates="skip"``.
    """
    times = F.col("app.first_seen")
    seen = earliest(times) if null_dates == SKIP else earliest_unless_null(times)
    rows = (
        on_platform(profiles, platform, null_users)
        .filter(F.size(times) > 0)
        .select(
            *_leading(profiles),
            "device.platform",
            "device.device_model",
            seen.alias("first_seen"),
        )
    )
    return rows.filter(F.col("first_seen").isNotNull()) if null_dates == SKIP else rows
