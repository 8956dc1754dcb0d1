"""The whole computation, from profiles to segments.

The DataFrames are lazy but for the measuring of lookups: building one runs small jobs over
the lookup tables. If these don't fit a broadcast, it also reads the profiles, once, and stores
the few sightings that matter in the folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchtide.operators.devices import launched_models, of_brand
from launchtide.operators.histogram import SHARES, delta_histogram, derive_bands
from launchtide.operators.joins import BROADCAST_BYTES, fits, having_keys, join_lookup
from launchtide.operators.losses import Losses, NoLosses
from launchtide.operators.segments import assign_segments
from launchtide.operators.sightings import FIRST, KEEP, earliest_sightings
from launchtide.operators.uptake import MONTH_USER, USER, first_rows, launch_delta, non_negative
from launchtide.schemas import BRAND, ID_DOCUMENTED, MY_BANDS, NOT_DETECTED, Band, Labels
from launchtide.sinks.shared import kept


def first_devices(
    profiles: DataFrame,
    lookup: DataFrame,
    launches: DataFrame,
    brand: str = BRAND,
    by: Sequence[str] = USER,
    null_dates: str = FIRST,
    null_users: str = KEEP,
    broadcast_bytes: int = BROADCAST_BYTES,
    losses: Losses | None = None,
) -> DataFrame:
    """First launched device of each user, or each user and month, with launch and first sighting.

    The profiles are read once, joined once to the brand's launched models, and shuffled once by
    user. Where these models don't fit a broadcast, a filter of their hashes, of bounded size,
    is broadcast instead: only sightings of launched models are shuffled. What is left of
    them, a row for each user and model, is stored, then counted by model and joined.

    ``losses`` counts on the way what profiles are left out for.
    """
    losses = losses or NoLosses()
    profiles = losses.read(profiles)
    models = launched_models(lookup, launches, brand).withColumnRenamed("model", "device_model")
    # Each launched model is one of the brand's lookup rows with a date: these take no join.
    no_smaller = of_brand(lookup, brand).select("model", "name", F.lit("yyyy-mm-dd").alias("launch"))
    seen = earliest_sightings(profiles, null_dates=null_dates, null_users=null_users)
    seen = seen.select(*by, "device_model", "first_seen")
    shuffled = not fits(broadcast_bytes, no_smaller, models)
    seen = losses.sighted(seen)
    if shuffled:
        models = kept(models, "models")
        seen = having_keys(seen, models, "device_model")
        # Only the first of a user's sightings of a model can count; null is before all.
        least = [F.min(F.struct("first_seen")).alias("least"), F.count("*").alias("n")]
        seen = seen.groupBy(*by, "device_model").agg(*least).select(*by, "device_model", "least.*", "n")
        seen = kept(seen, "sightings")
    launched = join_lookup(
        seen,
        models,
        "device_model",
        "inner",
        -1 if shuffled else broadcast_bytes,
        bound=None if shuffled else no_smaller,
        distinct=shuffled,
        filtered=shuffled,
    )
    launched = losses.launched(launched).withColumn("ifa", F.coalesce("ifa", F.lit(NOT_DETECTED)))
    return first_rows(launched, by)


def user_deltas(
    profiles: DataFrame,
    lookup: DataFrame,
    launches: DataFrame,
    brand: str = BRAND,
    by: Sequence[str] = USER,
    null_dates: str = FIRST,
    null_users: str = KEEP,
    broadcast_bytes: int = BROADCAST_BYTES,
    losses: Losses | None = None,
) -> DataFrame:
    """Days from launch to first sighting for each user, or each user and month.

    A user first seen before the launch is dropped only after that first sighting is
    chosen (:func:`first_devices`), so a later one does not bring the user back.
    """
    first = first_devices(profiles, lookup, launches, brand, by, null_dates, null_users, broadcast_bytes, losses)
    return non_negative((losses or NoLosses()).users(launch_delta(first)))


def batch_datamart(
    profiles: DataFrame,
    lookup: DataFrame,
    launches: DataFrame,
    bands: Sequence[Band] | DataFrame = MY_BANDS,
    labels: Labels = Labels(),
    losses: Losses | None = None,
) -> DataFrame:
    """Segments over all months together, one first device per user."""
    deltas = user_deltas(profiles, lookup, launches, labels.device_brand, losses=losses)
    return assign_segments(deltas, bands, labels)


def monthly_datamart(
    profiles: DataFrame,
    lookup: DataFrame,
    launches: DataFrame,
    bands: Sequence[Band] | DataFrame = ID_DOCUMENTED,
    labels: Labels = Labels(),
) -> DataFrame:
    """Segments month by month: a user has a row for each month with a first device."""
    deltas = user_deltas(profiles, lookup, launches, labels.device_brand, MONTH_USER)
    return assign_segments(deltas, bands, labels)


def derived_datamart(
    profiles: DataFrame,
    lookup: DataFrame,
    launches: DataFrame,
    shares: Sequence[str] = SHARES,
    bands: Sequence[Band] = MY_BANDS,
    labels: Labels = Labels(),
) -> DataFrame:
    """Segments over all months by bands cut from the same deltas.

    The deltas are computed once and stored; their histogram, which gives the bands, and the
    segments are read from there.
    """
    deltas = kept(user_deltas(profiles, lookup, launches, labels.device_brand), "deltas")
    cut = derive_bands(delta_histogram(deltas, one_row_per_user=True), shares, bands)
    return assign_segments(deltas, cut, labels)
