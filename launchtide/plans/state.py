"""First devices as a stored state that further months are merged into.

A user's first device is the least of the user's sightings by a total order, so the least of
the months seen so far and of new months is the least of all. The state keeps that one row a
user. A further month costs a scan of that month and a pass over the state, whatever
number of months went before.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchtide.journal import NotCommitted, begin, commit, last_committed, require_counts
from launchtide.operators.devices import launched_models
from launchtide.operators.segments import assign_segments
from launchtide.operators.uptake import first_rows, launch_delta, non_negative
from launchtide.plans.jobs import DIRECTORY, publish
from launchtide.plans.uptake import first_devices
from launchtide.schemas import BRAND, MY_BANDS, STATE, Band, Labels, require
from launchtide.sources import read_device_lookup, read_launches, read_profiles
from launchtide.sources.profiles import profile_months

COLUMNS = [field.name for field in STATE]


def merge_first(*firsts: DataFrame) -> DataFrame:
    """The first devices over tables of first devices: ``ifa, name, launch, first_seen, date``.

    Equal to taking them over all the sightings behind the tables, undated sightings, unreadable
    launches and ties included: rows are compared by all their columns.
    """
    united = firsts[0].select(*COLUMNS)
    for more in firsts[1:]:
        united = united.unionByName(more.select(*COLUMNS))
    return first_rows(united)


def models_mark(lookup: DataFrame, launches: DataFrame, brand: str) -> str:
    """A mark of the launched models, the same for equal tables in any order."""
    models = launched_models(lookup, launches, brand)
    each = F.xxhash64("model", "name", F.col("launch").isNull(), "launch")
    row = models.agg(F.count("*").alias("n"), F.bit_xor(each).alias("bits"), F.sum(F.pmod(each, F.lit(1 << 31))).alias("sum")).first()
    return f"{brand}:{row['n']}:{row['bits']}:{row['sum']}"


def _slot(state: str, nth: int) -> str:
    return f"{state.rstrip('/')}/{nth % 2}"


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """The last committed state; what a later run left unfinished doesn't matter."""
    run = last_committed(spark, state)
    if run is None:
        raise NotCommitted(f"no state has been committed at {state}")
    stored = spark.read.parquet(run.notes["slot"])
    require(stored.schema, STATE, "state")
    return stored.select(*COLUMNS)


def state_months(spark: SparkSession, state: str) -> list[int]:
    """The months that the last committed state holds."""
    run = last_committed(spark, state)
    return json.loads(run.notes["months"]) if run else []


def update_state(
    spark: SparkSession,
    profiles: str,
    country: str,
    months: str | Iterable[str | int],
    lookup: DataFrame,
    launches: DataFrame,
    state: str,
    brand: str = BRAND,
    directory: str = DIRECTORY,
) -> DataFrame:
    """Merge the first devices of further months into the state at ``state``; returns it.

    Only months that the state doesn't hold are read, so a month named again changes nothing. A
    state is made of one set of launched models: with others its users' choices could differ,
    and that is an error. The new state is written beside the old one and counted, then the
    journal commits it; a run that dies leaves the old one in place.
    """
    known = last_committed(spark, state)
    mark = f"{country}:{models_mark(lookup, launches, brand)}"
    held = set(json.loads(known.notes["months"])) if known else set()
    if known and known.notes["models"] != mark:
        raise ValueError(f"the state at {state} is of other models, launches or country; build a new one")
    new = [m for m in profile_months(spark, profiles, country, months, directory) if m not in held]
    if not new:
        if known is None:
            raise ValueError(f"no month of {months} is at {profiles}")
        return read_state(spark, state)
    scan = read_profiles(spark, profiles, country, new, directory, with_month=False)
    first = first_devices(scan, lookup, launches, brand)
    merged = merge_first(read_state(spark, state), first) if known else first
    run = begin(spark, state, new)
    # The slot that the last committed state does not use; a run that died may have.
    slot = next(s for s in (_slot(state, run.nth), _slot(state, run.nth + 1)) if not known or s != known.notes["slot"])
    merged = merged.select(*COLUMNS)
    merged.write.mode("overwrite").option("compression", "zstd").parquet(slot)
    stored = spark.read.schema(merged.schema).parquet(slot)
    n, users = stored.agg(F.count("*"), F.count_distinct("ifa")).first()
    require_counts(f"the state at {slot}", {"the state": users}, {"the state": n})
    if known and n < known.counts["users"]:
        raise RuntimeError(f"the state at {slot} has {n} users, the one before {known.counts['users']}")
    commit(spark, state, run, {"users": n}, {"months": json.dumps(sorted(held | set(new))), "models": mark, "slot": slot})
    return stored


def run_incremental(
    spark: SparkSession,
    profiles: str,
    country: str,
    months: str | Iterable[str | int],
    lookup: str,
    launches: str,
    state: str,
    out: str,
    bands: Sequence[Band] = MY_BANDS,
    labels: Labels = Labels(),
    directory: str = DIRECTORY,
) -> DataFrame:
    """Segments over all months so far, of which only ``months`` are read; published at ``out``.

    The rows are those of :func:`launchtide.plans.jobs.run_batch` over the months that the
    state holds and the new ones.
    """
    first = update_state(
        spark,
        profiles,
        country,
        months,
        read_device_lookup(spark, lookup),
        read_launches(spark, launches),
        state,
        labels.device_brand,
        directory,
    )
    deltas = non_negative(launch_delta(first.withColumn("date", F.to_date("first_seen"))))
    return publish(spark, assign_segments(deltas, bands, labels), out)
