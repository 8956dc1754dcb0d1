"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the threads. The test tables are written
once, before the clock starts, as the files that a user of the package has: profiles by year in
``FILES`` files each, the lookups as CSV. Each query runs once to warm up, then ``BENCH_RUNS``
times; the least time counts. Results go to Spark's ``noop`` sink, so every row is computed
and none is kept; jobs write their files.

``queries`` are the headlines on those files. ``plain`` is the step-by-step form of the
datamart and ``shuffled`` the package's with no lookup small enough to broadcast. ``stored`` and
``skewed`` are the main plans on ``BENCH_COPIES`` copies of the tables with users of their own,
``skewed`` with a third of the profiles without user, of one model and at one time. ``mapped`` are
registered queries that read the test tables as profiles on the way.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import testmap
from checks.plain import plain_deltas, plain_segments
from checks.queries import QUERIES
from launchtide.operators import (
    assign_segments,
    combine_histograms,
    delta_histogram,
    derive_bands,
    enrich,
    first_device,
    segment_audit,
    sightings,
)
from launchtide.operators.uptake import MONTH_USER
from launchtide.plans import (
    batch_datamart,
    derived_datamart,
    first_devices,
    monthly_datamart,
    run_batch,
    run_incremental,
    run_monthly,
    run_monthly_segments,
    user_deltas,
)
from launchtide.schemas import ID_AS_CODED, MY_BANDS
from launchtide.sources import read_device_lookup, read_launches, read_profiles

MAPPED = ["flatten_sightings", "first_launched_device", "segment_datamart"]
FILES = 32


def stored_inputs(spark: SparkSession, sf_dir: str, copies: int, skewed: bool) -> str:
    """Profiles below a new base, by country and month, each month in ``FILES`` files."""
    profiles = testmap.profiles(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    profiles = profiles.withColumn("ifa", F.concat_ws("-", "copy", "ifa")).drop("copy")
    if skewed:
        hot = F.xxhash64("ifa", "device", "app") % 3 == 0
        device = F.struct(F.lit("Android").alias("platform"), F.lit("1").alias("device_model"))
        app = F.array(F.struct(F.lit(None).cast("timestamp_ntz").alias("first_seen")))
        profiles = profiles.withColumns(
            {"ifa": F.when(~hot, F.col("ifa")), "device": F.when(hot, device).otherwise(F.col("device")), "app": F.when(hot, app).otherwise(F.col("app"))}
        )
    base = testmap.scratch(spark, "bench")
    # A directory a year keeps the files large.
    year = (F.col("month") / 100).cast("int") * 100 + 1
    files = FILES if copies > 1 else 8
    profiles.withColumn("month", year).repartition(files).write.partitionBy("month").parquet(f"{base}/{testmap.COUNTRY}")
    return base


def lookups(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    paths = {name: testmap.scratch(spark, name) for name in ("lookup", "launches")}
    testmap.raw_device_lookup(spark, sf_dir).write.csv(paths["lookup"], header=True)
    testmap.raw_launches(spark, sf_dir).write.csv(paths["launches"], header=True)
    return paths


def plans(spark: SparkSession, base: str, paths: dict[str, str]) -> dict[str, Callable[[], DataFrame]]:
    def read(with_month: bool = False) -> DataFrame:
        return read_profiles(spark, base, testmap.COUNTRY, "*", testmap.DIRECTORY, with_month)

    lookup, launches = read_device_lookup(spark, paths["lookup"]), read_launches(spark, paths["launches"])
    brand, labels = testmap.BRAND, testmap.LABELS
    deltas = lambda by=("ifa",): user_deltas(read(by == MONTH_USER), lookup, launches, brand, by)
    monthly = lambda: delta_histogram(deltas(MONTH_USER), ("month",), one_row_per_user=True)
    return {
        "scan": lambda: read(True),
        "flatten_sightings": lambda: sightings(read()),
        "enrich_device": lambda: enrich(sightings(read()), lookup, brand),
        "first_device_stepwise": lambda: first_device(enrich(sightings(read()), lookup, brand), launches),
        "first_launched_device": lambda: first_devices(read(), lookup, launches, brand),
        "segment_datamart": lambda: batch_datamart(read(), lookup, launches, MY_BANDS, labels),
        "segment_datamart_overlap": lambda: batch_datamart(read(), lookup, launches, ID_AS_CODED, labels),
        "segment_datamart_monthly_coded": lambda: monthly_datamart(read(True), lookup, launches, ID_AS_CODED, labels),
        "segment_datamart_derived": lambda: derived_datamart(read(), lookup, launches, labels=labels),
        "segment_audit": lambda: segment_audit(monthly_datamart(read(True), lookup, launches, ID_AS_CODED, labels)),
        "delta_histogram": lambda: delta_histogram(deltas(), one_row_per_user=True),
        "delta_histogram_monthly": monthly,
        "combine_histograms": lambda: combine_histograms(monthly()),
        "derive_thresholds": lambda: derive_bands(delta_histogram(deltas(), one_row_per_user=True)),
        "shuffled": lambda: assign_segments(user_deltas(read(), lookup, launches, brand, broadcast_bytes=-1), MY_BANDS, labels),
        "plain": lambda: plain_segments(plain_deltas(read(), lookup, launches, brand), MY_BANDS, labels),
    }


def jobs(spark: SparkSession, base: str, paths: dict[str, str]) -> dict[str, Callable[[], DataFrame]]:
    """The stored jobs; the incremental one adds the last year to a state that holds the others."""
    where = {"profiles": base, "country": testmap.COUNTRY, "directory": testmap.DIRECTORY}
    named = where | paths

    def monthly() -> DataFrame:
        out = testmap.scratch(spark, "monthly")
        run_monthly(spark, **named, months="*", out=out, brand=testmap.BRAND)
        return run_monthly_segments(spark, out, testmap.scratch(spark, "datamart"), ID_AS_CODED, testmap.LABELS)

    def batch() -> DataFrame:
        return run_batch(spark, **named, months="*", out=testmap.scratch(spark, "datamart"), labels=testmap.LABELS)

    def add(state: str, months: str) -> DataFrame:
        out = testmap.scratch(spark, "datamart")
        return run_incremental(spark, **named, months=months, state=state, out=out, labels=testmap.LABELS)

    states = [testmap.scratch(spark, "state") for _ in range(4)]
    for state in states:
        add(state, "{199*,2000*}")
    return {"job_batch": batch, "job_monthly_segments": monthly, "job_incremental": lambda: add(states.pop(), "2001*")}


def seconds(make: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def least(make: Callable[[], DataFrame], runs: int) -> float:
    seconds(make)
    return round(min(seconds(make) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = min(int(os.environ.get("BENCH_RUNS", "2")), 3)
    copies = int(os.environ.get("BENCH_COPIES", "4"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("launchtide-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="launchtide-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    paths = lookups(spark, sf_dir)
    base = stored_inputs(spark, sf_dir, 1, False)
    made = plans(spark, base, paths) | jobs(spark, base, paths)
    times = {key: least(make, runs) for key, make in made.items()}
    inputs = {}
    for name, skewed in (("stored", False), ("skewed", True)):
        made = plans(spark, stored_inputs(spark, sf_dir, copies, skewed), paths)
        chosen = ("scan", "segment_datamart", "segment_datamart_monthly_coded", "segment_audit", "first_device_stepwise", "shuffled", "plain")
        inputs[name] = {key: least(made[key], runs) for key in chosen}
    inputs["mapped"] = {key: least(lambda key=key: QUERIES[key](spark, sf_dir), runs) for key in MAPPED}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                **inputs,
                "copies": copies,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
