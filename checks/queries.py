
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import testmap
from checks.testmap import BRAND, COUNTRY, DIRECTORY, LABELS, scratch
from launchtide.operators import (
    assign_segments,
    combine_histograms,
    datamart_totals,
    delta_histogram,
    delta_row_histogram,
    derive_bands,
    distinct_users,
    device_lookup,
    enrich,
    first_device,
    join_launches,
    launch_delta,
    non_negative,
    segment_audit,
    sightings,
)
from launchtide.operators.uptake import MONTH_USER, USER
from launchtide.operators.sightings import on_platform
from launchtide.journal import begin
from launchtide.plans import (
    audit_path,
    batch_datamart,
    derived_datamart,
    distinct_histogram,
    first_devices,
    losses_path,
    merge_first,
    monthly_datamart,
    read_datamart,
    run_batch,
    run_incremental,
    run_monthly,
    run_monthly_segments,
    update_user_sets,
    user_deltas,
)
from launchtide.schemas import ID_AS_CODED, ID_DOCUMENTED, MY_BANDS, NOT_DETECTED, Labels
from launchtide.sinks import write_datamart, write_deltas, write_histograms, write_report
from launchtide.sources import (
    read_deltas,
    read_device_lookup,
    read_histograms,
    read_launches,
    read_profiles,
)

Query = Callable[[SparkSession, str], DataFrame]

# The month scanned alone, and a glob over all months of the test tables.
ONE_MONTH = 199806
ALL_MONTHS = "{199*,200*}"


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        testmap.profiles(spark, sf_dir),
        testmap.lookup(spark, sf_dir),
        testmap.launch_table(spark, sf_dir),
    )


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(testmap.profiles(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str, brand: str | None = BRAND) -> DataFrame:
    return enrich(_flat(spark, sf_dir), testmap.lookup(spark, sf_dir), brand)


def _first(spark: SparkSession, sf_dir: str, by: tuple[str, ...] = USER) -> DataFrame:
    launches = testmap.launch_table(spark, sf_dir)
    return first_device(_enriched(spark, sf_dir), launches, by)


def _deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_deltas(*_inputs(spark, sf_dir), BRAND)


def _monthly_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_deltas(*_inputs(spark, sf_dir), BRAND, MONTH_USER)


def _monthly_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_histogram(_monthly_deltas(spark, sf_dir), ("month",), one_row_per_user=True)


def _datamart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_datamart(*_inputs(spark, sf_dir), MY_BANDS, LABELS)


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_datamart(*_inputs(spark, sf_dir), ID_AS_CODED, LABELS)


# Scans and sinks


def _scanned(spark: SparkSession, sf_dir: str, months: str | list[int]) -> DataFrame:
    base = testmap.stored_profiles(spark, sf_dir)
    return read_profiles(spark, base, COUNTRY, months, DIRECTORY).select(
        "month", "ifa", "device.platform", "device.device_model", F.size("app.first_seen").alias("n_apps")
    )


def scan_profiles_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scanned(spark, sf_dir, [ONE_MONTH])


def scan_profiles_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scanned(spark, sf_dir, ALL_MONTHS)


def scan_profiles_unequal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months, of which every other has another member and times with a zone."""
    base = scratch(spark, "profiles")
    profiles = testmap.profiles(spark, sf_dir)
    other = profiles.withColumns(
        {
            "device": F.struct(F.lit("x").alias("carrier"), "device.device_model", "device.platform"),
            "app": F.col("app").cast("array<struct<first_seen:timestamp>>"),
        }
    )
    for table, rest in ((profiles, 0), (other, 1)):
        rows = table.filter(F.col("month") % 2 == rest).hint("rebalance", "month")
        rows.write.partitionBy("month").mode("append").parquet(f"{base}/{COUNTRY}")
    return read_profiles(spark, base, COUNTRY, ALL_MONTHS, DIRECTORY).select(
        "month", "ifa", "device.platform", "device.device_model", F.size("app.first_seen").alias("n_apps")
    )


def scan_device_lookup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "device_lookup")
    testmap.raw_device_lookup(spark, sf_dir).write.csv(path, header=True)
    return read_device_lookup(spark, path)


def scan_launch_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "launches")
    testmap.raw_launches(spark, sf_dir).write.csv(path, header=True)
    return read_launches(spark, path)


def sink_histogram_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "histograms")
    write_histograms(_monthly_histograms(spark, sf_dir), path)
    return spark.read.parquet(path)


def scan_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "histograms")
    write_histograms(_monthly_histograms(spark, sf_dir), path)
    return read_histograms(spark, path)


def sink_deltas_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "deltas")
    write_deltas(_monthly_deltas(spark, sf_dir), path)
    return spark.read.parquet(path)


def scan_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "deltas")
    write_deltas(_monthly_deltas(spark, sf_dir), path)
    return read_deltas(spark, path)


def sink_histogram_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "report")
    write_report(combine_histograms(_monthly_histograms(spark, sf_dir)), path)
    return spark.read.schema("delta int, sum_count bigint").csv(path, header=True)


def sink_datamart_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "datamart")
    write_datamart(_datamart(spark, sf_dir), path)
    return spark.read.parquet(path)


# Profiles to sightings


def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testmap.profiles(spark, sf_dir).select("ifa", "device.device_model")


def expand_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testmap.profiles(spark, sf_dir).select("ifa", "device.*")


def explode_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        testmap.profiles(spark, sf_dir)
        .select("ifa", "device.*", F.explode("app").alias("app"))
        .select("ifa", "platform", "device_model", "app.first_seen")
    )


def filter_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_platform(testmap.profiles(spark, sf_dir)).select("ifa", "device.*")


def flatten_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(testmap.profiles(spark, sf_dir).drop("month"))


def derive_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _flat(spark, sf_dir)
        .select("ifa", "first_seen", F.to_date("first_seen").alias("date"))
        .withColumns({"year": F.year("date"), "month": F.month("date")})
    )


# Lookups


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The renamed lookup beside each sighting, before anything is filled."""
    flat = _flat(spark, sf_dir).select("ifa", "first_seen", F.col("device_model").alias("model"))
    names = device_lookup(testmap.raw_device_lookup(spark, sf_dir))
    return flat.join(names, "model", "left").select("ifa", "first_seen", "brand", "name")


def fill_not_detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(spark, sf_dir).fillna(NOT_DETECTED)


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, None).drop("month", "brand", "Release_Year", "Release_Month")


def enrich_device_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, None).drop("month")


def enrich_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).drop("month")


def filter_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brand of sightings that the lookup does not have."""
    return _enriched(spark, sf_dir, NOT_DETECTED).drop("month")


def launch_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testmap.launch_table(spark, sf_dir)


def join_launch_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    launches = testmap.launch_table(spark, sf_dir)
    return join_launches(_enriched(spark, sf_dir), launches).select(
        "ifa", "first_seen", "name", "launch"
    )


# First device and delta


def first_launched_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_devices(*_inputs(spark, sf_dir), BRAND)


def first_device_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from exploded and enriched sightings."""
    return _first(spark, sf_dir)


def merge_first_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the first devices of three spans of months."""
    profiles, *lookups = _inputs(spark, sf_dir)
    spans = (F.col("month") < 199603, F.col("month").between(199603, 199809), F.col("month") > 199809)
    return merge_first(*(first_devices(profiles.filter(span), *lookups, BRAND) for span in spans))


def first_launched_device_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first(spark, sf_dir, MONTH_USER)


def launch_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return launch_delta(_first(spark, sf_dir))


def filter_nonnegative_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return non_negative(launch_deltas(spark, sf_dir))


# The same beyond the size of a broadcast


def deltas_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_deltas(*_inputs(spark, sf_dir), BRAND, broadcast_bytes=-1)


def enrich_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = testmap.lookup(spark, sf_dir)
    return enrich(_flat(spark, sf_dir), lookup, BRAND, broadcast_bytes=-1).drop("month")


def join_launch_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    launches = testmap.launch_table(spark, sf_dir)
    joined = join_launches(_enriched(spark, sf_dir), launches, broadcast_bytes=-1)
    return joined.select("ifa", "first_seen", "name", "launch")


# Histograms


def users_per_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_histogram(_monthly_deltas(spark, sf_dir))


def rows_per_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_row_histogram(_monthly_deltas(spark, sf_dir))


def delta_histogram_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly_histograms(spark, sf_dir)


def combined_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_histograms(_monthly_histograms(spark, sf_dir))


def derive_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = delta_histogram(_deltas(spark, sf_dir), one_row_per_user=True)
    return derive_bands(histogram).select("segment", "lo", "hi")


# Segments


def _one_segment(number: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return assign_segments(_deltas(spark, sf_dir), MY_BANDS[number : number + 1], LABELS)

    return query


def label_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = Labels(quarter="202201", adoption_type="uptake", device_brand="any")
    return assign_segments(_deltas(spark, sf_dir), MY_BANDS, labels)


def segment_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five segments of the same deltas, a branch each; the shuffle by user serves all."""
    deltas = _deltas(spark, sf_dir)
    union = assign_segments(deltas, MY_BANDS[:1], LABELS)
    for band in MY_BANDS[1:]:
        union = union.unionByName(assign_segments(deltas, [band], LABELS))
    return union


def segment_datamart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _datamart(spark, sf_dir)


def segment_datamart_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_datamart(*_inputs(spark, sf_dir), ID_AS_CODED, LABELS)


def segment_datamart_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_datamart(*_inputs(spark, sf_dir), ID_DOCUMENTED, LABELS)


def segment_datamart_monthly_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir)


def segment_datamart_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived_datamart(*_inputs(spark, sf_dir), labels=LABELS)


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_audit(_coded(spark, sf_dir))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datamart_totals(_coded(spark, sf_dir))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_users(_coded(spark, sf_dir))


# The stored jobs, from files to files


def _files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Profiles by month and both lookups, as a job finds them."""
    files = {name: scratch(spark, name) for name in ("lookup", "launches")}
    testmap.raw_device_lookup(spark, sf_dir).write.csv(files["lookup"], header=True)
    testmap.raw_launches(spark, sf_dir).write.csv(files["launches"], header=True)
    return files | {"profiles": testmap.stored_profiles(spark, sf_dir), "country": COUNTRY, "months": ALL_MONTHS, "directory": DIRECTORY}


def job_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_batch(
        spark, **_files(spark, sf_dir), out=scratch(spark, "datamart"), bands=MY_BANDS, labels=LABELS
    )


def job_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "datamart")
    run_batch(spark, **_files(spark, sf_dir), out=out, bands=MY_BANDS, labels=LABELS)
    return spark.read.parquet(losses_path(out))


def segment_many_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A band for each part, 30 days from its key's remainder by 1000: beyond what stands as literals."""
    key = F.col("p_partkey")
    low = (key % 1000).cast("int")
    bands = testmap.table(spark, sf_dir, "part").select(
        F.concat(F.lit("b"), key).alias("segment"), F.lit("SEG").alias("segment_id"), low.alias("lo"), (low + 30).alias("hi")
    )
    return assign_segments(_deltas(spark, sf_dir), bands, LABELS).groupBy("segment").agg(
        F.count("*").alias("n"), F.min("delta").alias("least"), F.max("delta").alias("most")
    )


def job_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job where a run died after writing some of its table."""
    out = scratch(spark, "datamart")
    begin(spark, out)
    _datamart(spark, sf_dir).limit(5).write.parquet(out)
    run_batch(spark, **_files(spark, sf_dir), out=out, bands=MY_BANDS, labels=LABELS)
    return read_datamart(spark, out)


def job_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job with months added to a state, some named again."""
    state, files = scratch(spark, "state"), _files(spark, sf_dir)
    for months in ("199[5-6]*", ["1997*", "199612"], ALL_MONTHS):
        out = scratch(spark, "datamart")
        run_incremental(spark, **files | {"months": months}, state=state, out=out, bands=MY_BANDS, labels=LABELS)
    return read_datamart(spark, out)


def job_monthly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "monthly")
    run_monthly(spark, **_files(spark, sf_dir), out=out, brand=BRAND)
    return spark.read.schema("delta int, sum_count bigint").csv(f"{out}/report", header=True)


def _job_segments(spark: SparkSession, sf_dir: str, bands: tuple | None) -> str:
    out, datamart = scratch(spark, "monthly"), scratch(spark, "datamart")
    run_monthly(spark, **_files(spark, sf_dir), out=out, brand=BRAND)
    run_monthly_segments(spark, out, datamart, bands, LABELS)
    return datamart


def job_monthly_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_job_segments(spark, sf_dir, ID_AS_CODED))


def job_monthly_segments_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_job_segments(spark, sf_dir, None))


def job_monthly_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(audit_path(_job_segments(spark, sf_dir, ID_AS_CODED)))


def _reach(spark: SparkSession, sf_dir: str, *parts: str) -> str:
    """Sets of users of all months, added part by part."""
    out, files = scratch(spark, "monthly"), _files(spark, sf_dir)
    for months in parts:
        run_monthly(spark, **files | {"months": months}, out=out, brand=BRAND)
        update_user_sets(spark, out)
    return out


def job_distinct_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months added in two parts, a year of the first one run again with the second."""
    return distinct_histogram(spark, _reach(spark, sf_dir, "199[0-5]*", "{1995*,199[6-9]*,2*}"))


def job_distinct_histogram_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users over four years of months, from sets of all months."""
    years = range(1994, 1998)
    months = [100 * year + month for year in years for month in range(1, 13)]
    return distinct_histogram(spark, _reach(spark, sf_dir, ALL_MONTHS), months)


def preview_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _datamart(spark, sf_dir).orderBy("delta", "ifa").limit(5)


QUERIES: dict[str, Query] = {
    "scan_profiles_month": scan_profiles_month,
    "scan_profiles_months": scan_profiles_months,
    "scan_profiles_unequal": scan_profiles_unequal,
    "scan_device_lookup_csv": scan_device_lookup_csv,
    "scan_launch_csv": scan_launch_csv,
    "scan_histograms": scan_histograms,
    "scan_deltas": scan_deltas,
    "sink_datamart_parquet": sink_datamart_parquet,
    "sink_histogram_parquet": sink_histogram_parquet,
    "sink_histogram_csv": sink_histogram_csv,
    "sink_deltas_parquet": sink_deltas_parquet,
    "project_columns": project_columns,
    "expand_struct": expand_struct,
    "explode_apps": explode_apps,
    "filter_platform": filter_platform,
    "flatten_sightings": flatten_sightings,
    "derive_date_parts": derive_date_parts,
    "rename_columns": rename_columns,
    "drop_columns": drop_columns,
    "fill_not_detected": fill_not_detected,
    "enrich_device_left": enrich_device_left,
    "enrich_device": enrich_device,
    "filter_brand": filter_brand,
    "launch_dimension": launch_dimension,
    "join_launch_inner": join_launch_inner,
    "first_launched_device": first_launched_device,
    "first_device_stepwise": first_device_stepwise,
    "merge_first_device": merge_first_device,
    "first_launched_device_monthly": first_launched_device_monthly,
    "launch_delta": launch_deltas,
    "filter_nonnegative_delta": filter_nonnegative_delta,
    "deltas_large_lookup": deltas_large_lookup,
    "enrich_large_lookup": enrich_large_lookup,
    "join_launch_large_lookup": join_launch_large_lookup,
    "delta_histogram": users_per_delta,
    "delta_row_histogram": rows_per_delta,
    "delta_histogram_monthly": delta_histogram_monthly,
    "combine_histograms": combined_histogram,
    "derive_thresholds": derive_thresholds,
    "segment_innovator": _one_segment(0),
    "segment_early_adopter": _one_segment(1),
    "segment_early_majority": _one_segment(2),
    "segment_late_majority": _one_segment(3),
    "segment_laggard": _one_segment(4),
    "label_segments": label_segments,
    "segment_union": segment_union,
    "segment_datamart": segment_datamart,
    "segment_datamart_overlap": segment_datamart_overlap,
    "segment_datamart_monthly": segment_datamart_monthly,
    "segment_datamart_monthly_coded": segment_datamart_monthly_coded,
    "segment_datamart_derived": segment_datamart_derived,
    "segment_many_bands": segment_many_bands,
    "segment_audit": audit,
    "datamart_totals": totals,
    "distinct_users": users,
    "job_batch": job_batch,
    "job_rerun": job_rerun,
    "job_losses": job_losses,
    "job_incremental": job_incremental,
    "job_monthly_report": job_monthly_report,
    "job_monthly_segments": job_monthly_segments,
    "job_monthly_segments_derived": job_monthly_segments_derived,
    "job_monthly_audit": job_monthly_audit,
    "job_distinct_histogram": job_distinct_histogram,
    "job_distinct_histogram_some": job_distinct_histogram_some,
    "preview_segment": preview_segment,
}
