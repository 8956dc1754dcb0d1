"""The two jobs as a user runs them: from stored profiles to stored segments."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchtide.journal import begin, commit, exists, last_run, require_committed, require_counts
from launchtide.operators.histogram import SHARES, combine_histograms, delta_histogram, derive_bands
from launchtide.operators.losses import Losses
from launchtide.operators.segments import assign_segments, segment_audit
from launchtide.operators.uptake import MONTH_USER
from launchtide.plans.uptake import batch_datamart, user_deltas
from launchtide.schemas import ID_DOCUMENTED, MY_BANDS, Band, Labels
from launchtide.sinks import write_datamart, write_deltas, write_histograms, write_report
from launchtide.sources import (
    read_deltas,
    read_device_lookup,
    read_histograms,
    read_launches,
    read_profiles,
)
from launchtide.sources.profiles import profile_months

DIRECTORY = "{country}/{month}"


def audit_path(datamart: str) -> str:
    """Where the audit of a stored segment table lies: ``segment, n_rows, n_users``."""
    return f"{datamart.rstrip('/')}-audit"


def losses_path(datamart: str) -> str:
    """Where the losses of a stored segment table lie: ``step, n``."""
    return f"{datamart.rstrip('/')}-losses"


def publish(spark: SparkSession, datamart: DataFrame, path: str, losses: Losses | None = None) -> DataFrame:
    """Write a segment table and its audit as one, and return the table as stored.

    With ``losses`` that counted along ``datamart``, they are stored too (:func:`losses_path`).

    The run is entered in the journal beside ``path`` (:mod:`launchtide.journal`), the table is
    written, the audit counts what is stored, and if both agree the run is committed with the
    rows of each segment. If the job dies on the way, :func:`read_datamart` refuses the table, and
    running it again replaces what is there. A committed table, or one that
    no journal knows, is never replaced.
    """
    known = last_run(spark, path)
    if exists(spark, path) and (known is None or known.committed):
        write_datamart(datamart.limit(0), path)  # says that there is something
    run = begin(spark, path)
    n = write_datamart(datamart, path, "overwrite")
    stored = spark.read.schema(datamart.schema).parquet(path)
    segment_audit(stored).write.mode("overwrite").parquet(audit_path(path))
    counts = {row["segment"]: row["n_rows"] for row in spark.read.parquet(audit_path(path)).collect()}
    require_counts(f"the audit of {path}", {"the table": n}, {"the table": sum(counts.values())})
    if losses:
        losses.table(stored).coalesce(1).write.mode("overwrite").parquet(losses_path(path))
    commit(spark, path, run, counts)
    return stored


def read_datamart(spark: SparkSession, path: str) -> DataFrame:
    """A published segment table; an error if its run was not committed."""
    require_committed(spark, path)
    return spark.read.parquet(path)


def run_batch(
    spark: SparkSession,
    profiles: str,
    country: str,
    months: str | Iterable[str | int],
    lookup: str,
    launches: str,
    out: str,
    bands: Sequence[Band] = MY_BANDS,
    labels: Labels = Labels(),
    directory: str = DIRECTORY,
) -> DataFrame:
    """Segment the users of all ``months`` together, write the table to ``out``, return it.

    The months form a list or a glob of directory names. Rows and distinct users of each
    segment are written beside the table (:func:`audit_path`), and so are the numbers of profiles
    and users that each step left out (:func:`losses_path`); all are committed together
    (:func:`publish`).
    """
    losses = Losses()
    datamart = batch_datamart(
        read_profiles(spark, profiles, country, months, directory, with_month=False),
        read_device_lookup(spark, lookup),
        read_launches(spark, launches),
        bands,
        labels,
        losses,
    )
    return publish(spark, datamart, out, losses)


def run_monthly(
    spark: SparkSession,
    profiles: str,
    country: str,
    months: str | Iterable[str | int],
    lookup: str,
    launches: str,
    out: str,
    brand: str = Labels().device_brand,
    directory: str = DIRECTORY,
) -> DataFrame:
    """Write month-wise deltas, their histograms and the combined report under ``out``.

    The months are a list, of which one left without rows is emptied, or a glob, which
    stands for the months it finds. All months go through one job. The profiles are read for the deltas only; what
    follows reads the deltas back, so a lost executor never repeats that scan. Months
    already at ``out`` stay and count in the report, which is returned.

    The months are entered in the journal beside ``out`` before anything is written, and
    committed with their rows when deltas and histograms agree. Months of a run that died are
    refused by :func:`run_monthly_segments` until a run has covered them.
    """
    scan = read_profiles(spark, profiles, country, months, directory)
    named = [str(month) for month in ([months] if isinstance(months, str) else months)]
    if all(month.isdigit() for month in named):
        months = sorted({int(month) for month in named})
    else:
        months = profile_months(spark, profiles, country, months, directory)
    run = begin(spark, out, months)
    deltas = user_deltas(
        scan,
        read_device_lookup(spark, lookup),
        read_launches(spark, launches),
        brand,
        MONTH_USER,
    )
    write_deltas(deltas, f"{out}/deltas", months)
    stored = read_deltas(spark, f"{out}/deltas", months)
    write_histograms(
        delta_histogram(stored, ("month",), one_row_per_user=True), f"{out}/histograms", months
    )
    rows, users = (
        {str(row["month"]): row["n"] for row in table.groupBy("month").agg(n.alias("n")).collect()}
        for table, n in (
            (read_deltas(spark, f"{out}/deltas", months), F.count("ifa")),
            (read_histograms(spark, f"{out}/histograms", months), F.sum("count")),
        )
    )
    counts = {str(month): rows.get(str(month), 0) for month in months}
    require_counts(f"the histograms of {out}", counts, users)
    total = combine_histograms(read_histograms(spark, f"{out}/histograms"))
    write_report(total, f"{out}/report")
    commit(spark, out, run, counts)
    return total


def run_monthly_segments(
    spark: SparkSession,
    out: str,
    datamart: str,
    bands: Sequence[Band] | None = ID_DOCUMENTED,
    labels: Labels = Labels(),
    shares: Sequence[str] = SHARES,
) -> DataFrame:
    """Segment the stored deltas of :func:`run_monthly`, write the table, return it.

    ``bands=None`` derives the bands from the stored histograms by ``shares``. The audit is
    written beside the table (:func:`audit_path`). Deltas of a run that was not committed are
    an error.
    """
    require_committed(spark, out)
    if bands is None:
        total = combine_histograms(read_histograms(spark, f"{out}/histograms"))
        bands = derive_bands(total, shares, ID_DOCUMENTED, count="sum_count")
    segments = assign_segments(read_deltas(spark, f"{out}/deltas"), bands, labels)
    return publish(spark, segments, datamart)
