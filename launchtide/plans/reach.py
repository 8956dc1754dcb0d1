"""Distinct users over any months, kept as bitmaps beside the month-wise deltas.

:func:`launchtide.plans.jobs.run_monthly` stores deltas and histograms month by month. Its
report adds the histograms up, so a user seen in three months counts three times. Counting
users once needs the deltas of all months, or what is kept here: a number for each user, and
for each month and delta the set of those numbers. One more month costs its deltas and a
join with the numbers given so far; a count over any months reads their sets alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchtide.journal import (
    Run,
    begin,
    commit,
    last_committed,
    require_committed,
    require_counts,
    runs,
    unfinished,
)
from launchtide.operators.user_sets import code_users, count_user_sets, user_sets
from launchtide.schemas import CODES, require
from launchtide.sinks import write_user_sets
from launchtide.sinks.shared import kept
from launchtide.sources import read_deltas, read_user_sets


def sets_path(out: str) -> str:
    """Where the sets of users of the months under ``out`` lie: ``month, delta, bucket, users``."""
    return f"{out.rstrip('/')}/user-sets"


def _codes_path(out: str, run: Run) -> str:
    return f"{out.rstrip('/')}/user-codes/run={run.nth}-{run.name}"


def read_codes(spark: SparkSession, out: str) -> DataFrame:
    """``ifa, code`` of all users so far; numbers that a run gave and never committed are left out."""
    paths = [_codes_path(out, run) for run in runs(spark, sets_path(out)) if run.committed and run.notes.get("codes")]
    if not paths:
        return spark.createDataFrame([], CODES)
    found = spark.read.parquet(*paths)
    require(found.schema, CODES, "user codes")
    return found.select("ifa", "code")


def _writers(spark: SparkSession, path: str) -> dict[str, str]:
    """For each month, the committed run that wrote it last."""
    done = sorted((run for run in runs(spark, path) if run.committed), key=lambda run: run.nth)
    return {month: run.name for run in done for month in run.parts}


def stale_months(spark: SparkSession, out: str) -> list[int]:
    """Months whose deltas are newer than their sets, or whose sets a run left unfinished."""
    path = sets_path(out)
    known: dict[str, str] = {}
    for run in sorted((run for run in runs(spark, path) if run.committed), key=lambda run: run.nth):
        known |= {month: run.notes[month] for month in run.parts if month in run.notes}
    deltas, left = _writers(spark, out), unfinished(spark, path)
    return sorted(int(m) for m in deltas if known.get(m) != deltas[m] or m in left)


def update_user_sets(spark: SparkSession, out: str) -> DataFrame:
    """Bring the sets of users up to the deltas that ``run_monthly`` stored; returns the sets.

    Only months that are new, or were run again since, are read. Users not seen before are
    numbered after those known, and no number ever changes, so sets of other months stay
    right. The sets' own journal commits them once every stored month holds as many users as
    its deltas; a run that dies is covered by the next.
    """
    require_committed(spark, out)
    path = sets_path(out)
    months = stale_months(spark, out)
    if not months:
        return read_user_sets(spark, path)
    writers = _writers(spark, out)
    deltas = read_deltas(spark, f"{out}/deltas", months).select("month", "ifa", "delta")
    known = last_committed(spark, path)
    above = int(known.notes["last"]) if known else 0
    codes = read_codes(spark, out)
    run = begin(spark, path, months)
    users = deltas.filter("ifa is not null").groupBy("ifa").agg(F.min("delta").alias("delta"))
    new = kept(users.join(codes, "ifa", "left_anti"), "new-users")
    code_users(new, above).write.mode("overwrite").option("compression", "zstd").parquet(_codes_path(out, run))
    added = spark.read.schema(codes.schema).parquet(_codes_path(out, run))
    n, last = added.agg(F.count("*"), F.max("code")).first()
    require_counts(f"the user codes of {out}", {"the new users": new.count()}, {"the new users": n})
    require_counts(f"the user codes of {out}", {"the last code": above + n}, {"the last code": last or above})
    write_user_sets(user_sets(deltas, codes.unionByName(added)), path, months)
    stored = read_user_sets(spark, path)
    wanted = _by_month(deltas.groupBy("month").agg(F.count("ifa").alias("n")))
    bits = F.when(F.col("bucket").isNull(), F.lit(0)).otherwise(F.bitmap_count("users"))
    found = _by_month(read_user_sets(spark, path, months).groupBy("month").agg(F.sum(bits).alias("n")))
    counts = {str(month): wanted.get(str(month), 0) for month in months}
    require_counts(f"the user sets of {out}", counts, found)
    notes = {str(month): writers[str(month)] for month in months} | {"last": str(above + n)}
    commit(spark, path, run, counts, notes | ({"codes": str(n)} if n else {}))
    return stored


def _by_month(table: DataFrame) -> dict[str, int]:
    return {str(row["month"]): row["n"] for row in table.collect()}


def distinct_histogram(spark: SparkSession, out: str, months: Iterable[int] | None = None) -> DataFrame:
    """Distinct users per delta over some stored months, or all, as ``delta, count``.

    Equal to ``delta_histogram`` over the deltas of those months, which are not read. Sets that
    are older than the deltas are an error: call :func:`update_user_sets` first.
    """
    require_committed(spark, out)
    require_committed(spark, sets_path(out))
    stale = stale_months(spark, out)
    if stale:
        raise ValueError(f"the user sets at {out} lack months as they are now: {', '.join(map(str, stale))}")
    return count_user_sets(read_user_sets(spark, sets_path(out), months))
