"""Writers of the segment table, the month-wise tables and the histogram report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from launchtide.functions.observed import observed
from launchtide.sinks.shared import kept

#: Rows of a file of a month, about; some 100 MB of deltas.
ROWS = 4_000_000
#: Rows of a file of sets of users, about; some 100 MB of bitmaps.
SET_ROWS = 25_000


def write_datamart(datamart: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write the segment table and return its rows; fails when something is there already."""
    written = Observation()
    datamart.observe(written, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return observed(written).get("n", 0)


def month_parts(counts: Mapping[int, int], rows: int) -> dict[int, int]:
    """In how many parts each month is written, of about ``rows`` rows each."""
    return {month: max(1, -(-n // rows)) for month, n in counts.items()}


def _overwrite_months(
    table: DataFrame, path: str, months: Iterable[int] | None, rows: int, compression: str | None = None
) -> None:
    """Replace the months ``table`` holds, and empty those of ``months`` it has no rows for.

    Other months at ``path`` stay. The table is stored and its months are counted first. Each
    month is then dealt over as many tasks as its rows fill, by a hash of the row, so a hot
    month is split, a small one is one file, and neither depends on adaptive execution.
    """
    spark = table.sparkSession
    table = kept(table, "months")
    counts = {row["month"]: row["n"] for row in table.groupBy("month").agg(F.count("*").alias("n")).collect()}
    if counts:
        parts, start, places = month_parts(counts, rows), 0, []
        for month in sorted(parts):
            places.append((month, start, parts[month]))
            start += parts[month]
        plan = F.broadcast(spark.createDataFrame(places, "month int, first int, parts int"))
        own = F.pmod(F.xxhash64(*table.columns), F.col("parts")).cast("int")
        written = (
            table.join(plan, "month")
            .withColumn("task", F.col("first") + own)
            .repartitionById(start, F.col("task"))
            .select(*table.columns)
            .write.option("partitionOverwriteMode", "dynamic")
            .partitionBy("month")
            .mode("overwrite")
        )
        (written.option("compression", compression) if compression else written).parquet(path)
    if months is not None:
        for month in sorted({int(m) for m in months} - set(counts)):
            nothing = table.drop("month").limit(0)
            nothing.write.mode("overwrite").parquet(f"{path}/month={month}")


def write_histograms(
    histograms: DataFrame, path: str, months: Iterable[int] | None = None, rows: int = ROWS
) -> None:
    """Overwrite month-wise histograms, one directory per month, of about ``rows`` rows a file."""
    _overwrite_months(histograms.select("month", "delta", "count"), path, months, rows)


def write_deltas(
    deltas: DataFrame, path: str, months: Iterable[int] | None = None, rows: int = ROWS
) -> None:
    """Overwrite month-wise user deltas, one directory per month, of about ``rows`` rows a file."""
    columns = ["month", "ifa", "name", "launch", "first_seen", "delta"]
    _overwrite_months(deltas.select(*columns), path, months, rows)


def write_user_sets(
    sets: DataFrame, path: str, months: Iterable[int] | None = None, rows: int = SET_ROWS
) -> None:
    """Overwrite month-wise sets of users, one directory per month, of about ``rows`` rows a file."""
    # Bitmaps of few users are mostly zeros, which this makes small.
    _overwrite_months(sets.select("month", "delta", "bucket", "users"), path, months, rows, "zstd")


def write_report(histogram: DataFrame, path: str) -> None:
    """Overwrite a histogram as one CSV file with a header, for a person to read.

    One file takes one task. A histogram has one row per whole number of days
    between two dates, a few thousand in practice, whatever the number of users.
    """
    one_file = histogram.coalesce(1).sortWithinPartitions("delta")
    one_file.write.csv(path, header=True, mode="overwrite")
