"""Parquet scans of the nested monthly profiles."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from launchtide.functions import month_of_path
from launchtide.functions.columns import month_pattern
from launchtide.schemas import PROFILE
from launchtide.sources.months import by_schema, distinct_names, found_directories

_FILES = {"pathGlobFilter": "*.parquet", "recursiveFileLookup": "true"}


def profile_directories(
    spark: SparkSession,
    base: str,
    country: str,
    months: str | Iterable[str | int],
    directory: str = "{country}/{month}",
) -> list[str]:
    """The directories that hold the profiles of ``months``, each once."""
    names = distinct_names([months] if isinstance(months, str) else months)
    paths = [f"{base}/{directory.format(country=country, month=name)}" for name in names]
    return list(dict.fromkeys(found_directories(spark, paths)))


def profile_months(
    spark: SparkSession,
    base: str,
    country: str,
    months: str | Iterable[str | int],
    directory: str = "{country}/{month}",
) -> list[int]:
    """The months that a list or glob finds, rising, from the names of directories alone."""
    pattern = re.compile(month_pattern(directory, country))
    found = [pattern.match(f"{path}/") for path in profile_directories(spark, base, country, months, directory)]
    return sorted({int(match[1]) for match in found if match})


def read_profiles(
    spark: SparkSession,
    base: str,
    country: str,
    months: str | Iterable[str | int],
    directory: str = "{country}/{month}",
    with_month: bool = True,
) -> DataFrame:
    """Profiles of one country as ``month, ifa, device, app``, in one scan.

    ``months`` is a month, a list of months, or a glob such as ``202{0*,101,102}``; one
    named twice is read once. The month is read off the path where ``directory`` has it.
    Only the directories named are listed, so other months cost nothing. Reading
    directories rather than a glob over files spares the driver one path per file.
    Without need for the month leave it out: Spark numbers the rows of a scan whose
    file path is selected and then not used.

    Each month's schema is looked up in one of its files. A month that lacks a member, or has
    it with another type, is an error that names its directory. Where months differ in other
    members, only those needed are read. Months with zoned and with unzoned times are read apart
    and united; unzoned ones then stand for times of the session's zone.
    """
    directories = profile_directories(spark, base, country, months, directory)
    groups = by_schema(spark, directories, PROFILE, "profile table", _FILES)
    if not groups:
        # No file anywhere: Spark says so.
        return spark.read.options(**_FILES).parquet(*directories)
    path = F.col("_metadata.file_path")
    month = [month_of_path(path, directory, country).alias("month")] if with_month else []
    scans = [
        spark.read.options(**_FILES).schema(schema).parquet(*paths).select(*month, "ifa", "device", "app")
        for schema, paths in groups
    ]
    if len(scans) == 1:
        return scans[0]
    zoned: T.DataType = PROFILE["app"].dataType
    united = None
    for scan in scans:
        scan = scan.withColumn("app", F.col("app").cast(zoned))
        united = scan if united is None else united.unionByName(scan)
    return united
