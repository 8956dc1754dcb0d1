"""CSV scans of the two lookup tables; every column is text, named by the header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from launchtide.operators.devices import device_lookup, launches
from launchtide.schemas import DEVICE_LOOKUP, LAUNCHES, require


def read_device_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The device table as ``model, brand, name``."""
    raw = spark.read.csv(path, header=True)
    require(raw.schema, DEVICE_LOOKUP, "device lookup")
    return device_lookup(raw)


def read_launches(spark: SparkSession, path: str) -> DataFrame:
    """The launch table as ``name, launch``."""
    raw = spark.read.csv(path, header=True)
    require(raw.schema, LAUNCHES, "launch table")
    return launches(raw)
