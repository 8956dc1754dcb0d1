"""The hand-made profiles, lookup and launches of FIXTURES.md, 2."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

LAUNCH = datetime(2020, 3, 6, 12, 30)

# User, platform, model, and the days from launch at which apps were first seen.
# "null" days stand for a null app array, None for an undated app.
ROWS = [
    ("a01", "Android", "SM-1", [4, 1]),
    ("a02", "ANDROID", "SM-1", [7]),
    ("a03", "android", "SM-1", [108]),
    ("a04", "Android", "SM-1", [109]),
    ("a05", "Android", "SM-1", [194]),
    ("a06", "Android", "SM-1", [195]),
    ("a07", "Android", "SM-1", [341]),
    ("a08", "Android", "SM-1", [342]),
    ("a09", "iOS", "SM-1", [1]),
    ("a10", "androidtv", "SM-1", [1]),
    ("a11", "Android", "ZZ-9", [1]),
    ("a12", "Android", "OT-1", [1]),
    ("a13", "Android", "SM-1", [-5, 26]),
    ("a14", "Android", "SM-1", []),
    ("a15", "Android", "SM-1", "null"),
    ("a16", "Android", "SM-1", [None, 3]),
    (None, "Android", "SM-1", [2]),
    (None, "Android", "SM-1", [5]),
    ("a17", "Android", "SM-3", [1]),
    ("a18", "Android", "SM-4", [400]),
    ("a19", "Android", "SM-5", [1]),
    ("a20", "Android", "SM-2", [60]),
    ("a20", "Android", "SM-1", [30]),
    ("a21", "Android", "SM-1", [0]),
    ("a22", "null", None, [1]),
    ("a23", "Android", None, [1]),
    ("a24", "Android", "sm-1", [1]),
    ("b22", "Android", "SM-1", [22]),
    ("b23", "Android", "SM-1", [23]),
    ("b128", "Android", "SM-1", [128]),
    ("b129", "Android", "SM-1", [129]),
    ("b332", "Android", "SM-1", [332]),
    ("b333", "Android", "SM-1", [333]),
    ("b469", "Android", "SM-1", [469]),
    ("b470", "Android", "SM-1", [470]),
]

KEPT = {
    "a01": 1, "a02": 7, "a03": 108, "a04": 109, "a05": 194, "a06": 195, "a07": 341, "a08": 342,
    "Not Detected": 2, "a18": 344, "a20": 30, "a21": 0, "b22": 22, "b23": 23, "b128": 128,
    "b129": 129, "b332": 332, "b333": 333, "b469": 469, "b470": 470,
}

# One member more than needed in each struct, to show that scans leave it out.
SCHEMA = """
    ifa string,
    device struct<platform:string, device_model:string, carrier:string>,
    app array<struct<first_seen:timestamp, bundle:string>>
"""

LOOKUP = [
    ("Samsung", "Phone One", "SM-1"),
    ("Samsung", "Phone Two", "SM-2"),
    ("Samsung", "Phone Three", "SM-3"),
    ("Samsung", "Phone Four", "SM-4"),
    ("Samsung", "Phone Four Plus", "SM-4"),
    ("Samsung", "Phone Five", "SM-5"),
    ("Other", "Phone One", "OT-1"),
]

LAUNCHES = [
    ("Phone One", "2020", "3", "2020-03-06"),
    ("Phone Two", "2020", "4", "2020-04-01"),
    ("Phone Four", "2020", "5", "2020-05-01"),
    ("Phone Four Plus", "2020", "5", "2020-05-08"),
    ("Phone Five", None, None, None),
]


def _profile(ifa, platform, model, days):
    device = None if platform == "null" else (platform, model, "carrier")
    if days == "null":
        return ifa, device, None
    apps = [(None if d is None else LAUNCH + timedelta(days=d), "bundle") for d in days]
    return ifa, device, apps


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([_profile(*row) for row in ROWS], SCHEMA)


def raw_lookup(spark: SparkSession) -> DataFrame:
    names = "`Retail Branding` string, `Marketing Name` string, Model string"
    return spark.createDataFrame(LOOKUP, names)


def raw_launches(spark: SparkSession) -> DataFrame:
    names = "Name string, Release_Year string, Release_Month string, Release_Date string"
    return spark.createDataFrame(LAUNCHES, names)
