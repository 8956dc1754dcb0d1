"""Random profiles, lookup and launches with ties, nulls, repeated keys and one hot key each."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

SCHEMA = """
    month int, ifa string, device struct<platform:string, device_model:string>,
    app array<struct<first_seen:timestamp>>
"""
BRAND = "B1"


def make(spark: SparkSession, seed: int, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    rng = random.Random(seed)

    def hot(hot_value, others):
        return hot_value if rng.random() < 1 / 3 else rng.choice(others)

    def day():
        if rng.random() < 0.01:
            return None
        return datetime(2020, 1, 1) + timedelta(days=rng.randrange(90), hours=rng.randrange(2))

    profiles = [
        (
            hot(202001, [202002, 202003]),
            hot(None, [f"u{i}" for i in range(n // 6)]),
            (rng.choice(["Android", "ANDROID", "iOS", None]), hot("m0", [f"m{i}" for i in range(30)])),
            None if rng.random() < 0.05 else [(day(),) for _ in range(rng.randrange(5))],
        )
        for _ in range(n)
    ]
    lookup = [
        (hot("m0", [f"m{i}" for i in range(25)]), hot(BRAND, ["B2", None]), hot("n0", ["n1", "n2", "n3", None]))
        for _ in range(40)
    ]
    launches = [
        (name, None if rng.random() < 0.1 else f"2020-01-{rng.randrange(1, 29):02}")
        for name in ["n0", "n0", "n1", "n1", "n2", "Not Detected"]
    ]
    return (
        spark.createDataFrame(profiles, SCHEMA),
        spark.createDataFrame(lookup, "model string, brand string, name string"),
        spark.createDataFrame(launches, "name string, launch string").selectExpr(
            "name", "to_date(launch) AS launch"
        ),
    )
