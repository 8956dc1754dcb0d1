"""Distinct users per delta as bitmaps that months can be merged by.

Histograms of months can only be added up, which counts a user once a month. Sets of users
can be united. Users are given whole numbers, their codes, and the users of a delta are the
bits of fixed-size bitmaps, ``BITS`` codes to each. Uniting months is then a bitwise OR and
counting is a count of bits: exact, without the ids, and without the deltas.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.operators.joins import BROADCAST_BYTES, fits

#: Codes of a bitmap of Spark's bitmap functions, which is hence 4 KiB.
BITS = 32_768
#: Users numbered in one group, about; a delta of more users is parted into several groups.
GROUP = 1_000_000


def code_users(users: DataFrame, above: int = 0, group: int = GROUP) -> DataFrame:
    """``ifa, code`` for a table of one row ``ifa, delta`` a user: ``above + 1`` and on, no gaps.

    Users are numbered delta by delta, so that those of one delta share bitmaps. A delta is
    counted first and parted by a hash of the id into groups of about ``group`` users; each
    group is numbered by itself and begins where those before it end. The running sum runs
    over groups: one for each delta and each ``group`` users. Codes follow from the rows
    alone, so a task that runs again gives the same ones.
    """
    sizes = users.groupBy("delta").agg(F.count("*").alias("n"))
    sizes = sizes.select("delta", F.ceil(F.col("n") / group).cast("int").alias("parts"))
    sizes = F.broadcast(sizes) if fits(BROADCAST_BYTES, sizes) else sizes
    own = F.pmod(F.xxhash64("ifa"), F.col("parts")).cast("int")
    placed = users.join(sizes, "delta").select("ifa", "delta", own.alias("part"))
    before = Window.orderBy("delta", "part").rowsBetween(Window.unboundedPreceding, -1)
    groups = placed.groupBy("delta", "part").agg(F.count("*").alias("n"))
    starts = groups.select("delta", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    starts = F.broadcast(starts) if fits(BROADCAST_BYTES, starts) else starts
    nth = F.row_number().over(Window.partitionBy("delta", "part").orderBy("ifa"))
    numbered = placed.withColumn("nth", nth).join(starts, ["delta", "part"])
    return numbered.select("ifa", (F.lit(above) + F.col("start") + F.col("nth")).cast("long").alias("code"))


def user_sets(deltas: DataFrame, codes: DataFrame) -> DataFrame:
    """``month, delta, bucket, users``: the users of each month and delta as bitmaps.

    ``deltas`` holds ``month, ifa, delta`` and may repeat rows; ``codes`` holds each of its
    users once. A user without id counts for nothing, as in :func:`delta_histogram`; a delta
    which only such users have keeps a row, of an empty bitmap and no bucket.
    """
    named = deltas.filter("ifa is not null").join(codes, "ifa").select("month", "delta", "code")
    nameless = deltas.filter("ifa is null").select("month", "delta", F.lit(None).cast("long").alias("code")).distinct()
    return (
        named.unionByName(nameless)
        .groupBy("month", "delta", F.bitmap_bucket_number("code").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("users"))
    )


def merge_user_sets(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sets of several months united, as ``delta, bucket, users`` after the columns of ``by``.

    A hot delta is many buckets, so it is split like any others.
    """
    return sets.groupBy(*by, "delta", "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def count_user_sets(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct users per delta over all months of ``sets``, as ``delta, count``.

    Equal to :func:`delta_histogram` over the deltas of those months.
    """
    united = merge_user_sets(sets, by)
    users = F.when(F.col("bucket").isNull(), F.lit(0)).otherwise(F.bitmap_count("users"))
    return united.groupBy(*by, "delta").agg(F.sum(users.cast("long")).alias("count")).orderBy(*by, "delta")
