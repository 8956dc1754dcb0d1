"""Column expressions, schema checks and the scratch folder."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import testmap
from launchtide.functions import earliest, earliest_unless_null, month_of_path, within, yyyymm
from launchtide.operators import assign_segments
from launchtide.operators.segments import band_nodes, matched_by_days
from launchtide.schemas import DATAMART, ID_AS_CODED, ID_DOCUMENTED, MY_BANDS, PROFILE, Band, require
from launchtide.sinks import write_deltas
from launchtide.sources.profiles import distinct_names


def test_earliest(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES (1, array(date'2020-02-01', date'2020-01-01')),
             (2, array(date'2020-02-01', null)), (3, array(null)), (4, array()),
             (5, null) AS t(n, times)"""
    ).select(
        "n",
        earliest(F.col("times")).alias("skip"),
        earliest_unless_null(F.col("times")).alias("first"),
    )
    found = {row.n: (str(row.skip), str(row["first"])) for row in rows.collect()}
    assert found == {
        1: ("2020-01-01", "2020-01-01"),
        2: ("2020-02-01", "None"),
        3: ("None", "None"),
        4: ("None", "None"),
        5: ("None", "None"),
    }


def test_months(spark):
    row = spark.range(1).select(
        yyyymm(F.lit("2020-09-30").cast("date")).alias("day"),
        yyyymm(F.lit("2021-12-31 23:59:59").cast("timestamp_ntz")).alias("time"),
        month_of_path(F.lit("s3a://b/monthly/MY/202009/part-0.parquet")).alias("plain"),
        month_of_path(
            F.lit("file:/b/MY/month=202109/part-0.parquet"), "{country}/month={month}", "MY"
        ).alias("named"),
        month_of_path(F.lit("file:/b/202108/MY/part-0.parquet"), "{month}/{country}", "MY").alias("first"),
        month_of_path(F.lit("file:/202001/MY/202107/day=01/p.parquet"), country="MY").alias("deeper"),
    )
    assert tuple(row.first()) == (202009, 202112, 202009, 202109, 202108, 202107)
    with pytest.raises(ValueError, match="once"):
        month_of_path(F.lit("x"), "{country}")
    with pytest.raises(Exception, match="no month where"):
        spark.range(1).select(month_of_path(F.lit("file:/b/MY/x/part-0.parquet"))).collect()


def test_month_names_that_name_a_directory_twice():
    assert distinct_names(["202101", 202101, "202102"]) == ["202101", "202102"]
    assert distinct_names(["2021*", "202101", "202002"]) == ["202002", "2021*"]
    assert distinct_names(["202{0*,101}", "202101", "202102", "2020*"]) == ["202102", "{202{0*,101},2020*}"]
    assert distinct_names(["20200[1-3]", "202004", "20200?"]) == ["{20200[1-3],20200?}"]


def test_within(spark):
    numbers = spark.sql("SELECT * FROM VALUES (1), (2), (3), (null) AS t(n)")

    def kept(lo, hi):
        return sorted(row.n for row in numbers.filter(within(F.col("n"), lo, hi)).collect())

    assert kept(2, 3) == [2, 3]
    assert kept(None, 2) == [1, 2]
    assert kept(3, None) == [3]
    assert kept(None, None) == [1, 2, 3]


def test_disjoint_bands_leave_no_gap():
    for bands in (MY_BANDS, ID_DOCUMENTED):
        assert bands[0].lo is None and bands[-1].hi is None
        assert all(a.hi + 1 == b.lo for a, b in zip(bands, bands[1:], strict=False))
    shared = [range(b.lo, a.hi + 1) for a, b in zip(ID_AS_CODED, ID_AS_CODED[1:], strict=False)]
    assert [day for days in shared for day in days] == [22, 128, 129, 332, 333, 470]


def test_required_members_are_found_whatever_stands_beside_them():
    found = T.StructType.fromDDL(
        """more int, app array<struct<x int, first_seen timestamp_ntz>>, ifa string,
           device struct<device_model string, y int, platform string>"""
    )
    require(found, PROFILE, "profiles")
    for wrong in (
        "ifa string",
        "ifa int, device struct<platform string, device_model string>, "
        "app array<struct<first_seen timestamp>>",
        "ifa string, device struct<platform string>, app array<struct<first_seen timestamp>>",
        "ifa string, device struct<platform string, device_model string>, "
        "app array<struct<first_seen string>>",
        "ifa string, device string, app array<string>",
    ):
        with pytest.raises(ValueError, match="profiles lacks"):
            require(T.StructType.fromDDL(wrong), PROFILE, "profiles")
    require(DATAMART, DATAMART, "datamart")


class Session:
    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, name, default):
        return self.settings.get(name.replace(".", "_"), default)

    def set(self, name, value):
        self.settings[name.replace(".", "_")] = value


def test_scratch_lies_where_the_session_says():
    shared = Session(spark_checkpoint_dir="hdfs://n/shared/", spark_master="yarn")
    first, second = testmap.scratch(shared, "deltas"), testmap.scratch(shared, "deltas")
    assert first.startswith("hdfs://n/shared/deltas-")
    assert first != second
    with pytest.raises(RuntimeError):
        testmap.scratch(Session(spark_master="yarn"), "deltas")
    alone = Session(spark_master="local[2]")
    assert testmap.scratch(alone, "deltas").startswith(alone.settings["spark_checkpoint_dir"])


def _bands(rng, n, days):
    """Overlapping, open, empty and touching bands."""
    out = []
    for k in range(n):
        lo, hi = sorted((rng.randrange(-days, days), rng.randrange(-days, days)))
        kind = rng.randrange(8)
        lo, hi = (None if kind == 0 else lo), (None if kind == 1 else hi)
        if kind == 2:
            hi = lo
        if kind == 3 and None not in (lo, hi):
            lo, hi = hi + 1, lo
        out.append(Band(f"s{k}", f"id{k % 7}", lo, hi))
    return out


@pytest.mark.parametrize("n", [1, 65, 400])
def test_bands_by_days_equal_bands_one_by_one(spark, n):
    rng = random.Random(n)
    bands = _bands(rng, n, 300)
    deltas = [(f"u{k}", "n", None, None, rng.choice([None, rng.randrange(-320, 320)])) for k in range(300)]
    deltas += [("hot", "n", None, None, 7)] * 100 + [("far", "n", None, None, d) for d in (-3_700_000, 3_700_000)]
    df = spark.createDataFrame(deltas, "ifa string, name string, launch date, first_seen timestamp, delta int")
    table = spark.createDataFrame([(b.segment, b.segment_id, b.lo, b.hi) for b in bands], "segment string, segment_id string, lo int, hi int")
    wanted = Counter(
        (u, b.segment, d)
        for u, _, _, _, d in deltas
        for b in bands
        if d is not None and (b.lo is None or d >= b.lo) and (b.hi is None or d <= b.hi)
    )
    for size in (1 << 25, -1):
        found = matched_by_days(df, table, size).select("ifa", "segment", "delta")
        assert Counter(map(tuple, found.collect())) == wanted
    for given in (bands, table):
        found = assign_segments(df, given).select("ifa", "segment", "delta")
        assert Counter(map(tuple, found.collect())) == wanted
    assert assign_segments(df.limit(0), table).isEmpty() and assign_segments(df, table.limit(0)).isEmpty()


@pytest.mark.parametrize("pairs", [1, 50, 100_000])
def test_pairs_of_hot_days_are_dealt_over_tasks(spark, pairs):
    """Days with more users than bands and the reverse, equal bands, equal rows."""
    bands = spark.sql("""SELECT concat('s', id) AS segment, 'x' AS segment_id, cast(id % 3 AS int) AS lo, cast(id % 3 AS int) AS hi FROM range(60)
        UNION ALL SELECT 'equal', 'x', 5, 6 FROM range(200) UNION ALL SELECT null, null, 9, null""")
    deltas = spark.sql("""SELECT concat('u', id % 40) AS ifa, 'n' AS name, date'2020-01-01' AS launch, timestamp'2020-01-01' AS first_seen,
        cast(CASE WHEN id < 300 THEN 2 WHEN id < 307 THEN 6 ELSE id % 15 END AS int) AS delta FROM range(400)""")
    found = matched_by_days(deltas, bands, -1, pairs)
    assert found.columns == [*deltas.columns, "segment", "segment_id"]
    wanted = deltas.join(bands, F.expr("delta >= lo AND (hi IS NULL OR delta <= hi)")).drop("lo", "hi")
    assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()
    sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
    if pairs == 50:
        assert max(sizes) < 1_000 < sum(sizes) / 4


def test_very_many_bands_make_no_pairs_that_do_not_match(spark):
    n = 100_000
    bands = spark.range(n).selectExpr("concat('s', id) AS segment", "'x' AS segment_id", "cast(id % 3000 AS int) AS lo", "cast(id % 3000 + id % 5 AS int) AS hi")
    deltas = spark.range(20_000).selectExpr("concat('u', id) AS ifa", "'n' AS name", "date'2020-01-01' AS launch", "timestamp'2020-01-01' AS first_seen", "cast(CASE WHEN id % 2 = 0 THEN 5 ELSE id % 4000 END AS int) AS delta")
    assert band_nodes(bands).count() < 4 * n
    found = assign_segments(deltas, bands)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    wanted = {d: sum(1 for k in range(n) if k % 3000 <= d <= k % 3000 + k % 5) for d in (5, 1001, 2999)}
    rows = {r.delta: r.n for r in found.filter("ifa in ('u0', 'u1001', 'u2999')").groupBy("delta").agg(F.count("*").alias("n")).collect()}
    assert rows == wanted


@pytest.mark.parametrize("adaptive", ["false", "true"])
def test_a_hot_month_is_split_over_files(spark, tmp_path, adaptive):
    """Half of all rows in one month, with and without adaptive execution."""
    df = spark.range(40_000).selectExpr("CASE WHEN id % 2 = 0 THEN 202001 ELSE 202002 + cast(id % 20 AS int) END AS month", "concat('u', id) AS ifa", "'n' AS name", "date'2020-01-01' AS launch", "timestamp'2020-01-01' AS first_seen", "cast(id % 9 AS int) AS delta")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        write_deltas(df, f"{tmp_path}/deltas", [202001, 203001], rows=2_500)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    stored = spark.read.parquet(f"{tmp_path}/deltas")
    files = {}
    for row in stored.groupBy("month", F.input_file_name().alias("file")).agg(F.count("*").alias("n")).collect():
        files.setdefault(row.month, []).append(row.n)
    assert len(files[202001]) == 8 and max(files[202001]) < 3_000
    assert all(len(sizes) == 1 for month, sizes in files.items() if month != 202001)
    assert stored.select(df.columns).exceptAll(df).isEmpty() and stored.count() == 40_000
