"""Distinct users by merged bitmaps against counting them over all deltas."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from launchtide import journal
from launchtide.journal import NotCommitted, last_committed
from launchtide.operators import code_users, count_user_sets, delta_histogram, merge_user_sets, user_sets
from launchtide.operators.uptake import MONTH_USER
from launchtide.operators.user_sets import BITS
from launchtide.plans import (
    distinct_histogram,
    reach,
    read_codes,
    run_monthly,
    sets_path,
    stale_months,
    update_user_sets,
    user_deltas,
)
from launchtide.sinks import write_deltas
from launchtide.sources import read_deltas, read_user_sets
from tests import random_tables
from tests.test_files import MONTHS, inputs, rows, stored  # noqa: F401


def _users(deltas):
    return deltas.filter("ifa is not null").groupBy("ifa").agg(F.min("delta").alias("delta"))


@pytest.mark.parametrize("seed", range(2))
def test_equals_counting_all_deltas(spark, seed):
    """Users of several months, a user without id, and a delta that only such a user has."""
    deltas = user_deltas(*random_tables.make(spark, seed, 500), random_tables.BRAND, MONTH_USER)
    deltas = deltas.select("month", "ifa", "delta").union(spark.createDataFrame([(202001, None, 9999)], "month int, ifa string, delta int"))
    codes = code_users(_users(deltas), group=7)
    assert sorted(row.code for row in codes.collect()) == list(range(1, codes.count() + 1))
    sets = user_sets(deltas.union(deltas), codes)
    assert rows(count_user_sets(sets)) == rows(delta_histogram(deltas))
    assert rows(count_user_sets(sets, ("month",))) == rows(delta_histogram(deltas, ("month",)))
    some = sets.filter("month <> 202002")
    assert rows(count_user_sets(some)) == rows(delta_histogram(deltas.filter("month <> 202002")))
    # What has been united can be united again, in any order.
    again = merge_user_sets(sets.filter("month = 202002").select("delta", "bucket", "users").union(merge_user_sets(some)))
    assert rows(count_user_sets(again)) == rows(delta_histogram(deltas))
    assert count_user_sets(sets.limit(0)).count() == 0
    assert code_users(_users(deltas).limit(0)).count() == 0


def test_codes_are_numbered_by_delta_and_do_not_depend_on_partitions(spark):
    users = spark.range(5000).selectExpr("concat('u', id) AS ifa", "cast(if(id % 3 = 0, 7, id % 50) AS int) AS delta")
    one, two = (code_users(u, 100, 64) for u in (users.repartition(1), users.repartition(23, "ifa")))
    assert rows(one) == rows(two)
    by_delta = one.join(users, "ifa").groupBy("delta").agg(F.min("code"), F.max("code"), F.count("*")).orderBy("delta").collect()
    end = 100
    for _, low, high, n in by_delta:
        assert (low, high) == (end + 1, end + n)
        end = high


def test_a_hot_delta_is_split(spark):
    """A delta of nearly all users is numbered and united in many tasks, adaptive execution off."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        users = spark.range(400_000).selectExpr("concat('u', id) AS ifa", "cast(if(id % 10 = 0, id % 7, 3) AS int) AS delta")
        codes = code_users(users, group=1000)
        deltas = users.withColumn("month", F.lit(202001))
        united = merge_user_sets(user_sets(deltas, codes).repartition(16, "delta", "bucket"))
        most = united.filter("delta = 3").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert most[1] >= 360_000 // BITS and most[0] < most[1]
        assert rows(count_user_sets(united)) == rows(delta_histogram(users))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def _monthly(spark, stored, out, months):  # noqa: F811
    return run_monthly(spark, f"{stored}/profiles", "MY", months, f"{stored}/lookup", f"{stored}/launches", out)


def test_month_by_month(spark, stored, tmp_path, monkeypatch):  # noqa: F811
    out, read = f"{tmp_path}/uptake", []
    monkeypatch.setattr(reach, "read_deltas", lambda *a: read.append(a[2]) or read_deltas(*a))
    with pytest.raises(NotCommitted):
        update_user_sets(spark, out)
    for months in (MONTHS[2:3], MONTHS[:2], MONTHS[3:]):
        _monthly(spark, stored, out, months)
        with pytest.raises((NotCommitted, ValueError)):
            distinct_histogram(spark, out)
        update_user_sets(spark, out)
        update_user_sets(spark, out)
        everything = read_deltas(spark, f"{out}/deltas")
        assert rows(distinct_histogram(spark, out)) == rows(delta_histogram(everything))
    assert read == [MONTHS[2:3], MONTHS[:2], MONTHS[3:]]
    for some in (MONTHS[1:3], MONTHS[3:], []):
        wanted = delta_histogram(everything.filter(F.col("month").isin(some)))
        assert rows(distinct_histogram(spark, out, some)) == rows(wanted)
    codes = read_codes(spark, out)
    users = everything.filter("ifa is not null").select("ifa").distinct()
    assert rows(codes.select("ifa")) == rows(users)
    assert sorted(row.code for row in codes.collect()) == list(range(1, users.count() + 1))
    # A month that is run again is the only one read again.
    _monthly(spark, stored, out, MONTHS[1:2])
    assert stale_months(spark, out) == MONTHS[1:2]
    update_user_sets(spark, out)
    assert read[3:] == [MONTHS[1:2]] and stale_months(spark, out) == []
    assert rows(distinct_histogram(spark, out)) == rows(delta_histogram(read_deltas(spark, f"{out}/deltas")))
    # The deltas are not read to count.
    plan = distinct_histogram(spark, out)._jdf.queryExecution().toString()
    assert "user-sets" in plan and "/deltas" not in plan


def test_a_run_that_died_is_covered_by_the_next(spark, stored, tmp_path, monkeypatch):  # noqa: F811
    out = f"{tmp_path}/uptake"
    _monthly(spark, stored, out, MONTHS[:2])
    update_user_sets(spark, out)
    known = rows(read_codes(spark, out))
    _monthly(spark, stored, out, MONTHS[1:])
    with monkeypatch.context() as patch:
        patch.setattr(reach, "commit", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            update_user_sets(spark, out)
    with pytest.raises(NotCommitted):
        distinct_histogram(spark, out)
    # Numbers it gave don't count; those committed stay.
    assert rows(read_codes(spark, out)) == known
    update_user_sets(spark, out)
    assert set(known) <= set(rows(read_codes(spark, out)))
    assert rows(distinct_histogram(spark, out)) == rows(delta_histogram(read_deltas(spark, f"{out}/deltas")))


def test_counts_that_differ_are_an_error(spark, stored, tmp_path, monkeypatch):  # noqa: F811
    out = f"{tmp_path}/uptake"
    _monthly(spark, stored, out, MONTHS)
    monkeypatch.setattr(reach, "user_sets", lambda deltas, codes: user_sets(deltas.filter("ifa <> 'u1'").limit(2), codes))
    with pytest.raises(RuntimeError, match="user sets"):
        update_user_sets(spark, out)
    assert last_committed(spark, sets_path(out)) is None


def test_an_emptied_month_has_no_sets(spark, stored, tmp_path):  # noqa: F811
    out = f"{tmp_path}/uptake"
    _monthly(spark, stored, out, MONTHS)
    update_user_sets(spark, out)
    none = read_deltas(spark, f"{out}/deltas").limit(0)
    write_deltas(none, f"{out}/deltas", MONTHS[:1])
    run = reach.begin(spark, out, MONTHS[:1])
    reach.commit(spark, out, run, {str(MONTHS[0]): 0})
    update_user_sets(spark, out)
    assert read_user_sets(spark, sets_path(out), MONTHS[:1]).count() == 0
    assert rows(distinct_histogram(spark, out)) == rows(delta_histogram(read_deltas(spark, f"{out}/deltas")))


def test_many_months_read_the_journals_as_often_as_few(spark, tmp_path, monkeypatch):
    read, entries = [], journal.entries
    monkeypatch.setattr(journal, "entries", lambda spark, path: read.append(path) or entries(spark, path))
    calls = []
    for n in (1, 12):
        out, months = f"{tmp_path}/{n}", list(range(202001, 202001 + n))
        counts = {str(month): 1 for month in months}
        deltas = journal.begin(spark, out, months)
        journal.commit(spark, out, deltas, counts)
        sets = journal.begin(spark, sets_path(out), months)
        journal.commit(spark, sets_path(out), sets, counts, dict.fromkeys(counts, deltas.name))
        read.clear()
        assert stale_months(spark, out) == []
        calls.append(len(read))
    assert calls[0] == calls[1]
