"""The state of first devices, month by month, against all months together."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from launchtide.journal import NotCommitted, last_committed, last_run
from launchtide.operators.uptake import first_rows
from launchtide.plans import (
    batch_datamart,
    first_devices,
    merge_first,
    read_datamart,
    read_state,
    run_incremental,
    state,
    state_months,
    update_state,
)
from launchtide.schemas import Labels
from launchtide.sources import read_profiles
from tests import random_tables
from tests.test_files import MONTHS, inputs, rows, stored  # noqa: F401

BRAND = random_tables.BRAND


@pytest.mark.parametrize("seed", range(4))
def test_merged_parts_are_the_whole(spark, seed):
    """Undated sightings, unreadable launches, ties and a hot user, in parts of any order."""
    profiles, lookup, launches = random_tables.make(spark, seed, 400)
    whole = first_devices(profiles, lookup, launches, BRAND)
    parts = [profiles.filter(F.pmod(F.xxhash64("ifa", "app"), F.lit(4)) == k) for k in range(4)]
    random.Random(seed).shuffle(parts)
    firsts = [first_devices(part, lookup, launches, BRAND) for part in parts]
    assert rows(merge_first(*firsts)) == rows(whole)
    one_by_one = firsts[0]
    for first in firsts[1:]:
        one_by_one = merge_first(first, one_by_one, one_by_one)
    assert rows(one_by_one) == rows(whole)
    assert rows(merge_first(whole.limit(0), whole)) == rows(whole)
    assert rows(first_rows(whole)) == rows(whole)


def test_month_by_month(spark, stored, inputs, tmp_path, monkeypatch):  # noqa: F811
    read = []
    monkeypatch.setattr(state, "read_profiles", lambda *a, **k: read.append(a[3]) or read_profiles(*a, **k))
    args = (f"{stored}/profiles", "MY")
    files = (f"{stored}/lookup", f"{stored}/launches")
    at = f"{tmp_path}/state"
    with pytest.raises(NotCommitted):
        read_state(spark, at)
    for k, months in enumerate((MONTHS[2:3], "2020*", [MONTHS[0], MONTHS[3]], MONTHS)):
        out = f"{tmp_path}/segments{k}"
        found = run_incremental(spark, *args, months, *files, at, out)
        held = read_profiles(spark, *args, state_months(spark, at), with_month=False)
        assert rows(found) == rows(read_datamart(spark, out)) == rows(batch_datamart(held, *inputs[1:]))
    # A month is read once, however often it is named.
    assert read == [[MONTHS[2]], MONTHS[:2], [MONTHS[3]]]
    assert state_months(spark, at) == MONTHS
    assert rows(found) == rows(batch_datamart(*inputs))
    assert last_committed(spark, at).counts["users"] == read_state(spark, at).count()


def test_a_run_that_died_leaves_the_state_as_it_was(spark, stored, inputs, tmp_path, monkeypatch):  # noqa: F811
    at = f"{tmp_path}/state"

    def run(months):
        return update_state(spark, f"{stored}/profiles", "MY", months, *inputs[1:], at)

    def dies(*args):
        raise OSError("lost")

    before = rows(run(MONTHS[:1]))
    for months in (MONTHS[:2], MONTHS):
        with monkeypatch.context() as broken:
            broken.setattr(state, "commit", dies)
            with pytest.raises(OSError):
                run(months)
        assert rows(read_state(spark, at)) == before and state_months(spark, at) == MONTHS[:1]
    after = rows(run(MONTHS))
    profiles = read_profiles(spark, f"{stored}/profiles", "MY", MONTHS, with_month=False)
    assert after == rows(first_devices(profiles, *inputs[1:]).select(*state.COLUMNS))
    assert last_run(spark, at).committed


def test_other_models_are_refused(spark, stored, inputs, tmp_path):  # noqa: F811
    at, (_, lookup, launches) = f"{tmp_path}/state", inputs

    def run(lookup, launches, months=MONTHS[:1], country="MY"):
        return update_state(spark, f"{stored}/profiles", country, months, lookup, launches, at)

    run(lookup, launches)
    # The same rows in another order, or some of them twice, are the same models.
    run(lookup.repartition(5), launches.union(launches), MONTHS[:2])
    with pytest.raises(ValueError, match="other models"):
        run(lookup.filter("model <> 'SM-1'"), launches, MONTHS)
    with pytest.raises(ValueError, match="other models"):
        run(lookup, launches.withColumn("launch", F.date_add("launch", 1)), MONTHS)
    assert state_months(spark, at) == MONTHS[:2]


def test_a_month_without_rows(spark, stored, inputs, tmp_path):  # noqa: F811
    base = f"{tmp_path}/profiles"
    scan = read_profiles(spark, f"{stored}/profiles", "MY", MONTHS[:1], with_month=False)
    scan.limit(0).write.parquet(f"{base}/MY/202001")
    scan.write.parquet(f"{base}/MY/202002")
    found = update_state(spark, base, "MY", "2020*", *inputs[1:], f"{tmp_path}/state")
    assert rows(found) == rows(first_devices(scan, *inputs[1:], brand=Labels().device_brand).select(*state.COLUMNS))
    with pytest.raises(ValueError, match="no month"):
        update_state(spark, base, "MY", "2031*", *inputs[1:], f"{tmp_path}/other")
