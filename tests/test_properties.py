"""Outcomes that must hold whatever the data, its order, its partitions or its skew."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.plain import plain_deltas
from launchtide.operators import (
    assign_segments,
    combine_histograms,
    datamart_totals,
    delta_histogram,
    delta_row_histogram,
    derive_bands,
    distinct_users,
    enrich,
    first_device,
    join_launches,
    launch_delta,
    non_negative,
    segment_audit,
    sightings,
)
from launchtide.operators.uptake import MONTH_USER, USER
from launchtide.plans import user_deltas
from launchtide.schemas import ID_AS_CODED, MY_BANDS
from tests import random_tables
from tests.random_tables import BRAND

SHUFFLE_ALL = -1


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture(scope="module", params=[1, 2])
def inputs(spark, request):
    return random_tables.make(spark, request.param, 600)


@pytest.mark.parametrize("by", [USER, MONTH_USER])
@pytest.mark.parametrize("broadcast_bytes", [1 << 20, SHUFFLE_ALL])
def test_deltas_equal_the_plain_form(inputs, by, broadcast_bytes):
    columns = [*by, "name", "launch", "first_seen", "delta"]
    found = user_deltas(*inputs, BRAND, by, broadcast_bytes=broadcast_bytes).select(columns)
    expected = plain_deltas(*inputs, BRAND, by).select(columns)
    assert rows(found) == rows(expected)
    assert found.count() == found.select(*by).distinct().count() > 0
    assert found.filter("delta < 0 OR delta IS NULL").count() == 0


def test_shuffled_lookups_equal_broadcast_ones(inputs):
    profiles, lookup, launches = inputs
    seen = sightings(profiles)
    for brand in (None, BRAND, "Not Detected"):
        near = enrich(seen, lookup, brand)
        far = enrich(seen, lookup, brand, broadcast_bytes=SHUFFLE_ALL)
        assert rows(near) == rows(far)
        assert rows(join_launches(near, launches)) == rows(
            join_launches(far, launches, broadcast_bytes=SHUFFLE_ALL)
        )
    assert rows(enrich(seen, lookup).filter(F.col("brand") == BRAND)) == rows(
        enrich(seen, lookup, BRAND)
    )


@pytest.mark.parametrize("by", [USER, MONTH_USER])
def test_first_device_equals_the_plain_form(inputs, by):
    profiles, lookup, launches = inputs
    first = first_device(enrich(sightings(profiles), lookup, BRAND), launches, by)
    columns = [*by, "name", "launch", "first_seen", "delta"]
    expected = plain_deltas(*inputs, BRAND, by).select(columns)
    assert rows(non_negative(launch_delta(first)).select(columns)) == rows(expected)


def test_order_and_partitions_do_not_matter(inputs):
    profiles, lookup, launches = inputs
    expected = rows(user_deltas(profiles, lookup, launches, BRAND))
    turned = profiles.orderBy(F.xxhash64("ifa", "app").desc())
    for other in (profiles.repartition(13), profiles.coalesce(1), turned):
        assert rows(user_deltas(other, lookup, launches, BRAND)) == expected
    first = rows(first_device(enrich(sightings(profiles), lookup, BRAND), launches))
    again = enrich(sightings(turned), lookup.repartition(5), BRAND)
    assert rows(first_device(again, launches.repartition(3))) == first


def test_histograms(inputs):
    monthly = user_deltas(*inputs, BRAND, MONTH_USER)
    histograms = delta_histogram(monthly, ("month",))
    assert rows(histograms) == rows(delta_histogram(monthly, ("month",), one_row_per_user=True))
    combined = combine_histograms(histograms).collect()
    assert [row.delta for row in combined] == sorted(row.delta for row in combined)
    assert {row.delta: row.sum_count for row in combined} == {
        row.delta: row["count"] for row in delta_row_histogram(monthly).collect()
    }
    distinct = {row.delta: row["count"] for row in delta_histogram(monthly).collect()}
    assert all(row.sum_count >= distinct[row.delta] for row in combined)


def test_audit_and_totals(inputs):
    deltas = user_deltas(*inputs, BRAND, MONTH_USER)
    for bands in (MY_BANDS, ID_AS_CODED):
        datamart = assign_segments(deltas, bands)
        table = datamart.select("segment", "ifa").collect()
        expected = {
            name: (
                sum(row.segment == name for row in table),
                len({row.ifa for row in table if row.segment == name}),
            )
            for name in {row.segment for row in table}
        }
        audit = segment_audit(datamart).collect()
        assert {row.segment: (row.n_rows, row.n_users) for row in audit} == expected
        users = {row.ifa for row in table}
        assert tuple(datamart_totals(datamart).first()) == (len(table), len(users))
        assert rows(distinct_users(datamart)) == sorted((user,) for user in users)


@pytest.mark.parametrize("shares", [("0.025", "0.16", "0.50", "0.84"), ("0.1", "0.2", "0.9", "1")])
def test_derived_bands_equal_a_running_count(inputs, shares):
    histogram = delta_histogram(user_deltas(*inputs, BRAND))
    counts = [(row.delta, row["count"]) for row in histogram.collect()]
    total = sum(count for _, count in counts)
    cuts = []
    for share in shares:
        running = 0
        for delta, count in counts:
            running += count
            if running * 1000 >= total * round(float(share) * 1000):
                cuts.append(delta)
                break
    bands = derive_bands(histogram, shares).orderBy("band_order").collect()
    assert [band.hi for band in bands] == [*cuts, None]
    assert [band.lo for band in bands] == [None, *[cut + 1 for cut in cuts]]
    assert [band.segment for band in bands] == [band.segment for band in MY_BANDS]


@pytest.mark.parametrize(
    "shares", [("0.1", "0.2", "0.9", "1.5"), ("0.5", "0.4", "0.6", "0.7"), ("0", "0.2", "0.3", "0.4"), ("0.2", "0.2", "0.3", "0.4")]
)
def test_shares_rise_within_0_and_1(inputs, shares):
    with pytest.raises(ValueError, match="rise"):
        derive_bands(delta_histogram(user_deltas(*inputs, BRAND)), shares)


def test_derived_bands_need_a_name_each(inputs):
    with pytest.raises(ValueError):
        derive_bands(delta_histogram(user_deltas(*inputs, BRAND)), ("0.5",))
