"""Exact outcomes on the hand-made table: one row per point of semantics."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.plain import plain_deltas, plain_segments
from launchtide.operators import (
    assign_segments,
    datamart_totals,
    device_lookup,
    earliest_sightings,
    enrich,
    first_device,
    first_rows,
    join_launches,
    launch_delta,
    launched_models,
    launches,
    non_negative,
    segment_audit,
    sightings,
)
from launchtide.plans import batch_datamart, user_deltas
from launchtide.schemas import (
    BRAND,
    DATAMART,
    ID_AS_CODED,
    ID_DOCUMENTED,
    MY_BANDS,
    NOT_DETECTED,
    Band,
    Labels,
)
from tests import edge_table


@pytest.fixture(scope="module")
def inputs(spark):
    return (
        edge_table.profiles(spark),
        device_lookup(edge_table.raw_lookup(spark)),
        launches(edge_table.raw_launches(spark)),
    )


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def deltas_of(df):
    return {row.ifa: row.delta for row in df.select("ifa", "delta").collect()}


def test_counts_step_by_step(inputs):
    profiles, lookup, launch = inputs
    seen = sightings(profiles)
    assert seen.count() == 33
    enriched = enrich(seen, lookup)
    assert enriched.count() == 34
    assert enriched.filter(F.col("brand") == NOT_DETECTED).count() == 3
    of_brand = enrich(seen, lookup, BRAND)
    assert rows(of_brand) == rows(enriched.filter(F.col("brand") == BRAND))
    assert of_brand.count() == 30
    assert join_launches(of_brand, launch).count() == 29
    first = launch_delta(first_device(of_brand, launch))
    assert first.count() == 23
    assert first.filter("delta IS NULL").count() == 2
    assert first.filter("delta < 0").count() == 1
    assert deltas_of(non_negative(first)) == edge_table.KEPT


def test_earliest_sightings_lead_to_the_same_devices(inputs):
    profiles, lookup, launch = inputs
    by_app = first_device(enrich(sightings(profiles), lookup, BRAND), launch)
    by_profile = first_device(enrich(earliest_sightings(profiles), lookup, BRAND), launch)
    assert rows(by_app) == rows(by_profile)


def test_user_deltas(inputs):
    deltas = user_deltas(*inputs)
    assert deltas_of(deltas) == edge_table.KEPT
    by_user = {row.ifa: row for row in deltas.collect()}
    assert by_user["a18"].name == "Phone Four"
    assert by_user["a20"].name == "Phone One"
    assert by_user["a01"].first_seen.day == 7


def test_equals_the_plain_form(inputs):
    plain = plain_deltas(*inputs, BRAND)
    columns = ["ifa", "name", "launch", "first_seen", "delta"]
    assert rows(user_deltas(*inputs).select(columns)) == rows(plain.select(columns))


@pytest.mark.parametrize(
    "bands, counts",
    [(MY_BANDS, [3, 5, 4, 4, 4]), (ID_AS_CODED, [5, 7, 6, 7, 1])],
)
def test_segments(inputs, bands, counts):
    datamart = batch_datamart(*inputs, bands)
    audit = {row.segment: (row.n_rows, row.n_users) for row in segment_audit(datamart).collect()}
    assert audit == {band.segment: (n, n) for band, n in zip(bands, counts, strict=True)}
    assert tuple(datamart_totals(datamart).first()) == (sum(counts), 20)
    plain = plain_segments(user_deltas(*inputs), bands, Labels())
    assert rows(datamart) == rows(plain)


def test_id_bands_differ_only_by_the_overlap(inputs):
    documented = batch_datamart(*inputs, ID_DOCUMENTED)
    coded = batch_datamart(*inputs, ID_AS_CODED)
    assert documented.count() == 20
    assert documented.exceptAll(coded).count() == 0
    assert {row.delta for row in coded.exceptAll(documented).collect()} == {
        22, 128, 129, 332, 333, 470,
    }


def test_one_band_is_a_filter(inputs):
    deltas = user_deltas(*inputs)
    whole = assign_segments(deltas, MY_BANDS)
    for band in MY_BANDS:
        one = assign_segments(deltas, [band])
        assert rows(one) == rows(whole.filter(F.col("segment") == band.segment))


def test_band_table_equals_band_list(spark, inputs):
    deltas = user_deltas(*inputs)
    for bands in (MY_BANDS, ID_AS_CODED):
        table = spark.createDataFrame(
            [(b.segment, b.segment_id, b.lo, b.hi) for b in bands],
            "segment string, segment_id string, lo int, hi int",
        )
        assert rows(assign_segments(deltas, table)) == rows(assign_segments(deltas, bands))


def test_a_band_open_at_both_ends_holds_all_but_null(spark):
    deltas = spark.createDataFrame(
        [("u", "n", None, None, -3), ("v", "n", None, None, None)],
        "ifa string, name string, launch date, first_seen timestamp, delta int",
    )
    assert assign_segments(deltas, [Band("all", "x", None, None)]).count() == 1


def test_datamart_schema(inputs):
    assert batch_datamart(*inputs).schema == DATAMART


def test_null_dates_and_users_may_be_left_out(inputs):
    skipped = deltas_of(user_deltas(*inputs, null_dates="skip"))
    assert skipped == edge_table.KEPT | {"a16": 3}
    dropped = deltas_of(user_deltas(*inputs, null_users="drop"))
    assert dropped == {k: v for k, v in edge_table.KEPT.items() if k != NOT_DETECTED}
    profiles = inputs[0]
    assert sightings(profiles, null_dates="skip").count() == 32
    assert sightings(profiles, null_users="drop").count() == 31


def test_undated_app_struct_counts_as_undated(spark):
    profiles = spark.sql(
        """SELECT 'u' AS ifa, named_struct('platform', 'Android', 'device_model', 'm') AS device,
                  array(named_struct('first_seen', timestamp'2020-01-02'), null) AS app"""
    )
    assert earliest_sightings(profiles).first().first_seen is None
    assert {row.first_seen is None for row in sightings(profiles).collect()} == {True, False}


def test_launched_models_choose_least_name_then_least_launch(spark):
    lookup = spark.createDataFrame(
        [("m1", "B", "y"), ("m1", "B", "x"), ("m1", "B", "w"), ("m2", "B", None), (None, "B", "x"),
         ("m3", "B", "z"), ("m4", "C", "x")],
        "model string, brand string, name string",
    )
    launch = spark.sql(
        """SELECT * FROM VALUES ('x', date'2020-02-01'), ('x', date'2020-01-01'),
             ('y', date'2019-01-01'), ('z', date'2020-01-01'), ('z', null),
             ('Not Detected', date'2021-01-01') AS t(name, launch)"""
    )
    found = {(r.model, r.name, str(r.launch)) for r in launched_models(lookup, launch, "B").collect()}
    assert found == {
        ("m1", "x", "2020-01-01"),
        ("m2", "Not Detected", "2021-01-01"),
        ("m3", "z", "2020-01-01"),
    }
    with pytest.raises(ValueError):
        launched_models(lookup, launch, NOT_DETECTED)


def test_an_unreadable_duplicate_launch_hides_no_user(spark):
    lookup = spark.createDataFrame([("m", "B", "x"), ("k", "B", "y")], "model string, brand string, name string")
    launch = spark.sql(
        """SELECT * FROM VALUES ('x', date'2020-01-01'), ('x', null), ('y', null) AS t(name, launch)"""
    )
    profiles = spark.sql(
        """SELECT ifa, named_struct('platform', 'Android', 'device_model', model) AS device,
                  array(named_struct('first_seen', timestamp'2020-01-03')) AS app
           FROM VALUES ('u', 'm'), ('v', 'k') AS t(ifa, model)"""
    )
    assert deltas_of(user_deltas(profiles, lookup, launch, "B")) == {"u": 2}
    by_app = first_device(enrich(sightings(profiles), lookup, "B"), launch)
    assert deltas_of(launch_delta(by_app)) == {"u": 2, "v": None}
    joined = join_launches(enrich(sightings(profiles), lookup, "B"), launch)
    assert {(row.ifa, str(row.launch)) for row in first_rows(joined).collect()} == {
        ("u", "2020-01-01"), ("v", "None"),
    }


def test_a_band_table_may_be_long_and_no_bands_give_no_rows(spark, inputs):
    """A band a day; a longer table than may stand as literals beside each delta."""
    deltas = user_deltas(*inputs)
    long = spark.range(1001).selectExpr("'s' AS segment", "'i' AS segment_id", "int(id) AS lo", "int(id) AS hi")
    assert deltas_of(assign_segments(deltas, long)) == deltas_of(deltas.filter("delta <= 1000"))
    assert assign_segments(deltas, []).count() == 0


def test_unreadable_launch_dates_are_null(spark):
    raw = spark.createDataFrame(
        [("a", "2020-03-06"), ("b", "3/6/2020"), ("c", ""), ("d", None), ("e", "2020-3-6")],
        "Name string, Release_Date string",
    )
    found = {row.name: str(row.launch) for row in launches(raw).collect()}
    assert found == {"a": "2020-03-06", "b": "None", "c": "None", "d": "None", "e": "2020-03-06"}


def test_delta_counts_calendar_days(spark):
    first = spark.sql(
        """SELECT date(seen) AS date, launch FROM VALUES
             (timestamp'2020-03-07 04:10:00', date'2020-03-06'),
             (timestamp'2020-03-06 23:59:59', date'2020-03-06'),
             (timestamp'2020-03-05 23:59:59', date'2020-03-06') AS t(seen, launch)"""
    )
    assert [row.delta for row in launch_delta(first).collect()] == [1, 0, -1]
