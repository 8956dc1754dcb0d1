"""The physical plans: what is read, how often data is shuffled, and what is joined how."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from launchtide.operators import (
    assign_segments,
    delta_histogram,
    derive_bands,
    device_lookup,
    earliest_sightings,
    enrich,
    launched_models,
    launches,
    segment_audit,
    sightings,
)
from launchtide.operators.devices import of_brand
from launchtide.operators import joins
from launchtide.operators.joins import (
    SALTS,
    dealt,
    filter_bits,
    having_keys,
    hot_keys,
    join_lookup,
    key_filter,
    measured_bytes,
)
from launchtide.operators.uptake import MONTH_USER
from launchtide.plans import batch_datamart, derived_datamart, uptake, user_deltas
from launchtide.schemas import BRAND, ID_AS_CODED, MY_BANDS
from launchtide.sinks import kept, write_deltas
from launchtide.sources import read_deltas, read_profiles
from tests import edge_table


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    return str(tmp_path_factory.mktemp("plans"))


@pytest.fixture(scope="module")
def inputs(spark, base):
    edge_table.profiles(spark).write.parquet(f"{base}/profiles/MY/202101")
    edge_table.raw_lookup(spark).write.parquet(f"{base}/lookup")
    edge_table.raw_launches(spark).write.parquet(f"{base}/launches")
    return (
        read_profiles(spark, f"{base}/profiles", "MY", ["202101"]),
        device_lookup(spark.read.parquet(f"{base}/lookup")),
        launches(spark.read.parquet(f"{base}/launches")),
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def fact_side(text: str) -> str:
    """The plan without what lies below a broadcast."""
    kept, depth = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if depth is not None and indent > depth:
            continue
        depth = indent if "BroadcastExchange" in line else None
        kept.append(line)
    return "\n".join(kept)


def test_one_scan_with_only_the_members_used(spark, inputs, base):
    _, lookup, launch = inputs
    undated = read_profiles(spark, f"{base}/profiles", "MY", ["202101"], with_month=False)
    for df in (
        batch_datamart(undated, lookup, launch),
        user_deltas(*inputs, by=MONTH_USER),
        sightings(undated),
    ):
        scans = re.findall(r"ReadSchema: (\S+)", plan(df))
        assert [scan for scan in scans if "app" in scan] == [
            "struct<ifa:string,device:struct<platform:string,device_model:string>,"
            "app:array<struct<first_seen:timestamp>>>"
        ]


def test_profiles_are_shuffled_once_with_one_row_per_user_and_task(inputs):
    for by in (("ifa",), MONTH_USER):
        facts = fact_side(plan(user_deltas(*inputs, by=by)))
        assert len(re.findall(r"\bExchange ", facts)) == 1
        assert "hashpartitioning(" + ("ifa" if by == ("ifa",) else "month") in facts
        assert facts.count("WindowGroupLimit") == 2
        before_shuffle = facts[facts.index("Exchange hashpartitioning") :]
        assert before_shuffle.count("WindowGroupLimit") == 1
        assert "BroadcastHashJoin" in before_shuffle
        assert "explode" not in facts.lower()


def test_negative_deltas_are_dropped_after_the_window(inputs):
    text = plan(user_deltas(*inputs))
    assert text.index(">= 0)") < text.index("Window [")


def test_segments_add_no_join_and_no_shuffle(inputs):
    for bands in (MY_BANDS, ID_AS_CODED):
        facts = fact_side(plan(batch_datamart(*inputs, bands)))
        assert len(re.findall(r"\bExchange ", facts)) == 1
        assert len(re.findall(r"Join ", facts)) == 1


def test_audit_reuses_the_shuffle_by_user(inputs):
    facts = fact_side(plan(segment_audit(batch_datamart(*inputs))))
    assert re.findall(r"\bExchange hashpartitioning\((\w+)", facts) == ["segment", "ifa"]


def test_histogram_of_first_devices_shuffles_no_users(inputs, spark, tmp_path):
    write_deltas(user_deltas(*inputs, by=MONTH_USER), f"{tmp_path}/deltas")
    stored = read_deltas(spark, f"{tmp_path}/deltas")
    text = plan(delta_histogram(stored, ("month",), one_row_per_user=True))
    assert "keys=[month" in text
    assert "distinct" not in text


def test_stored_deltas_are_pruned_by_month_and_band(inputs, spark, tmp_path):
    write_deltas(user_deltas(*inputs, by=MONTH_USER), f"{tmp_path}/deltas")
    stored = read_deltas(spark, f"{tmp_path}/deltas", [202101])
    text = plan(assign_segments(stored, MY_BANDS[1:2]))
    assert re.search(r"PartitionFilters: \[[^\]]*month\S* = 202101", text)
    assert "GreaterThanOrEqual(delta,7), LessThanOrEqual(delta,108)" in text


@pytest.fixture
def shuffled(spark):
    """Joins as they are when nothing fits a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_lookup_too_large_to_broadcast_is_shuffled(inputs, shuffled):
    profiles, lookup, _ = inputs
    seen = earliest_sightings(profiles)
    size = measured_bytes(lookup.select("model", "brand", "name"))
    assert 0 < size < 2000
    assert "BroadcastHashJoin" in plan(enrich(seen, lookup, broadcast_bytes=size))
    text = plan(enrich(seen, lookup, broadcast_bytes=size - 1))
    assert re.search(r"SortMergeJoin \[device_model#\d+, salt#\d+\]", text)
    assert re.search(r"Exchange hashpartitioning\(device_model#\d+, salt#\d+", text)


def test_only_hot_keys_are_salted_and_equal_rows_part(spark, shuffled):
    facts = spark.range(0, 30_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE string(id) END AS k", "1 AS same"
    )
    lookup = spark.range(0, 30_000, 1, 4).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE string(id) END AS k", "id AS value"
    )
    keys = {row.k: row.salts for row in hot_keys(facts, "k").collect()}
    assert keys == {"hot": -(-SALTS * 10_000 // 30_000)}
    joined = join_lookup(facts, lookup, "k", broadcast_bytes=-1)
    assert joined.count() == 20_000
    parts = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(row["count"] for row in parts) < 4_000
    left = join_lookup(facts, lookup, "k", "left", broadcast_bytes=-1)
    assert left.count() == 30_000
    assert left.filter("k IS NULL AND value IS NULL").count() == 10_000
    assert join_lookup(facts.limit(0), lookup, "k", broadcast_bytes=-1).count() == 0


def test_rows_of_no_hot_key_are_shuffled_once(spark, shuffled):
    facts = spark.range(0, 9_000, 1, 4).selectExpr("string(id % 3000) AS k", "id % 2 AS same")
    lookup = spark.range(0, 6_000, 2, 4).selectExpr("string(id) AS k", "id AS value")
    for how in ("left", "inner"):
        joined = join_lookup(facts, lookup, "k", how, broadcast_bytes=-1, filtered=True)
        text = plan(joined)
        assert text.count("Exchange hashpartitioning") == 2
        assert "Union" not in text and "Aggregate" not in text and "salt" not in text
        assert joined.exceptAll(facts.join(lookup, "k", how)).isEmpty()
        assert joined.count() == (9_000 if how == "left" else 4_500)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_and_missing_keys_beside_others(spark, shuffled, how):
    """Equal rows of hot keys, one of them unknown, rows without a key, and keys listed twice."""
    facts = spark.range(0, 8_000, 1, 4).selectExpr(
        "CASE id % 4 WHEN 0 THEN 'hot' WHEN 1 THEN 'unknown' WHEN 2 THEN NULL ELSE string(id % 600) END AS k", "id % 3 AS v"
    )
    lookup = spark.sql("SELECT string(id) AS k, id AS value FROM range(900) UNION ALL VALUES ('hot', 1L), ('hot', NULL), (NULL, 7L), ('3', 3L)")
    wanted = facts.join(lookup, "k", how)
    for size, dealt_out in ((-1, True), (measured_bytes(lookup) - 1, False)):
        found = join_lookup(facts, lookup, "k", how, size)
        assert bool(re.search(r"SortMergeJoin \[k#\d+, salt#\d+\]", plan(found))) == dealt_out
        assert found.columns == wanted.columns and found.count() == wanted.count()
        assert found.exceptAll(wanted).isEmpty()


def test_salts_do_not_depend_on_the_order_of_rows(spark, inputs, shuffled):
    facts = spark.range(0, 6_000, 1, 4).selectExpr("'hot' AS k", "id % 50 AS v")
    hot = hot_keys(facts, "k")
    orders = (facts, facts.orderBy(F.desc("v")), facts.repartition(7).sortWithinPartitions("v"))
    found = [sorted(dealt(rows, hot, "k").collect()) for rows in orders]
    assert found[0] == found[1] == found[2] and len(found[0]) == 6_000
    assert len({row.salt for row in found[0]}) > SALTS / 2
    alone = facts.distinct()
    assert sorted(dealt(alone, hot, "k", True).collect()) == sorted(dealt(alone, hot, "k").collect())
    assert "monotonically" not in plan(join_lookup(facts, facts.distinct(), "k", broadcast_bytes=-1))
    assert "monotonically" not in plan(user_deltas(*inputs, broadcast_bytes=-1))


def test_only_sightings_of_launched_models_are_shuffled_and_stored(spark, inputs, shuffled, monkeypatch):
    """A lookup too large to broadcast: a filter of its keys stands before the first shuffle."""
    stored = {}

    def kept_too(table, name):
        stored[name] = (plan(table), kept(table, name))
        return stored[name][1]

    monkeypatch.setattr(uptake, "kept", kept_too)
    profiles, lookup, launch = inputs
    deltas = user_deltas(*inputs, broadcast_bytes=-1)
    text, rows = stored["sightings"]
    assert "partial_min(struct(first_seen" in text
    fact = fact_side(text)
    shuffle = fact.index("Exchange hashpartitioning(ifa")
    assert "BroadcastHashJoin [(_place" in fact[shuffle:] and "getbit" in fact[shuffle:]
    models = {r.model for r in launched_models(lookup, launch, BRAND).collect()}
    assert {r.device_model for r in rows.collect()} == models & {r.device_model for r in sightings(profiles).collect()}
    assert rows.count() == rows.select("ifa", "device_model").distinct().count() < earliest_sightings(profiles).count()
    # The profiles are read for that table only.
    assert "app" not in plan(deltas)
    assert sorted(map(str, deltas.collect())) == sorted(map(str, user_deltas(*inputs).collect()))


@pytest.mark.parametrize("n, bits", [(0, 1 << 15), (1, 1 << 15), (2048, 1 << 15), (2049, 1 << 16), (1 << 23, 1 << 27), (1 << 27, 1 << 27), ((1 << 27) + 1, 0)])
def test_a_key_filter_is_bounded(n, bits):
    assert filter_bits(n) == bits


def test_a_key_filter_loses_no_row(spark, monkeypatch):
    keys = spark.range(20_000).selectExpr("CASE WHEN id % 1000 > 0 THEN concat('k', id * 3) END AS k")
    facts = spark.range(60_000).selectExpr("CASE WHEN id % 500 > 0 THEN concat('k', id) END AS k", "id AS part", "id % 2 AS words")
    found = having_keys(facts, keys, "k")
    assert found.columns == facts.columns
    wanted = facts.join(keys, "k", "left_semi")
    assert wanted.exceptAll(found.select(*wanted.columns)).isEmpty()
    assert wanted.count() <= found.count() < 1.1 * wanted.count()
    assert key_filter(keys, "k", filter_bits(20_000)).count() <= filter_bits(20_000) // joins.ROW_BITS
    assert having_keys(facts, keys.limit(0), "k").isEmpty() and having_keys(facts.limit(0), keys, "k").isEmpty()
    # Too many keys for the largest filter: rows stay as they are.
    monkeypatch.setattr(joins, "MOST_BITS", 1 << 10)
    assert having_keys(facts, spark.range(40_000).selectExpr("concat('k', id) AS k"), "k").count() == facts.filter("k is not null").count()


def test_the_deltas_behind_derived_bands_are_computed_once(spark, inputs, monkeypatch):
    stored = []
    monkeypatch.setattr(uptake, "kept", lambda table, name: stored.append(name) or kept(table, name))
    derived = derived_datamart(*inputs)
    assert stored == ["deltas"] and "app" not in plan(derived)
    bands = derive_bands(delta_histogram(user_deltas(*inputs), one_row_per_user=True))
    wanted = assign_segments(user_deltas(*inputs), bands)
    assert sorted(map(str, derived.collect())) == sorted(map(str, wanted.collect()))


def test_a_lookup_is_broadcast_by_its_bound_or_else_by_its_own_size(inputs, spark):
    profiles, lookup, launch = inputs
    models = launched_models(lookup, launch, BRAND)
    bound = of_brand(lookup, BRAND).select("model", "name", F.lit("yyyy-mm-dd").alias("launch"))
    assert measured_bytes(models) < measured_bytes(bound)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_bound, by_size, neither = (
            plan(user_deltas(*inputs, broadcast_bytes=size))
            for size in (
                measured_bytes(bound), measured_bytes(models), measured_bytes(models) - 1
            )
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [device_model" in by_bound
    assert "BroadcastHashJoin [device_model" in by_size
    assert "SortMergeJoin [device_model" in neither


def test_brand_cuts_the_lookup_before_the_join(inputs):
    profiles, lookup, _ = inputs
    text = plan(enrich(earliest_sightings(profiles), lookup, BRAND))
    assert re.search(r"BroadcastHashJoin.*Inner", text)
    assert "(coalesce(Retail Branding" in text
