"""Mixing against reference levels and the shares it is to reach."""

from __future__ import annotations

import re
from math import floor, sqrt

import pytest
from pyspark.sql import functions as F

from launchtide.llm import mixing
from launchtide.llm.mixing import mix, mixed

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Share, cut and share the excess again, until nothing is above its limit."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    total, done = share * sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in done]
        level = (total - sum(done.values())) / sum(weight[n] for n in free) if free else 0
        above = [n for n in free if weight[n] * level >= most * sizes[n]]
        if not above:
            return done | {n: weight[n] * level for n in free}
        done |= {n: most * sizes[n] for n in above}


def check(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    found = mix(docs).select("doc_id", "source", "mix_size", "mix_source_size", "mix_target", "mix_copies").collect()
    assert len(found) == len(rows)
    sizes = {}
    for row in rows:
        sizes[row.source] = sizes.get(row.source, 0) + len(SPACE.findall(row.text or ""))
    wanted = targets(sizes)
    taken, marginal = {}, {}
    for row in found:
        assert row.mix_source_size == sizes[row.source]
        assert row.mix_target == pytest.approx(wanted[row.source])
        assert 0 <= row.mix_copies <= 2
        taken[row.source] = taken.get(row.source, 0) + row.mix_size * row.mix_copies
        marginal[row.source] = max(marginal.get(row.source, 0), row.mix_size)
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= marginal[source] / 2 + 1e-6
    assert sorted(map(str, found)) == sorted(map(str, mix(docs.repartition(7)).select(found[0].__fields__).collect()))
    return found


def test_shares_and_reruns(copies):
    found = check(copies)
    assert {row.mix_copies for row in found} >= {0, 1, 2}
    rows = mixed(copies)
    assert rows.columns == copies.columns
    assert rows.count() == sum(row.mix_copies for row in found)


def test_edges(edge_docs, edge_rows, no_docs, spark):
    unique = edge_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check(unique)
    whole = mix(edge_docs)
    assert whole.count() == len(edge_rows) and set(edge_docs.columns) < set(whole.columns)
    assert mix(no_docs).count() == 0 and mixed(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert {(r.mix_size, r.mix_target, r.mix_copies) for r in mix(blank).collect()} == {(0, 0.0, 0)}
    one = spark.createDataFrame([(1, "a b c", "s")], "doc_id bigint, text string, source string")
    assert [(r.mix_target, r.mix_copies) for r in mix(one).collect()] == [(4.5, 2)]


def test_draws_follow_the_chances(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.concat(F.lit("s"), F.col("id") % 2).alias("source"))
    rows = mix(docs).groupBy("source").agg(F.avg("mix_copies").alias("mean"), F.first("mix_target").alias("t"), F.first("mix_source_size").alias("n")).collect()
    for row in rows:
        assert row["mean"] == pytest.approx(row.t / row.n, abs=1e-3)


def test_no_python_in_the_plan(copies):
    plan = mixed(copies)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def pareto(rows, plan):
    """Which documents one source takes once more, ranked one by one. ``rows``: (key, size, drawn)."""
    rest, chance, mean = plan

    def q(row):
        odds = chance / (1 - chance) * (floor(sqrt(row[1] + 1) * 1024) / mean)
        return row[2] / (1 - row[2]) / odds

    taken, before = set(), 0
    for key, size, _ in sorted(rows, key=q):
        if before + size / 2 <= rest:
            taken.add(key)
        before += size
    return taken


def sizes_of_two(spark):
    """A third of the documents have 64 times the words of the others."""
    text = F.when(F.col("id") % 3 == 0, F.repeat(F.lit("w "), 128)).otherwise(F.lit("a b"))
    return spark.range(900).select(F.col("id").alias("doc_id"), text.alias("text"), F.concat(F.lit("s"), F.col("id") % 2).alias("source"))


def test_the_sample_is_ranked_by_odds_over_inclusion_odds(spark):
    docs = sizes_of_two(spark)
    drawn = {r.doc_id: r.u for r in docs.select("doc_id", mixing.uniform("doc_id", "text", 4).alias("u")).collect()}
    rows = mix(docs, share=0.8).collect()
    for source in ("s0", "s1"):
        own = [r for r in rows if r.source == source]
        total, target = own[0].mix_source_size, own[0].mix_target
        whole = target // total
        rest = target - whole * total
        mean = sum(r.mix_size * floor(sqrt(r.mix_size + 1) * 1024) for r in own) / total
        wanted = pareto([(r.doc_id, r.mix_size, drawn[r.doc_id]) for r in own], (rest, rest / total, mean))
        assert {r.doc_id for r in own if r.mix_copies > whole} == wanted


def test_without_the_inclusion_odds_the_sample_differs(spark, monkeypatch):
    docs = sizes_of_two(spark)
    divided = {r.doc_id: r.mix_copies for r in mix(docs, share=0.8).collect()}
    monkeypatch.setattr(mixing, "inclusion_odds", lambda chance, size, mean: F.when(chance > 0, F.lit(1.0)))
    bare = {r.doc_id: r.mix_copies for r in mix(docs, share=0.8).collect()}
    assert sum(divided[k] != bare[k] for k in bare) > 50


def test_inclusion_frequencies_follow_the_odds(spark):
    """Over seeds documents of each size are taken as often as their odds say."""
    docs = sizes_of_two(spark).withColumn("source", F.lit("s"))
    times, n = {2: 0, 128: 0}, 12
    for seed in range(n):
        rows = mix(docs, weights=(1,), share=0.5, seed=seed).collect()
        for r in rows:
            times[r.mix_size] += r.mix_copies
    small, large = times[2] / (600 * n), times[128] / (300 * n)
    # Pulls of sqrt(3) and sqrt(129): the ratio of the odds.
    ratio = (large / (1 - large)) / (small / (1 - small))
    assert ratio == pytest.approx(sqrt(129) / sqrt(3), rel=0.15)
    taken = (2 * times[2] + 128 * times[128]) / n
    assert taken == pytest.approx(0.5 * (600 * 2 + 300 * 128), rel=0.01)


def test_rows_without_doc_id_reach_the_target(spark):
    docs = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("a b c d"), F.col("id")).alias("text"), F.lit("s").alias("source"))
    rows = mix(docs).collect()
    taken = sum(r.mix_size * r.mix_copies for r in rows)
    assert abs(taken - rows[0].mix_target) <= 2
