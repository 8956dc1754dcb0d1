"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.llm.shared import broadcast_if_small, spare, stored

#: Bins over the ranking of a source: so many coarse ones, each of so many fine ones.
BINS = 512
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text"):
    """Words of a text, parted by ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: str, text: str, seed: int):
    """A number between 0 and 1 that a document keeps in every run: 52 bits of an md5.

    It is drawn from doc_id and text, so rows that repeat a doc_id or have none differ as
    long as their texts do.
    """
    own = F.md5(F.coalesce(text, F.lit("")))
    digits = F.substring(F.md5(F.concat_ws(":", F.col(doc_id).cast("string"), own, F.lit(str(seed)))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def pull(size):
    """A document's weight by its words, as a whole number: their square root, times 1024."""
    return F.floor(F.sqrt(size + 1) * 1024)


def inclusion_odds(chance, size, mean_pull):
    """A document's odds to be taken once more: those of its source, times its pull over the
    source's mean. A document of four times the words has twice the odds."""
    return chance / (1 - chance) * (pull(size) / mean_pull)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target, whole copies and mean chance of one more copy for each source.

    ``sizes``: (source, source_size, mean_pull), a row per source. The target is ``weight * level``
    but at most ``most * source_size``; the level is the one at which all targets make
    ``share`` of all sizes. Sources fill up in the order of limit over weight, so the level
    stands at the first that does not.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    limited = sizes.select(
        "source",
        "source_size",
        "mean_pull",
        F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(most)).alias("limit"),
    ).withColumn("ratio", F.col("limit") / F.col("weight"))
    filling = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    filled = limited.withColumn("level", level)
    reached = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", F.col("source").isNull(), "source", "level")))
    target = F.least(F.col("limit"), F.col("weight") * F.col("reached.level"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        filled.withColumn("reached", reached.over(everything))
        .withColumn("target", F.coalesce(target, "limit"))
        .withColumn("whole", F.floor(rate))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("chance", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0))
        .select("source", "source_size", "mean_pull", "target", "whole", "rest", "chance")
    )


def _ranked(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents of sources with a rest to take, by random odds over inclusion odds."""
    chance = F.col("chance")
    odds = F.try_divide(F.col("drawn") / (1 - F.col("drawn")), inclusion_odds(chance, F.col("size"), F.col("mean_pull")))
    return (
        sized.join(broadcast_if_small(plan), sized.source.eqNullSafe(plan.source))
        .select(sized.source, "doc_id", "size", "rest", F.when(chance > 0, odds).alias("odds"))
        .withColumn("bin", _bin(F.col("odds")))
    )


def _bin(odds):
    return F.least(F.floor(odds / (1 + odds) * (BINS * BINS)), F.lit(BINS * BINS - 1)).cast("int")


def _cut_bin(rows: DataFrame, name: str) -> DataFrame:
    """The bin of each source in which its rest runs out, and the words before that bin.

    ``rows``: (source, rest, already, <name>, size); words are summed by bin ahead of the
    shuffle, and at most ``BINS`` sums of a source meet in a task.
    """
    bins = rows.groupBy("source", "rest", "already", name).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy(name)
    running = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        bins.withColumn("after", F.col("already") + running)
        .filter("after > rest")
        .withColumn("first", F.row_number().over(order))
        .filter("first = 1")
        .select("source", "rest", name, (F.col("after") - F.col("words")).alias("already"))
    )


def _cuts(ranked: DataFrame) -> DataFrame:
    """``(source, cut_bin, cut_odds, cut_id)``: the last document each source takes once more.

    Coarse bins, then fine bins within one, then the documents within one of those: each
    step keeps the part in which the rest runs out.
    """
    ranked = ranked.filter("odds is not null").withColumn("coarse", F.shiftright("bin", BINS.bit_length() - 1))
    coarse = stored(_cut_bin(ranked.withColumn("already", F.lit(0).cast("long")), "coarse"), "coarse")
    inner = _within(ranked, coarse, "coarse")
    fine = stored(_cut_bin(inner, "bin"), "fine")
    rows = _within(inner.drop("already"), fine, "bin")
    order = Window.partitionBy("source").orderBy("odds", "doc_id")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (
        rows.withColumn("before", F.col("already") + before)
        .filter("before + size / 2 <= rest")
        .groupBy("source")
        .agg(F.max(F.struct("odds", "doc_id")).alias("last"))
    )
    a, b = fine.alias("a"), last.alias("b")
    return a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left").select(
        "a.source",
        F.col("bin").alias("cut_bin"),
        F.col("last.odds").alias("cut_odds"),
        F.col("last.doc_id").alias("cut_id"),
    )


def _within(rows: DataFrame, cut: DataFrame, name: str) -> DataFrame:
    """The rows of each source's cut bin, with the words before it."""
    cut = broadcast_if_small(cut.select(F.col("source").alias("of"), F.col(name).alias("at"), "already"))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col(name) == F.col("at"))
    return rows.drop("already").join(cut, same).drop("of", "at")


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2,
    seed: int = 4,
) -> DataFrame:
    """All columns of ``docs`` and ``mix_size, mix_source_size, mix_target, mix_copies``.

    A source is to give ``target`` words (:func:`source_targets`): sources in the order of
    their names, null last, have the given weights in turn. A document of a source with
    rate ``target / source_size`` has the whole part as certain copies; the fraction is the
    mean chance of one more. A document's own inclusion odds are those of this chance, times
    the square root of its words over the source's mean (:func:`inclusion_odds`). Within a source
    documents are ranked by their random odds over these inclusion odds (Pareto order
    sampling) and taken until the source's rest is reached, to the nearest: the next document is taken if at least half of it fits. So a
    source misses its target by at most half a document, and no document is taken more
    than ``ceil(most)`` times.

    The random number is a hash of doc_id, text and ``seed``: reruns agree. Rows alike in doc_id and
    text are taken or left together, so they can add to the miss. A null or blank text has size 0; a source of such
    texts has target 0. Columns of the same names in ``docs`` are replaced.
    """
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_copies")
    sized = stored(
        docs.select(
            "source",
            F.col("doc_id").cast("long").alias("doc_id"),
            words().alias("size"),
            uniform("doc_id", "text", seed).alias("drawn"),
        ),
        "sizes",
    )
    return _apply(docs, plan_of(sized, weights, share, most), words(), seed)


def plan_of(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: its target, whole copies, and where its ranking is cut."""
    # The mean pull of a source's words; sums of whole numbers don't depend on their order.
    drawn = F.sum((F.col("size") * pull(F.col("size"))).cast("decimal(38,0)")).cast("double")
    mean = F.coalesce(F.try_divide(drawn, F.sum("size").cast("double")), F.lit(1.0))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), mean.alias("mean_pull"))
    targets = stored(source_targets(sizes, weights, share, most), "targets")
    cuts = stored(_cuts(_ranked(sized, targets)), "cuts").withColumnRenamed("source", "of")
    return stored(
        targets.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"), "mix"
    )


def _apply(docs: DataFrame, plan: DataFrame, size, seed: int) -> DataFrame:
    names = {c: spare(docs, f"mix_{c}_") for c in plan.columns}
    plan = broadcast_if_small(plan.withColumnsRenamed(names))
    chance, drawn = F.col(names["chance"]), uniform("doc_id", "text", seed)
    odds = F.try_divide(drawn / (1 - drawn), inclusion_odds(chance, size, F.col(names["mean_pull"])))
    bin_, at = _bin(odds), F.col(names["cut_bin"])
    place = F.struct(odds.alias("odds"), F.col("doc_id").cast("long").alias("doc_id"))
    last = F.struct(F.col(names["cut_odds"]).alias("odds"), F.col(names["cut_id"]).alias("doc_id"))
    within = (bin_ == at) & F.col(names["cut_odds"]).isNotNull() & (place <= last)
    more = F.when((chance > 0) & ((bin_ < at) | within), 1).otherwise(0)
    return docs.join(plan, docs.source.eqNullSafe(F.col(names["source"])), "left").select(
        *(docs[f"`{c}`"] for c in docs.columns),
        size.alias("mix_size"),
        F.col(names["source_size"]).alias("mix_source_size"),
        F.col(names["target"]).alias("mix_target"),
        (F.col(names["whole"]) + more).cast("long").alias("mix_copies"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, columns as they are."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int")))
    name = spare(docs, "copy")
    return mix(docs, **options).withColumn(name, copies).select(*(F.col(f"`{c}`") for c in docs.columns))
