"""Collapse of cumulative conversation snapshots, and rendering of what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from launchtide.llm.shared import stored


def _turns(turns: DataFrame) -> DataFrame:
    """Turns with two 64-bit hashes of role and text, in which nulls differ from ``""``."""
    content = [F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        F.xxhash64(F.lit(1), *content).alias("h1"),
        F.xxhash64(F.lit(2), *content).alias("h2"),
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, place, p1, p2, last``: for each turn the hash of all turns up to it.

    A turn's hash covers its place from 1, role and text; a prefix's hash is the exclusive
    or of its turns' hashes, so it rolls from turn to turn in one pass and equal prefixes
    have equal hashes whatever their turn numbers. Two are kept, 128 bits together. A turn
    without conv_id is a conversation of its own.
    """
    lone = turns.filter("conv_id is null").select("conv_id", F.lit(1).alias("place"), *_first_place(), F.lit(True).alias("last"))
    turns = turns.filter("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "h1", "h2")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.select("conv_id", "turn", "h1", "h2").withColumn("place", F.row_number().over(order))
    return placed.select(
        "conv_id",
        "place",
        F.bit_xor(F.xxhash64("place", "h1", "h2")).over(running).alias("p1"),
        F.bit_xor(F.xxhash64("h2", "place", "h1")).over(running).alias("p2"),
        F.lead("place").over(order).isNull().alias("last"),
    ).union(lone)


def _first_place() -> list[Column]:
    """``p1, p2`` of a conversation of one turn."""
    return [F.xxhash64(F.lit(1), "h1", "h2").alias("p1"), F.xxhash64("h2", F.lit(1), "h1").alias("p2")]


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, p1, p2, n_turns, n_copies`` of conversations that are no prefix of a longer one.

    A conversation goes if its whole hash is that of a proper prefix of another: an
    anti-join with the distinct hashes of proper prefixes. Of equal conversations the one
    of least conv_id stays, with their number. Distinct hashes and copies are combined
    before their shuffles, so a first turn or a conversation that occurs in a third of all
    rows is one row per task.
    """
    prefixes = stored(prefix_hashes(turns), "prefixes")
    whole = (
        prefixes.filter("last")
        .groupBy("p1", "p2", "place")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    inner = prefixes.filter("not last").select("p1", "p2", "place").distinct()
    return whole.join(inner, ["p1", "p2", "place"], "left_anti").select(
        "conv_id", "p1", "p2", F.col("place").cast("long").alias("n_turns"), "n_copies"
    )


def format_chats(
    turns: DataFrame, *, begin: str = "<|im_start|>", end: str = "<|im_end|>"
) -> DataFrame:
    """One row per maximal conversation: ``conv_id, n_turns, n_copies, n_chars, text``.

    A logged conversation that is the beginning of a longer one, turn by turn in role and
    text, is dropped; of equal ones the least conv_id stays. The others are rendered:
    each turn as ``begin``, role, line feed, text, ``end``, line feed.

    Turns are taken in the order of ``turn``, nulls last, equal ones in the order of their
    hashes; their numbers need not begin at 0. A null role or text differs from an empty
    one but renders like it. A row without conv_id is a conversation of its own; of equal ones
    without any conv_id one stays, and has none. No turns, no rows. Only ``conv_id, turn, role, text`` are read.
    """
    turns = _turns(turns)
    kept = maximal_conversations(turns).withColumnRenamed("conv_id", "id")
    line = F.concat(
        F.lit(begin), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(f"{end}\n")
    )
    known, lone = kept.filter("id is not null").drop("p1", "p2"), kept.filter("id is null")
    lines = (
        turns.join(known, turns.conv_id == known.id)
        .groupBy("conv_id", "n_turns", "n_copies")
        .agg(F.collect_list(F.struct(F.col("turn").isNull(), "turn", "h1", "h2", line.alias("line"))).alias("lines"))
    )
    rendered = lines.select(
        "conv_id", "n_turns", "n_copies", F.array_join(F.transform(F.sort_array("lines"), lambda x: x.line), "").alias("text")
    )
    # Equal turns are one line ahead of the shuffle, however many there are.
    single = turns.filter("conv_id is null").select(*_first_place(), line.alias("text")).groupBy("p1", "p2").agg(F.min("text").alias("text"))
    rendered = rendered.union(single.join(lone, ["p1", "p2"]).select(F.col("id"), "n_turns", "n_copies", "text"))
    return rendered.select("conv_id", "n_turns", "n_copies", F.length("text").cast("long").alias("n_chars"), "text")
