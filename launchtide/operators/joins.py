"""Joining a large table to a lookup table whose size is not known beforehand."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from launchtide.functions.observed import observed

BROADCAST_BYTES = 32 << 20
CELL_BYTES = 16
#: A key with at least this share of the rows is hot; so there are at most as many as its inverse.
HOT_SHARE = 1 / 64
#: Salts for a key that has all rows; others get their share of them.
SALTS = 256
#: Bits of a key filter for each key, at most (16 MiB), and in one row of its table.
KEY_BITS = 16
MOST_BITS = 1 << 27
ROW_BITS = 1 << 15


def measured_bytes(table: DataFrame) -> int:
    """Size of a table's values, by one aggregation over that table alone."""
    widths = [
        F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + CELL_BYTES
        for name in table.columns
    ]
    return table.agg(F.sum(reduce(add, widths))).first()[0] or 0


def fits(broadcast_bytes: int, *tables: DataFrame | None) -> bool:
    """Whether one of the tables, measured in turn, is small enough to broadcast."""
    return broadcast_bytes >= 0 and any(measured_bytes(t) <= broadcast_bytes for t in tables if t is not None)


def filter_bits(n: int) -> int:
    """Bits of a filter of ``n`` keys, a power of two; 0 if most other keys would pass it too."""
    bits = ROW_BITS
    while bits < min(KEY_BITS * n, MOST_BITS):
        bits *= 2
    return bits if n <= bits else 0


def key_filter(keys: DataFrame, on: str, bits: int) -> DataFrame:
    """``part, words``: a bitmap with the bit of each key's hash set, ``ROW_BITS`` to a row.

    It has at most ``bits`` / 8 bytes, however many keys there are and however long.
    """
    place = F.xxhash64(on).bitwiseAND(F.lit(bits - 1))
    placed = keys.filter(F.col(on).isNotNull()).select(place.alias("place"))
    words = placed.groupBy(
        F.expr(f"place div {ROW_BITS}").alias("part"), F.expr(f"cast(place % {ROW_BITS} div 64 as int)").alias("at")
    ).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("word"))
    filled = F.map_from_entries(F.collect_list(F.struct("at", "word")))
    every = F.sequence(F.lit(0), F.lit(ROW_BITS // 64 - 1))
    return (
        words.groupBy("part")
        .agg(filled.alias("filled"))
        .select("part", F.transform(every, lambda k: F.coalesce(F.try_element_at("filled", k), F.lit(0).cast("long"))).alias("words"))
    )


def having_keys(facts: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows of ``facts`` whose key is among ``keys``, and a few others; none without a key.

    A bitmap of hashes of bounded size is broadcast, whatever the size of ``keys``, so the
    rows that a later join would drop are not shuffled for it. With so many keys that
    the largest bitmap would let most rows pass, ``facts`` is returned as it is.
    """
    keyed = facts.filter(F.col(on).isNotNull())
    bits = filter_bits(keys.count())
    if not bits:
        return keyed
    known = key_filter(keys, on, bits).withColumnsRenamed({"part": "_part", "words": "_words"})
    place = F.xxhash64(on).bitwiseAND(F.lit(bits - 1))
    placed = keyed.withColumn("_place", place)
    set_ = F.expr(f"getbit(_words[cast(_place % {ROW_BITS} div 64 as int)], cast(_place % 64 as int)) = 1")
    found = placed.join(F.broadcast(known), F.expr(f"_place div {ROW_BITS} = _part"))
    return found.filter(set_).select(*facts.columns)


def hot_and_missing(facts: DataFrame, on: str) -> tuple[list[tuple], int]:
    """Keys that hold much of ``facts`` with their salts, at most ``1 / HOT_SHARE``, and the rows without a key.

    One job: rows are counted by key, which is combined before its shuffle, and altogether
    on the way.
    """
    every = Observation()
    counts = (
        facts.observe(every, F.count(F.lit(1)).alias("n"), F.count(F.col(on)).alias("keyed"))
        .filter(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count("*").alias("n"))
    )
    most = counts.orderBy(F.col("n").desc(), on).limit(int(1 / HOT_SHARE)).collect()
    found = observed(every)
    total = found.get("n", 0)
    rows = [(row[on], -(-row["n"] * SALTS // max(total, 1))) for row in most if row["n"] >= max(1, total * HOT_SHARE)]
    return rows, total - found.get("keyed", 0)


def _salts(facts: DataFrame, on: str, rows: list[tuple]) -> DataFrame:
    schema = T.StructType([facts.schema[on], T.StructField("salts", T.IntegerType())])
    return facts.sparkSession.createDataFrame(rows, schema)


def hot_keys(facts: DataFrame, on: str) -> DataFrame:
    """``<on>, salts``: keys that hold much of ``facts`` (:func:`hot_and_missing`)."""
    return _salts(facts, on, hot_and_missing(facts, on)[0])


def dealt(facts: DataFrame, hot: DataFrame, on: str, distinct: bool = False) -> DataFrame:
    """``facts`` that have a key, with ``salt``: rows of hot keys are spread over their salts.

    A row's salt depends on its values and, among equal rows, on its number; never on the
    order of rows, which may differ when a task runs again. Equal rows are counted first,
    unless they are known to be ``distinct``.
    """
    columns = facts.columns
    keyed = facts.filter(F.col(on).isNotNull()).withColumn("turn", F.lit(0))
    if not distinct:
        counted = keyed.groupBy(*columns).agg(F.count("*").cast("int").alias("copies"))
        keyed = counted.select(*columns, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("turn"))
    start = F.pmod(F.xxhash64(*columns), F.col("salts"))
    salt = F.pmod(start + F.col("turn"), F.col("salts")).cast("int")
    return keyed.join(hot, on, "left").select(*columns, F.coalesce(salt, F.lit(0)).alias("salt"))


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    bound: DataFrame | None = None,
    distinct: bool = False,
    filtered: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on one column, ``inner`` or ``left``.

    A lookup measured to fit ``broadcast_bytes`` is broadcast, and ``facts`` is not
    shuffled. Where a lookup takes work to make, ``bound`` names a table that is no
    smaller and is measured first; the lookup itself only if that is too large.

    A larger lookup is shuffled. An inner join first drops the rows whose key it lacks, as far
    as a filter of bounded size tells them (:func:`having_keys`; ``filtered`` tells that this has
    been done). Keys are counted, and rows of all but hot ones are shuffled once, as they are.
    Rows of keys that hold much of ``facts`` are joined apart, to those keys' few lookup rows: by a
    broadcast where these fit a share of its limit, or dealt over salts in proportion to their
    number (:func:`dealt`), so equal rows part as well. ``distinct`` tells that no two rows of ``facts`` are equal, which
    saves counting them there. Rows without a key match nothing; a left join adds them back
    without a shuffle. A part that the count finds empty is left out.
    """
    if fits(broadcast_bytes, bound, lookup):
        return facts.join(F.broadcast(lookup), on, how)
    if how == "inner" and not filtered:
        facts = having_keys(facts, lookup.select(on), on)
    rows, missing = hot_and_missing(facts, on)
    hot = F.broadcast(_salts(facts, on, rows))
    keyed = facts.filter(F.col(on).isNotNull())
    cold = keyed.join(hot, on, "left_anti") if rows else keyed
    joined = cold.join(lookup, on, how)
    if rows:
        much, names = keyed.join(hot, on, "left_semi"), lookup.join(hot, on, "left_semi")
        if fits(broadcast_bytes // int(1 / HOT_SHARE), names):
            apart = much.join(F.broadcast(names), on, how)
        else:
            copies = names.join(hot, on).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            apart = dealt(much, hot, on, distinct).join(copies.drop("salts"), [on, "salt"], how).drop("salt")
        joined = joined.union(apart)
    if how != "left" or not missing:
        return joined
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema if f.name != on]
    unkeyed = facts.filter(F.col(on).isNull()).select(on, *(c for c in facts.columns if c != on), *added)
    return joined.union(unkeyed)
