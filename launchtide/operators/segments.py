"""Segment assignment and the counts that check it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchtide.functions import within
from launchtide.operators.joins import BROADCAST_BYTES, dealt, fits
from launchtide.schemas import Band, Labels
from launchtide.sinks.shared import kept

#: Bands that may stand as literals beside each delta.
MOST_BANDS = 64
#: Deltas lie within this many days of 0, as Spark's dates run from year 1 to 9999.
FARTHEST = 1 << 22
LEVELS = 23
#: Pairs of a delta and a band that one task makes, about, and the most tasks that make them.
PAIRS = 1 << 22
MOST_TASKS = 4096


def _inside() -> Column:
    """Whether ``delta`` lies in the band beside it; a null limit is open."""
    delta, lo, hi = F.col("delta"), F.col("lo"), F.col("hi")
    return delta.isNotNull() & (lo.isNull() | (delta >= lo)) & (hi.isNull() | (delta <= hi))


def _row(band: Band) -> Column:
    return F.struct(
        F.lit(band.segment).alias("segment"),
        F.lit(band.segment_id).alias("segment_id"),
        F.lit(band.lo).cast("int").alias("lo"),
        F.lit(band.hi).cast("int").alias("hi"),
    )


def _matched(deltas: DataFrame, bands: Sequence[Band]) -> DataFrame:
    """One row per band a delta lies in. A single band is a filter, which a scan can use."""
    if len(bands) == 1:
        (band,) = bands
        return deltas.filter(within(F.col("delta"), band.lo, band.hi)).select(
            "*", F.lit(band.segment).alias("segment"), F.lit(band.segment_id).alias("segment_id")
        )
    if not bands:
        return deltas.select("*", F.lit("").alias("segment"), F.lit("").alias("segment_id")).limit(0)
    return deltas.select("*", F.inline(F.array(*map(_row, bands)))).filter(_inside())


def _listed(bands: DataFrame) -> list[Band] | None:
    """A short band table as a list."""
    rows = bands.select("segment", "segment_id", "lo", "hi").limit(MOST_BANDS + 1).collect()
    return [Band(*row) for row in rows] if len(rows) <= MOST_BANDS else None


def band_nodes(bands: DataFrame) -> DataFrame:
    """Each band as few nodes of a binary tree over the days: its columns with ``level, node``.

    A node of level k stands for 2 ** k days. A band takes at most two nodes of a level, and each of its
    days lies in exactly one of its nodes. Open limits reach to the end of the tree. Further columns stay.
    """
    limits = bands.filter("lo is null or hi is null or lo <= hi")
    low = F.greatest(F.coalesce("lo", F.lit(-FARTHEST)), F.lit(-FARTHEST)).cast("long") + FARTHEST
    high = F.least(F.coalesce("hi", F.lit(FARTHEST - 1)), F.lit(FARTHEST - 1)).cast("long") + FARTHEST + 1
    nodes = []
    for level in range(LEVELS + 1):
        # The band less what finer nodes hold, from the first to before the last node.
        first, last = F.expr(f"(low + {(1 << level) - 1}) div {1 << level}"), F.expr(f"high div {1 << level}")
        for odd, node in ((first, first), (last, last - 1)):
            taken = (first < last) & (odd % 2 == 1)
            nodes.append(F.when(taken, F.struct(F.lit(level).alias("level"), node.alias("node"))))
    found = F.filter(F.array(*nodes), lambda x: x.isNotNull())
    return (
        limits.withColumns({"low": low, "high": high})
        .withColumn("at", F.explode(found))
        .select(*(name for name in bands.columns if name not in ("lo", "hi")), "at.level", "at.node")
    )


def _pairs_by_day(deltas: DataFrame, matches: DataFrame, pairs: int) -> tuple[int, list[tuple]]:
    """Tasks that make all pairs, and ``delta, salts, by_user`` of days with more pairs than one should make.

    A day's larger side is dealt, of which ``by_user`` tells whether it is the deltas, and the
    smaller one copied to each salt. There are fewer such days than tasks.
    """
    days = [table.groupBy("delta").agg(F.count("*").alias(n)) for table, n in ((deltas, "n"), (matches, "m"))]
    load = kept(days[0].join(days[1], "delta").withColumn("pairs", F.col("n") * F.col("m")), "pairs")
    total = load.agg(F.sum("pairs")).first()[0] or 0
    each = max(pairs, -(-total // MOST_TASKS))
    salts = F.least(F.ceil(F.col("pairs") / each), F.greatest("n", "m")).cast("int")
    much = load.filter(F.col("pairs") > each).select("delta", salts, F.col("n") >= F.col("m"))
    return max(1, -(-total // each)), [tuple(row) for row in much.collect()]


def _copied(table: DataFrame, days: DataFrame) -> DataFrame:
    """``table`` with each row of ``days`` once for each of their salts."""
    every = F.when(F.col("salts").isNotNull(), F.sequence(F.lit(0), F.col("salts") - 1))
    salts = F.explode(F.coalesce(every, F.array("salt")))
    columns = [name for name in table.columns if name != "salt"]
    return table.join(days, "delta", "left").select(*columns, salts.alias("salt"))


def matched_by_days(
    deltas: DataFrame, bands: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, pairs: int = PAIRS
) -> DataFrame:
    """``deltas`` with ``segment, segment_id``, a row for each band of a table of any size.

    The days that occur, some thousands, look up the nodes above them; bands and days then join
    on equal nodes, and deltas with the outcome on equal days. No pair of day and band is made
    that does not match. ``deltas`` is stored, as it is read twice.

    Where the outcome is not broadcast, its rows and the deltas are counted by day. As many tasks as
    all pairs fill make about ``pairs`` each, and days with more are dealt over salts. In a task, bands are
    read one by one, each beside all deltas of its day, so a count by segment
    that follows meets rows of one segment together.
    """
    deltas = kept(deltas.filter(F.col("delta").isNotNull()), "deltas")
    days = deltas.select("delta").distinct()
    day = F.col("delta").cast("long") + FARTHEST
    above = F.array(*(F.struct(F.lit(k).alias("level"), F.shiftright(day, k).alias("node")) for k in range(LEVELS + 1)))
    lines = days.select("delta", F.inline(above))
    # Equal bands are told apart by ``turn``, so that they part where a day is dealt.
    counted = bands.groupBy("segment", "segment_id", "lo", "hi").agg(F.count("*").cast("int").alias("copies"))
    turns = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    numbered = counted.select("segment", "segment_id", "lo", "hi", turns.alias("turn"))
    found = lines.join(band_nodes(numbered), ["level", "node"])
    matches = kept(found.select("delta", "segment", "segment_id", "turn"), "matches")
    if fits(broadcast_bytes, matches):
        return deltas.join(F.broadcast(matches.drop("turn")), "delta")
    tasks, much = _pairs_by_day(deltas, matches, pairs)
    hot = deltas.sparkSession.createDataFrame(much, "delta int, salts int, by_user boolean")
    by_user = F.broadcast(hot.filter("by_user").drop("by_user"))
    by_band = F.broadcast(hot.filter("not by_user").drop("by_user"))
    users = dealt(deltas, by_user, "delta") if any(row[2] for row in much) else deltas.withColumn("salt", F.lit(0))
    own = F.pmod(F.xxhash64("segment", "segment_id") + F.col("turn"), F.col("salts")).cast("int")
    parted = matches.join(by_band, "delta", "left").select(
        "delta", "segment", "segment_id", F.coalesce(own, F.lit(0)).alias("salt")
    )
    place = (tasks, "delta", "salt")
    joined = _copied(parted, by_user).repartition(*place).join(_copied(users, by_band).repartition(*place), ["delta", "salt"])
    return joined.select(*deltas.columns, "segment", "segment_id")


def assign_segments(
    deltas: DataFrame, bands: Sequence[Band] | DataFrame, labels: Labels = Labels()
) -> DataFrame:
    """The ten-column segment table: a row for each band a user's delta lies in.

    ``deltas`` is read once, whatever the number of bands. ``bands`` may be the table
    made by :func:`launchtide.operators.histogram.derive_bands`: its few rows are fetched,
    which computes them, and stand as literals beside each delta like those of a list. More
    than ``MOST_BANDS`` bands are joined by days (:func:`matched_by_days`).
    """
    if isinstance(bands, DataFrame):
        listed = _listed(bands)
    else:
        listed = bands if len(bands) <= MOST_BANDS else None
    if listed is None and not isinstance(bands, DataFrame):
        rows = [(band.segment, band.segment_id, band.lo, band.hi) for band in bands]
        bands = deltas.sparkSession.createDataFrame(rows, "segment string, segment_id string, lo int, hi int")
    matched = matched_by_days(deltas, bands) if listed is None else _matched(deltas, listed)
    return matched.select(
        F.lit(labels.quarter).alias("quarter"),
        F.lit(labels.adoption_type).alias("adoption_type"),
        "ifa",
        "segment_id",
        "segment",
        F.lit(labels.device_brand).alias("device_brand"),
        F.col("name").alias("device_name"),
        F.col("launch").alias("launch_date"),
        "first_seen",
        "delta",
    )


def segment_audit(datamart: DataFrame) -> DataFrame:
    """Rows and distinct users of each segment, in one pass: ``segment, n_rows, n_users``."""
    return datamart.groupBy("segment").agg(
        F.count("ifa").alias("n_rows"), F.count_distinct("ifa").alias("n_users")
    )


def datamart_totals(datamart: DataFrame) -> DataFrame:
    """Rows and distinct users of the whole table: ``n_rows, n_users``."""
    return datamart.agg(F.count("ifa").alias("n_rows"), F.count_distinct("ifa").alias("n_users"))


def distinct_users(datamart: DataFrame) -> DataFrame:
    """Every user of a segment table once."""
    return datamart.select("ifa").distinct()
