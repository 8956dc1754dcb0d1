"""Histograms of launch deltas and the bands cut from them.

A histogram has one row per delta (and month). Spark dates run from year 1 to 9999,
so there are at most 3.7 million deltas, and some thousands in practice, however
many users there are: sorting and running sums over a histogram are small work.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.schemas import MY_BANDS, Band

# Running shares of Rogers, Diffusion of Innovations: 2.5, 13.5, 34 and 34 per cent.
SHARES = ("0.025", "0.16", "0.50", "0.84")


def delta_histogram(
    deltas: DataFrame, by: Sequence[str] = (), one_row_per_user: bool = False
) -> DataFrame:
    """Users per delta, as ``delta, count`` with the columns of ``by`` before them.

    Where the rows are known to hold a user once per ``by``, as first devices do,
    ``one_row_per_user`` counts rows and spares the shuffle of user ids.
    """
    users = F.count("ifa") if one_row_per_user else F.count_distinct("ifa")
    return deltas.groupBy(*by, "delta").agg(users.alias("count")).orderBy(*by, "delta")


def delta_row_histogram(deltas: DataFrame) -> DataFrame:
    """Rows per delta, a user counted as often as there are rows."""
    return delta_histogram(deltas, one_row_per_user=True)


def combine_histograms(histograms: DataFrame) -> DataFrame:
    """Sum of month-wise histograms, as ``delta, sum_count``.

    A user seen in several months counts in each. For distinct users take
    :func:`delta_histogram` over the deltas of all months.
    """
    return histograms.groupBy("delta").agg(F.sum("count").alias("sum_count")).orderBy("delta")


def derive_bands(
    histogram: DataFrame,
    shares: Sequence[str] = SHARES,
    bands: Sequence[Band] = MY_BANDS,
    count: str = "count",
) -> DataFrame:
    """Bands ``band_order, segment, segment_id, lo, hi`` cut from a histogram over all months.

    A cut is the least delta at which the running share of ``count`` reaches a share;
    it closes one band and the next begins a day later. Names and ids are taken from
    ``bands``, one more than there are shares. Shares rise, and lie above 0 and up to 1:
    one that is never reached would leave its band open, and falling ones would cross.
    """
    exact = [Decimal(str(share)) for share in shares]
    if any(a >= b for a, b in zip([0, *exact], exact, strict=False)) or max(exact, default=1) > 1:
        raise ValueError(f"shares have to rise within 0 and 1, unlike {', '.join(map(str, shares))}")
    if len(bands) != len(shares) + 1:
        raise ValueError(f"{len(shares)} shares cut {len(shares) + 1} bands, not {len(bands)}")
    in_order = Window.orderBy("delta").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("delta").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    running = histogram.select(
        "delta",
        F.sum(count).over(in_order).alias("running"),
        F.sum(count).over(everything).alias("total"),
    )
    cuts = running.agg(
        *[
            F.min(
                F.when(F.col("running") >= F.col("total") * F.lit(share), F.col("delta"))
            ).alias(f"cut{i}")
            for i, share in enumerate(exact)
        ]
    )
    rows = [
        F.struct(
            F.lit(i).alias("band_order"),
            F.lit(band.segment).alias("segment"),
            F.lit(band.segment_id).alias("segment_id"),
            (F.col(f"cut{i - 1}") + 1 if i > 0 else F.lit(None).cast("int")).alias("lo"),
            (F.col(f"cut{i}") if i < len(shares) else F.lit(None).cast("int")).alias("hi"),
        )
        for i, band in enumerate(bands)
    ]
    return cuts.select(F.inline(F.array(*rows)))
