"""Tables kept in the folder that driver and executors share, and what queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchtide.sinks.shared import shared_path

#: A table is broadcast only if it is stored and its files hold no more than this.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later steps start from its files, so a lost executor costs the tasks it ran, and
    rows numbered or drawn once stay as they are.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a stored table's values: what texts hold, and 8 for any other column."""
    wide = [F.octet_length(f"`{c}`") for c, kind in df.dtypes if kind in ("string", "binary")]
    each = sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(8 * len(df.columns)))
    return df.agg(F.sum(each.cast("long"))).first()[0] or 0


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Ask for a broadcast of a stored table only when its measured size allows it."""
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df


def spare(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
