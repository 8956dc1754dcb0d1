"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names in ``spark.checkpoint.dir``.

    Only a session on one machine may leave that setting out, as tests do; it is then given
    a folder, which stays in the setting for the calls that follow.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="launchtide-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(table: DataFrame, name: str) -> DataFrame:
    """A table written to that folder and read back, so that what follows doesn't compute it again."""
    path = shared_path(table.sparkSession, name)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
