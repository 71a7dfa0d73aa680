"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where that is unset, a local folder is made, but only for a local master, as in tests: the executors of a cluster
    would not see it, so there a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/sievework/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage at a table that survives the loss of executors.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of ids that may be broadcast; larger tables are joined by shuffle. A row of a few numbers was measured at some
#: 60 bytes in a broadcast, so this is about 30 MB.
BROADCAST_ROWS = 500_000


def broadcast_if_small(ids: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``ids``, rows of a few numbers or short names, with a broadcast hint if it has been counted to hold at most ``most``."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids
