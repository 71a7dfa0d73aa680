"""What a run leaves before and while it works: a lock, its configuration, and its records in batches."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_path

LOCK = "metadata/lock.json"


class Locked(RuntimeError):
    """Another run writes to the folder, or died without giving it back."""


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _holder(spark: SparkSession, uri: str) -> str:
    return "".join(r["value"] for r in spark.read.text(uri).collect())  # a line


@contextmanager
def locked(spark: SparkSession, out: str, take_over: bool = False) -> Iterator[dict]:
    """Holds ``out`` for one run: a second one gets :class:`Locked`, which tells who has it.

    The lock is a file that the file system creates only where there is none. It goes when the run ends, well or not. A
    run whose driver was killed leaves it; ``take_over`` puts the new run in its place.
    """
    uri = f"{out}/{LOCK}"
    path, fs = _path(spark, uri)
    mine = {"run": uuid.uuid4().hex, "application": spark.sparkContext.applicationId, "since_utc": datetime.now(UTC).isoformat()}
    if take_over:
        fs.delete(path, False)
    try:
        stream = fs.create(path, False)
    except Exception as refused:
        if not fs.exists(path):
            raise
        raise Locked(f"{out} belongs to another run: {_holder(spark, uri)}; if that one is dead, take over") from refused
    stream.write(bytearray(json.dumps(mine).encode()))
    stream.close()
    try:
        yield mine
    finally:
        if fs.exists(path) and json.loads(_holder(spark, uri) or "{}").get("run") == mine["run"]:
            fs.delete(path, False)


def in_batches(records: DataFrame, key: str, size: int, name: str) -> list[DataFrame]:
    """The records in parts of about ``size``, by a hash of ``key``, each to be read by itself.

    They are written once, a folder for each part, so that reading a part opens nothing of the others.
    """
    spark = records.sparkSession
    n = -(-records.count() // size)
    if not n:
        return []
    place = shared_path(spark, name)
    records.withColumn("_batch", F.pmod(F.xxhash64(key), F.lit(n))).repartition("_batch").write.partitionBy("_batch").parquet(place)
    path, fs = _path(spark, place)
    there = sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path) if s.isDirectory())
    return [spark.read.schema(records.schema).parquet(f"{place}/_batch={b}") for b in there]
