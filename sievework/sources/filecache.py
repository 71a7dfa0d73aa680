"""Hashes of files that are remembered with their length and time, so that what has not changed is not read again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import materialize
from .images import EXTENSIONS

#: Buckets of names whose digests are compared first: rows that a comparison of unchanged folders joins.
BUCKETS = 4096


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``name`` (from the last two folders on), ``length`` and ``modified`` of every image below ``root``; no file is opened."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", EXTENSIONS).load(root)
    return read.select(F.regexp_extract("path", r"([^/]+/[^/]+/[^/]+)$", 1).alias("name"), "length", F.unix_micros("modificationTime").alias("modified"))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("name"), F.lit(BUCKETS))


def _digests(files: DataFrame, prefix: str) -> DataFrame:
    """A row for each bucket: its files, and a sum of their hashes, which no order changes and tasks take first."""
    one = F.xxhash64("name", "length", "modified").cast("decimal(38,0)")
    return files.groupBy(_bucket().alias("bucket")).agg(F.count("*").alias(f"{prefix}_n"), F.sum(one).alias(f"{prefix}_sum"))


def _read(names: DataFrame, root: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pa.fs.FileSystem.from_uri(root)
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                with fs.open_input_stream(f"{folder}/{name}") as f:
                    while part := f.read(1 << 20):
                        digest.update(part)
                out.append({"name": name, "sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("name", pa.string()), ("sha256", pa.string())]))

    return names.select("name").mapInArrow(run, "name string, sha256 string")


def hashes(spark: SparkSession, root: str, remembered: DataFrame | None) -> DataFrame:
    """``name`` and ``sha256`` of every image below ``root``; only files that are not as they were ``remembered`` are read.

    The names are dealt to buckets. Those whose digest is the remembered one are taken as they were; the files of the
    others are compared one by one by name, length and time. What is changed within its length and time goes unseen.
    """
    now = materialize(listing(spark, root), "listing")
    if remembered is None:
        return _read(now, root)
    both = _digests(now, "now").join(_digests(remembered, "was"), "bucket", "full")
    alike = F.coalesce((F.col("now_n") == F.col("was_n")) & (F.col("now_sum") == F.col("was_sum")), F.lit(False))
    changed = F.broadcast(materialize(both.filter(~alike).select("bucket"), "changed-buckets"))  # BUCKETS rows at most
    in_changed = lambda files, how: files.withColumn("bucket", _bucket()).join(changed, "bucket", how).drop("bucket")
    kept = in_changed(remembered, "left_anti").select("name", "sha256")
    known = materialize(in_changed(now, "left_semi").join(in_changed(remembered, "left_semi"), ["name", "length", "modified"], "left"), "compared")
    return kept.unionByName(known.filter("sha256 IS NOT NULL").select("name", "sha256")).unionByName(_read(known.filter("sha256 IS NULL"), root))


def remember(spark: SparkSession, root: str, known: DataFrame, place: str) -> None:
    """Keeps ``known`` (``name``, ``sha256``) with the files' lengths and times as they are now."""
    materialize(listing(spark, root).join(known, "name"), "remembered").write.mode("overwrite").parquet(place)
