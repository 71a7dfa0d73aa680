"""Progress logs: lines of JSON of which the last for each key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def latest(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last record of each key by ``order``, reduced map-side."""
    others = [c for c in records.columns if c != key]
    return records.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("last_")).select(key, "last_.*")


def lines_of(text: DataFrame) -> DataFrame:
    """Of a reader of text files, whole or a stream, the lines (``value``) with their ``file`` and the ``block`` of it that was read."""
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def placed_records(lines: DataFrame, schema: StructType, key: str) -> DataFrame:
    """The records of lines (see ``lines_of``) with ``place``: file, block and the line's order in it.

    A torn last line of a file is ignored, for a writer may have died there; any other line that is no record, or has no
    key, is an error. No file is held whole; where each ends is one row for a file, which is broadcast.
    """
    numbered = lines.withColumn("row", F.monotonically_increasing_id()).filter(F.trim("value") != "")
    full = StructType([*schema.fields]).add("_corrupt_record", "string")
    parsed = numbered.withColumn("r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    ends = numbered.groupBy("file").agg(F.max(F.struct("block", "row")).alias("end")).withColumnRenamed("file", "end_file")
    bad = F.coalesce(F.col("r").isNull() | F.col("r._corrupt_record").isNotNull() | F.col(f"r.{key}").isNull(), F.lit(True))
    is_end = F.struct("block", "row") == F.col("end")
    checked = parsed.join(F.broadcast(ends), F.col("file") == F.col("end_file")).filter(~(bad & is_end))
    told = F.when(bad, F.raise_error(F.concat(F.lit("a line of the progress log is damaged: "), F.substring("value", 1, 80)))).otherwise(F.col("r"))
    return checked.select(told.alias("r"), F.struct("file", "block", "row").alias("place")).select("r.*", "place").drop("_corrupt_record")


def read_progress(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """The latest record of each key in a log of one or more files.

    A torn last line of a file is ignored, any other line that is no record, or has no key, is an error. Lines are
    placed by file and by their offset, which the reader keeps even where it splits a file.
    """
    return latest(placed_records(lines_of(spark.read.text(path)), schema, key), key, ["place"]).drop("place")
