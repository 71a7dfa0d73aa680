"""Incremental runs: progress records and event windows as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New JSON-lines files below ``folder`` as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def once_per_key(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark, so that records delivered twice count once."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def append_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process all that is there and stop; a later call goes on where this one ended."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
