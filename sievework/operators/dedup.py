"""Exact duplicates by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical_members(records: DataFrame, key: str, content: str) -> DataFrame:
    """Adds ``content_sha``, ``canonical`` (smallest key with equal content) and ``copies`` to each record.

    The groups are reduced to one row each before they meet the records again, so a group that holds a
    third of all rows is summed map-side and its join can be split. Null contents form one group.
    """
    hashed = records.select(key, F.sha2(F.coalesce(F.col(content), F.lit("")).cast("binary"), 256).alias("content_sha"))
    groups = hashed.groupBy("content_sha").agg(F.min(key).alias("canonical"), F.count("*").alias("copies"))
    return hashed.join(groups, "content_sha")


def duplicate_sources(records: DataFrame, key: str, content: str) -> DataFrame:
    """One row for each content that comes more than once: ``canonical``, the smallest key, and ``duplicates``, how many others.

    The others are rows of ``canonical_members``, not one list: a group may hold any share of all records.
    """
    members = canonical_members(records, key, content)
    return members.filter(F.col("copies") > 1).groupBy("content_sha").agg(F.min("canonical").alias("canonical"), (F.count("*") - 1).alias("duplicates"), F.max(key).alias("last"))


def signature(boxes: Column, digits: int = 4) -> Column:
    """An order-insensitive signature of box arrays, rounded."""
    return F.to_json(F.array_sort(F.transform(boxes, lambda b: F.transform(b, lambda v: F.bround(v, digits)))))


def conflicts(records: DataFrame, content: str, sign: str) -> DataFrame:
    """Contents that come more than once, with the number of their distinct signatures and whether they conflict."""
    sha = F.sha2(F.coalesce(F.col(content), F.lit("")).cast("binary"), 256).alias("content_sha")
    parts = records.select(sha, F.col(sign).alias("sign")).groupBy("content_sha", "sign").agg(F.count("*").alias("n"))
    groups = parts.groupBy("content_sha").agg(F.sum("n").alias("copies"), F.count("sign").alias("n_signatures")).filter("copies > 1")
    return groups.withColumn("conflict", F.col("n_signatures") > 1)


def across_groups(records: DataFrame, content: str, group: str) -> DataFrame:
    """Contents that lie in more than one group."""
    sha = F.sha2(F.coalesce(F.col(content), F.lit("")).cast("binary"), 256).alias("content_sha")
    parts = records.select(sha, F.col(group).alias("g")).groupBy("content_sha", "g").agg(F.count("*").alias("n"))
    return parts.groupBy("content_sha").agg(F.count("g").alias("n_groups"), F.sum("n").alias("copies")).filter("n_groups > 1")


def dedup_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = canonical_members(docs, "doc_id", "text")
    return out.select("doc_id", "content_sha", "canonical", "copies", (F.col("doc_id") == F.col("canonical")).alias("is_canonical"))


DEDUP_CANONICAL_SQL = """
SELECT doc_id, sha256(coalesce(text, '')) AS content_sha, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS canonical,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS copies, doc_id = min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS is_canonical
FROM documents
"""
