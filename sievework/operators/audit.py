"""Audits of parents and children: orphans, missing parts, defaults, counts and totals of issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..shared import materialize


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose key is null or names no parent."""
    return children.join(parents.select(F.col(parent_key).alias("parent_")).distinct(), F.col(child_key) == F.col("parent_"), "left_anti")


def childless(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    return orphans(parents, children, parent_key, child_key)


def attach(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, item: Column, name: str) -> DataFrame:
    """Each parent with the sorted array of its children's ``item``; empty without children."""
    lists = children.groupBy(F.col(child_key).alias("key_")).agg(F.array_sort(F.collect_list(item)).alias(name))
    joined = parents.join(lists, F.col(parent_key) == F.col("key_"), "left").drop("key_")
    return joined.withColumn(name, F.coalesce(F.col(name), F.array().cast(joined.schema[name].dataType)))


def count_by(records: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return records.groupBy(*keys).agg(F.count("*").alias(name))


def required_values(records: DataFrame, group: str, value: str, wanted: list[str]) -> DataFrame:
    """Per group whether it has every wanted value (``has_all``), and its number of records; values are told apart within tasks first."""
    has = [F.bool_or(F.coalesce(F.col(value) == w, F.lit(False))) for w in wanted]
    whole = has[0]
    for one in has[1:]:
        whole = whole & one
    return records.groupBy(group).agg(whole.alias("has_all"), F.count("*").alias("n"))


def target_counts(children: DataFrame, key: str, is_target: Column) -> DataFrame:
    """Children of each key that are targets, and the others."""
    return children.groupBy(key).agg(F.count_if(is_target).alias("target_count"), F.count_if(~is_target).alias("other_count"))


def written_and_counted(rows: DataFrame, counts: dict[str, Column], name: str) -> tuple[DataFrame, dict[str, int]]:
    """The rows, written once, and how many of them meet each condition, counted as they pass to the table.

    The counts cost no scan of their own. They are taken in the tasks that write, each of which counts once however
    often it is tried, so lost executors do not change them. A null condition is not met.
    """
    seen = Observation()
    out = materialize(rows.observe(seen, *[F.count_if(c).alias(k) for k, c in counts.items()]), name)
    return out, {k: int(n) for k, n in seen.get.items()}


def issue_totals(issues: dict[str, DataFrame], spark) -> DataFrame:
    """One row per kind of issue, also of those that never occur, and the total over all kinds."""
    counts = None
    for kind, rows in issues.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(kind).alias("issue"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts.unionByName(counts.agg(F.sum("n").alias("n")).select(F.lit("total").alias("issue"), "n"))


def set_difference(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """How many distinct keys are missing or extra, and whether the sets are equal."""
    both = expected.select(key).distinct().withColumn("e", F.lit(True)).join(actual.select(key).distinct().withColumn("a", F.lit(True)), key, "full")
    out = both.agg(F.count_if(F.col("a").isNull()).alias("missing"), F.count_if(F.col("e").isNull()).alias("extra"))
    return out.withColumn("equal", (F.col("missing") == 0) & (F.col("extra") == 0))
