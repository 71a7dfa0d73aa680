"""Splits by group that leak nothing between train, validation and test."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize
from .percentiles import exact_percentiles

SPLITS = ("train", "val", "test")
RATIOS = (0.70, 0.15, 0.15)
#: Weights of images and boxes in the filling, and of boxes in the score.
IMAGE_WEIGHT, BOX_WEIGHT, BOX_SCORE = 0.75, 0.25, 0.5
#: Groups that one task may hold; the search needs all groups' sizes, not their records. Where there are more, only the
#: largest stand alone, half as many, and the others are dealt to as many bundles.
MAX_GROUPS = 100_000


def group_stats(records: DataFrame, group: str, boxes: Column) -> DataFrame:
    """Images and boxes of each group."""
    return records.groupBy(F.col(group).alias("group")).agg(F.count("*").alias("images"), F.sum(F.coalesce(boxes.cast("long"), F.lit(0))).alias("boxes"))


def hash_split(group: Column) -> Column:
    """A split by the MD5 of the group: 70, 15 and 15 of each hundred."""
    at = F.conv(F.substring(F.md5(F.coalesce(group, F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long") % 100
    return F.when(at < 70, "train").when(at < 85, "val").otherwise("test")


def split_stats(stats: DataFrame) -> DataFrame:
    """Groups, images, boxes of each split and their shares in percent; ``stats`` has split, images, boxes."""
    sums = stats.groupBy("split").agg(F.count("*").alias("n_groups"), F.sum("images").alias("images"), F.sum("boxes").alias("boxes"))
    total = stats.agg(F.sum("images").alias("all_images"), F.sum("boxes").alias("all_boxes"))
    share = lambda c: F.round(F.lit(100.0) * F.col(c) / F.greatest(total.select(f"all_{c}").scalar(), F.lit(1)), 2)
    return sums.select("split", "n_groups", "images", "boxes", share("images").alias("image_percent"), share("boxes").alias("box_percent"))


def split_counters(records: DataFrame) -> DataFrame:
    """Images, targets and images without a target of each split (``split``, ``target_count``)."""
    return records.groupBy("split").agg(F.count("*").alias("images"), F.sum("target_count").alias("targets"), F.count_if(F.col("target_count") == 0).alias("negatives"))


def score(held: dict[str, tuple[int, int]], ratios: tuple[float, ...]) -> float:
    """How far splits, with their images and boxes, are from the ratios."""
    images, boxes = (sum(x[i] for x in held.values()) for i in (0, 1))
    off = lambda i, total: sum(abs(held[s][i] / total - r) for s, r in zip(SPLITS, ratios, strict=True))
    return off(0, max(images, 1)) + (BOX_SCORE * off(1, boxes) if boxes else 0.0)


def _attempt(groups: list[tuple[str, int, int]], number: int, seed: int, ratios: tuple[float, ...]) -> tuple[float, dict[str, str]] | None:
    """One greedy assignment: large groups first, each to the split that is filled least."""
    rng = random.Random(seed + number)
    images, boxes = max(sum(g[1] for g in groups), 1), sum(g[2] for g in groups)
    order = groups[:]
    rng.shuffle(order)
    weight = {g: (max(i / images, b / max(boxes, 1)), rng.random()) for g, i, b in order}
    order.sort(key=lambda g: weight[g[0]], reverse=True)
    held = {s: [0, 0, 0] for s in SPLITS}
    chosen: dict[str, str] = {}
    for g, i, b in order:

        def filled(split: str, i: int = i, b: int = b) -> tuple[float, float, str]:
            ratio = ratios[SPLITS.index(split)]
            by_image = (held[split][0] + i) / max(images * ratio, 1)
            by_box = (held[split][1] + b) / max(boxes * ratio, 1) if boxes else by_image
            return IMAGE_WEIGHT * by_image + BOX_WEIGHT * by_box, rng.random(), split

        best = min(SPLITS, key=filled)
        chosen[g] = best
        held[best] = [held[best][0] + i, held[best][1] + b, held[best][2] + 1]
    if any(not x[2] for x in held.values()):
        return None
    return score({s: (x[0], x[1]) for s, x in held.items()}, ratios), chosen


def bundled(stats: DataFrame) -> DataFrame:
    """``stats`` with the ``bundle`` of each group, ``MAX_GROUPS`` at most: the largest groups alone, the rest by a hash of their names.

    What is large is told by an exact percentile of the sizes, so no list of groups meets anywhere. A group lies in one
    bundle, so it never lies in two splits; bundles are small beside the splits, and alike.
    """
    half, n = max(MAX_GROUPS // 2, 2), stats.count()
    name = F.coalesce("group", F.lit(""))
    if n <= MAX_GROUPS:
        return stats.withColumn("bundle", name)
    cut = exact_percentiles(stats, [], "images", {"cut": 1 - half / n}).first()["cut"]
    dealt = F.concat(F.lit("bundle "), F.pmod(F.xxhash64(name), F.lit(half)).cast("string"))
    return stats.withColumn("bundle", F.when(F.col("images") > cut, F.concat(F.lit("group "), name)).otherwise(dealt))


def balanced_split(stats: DataFrame, attempts: int = 300, seed: int = 42, ratios: tuple[float, ...] = RATIOS) -> DataFrame:
    """``group``, ``split`` and ``score`` of the best of many greedy assignments, tried in parallel.

    ``stats`` has ``group``, ``images``, ``boxes``: one row per group. Of more than ``MAX_GROUPS`` groups the small ones
    are assigned in bundles; fewer than three are an error. The earliest of equal scores wins.
    """
    named = materialize(bundled(stats), "bundles")
    sums = named.groupBy("bundle").agg(F.sum("images").alias("images"), F.sum("boxes").alias("boxes"))
    rows = sorted((r["bundle"], int(r["images"]), int(r["boxes"])) for r in sums.collect())  # ``MAX_GROUPS`` at most
    if len(rows) < 3:
        raise ValueError(f"the search takes three groups or more, not {len(rows)}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tried = [(n, _attempt(rows, int(n), seed, ratios)) for n in batch["id"]]
            yield pd.DataFrame([(r[0], n) for n, r in tried if r], columns=["score", "attempt"])

    spark = stats.sparkSession
    best = spark.range(attempts).repartition(min(attempts, 4 * spark.sparkContext.defaultParallelism)).mapInPandas(run, "score double, attempt long").agg(F.min(F.struct("score", "attempt")).alias("b")).first()["b"]
    if best is None:
        raise ValueError("every attempt left a split empty")
    chosen = _attempt(rows, best["attempt"], seed, ratios)[1]
    told = spark.createDataFrame([(g, s, best["score"]) for g, s in sorted(chosen.items())], "bundle string, split string, score double")
    return named.join(F.broadcast(told), "bundle").select(F.coalesce("group", F.lit("")).alias("group"), "split", "score")


def shared_between_splits(records: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """How many keys of each kind lie in both of two splits (``records`` has ``split``); zero for all is no leak."""
    keys = records.select("split", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in kinds.items()])).alias("x"))
    within = keys.select("x.kind", "x.key", "split").distinct().groupBy("kind", "key").agg(F.collect_set("split").alias("s"))
    pairs = [(a, b) for i, a in enumerate(SPLITS) for b in SPLITS[i + 1 :]]
    told = F.explode(F.array(*[F.struct(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), (F.array_contains("s", a) & F.array_contains("s", b)).cast("long").alias("both")) for a, b in pairs]))
    return within.select("kind", told.alias("p")).groupBy("kind", "p.split_a", "p.split_b").agg(F.sum("p.both").alias("n_shared"))
