"""Samplers: capped by group, evenly spaced, at random by hash, and checks of their independence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..shared import materialize


def by_key(key: str) -> WindowSpec:
    """The order of a sample by its key, for numbers; a sample is a few hundred rows at most."""
    return Window.partitionBy(F.lit(0)).orderBy(key)


def random_key(seed: int | str, key: Column) -> Column:
    """A reproducible random order: the MD5 of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")).cast("binary"))


def capped_by_group(records: DataFrame, group: str, key: str, cap: int, n: int, seed: int | str, used: DataFrame | None = None) -> DataFrame:
    """At most ``n`` records, turn by turn over the groups and at most ``cap`` of each.

    ``used`` (``group``, ``used``) tells how much of each group's cap earlier strata have taken. Within a
    group the order is random by seed. Spark keeps only ``cap`` rows of a group before it shuffles.
    """
    within = Window.partitionBy(group).orderBy(random_key(seed, F.col(key)), key)
    ranked = records.withColumn("turn", F.row_number().over(within)).filter(F.col("turn") <= cap)
    if used is not None:
        taken = used.select(F.col("group").alias("used_group"), "used")
        ranked = ranked.join(taken, F.col(group) == F.col("used_group"), "left").filter(F.col("turn") + F.coalesce("used", F.lit(0)) <= cap).drop("used_group", "used")
    return ranked.orderBy("turn", random_key(seed, F.col(group)), key).limit(n)


def random_fill(records: DataFrame, chosen: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """``n`` further records that are not among ``chosen``."""
    return records.join(chosen.select(key), key, "left_anti").orderBy(random_key(seed, F.col(key)), key).limit(n)


def evenly_spaced(records: DataFrame, key: str, k: int) -> DataFrame:
    """``k`` records at equal distances in the order of ``key``, which is unique: one is the middle, ``k`` or fewer are all.

    Places are counted per range of keys, so the order never meets in one task: only the wanted ranks are
    looked up within their ranges. The keys with their places are written once, for both steps must see
    the same ranges.
    """
    n = records.count()
    if k <= 0 or k >= n:
        return records if k > 0 else records.limit(0)
    wanted = [n // 2] if k == 1 else [round(i * (n - 1) / (k - 1)) for i in range(k)]
    placed = records.select(key).orderBy(key).select(F.col(key).alias("key_"), F.spark_partition_id().alias("part_"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row_"))
    placed = materialize(placed, "even")
    sizes = {r["part_"]: r["n"] for r in placed.groupBy("part_").agg(F.count("*").alias("n")).collect()}
    places, before = [], 0
    for part in sorted(sizes):
        places += [(part, i - before) for i in wanted if before <= i < before + sizes[part]]
        before += sizes[part]
    picks = records.sparkSession.createDataFrame(places, "part_ int, row_ long")
    keys = placed.join(F.broadcast(picks), ["part_", "row_"], "left_semi").select("key_")
    return records.join(F.broadcast(keys), F.col(key) == F.col("key_"), "left_semi")  # k keys


def independence(a: DataFrame, b: DataFrame, key: str, group: str, cap: int) -> DataFrame:
    """One row: keys and groups in both samples, most of one group in ``b``, and whether all is in order."""
    shared = lambda c: a.select(c).distinct().intersect(b.select(c).distinct()).agg(F.count("*").alias("n")).scalar()
    most = b.groupBy(group).count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("n")).scalar()
    one = a.sparkSession.range(1).select(shared(key).alias("shared_keys"), shared(group).alias("shared_groups"), most.alias("most_of_a_group"))
    return one.withColumn("independent", (F.col("shared_keys") == 0) & (F.col("shared_groups") == 0) & (F.col("most_of_a_group") <= cap))


#: Fixed values of the trial sample: records profiled and taken, and the rankings that each pick one record
#: not yet taken (reason, column, whether the highest comes first).
POSITIVE_POOL, NEGATIVE_POOL, POSITIVES, NEGATIVES = 400, 200, 14, 6
POSITIVE_RANKS = (
    ("tiny_fish_heavy", "tiny_count", True), ("small_fish_heavy", "small_count", True), ("dark_scene", "brightness", False), ("bright_scene", "brightness", True),
    ("low_contrast_scene", "contrast", False), ("high_contrast_scene", "contrast", True), ("soft_scene", "sharpness", False), ("high_detail_scene", "sharpness", True),
    ("strong_colour_cast", "colour_cast", True), ("weak_colour_cast", "colour_cast", False), ("many_fish", "target_count", True),
)
NEGATIVE_RANKS = (("negative_dark_scene", "brightness", False), ("negative_low_contrast", "contrast", False), ("negative_soft_scene", "sharpness", False), ("negative_strong_colour_cast", "colour_cast", True))
#: Fixed values of the calibration sample: positives and negatives, those of them with tiny or small boxes, and the cap of a group.
CALIBRATION_POSITIVES, CALIBRATION_NEGATIVES, WITH_TINY, WITH_SMALL, GROUP_CAP = 150, 50, 60, 45, 6
TRIAL_SEED, CALIBRATION_SEED = 42, 314159


def random_pool(records: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """``n`` records at random: the pool that is profiled."""
    return records.orderBy(random_key(seed, F.col(key)), key).limit(n)


def ranked_sample(pool: DataFrame, key: str, ranks: tuple, n: int, seed: int | str, fill: str) -> DataFrame:
    """``key`` and ``reason`` of ``n`` records: the first not yet taken of each ranking, then others at random.

    ``pool`` has been cut to a few hundred records before it was profiled; its measures meet at the driver.
    """
    columns = list(dict.fromkeys(c for _, c, _ in ranks))
    rows = pool.select(key, random_key(seed, F.col(key)).alias("random_"), *columns).orderBy("random_", key).limit(POSITIVE_POOL + 1).collect()
    if len(rows) > POSITIVE_POOL:
        raise ValueError(f"a pool has at most {POSITIVE_POOL} records")
    taken: dict = {}
    for reason, column, highest in ranks:
        free = [r for r in rows if r[key] not in taken and r[column] is not None]
        if free:
            taken[(max if highest else min)(free, key=lambda r, c=column: r[c])[key]] = reason
    for r in rows:
        if len(taken) < n:
            taken.setdefault(r[key], fill)
    kind = pool.schema[key].dataType.simpleString()
    return pool.sparkSession.createDataFrame(list(taken.items())[:n], f"{key} {kind}, reason string")


def trial_sample(records: DataFrame, profile, key: str = "image", seed: int = TRIAL_SEED) -> DataFrame:
    """``key`` and ``reason`` of the trial images: most telling positives and negatives, filled up at random.

    ``records`` has ``key`` and ``target_count``; ``profile`` adds the ranked measures to a pool of them, so only
    the pools are decoded.
    """
    positive, negative = records.filter("target_count > 0"), records.filter("target_count = 0")
    a = ranked_sample(profile(random_pool(positive, key, POSITIVE_POOL, seed)), key, POSITIVE_RANKS, POSITIVES, seed, "diverse_positive_random")
    b = ranked_sample(profile(random_pool(negative, key, NEGATIVE_POOL, seed)), key, NEGATIVE_RANKS, NEGATIVES, seed, "diverse_negative_random")
    return a.unionByName(b)


def calibration_sample(records: DataFrame, trial: DataFrame, key: str = "image", group: str = "group", seed: int = CALIBRATION_SEED, positives: int = CALIBRATION_POSITIVES, negatives: int = CALIBRATION_NEGATIVES, with_tiny: int = WITH_TINY, with_small: int = WITH_SMALL, cap: int = GROUP_CAP) -> DataFrame:
    """``key``, ``group`` and ``stratum`` of the calibration records; none is of a group of the trial (``trial`` has ``key``).

    Four strata in turn share one cap for each group: positives with tiny boxes, with small and no tiny ones,
    any positives up to their number, negatives. ``records``: key, group, ``target_count``, ``tiny_count``,
    ``small_count``. Too few records are an error. Each stratum is written once, a few hundred rows at most.
    """
    held = records.join(trial.select(key), key, "left_semi").select(group).distinct()
    free = records.join(held, group, "left_anti")
    chosen, n_positive = None, 0
    is_positive, tiny, small = F.col("target_count") > 0, F.coalesce("tiny_count", F.lit(0)), F.coalesce("small_count", F.lit(0))
    strata = (
        ("tiny", is_positive & (tiny > 0), lambda: min(with_tiny, positives)),
        ("small", is_positive & (tiny == 0) & (small > 0), lambda: min(with_small, positives - n_positive)),
        ("positive", is_positive, lambda: positives - n_positive),
        ("negative", ~is_positive, lambda: negatives),
    )
    for name, condition, wanted in strata:
        rest, used = free.filter(condition), None
        if chosen is not None:
            rest = rest.join(chosen.select(key), key, "left_anti")
            used = chosen.groupBy(F.col(group).alias("group")).agg(F.count("*").alias("used"))
        picked = capped_by_group(rest, group, key, cap, max(wanted(), 0), f"{seed}-{name}", used)
        picked = materialize(picked.select(key, group, F.lit(name).alias("stratum")), f"calibration-{name}")
        n = picked.count()
        n_positive += n if name != "negative" else 0
        if (name == "positive" and n_positive != positives) or (name == "negative" and n != negatives):
            raise ValueError(f"only {n_positive if name == 'positive' else n} {name} calibration records are to be had under the cap")
        chosen = picked if chosen is None else chosen.unionByName(picked)
    return chosen


def per_split_sample(records: DataFrame, known: DataFrame, n: int, key: str = "image", splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """``n`` evenly spaced records of each split; the first known processed training record replaces the last training pick, if it is not one."""
    picks = [evenly_spaced(records.filter(F.col("split") == s), key, n) for s in splits]
    one = known.select(key).join(records.filter(F.col("split") == splits[0]), key).select(records.columns).orderBy(key).limit(1)
    if n > 0 and (first := one.first()) is not None and picks[0].filter(F.col(key) == first[key]).isEmpty():
        last = picks[0].agg(F.max(key)).first()[0]
        picks[0] = picks[0].filter(F.col(key) != last).unionByName(one)
    out = picks[0]
    for p in picks[1:]:
        out = out.unionByName(p)
    return out
