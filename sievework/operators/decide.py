"""Decisions over evaluations in long form: gates, scores, winners and the calibration of the threshold.

An evaluation is a row per image and mode: ``image``, ``mode``, ``risk`` (normal or higher), the metrics or,
once gated, ``passed``, ``benefit`` and ``margin``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import Rules, all_failing, clamp, closeness_to_one
from ..shared import materialize
from .percentiles import exact_percentiles

RAW = "raw_baseline"
#: The candidate modes in order of preference, and the risk class of each.
MODES = {
    "adaptive_gamma_light": "normal", "adaptive_gamma_standard": "normal", "mild_dehaze_low": "normal", "mild_dehaze_medium": "normal",
    "white_balance_conservative": "higher", "clahe_very_mild": "higher", "bilateral_denoise_mild": "higher",
}
#: Fixed values of the rules: near ties, what higher risk must gain, and over a safe winner.
NEAR_TIE, HIGHER_EXTRA, HIGHER_OVER_SAFE = 5e-4, 0.003, 0.002
#: Fixed limits of the gate over the whole image.
GLOBAL_LIMITS = {
    "geometry_changed": ("geometry_preserved", "<", 1.0), "global_detail_loss": ("detail_retention", "<", 0.85), "global_edge_loss": ("edge_recall", "<", 0.72),
    "global_blur": ("sharpness_ratio", "<", 0.65), "global_over_sharpening": ("sharpness_ratio", ">", 3.00), "global_noise_increase": ("noise_ratio", ">", 2.00),
    "edge_explosion_or_artifacts": ("edge_density_ratio", ">", 2.50), "excessive_black_clipping": ("black_clip", ">", 0.10), "excessive_white_clipping": ("white_clip", ">", 0.10),
    "added_clipping_above_limit": ("extra_clip", ">", 0.05), "image_too_dark": ("brightness", "<", 0.06), "image_too_bright": ("brightness", ">", 0.94),
    "extreme_colour_shift": ("lab_shift", ">", 55.0), "extreme_saturation_shift": ("saturation_shift", ">", 0.25),
}
#: Fixed limits over tiles: for normal risk, for higher risk.
LOCAL_LIMITS = {
    "local_detail_loss": ("detail_p10", "<", 0.78, 0.84), "local_edge_loss": ("edge_p10", "<", 0.72, 0.78), "local_blur": ("sharpness_p10", "<", 0.72, 0.80),
    "local_over_sharpening": ("sharpness_p90", ">", 2.40, 2.00), "local_noise_increase": ("noise_p90", ">", 1.80, 1.55),
    "local_contrast_loss": ("contrast_p10", "<", 0.70, 0.78), "local_contrast_explosion": ("contrast_p90", ">", 2.20, 1.80),
}
#: Fixed limits around boxes: of any size, and of tiny ones where there are some.
REGION_LIMITS = {
    "detail_loss": ("detail", "<", 0.82, 0.88), "edge_loss": ("edge", "<", 0.76, 0.82), "blur": ("sharpness", "<", 0.80, 0.85),
    "over_sharpening": ("sharpness", ">", 2.50, 2.20), "noise_increase": ("noise", ">", 1.80, 1.60), "colour_shift": ("lab", ">", 45.0, 40.0),
}
#: What a threshold needs to be eligible, and the one to fall back on.
LEAST_PROCESSED, LEAST_RATE, DEFAULT_THRESHOLD = 10, 0.05, 0.020
#: Fixed thresholds that a calibration replays.
THRESHOLD_GRID = (0.0005, 0.001, 0.0015, 0.002, 0.003, 0.004, 0.005, 0.006, 0.008, 0.01, 0.012, 0.014, 0.016, 0.018, 0.02, 0.022, 0.025, 0.03)
#: Thresholds that one replay takes, for each image is held once for each; more are an error.
MAX_THRESHOLDS = 1000


def _broken(metric: str, side: str, limit: Column | float) -> Column:
    x = F.col(metric)
    return x.isNull() | F.isnan(x) | ((x < limit) if side == "<" else (x > limit))


def gate_rules() -> Rules:
    """All rules of the runtime gate that concern metrics which the rows have; a missing value fails."""
    rules = [(name, _broken(m, side, F.lit(limit))) for name, (m, side, limit) in GLOBAL_LIMITS.items()]
    higher = F.col("risk") == "higher"
    return rules + [(name, _broken(m, side, F.when(higher, b).otherwise(a))) for name, (m, side, a, b) in LOCAL_LIMITS.items()]


def gate(evaluations: DataFrame, rules: Rules) -> DataFrame:
    """Adds ``reasons``, every rule that fails in order, and ``passed``."""
    return evaluations.withColumn("reasons", all_failing(rules)).withColumn("passed", F.size("reasons") == 0)


def with_modes(records: DataFrame) -> DataFrame:
    """Each record with every candidate mode: its name, risk class and ``priority``, the place in the order of preference."""
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(r).alias("risk"), F.lit(i).alias("priority")) for i, (m, r) in enumerate(MODES.items())])
    return records.select("*", F.explode(modes).alias("mode_")).select("*", "mode_.*").drop("mode_")


def passed_by_image(evaluations: DataFrame) -> DataFrame:
    """Per image whether any mode passed the gate, whether all did, and whether all left the regions whole."""
    return evaluations.groupBy("image").agg(F.bool_or("passed").alias("any_passed"), F.bool_and("passed").alias("all_passed"), F.bool_and("region_passed").alias("all_regions_passed"))


def region_audit(evaluations: DataFrame) -> DataFrame:
    """Adds ``region_reasons`` and ``region_passed`` from ``boxes``, ``tiny_boxes``, ``any_*`` and ``tiny_*`` metrics.

    Without boxes that could be measured it passes; a metric that is missing breaks no rule.
    """
    measured = lambda metric, side, limit: F.col(metric).isNotNull() & _broken(metric, side, F.lit(limit))
    some = F.coalesce(F.col("boxes"), F.lit(0)) > 0
    rules = [(f"fish_roi_{k}", some & measured(f"any_{m}", side, a)) for k, (m, side, a, _) in REGION_LIMITS.items()]
    rules += [(f"tiny_fish_{k}", some & (F.col("tiny_boxes") > 0) & measured(f"tiny_{m}", side, b)) for k, (m, side, _, b) in REGION_LIMITS.items()]
    return evaluations.withColumn("region_reasons", all_failing(rules)).withColumn("region_passed", F.size("region_reasons") == 0)


def safety_margin(passed: Column) -> Column:
    """Mean of six margins in [0, 1] where the gate is passed, else 0."""
    higher = F.col("risk") == "higher"
    limit = lambda rule: F.when(higher, LOCAL_LIMITS[rule][3]).otherwise(LOCAL_LIMITS[rule][2])
    above = lambda metric, least: clamp((F.col(metric) - least) / (1 - least), 0.0, 1.0)
    parts = [
        above("detail_retention", F.lit(GLOBAL_LIMITS["global_detail_loss"][2])), above("edge_recall", F.lit(GLOBAL_LIMITS["global_edge_loss"][2])),
        above("detail_p10", limit("local_detail_loss")), above("edge_p10", limit("local_edge_loss")), closeness_to_one(F.col("sharpness_p50")),
        clamp(1 - (F.col("noise_p90") - 1) / (limit("local_noise_increase") - 1), 0.0, 1.0),
    ]
    return F.when(passed, sum(parts[1:], parts[0]) / len(parts)).otherwise(0.0)


def _best(candidates: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Per key the best candidate: within ``NEAR_TIE`` of the highest benefit, the largest margin, then mode order."""
    near = candidates.withColumn("top_", F.max("benefit").over(Window.partitionBy(*keys))).filter(F.col("benefit") >= F.col("top_") - NEAR_TIE)
    rank = F.struct((-F.col("margin")).alias("m"), F.col("priority").alias("p"), F.col("mode").alias("mode"), F.col("benefit").alias("benefit"), F.col("margin").alias("margin"))
    return near.groupBy(*keys).agg(F.min(rank).alias(name))


def winners(evaluations: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Per image and threshold the winning mode with its benefit and margin.

    ``evaluations`` has ``image``, ``mode``, ``risk``, ``priority``, ``passed``, ``benefit``, ``margin``;
    ``thresholds`` has few rows (``threshold``). Among normal modes at or above the threshold the best is
    safe, or else raw; a higher-risk mode wins only with ``HIGHER_EXTRA`` more and ``HIGHER_OVER_SAFE`` over a
    safe one. Images none of whose modes qualify stay raw, with benefit 0 and margin 1.
    """
    images = evaluations.select("image").distinct()
    grid = [r["threshold"] for r in thresholds.select("threshold").distinct().orderBy("threshold").limit(MAX_THRESHOLDS + 1).collect()]
    if len(grid) > MAX_THRESHOLDS:
        raise ValueError(f"at most {MAX_THRESHOLDS} thresholds can be replayed at once")
    each = F.explode(F.array(*[F.lit(float(t)) for t in grid])).alias("threshold")
    keys = ["image", "threshold"]
    able = evaluations.filter("passed").select("*", each).filter(F.col("benefit") >= F.col("threshold"))
    safe = _best(able.filter("risk = 'normal'"), keys, "safe")
    higher = able.filter("risk = 'higher'").filter(F.col("benefit") >= F.col("threshold") + HIGHER_EXTRA).join(safe, keys, "left")
    higher = higher.filter(F.col("safe").isNull() | (F.col("benefit") >= F.col("safe.benefit") + HIGHER_OVER_SAFE)).drop("safe")
    bold = _best(higher, keys, "bold")
    joined = images.select("image", each).join(safe, keys, "left").join(bold, keys, "left")
    over = F.col("bold").isNotNull() & (F.col("safe").isNull() | (F.col("bold.benefit") >= F.col("safe.benefit") + HIGHER_OVER_SAFE))
    won = F.when(over, F.col("bold")).otherwise(F.col("safe"))
    return joined.select(*keys, F.coalesce(won["mode"], F.lit(RAW)).alias("mode"), F.coalesce(won["benefit"], F.lit(0.0)).alias("benefit"), F.coalesce(won["margin"], F.lit(1.0)).alias("margin"))


def replay(won: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Per threshold: images, processed ones, their rate, mean, median and least benefit, and damaged ones."""
    damage = evaluations.select(F.col("image").alias("i_"), F.col("mode").alias("m_"), (~F.col("region_passed")).alias("damaged"))
    chosen = won.join(damage, (F.col("image") == F.col("i_")) & (F.col("mode") == F.col("m_")), "left")
    chosen = materialize(chosen.select("threshold", "mode", "benefit", "damaged"), "replayed")  # summed up and ordered
    processed = F.col("mode") != RAW
    gain = F.when(processed, F.col("benefit"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = chosen.groupBy("threshold").agg(
        F.count("*").alias("images"), F.count_if(processed).alias("processed"), zero(F.avg(gain)).alias("mean_benefit"),
        zero(F.min(gain)).alias("min_benefit"), F.count_if(F.col("damaged")).alias("damaged"),
    )
    medians = exact_percentiles(chosen.select("threshold", gain.alias("gain")), ["threshold"], "gain", {"median_benefit": 0.5})
    out = out.join(F.broadcast(medians), "threshold").withColumn("median_benefit", zero(F.col("median_benefit")))  # a row for each threshold, few by contract
    rate = F.col("processed") / F.col("images")
    return out.withColumn("rate", rate).withColumn("eligible", (F.col("processed") >= LEAST_PROCESSED) & (F.col("rate") >= LEAST_RATE) & (F.col("damaged") == 0))


def choose_threshold(replayed: DataFrame) -> DataFrame:
    """The lowest eligible threshold; else the lowest without damage; else the default."""
    lowest = lambda c: F.min(F.when(c, F.col("threshold")))
    one = replayed.agg(lowest(F.col("eligible")).alias("a"), lowest(F.col("damaged") == 0).alias("b"))
    how = F.when(F.col("a").isNotNull(), "eligible").when(F.col("b").isNotNull(), "undamaged").otherwise("default")
    return one.select(F.coalesce("a", "b", F.lit(DEFAULT_THRESHOLD)).alias("threshold"), how.alias("chosen_as"))


def reason_histogram(gated: DataFrame) -> DataFrame:
    """How often each reason rejects each mode."""
    return gated.select("mode", F.explode("reasons").alias("reason")).groupBy("mode", "reason").agg(F.count("*").alias("n"))


def mode_report(gated: DataFrame) -> DataFrame:
    """Per mode: passes, rejections, and the spread of the benefit."""
    sums = gated.groupBy("mode").agg(F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_rejected"), F.min("benefit").alias("benefit_min"), F.avg("benefit").alias("benefit_mean"), F.max("benefit").alias("benefit_max"))
    return sums.join(exact_percentiles(gated, ["mode"], "benefit", {"benefit_median": 0.5, "benefit_p90": 0.9}), "mode")


def winners_by_split(won: DataFrame, modes: list[str]) -> DataFrame:
    """Winners of each mode by split, zero where there are none."""
    return won.groupBy("split").pivot("mode", modes).count().na.fill(0)


def winner_distribution(won: DataFrame) -> DataFrame:
    """How many images each mode won, and their percentage; modes without any have zero."""
    total = won.agg(F.count("*").alias("n")).scalar()
    modes = won.sparkSession.createDataFrame([(m,) for m in [RAW, *MODES]], "mode string")
    counts = won.groupBy("mode").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return modes.join(F.broadcast(counts), "mode", "left").select("mode", n.alias("n"), F.when(total > 0, 100.0 * n / total).otherwise(0.0).alias("percent"))


def with_baseline(evaluations: DataFrame) -> DataFrame:
    """The evaluations with the neutral row of each image's raw baseline: passed, benefit 0, margin 1."""
    kinds = {f.name: f.dataType for f in evaluations.schema}
    fixed = {"mode": F.lit(RAW), "risk": F.lit("baseline"), "passed": F.lit(True), "benefit": F.lit(0.0), "margin": F.lit(1.0), "region_passed": F.lit(True)}
    fixed |= {c: F.array().cast(kinds[c]) for c in ("reasons", "region_reasons") if c in kinds}
    given = {c: fixed.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items() if c != "image"}
    return evaluations.unionByName(evaluations.select("image").distinct().select("image", *given.values()))


def compact(evaluations: DataFrame) -> DataFrame:
    """What a replay of thresholds needs of each evaluation; no metrics. What the rows lack is null."""
    has = lambda c, kind: F.col(c) if c in evaluations.columns else F.lit(None).cast(kind)
    return evaluations.select(
        "image", "mode", F.col("risk").alias("risk_class"), F.col("passed").alias("runtime_gate_passed"), has("reasons", "array<string>").alias("runtime_rejection_reasons"), F.col("benefit").alias("benefit_score"),
        F.col("margin").alias("safety_margin_score"), has("region_passed", "boolean").alias("offline_roi_audit_passed"), has("region_reasons", "array<string>").alias("offline_roi_reasons"),
    )


def rejection_sums(rejected: DataFrame) -> DataFrame:
    """Over all images, how often each reason stands in their maps (``rejections``)."""
    return rejected.select(F.explode("rejections").alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("n"))


def rejections(gated: DataFrame) -> DataFrame:
    """Per image, how often each reason rejected one of its modes, as a map."""
    counts = gated.select("image", F.explode("reasons").alias("reason")).groupBy("image", "reason").agg(F.count("*").alias("n"))
    return counts.groupBy("image").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("rejections"))


def status(calibration_safe: Column, damaged: Column) -> Column:
    """The status of a trial run: an unsafe calibration goes before damaged regions; else people review it."""
    return F.when(~calibration_safe, "CALIBRATION_NOT_APPROVABLE").when(damaged > 0, "DETAIL_AUDIT_FAILED").otherwise("REVIEW_REQUIRED")


def run_status(calibration_safe: bool, damaged: int) -> str:
    """The same of a finished run."""
    if not calibration_safe:
        return "CALIBRATION_NOT_APPROVABLE"
    return "DETAIL_AUDIT_FAILED" if damaged else "REVIEW_REQUIRED"
