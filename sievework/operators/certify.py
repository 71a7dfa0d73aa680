"""Fingerprints, resumption and verification of written outputs."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_hash(value: object, ascii_only: bool = False) -> str:
    """SHA-256 of a small object as JSON with sorted keys and no spaces."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only).encode()).hexdigest()


def fingerprint(records: DataFrame, columns: list[str]) -> DataFrame:
    """One row that changes with any record: a hash of 256 hashes, each over one bucket's sorted records.

    Records are hashed where they are; equal records count each. Only the hashes of a bucket's groups of
    records meet, 65,536 of them at most over all, so no task or driver holds all records.
    """
    row = F.sha2(F.to_json(F.struct(*columns)).cast("binary"), 256)
    counted = records.select(row.alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    # Sums of parts of the hashes do not depend on the order and are taken map-side.
    parts = [F.sum(F.conv(F.substring("h", 1 + 12 * i, 12), 16, 10).cast("decimal(20,0)") * F.col("n")).alias(f"s{i}") for i in range(5)]
    groups = counted.groupBy(F.substring("h", 1, 4).alias("g")).agg(F.sum("n").alias("n"), *parts)
    joined = groups.select(F.substring("g", 1, 2).alias("b"), F.sha2(F.concat_ws("|", "g", "n", *[f"s{i}" for i in range(5)]).cast("binary"), 256).alias("h"), "n")
    buckets = joined.groupBy("b").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "").cast("binary"), 256).alias("h"), F.sum("n").alias("n"))
    return buckets.agg(F.sum("n").alias("records"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "").cast("binary"), 256).alias("fingerprint"))


def resume_states(wanted: DataFrame, done: DataFrame, key: str, mark: str) -> DataFrame:
    """``key`` and ``state``: resumed where the mark is unchanged, reprocessed where it differs, else new."""
    before = done.select(F.col(key).alias("key_"), F.col(mark).alias("mark_"))
    state = F.when(F.col("key_").isNull(), "new").when(F.col(mark).eqNullSafe(F.col("mark_")), "resumed").otherwise("reprocessed")
    return wanted.join(before, F.col(key) == F.col("key_"), "left").select(key, state.alias("state"))


def require_policy(done: DataFrame, policy: str) -> DataFrame:
    """The records, all of which must be of the policy: another one aborts the run."""
    told = F.raise_error(F.lit("records of another policy: start anew or restore that policy"))
    return done.withColumn("policy_fingerprint_sha256", F.when(F.col("policy_fingerprint_sha256") == policy, F.col("policy_fingerprint_sha256")).otherwise(told))


def verify(expected: DataFrame, actual: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A row per fault: (key, reason), missing, extra, or a column that differs. Empty if all is right."""
    e = expected.select(F.col(key), *[F.col(c).alias(f"e_{c}") for c in columns]).withColumn("in_e", F.lit(True))
    a = actual.select(F.col(key), *[F.col(c).alias(f"a_{c}") for c in columns]).withColumn("in_a", F.lit(True))
    both = F.col("in_e").isNotNull() & F.col("in_a").isNotNull()
    reasons = F.array_compact(F.array(F.when(F.col("in_a").isNull(), "missing"), F.when(F.col("in_e").isNull(), "extra"), *[F.when(both & ~F.col(f"e_{c}").eqNullSafe(F.col(f"a_{c}")), f"{c} differs") for c in columns]))
    return e.join(a, key, "full").select(key, F.explode(reasons).alias("reason"))


def report_passed(report: dict) -> bool:
    """Whether a report says that its checks passed, by its status or by ``passed``."""
    return str(report.get("status", "")).strip().upper() in ("PASS", "PASSED", "CERTIFIED") or report.get("passed") is True


def close(x: object, expected: float, tolerance: float = 1e-12) -> bool:
    try:
        return abs(float(x) - expected) <= tolerance
    except (TypeError, ValueError):
        return False


def preflight(trial: dict, calibration: dict, sampling: dict, records: DataFrame, config: dict) -> list[tuple[int, str, bool]]:
    """(number, check, passed) of all checks before a full run, in their order; what is missing has not passed.

    ``config`` holds what the reports must agree with: ``policy_version``, ``threshold``, ``modes`` (their
    number), ``cap``, the numbers of ``trial_images``, ``calibration_images``, ``trial_groups`` and
    ``calibration_groups``, and ``splits``, the records of each. ``records``: ``image``, ``label``, ``split``.
    """
    section = lambda name: x if isinstance(x := sampling.get(name), dict) else {}
    how, counts, checks = section("policy"), section("counts"), section("checks")
    rows = calibration.get("threshold_analysis")
    rows = [r for r in rows if isinstance(r, dict) and close(r.get("threshold"), config["threshold"])] if isinstance(rows, list) else []
    row = rows[0] if len(rows) == 1 else {}
    version = config["policy_version"]
    told = records.groupBy("split").agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce("image", F.lit("")).startswith(F.concat(F.col("split"), F.lit("/images/")))).alias("images"),
        F.count_if(F.coalesce("label", F.lit("")).startswith(F.concat(F.col("split"), F.lit("/labels/")))).alias("labels"),
    ).collect()  # a row per split
    repeated = lambda c: not records.groupBy(c).count().filter("count > 1").isEmpty()
    found = [
        (1, "selector version", config.get("selector_version", version) == version),
        (2, "number of modes", config["modes"] == config.get("expected_modes", 8)),
        (3, "reports are objects", all(isinstance(r, dict) and r for r in (trial, calibration, sampling))),
        (4, "policy versions of the reports", all(r.get("policy_version") == version for r in (trial, calibration, sampling))),
        (5, "threshold of the reports", close(trial.get("calibrated_minimum_improvement"), config["threshold"]) and close(calibration.get("selected_threshold"), config["threshold"])),
        (6, "selection without labels", trial.get("runtime_selector_label_free") is True and calibration.get("runtime_selector") == "label_free" and calibration.get("annotations_used_for_runtime_selection") is False),
        (7, "threshold neutral to classes", all(calibration.get(k) is False for k in ("class_labels_used_for_threshold_reward", "positive_images_rewarded", "negative_images_penalized"))),
        (8, "calibration is safe", calibration.get("calibration_safe") is True and close(row.get("roi_unsafe_selected"), 0) and row.get("eligible_for_selection") is True),
        (9, "no damaged region among the trial's winners", close(trial.get("winner_roi_audit_failures"), 0)),
        (10, "samples are independent", report_passed(sampling) and all(how.get(k) is True for k in ("smoke_deployments_excluded_from_calibration", "group_aware_round_robin", "positive_and_negative_share_deployment_cap"))
            and all(close(checks.get(f"{k}_overlap_count"), 0) and checks.get(f"{k}_overlap_passed") is True and not checks.get(f"{k}_overlap") for k in ("image", "deployment"))
            and close(how.get("maximum_calibration_images_per_deployment"), config["cap"])),
        (11, "sizes of the samples", all(close(counts.get(name), config[key]) for name, key in (("smoke_images", "trial_images"), ("calibration_images", "calibration_images"), ("smoke_deployments", "trial_groups"), ("calibration_deployments", "calibration_groups")) if key in config)),
        (12, "records are whole and unique", bool(told) and all(r["n"] == r["images"] == r["labels"] for r in told) and not repeated("image") and not repeated("label")),
        (13, "records of each split", {r["split"]: r["n"] for r in told} == config["splits"]),
    ]
    return [(n, check, bool(ok)) for n, check, ok in found]


def require_passed(checks: list[tuple[int, str, bool]]) -> None:
    """The first check that has not passed stops the run."""
    for number, check, ok in checks:
        if not ok:
            raise RuntimeError(f"check {number} has not passed: {check}")


def valid_checkpoints(done: DataFrame, sources: DataFrame, outputs: DataFrame, key: str, marks: dict[str, str], output: str = "name") -> DataFrame:
    """The records of an earlier run that still hold.

    ``sources`` (``key`` and a column for each of ``marks``' values) and ``outputs`` (``output``, ``sha256``) tell how
    the files are now: every mark of the record must equal its source's, and its ``sha256`` its output's.
    """
    now = sources.select(F.col(key), *[F.col(c).alias(f"now_{c}") for c in marks.values()])
    files = outputs.select(F.col(output), F.col("sha256").alias("now_sha256"))
    same = F.col("sha256") == F.col("now_sha256")
    for mark, c in marks.items():
        same = same & (F.col(mark) == F.col(f"now_{c}"))
    return done.join(now, key).join(files, output).filter(same).select(done.columns)


def require_verified(faults: DataFrame) -> None:
    """Any fault stops the run; the first ten are told."""
    first = faults.orderBy(*faults.columns).limit(10).collect()
    if first:
        raise RuntimeError("the outputs are not as they should be: " + "; ".join(" ".join(map(str, r)) for r in first))
