"""The first two stages as whole runs: a source of annotated images is prepared, and the selector is tried and calibrated."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boxes import label_file_problem, size_counts, to_yolo
from ..functions.naming import base_name, prepared_name
from ..operators import audit, certify, decide, dedup, pixels, sampling, split
from ..shared import materialize
from ..sources import coco, indexes, reports
from ..sources.images import hash_images, read_files, read_images, read_texts, write_files
from . import curation

#: Fixed: the categories that are targets, and the one class that they become.
TARGETS, CLASS_NAME = ["fish", "small_fish"], "fish"
VERSION = "1"


def now() -> str:
    return datetime.now(UTC).isoformat()


def _counts(rows: DataFrame, key: str) -> dict:
    return {r[key]: r["n"] for r in audit.count_by(rows, key).orderBy(key).collect()}


def prepare_dataset(spark: SparkSession, source: str, out: str, targets: list[str] | None = None, attempts: int = 300, seed: int = 42, copy: bool = False) -> DataFrame:
    """Audits a source, drops copies, splits by group, and writes labels, index, metadata and reports below ``out``.

    Any fatal issue, a conflict between copies, a group or content in two splits, or a label that is not as its
    boxes leaves a report and stops the run. Images stay where they are, named by ``source_path``, unless ``copy`` is set.
    Returns the index, written as Parquet to ``out``/records: one row per prepared image with its label's text.
    """
    targets = targets or TARGETS
    if missing := coco.missing_parts(source):
        raise FileNotFoundError(f"the source has no document for {', '.join(missing)}")
    docs = materialize(coco.read_documents(spark, source), "documents")
    parts = lambda c: {"split": F.regexp_extract(c, r"([^/]+)/[^/]+$", 1), "file_name": base_name(F.col(c))}
    sizes = materialize(read_images(spark, source).select("image", "width", "height").withColumns(parts("image")), "sizes")
    items, issues = coco.audit_source(docs, sizes, targets)
    issues["total"] = sum(issues.values())
    notes = coco.audited_annotations(items)
    sound = notes.filter("problem IS NULL OR problem NOT IN ('orphan_annotation', 'unknown_category')")
    audited_at = now()
    reports.write_json(f"{out}/reports/source_audit.json", {
        "created_at_utc": audited_at, "status": "FAIL" if issues["total"] else "PASS", "fatal_issues": issues,
        "annotations_by_category": _counts(sound, "category"), "images_by_split": _counts(coco.images(docs), "split"),
    })
    if issues["total"]:
        raise ValueError(f"the source has {issues['total']} fatal issues; see reports/source_audit.json")

    hashes = hash_images(spark, source).withColumns(parts("path")).select("split", "file_name", "sha256", F.regexp_replace("path", "^file:/+", "file:/").alias("source_path"))
    is_target = F.col("category").isin(targets)
    lists = notes.filter(F.col("problem").isNull() & is_target).groupBy("split", "image_id").agg(F.collect_list("bbox").alias("boxes"))
    counted = coco.image_counts(docs, targets, notes).join(lists, ["split", "image_id"], "left").withColumn("boxes", F.coalesce("boxes", F.array().cast("array<array<double>>")))
    labelled = counted.join(coco.label_files(docs, targets, notes), ["split", "file_name"]).join(hashes, ["split", "file_name"])
    records = labelled.withColumnRenamed("split", "source_split").withColumn("path", F.concat_ws("/", "source_split", "file_name")).withColumn("sign", dedup.signature(F.col("boxes")))
    records = materialize(records, "records")
    copies = materialize(dedup.duplicate_sources(records.withColumnRenamed("sha256", "content"), "path", "content"), "copies")
    chosen = materialize(curation.prepare(records.withColumnRenamed("boxes", "bboxes").withColumn("boxes", F.size("bboxes")), attempts, seed), "chosen")
    leaks = split.shared_between_splits(chosen, {"group": F.col("group"), "content": F.col("sha256")}).agg(F.sum("n_shared")).first()[0]
    if leaks:
        raise ValueError(f"{leaks} groups or contents lie in two splits")

    name = prepared_name(F.col("source_split"), F.col("image_id"), F.col("path"))
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    index = chosen.select(
        F.concat_ws("/", "split", F.lit("images"), name).alias("image"), F.concat_ws("/", "split", F.lit("labels"), F.concat(stem, F.lit(".txt"))).alias("label_path"), "label", "split", "group",
        "source_path", "path", "source_split", F.col("image_id").alias("source_image_id"), "width", "height", "sha256", "target_count", "non_target_count", *[f"{t}_count" for t in targets], F.col("bboxes").alias("boxes"),
    ).withColumn("sizes", size_counts(F.col("boxes"), F.col("width"), F.col("height")))
    index = index.select("*", F.col("sizes.tiny").alias("tiny_count"), F.col("sizes.small").alias("small_count")).drop("sizes")
    clear_prepared(out)
    index.write.mode("overwrite").parquet(f"{out}/records")
    index = spark.read.parquet(f"{out}/records")
    materialize(write_files(index.select(F.col("label_path").alias("name"), F.col("label").cast("binary").alias("content")), out), "labels")
    if copy:
        files = read_files(spark, source).join(index.select(F.col("source_path").alias("image"), F.col("image").alias("name")), "image")
        materialize(write_files(files.select("name", "content"), out), "images")
    faults = materialize(prepared_faults(spark, index, out, copy), "faults")
    errors = faults.count()
    certify.require_verified(faults)

    stats = split.split_stats(split.group_stats(chosen.withColumn("g", F.concat_ws("|", "split", "group")), "g", F.col("target_count")).withColumn("split", F.substring_index("group", "|", 1)))
    by_split = {r["split"]: r.asDict() for r in stats.collect()}
    counters = {r["split"]: r.asDict() for r in split.split_counters(index).collect()}
    print_ = certify.fingerprint(index, ["sha256", "split", "path", "label"]).first()["fingerprint"]
    told = {"dataset_fingerprint_sha256": print_, "version": VERSION, "class_names": {0: CLASS_NAME}, "source_categories": targets, "splits": counters, "materialization": "copy" if copy else "reference"}
    sums = index.agg(F.count("*").alias("images"), F.sum("target_count").alias("boxes"), F.count_if(F.col("target_count") == 0).alias("negative"), F.sum("non_target_count").alias("others")).first()
    reports.write_text(f"{out}/dataset.yaml", reports.dataset_yaml(out, {0: CLASS_NAME}))
    reports.write_json(f"{out}/metadata/dataset_info.json", {
        **told, "preparation_version": VERSION, "prepared_at_utc": now(), "source_root": source, "prepared_root": out, "final_classes": {"0": CLASS_NAME}, "source_target_mapping": dict.fromkeys(targets, CLASS_NAME),
        "split_seed": seed, "requested_split_ratios": dict(zip(split.SPLITS, split.RATIOS, strict=True)), "images": sums["images"], "target_boxes": sums["boxes"], "negative_images": sums["negative"], "non_target_annotations": sums["others"],
    })
    reports.write_json(f"{out}/metadata/dataset_provenance.json", {
        "source_root": source, "audited_at_utc": audited_at, "preparation_version": VERSION, "target_categories": sorted(targets), "final_class": CLASS_NAME, "split_seed": seed, "split_ratios": dict(zip(split.SPLITS, split.RATIOS, strict=True)),
    })
    _write_indexes(notes, index, targets, out)
    gone = {"groups_of_copies": copies.count(), "copies_dropped": copies.agg(F.coalesce(F.sum("duplicates"), F.lit(0))).first()[0]}
    score = split.score({k: (v["images"], v["boxes"]) for k, v in by_split.items()}, split.RATIOS)
    reports.write_json(f"{out}/reports/preparation_report.json", {"status": "PASS", "created_at_utc": now(), "verification": {"error_count": errors, "images": sums["images"]}, "copies": gone, "split": {"seed": seed, "search_attempts": attempts, "score": score, "stats": by_split}, **told})
    return index


#: What a preparation writes below its folder besides the folders of the splits; the names are fixed.
PREPARED = ("records", "metadata", "reports/preparation_report.json", "dataset.yaml")


def clear_prepared(out: str) -> None:
    """Removes what an earlier preparation has written, and nothing else, so that no label or image of it stays beside new ones."""
    curation.remove(out, [*(f"{s}/{kind}" for s in split.SPLITS for kind in ("images", "labels")), *PREPARED])


def prepared_faults(spark: SparkSession, index: DataFrame, out: str, copied: bool) -> DataFrame:
    """(key, reason) of whatever of a prepared dataset is not as its index has it; empty if all is right.

    Labels are read back and held against the index and their own rules. Images (those in ``out`` if they were copied,
    else the sources) are read back for hash, decoded for size, and none may be missing or extra. An empty label file
    that is too many is not seen: Spark's listings leave empty files out.
    """
    text = index.withColumn("problem", label_file_problem(F.col("label"), F.col("target_count"))).filter("problem IS NOT NULL").select(F.col("image").alias("key"), F.concat(F.lit("label: "), "problem").alias("reason"))
    found = read_texts(index.select(F.col("label_path").alias("name")), out).filter("text IS NOT NULL").select(F.col("name").alias("label_path"), F.col("text").alias("label"))
    wrong = certify.verify(index, found, "label_path", ["label"]).withColumnRenamed("label_path", "key")
    there = [f"{out}/{s}/labels" for s in split.SPLITS if curation._is_file(f"{out}/{s}/labels")]
    if there:
        labels = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(there)
        more = labels.select(F.regexp_extract("path", r"([^/]+/labels/[^/]+)$", 1).alias("label_path")).join(index, "label_path", "left_anti")
        wrong = wrong.unionByName(more.select(F.col("label_path").alias("key"), F.lit("extra").alias("reason")))
    root = [f"{out}/{s}/images" for s in split.SPLITS if curation._is_file(f"{out}/{s}/images")] if copied else sorted({r["p"] for r in index.select(F.regexp_extract("source_path", "^(.*)/[^/]+$", 1).alias("p")).distinct().collect()})  # a folder for each split
    name = F.regexp_extract("image", r"([^/]+/images/[^/]+)$", 1) if copied else F.col("image")
    hashes = read_files(spark, root).select(name.alias("key"), F.sha2("content", 256).alias("sha256"))
    sizes = read_images(spark, root).select(name.alias("key"), "width", "height")
    wanted = index.withColumn("key", F.col("image") if copied else F.col("source_path"))
    actual = hashes.join(sizes, "key", "left")
    if not copied:  # copies that were dropped stay in the source
        actual = actual.join(wanted.select("key"), "key", "left_semi")
    return text.unionByName(wrong).unionByName(certify.verify(wanted, actual, "key", ["sha256", "width", "height"]))


def _write_indexes(notes: DataFrame, index: DataFrame, targets: list[str], out: str) -> None:
    """The indexes of the prepared dataset, its images and their annotations, as JSON; the names of fields are fixed."""
    images = index.select(
        F.col("image").alias("prepared_image"), F.col("label_path").alias("prepared_label"), "split", F.col("path").alias("source_relative_path"), "source_split", "source_image_id", "width", "height",
        F.col("group").alias("deployment"), "sha256", "target_count", *[f"{t}_count" for t in targets], "non_target_count",
    )
    indexes.write_image_index(images, f"{out}/metadata/image_index")
    sound = notes.filter(F.col("problem").isNull() & F.col("category").isin(targets)).withColumnsRenamed({"split": "source_split", "image_id": "source_image_id"}).select("source_split", "source_image_id", "annotation_id", "category", "bbox")
    note = F.struct(
        F.col("annotation_id").alias("source_annotation_id"), F.lit(0).alias("class_id"), F.lit(CLASS_NAME).alias("class_name"), F.col("category").alias("source_category"), F.col("bbox").alias("bbox_xywh"),
        to_yolo(F.col("bbox"), F.col("width"), F.col("height")).alias("bbox_yolo"),
    )
    joined = index.select("image", "source_split", "source_image_id", "width", "height").join(sound, ["source_split", "source_image_id"], "left")
    lists = joined.groupBy("image").agg(F.array_sort(F.collect_list(F.when(F.col("annotation_id").isNotNull(), note))).alias("annotations"))
    indexes.write_annotation_index(lists, f"{out}/metadata/annotation_index")


#: What a trial writes below its folder; the names are fixed.
TRIED = ("decisions", "sampling.json", "calibration.json", "trial.json", "policy_candidate.json")


def _boxes(records: DataFrame) -> DataFrame:
    return records.select("image", F.explode("boxes").alias("bbox"))


def try_out(spark: SparkSession, records: DataFrame, root: str, out: str, thresholds: tuple[float, ...] = decide.THRESHOLD_GRID, version: str = VERSION, **sizes: int) -> dict:
    """Calibrates the threshold on training images and tries the selector on others; writes the reports that a full run checks.

    ``records`` is the index of a prepared dataset and ``root`` the folder below which its images lie. Only training
    records are used. No label takes part in a selection: boxes only judge winners. ``sizes`` are those of
    ``calibration_sample``. Returns the policy candidate, which people have to review.
    """
    curation.remove(out, TRIED)
    train = records.filter("split = 'train'")
    uri = lambda c: F.concat(F.lit(curation._plain(root) + "/"), c)
    pixels_of = lambda rows: read_images(spark, [r["p"] for r in rows.select(uri(F.col("image")).alias("p")).collect()])  # a sample's paths

    def profile(pool: DataFrame) -> DataFrame:
        pool = materialize(pool.withColumn("image_", F.col("image")).withColumn("image", uri(F.col("image"))).drop("tiny_count", "small_count"), "pool")
        seen = pixels.profile_records(pool, pixels.profile_images(pixels_of(pool.select(F.col("image_").alias("image")))))
        return materialize(seen.drop("image").withColumnRenamed("image_", "image"), "profiles")

    trial = materialize(sampling.trial_sample(train, profile), "trial")
    chosen = materialize(sampling.calibration_sample(train, trial, **sizes), "calibration")
    first = trial.join(train.select("image", "group"), "image")
    apart = sampling.independence(first, chosen, "image", "group", sizes.get("cap", sampling.GROUP_CAP)).first()
    groups = lambda rows: rows.select("group").distinct().count()
    reports.write_json(f"{out}/sampling.json", {
        "policy_version": version, "status": "PASS" if apart["independent"] else "FAIL", "created_at_utc": now(),
        "policy": {"smoke_deployments_excluded_from_calibration": True, "group_aware_round_robin": True, "positive_and_negative_share_deployment_cap": True, "maximum_calibration_images_per_deployment": sizes.get("cap", sampling.GROUP_CAP)},
        "counts": {"smoke_images": trial.count(), "calibration_images": chosen.count(), "smoke_deployments": groups(first), "calibration_deployments": groups(chosen)},
        "checks": {"image_overlap_count": apart["shared_keys"], "image_overlap_passed": apart["shared_keys"] == 0, "image_overlap": [], "deployment_overlap_count": apart["shared_groups"], "deployment_overlap_passed": apart["shared_groups"] == 0},
    })
    if not apart["independent"]:
        raise ValueError("the samples are not independent; see sampling.json")

    def audited(sample: DataFrame) -> DataFrame:
        rows = train.join(sample.select("image"), "image", "left_semi")
        seen = pixels_of(rows)
        boxes = _boxes(rows.withColumn("image", uri(F.col("image"))))
        return materialize(curation.audited_regions(curation.evaluated(seen), seen, boxes), "audited")

    tried = audited(chosen)
    grid = spark.createDataFrame([(float(t),) for t in thresholds], "threshold double")
    replayed = materialize(decide.replay(decide.winners(tried, grid), tried), "replay")
    choice = decide.choose_threshold(replayed).first()
    threshold, safe = choice["threshold"], choice["chosen_as"] == "eligible"
    analysis = [{"threshold": r["threshold"], "processed": r["processed"], "processed_rate": r["rate"], "mean_benefit": r["mean_benefit"], "median_benefit": r["median_benefit"], "minimum_benefit": r["min_benefit"], "roi_unsafe_selected": r["damaged"], "eligible_for_selection": r["eligible"]} for r in replayed.orderBy("threshold").collect()]
    reports.write_json(f"{out}/calibration.json", {
        "policy_version": version, "created_at_utc": now(), "selected_threshold": threshold, "chosen_as": choice["chosen_as"], "calibration_safe": safe, "threshold_analysis": analysis, "runtime_selector": "label_free",
        "annotations_used_for_runtime_selection": False, "class_labels_used_for_threshold_reward": False, "positive_images_rewarded": False, "negative_images_penalized": False,
        "modes": [r.asDict() for r in decide.mode_report(tried).orderBy("mode").collect()], "reasons": [r.asDict() for r in decide.reason_histogram(tried).orderBy("mode", "reason").collect()],
    })

    shown = audited(trial)
    one = spark.createDataFrame([(float(threshold),)], "threshold double")
    won = materialize(decide.winners(shown, one).drop("threshold"), "trial-winners")
    damaged = won.join(shown.filter(~F.col("region_passed")).select("image", "mode"), ["image", "mode"], "left_semi").count()
    status = decide.run_status(safe, damaged)
    risk = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for m, r in decide.MODES.items() for x in (m, r)]), F.col("mode")), F.lit("baseline"))
    told = trial.join(train, "image").withColumn("path_", uri(F.col("image"))).join(won.withColumnsRenamed({"image": "path_"}), "path_")
    decisions = told.select(
        F.row_number().over(sampling.by_key("image")).alias("sample_number"), F.when(F.col("target_count") > 0, "positive").otherwise("negative").alias("sample_type"), F.col("reason").alias("selection_reason"),
        F.col("image").alias("prepared_image"), "target_count", "tiny_count", "small_count", (F.col("target_count") - F.col("tiny_count") - F.col("small_count")).alias("medium_large_count"),
        F.col("mode").alias("winner_mode"), risk.alias("winner_risk"), F.col("benefit").alias("winner_benefit_score"), F.col("margin").alias("winner_safety_margin"), (F.col("mode") != decide.RAW).alias("processed_selected"),
    )
    decisions = materialize(decisions, "decisions")
    reports.write_decisions(decisions, f"{out}/decisions")
    reports.write_json(f"{out}/trial.json", {
        "policy_version": version, "status": status, "created_at_utc": now(), "calibrated_minimum_improvement": threshold, "runtime_selector_label_free": True, "winner_roi_audit_failures": damaged,
        "winners": {r["mode"]: r["n"] for r in decide.winner_distribution(won).collect()}, "decisions": [{"prepared_image": r["prepared_image"], "winner_mode": r["winner_mode"], "processed_selected": r["processed_selected"]} for r in decisions.collect()],
    })
    candidate = {"policy_version": version, "approval_status": "REVIEW_REQUIRED" if safe else "CALIBRATION_NOT_APPROVABLE", "score_model": "benefit_only_after_safety_gate", "benefit_weights": pixels.BENEFIT_WEIGHTS, "calibration": {"scope": "train_only", "sample_count": chosen.count(), "calibration_safe": safe, "threshold_grid": list(thresholds)}, **curation.policy(threshold)}
    reports.write_json(f"{out}/policy_candidate.json", candidate | {"created_at_utc": now()})
    return candidate
