"""The three stages on image data: prepare, calibrate, process."""

from __future__ import annotations

import hashlib
import inspect
import re
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import group_name, required_group
from ..operators import decide, kernels, pixels, split
from ..operators.certify import canonical_hash, require_policy, require_verified, valid_checkpoints, verify
from ..operators.kernels import TRANSFORMS, pixels_of
from ..operators.pixels import BENEFIT_WEIGHTS, evaluate_images, region_metrics
from ..shared import broadcast_if_small, materialize
from ..sources import filecache, runlog
from ..sources.filesink import recover
from ..sources.images import encode_png, hash_images, list_images, read_files, read_images, remove_files, write_files
from ..sources.progress import latest
from ..sources.reports import dataset_yaml, read_object, write_json, write_manifest, write_text


def prepare(records: DataFrame, attempts: int = 300, seed: int = 42) -> DataFrame:
    """Canonical records with their group and split.

    ``records``: ``path``, ``sha256``, ``boxes`` (their number) and ``sign`` (their signature). Copies go;
    equal files with different signatures stop the run; no group lies in two splits.
    """
    signs = records.groupBy("sha256").agg(F.min("path").alias("path"), F.count_distinct("sign").alias("signs"), F.count("*").alias("copies"))
    sound = F.when(F.col("signs") > 1, F.raise_error(F.concat(F.lit("equal files with different boxes: "), F.col("path")))).otherwise(F.col("path"))
    kept = records.join(signs.select(sound.alias("path"), "copies"), "path", "left_semi").withColumn("group", required_group(group_name(F.col("path"))))
    chosen = split.balanced_split(split.group_stats(kept, "group", F.col("boxes")), attempts, seed).select("group", "split")
    return kept.join(chosen, "group")


def evaluated(images: DataFrame) -> DataFrame:
    """Gated evaluations of all candidate modes of all images, with benefit and margin."""
    gated = decide.gate(evaluate_images(images), decide.gate_rules())
    return gated.withColumn("margin", decide.safety_margin(F.col("passed")))


def audited_regions(evaluations: DataFrame, images: DataFrame, boxes: DataFrame) -> DataFrame:
    """The evaluations with the audit of the regions around boxes, which only judges and never selects."""
    return decide.region_audit(evaluations.join(region_metrics(images, boxes), ["image", "mode"], "left"))


def calibrate(evaluations: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The chosen threshold; ``evaluations`` has ``region_passed`` from the audit of boxes."""
    return decide.choose_threshold(decide.replay(decide.winners(evaluations, thresholds), evaluations))


def _source_hash() -> str:
    """The hash of the code that selects: a run under other code is a run under another policy."""
    return hashlib.sha256("".join(inspect.getsource(m) for m in (decide, kernels, pixels)).encode()).hexdigest()


def policy(threshold: float) -> dict:
    """The frozen rules of a run and their fingerprint."""
    rules = {
        "threshold": threshold, "modes": decide.MODES, "global": decide.GLOBAL_LIMITS, "local": decide.LOCAL_LIMITS, "near_tie": decide.NEAR_TIE, "higher_extra": decide.HIGHER_EXTRA, "higher_over_safe": decide.HIGHER_OVER_SAFE,
        "regions": decide.REGION_LIMITS, "benefit_weights": BENEFIT_WEIGHTS, "least_processed": decide.LEAST_PROCESSED, "least_rate": decide.LEAST_RATE, "selector_source_sha256": _source_hash(),
    }
    return rules | {"policy_fingerprint_sha256": canonical_hash(rules)}


def process(images: DataFrame, won: DataFrame, folder: str, files: DataFrame | None = None) -> DataFrame:
    """Write each image as its winning mode has it; returns ``image``, ``mode``, ``name``, ``length`` and ``sha256``.

    ``won``: ``image``, ``mode`` and, if wanted, ``name`` (where the output goes below ``folder``, without its
    suffix; else the file's name). With ``files`` (``image``, ``content``) raw winners keep their file byte for byte;
    all others are lossless PNG. Names that repeat and images that cannot be decoded stop the run.
    """
    base = F.regexp_replace(F.element_at(F.split("image", "/"), -1), r"(?<=.)\.[^.]*$", "")
    won = won.select("image", "mode", (F.col("name") if "name" in won.columns else base).alias("name"))
    _once(won, "name")
    as_it_is = F.lit(files is not None) & (F.col("mode") == decide.RAW)
    kept, made = broadcast_if_small(won.filter(as_it_is)), broadcast_if_small(won.filter(~as_it_is))  # names, so that pixels stay where they are

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, h, w, data, mode, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = pixels_of(data, h, w)
                if raw is None:
                    raise ValueError(f"{key} cannot be decoded")
                out = TRANSFORMS[mode](raw) if mode in TRANSFORMS else raw
                if out.shape != raw.shape:
                    raise ValueError(f"{mode} changed the size of {key}")
                yield pa.RecordBatch.from_pylist([{"image": key, "mode": mode, "name": name + ".png", "content": encode_png(out)}])

    schema = "image string, mode string, name string, content binary"
    outputs = images.join(made, "image").select("image", "height", "width", "data", "mode", "name").mapInArrow(run, schema)
    if files is not None:
        suffix = F.regexp_extract("image", r"\.[^./]*$", 0)
        outputs = outputs.unionByName(files.join(kept, "image").select("image", "mode", F.concat("name", suffix).alias("name"), "content"))
    return write_files(outputs, folder, ["image", "mode"])


#: Columns by which a finished record is known again: its file, its label, and the policy.
MARKS = {"source_sha256": "source_sha256", "label_sha256": "label_sha256"}


def run(spark: SparkSession, records: DataFrame, root: str, out: str, threshold: float = decide.DEFAULT_THRESHOLD, reset: bool = False, take_over: bool = False, told: dict | None = None) -> DataFrame:
    """Select and write the winner of every record's image; a run that was stopped goes on where it ended.

    ``records``: ``image`` (path below ``root``), ``split``, ``group``, ``target_count``, ``width``, ``height``, ``label`` (text). Outputs go to
    ``out``/``split``/images and labels, the manifest to ``out``/manifest, batch by batch. Finished records whose files and
    labels are unchanged are kept, others are done anew; records of another policy stop the run. At the end all outputs are
    read back and compared. Returns the manifest; any failure leaves a report and is raised.

    Before the first batch ``out``/metadata tells the policy, the dataset (``told``, as its preparation had it) and the
    run. The run holds a lock: a second one on the same ``out`` is refused, unless it takes over from one that died; what
    that one had begun to write is ended or dropped.
    """
    rules, began = policy(threshold), time.time()
    with runlog.locked(spark, out, take_over) as holder:
        try:
            _begin(spark, out, rules, told or {}, {"reset": reset, **holder})
            manifest, resumed = _continued(spark, records, root, out, rules, reset)
            return _ended(spark, records, manifest, root, out, rules, resumed, began)
        except Exception as failure:
            write_json(f"{out}/reports/failure.json", {"status": "FAIL", "seconds": round(time.time() - began, 3), "error": f"{type(failure).__name__}: {failure}"[:4000]})
            raise


def _begin(spark: SparkSession, out: str, rules: dict, told: dict, run_: dict) -> None:
    """The metadata of a run, before it does anything; the keys and values of its configuration are fixed."""
    before = read_object(f"{out}/metadata/frozen_policy.json")
    if before and not run_["reset"] and before.get("policy_fingerprint_sha256") != rules["policy_fingerprint_sha256"]:
        raise ValueError("records of another policy: start anew or restore that policy")
    left = recover(spark, out)
    write_json(f"{out}/metadata/frozen_policy.json", rules)
    write_json(f"{out}/metadata/source_dataset_info.json", told)
    write_json(f"{out}/metadata/run_configuration.json", {
        "run_mode": "full", "frozen_threshold": rules["threshold"], "selector_source_sha256": rules["selector_source_sha256"], "runtime_selector_label_free": True, "annotations_used_at_runtime": False,
        "raw_image_handling": "byte_for_byte_copy", "processed_image_handling": "lossless_png", "label_handling": "byte_for_byte_copy", "geometry_changes_allowed": False, "threshold_recalibration_allowed": False,
        "batch_records": BATCH, "left_by_earlier_runs": left, **run_,
    })
    write_text(f"{out}/dataset.yaml", dataset_yaml(out, {0: "fish"}))


def _ended(spark: SparkSession, records: DataFrame, manifest: DataFrame, root: str, out: str, rules: dict, resumed: int, began: float) -> DataFrame:
    require_verified(_faults(spark, records, manifest, root, out))
    filecache.remember(spark, out, manifest.select(F.col("output_image").alias("name"), F.col("output_image_sha256").alias("sha256")), f"{out}/{VERIFIED}")
    won = manifest.select("split", F.col("selected_mode").alias("mode"))
    by_split = decide.winners_by_split(won, [decide.RAW, *decide.MODES]).orderBy("split")
    reasons = manifest.select(F.explode("rejections").alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("n")).orderBy("reason")
    write_manifest(manifest.withColumn("rejections", F.to_json("rejections")), f"{out}/manifests")
    write_json(f"{out}/reports/run.json", {
        "status": "PASS", "seconds": round(time.time() - began, 3), "resumed": resumed, "policy": rules,
        "winners_by_split": [r.asDict() for r in by_split.collect()], "rejections": {r["reason"]: r["n"] for r in reasons.collect()},
    })
    return manifest


def _once(rows: DataFrame, name: str) -> None:
    """A name that comes twice is an error."""
    if twice := rows.groupBy(name).count().filter("count > 1").limit(1).collect():
        raise ValueError(f"several images would be written to {twice[0][name]}")


def _is_file(uri: str) -> bool:
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    return fs.get_file_info(path).type != pyarrow.fs.FileType.NotFound


def remove(out: str, names: list[str] | tuple[str, ...]) -> None:
    """Removes these files and folders below ``out``, those that are there, and nothing else."""
    for name in names:
        fs, path = pyarrow.fs.FileSystem.from_uri(f"{out}/{name}")
        kind = fs.get_file_info(path).type
        if kind == pyarrow.fs.FileType.Directory:
            fs.delete_dir(path)
        elif kind == pyarrow.fs.FileType.File:
            fs.delete_file(path)


def _output_files(spark: SparkSession, out: str) -> DataFrame:
    return hash_images(spark, out).select(_output_name(F.col("path")).alias("name"), "sha256")


#: Where a run keeps the hashes of its verified outputs with their lengths and times.
VERIFIED = "metadata/verified_outputs"


def _resumed_files(spark: SparkSession, out: str) -> DataFrame:
    """The outputs there are, with hashes; those that the last whole run has verified and that no one touched are not read."""
    remembered = spark.read.parquet(f"{out}/{VERIFIED}") if _is_file(f"{out}/{VERIFIED}/_SUCCESS") else None
    return filecache.hashes(spark, out, remembered)


def _output_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+/images/[^/]+)$", 1)


#: Records that are selected, written and recorded together, about: what a stopped run has to do again. Their paths,
#: and nothing else of them, meet at the driver.
BATCH = 10_000


def _batch(spark: SparkSession, todo: DataFrame, out: str, rules: dict) -> DataFrame:
    """Selects and writes the winners of some records, and gives their progress, to be appended once all is written.

    Each image is decoded for its evaluation; only those that change are decoded once more, the others are copied.
    """
    paths = [r["image"] for r in todo.select("image").collect()]
    gated = materialize(evaluated(read_images(spark, paths)), "evaluated")
    grid = spark.createDataFrame([(float(rules["threshold"]),)], "threshold double")
    won = materialize(decide.winners(gated, grid).drop("threshold").join(todo.select("image", F.col("output").alias("name")), "image"), "won")
    changed = [r["image"] for r in won.filter(F.col("mode") != decide.RAW).select("image").collect()]
    written = process(read_images(spark, changed), won, out, read_files(spark, sorted({*paths} - {*changed})))
    labels = write_files(todo.select(F.col("label_output").alias("name"), F.coalesce("label", F.lit("")).cast("binary").alias("content"), "image"), out, ["image"])
    marked = todo.select("image", "split", F.col("group").alias("deployment"), "target_count", "width", "height", "source_sha256", "label_sha256")
    return (
        written.withColumnRenamed("mode", "selected_mode").drop("length").join(marked, "image").join(won.select("image", "benefit", "margin"), "image")
        .join(labels.select("image", F.col("name").alias("output_label"), F.col("sha256").alias("output_label_sha256")), "image")
        .join(decide.rejections(gated), "image", "left")
        .withColumn("policy_fingerprint_sha256", F.lit(rules["policy_fingerprint_sha256"])).withColumn("finished", F.current_timestamp())
    )


def _continued(spark: SparkSession, records: DataFrame, root: str, out: str, rules: dict, reset: bool) -> tuple[DataFrame, int]:
    """The manifest of all records, and how many of them an earlier run had finished."""
    place = f"{out}/manifest"
    stem = F.regexp_replace(F.element_at(F.split("image", "/"), -1), r"(?<=.)\.[^.]*$", "")
    sha = lambda c: F.sha2(F.coalesce(c, F.lit("")).cast("binary"), 256)
    files = read_files(spark, root)
    full = records.withColumn("image", F.concat(F.lit(_plain(root) + "/"), "image"))
    full = full.join(files.select("image", F.sha2("content", 256).alias("source_sha256")), "image").withColumn("label_sha256", sha(F.col("label")))
    todo, done = full, None
    if reset:
        remove(out, [r["split"] for r in records.select("split").distinct().collect()])
    if not reset and _is_file(place):
        earlier = require_policy(latest(spark.read.parquet(place), "image", ["finished"]), rules["policy_fingerprint_sha256"])
        done = materialize(valid_checkpoints(earlier, full, _resumed_files(spark, out), "image", MARKS), "resumed")
        todo = full.join(done.select("image"), "image", "left_anti")
    label_name = F.concat_ws("/", "split", F.lit("labels"), F.concat(stem, F.lit(".txt")))
    todo = todo.withColumns({"output": F.concat_ws("/", "split", F.lit("images"), stem), "label_output": label_name})
    _once(full.select(F.concat_ws("/", "split", stem).alias("output")), "output")
    if reset and _is_file(place):
        fs, path = pyarrow.fs.FileSystem.from_uri(place)
        fs.delete_dir(path)
    for part in runlog.in_batches(todo, "image", BATCH, "todo"):
        _batch(spark, part, out, rules).write.mode("append").parquet(place)
    if not _is_file(place):
        raise ValueError("there is no record with an image")
    manifest = latest(spark.read.parquet(place), "image", ["finished"]).join(full.select("image"), "image", "left_semi")
    renamed = {"source_prepared_image": "image", "output_image": "name", "winner_benefit_score": "benefit", "winner_safety_margin": "margin", "source_image_sha256": "source_sha256", "output_image_sha256": "sha256", "source_label_sha256": "label_sha256"}
    manifest = manifest.withColumn("processed", F.col("selected_mode") != decide.RAW).withColumnsRenamed({v: k for k, v in renamed.items()})
    # An image that was written anew may have another suffix than before: its earlier file goes.
    stem_of = lambda c: F.regexp_replace(c, r"\.[^./]*$", "")
    stems = manifest.select(stem_of(F.col("output_image")).alias("stem"), F.col("output_image").alias("now"))
    stale = list_images(spark, out).select(_output_name(F.col("path")).alias("name")).withColumn("stem", stem_of(F.col("name"))).join(stems, "stem").filter("name <> now")
    remove_files(stale, out)
    return manifest, 0 if done is None else done.count()


def _plain(root: str) -> str:
    """The folder as the readers name it."""
    return re.sub("^file:/+", "file:/", root).rstrip("/")


def _faults(spark: SparkSession, records: DataFrame, manifest: DataFrame, root: str, out: str) -> DataFrame:
    """(key, reason) of every record without an output, and of every output that is not as the manifest or the record has it."""
    wanted = records.select(F.concat(F.lit(_plain(root) + "/"), "image").alias("image"), "width", "height")
    got = manifest.select(F.col("source_prepared_image").alias("image"), "width", "height")
    listed = verify(wanted, got, "image", ["width", "height"])
    named = manifest.select(F.col("output_image").alias("name"), F.col("output_image_sha256").alias("sha256"), "width", "height")
    shape = read_images(spark, out).select(F.regexp_extract("image", r"([^/]+/images/[^/]+)$", 1).alias("name"), "width", "height")
    now = _output_files(spark, out).join(shape, "name", "left")
    changed = manifest.filter("source_label_sha256 <> output_label_sha256").select(F.col("output_label").alias("key"), F.lit("label differs").alias("reason"))
    changed = changed.unionByName(manifest.filter("NOT processed AND source_image_sha256 <> output_image_sha256").select(F.col("output_image").alias("key"), F.lit("raw image differs").alias("reason")))
    return listed.withColumnRenamed("image", "key").unionByName(verify(named, now, "name", ["sha256", "width", "height"]).withColumnRenamed("name", "key")).unionByName(changed)

