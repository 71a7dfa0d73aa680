"""``spark-submit -m sievework``: check, try on a few records, or process all of a prepared dataset."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import certify, decide, sampling
from .plans import curation, stages
from .sources import indexes
from .sources.images import read_texts
from .sources.reports import read_object


def arguments(given: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="sievework", description=__doc__)
    mode = p.add_mutually_exclusive_group(required=True)
    mode.add_argument("--prepare", metavar="SOURCE", help="audit and prepare an annotated source: records, labels and reports go to --out")
    mode.add_argument("--calibrate", action="store_true", help="calibrate the threshold and try the selector: its reports go to --reports")
    mode.add_argument("--preflight", action="store_true", help="check the reports and records, and stop")
    mode.add_argument("--smoke-test", type=int, metavar="N", help="process N records of each split, anew")
    mode.add_argument("--full", action="store_true", help="process all records, going on where a stopped run ended")
    p.add_argument("--reset", action="store_true", help="forget what an earlier full run has finished")
    p.add_argument("--take-over", action="store_true", help="go on in the place of a run that died and left its lock")
    p.add_argument("--records", help="Parquet table, or image index as JSON: image, label_path, label (its text), split, group, target_count, width, height")
    p.add_argument("--images", help="folder of the images, as a URI")
    p.add_argument("--reports", help="folder with trial.json, calibration.json, sampling.json and config.json, as a URI")
    p.add_argument("--out", help="folder of the outputs, as a URI")
    told = p.parse_args(given)
    needed = ["out"] if told.prepare else ["records", "images", "reports"] + ["out"] * (not told.calibrate)
    if lacking := [f"--{n}" for n in needed if getattr(told, n) is None]:
        p.error(f"{', '.join(lacking)} must be given")
    if told.smoke_test is not None and told.smoke_test < 1:
        p.error("--smoke-test takes a positive number")
    if told.reset and not told.full:
        p.error("--reset goes with --full")
    if told.take_over and not (told.full or told.smoke_test):
        p.error("--take-over goes with --full or --smoke-test")
    return told


def read_records(spark: SparkSession, path: str, images: str | None) -> DataFrame:
    """The records of a prepared dataset: a Parquet table, or its image index as JSON (a document, or a folder of several), with the labels' texts from below ``images``."""
    if not indexes.is_index(path):
        return spark.read.parquet(path)
    index = indexes.read_image_index(spark, path).withColumnsRenamed({"prepared_image": "image", "prepared_label": "label_path", "deployment": "group"})
    labels = read_texts(index.select(F.col("label_path").alias("name")), images).withColumnRenamed("text", "label")
    return index.join(labels, index["label_path"] == labels["name"], "left").drop("name")


def main(given: list[str], spark: SparkSession | None = None) -> int:
    told = arguments(given)
    spark = spark or SparkSession.builder.appName("sievework").getOrCreate()
    if told.prepare:
        stages.prepare_dataset(spark, told.prepare, told.out, copy=True)
        return 0
    records = read_records(spark, told.records, told.images)
    if told.calibrate:
        print(stages.try_out(spark, records, told.images, told.reports)["approval_status"])
        return 0
    trial, calibration, independence, config = (read_object(f"{told.reports}/{n}.json") for n in ("trial", "calibration", "sampling", "config"))
    named = records.withColumn("label", F.col("label_path")) if "label_path" in records.columns else records
    checks = certify.preflight(trial, calibration, independence, named, config | {"modes": 1 + len(decide.MODES)})
    for number, check, ok in checks:
        print(f"{number:2d} {'passed' if ok else 'FAILED'}  {check}")
    certify.require_passed(checks)
    if told.preflight:
        return 0
    about = read_object(f"{told.images}/metadata/dataset_info.json")
    if told.full:
        curation.run(spark, records, told.images, told.out, config["threshold"], told.reset, told.take_over, about)
        return 0
    known = spark.createDataFrame([(d["prepared_image"],) for d in trial.get("decisions", []) if d.get("processed_selected")], "image string")
    some = sampling.per_split_sample(records, known, told.smoke_test)
    curation.run(spark, some, told.images, f"{told.out.rstrip('/')}-smoke", config["threshold"], True, told.take_over, about)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
