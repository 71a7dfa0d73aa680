"""Annotation documents: reading, auditing and label files."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boxes import box_problem, label_line, to_yolo
from ..operators.audit import written_and_counted
from . import bigjson

SPLITS = ("train", "valid", "test")
FILE = "_annotations.coco.json"
#: The members of a document that are read, and the fields of their items.
ITEMS = {
    "categories": "id bigint, name string", "images": "id bigint, file_name string, width int, height int",
    "annotations": "id bigint, image_id bigint, category_id bigint, bbox array<double>",
}


def read_documents(spark: SparkSession, root: str, chunk: int = bigjson.CHUNK) -> DataFrame:
    """A row for each item of the splits' documents: ``split`` and one of ``categories``, ``images`` and ``annotations``, the others null.

    A split without a document is an error, as is a damaged one. Several tasks read a large document.
    """
    items = bigjson.json_items(spark, [f"{root}/{s}/{FILE}" for s in SPLITS], 2, chunk).filter(F.col("key").isin(*ITEMS))
    split = F.element_at(F.split("file", "/"), -2).alias("split")
    return items.select(split, *[F.when(F.col("key") == k, F.from_json("text", fields, {"mode": "FAILFAST"})).alias(k) for k, fields in ITEMS.items()])


def missing_parts(root: str) -> list[str]:
    """Splits without a folder or a document; none if the layout is whole. Reading stops at the first of them."""
    fs, path = pa.fs.FileSystem.from_uri(root)
    found = {i.path: i.type for s in SPLITS for i in fs.get_file_info([f"{path}/{s}", f"{path}/{s}/{FILE}"])}
    return [s for s in SPLITS if found[f"{path}/{s}"] != pa.fs.FileType.Directory or found[f"{path}/{s}/{FILE}"] != pa.fs.FileType.File]


def images(docs: DataFrame) -> DataFrame:
    return docs.select("split", F.col("images").alias("i")).filter("i IS NOT NULL").select("split", F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height")


def categories(docs: DataFrame) -> DataFrame:
    return docs.select("split", F.col("categories").alias("c")).filter("c IS NOT NULL").select("split", F.col("c.id").alias("category_id"), F.lower(F.trim("c.name")).alias("category"))


def annotations(docs: DataFrame) -> DataFrame:
    return docs.select("split", F.col("annotations").alias("a")).filter("a IS NOT NULL").select("split", F.col("a.id").alias("annotation_id"), "a.image_id", "a.category_id", "a.bbox")


def audited(docs: DataFrame) -> DataFrame:
    """Annotations with ``category``, their image's size and ``problem``: the first that applies, or null.

    An annotation of no image is judged before one of no category, and both before its box.
    """
    found = annotations(docs).join(images(docs), ["split", "image_id"], "left").join(categories(docs), ["split", "category_id"], "left")
    problem = F.when(F.col("file_name").isNull(), "orphan_annotation").when(F.col("category").isNull(), "unknown_category").otherwise(box_problem(F.col("bbox"), F.col("width"), F.col("height")))
    return found.withColumn("problem", problem)


def file_issues(docs: DataFrame, files: DataFrame) -> DataFrame:
    """Listed images without a file and files that no document lists (``files``: ``split``, ``file_name``)."""
    listed = images(docs).select("split", "file_name")
    missing = listed.join(files, ["split", "file_name"], "left_anti").withColumn("issue", F.lit("missing_image"))
    return missing.unionByName(files.select("split", "file_name").join(listed, ["split", "file_name"], "left_anti").withColumn("issue", F.lit("unlisted_file")))


#: Kinds of issues that stop a preparation, in the order of the report.
FATAL = ("missing_image", "undecodable_image", "unlisted_file", "orphan_annotation", "unknown_category", "invalid_box", "size_mismatch", "missing_target_category")


def source_items(docs: DataFrame, files: DataFrame, targets: list[str]) -> DataFrame:
    """All that an audit looks at as rows, each with its ``issue``, null if it has none.

    ``item`` tells what they are: an annotation (with the columns of ``audited``), a picture that is listed or has a
    file, or a target category that its split lacks.

    ``files``: ``split``, ``file_name``, and the decoded ``width`` and ``height`` (null or below one if undecodable).
    """
    problem, w, h = F.col("problem"), F.col("w_"), F.col("h_")
    notes = audited(docs).withColumn("issue", F.when(problem.isin("orphan_annotation", "unknown_category"), problem).when(problem.isNotNull(), "invalid_box"))
    listed = images(docs).select("split", "file_name", "width", "height", F.lit(True).alias("listed_"))
    there = files.select("split", "file_name", F.col("width").alias("w_"), F.col("height").alias("h_"), F.lit(True).alias("there_"))
    issue = F.when(F.col("there_").isNull(), "missing_image").when(F.col("listed_").isNull(), "unlisted_file").when(F.coalesce(w < 1, F.lit(True)), "undecodable_image").when((F.col("width") != w) | (F.col("height") != h), "size_mismatch")
    pictures = listed.join(there, ["split", "file_name"], "full").select("split", "file_name", "width", "height", issue.alias("issue"))
    wanted = docs.sparkSession.createDataFrame([(s, t) for s in SPLITS for t in targets], "split string, category string")
    lacking = wanted.join(categories(docs), ["split", "category"], "left_anti").withColumn("issue", F.lit("missing_target_category"))
    kinds = [rows.withColumn("item", F.lit(k)) for k, rows in (("annotation", notes), ("picture", pictures), ("category", lacking))]
    return kinds[0].unionByName(kinds[1], True).unionByName(kinds[2], True)


def audit_source(docs: DataFrame, files: DataFrame, targets: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """The items of a source, written once, and how many have each fatal issue (also 0), counted as they are written."""
    return written_and_counted(source_items(docs, files, targets), {k: F.col("issue") == k for k in FATAL}, "source-items")


def audited_annotations(items: DataFrame) -> DataFrame:
    """Of the written items those that are annotations, with the columns of ``audited``: no document is read or joined again."""
    return items.filter("item = 'annotation'").drop("item", "issue")


def image_counts(docs: DataFrame, targets: list[str], found: DataFrame | None = None) -> DataFrame:
    """Each image with its sound boxes: of every target, all targets and all others; zero without any.

    ``found`` are the audited annotations, where they are at hand.
    """
    sound = (audited(docs) if found is None else found).filter(F.col("problem").isNull())
    is_target = F.col("category").isin(targets)
    counts = sound.groupBy("split", "image_id").agg(*[F.count_if(F.col("category") == t).alias(f"{t}_count") for t in targets], F.count_if(is_target).alias("target_count"), F.count_if(~is_target).alias("non_target_count"))
    return images(docs).join(counts, ["split", "image_id"], "left").na.fill(0)


def issue_counts(docs: DataFrame, files: DataFrame, targets: list[str]) -> DataFrame:
    """``issue`` and ``n`` for each kind that is fatal, also of those that do not occur, and their total."""
    counts = audit_source(docs, files, targets)[1]
    return docs.sparkSession.createDataFrame([*counts.items(), ("total", sum(counts.values()))], "issue string, n bigint")


def label_files(docs: DataFrame, targets: list[str], found: DataFrame | None = None) -> DataFrame:
    """``split``, ``file_name`` and ``label``: a line per sound target box, in annotation order; empty without one.

    ``found`` are the audited annotations, where they are at hand.
    """
    sound = (audited(docs) if found is None else found).filter(F.col("problem").isNull() & F.col("category").isin(targets))
    line = label_line(to_yolo(F.col("bbox"), F.col("width"), F.col("height")))
    lines = sound.select("split", "image_id", F.struct("annotation_id", line.alias("line")).alias("x")).groupBy("split", "image_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    text = F.coalesce(F.array_join(F.transform("x", lambda v: F.concat(v["line"], F.lit("\n"))), ""), F.lit(""))
    return images(docs).join(lines, ["split", "image_id"], "left").select("split", "file_name", text.alias("label"))
