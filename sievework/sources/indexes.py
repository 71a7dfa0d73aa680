"""Indexes of a prepared dataset: its images as an array of JSON objects, its annotations as an object keyed by image."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bigjson
from .images import write_parts

#: Fixed fields of an image of the index, and of an annotation.
IMAGE_SCHEMA = (
    "prepared_image string, prepared_label string, split string, source_relative_path string, source_split string, source_image_id bigint, width int, height int, deployment string, "
    "sha256 string, target_count int, fish_count int, small_fish_count int, non_target_count int, duplicate_sources array<string>"
)
ANNOTATION_SCHEMA = "struct<class_id:int,class_name:string,source_category:string,source_annotation_id:bigint,bbox_xywh:array<double>,bbox_yolo:array<double>>"


#: Items of one document that is written here, about: an index is one document or a folder of several.
ITEMS = 10_000


def _documents(path: str) -> list[str]:
    """The document, or those in the folder."""
    fs, plain = pa.fs.FileSystem.from_uri(path)
    if fs.get_file_info(plain).type != pa.fs.FileType.Directory:
        return [path]
    return [f"{path.rstrip('/')}/{i.base_name}" for i in fs.get_file_info(pa.fs.FileSelector(plain)) if i.base_name.endswith(".json")]


def is_index(path: str) -> bool:
    """Whether a path names a JSON document or a folder of such, rather than a table."""
    return any(d.endswith(".json") for d in _documents(path))


def read_image_index(spark: SparkSession, path: str, chunk: int = bigjson.CHUNK) -> DataFrame:
    """One row per image; a missing file or a damaged one is an error. Several tasks read a large document."""
    items = bigjson.json_items(spark, _documents(path), 1, chunk)
    return items.select(F.from_json("text", IMAGE_SCHEMA, {"mode": "FAILFAST"}).alias("i")).select("i.*")


def read_annotation_index(spark: SparkSession, path: str, chunk: int = bigjson.CHUNK) -> DataFrame:
    """``image`` and ``annotations`` of every image of the index; a missing file or a damaged one is an error.

    A document is one object with a key for each image, which is parsed as a map of one entry, never by an inferred
    schema. Several tasks read a large one.
    """
    items = bigjson.json_items(spark, _documents(path), 1, chunk).withColumn("text", F.concat(F.lit("{"), "text", F.lit("}")))
    entry = F.from_json("text", f"map<string,array<{ANNOTATION_SCHEMA}>>", {"mode": "FAILFAST"})
    return items.select(F.explode(entry).alias("image", "annotations"))


def _bucketed(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows.count() // ITEMS)))))


def _write(texts: DataFrame, key: str, folder: str, head: str, tail: str) -> None:
    """Writes each ``text`` into the document of its ``_part``, item by item: no task holds a document whole."""
    named = F.concat(F.lit("part-"), F.lpad(F.col("_part").cast("string"), 6, "0"), F.lit(".json"))
    write_parts(texts.select(named.alias("name"), key, F.col("text").cast("binary").alias("content")), folder, key, head=head, between=",", tail=tail)


def write_image_index(images: DataFrame, folder: str) -> None:
    """Writes the rows as documents of about ``ITEMS`` objects each, however many there are."""
    rows = _bucketed(images, "prepared_image")
    _write(rows.select("_part", "prepared_image", F.to_json(F.struct(*images.columns)).alias("text")), "prepared_image", folder, "[", "]")


def write_annotation_index(annotations: DataFrame, folder: str) -> None:
    """Writes ``image`` and ``annotations``, a row for each image, as objects of about ``ITEMS`` keys each; an image that comes twice is an error."""
    before = F.lag("image").over(Window.partitionBy("_part").orderBy("image"))
    once = F.when(before == F.col("image"), F.raise_error(F.concat(F.lit("an image comes twice: "), "image"))).otherwise(F.to_json(F.create_map("image", "annotations")))
    rows = _bucketed(annotations, "image").select("_part", "image", once.alias("text"))
    _write(rows.withColumn("text", F.expr("substring(text, 2, length(text) - 2)")), "image", folder, "{", "}")


def with_annotations(images: DataFrame, annotations: DataFrame, key: str = "prepared_image") -> DataFrame:
    """Each image with its annotations, none if the index has none for it."""
    joined = images.join(annotations.withColumnRenamed("image", "image_"), F.col(key) == F.col("image_"), "left").drop("image_")
    return joined.withColumn("annotations", F.coalesce("annotations", F.array().cast(f"array<{ANNOTATION_SCHEMA}>")))
