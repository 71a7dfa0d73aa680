"""Images: listing, decoding, writing as PNG."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .filesink import publish, stage

EXTENSIONS = "*.{jpg,jpeg,png,bmp,JPG,JPEG,PNG,BMP}"


def list_images(spark: SparkSession, root: str) -> DataFrame:
    """``path`` and ``length`` of every image file below ``root``; no file is opened."""
    return _binary(spark, root).select("path", "length")


def hash_images(spark: SparkSession, root: str) -> DataFrame:
    """``path``, ``length`` and ``sha256`` of every image file below ``root``."""
    return _binary(spark, root).select("path", "length", F.sha2("content", 256).alias("sha256"))


def _binary(spark: SparkSession, root: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", EXTENSIONS).load(root)


def read_images(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Of all image files below ``root``, or of the files that it lists, ``image`` (path), ``height``, ``width`` and ``data`` (bytes of one, three or four channels, BGR first).

    Undecodable files have null data.
    """
    if root == []:
        return spark.createDataFrame([], "image string, height int, width int, data binary")
    read = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").option("pathGlobFilter", EXTENSIONS).load(root)
    return read.select(_uri(F.col("image.origin")).alias("image"), "image.height", "image.width", F.when(F.col("image.height") > 0, F.col("image.data")).alias("data"))


def _uri(path: Column) -> Column:
    """A file's path as both readers should name it: they differ in the slashes after ``file:``."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def read_files(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """``image`` (path) and ``content`` of every image file below ``root``, or of the files that it lists."""
    if root == []:
        return spark.createDataFrame([], "image string, content binary")
    return _binary(spark, root).select(_uri(F.col("path")).alias("image"), "content")


def encode_png(image: np.ndarray, level: int = 3) -> bytes:
    """A BGR image as a lossless PNG."""
    h, w = image.shape[:2]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(image[..., ::-1]).reshape(h, 3 * w)], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, level)) + chunk(b"IEND", b"")


def png(height: Column, width: Column, data: Column) -> Column:
    """The PNG of each image of three channels, from its bytes."""

    def encode(h: pd.Series, w: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([encode_png(np.frombuffer(x, np.uint8).reshape(y, z, 3)) for y, z, x in zip(h, w, d, strict=True)])

    return F.pandas_udf(encode, "binary")(height, width, data)


def write_files(files: DataFrame, folder: str, keep: list[str] | None = None) -> DataFrame:
    """Write each row's ``content`` to ``folder``/``name``; returns name, length, SHA-256 and the text columns ``keep``.

    Files become visible together once all are written; a job that fails leaves none. Tasks that run again do no harm.
    """
    return publish(files.sparkSession, folder, stage(files, folder, keep), keep)


def write_parts(parts: DataFrame, folder: str, *order: str, head: str = "", between: str = "", tail: str = "") -> DataFrame:
    """Write each ``name`` as one file of the ``content`` of all its rows, in the order of the columns ``order``, with what goes before, between and after them.

    The task that writes a file holds a batch of its rows, never the whole; otherwise as :func:`write_files`.
    """
    return publish(parts.sparkSession, folder, stage(parts.repartition("name").sortWithinPartitions("name", *order), folder, joined=(head, between, tail)))


def read_texts(names: DataFrame, folder: str) -> DataFrame:
    """``name`` and the ``text`` of the file ``folder``/``name`` of each row, null where there is none; empty files too, which Spark's readers leave out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                there = fs.get_file_info(f"{root}/{name}").type == pa.fs.FileType.File
                out.append({"name": name, "text": fs.open_input_stream(f"{root}/{name}").readall().decode(errors="replace") if there else None})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("name", pa.string()), ("text", pa.string())]))

    return names.select("name").mapInArrow(run, "name string, text string")


def remove_files(names: DataFrame, folder: str) -> int:
    """Remove the files ``folder``/``name`` of all rows; those that are gone already do no harm. Returns their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if fs.get_file_info(f"{root}/{name}").type == pa.fs.FileType.File:
                    fs.delete_file(f"{root}/{name}")
            yield batch

    return names.select("name").mapInArrow(run, "name string").count()
