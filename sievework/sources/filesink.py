"""A sink of whole files: those of a job become visible together, or none does.

Tasks write to a hidden folder of the job below the target. Spark hands the attempts that count to ``commit``, which
records them in one file: from then on the job is done, and :func:`publish` moves its files to their names, in tasks. A
driver that dies before the record leaves nothing to be seen; one that dies after it leaves a move that
:func:`recover` takes up again, for a file that has been moved already stays as it is.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..shared import materialize

#: Where jobs write below a target; Spark's readers pass over names that begin so.
STAGING = "_staging"
_RECORD = "commit.json"


@dataclass
class Attempt(WriterCommitMessage):
    """The folder in which one attempt of a task has written."""

    place: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder, self.job = options["path"], options["job"]
        self.keep, self.joined = json.loads(options["keep"]), json.loads(options["joined"])
        self.head, self.between, self.tail = (x.encode() for x in self.joined or ("", "", ""))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        fs, root = pa.fs.FileSystem.from_uri(self.folder)
        place = f"{STAGING}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(f"{root}/{place}", recursive=True)
        schema = pa.schema([("name", pa.string()), ("length", pa.int64()), ("sha256", pa.string()), *[(k, pa.string()) for k in self.keep]])
        with fs.open_output_stream(f"{root}/{place}/manifest.parquet") as out, pq.ParquetWriter(out, schema) as manifest:
            def add(some: bytes | pa.Buffer) -> None:
                nonlocal length
                f.write(some)
                sha.update(some)
                length += len(some)

            def closed() -> dict:
                add(self.tail)
                f.close()
                return {"name": at, "length": length, "sha256": sha.hexdigest(), **dict(zip(self.keep, told, strict=True))}

            at, length = None, 0
            for batch in iterator:
                rows = []
                for name, content, *rest in zip(*(batch.column(c) for c in ("name", "content", *self.keep)), strict=True):
                    name, content, rest = name.as_py(), content.as_buffer(), [x.as_py() for x in rest]  # one row at a time
                    if at is None or name != at or self.joined is None:
                        rows += [closed()] if at is not None else []
                        to = f"{root}/{place}/files/{name}"
                        fs.create_dir(to.rsplit("/", 1)[0], recursive=True)
                        f, at, told, length, sha = fs.open_output_stream(to), name, rest, 0, hashlib.sha256()
                        add(self.head)
                    else:
                        add(self.between)
                    add(content)
                if rows:
                    manifest.write_table(pa.Table.from_pylist(rows, schema))
            if at is not None:
                manifest.write_table(pa.Table.from_pylist([closed()], schema))
        return Attempt(place)

    def commit(self, messages: list[Attempt | None]) -> None:
        fs, root = pa.fs.FileSystem.from_uri(self.folder)
        folder = f"{root}/{STAGING}/{self.job}"
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{_RECORD}.part") as f:
            f.write(json.dumps({"places": [m.place for m in messages if m]}).encode())
        fs.move(f"{folder}/{_RECORD}.part", f"{folder}/{_RECORD}")

    def abort(self, messages: list[Attempt | None]) -> None:
        _drop(self.folder, self.job)


class FileSink(DataSource):
    """Takes rows of ``name`` and ``content``, and the text columns listed in ``keep``; ``path`` is the target and ``job`` a new name.

    With ``joined`` (its head, what is between parts, its tail), rows of one name that follow each other are parts of one
    file, which no task holds whole.
    """

    @classmethod
    def name(cls) -> str:
        return "sievework_files"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))


def _drop(folder: str, job: str) -> None:
    fs, root = pa.fs.FileSystem.from_uri(folder)
    if fs.get_file_info(f"{root}/{STAGING}/{job}").type == pa.fs.FileType.Directory:
        fs.delete_dir(f"{root}/{STAGING}/{job}")
    if not fs.get_file_info(pa.fs.FileSelector(f"{root}/{STAGING}", allow_not_found=True)) and fs.get_file_info(f"{root}/{STAGING}").type == pa.fs.FileType.Directory:
        fs.delete_dir(f"{root}/{STAGING}")


def stage(files: DataFrame, folder: str, keep: list[str] | None = None, joined: tuple[str, str, str] | None = None) -> str:
    """Writes each row's ``content`` out of sight and commits; gives the job, which is still to be published."""
    spark, job = files.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(FileSink)
    files.select("name", "content", *(keep or [])).write.format(FileSink.name()).options(path=folder, job=job, keep=json.dumps(keep or []), joined=json.dumps(joined)).mode("append").save()
    return job


def publish(spark: SparkSession, folder: str, job: str, keep: list[str] | None = None) -> DataFrame:
    """Moves the files of a committed job to their names; gives name, length, SHA-256 and the columns ``keep`` of each.

    A file of that name gives way. Of names that come twice one stays. Runs again without harm.
    """
    fs, root = pa.fs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{root}/{STAGING}/{job}/{_RECORD}") as f:
        places = json.loads(f.read())["places"]
    schema = "name string, length long, sha256 string" + "".join(f", {k} string" for k in keep or [])
    listed = [f"{folder}/{p}/manifest.parquet" for p in places]
    manifest = spark.read.schema(schema).parquet(*listed) if listed else spark.createDataFrame([], schema)
    manifest = materialize(manifest.select("*", F.regexp_extract("_metadata.file_path", r"([^/]+)/manifest\.parquet$", 1).alias("_place")), "published") if listed else manifest.withColumn("_place", F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, to = f"{root}/{STAGING}/{job}/{place}/files/{name}", f"{root}/{name}"
                if fs.get_file_info(at).type == pa.fs.FileType.NotFound:  # moved before
                    if fs.get_file_info(to).type == pa.fs.FileType.NotFound:
                        raise FileNotFoundError(f"{at} was committed and is gone")
                    continue
                fs.create_dir(to.rsplit("/", 1)[0], recursive=True)
                if fs.type_name != "local" and fs.get_file_info(to).type != pa.fs.FileType.NotFound:
                    fs.delete_file(to)  # where a move does not replace
                fs.move(at, to)
            yield batch

    manifest.select("name", "_place").mapInArrow(run, "name string, _place string").write.format("noop").mode("overwrite").save()
    _drop(folder, job)
    return manifest.drop("_place")


def recover(spark: SparkSession, folder: str) -> dict[str, int]:
    """Ends what writers that died have left below ``folder``: committed jobs are published, others dropped; gives how many of each.

    Only for a folder to which no one else writes at the time.
    """
    fs, root = pa.fs.FileSystem.from_uri(folder)
    told = {"published": 0, "dropped": 0}
    for job in fs.get_file_info(pa.fs.FileSelector(f"{root}/{STAGING}", allow_not_found=True)):
        name = job.path.rsplit("/", 1)[-1]
        if fs.get_file_info(f"{job.path}/{_RECORD}").type == pa.fs.FileType.File:
            publish(spark, folder, name)
            told["published"] += 1
        else:
            _drop(folder, name)
            told["dropped"] += 1
    return told
