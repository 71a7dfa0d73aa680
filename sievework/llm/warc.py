"""WARC archives with a two-level capture index, written and read back."""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import materialize, shared_path

#: Index lines of a compressed block; payloads shorter than this are never revisits.
BLOCK_LINES, LEAST_BYTES = 1000, 1000
#: Bytes that may lie unread between two records that are fetched in one range read, and bytes of such a read.
GAP_BYTES, READ_BYTES = 16_384, 4 << 20
#: Bytes of archives that one task reads back, and tasks at least.
TASK_BYTES, LEAST_TASKS = 32 << 20, 12

_INDEX = "surt string, page_id long, archive string, offset long, length long"


def surt_key(url: str | None) -> str:
    """A URL's sorting key: host labels reversed, then port, path and query, e.g. ``org,example)/a?b=1``."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return (url or "").strip().lower()
    labels = ",".join(reversed(host.rstrip(".").removeprefix("www.").split(".")))
    known = {"http": 80, "https": 443}.get(parts.scheme)
    return f"{labels}{f':{port}' if port and port != known else ''}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def _files(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def _publish(fs: pa.fs.FileSystem, path: str, data: list[bytes]) -> None:
    """Write a file whole or not at all: a task that runs again replaces what it has written."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        for x in data:
            out.write(x)
    fs.move(part, path)


def _record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, compressed as a member of its own. A revisit holds the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{target}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> dict:
    """Fields of one compressed record; the payload's digest and length are taken from the payload itself,
    those of a revisit from its headers. A damaged record raises ``ValueError``."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    named = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(named["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    told = base64.b32decode(named["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    revisit = named["WARC-Type"] == "revisit"
    if not revisit and (hashlib.sha1(payload).hexdigest() != told or len(payload) != length):
        raise ValueError("the payload differs from its digest")
    page = named["X-Page-Id"]
    return {
        "page_id": int(page) if page else None, "url": named["WARC-Target-URI"], "payload": None if revisit else payload, "payload_bytes": length,
        "payload_digest": told, "record_type": named["WARC-Type"], "refers_to": int(named["X-Refers-To-Page-Id"]) if revisit else None,
    }


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page to ``folder`` and return the unsorted index: key, page, archive, offset, length.

    Of pages with equal payloads of ``LEAST_BYTES`` or more, that with the largest page_id is the response.
    The groups are reduced map-side to one row per digest, so a group of any size costs a row per task.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    long_ = full.filter(F.length("payload") >= LEAST_BYTES)
    last = long_.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).filter("copies > 1").select(F.col("digest").alias("same"), "response")
    joined = full.join(last, F.col("digest") == F.col("same"), "left").select("page_id", "url", "payload", "digest", "response")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _files(folder)
        task = TaskContext.get()
        # Each attempt writes a file of its own: a second one may see its rows in another order, and the index
        # holds the offsets of the attempt that Spark commits.
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        rows, offset = [], 0
        part = f"{root}/{name}.{uuid.uuid4().hex}.part"
        out = None
        for batch in batches:
            for page_id, url, data, digest, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = out or fs.open_output_stream(part)
                revisit = response is not None and response != page_id
                record = _record(page_id, url, data, digest, response, revisit)
                out.write(record)
                rows.append((surt_key(url), page_id, name, offset, len(record)))
                offset += len(record)
        if out:
            out.close()
            fs.move(part, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["surt", "page_id", "archive", "offset", "length"])

    fs, root = _files(folder)
    fs.create_dir(root, recursive=True)
    return joined.mapInArrow(run, _INDEX)


def _key(surt: str, page_id: int | None) -> tuple[str, int]:
    return surt, -(2**63) if page_id is None else page_id


def write_index(entries: DataFrame, folder: str) -> list[tuple[str, int, str]]:
    """Write the sorted index and return its top level: each file's first key and name.

    Entries are sorted by reversed-host key and page over all files. A file holds compressed blocks of
    ``BLOCK_LINES`` lines, and beside it lies a sparse directory with each block's first key, offset and
    length. The top level has one row per file, as many as the sort has tasks.
    """
    fs, root = _files(folder)
    fs.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _files(folder)
        name = f"index-{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}.gz"
        blocks: list[bytes] = []
        directory: list[list] = []
        held: list[list] = []
        offset = 0

        def flush() -> None:
            nonlocal offset
            data = zlib.compress("\n".join(json.dumps(x) for x in held).encode())
            directory.append([held[0][0], held[0][1], offset, len(data)])
            blocks.append(data)
            offset += len(data)
            held.clear()

        for batch in batches:
            for surt, page_id, archive, at, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append([*_key(surt, page_id), archive, at, length])
                if len(held) == BLOCK_LINES:
                    flush()
        if held:
            flush()
        if directory:
            _publish(fs, f"{root}/{name}", blocks)
            _publish(fs, f"{root}/{name}.dir", [json.dumps(directory).encode()])
            yield pa.RecordBatch.from_pylist([{"surt": directory[0][0], "page_id": directory[0][1], "file": name}])

    ordered = entries.repartitionByRange("surt", "page_id").sortWithinPartitions("surt", F.col("page_id").asc_nulls_first())
    return sorted(map(tuple, ordered.mapInArrow(run, "surt string, page_id long, file string").collect()))


class Index:
    """Looks keys up in the written index, file by file."""

    def __init__(self, folder: str, top: list[tuple[str, int, str]]):
        self.fs, self.root = _files(folder)
        self.top, self.starts = top, [x[:2] for x in top]
        self.file = self.directory = self.firsts = None
        self.block: tuple | None = None

    def first_file(self, key: tuple[str, int]) -> int:
        """The file in which entries of the key begin, if there are any."""
        return max(bisect_left(self.starts, key) - 1, 0)

    def _open(self, number: int) -> None:
        if self.file != number:
            with self.fs.open_input_stream(f"{self.root}/{self.top[number][2]}.dir") as f:
                self.directory = json.loads(f.read())
            self.file, self.firsts, self.block = number, [tuple(x[:2]) for x in self.directory], None

    def _lines(self, block: int) -> list[list]:
        if not self.block or self.block[0] != block:
            _, _, offset, length = self.directory[block]
            with self.fs.open_input_file(f"{self.root}/{self.top[self.file][2]}") as f:
                data = f.read_at(length, offset)
            self.block = block, [json.loads(x) for x in zlib.decompress(data).decode().split("\n")]
        return self.block[1]

    def find(self, key: tuple[str, int]) -> Iterator[tuple[str, int, int]]:
        """Archive, offset and length of every entry of the key."""
        for number in range(self.first_file(key), len(self.top)):
            if self.starts[number] > key:
                return
            self._open(number)
            for block in range(max(bisect_left(self.firsts, key) - 1, 0), len(self.directory)):
                if self.firsts[block] > key:
                    return
                lines = self._lines(block)
                at = bisect_left(lines, list(key))
                while at < len(lines) and tuple(lines[at][:2]) == key:
                    yield tuple(lines[at][2:])
                    at += 1


def look_up(keys: DataFrame, folder: str, top: list[tuple[str, int, str]]) -> DataFrame:
    """``archive``, ``offset`` and ``length`` of every record of the keys (``surt``, ``page_id``).

    The top level, one row per file, tells each key's file; the keys of a file then meet in one task,
    sorted, so that each block is read once.
    """
    sent = keys.sparkSession.sparkContext.broadcast(top)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, sent.value)
        for batch in batches:
            files = [index.first_file(_key(s, p)) for s, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(files, pa.int32())], ["surt", "page_id", "file"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, sent.value)
        for batch in batches:
            found = [x for s, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in index.find(_key(s, p))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["archive", "offset", "length"])

    routed = keys.select(F.coalesce("surt", F.lit("")).alias("surt"), "page_id").distinct().mapInArrow(route, "surt string, page_id long, file int")
    return routed.repartition("file").sortWithinPartitions("file", "surt", F.col("page_id").asc_nulls_first()).mapInArrow(run, "archive string, offset long, length long")


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]


def read_records(places: DataFrame, folder: str, tasks: int = LEAST_TASKS) -> DataFrame:
    """The records at ``archive``, ``offset``, ``length``, read by ranges; neighbours share a read.

    The rows are few bytes beside the records to which they point, so the number of ``tasks`` is given: it follows
    the bytes of the records.
    """

    def members(rows: list[tuple[str, int, int]], fs: pa.fs.FileSystem, root: str) -> Iterator[bytes]:
        i = 0
        while i < len(rows):
            j, end = i + 1, rows[i][1] + rows[i][2]
            while j < len(rows) and rows[j][0] == rows[i][0] and rows[j][1] - end <= GAP_BYTES and rows[j][1] + rows[j][2] - rows[i][1] <= READ_BYTES:
                end = max(end, rows[j][1] + rows[j][2])
                j += 1
            with fs.open_input_file(f"{root}/{rows[i][0]}") as f:
                data = f.read_at(end - rows[i][1], rows[i][1])
            for _, offset, length in rows[i:j]:
                yield data[offset - rows[i][1] : offset - rows[i][1] + length]
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _files(folder)
        for batch in batches:
            held: list[dict] = []
            size = 0
            for member in members(list(zip(*(c.to_pylist() for c in batch.columns), strict=True)), fs, root):
                held.append(parse_record(member))
                size += held[-1]["payload_bytes"]
                if size > READ_BYTES:
                    yield pa.RecordBatch.from_pylist(held, pa.schema(_FIELDS))
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, pa.schema(_FIELDS))

    stretch = F.floor(F.col("offset") / READ_BYTES)  # an archive may be large: its stretches are dealt apart
    dealt = places.repartition(tasks, "archive", stretch).sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (``page_id``, ``url``, ``html``) to WARC archives with their index and read all records back.

    Returns ``page_id``, ``url``, ``payload`` (null for revisits), ``payload_bytes``, ``payload_digest``,
    ``record_type`` and ``refers_to``. A null html is an empty payload, a null url an empty key. Rows that
    repeat a page_id have a record each; those with their group's largest page_id are all responses. A
    null page_id is written, indexed before all others of its url, and never referred to unless all of its
    group are null; then they are all responses. Other columns are left out; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    entries = materialize(write_archives(pages, folder), "warc-entries")
    size = entries.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    top = write_index(entries, f"{folder}/index")
    wanted = pages.select(F.coalesce("url", F.lit("")).alias("url"), F.col("page_id").cast("long").alias("page_id"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt_key(u) for u in batch.column(0).to_pylist()], pa.string()), batch.column(1)], ["surt", "page_id"])

    keys = wanted.mapInArrow(keyed, "surt string, page_id long")
    return read_records(look_up(keys, f"{folder}/index", top), folder, max(LEAST_TASKS, -(-size // TASK_BYTES)))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""
