"""Large JSON documents, read in parts: the items of one object or array by several tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import broadcast_if_small, materialize

#: Bytes of a document that a task reads as its part, and by which it reads on to the end of its last item.
CHUNK, MORE = 8 << 20, 1 << 16
#: Parts are dealt to this many partitions at most.
PARTITIONS = 10_000
_QUOTE, _COMMA, _OPEN, _CLOSE = b'",'[0], b'",'[1], b"{[", b"}]"
_MARK = np.isin(np.arange(256), list(b'",{}[]'))
_STEP = np.isin(np.arange(256), list(_OPEN)).astype(np.int8) - np.isin(np.arange(256), list(_CLOSE)).astype(np.int8)
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', re.DOTALL)
#: Bytes before a bracket within which the key that names it must begin.
KEY_BYTES = 1 << 16


def _marks(file: pa.NativeFile, start: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and characters of quotes, brackets and commas in ``data``, which begins at ``start``; no escaped quotes."""
    before, back = b"", 64
    while start and not before.strip(b"\\"):  # whether the first character is escaped may lie far back
        before = _read(file, max(0, start - back), min(back, start))
        if len(before) == start:
            break
        back *= 2
    run = len(before) - len(before.rstrip(b"\\"))
    a = np.frombuffer(b"\\" * run + data, np.uint8)
    at = np.flatnonzero(_MARK[a])
    slashes = np.flatnonzero(a == 92)
    if len(slashes):
        ends = np.flatnonzero(np.diff(slashes, append=-2) != 1)  # the last of each run of backslashes
        lengths = np.diff(ends, prepend=-1)
        escaped = slashes[ends][lengths % 2 == 1] + 1
        at = np.setdiff1d(at, escaped, assume_unique=True)
    at = at[at >= run]
    return at - run, a[at]


def _read(file: pa.NativeFile, start: int, length: int) -> bytes:
    file.seek(start)
    return file.read(length)


def _steps(kinds: np.ndarray, inside: bool) -> np.ndarray:
    """By how much each mark changes the depth, if the text begins inside a string or not; 2 marks a comma between items."""
    quoted = (np.cumsum(kinds == _QUOTE) + inside) % 2 == 1
    return np.where(quoted | (kinds == _QUOTE), 0, np.where(kinds == _COMMA, 2, _STEP[kinds]))


def _depth_change(steps: np.ndarray) -> int:
    return int(steps[steps != 2].sum())


def _chunks(spark: SparkSession, files: list[str], chunk: int) -> DataFrame:
    sizes = []
    for uri in files:
        fs, path = pa.fs.FileSystem.from_uri(uri)
        info = fs.get_file_info(path)
        if info.type != pa.fs.FileType.File:
            raise FileNotFoundError(uri)
        sizes.append((uri, info.size))
    table = spark.createDataFrame(sizes, "file string, size long").filter("size > 0")
    return table.select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(chunk).cast("long"))).alias("start"))


def _dealt(chunks: DataFrame, n: int) -> DataFrame:
    return chunks.repartition(max(1, min(n, PARTITIONS)), "file", "start")


def chunk_states(spark: SparkSession, files: list[str], chunk: int = CHUNK) -> DataFrame:
    """``file``, ``start`` of each part, and where the text stands there: ``inside`` a string or not, and the ``depth``.

    A task can't tell whether its part begins inside a string, so it tells for both cases by how much the part changes
    the depth; running sums over the parts of a file then tell which case it is. A document that doesn't end as it
    began is an error.
    """
    chunks = materialize(_chunks(spark, files, chunk), "json-chunks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, path = pa.fs.FileSystem.from_uri(uri)
                with fs.open_input_file(path) as file:
                    _, kinds = _marks(file, start, _read(file, start, chunk))
                out.append({"file": uri, "start": start, "quotes": int((kinds == _QUOTE).sum()), "out": _depth_change(_steps(kinds, False)), "in": _depth_change(_steps(kinds, True))})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("start", "quotes", "out", "in")]]))

    told = _dealt(chunks.select("file", "start"), chunks.count()).mapInArrow(run, "file string, start long, quotes long, out long, in long")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    told = materialize(told, "json-parts").withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    told = told.withColumn("change", F.when(F.col("inside"), F.col("in")).otherwise(F.col("out")))
    told = told.withColumns({"depth": F.coalesce(F.sum("change").over(earlier), F.lit(0)).cast("int"), "_end": F.sum("change").over(whole), "_quotes": F.sum("quotes").over(whole) % 2})
    sound = F.when((F.col("_end") == 0) & (F.col("_quotes") == 0), F.col("start")).otherwise(F.raise_error(F.concat(F.lit("the document is damaged: "), F.col("file"))))
    return materialize(told.select("file", sound.cast("long").alias("start"), "inside", "depth"), "json-states")


def _items(file: pa.NativeFile, start: int, chunk: int, inside: bool, depth: int, level: int) -> Iterator[tuple[int, bytes | None, bytes | None]]:
    """(place, key of the container that opens here or none, text or none) of all items that begin in a part.

    An item lies between two marks of its container: the opening bracket or a comma, and a comma or the closing bracket.
    It begins where the first of these stands, so the part that holds that one reads on to the second.
    """
    data = _read(file, start, chunk)
    at, kinds = _marks(file, start, data)
    steps = _steps(kinds, inside)

    def ends(steps: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        after = depth + np.cumsum(np.where(steps == 2, 0, steps))
        opens, commas, closes = (steps == 1) & (after == level), (steps == 2) & (after == level), (steps == -1) & (after == level - 1)
        return opens, opens | commas, commas | closes

    opens, first, last = ends(steps, depth)
    if level > 1:
        for p in at[opens].tolist():
            before = data[max(0, p - KEY_BYTES) : p] if p >= KEY_BYTES or not start else _read(file, max(0, start + p - KEY_BYTES), min(KEY_BYTES, start + p))
            found = _KEY.search(before)
            yield start + p, json.loads(b'"' + found[1] + b'"').encode() if found else b"", None
    events = np.flatnonzero(first | last)
    for j, k in zip(events, events[1:], strict=False):
        if first[j]:
            yield start + int(at[j]), None, data[at[j] + 1 : at[k]]
    if len(events) and first[events[-1]]:
        p, rest = int(at[events[-1]]), []
        n, depth, inside = start + len(data), depth + _depth_change(steps), bool((inside + (kinds == _QUOTE).sum()) % 2)
        while more := _read(file, n, MORE):
            at_, kinds_ = _marks(file, n, more)
            steps_ = _steps(kinds_, inside)
            if len(stop := np.flatnonzero(ends(steps_, depth)[2])):
                yield start + p, None, data[p + 1 :] + b"".join(rest) + more[: at_[stop[0]]]
                return
            rest.append(more)
            n, depth, inside = n + len(more), depth + _depth_change(steps_), bool((inside + (kinds_ == _QUOTE).sum()) % 2)
        raise ValueError(f"an item that begins at {start + p} has no end")


def json_items(spark: SparkSession, files: list[str], level: int = 1, chunk: int = CHUNK) -> DataFrame:
    """The items of JSON documents: ``file``, ``at`` (the place of the bracket or comma before it), ``key`` and ``text``.

    At level 1 these are the items of the whole, which is one array or object; ``key`` is null, and an item of an object
    is its key and value. At level 2 they are the items of the arrays and objects in it, and ``key`` is the name under
    which that one stands. A document is cut at fixed bytes, so several tasks read it, and each item goes to the task in
    whose part it begins; no task holds more than its part and its last item. Empty containers have no items. ``files``
    are URIs, known to the driver; so are, at level 2, the names of a document's members. Texts are not parsed here.
    """
    states = chunk_states(spark, files, chunk)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("opens", pa.string()), ("text", pa.string())])
        for batch in batches:
            for uri, start, inside, depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = pa.fs.FileSystem.from_uri(uri)
                rows: list[dict] = []
                with fs.open_input_file(path) as file:
                    for at, opens, text in _items(file, start, chunk, inside, depth, level):
                        if opens is not None or text.strip():
                            rows.append({"file": uri, "at": at, "opens": None if opens is None else opens.decode(), "text": None if text is None else text.decode()})
                        if len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    found = _dealt(states, states.count()).mapInArrow(run, "file string, at long, opens string, text string")
    if level == 1:
        return found.select("file", "at", F.lit(None).cast("string").alias("key"), "text")
    found = materialize(found, "json-items")
    until = F.lead("at").over(Window.partitionBy("file").orderBy("at"))  # a row for each member of a document
    spans = found.filter("opens IS NOT NULL").select(F.col("file").alias("_file"), F.col("at").alias("_from"), F.coalesce(until, F.lit((1 << 63) - 1)).alias("_until"), F.col("opens").alias("key"))
    inside = (F.col("file") == F.col("_file")) & (F.col("at") >= F.col("_from")) & (F.col("at") < F.col("_until"))
    return found.filter("text IS NOT NULL").join(broadcast_if_small(spans), inside).select("file", "at", "key", "text")
