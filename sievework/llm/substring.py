"""Removal of repeated word windows across documents, found by difference-cover anchors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Every difference modulo 13 is one of two positions of this cover, so two equal stretches, wherever they
#: begin, both have a cover position at one of their first 13 places.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Text that is hashed at a time, hashes that are dealt at a time, buckets for each partition of a shuffle (one
#: bucket of hashes is held in memory at a time), and bytes of text for a bucket at most: their hashes take some twice that.
CHUNK_BYTES, DEAL_ROWS, BUCKETS_EACH, BUCKET_BYTES = 1 << 19, 250_000, 4, 32 << 20

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(odd: int, inverse: bool, n: int) -> np.ndarray:
    """1, c, c^2, ... modulo 2^64, of an odd number or its inverse."""
    known = _POWERS.get((odd, inverse))
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), pow(odd, -1, 1 << 64) if inverse else odd, np.uint64)
        steps[0] = 1
        known = _POWERS[odd, inverse] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for every pair, from running sums."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, _powers(odd, False, len(values)), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(odd, True, len(values) + 1)[starts]


class Words:
    """The words of several texts, hashed: ``hash``, the text each is in, and its place there."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        space = _SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        word = ~space
        before = np.r_[True, space[:-1]] if len(data) else space
        after = np.r_[space[1:], True] if len(data) else space
        self.start = np.flatnonzero(word & (before | edge[:-1]))
        self.end = np.flatnonzero(word & (after | edge[1:])) + 1
        self.data = data
        self.hash = self.hashed(_ODD[0])
        self.first = np.searchsorted(self.start, offsets)  # each text's first word; its end is the next text's
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.count)), self.count)
        self.place = np.arange(len(self.start)) - self.first[:-1][self.text]

    def hashed(self, odd: int) -> np.ndarray:
        """A hash of every word."""
        return _mixed(_ranges(np.add(self.data, 1, dtype=np.uint64), self.start, self.end, odd) ^ (self.end - self.start).astype(np.uint64))

    def windows(self, at: np.ndarray, length: int, odd: int = _ODD[1], words: np.ndarray | None = None) -> np.ndarray:
        """Hash of the ``length`` words from each index in ``at``."""
        return _mixed(_ranges(self.hash if words is None else words, at, at + length, odd))

    def full(self, length: int) -> np.ndarray:
        """Indexes at which ``length`` words of one text begin."""
        return np.flatnonzero(self.place + length <= self.count[self.text])


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows (from, to) with their texts' bytes and offsets, about ``CHUNK_BYTES`` at a time."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + CHUNK_BYTES, side="right")) - 1)
        yield a, b, raw[ends[a] : ends[b]], ends[a : b + 1] - ends[a]
        a = b


def _equal(h: np.ndarray, h2: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash, equal ones by place, and which rows in it equal the one before."""
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1] if len(h) else np.zeros(0, bool)
    shared = np.flatnonzero(np.r_[same, False] | np.r_[False, same]) if len(h) else np.zeros(0, np.int64)
    mine = order[shared]
    order[shared] = mine[np.lexsort((pos[mine], doc[mine], h2[mine], h[mine]))]
    return order, np.r_[False, (h[order][1:] == h[order][:-1]) & (h2[order][1:] == h2[order][:-1])] if len(h) else same


def _later(order: np.ndarray, same: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which rows in an order by ``_equal`` lie at a later place than the first of their equals."""
    first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    return same & ((doc[order] != doc[first]) | (pos[order] != pos[first]))


_DEALT = "bucket int, h binary, h2 binary, doc_id binary, tag binary, low binary, high binary, known binary"
_TYPES = (np.uint64, np.int32, np.int64, np.int64, np.uint16, np.uint16, np.bool_)


class _Dealer:
    """Deals found hashes with their places to buckets, many to a row.

    Of equal hashes only the earliest place (in several rows, if they share it) goes on under its hash; the
    others are known to be repeats and are dealt evenly, so a passage that fills a third of the corpus meets no task whole.
    """

    def __init__(self, buckets: int, first_only: bool):
        self.buckets, self.first_only, self.held, self.n = buckets, first_only, [], 0

    def add(self, *found: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(found)
        self.n += len(found[0])
        if self.n >= DEAL_ROWS:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        empty = [np.zeros(0, t) for t in (np.uint64, np.int32, np.int64, np.int64, np.int64)]
        h, h2, doc, pos, tag = (np.concatenate([e, *x]) for e, x in zip(empty, zip(*self.held, strict=True) if self.held else [()] * 5, strict=True))
        self.held, self.n = [], 0
        order, same = _equal(h, h2, doc, pos)
        known = np.zeros(len(h), bool)
        known[order[_later(order, same, doc, pos) if self.first_only else same]] = True
        spread = _mixed((doc.view(np.uint64) * np.uint64(_ODD[2])) ^ pos.astype(np.uint64))
        h = np.where(known, spread, h)
        if not self.first_only and len(same):
            known[order[:-1][same[1:]]] = True
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]]) if len(h) else np.zeros(0, np.int64)
        ends = np.r_[cuts[1:], len(h)]
        columns = [pa.array(bucket[order][cuts], pa.int32())]
        for x, t in zip((h, h2, doc, tag, pos & 0xFFFF, pos >> 16, known), _TYPES, strict=True):
            data = x[order].astype(t)
            offsets = (np.r_[cuts, len(h)] if len(cuts) else np.zeros(1, np.int64)) * data.itemsize
            columns.append(pa.Array.from_buffers(pa.binary(), len(ends) if len(cuts) else 0, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data.tobytes())]))
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _DEALT.split(", ")])


def _anchors(window: int, buckets: int) -> Callable:
    """Hashes of the words at cover positions: long enough to be telling, short enough to lie in the window."""
    length = window - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(buckets, first_only=False)
        for batch in batches:
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            for a, _, data, offsets in chunks(batch.column(1)):
                w = Words(data, offsets)
                at = w.full(length)
                at = at[np.isin(w.place[at] % PERIOD, COVER) & (w.count[w.text[at]] >= window)]
                h = w.windows(at, length)
                yield from dealer.add(h, np.zeros(len(h), np.int32), ids[a + w.text[at]], w.place[at], tags[a + w.text[at]])
        yield dealer.flush()

    return run


def _repeats(first_only: bool) -> Callable:
    """Rows sorted by bucket: places whose hash is not alone (first_only: not the first)."""

    def judged(held: list[list[bytes]]) -> pa.RecordBatch:
        h, h2, doc, tag, low, high, known = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*held, strict=True), _TYPES, strict=True))
        pos = high.astype(np.int64) << 16 | low
        order, same = _equal(h, h2, doc, pos)
        repeated = known.copy()
        repeated[order[_later(order, same, doc, pos) if first_only else same]] = True
        if not first_only:
            repeated[order[:-1][same[1:]]] = True
        return pa.RecordBatch.from_arrays([pa.array(doc[repeated]), pa.array(tag[repeated]), pa.array(pos[repeated], pa.int32())], ["doc_id", "tag", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != bucket and held:
                    yield judged(held)
                    held = []
                bucket = row[0]
                held.append(row[1:])
        if held:
            yield judged(held)

    return run


def _places(found: DataFrame, first_only: bool, tasks: int) -> DataFrame:
    """Repeated places per row key, as one list."""
    dealt = found.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_repeats(first_only), "doc_id long, tag long, pos int").groupBy("doc_id", "tag").agg(F.collect_list("pos").alias("places"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row each is in; null lists have none."""
    lengths = np.diff(np.asarray(column.offsets)) if column.null_count == 0 else np.array([len(x) if x.is_valid else 0 for x in column])
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64), np.repeat(np.arange(len(column)), lengths)


def _cover(first: np.ndarray, total: int, starts: np.ndarray, before: int, length: int) -> np.ndarray:
    """Which of ``total`` indexes lie in [start - before, start + length)."""
    marks = np.zeros(total + 1, np.int64)
    np.add.at(marks, np.maximum(starts - before, first), 1)
    np.add.at(marks, np.minimum(starts + length, total), -1)
    return np.cumsum(marks[:-1]) > 0


def _candidates(window: int, buckets: int) -> Callable:
    """Windows that hold a repeated anchor, hashed whole."""
    length = window - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(buckets, first_only=True)
        for batch in batches:
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3))
            places, rows = _lists(batch.column(2))
            for a, b, data, offsets in chunks(batch.column(1)):
                mine = (rows >= a) & (rows < b)
                if not mine.any():
                    continue
                w = Words(data, offsets)
                begins = w.first[rows[mine] - a]
                near = _cover(begins, len(w.start), begins + places[mine], window - length, 1)
                at = np.flatnonzero(near & (w.place + window <= w.count[w.text]))
                h, h2 = w.windows(at, window), w.windows(at, window, _ODD[2], w.hashed(_ODD[2])) & np.uint64(0x7FFFFFFF)
                yield from dealer.add(h, h2.astype(np.int32), ids[a + w.text[at]], w.place[at], tags[a + w.text[at]])
        yield dealer.flush()

    return run


def _remaining(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows = _lists(batch.column(2))
            ends = np.searchsorted(rows, np.arange(len(batch) + 1))
            out: list[list] = [[], [], [], []]
            for i, (doc, text, copy) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), batch.column(3).to_pylist(), strict=True)):
                words = (text.as_py() or "").encode().split()
                mine = places[ends[i] : ends[i + 1]]
                kept = words
                if copy and len(words) >= window:
                    kept = []
                elif len(mine):
                    gone = _cover(np.zeros(len(mine), np.int64), len(words), mine, 0, window)
                    kept = [words[j] for j in np.flatnonzero(~gone).tolist()]
                joined = b" ".join(kept)
                for col, x in zip(out, (doc, len(words), len(words) - len(kept), joined), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "n_words", "n_removed", "kept"])

    return run


#: Stands for a null doc_id where places are compared: before all others.
_NO_ID = -(2**63)


def drop_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one space, in UTF-8).

    A word goes if a window of ``window`` words that covers it also starts earlier: in a document of
    smaller doc_id, or earlier in its own. All windows are judged on the input.

    Of equal texts only those of the smallest doc_id are searched: every window of the others starts
    earlier there. Anchors, windows of ``window - 12`` words, are hashed at cover positions only. Where an
    anchor comes twice, the windows around it are hashed whole; the first place of each hash stays. The
    texts are dealt once for all steps, by doc_id and ``tag`` (60 bits of the text's SHA-256), which tell
    rows of one doc_id with different texts apart. A null text has no words; null ids count as one document
    before all others. Rows that repeat a doc_id are parts of one document that begin at the same place:
    none is earlier than the other. Other columns are left out; an empty table gives an empty one.

    Windows count as equal if 95 bits of two hashes are, each over words hashed on their own; the words are
    not compared. Buckets, and the tasks that hold them, follow the bytes of all texts.
    """
    if window < PERIOD:
        raise ValueError(f"a window has {PERIOD} words at least")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(BUCKETS_EACH * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    tasks = -(-buckets // BUCKETS_EACH)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), "text")
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    texts = texts.withColumn("print", sha).withColumn("tag", F.coalesce(F.conv(F.substring("print", 1, 15), 16, 10).cast("long"), F.lit(0)))  # no null: a filter on it would part the dealings
    prints = texts.select("doc_id", "tag", "print")
    firsts = prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("print", "first")
    key = ["doc_id", "tag"]
    copies = prints.join(firsts, "print").filter("doc_id > first").select(key).distinct().withColumn("copy", F.lit(True))
    texts = texts.join(copies, key, "left").select(*key, "text", F.coalesce("copy", F.lit(False)).alias("copy"))
    searched = texts.filter(~F.col("copy")).select("doc_id", "text", "tag")
    anchors = _places(searched.mapInArrow(_anchors(window, buckets), _DEALT), False, tasks)
    candidates = searched.join(anchors, key).select("doc_id", "text", "places", "tag").mapInArrow(_candidates(window, buckets), _DEALT)
    repeats = _places(candidates, True, tasks)
    found = texts.join(repeats, key, "left").select("doc_id", "text", "places", "copy")
    out = found.mapInArrow(_remaining(window), "doc_id long, n_words long, n_removed long, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
k AS (SELECT r, id, i, array_to_string(w[i + 1:i + 20], ' ') AS words FROM (SELECT *, unnest(range(len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT words, min({'id': id, 'i': i}) AS first FROM k GROUP BY 1),
g AS (SELECT DISTINCT r, i + j AS at FROM (SELECT r, i FROM k JOIN f USING (words) WHERE {'id': id, 'i': i} > first), (SELECT unnest(range(20)) AS j)),
t AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS at FROM d),
s AS (SELECT t.r, count(g.at) AS n_removed, string_agg(word, ' ' ORDER BY t.at) FILTER (WHERE g.at IS NULL) AS kept FROM t LEFT JOIN g ON t.r = g.r AND t.at = g.at GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN s USING (r)
"""
