"""Near duplicates by SimHash, with pigeonring filtering of candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import materialize
from .components import roots

#: Segments on the ring, their bits, and the differing bits at which fingerprints still link.
SEGMENTS, WIDTH, MOST = 4, 16, 3
SHINGLE = 3
#: Fingerprints of one bucket that are compared in one task; larger buckets are cut into pairs of blocks.
BLOCK = 4096
#: Pairs held before they are reduced to a forest.
HELD_PAIRS = 500_000


def fingerprint(text: str | None) -> int:
    """SimHash of the XXH64 (seed 42) of a text's word shingles; 0 if it has no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) > SHINGLE:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        ends = starts + lengths
        spans = zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
        hash64 = xxhash.xxh64_intdigest
        hashes = np.array([hash64(joined[a:b], 42) for a, b in spans], np.uint64)
    else:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _print() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``print`` (the text's SHA-256) and ``fp`` (the fingerprint's 64 bits as a long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found.view(np.int64))], ["doc_id", "print", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text", _print().alias("print")).mapInArrow(run, "doc_id long, print string, fp long")


def _segment(fp: Column, i: int, width: int = WIDTH) -> Column:
    return F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1))


def ring_keys(fp: Column) -> Column:
    """Bucket keys of a fingerprint.

    With at most 3 differing bits over 4 segments on a ring, some segment i has no difference and it and
    the next have one at most (a chain's budget is its length times 3/4, rounded down). So one half of the
    next segment is equal too: each i and half gives a key of 16 + 8 bits.
    """
    keys = []
    for i in range(SEGMENTS):
        for half in range(2):
            following = _segment(fp, 2 * ((i + 1) % SEGMENTS) + half, WIDTH // 2)
            keys.append(F.lit((2 * i + half) << 24) + F.shiftleft(_segment(fp, i), 8) + following)
    return F.array(*[k.cast("int") for k in keys])


def _linked(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which pairs link: the chains from segment ``start`` stay within budget, then the whole distance."""
    x = a ^ b
    turn = (start * WIDTH).astype(np.uint64)
    x = (x >> turn) | (x << ((64 - turn) % 64).astype(np.uint64))  # the chain's first segment comes lowest
    ok = np.ones(len(x), bool)
    for length in range(1, SEGMENTS):
        low = np.uint64((1 << (WIDTH * length)) - 1)
        ok &= np.bitwise_count(x & low) <= length * MOST // SEGMENTS
    ok[ok] = np.bitwise_count(x[ok]) <= MOST
    return ok


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that is not the least of its component, with that least node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    hung = label != np.arange(len(nodes))
    return nodes[hung], nodes[label[hung]]


class _Links:
    """Collects linking pairs, reduced to a forest whenever there are many."""

    def __init__(self):
        self.a, self.b, self.n = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.n += len(a)
        if self.n > HELD_PAIRS:
            self.a, self.b = [[x] for x in self.forest()]
            self.n = len(self.a[0])

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.uint64)
        return _forest(np.concatenate([none, *self.a]), np.concatenate([none, *self.b]))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, lo, hi, fp), sorted: links within each group of equal key, lo and hi, as a forest."""
    carry = None
    for batch in _with_end(batches):
        rows = None if batch is None else np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
        if rows is not None:
            carry = rows if carry is None else np.concatenate([carry, rows], axis=1)
        if carry is None or not carry.shape[1]:
            continue
        new = np.r_[True, (carry[:3, 1:] != carry[:3, :-1]).any(axis=0)]
        firsts = np.flatnonzero(new)
        stop = carry.shape[1] if batch is None else firsts[-1]  # the last group may go on in the next batch
        rows, carry = carry[:, :stop], carry[:, stop:]
        if not stop:
            continue
        firsts = firsts[firsts < stop]
        ends = np.repeat(np.r_[firsts[1:], stop], np.diff(np.r_[firsts, stop]))
        fp, start = rows[3].view(np.uint64), rows[0] >> 25
        links, at = _Links(), np.arange(stop)
        for gap in range(1, int((ends - at).max())):
            at = at[at + gap < ends[at]]
            ok = _linked(fp[at], fp[at + gap], start[at])
            if ok.any():
                links.add(fp[at[ok]], fp[at[ok] + gap])
        a, b = links.forest()
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def links(distinct: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) that connect just those of the distinct fingerprints ``fp`` that links connect.

    Pairs are compared inside tasks and leave them as forests, never as all pairs of a bucket. Buckets of
    one fingerprint go at once; a bucket of more than ``BLOCK`` is cut into blocks, and each pair of
    blocks is a group of its own.
    """
    keyed = distinct.select("fp", F.explode(ring_keys(F.col("fp"))).alias("key"))
    sizes = keyed.groupBy("key").count().filter("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    shared = keyed.join(sizes, "key").withColumn("blocks", blocks).withColumn("own", own)
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = shared.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    return groups.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents whose fingerprints differ in 3 bits or fewer are linked; the component's id is the smallest
    doc_id that links reach. A null or empty text has fingerprint zero and is linked like any other; a null
    doc_id keeps its row and gives no component its name, unless all in it are null. Repeated rows each stay. Other
    columns are left out; an empty table gives an empty one.
    """
    prints = materialize(fingerprints(docs).drop("print"), "simhash")
    return prints.join(_components(prints), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _components(prints: DataFrame) -> DataFrame:
    """Every distinct ``fp`` with the ``root`` fingerprint of its component and the smallest doc_id there."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = roots(links(distinct))
    classes = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return classes.join(named, "root").select("fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component: that of the smallest doc_id (null last), then of the smallest SHA-256 of its text.

    Rows are chosen on ids and hashes; rows alike in both are in one component and count as one. The
    smallest long stands for a null doc_id, so join and deduplication share one dealing of the texts.
    """
    key = lambda c: F.coalesce(c.cast("long"), F.lit(-(2**63))).alias("kept_key_")
    prints = materialize(fingerprints(docs), "simhash")
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "print")
    least = prints.groupBy("fp").agg(F.min(row).alias("row"))  # few rows to a join, however many are alike
    kept = least.join(_components(prints), "fp").groupBy("root").agg(F.min("row").alias("row"))
    kept = kept.select(key(F.col("row.doc_id")), F.col("row.print").alias("kept_print_"))
    keys = ["kept_key_", "kept_print_"]
    stays = docs.select("*", key(F.col("doc_id")), _print().alias("kept_print_")).join(kept, keys, "left_semi")
    return stays.dropDuplicates(keys).select(docs.columns)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
