"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .substring import Words, chunks
from .text import held_out, hash_unit

#: Buckets of hashed words, and rank of the pairwise interactions.
BUCKETS, RANK = 1 << 14, 4
#: Labelled documents from which the machine is fitted, chosen by a hash of the id.
SAMPLE = 4000
#: Passes over the sample, step of Adam, and weight of the squared parameters.
PASSES, STEP, DECAY = 80, 0.05, 1e-4
#: A score from which a document counts as good.
CUT = 0.3

STATS = ("log_words", "word_length", "word_length_spread", "log_lines", "line_words", "upper", "digits", "marks", "symbols", "bars", "not_ascii", "spaces", "one_letter", "same_as_last", "distinct", "log_n_chars", "n_chars_off")
_KINDS = np.zeros((7, 256), bool)
_KINDS[0, ord("A") : ord("Z") + 1] = True
_KINDS[1, ord("0") : ord("9") + 1] = True
_KINDS[2, [ord(c) for c in ".,;:!?'\"()-"]] = True
_KINDS[3, [ord(c) for c in "#*$%&<>@=+/\\^~_{}[]"]] = True
_KINDS[4, ord("|")] = True
_KINDS[5, 192:] = True  # first bytes of longer characters
_KINDS[6, [32, 9, 10, 11, 12, 13]] = True


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _told(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chars = _per_text((data & 0xC0) != 0x80, offsets)
    told = np.log1p(np.where(n_chars < 0, chars, n_chars))
    return told, np.abs(told - np.log1p(chars))


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts in ``data``: each word's bucket, the words' bounds by text, and the statistics.

    The last two are metadata: the length that the table tells, and how far it is from the text's own, as logarithms.
    A length that is not told (negative) counts as the text's own.
    """
    w = Words(data, offsets)
    n, size = np.maximum(w.count, 1), np.maximum(np.diff(offsets), 1)
    lengths = (w.end - w.start).astype(float)
    mean = _per_text(lengths, w.first) / n
    square = _per_text(lengths**2, w.first) / n
    lines = 1 + _per_text(data == 10, offsets)
    shares = [_per_text(_KINDS[i][data], offsets) / size for i in range(len(_KINDS))]
    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.place[1:] > 0)
    keys = np.sort(w.text.astype(np.uint64) << np.uint64(44) | w.hash >> np.uint64(20))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[new] >> np.uint64(44)).astype(np.int64), minlength=len(n))
    stats = np.stack([np.log1p(w.count), mean, np.sqrt(np.maximum(square - mean**2, 0)), np.log(lines), np.log1p(w.count / lines), *shares, _per_text(lengths == 1, w.first) / n, _per_text(same, w.first) / n, distinct / n**0.9, *_told(data, offsets, n_chars)], axis=1)
    return (w.hash % np.uint64(BUCKETS)).astype(np.int64), w.first, stats


@dataclass
class Machine:
    """A factorisation machine: constant, weights and factors of the words and of the statistics."""

    constant: float
    word: np.ndarray
    word_factor: np.ndarray
    stat: np.ndarray
    stat_factor: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.spread, -3, 3)

    def score(self, buckets: np.ndarray, first: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Probabilities, in time linear in the words: each word weighs one over the text's words.

        The sum over all pairs of features is half the square of the sum less half the sum of squares.
        """
        n = np.diff(first)
        weight = 1.0 / np.maximum(n, 1)
        table = np.concatenate([self.word[:, None], self.word_factor, (self.word_factor**2).sum(axis=1, keepdims=True)], axis=1)
        sums = np.zeros((len(n), table.shape[1]))
        some = np.flatnonzero(n)
        if len(some):
            sums[some] = np.add.reduceat(table.take(buckets, axis=0), first[some], axis=0)
        s = self.scaled(stats)
        linear = self.constant + sums[:, 0] * weight + s @ self.stat
        q = sums[:, 1:-1] * weight[:, None] + s @ self.stat_factor
        squares = sums[:, -1] * weight**2 + s**2 @ (self.stat_factor**2).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(linear + 0.5 * ((q**2).sum(axis=1) - squares), -30, 30)))


def fit_machine(rows: np.ndarray, buckets: np.ndarray, counts: np.ndarray, stats: np.ndarray, target: np.ndarray, seed: int = 7) -> Machine:
    """Adam over the whole sample. ``rows``, ``buckets``, ``counts``: how often a word is in a text, by row.

    Without samples, or with samples of one kind, the machine scores all alike by that kind's share.
    """
    n, m = len(target), len(STATS)
    rng = np.random.default_rng(seed)
    zero = Machine(0.0, np.zeros(BUCKETS), np.zeros((BUCKETS, RANK)), np.zeros(m), np.zeros((m, RANK)), np.zeros(m), np.ones(m))
    share = (target.sum() + 1) / (n + 2)
    zero.constant = float(np.log(share / (1 - share)))
    if n == 0 or target.min() == target.max():
        return zero
    mean, spread = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    s = np.clip((stats - mean) / spread, -3, 3)
    per_row = np.maximum(np.bincount(rows, counts, minlength=n), 1)
    x, x2 = counts / per_row[rows], counts / per_row[rows] ** 2
    used, col = np.unique(buckets, return_inverse=True)
    by_col = np.argsort(col, kind="stable")
    col_first = np.searchsorted(col[by_col], np.arange(len(used)))
    row_some, row_first = np.unique(rows, return_index=True)

    def to_rows(values: np.ndarray) -> np.ndarray:
        out = np.zeros((n, *values.shape[1:]))
        out[row_some] = np.add.reduceat(values, row_first, axis=0)
        return out

    def to_cols(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[by_col], col_first, axis=0)

    p = [np.array([zero.constant]), np.zeros(len(used)), rng.normal(0, 0.1, (len(used), RANK)), np.zeros(m), rng.normal(0, 0.1, (m, RANK))]
    first, second = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    for t in range(1, PASSES + 1):
        c, w, v, ws, vs = p
        q = to_rows(x[:, None] * v[col]) + s @ vs
        squares = to_rows((x2 * (v**2).sum(axis=1)[col])[:, None])[:, 0] + s**2 @ (vs**2).sum(axis=1)
        y = c + to_rows((x * w[col])[:, None])[:, 0] + s @ ws + 0.5 * ((q**2).sum(axis=1) - squares)
        g = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - target) / n
        gq = g[:, None] * q
        grads = [
            np.array([g.sum()]),
            to_cols((x * g[rows])[:, None])[:, 0],
            to_cols(x[:, None] * gq[rows]) - v * to_cols((x2 * g[rows])[:, None]),
            s.T @ g,
            s.T @ gq - vs * (s**2).T.dot(g)[:, None],
        ]
        for i, grad in enumerate(grads):
            grad = grad + DECAY * p[i]
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad**2
            p[i] = p[i] - STEP * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    zero.word[used], zero.word_factor[used] = p[1], p[2]
    return Machine(float(p[0][0]), zero.word, zero.word_factor, p[3], p[4], mean, spread)


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per labelled document: its words' buckets with their counts, its statistics and its label."""
    for batch in batches:
        labels, told = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        for a, b, data, offsets in chunks(batch.column(0)):
            buckets, first, stats = features(data, offsets, told[a:b])
            found = [np.unique(buckets[i:j], return_counts=True) for i, j in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.list_(pa.int64())), pa.array(list(stats), pa.list_(pa.float64())), pa.array(labels[a:b].astype(np.int32))], ["buckets", "counts", "stats", "label"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine from at most ``sample`` labelled documents (``doc_id``, ``label`` 0 or 1) that are not held out.

    The sample is taken by a hash of the id; its whole texts are turned into counts on the executors. One task
    fits the machine from the counts, which the sample bounds, and only the machine, of fixed size, comes to the
    driver. An id with several labels counts as its largest. Null ids and labels teach nothing; without labels, or with
    labels of one kind, all documents score alike. ``docs`` may have ``n_chars``.
    """
    known = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(hash_unit(F.lit("quality"), F.col("doc_id")), "doc_id").limit(sample).withColumnRenamed("doc_id", "label_id")
    texts = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", F.col("label").cast("int").alias("label"), _n_chars(docs).alias("told"))
    found = texts.select("text", "label", "told").mapInArrow(_featurised, "buckets array<long>, counts array<long>, stats array<double>, label int")
    rows = found.repartition(1).sortWithinPartitions("label", "stats").mapInArrow(_machines, "machine binary").collect()
    return pickle.loads(rows[0]["machine"]) if rows else fit_machine(*[np.zeros(0, np.int64)] * 3, np.zeros((0, len(STATS))), np.zeros(0))


def _n_chars(docs: DataFrame) -> Column:
    return F.coalesce(F.col("n_chars").cast("long"), F.lit(-1)) if "n_chars" in docs.columns else F.lit(-1).cast("long")


def _machines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One machine from all rows of ``_featurised``."""
    held = [b for b in batches if len(b)]
    if held:
        found = pa.Table.from_batches(held).combine_chunks()
        lists = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (found["buckets"], found["counts"], found["stats"])]
        sizes = np.diff(np.asarray(lists[0].offsets))
        flat = [np.asarray(x.flatten().to_numpy(zero_copy_only=False)) for x in lists]
        machine = fit_machine(np.repeat(np.arange(len(sizes)), sizes), flat[0], flat[1], flat[2].reshape(-1, len(STATS)), found["label"].to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(machine)], pa.binary())], ["machine"])


def score(docs: DataFrame, machine: Machine, cut: float = CUT) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``cut`` on) of every document.

    Whole texts are read, and ``n_chars`` if ``docs`` has it; nothing else. A null or empty text has no words and the
    statistics of an empty text. Repeated rows are scored each; a null id stays null; other columns are left out; an
    empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # a table of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sent.value.score(*features(data, offsets, told[a:b])))], ["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _n_chars(docs).alias("told")).mapInArrow(run, "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return score(docs, fit(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
