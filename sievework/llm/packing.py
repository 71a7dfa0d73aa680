"""Packing tokenised documents into fixed-length sequences by a configuration linear program."""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import materialize

#: Words whose tokens a worker remembers; more are encoded again each time they come.
MEMO_WORDS = 120_000
#: Share of the lower bound by which the linear program's solution may exceed it, the rounds in a row that
#: must better nothing to end it sooner, and the strength with which empty room raises prices.
GAP, STALL, STEP = 0.002, 20, 1.0
#: Groups in which the pieces of one length are numbered, at least, and pieces of such a group beyond which there
#: are more groups: a common length is no single task, however many pieces have it.
SALTS, SALT_ROWS = 64, 10_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Letters whose lower case, composed form and byte-level form are plain, then marks that form one run.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level BPE writes the bytes 0 to 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds(dict):
    """Token ids (little-endian unsigned 32 bit) of a piece of text without white space, by its UTF-8 bytes.

    The tokenizer cuts at white space, so a text's ids are those of its words one after another. Words
    of plain letters and marks go straight to its BPE model; all others take its whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.parts = self.tokenizer.model, _byte_letters(), {}

    def part(self, text: str) -> bytes:
        written = text if text.isascii() else "".join([self.letters[b] for b in text.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(written)])

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if plain := _PLAIN.fullmatch(text):
            word_, marks = plain.groups()
            if marks not in self.parts:
                self.parts[marks] = self.part(marks) if marks else b""
            ids = (self.part(word_.lower()) if word_ else b"") + self.parts[marks]
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < MEMO_WORDS and len(word) <= 40:
            self[word] = ids
        return ids


_WORD_IDS: dict[str, WordIds] = {}


def token_ids(text: str | None, path: str) -> bytes:
    """All ids of a text, then id 1."""
    known = _WORD_IDS.get(path) or _WORD_IDS.setdefault(path, WordIds(path))
    return b"".join([known[w] for w in (text or "").encode().split()]) + b"\x01\0\0\0"


def tokenize_pieces(docs: DataFrame, capacity: int, path: str) -> DataFrame:
    """One row per piece: only documents longer than ``capacity`` are cut, into pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(text.as_py(), path)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for col, x in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        col.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


Patterns = list[tuple[int, np.ndarray, np.ndarray]]
#: A sequence's content: (which length, how often) pairs.
Pattern = tuple[tuple[int, int], ...]


def _knapsack(lengths: np.ndarray, worth: np.ndarray, which: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """The worth of the best filling of every room up to ``capacity`` by the lengths ``which``, and one length in it (-1: none)."""
    lengths, worth = lengths[which], worth[which]
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], last[c] = best[c - 1], last[c - 1]
        if k := upto[c]:
            value = best[c - lengths[:k]] + worth[:k]
            if value[i := int(value.argmax())] > best[c]:
                best[c], last[c] = value[i], which[i]
    return best, last.tolist()


def _least(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> float:
    """A number of sequences that no fractional solution goes below (Martello and Toth, over all thresholds).

    At threshold k lengths over ``capacity - k`` need a sequence each, lengths under k cost nothing, and what
    lies between costs its share, a sequence at least for each length over one half.
    """
    number = np.zeros(capacity + 2)
    number[lengths + 1] = counts
    upto, mass = np.cumsum(number), np.cumsum(number * np.maximum(np.arange(capacity + 2) - 1, 0))
    half = capacity // 2
    k = np.arange(half + 1)
    alone, pairs = upto[-1] - upto[capacity - k + 1], upto[capacity - k + 1] - upto[half + 1]
    spare = pairs * capacity - (mass[capacity - k + 1] - mass[half + 1])
    small = mass[half + 1] - mass[k]
    return float((alone + pairs + np.maximum(small - spare, 0) / capacity).max())


def _covering(lengths: np.ndarray, counts: np.ndarray, capacity: int, worth: np.ndarray) -> tuple[dict[Pattern, float], np.ndarray, float]:
    """A fractional solution that covers each length exactly, each length's mean empty share, and a lower bound.

    From the longest length down, a sequence takes that length and then what the knapsack prices highest
    among lengths still open; it is used as often as all its lengths are. The knapsack is solved again
    whenever a tenth of the lengths have closed. Where its choice has closed since, the longest open
    length that fits stands in.
    """
    sizes, most, left = lengths.tolist(), counts.tolist(), counts.astype(float).tolist()
    best, last = _knapsack(lengths, worth, np.arange(len(lengths)), capacity)
    bound = float(worth @ counts / best[capacity])
    open_, solved, use, empty = list(range(len(lengths))), len(lengths), {}, np.zeros(len(lengths))
    while open_:
        if len(open_) < 0.9 * solved:
            (_, last), solved = _knapsack(lengths, worth, np.array(open_), capacity), len(open_)
        often, room, i = {}, capacity, open_[-1]
        while i >= 0:
            often[i] = often.get(i, 0) + 1
            room -= sizes[i]
            i = last[room]
            if i < 0 or often.get(i, 0) >= left[i]:
                at = bisect.bisect_right(open_, room, key=sizes.__getitem__) - 1
                while at >= 0 and often.get(open_[at], 0) >= left[open_[at]]:
                    at -= 1
                i = open_[at] if at >= 0 else -1
        times = min(left[j] / k for j, k in often.items())
        pattern = tuple(sorted(often.items()))
        use[pattern] = use.get(pattern, 0.0) + times
        for j, k in pattern:
            left[j] -= times * k
            empty[j] += times * k / most[j] * room / capacity
            if left[j] <= 1e-9 * most[j]:
                left[j] = 0.0
                del open_[bisect.bisect_left(open_, j)]
    return use, empty, bound


def linear_program(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[dict[Pattern, float], float]:
    """How often each pattern is used, fractionally, and a lower bound on the number of sequences.

    Every round covers each length exactly. The rounds go on, prices rising by multiplicative weights where
    sequences stay emptier, until the best of them is within ``GAP`` of the bound, or within one sequence;
    they also end when ``STALL`` of them in a row better neither side, and the gap is then larger.
    """
    worth, bound, found, value, idle = lengths / capacity, _least(lengths, counts, capacity), {}, np.inf, 0
    while value - bound > max(1.0, GAP * bound) and idle < STALL:
        use, empty, below = _covering(lengths, counts, capacity, worth)
        idle += 1
        if below > bound + 1e-9:
            bound, idle = below, 0
        if (total := sum(use.values())) < value - 1e-9:
            found, value, idle = use, total, 0
        worth = worth * np.exp(STEP * empty)
        worth /= worth.max()
    return found, bound


def _fill(lengths: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """A sequence filled from the longest remaining length down, each time with the longest that fits."""
    times, room = np.zeros(len(lengths), np.int64), capacity
    left = left.copy()
    while True:
        fits = np.flatnonzero((left > 0) & (lengths <= room))
        if not len(fits):
            return times
        i = fits[-1]
        n = min(int(left[i]), int(room // lengths[i]))
        times[i] += n
        left[i] -= n
        room -= n * int(lengths[i])


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Patterns:
    """How many sequences have each pattern: (number, which lengths, how often each stands in a sequence).

    Together they hold each length exactly ``counts`` times.

    The linear program is solved at every size. Its solution is rounded down to whole sequences; then, the
    largest rest first and the fuller of equal ones, patterns whose rest is one half or more are used once
    more where the counts allow. Only what remains is filled best-fit, longest first. The work depends on the number of lengths, at most
    ``capacity``, not on the number of documents.
    """
    lengths, left = np.asarray(lengths, np.int64), np.asarray(counts, np.int64).copy()
    out: Patterns = []
    if not len(lengths):
        return out

    def use(n: int, which: np.ndarray, often: np.ndarray) -> None:
        out.append((n, which, often))
        left[which] -= n * often

    found, _ = linear_program(lengths, left, capacity)
    patterns = [(x + 1e-6, *np.array(p, np.int64).T) for p, x in found.items()]
    for x, which, often in patterns:
        if x >= 1:
            use(int(x), which, often)
    rests = [(x % 1, int(lengths[which] @ often), which, often) for x, which, often in patterns if x % 1 >= 0.5]
    for _, _, which, often in sorted(rests, key=lambda r: (-round(r[0], 6), -r[1])):
        if (left[which] >= often).all():
            use(1, which, often)
    while left.any():
        p = _fill(lengths, left, capacity)
        which = np.flatnonzero(p)
        use(int((left[which] // p[which]).min()), which, p[which])
    return out


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (any rows with ``doc_id``, ``piece``, ``length``).

    The histogram of lengths, at most ``capacity`` rows, goes to the driver; its solution gives, for every
    length, ranges of numbered slots. Pieces of one length are numbered in salted groups, more for a common length.
    """
    spark = pieces.sparkSession
    lengths = materialize(pieces.groupBy("length").count(), "pack-lengths")
    hist = np.array(lengths.orderBy("length").collect(), np.int64).reshape(-1, 2)
    salts = F.broadcast(lengths.select("length", F.greatest(F.lit(SALTS), F.ceil(F.col("count") / SALT_ROWS)).alias("salts")))  # ``capacity`` rows at most
    pieces = pieces.join(salts, "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts")).cast("int")).drop("salts")
    groups = pieces.groupBy("length", "salt").count()
    slots, seen, base = [], dict.fromkeys(hist[:, 0].tolist(), 0), 0
    for n, which, often in solve(hist[:, 0], hist[:, 1], capacity):
        offset = 0
        for i, times in zip(which[::-1].tolist(), often[::-1].tolist(), strict=True):
            length = int(hist[i, 0])
            slots.append((length << 44 | seen[length], times, base, offset))
            seen[length] += n * times
            offset += times * length
        base += n
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    sent = spark.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    numbered = pieces.withColumn("rank", rank).join(starts, ["length", "salt"]).withColumn("rank", F.col("first") + F.col("rank") - 1).drop("first", "salt")
    names = numbered.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, n = (batch.column(names.index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            rows = sent.value[np.searchsorted(sent.value[:, 0], length << 44 | n, side="right") - 1]
            n = n - (rows[:, 0] & (1 << 44) - 1)
            kept = [i for i, c in enumerate(names) if c != "rank"]
            added = [pa.array(rows[:, 2] + n // rows[:, 1]), pa.array(rows[:, 3] + n % rows[:, 1] * length)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *added], [*(names[i] for i in kept), "sequence_id", "offset"])

    schema = numbered.drop("rank").withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return numbered.mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int = 4096, path: str | None = None) -> DataFrame:
    """Packs documents (``doc_id``, ``text``; other columns are left out) into sequences of ``capacity`` tokens.

    A null or empty text is the one id 1. Repeated rows are packed each. A null id stays null. Within a
    sequence the pieces stand without gaps from offset 0. An empty table gives an empty result.
    """
    pieces = materialize(tokenize_pieces(docs, capacity, path or tokenizer_path()), "pack-pieces")
    return place(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
