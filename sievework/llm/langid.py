"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import held_out, hash_unit, slices

#: Characters of an n-gram; each takes 16 bits of its key.
ORDER, BITS = 4, 16
#: Documents of each language from which the model is fitted (the expected number; chosen by a hash of the
#: id), of which one in four only calibrates the rejection.
DOCS_PER_LANGUAGE = 400
#: Languages that one model may hold: each is some megabytes, on the driver and in every worker.
MAX_LANGUAGES = 200
#: Standard deviations above a language's usual cross-entropy at which a document is rejected, and documents from
#: which a language's own deviation is taken; with fewer, it is the largest of all languages.
REJECT_AT, CALIBRATORS = 10.0, 5
#: Probabilities that a worker remembers (one for each n-gram and language), and characters scored at a time.
MEMO, CHUNK = 2_000_000, 1 << 16

_SPACE, _WIDE = 32, 0xFFFF
_CLASSES: list[np.ndarray] = []


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Each character below 65,536: its lower case if it is a letter (or a mark on one), else a space; and whether it is a letter."""
    if not _CLASSES:
        out = np.full(1 << BITS, _SPACE, np.uint16)
        for c in range(128, 0xD800):
            if unicodedata.category(chr(c))[0] in "LM":
                out[c] = min(ord(chr(c).lower()[0]), _WIDE)
        for c in range(0xF900, 0xFFFD):
            if unicodedata.category(chr(c))[0] in "LM":
                out[c] = min(ord(chr(c).lower()[0]), _WIDE)
        for c in range(128):
            if chr(c).isalpha():
                out[c] = ord(chr(c).lower())
        _CLASSES.extend((out, np.array([unicodedata.category(chr(c))[0] == "L" for c in range(1 << BITS)])))
    return _CLASSES[0], _CLASSES[1]


def letters(text: str | None) -> np.ndarray:
    """The text as lower-case letters, every run of other characters one space, after three spaces.

    Empty if there is no letter: marks alone are none. Letters beyond 65,536 count as one letter.
    """
    code = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    lower, is_letter = _classes()
    low = np.minimum(code, (1 << BITS) - 1)
    out = lower[low]
    wide = np.flatnonzero(code >= 1 << BITS)
    if len(wide):
        kinds, which = np.unique(code[wide], return_inverse=True)
        out[wide] = np.array([_WIDE if chr(c).isalpha() else _SPACE for c in kinds.tolist()], np.uint16)[which]
    if not is_letter[low].any() and not (out[wide] == _WIDE).any():
        return out[:0]
    space = out == _SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first of each run of spaces
    keep[0] = not space[0]
    return np.concatenate([np.full(ORDER - 1, _SPACE, np.uint16), out[keep]])


def _keys(seq: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each character from the ``ORDER``-th on, the last character lowest."""
    wide = seq.astype(np.uint64)
    out = wide[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        out |= wide[ORDER - 1 - k : len(wide) - k] << np.uint64(BITS * k)
    return out


def _mask(n: int) -> np.uint64:
    return np.uint64((1 << (BITS * n)) - 1)


def _hash(keys: np.ndarray) -> np.ndarray:
    """A mixing of the key's bits that loses none, so distinct n-grams have distinct hashes."""
    x = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def _unhash(hashes: np.ndarray) -> np.ndarray:
    """The keys of hashes."""
    x = hashes ^ (hashes >> np.uint64(27)) ^ (hashes >> np.uint64(54))
    x = x * np.uint64(pow(0x7FB5D329728EA185, -1, 1 << 64))
    return x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True)


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """For each order from 1: (n-grams, discounted shares, contexts, weights of the order below)."""
    out = []
    for n in range(ORDER, 0, -1):
        ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
        discount = min(max(ones / (ones + 2 * twos), 0.1), 0.95) if ones else 0.5
        contexts, of = _grouped(keys >> np.uint64(BITS))
        sums, kinds = np.bincount(of, counts), np.bincount(of)
        out.append((keys, np.maximum(counts - discount, 0) / sums[of], contexts, discount * kinds / sums))
        keys, of = _grouped(keys & _mask(n - 1))  # below, a count is the number of distinct characters before
        counts = np.bincount(of)
    return out[::-1]


def language_tables(keys: np.ndarray, counts: np.ndarray) -> list[list[np.ndarray]]:
    """A language's sorted hash arrays: for each order n-grams, their shares, contexts and their weights."""
    out = []
    for grams, shares, contexts, weights in kneser_ney(keys, counts):
        a, b = _hash(grams), _hash(contexts)
        i, j = np.argsort(a), np.argsort(b)
        out.append([a[i], shares[i].astype(np.float32), b[j], weights[j].astype(np.float32)])
    return out


@dataclass
class Model:
    """Of each language the sorted hash arrays of every order, and how its texts usually score.

    A language holds its own n-grams only, so the model grows with the n-grams that it has seen.
    """

    languages: list[str]
    tables: list[list[list[np.ndarray]]]
    usual: np.ndarray | None = None
    between: np.ndarray | None = None
    within: np.ndarray | None = None

    def __post_init__(self):
        letters_ = np.unique(np.concatenate([np.zeros(0, np.uint64), *(t[0][0] for t in self.tables)]))
        self.floor = 1.0 / (1 + len(letters_))

    @staticmethod
    def fit(per_language: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
        """From each language's distinct n-grams and their counts."""
        return Model(sorted(per_language), [language_tables(*per_language[x]) for x in sorted(per_language)])

    def known(self) -> np.ndarray:
        """All n-grams of the highest order."""
        return _unhash(np.unique(np.concatenate([np.zeros(0, np.uint64), *(t[-1][0] for t in self.tables)])))

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Minus log2 of each n-gram's interpolated probability, per language."""
        wanted = [(_hash(keys & _mask(n)), _hash((keys & _mask(n)) >> np.uint64(BITS))) for n in range(1, ORDER + 1)]
        out = np.empty((len(keys), len(self.languages)))
        for j, table in enumerate(self.tables):
            p = np.full(len(keys), self.floor)
            for (gram, context), (grams, shares, contexts, weights) in zip(wanted, table, strict=True):
                p = _look_up(grams, shares, gram, 0.0) + _look_up(contexts, weights, context, 1.0) * p
            out[:, j] = p
        return -np.log2(out)


def _look_up(hashes: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(hashes):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return np.where(hashes[at] == wanted, values[at], default)


class Scorer:
    """Scores texts; remembers the n-grams that it has met, sorted by hash behind a table of the hash's top bits."""

    def __init__(self, model: Model):
        self.model = model
        self._remember(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros((0, len(model.languages))))
        known = model.known()[: MEMO // max(1, len(model.languages))]
        for a in range(0, len(known), CHUNK):
            self._add(known[a : a + CHUNK], model.bits(known[a : a + CHUNK]))

    def _remember(self, hashes: np.ndarray, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(len(hashes)).bit_length() + 2)
        self.hashes, self.keys, self.values, self.shift = hashes, keys, values, np.uint64(64 - bits)
        self.start = np.zeros((1 << bits) + 1, np.int32)
        np.cumsum(np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << bits), out=self.start[1:])

    def _add(self, keys: np.ndarray, values: np.ndarray) -> None:
        if len(self.keys) + len(keys) > MEMO // max(1, len(self.model.languages)):
            self._remember(self.hashes[:0], self.keys[:0], self.values[:0])
        hashes = _hash(keys)
        order = np.argsort(hashes)
        place = np.searchsorted(self.hashes, hashes[order])
        self._remember(np.insert(self.hashes, place, hashes[order]), np.insert(self.keys, place, keys[order]), np.insert(self.values, place, values[order], axis=0))

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash in the sorted array, and which are not there."""
        top = (hashes >> self.shift).astype(np.int64)
        at, n = self.start.take(top, mode="clip").astype(np.int64), len(self.hashes)
        missing = np.flatnonzero(self.hashes.take(at, mode="clip") != hashes) if n else np.arange(len(hashes))
        end = self.start[top[missing] + 1]
        none = []
        while len(missing):
            at[missing] += 1
            over = at[missing] >= end
            none.append(missing[over])
            missing, end = missing[~over], end[~over]
            still = self.hashes[at[missing]] != hashes[missing]
            missing, end = missing[still], end[still]
        return at, np.concatenate([np.zeros(0, np.int64), *none])

    def _bits(self, keys: np.ndarray) -> np.ndarray:
        hashes = _hash(keys)
        at, none = self._find(hashes)
        if not len(none):
            return self.values.take(at, axis=0, mode="clip")
        new, of = np.unique(keys[none], return_inverse=True)
        found = self.model.bits(new)
        at[none] = 0
        out = self.values[at] if len(self.values) else np.empty((len(keys), len(self.model.languages)))
        out[none] = found[of]
        self._add(new, found)
        return out

    def totals(self, seq: np.ndarray, squared: bool = False) -> tuple[int, np.ndarray, np.ndarray]:
        """Characters scored, and the sums of their bits (and squared bits) per language."""
        n, total, squares = 0, np.zeros(len(self.model.languages)), np.zeros(len(self.model.languages))
        for a in range(0, len(seq) - ORDER + 1, CHUNK):
            bits = self._bits(_keys(seq[a : a + CHUNK + ORDER - 1]))
            ones = np.ones(len(bits))
            n, total = n + len(bits), total + ones @ bits
            if squared:
                squares += ones @ bits**2
        return n, total, squares

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """Language, score, cross-entropy (bits a character) and whether it is rejected."""
        m, seq = self.model, letters(text)
        if not len(seq) or not m.languages:
            return "und", 0.0, None, True
        n, total, _ = self.totals(seq)
        bits = total / n
        best = int(bits.argmin())
        share = np.exp2(-(total - total[best]) * min(1.0, 60 / n))  # of characters beyond 60, more is not surer
        limit = np.inf
        if m.usual is not None:
            limit = m.usual[best] + REJECT_AT * np.sqrt(m.between[best] ** 2 + m.within[best] ** 2 / n)
        return m.languages[best], float(1 / share.sum()), float(bits[best]), bool(bits[best] > limit)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            seq = letters(text.as_py())
            for a in range(0, len(seq) - ORDER + 1, CHUNK):
                keys, counts = np.unique(_keys(seq[a : a + CHUNK + ORDER - 1]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])


#: Hashes of n-grams, shares, hashes of contexts, weights.
_TABLE = (np.uint64, np.float32, np.uint64, np.float32)


def _fitted(rows: pa.Table) -> pa.Table:
    """The tables of one language, a row for each order."""
    tables = language_tables(rows["gram"].to_numpy().view(np.uint64), rows["n"].to_numpy())
    columns = [pa.array([t[i].tobytes() for t in tables], pa.binary()) for i in range(len(_TABLE))]
    return pa.table([pa.array([rows["lang"][0].as_py()] * len(tables)), *columns, pa.array(range(len(tables)), pa.int32())], ["lang", "t0", "t1", "t2", "t3", "level"])


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """A model of the languages in ``lang``, from whole texts that are not held out.

    The number of documents of each language is bounded by ``docs_per_language``. Their n-grams are counted
    and each language's tables are worked out on the executors, a task for a language; the driver gathers the
    tables of at most ``MAX_LANGUAGES``. One in four of the sample is scored with the model to learn each
    language's usual cross-entropy; if all of these are missing, nothing is rejected but texts without a letter.
    Rows with a null id, text or language teach nothing; without any a model of no language results.
    """
    spark = docs.sparkSession
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Model([], [], [], 1.0)
    rates = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, docs_per_language / r["count"]))])
    sample = known.filter(F.col("text").isNotNull() & (hash_unit(F.lit("language"), F.col("doc_id")) < F.element_at(rates, F.col("lang"))))
    spare = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    counts = sample.filter(~spare).select("lang", "text").mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    fitted = counts.groupBy("lang").applyInArrow(_fitted, "lang string, t0 binary, t1 binary, t2 binary, t3 binary, level int").orderBy("lang", "level").collect()
    per_language: dict[str, list] = {}
    for row in fitted:
        per_language.setdefault(row["lang"], []).append([np.frombuffer(row[f"t{i}"], t) for i, t in enumerate(_TABLE)])
    model = Model(sorted(per_language), [per_language[x] for x in sorted(per_language)])
    _calibrate(spark, model, sample.filter(spare))
    return model


def _calibrate(spark: SparkSession, model: Model, sample: DataFrame) -> None:
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seq = letters(text.as_py())
                if len(seq) and lang in sent.value.languages:
                    j = sent.value.languages.index(lang)
                    n, total, squares = scorer.totals(seq, squared=True)
                    out.append({"lang": lang, "n": n, "bits": total[j] / n, "var": max(squares[j] / n - (total[j] / n) ** 2, 0.0)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("lang", pa.string()), ("n", pa.int64()), ("bits", pa.float64()), ("var", pa.float64())]))

    seen = sample.select("lang", "text").mapInArrow(run, "lang string, n long, bits double, var double")
    long = F.when(F.col("n") >= 100, F.col("bits"))
    rows = {r["lang"]: r for r in seen.groupBy("lang").agg(F.count("*").alias("docs"), F.median(F.coalesce(long, F.col("bits"))).alias("usual"), F.stddev_pop(long).alias("between"), F.avg("var").alias("var")).collect()}
    if not rows:
        return
    most = {k: max(r[k] or 0.0 for r in rows.values()) for k in ("usual", "between", "var")}
    few = {"docs": 0, "usual": most["usual"], "between": 0.0, "var": most["var"]}
    told = [rows.get(x, few) for x in model.languages]
    model.usual = np.array([r["usual"] for r in told], float)
    model.between = np.array([max(r["between"] or 0.0, 0.05, most["between"] if r["docs"] < CALIBRATORS else 0.0) for r in told], float)
    model.within = np.array([np.sqrt(r["var"] or 1.0) for r in told], float)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` and ``rejected`` of every document.

    The language with the lowest cross-entropy per character of the whole text wins; equal ones go to the
    first by name. A null text or one without a letter is ``und``, score 0 and rejected, as is every text
    if no language was learnt. Repeated rows are judged each; a null id stays null. Other columns are left out;
    an empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            found = [scorer.predict(t.as_py()) for t in batch.column(1)]
            cols = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def drop_unidentified(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose language is not rejected, with all their columns; each row is judged on its own text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in slices(batches):
            yield batch.filter(pa.array([not scorer.predict(t.as_py())[3] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
