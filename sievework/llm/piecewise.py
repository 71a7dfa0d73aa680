"""SentencePiece BPE: exact encoding by backtracking over longest matches, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import slices

#: Bytes of segments and their ids that a worker remembers between batches, and slots for pairs of pieces whose
#: compatibility it remembers (a later pair takes the slot of an earlier one; forgotten pairs are merged anew).
MEMO_BYTES, PAIR_SLOTS = 32 << 20, 1 << 19
#: Stretches of text under which they are no longer encoded side by side but one after another.
SIDE_BY_SIDE = 16
#: How the library writes a space.
SPACE = "▁"


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Encoder:
    """Encodes normalised text with the pieces of a BPE model.

    The library merges, again and again, the neighbours whose joined piece has the highest score, the leftmost of
    equals. A row of pieces is what that gives if and only if each two neighbours stay as they are when merged anew from
    their characters. So pieces are put down from the left, the longest match first; one that its predecessor does not
    admit, or that ends where no way went on, gives way to the longest piece it begins with; if none is left, the last
    piece is taken back and its end is marked as failed. The pieces up to a place are the only ones that fit, so a
    failed place need never be tried again, and the work grows with the length of the text.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        every = range(model.vocab_size())
        self.names = [model.id_to_piece(i) for i in every]
        self.ids = {self.names[i]: i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        self.rank = {name: -model.get_score(i) for name, i in self.ids.items()}
        self.size = np.array([len(name) for name in self.names])
        self.shorter = np.full(len(self.names), -1)
        for name, i in self.ids.items():
            self.shorter[i] = next((self.ids[name[:k]] for k in range(len(name) - 1, 0, -1) if name[:k] in self.ids), -1)
        self.plain_size, self.plain_shorter = self.size.tolist(), self.shorter.tolist()
        bytes_ = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = bytes_ if all(map(model.is_byte, bytes_)) else None
        single = {name for name in self.ids if len(name) == 1}
        if any(c not in single for name in self.ids for c in name):
            raise ValueError(f"{path}: each character of a piece must be a piece")
        self.gap = next(c for c in map(chr, range(0x110000)) if c not in single)
        self.matcher = ahocorasick.Automaton()
        for name, i in self.ids.items():
            self.matcher.add_word(name, i)
        self.matcher.make_automaton()
        self.pair_keys, self.pair_fits = np.full(PAIR_SLOTS, -1), np.zeros(PAIR_SLOTS, bool)
        self.memo: dict[str, bytes] = {}
        self.held = 0
        # Where no piece holds a space after another character, nothing is merged across the start of a run of spaces.
        stops = "".join(re.escape(c) for c in "\n\r\t" if c not in single) if self.bytes else ""
        self.cuts = re.compile(f"{SPACE}*[^{SPACE}{stops}]+|{SPACE}+" + (f"|[{stops}]" if stops else ""))
        if any(SPACE in name.lstrip(SPACE) for name in self.ids):
            self.cuts = re.compile("(?s).+")

    def merged(self, text: str) -> list[str]:
        """The pieces by merging from characters, the best pair first: for the few characters of two pieces."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each ``piece`` can stand after its ``last`` (-1: at the start), by ids."""
        keys = (last + 1) * len(self.names) + piece
        slots = (keys * 0x9E3779B1 >> 12) % PAIR_SLOTS
        known = self.pair_keys[slots] == keys
        out = self.pair_fits[slots]
        if not known.all():
            new, which = np.unique(keys[~known], return_inverse=True)
            before, after = np.divmod(new, len(self.names))
            names = [([self.names[a - 1]] if a else []) + [self.names[b]] for a, b in zip(before.tolist(), after.tolist(), strict=True)]
            told = np.array([self.merged("".join(x)) == x for x in names])
            out[~known] = told[which]
            self.pair_keys[slots[~known]], self.pair_fits[slots[~known]] = keys[~known], out[~known]
        return out

    def longest(self, text: str) -> np.ndarray:
        """For each place of a text the longest piece that starts there; -1 at a character without a piece."""
        out, size = [-1] * len(text), self.plain_size
        for end, i in self.matcher.iter(text):
            out[end + 1 - size[i]] = i  # matches with one start come in the order of their ends
        return np.array(out, np.int64)

    def pieces(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of a text by id, and the last character of each; characters without a piece are left out.

        The stretches between such characters are encoded side by side, each with its own place and candidate;
        ``ending`` holds the piece that ends at a place, so it is also the way back.
        """
        longest = self.longest(text)
        known = np.concatenate([[False], longest >= 0, [False]])
        start, stop = np.flatnonzero(~known[:-1] & known[1:]), np.flatnonzero(known[:-1] & ~known[1:])
        ending, failed, longest = np.full(len(text) + 1, -1), np.zeros(len(text) + 1, bool), np.append(longest, -1)
        at, until, piece = start.copy(), stop, longest[start]
        while len(at) >= SIDE_BY_SIDE:
            last, end = ending[at], at + self.size[piece]
            ok = ~failed[end]
            ok[ok] = self.fits(last[ok], piece[ok])
            ending[end[ok]] = piece[ok]
            other = self.shorter[piece]
            back = ~ok & (other < 0)  # nothing goes on from here: the last piece is tried again, and its end has failed
            failed[at[back]] = True
            at = np.where(ok, end, np.where(back, at - self.size[last], at))
            piece = np.where(ok, longest[at], np.where(back, last, other))
            going = at < until
            at, until, piece = at[going], until[going], piece[going]
        for a, b in zip(at.tolist(), until.tolist(), strict=True):
            self._alone(a, b, longest, ending, failed)
        kept, at, first = np.zeros(len(text) + 1, bool), stop, start
        while len(at):
            kept[at] = True
            at = at - self.size[ending[at]]
            at, first = at[at > first], first[at > first]
        ends = np.flatnonzero(kept)
        return ending[ends], ends - 1

    def _alone(self, at: int, until: int, longest: np.ndarray, ending: np.ndarray, failed: np.ndarray) -> None:
        """One stretch from where it stands; the same steps as side by side."""
        start = at
        while start and ending[start] >= 0:
            start -= int(self.size[ending[start]])
        size, shorter, best = self.plain_size, self.plain_shorter, longest[start : until + 1].tolist()
        known: dict[tuple[int, int], bool] = {}
        bits = bytearray(np.packbits(failed[start : until + 1], bitorder="little").tobytes())
        row, at, piece, until = [], 0, best[0], until - start
        while at < until:
            end, last = at + size[piece], row[-1] if row else -1
            ok = not bits[end >> 3] >> (end & 7) & 1
            if ok and (ok := known.get((last, piece))) is None:
                ok = known[last, piece] = bool(self.fits(np.array([last]), np.array([piece]))[0])
            if ok:
                row.append(piece)
                ending[start + end] = piece
                at, piece = end, best[end]
            elif shorter[piece] >= 0:
                piece = shorter[piece]
            else:
                bits[at >> 3] |= 1 << (at & 7)
                piece = row.pop()
                at -= size[piece]

    def learn(self, segments: list[str]) -> None:
        """Encodes segments of normalised text into the memo."""
        text = self.gap.join(segments)
        ids, at = self.pieces(text)
        stops = np.cumsum([len(x) + 1 for x in segments])  # the place after the character that parts a segment from the next
        odd = np.ones(len(text), bool)
        for shift in range(int(self.size.max())):
            covered = at[self.size[ids] > shift] - shift
            odd[covered] = False
        odd[stops[:-1] - 1] = False
        odd = np.flatnonzero(odd)
        if len(odd):
            if self.bytes:
                spelt = [[self.bytes[b] for b in text[i].encode()] for i in odd.tolist()]
            else:  # the library joins unknown characters that stand together
                odd = odd[np.diff(odd, prepend=-2) > 1]
                spelt = [[self.model.unk_id()]] * len(odd)
            at = np.concatenate([at, np.repeat(odd, [len(x) for x in spelt])])
            order = np.argsort(at, kind="stable")
            ids, at = np.concatenate([ids, [i for x in spelt for i in x]])[order], at[order]
        data, bounds = ids.astype("<i4").tobytes(), (4 * np.searchsorted(at, np.append(0, stops))).tolist()
        self.memo.update(zip(segments, (data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)), strict=True))
        self.held += len(data) + len(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """All ids of each text (little-endian, 32 bits). The library's own normaliser writes the spaces."""
        if self.held > MEMO_BYTES:
            self.memo, self.held = {}, 0
        cut = [self.cuts.findall(self.model.normalize(x)) if x else () for x in texts]
        if new := list({x for segments in cut for x in segments} - self.memo.keys()):
            self.learn(new)
        return [b"".join([self.memo[x] for x in segments]) for segments in cut]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a model, made once for each worker process."""
    return _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document (``doc_id``, ``text``; other columns are left out): ``doc_id`` and ``ids``, an array of all ids.

    ``path`` names a BPE model of the sentencepiece library, which must lie there on every machine. The ids are those
    of its ``encode``, without begin or end. A null or empty text has none; a null id stays null; repeated rows come
    out alike; an empty table gives an empty one. The longest text of a batch is encoded whole, in memory that grows
    with its own length.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in slices(batches):
            each = known.encode(batch.column(1).to_pylist())
            starts = np.cumsum([0, *map(len, each)], dtype=np.int64) // 4
            ids = pa.Array.from_buffers(pa.int32(), int(starts[-1]), [None, pa.py_buffer(b"".join(each))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``text`` to rows of ``doc_id`` and ``ids``, by the library's ``decode``; null ids give a null text."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in slices(batches):
            texts = [None if ids is None else known.decode(ids.tolist()) for ids in (x.values and x.values.to_numpy() for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
