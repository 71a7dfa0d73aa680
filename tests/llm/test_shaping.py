"""Resampling, fill-in-the-middle and SentencePiece: against brute force, against the library, and on odd rows."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.llm import infilling, piecewise, resampling

SF = "/root/testdata/sf0.001"
ODD = [(5, "The quick <b>brown</b> fox " * 8), (5, "The quick <b>brown</b> fox " * 8), (7, None), (None, "Null id here, with words enough " * 5), (8, ""), (9, " \n\t "), (10, "wörter ßtraße 漢字 \U0001f600 x" * 900)]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "doc_id long, text string, row string, bucket int, rank int")


def told(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


# --- resampling


def plain_resample(docs, target, percent, least, most, buckets, seed):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    cut = [(d, *features(t)) for d, t in docs]
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, _, found in cut:
        np.add.at(s, found, 1)
    for text in target:
        np.add.at(t, features(text)[1], 1)
    gain = [math.floor(1000 * math.log(((a + 1.0) * (s.sum() + float(buckets))) / ((b + 1.0) * (t.sum() + float(buckets))))) for a, b in zip(t.tolist(), s.tolist(), strict=True)]
    out, open_ = [], []
    for i, (d, words, found) in enumerate(cut):
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if words >= least:
            open_.append((-out[-1][3], d is not None, d, i))
    for rank, (*_, i) in enumerate(sorted(open_)[: percent * len(open_) // 100], 1):
        out[i][4] = rank
    return sorted((tuple(r) for r in out), key=str)


@pytest.mark.parametrize(("most", "percent", "least", "buckets"), [(1, 10, 20, 10_000), (3, 40, 1, 97), (2, 100, 0, 5)])
def test_resampling_against_brute_force(spark, most, percent, least, buckets):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(120).unionByName(odd(spark).select("doc_id", "text"))
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [tuple(r) for r in docs.collect()]
    want = plain_resample(rows, [r["text"] for r in target.collect()], percent, least, most, buckets, 7)
    assert told(resampling.resample(docs, target, percent, least, most, buckets, 7)) == want


def test_resampling_odd_tables(spark):
    got = told(resampling.resample(odd(spark), odd(spark, []), percent=100, least_words=0))
    assert got == plain_resample(ODD, [], 100, 0, 1, 10_000, 2024)
    assert sorted(r[4] for r in got) == list(range(1, len(ODD) + 1))
    assert told(resampling.resample(odd(spark, []), odd(spark))) == []


def test_ranks_are_whole_however_rows_are_dealt(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 3 == 0).cast("int").alias("same")).repartition(7)  # a third are equal in the first key
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = resampling.ranked(rows, [F.col("same").desc(), F.col("id").asc()]).orderBy("place").collect()
            want = sorted(range(5000), key=lambda i: (i % 3 != 0, i))
            assert [r["id"] for r in got] == want and [r["place"] for r in got] == list(range(1, 5001)) and got[0]["total"] == 5000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_resampling_draws_towards_the_target(spark):
    """Of documents half of which speak as the target does, the sample holds far more than half."""
    words = {"near": "alpha beta gamma delta epsilon zeta", "far": "one two three four five six"}
    docs = spark.createDataFrame([(i, " ".join(np.random.default_rng(i).permutation((words["near" if i % 2 else "far"] + " and the of").split() * 3))) for i in range(400)], "doc_id long, text string")
    target = spark.createDataFrame([((words["near"] + " ") * 40,)], "text string")
    drawn = [r for r in resampling.resample(docs, target).collect() if r["rank"]]
    assert len(drawn) == 40 and sum(r["doc_id"] % 2 for r in drawn) >= 30


# --- fill in the middle


def plain_fim(doc, text, rate=50, spm=80, seed=42, markers=("<P>", "<S>", "<M>")):
    text, (p, s, m) = text or "", markers
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(x in text for x in markers) or h[2] % 100 >= rate:
        return doc, len(units), "plain", None, None, text
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    return doc, len(units), form, len(pre), len(mid), s + suf + p + pre + m + mid if form == "spm" else p + pre + s + suf + m + mid


@pytest.mark.parametrize("options", [{}, {"rate": 100, "spm": 30, "seed": "it's"}, {"rate": 100, "markers": ("[pre]", "[suf]", "[mid]")}])
def test_fill_in_middle_against_brute_force(spark, options):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    docs = docs.unionByName(spark.createDataFrame([(i, t) for i in range(900, 960) for t in ("a <S> b", "a < S> <P <M", " x ", "\x0b\x0c\r", "é\x00ü")], "doc_id long, text string"))
    made = infilling.fill_in_middle(docs, **options)
    rows = [tuple(r) for r in docs.collect()]
    assert told(made) == sorted((plain_fim(*r, **options) for r in rows), key=str)
    back = made.select("doc_id", infilling.restored(F.col("output"), F.col("form"), options.get("markers", infilling.MARKERS)))
    assert told(back) == sorted(((d, t or "") for d, t in rows), key=str)
    assert {r[2] for r in told(made)} == {"plain", "psm", "spm"}


def test_fill_in_middle_odd_tables_and_markers(spark):
    assert told(infilling.fill_in_middle(odd(spark, []))) == []
    assert told(infilling.fill_in_middle(odd(spark))) == sorted((plain_fim(*r) for r in ODD), key=str)
    for bad in [("<a", "<S>", "a<"), ("x", "x", "y"), ("", "a", "b"), ("ab", "abc", "d"), ("aa", "b", "c")]:
        with pytest.raises(ValueError):
            infilling.fill_in_middle(odd(spark), markers=bad)


# --- SentencePiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piecewise.model_path())


def ids(data):
    return np.frombuffer(data, "<i4").tolist()


def fresh():
    return piecewise.encoder(piecewise.model_path())


def test_encoding_of_whole_tables_is_the_librarys(library):
    texts = [r[0] for t in ("documents", "benchmark", "conversations") for r in duckdb.sql(f"SELECT text FROM '{SF}/{t}.parquet'").fetchall()]
    assert [ids(x) for x in fresh().encode(texts)] == library.encode(texts)


def test_runs_and_pieces_in_any_order(library):
    e, draw = fresh(), np.random.default_rng(3)
    names = [x.replace("▁", " ") for x in e.ids]
    texts = [part * n for n in range(70) for part in (" ", "a", "ab", "in ", "▁", "\n", " \n", "漢", "\U0001f600")] + ["x" + " " * n + "y" for n in range(70)]
    texts += ["".join(draw.choice(names, draw.integers(1, 7))) for _ in range(3000)]
    texts += ["".join(draw.choice(list("abcdeinstrho "), draw.integers(1, 40))) for _ in range(3000)]
    assert [ids(x) for x in e.encode(texts)] == library.encode(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])) | st.text("eran tionß▁\n<0x>"), min_size=1, max_size=40))
def test_any_text_alone_and_side_by_side(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=piecewise.model_path())
    e = fresh()
    for some in (texts[:1], texts):
        e.memo, e.held = {}, 0
        assert [ids(x) for x in e.encode(some)] == library.encode(some)


def test_a_long_word_and_a_full_memo(library, monkeypatch):
    e = fresh()
    word = "".join(np.random.default_rng(1).choice(list("abcdeinstrho"), 60_000))
    monkeypatch.setattr(piecewise, "MEMO_BYTES", 1000)
    monkeypatch.setattr(piecewise, "PAIR_SLOTS", len(e.pair_keys))
    for text in (word, "qwertyuiop" * 3000, "a b c " * 500, word):
        assert ids(e.encode([text])[0]) == library.encode(text)
    assert e.held > 1000 and e.encode(["a"]) and e.held < 1000  # it was given up once it was full


def test_the_way_back_is_taken():
    """Greedy longest matches alone give other pieces than merging does, so some words need a step back."""
    e = fresh()
    words = [w for w in " ".join(r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' LIMIT 60").fetchall()).split() if w.isalpha()][:5000]
    changed = 0
    for w in set(words):
        if not all(c in e.ids for c in w):
            continue
        row, longest, at = [], e.longest(w), 0
        while at < len(w):
            row.append(int(longest[at]))
            at += e.plain_size[row[-1]]
        found = e.pieces(w)[0].tolist()
        assert [e.names[i] for i in found] == e.merged(w)
        changed += row != found
    assert changed > 50


def test_encode_and_decode_frames(spark, library):
    got = piecewise.decode(piecewise.encode(odd(spark)))
    want = sorted(((d, library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in ODD), key=str)
    assert sorted(((r["doc_id"], r["ids"], r["text"]) for r in got.collect()), key=str) == want
    assert piecewise.decode(piecewise.encode(odd(spark, []))).collect() == []
    invalid = spark.createDataFrame([(1, [3 + 0xC3, 3 + 0x28, 300]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert told(piecewise.decode(invalid).select("doc_id", "text")) == [(1, library.decode([3 + 0xC3, 3 + 0x28, 300])), (2, ""), (3, None)]


def test_query_digests(spark, library):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(d, len(found := library.encode(t)), sha(",".join(map(str, found))), sha(library.decode(found))) for d, t in docs]
    assert told(piecewise.op13_pieces(spark, SF)) == sorted(want, key=str)


def test_a_model_must_have_its_characters(monkeypatch):
    """A vocabulary in which a character of a piece is no piece is refused rather than encoded otherwise."""
    plain = sentencepiece.SentencePieceProcessor.id_to_piece
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, i: "another e" if plain(self, i) == "e" else plain(self, i))
    with pytest.raises(ValueError, match="must be a piece"):
        piecewise.Encoder(piecewise.model_path())
