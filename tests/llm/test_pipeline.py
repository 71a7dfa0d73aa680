"""The pipeline, stage by stage, on a small table."""

import zlib

import corpus_pipeline as c
import pytest

from tests.llm.test_operators import PROSE, SCHEMA, rows, words

COLUMNS = c.COLUMNS


@pytest.fixture(scope="module")
def docs(spark):
    prose = [(300 + i, PROSE.replace("and", f"og{i}"), "en", "a", 0, None, None, None, None) for i in range(40)]
    return spark.createDataFrame([*rows(), *prose], SCHEMA)


def test_stages_keep_the_columns_and_take_effect(spark, docs):
    texts = docs.select("text")
    clean = c.secret_scan(spark, docs, "")
    assert clean.columns == COLUMNS and clean.count() == docs.count()
    assert clean.filter("text LIKE '%[SECRET]%'").count() == 1
    assert clean.filter("n_chars <> length(text)").count() == 0
    single = c.near_duplicates(spark, docs, "")
    assert single.columns == COLUMNS and single.select("doc_id").distinct().count() == single.count() < texts.count()
    mixed = c.mixture(spark, docs, "")
    assert mixed.columns == COLUMNS and mixed.groupBy("doc_id").count().filter("count > 6").count() == 0
    assert c.language(spark, docs, "").columns == COLUMNS
    packed = c.packed(spark, mixed, "")
    assert packed.filter("offset + length > 4096").count() == 0


def test_an_empty_table_passes_through(spark, docs):
    for _, stage in c.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0


ODD = [(None, "quite other words of a row without any number " * 3), (None, "something else again that has no number either and goes on " * 3), (5, "a second text under number five which differs in every word from the first one " * 2), (5, "a third text of the same number " * 4), (None, None), (301, "")]


def test_run_equals_brute_force(spark, docs, tmp_path):
    """Every stage worked out row by row in plain Python (the mixture in SQL), with the same fitted models.

    Null and repeated ids, null and empty texts and whole rows that repeat go through all stages.
    """
    import hashlib
    from collections import Counter

    import duckdb
    from tokenizers import Tokenizer

    from sievework.llm import langid, mixing, packing, secrets
    from tests.llm.test_operators import slow_fingerprint

    odd = spark.createDataFrame([(d, t, "en", "b", 0) for d, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    docs.select(COLUMNS).unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in c.run(spark, str(tmp_path)).collect())

    scorer = langid.Scorer(langid.fit(table))
    left = [r.asDict() for r in table.collect() if not scorer.predict(r["text"])[3]]
    assert sum(r["doc_id"] is None for r in left) >= 3 and sum(r["doc_id"] == 5 for r in left) >= 3
    prints = sorted({slow_fingerprint(r["text"]) for r in left})
    label = {p: p for p in prints}
    for _ in prints:
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    kept = {}
    for r in left:
        key = (r["doc_id"] is None, r["doc_id"] or 0, hashlib.sha256((r["text"] or "").encode()).hexdigest())
        group = label[slow_fingerprint(r["text"])]
        if group not in kept or key < kept[group][0]:
            kept[group] = key, r
    left = [r for _, r in kept.values()]
    forest = secrets.fit(spark)
    for r in left:
        for a, b, _, p in reversed(secrets.scan(r["text"], r["source"], forest)):
            if p >= 0.5:
                r["text"] = r["text"][:a] + "[SECRET]" + r["text"][b:]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r["doc_id"], r["text"], r["source"]) for r in left])
    found = db.execute(mixing.OP2_SQL)
    names = [d[0] for d in found.description]
    copies = {}
    for r in found.fetchall():
        d, size, taken = (r[names.index(k)] for k in ("doc_id", "size", "taken"))
        copies.setdefault((d, size), []).append(taken // size)
    assert all(len(set(x)) == 1 for x in copies.values())
    tok, want = Tokenizer.from_file(packing.tokenizer_path()), Counter()
    for r in left:
        ids = [*tok.encode(r["text"], add_special_tokens=False).ids, 1]
        times = copies[(r["doc_id"], len(words(r["text"])))][0]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[(r["doc_id"], piece, start, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))] += times
    assert got == +want
