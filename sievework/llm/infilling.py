"""Fill-in-the-middle examples: texts cut into prefix, middle and suffix and put in a new order, by DuckDB inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import slices

#: A unit of cutting: a word with the white space before it, or the white space that ends a text.
TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: What stands before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

#: Placeholders are filled with numbers and quoted text only. Each batch of a task is the table ``batch``.
_SQL = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {token}) AS units, sha256({seed} || ':' || coalesce(doc_id::VARCHAR, '')) AS h FROM batch),
drawn AS (SELECT *, len(units) AS n, list_transform([1, 9, 17, 25], lambda x: ('0x' || substr(h, x, 8))::BIGINT) AS r FROM cut),
bounds AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, {p}) OR contains(text, {s}) OR contains(text, {m}) OR r[3] % 100 >= {rate} THEN 'plain' WHEN r[4] % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, n, form, text, array_to_string(list_slice(units, 1, a), '') AS prefix, array_to_string(list_slice(units, a + 1, b), '') AS middle,
    array_to_string(list_slice(units, b + 1, n), '') AS suffix FROM bounds)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  CASE form WHEN 'plain' THEN text WHEN 'psm' THEN {p} || prefix || {s} || suffix || {m} || middle ELSE {s} || suffix || {p} || prefix || {m} || middle END AS output
FROM parts
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _checked(markers: tuple[str, str, str]) -> tuple[str, str, str]:
    """The markers, if an output can be read back for sure: none may begin as another, or itself, ends."""
    overlaps = [(a, b) for a in markers for b in markers for k in range(1, min(len(a), len(b)) + 1) if a[-k:] == b[:k] and not (a is b and k == len(a))]
    if overlaps or not all(markers) or len(set(markers)) < 3 or any(a in b for a in markers for b in markers if a is not b):
        raise ValueError(f"markers that can't be told apart in an output: {markers}")
    return markers


def fill_in_middle(docs: DataFrame, rate: int = 50, spm: int = 80, seed: int | str = 42, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """One row per document (``doc_id``, ``text``; other columns are left out) with its ``output`` and ``form``.

    ``rate`` percent of the documents are cut at two places between units, drawn from the SHA-256 of seed and id:
    ``spm`` percent of these are written suffix first, the others prefix first. The rest stay plain, as do empty
    texts and those that hold a marker. ``n`` counts units, ``prefix_chars`` and ``middle_chars`` code points (null
    where plain). :func:`restored` gives the text back.

    A null text counts as empty, a null id as an empty one in the hash. Repeated rows come out alike, an empty table
    gives an empty one. A task holds the units of few texts at a time.
    """
    p, s, m = (_quoted(x) for x in _checked(markers))
    sql = _SQL.format(token=_quoted(TOKEN), seed=_quoted(str(seed)), p=p, s=s, m=m, rate=int(rate), spm=int(spm))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(config={"threads": 1, "temp_directory": ""}) as db:
            for part in slices(batches):
                db.register("batch", pa.Table.from_batches([part]))
                yield from db.sql(sql).to_arrow_table().cast(kinds).to_batches()
                db.unregister("batch")

    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output of a form was made of; each marker stands in it once, or the form is plain."""
    p, s, m = (F.lit(x) for x in _checked(markers))
    part = lambda text, mark, n: F.split_part(text, mark, F.lit(n))
    middle = part(output, m, 2)
    psm = F.concat(part(part(output, s, 1), p, 2), middle, part(part(output, s, 2), m, 1))
    spm = F.concat(part(part(output, p, 2), m, 1), middle, part(part(output, p, 1), s, 2))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
numbers AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM units),
formed AS (
  SELECT *, CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    length(array_to_string(u[:least(h1 % (n + 1), h2 % (n + 1))], '')) AS a, length(array_to_string(u[:greatest(h1 % (n + 1), h2 % (n + 1))], '')) AS b FROM numbers),
written AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || left(text, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
    ELSE '<S>' || substr(text, b + 1) || '<P>' || left(text, a) || '<M>' || substr(text, a + 1, b - a) END AS output FROM formed)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM written
"""
