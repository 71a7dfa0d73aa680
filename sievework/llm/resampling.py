"""Target-distribution importance resampling over hashed n-grams (DataFrame functions only).

Documents are drawn by Gumbel noise on top of a weight, the mean gain of their n-grams: the log of a bucket's share
among target texts over its share among all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import materialize

#: A word of lower-cased text (letters and digits of ASCII, and all beyond ASCII).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Gains, noise and scores are whole numbers of this part of a natural logarithm, so that sums do not depend on their order.
UNIT = 1000
#: A document's place in its partition, in the lower bits of what ``monotonically_increasing_id`` gives.
_PLACE_BITS = 33


def with_buckets(texts: DataFrame, most: int, buckets: int) -> DataFrame:
    """Adds ``n_words`` and ``buckets``, those of all runs of 1 to ``most`` consecutive words, to rows with ``text``; none of a null."""
    found = F.coalesce(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))
    cut = texts.withColumn("words", found)  # a column of its own: worked out once, not for each run
    hashed = F.transform(_runs(F.col("words"), most), lambda run: F.pmod(F.crc32(run.cast("binary")), F.lit(buckets)).cast("int"))
    return cut.withColumns({"n_words": F.size("words").cast("long"), "buckets": hashed}).drop("words")


def _runs(found: Column, most: int) -> Column:
    """All runs of 1 to ``most`` words, each joined by one space."""
    return F.concat(found, *[_of_length(found, n) for n in range(2, most + 1)]) if most > 1 else found


def _of_length(found: Column, n: int) -> Column:
    starts = F.slice(found, F.lit(1), F.greatest(F.size(found) - (n - 1), F.lit(0)))
    return F.transform(starts, lambda _, i: F.array_join(F.slice(found, i + 1, F.lit(n)), " "))


def bucket_counts(parts: DataFrame) -> DataFrame:
    """How often each bucket comes in all rows (``buckets``); a task sends one row for each bucket at most."""
    return parts.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """``bucket`` and ``gain`` of every bucket that ``raw`` holds: at most ``buckets`` rows, whatever the corpus.

    Counts are smoothed by one. Both tables are those of :func:`bucket_counts`.
    """
    everything = Window.partitionBy()  # over one row for each bucket
    both = raw.select("bucket", "n", F.lit(0).cast("long").alias("m")).union(target.select("bucket", F.lit(0).cast("long"), "n"))
    summed = both.groupBy("bucket").agg(F.sum("n").alias("s"), F.sum("m").alias("t"))
    summed = summed.withColumns({"all_s": F.sum("s").over(everything), "all_t": F.sum("t").over(everything)})
    ratio = ((F.col("t") + 1.0) * (F.col("all_s") + float(buckets))) / ((F.col("s") + 1.0) * (F.col("all_t") + float(buckets)))
    return summed.filter("s > 0").select("bucket", F.floor(F.log(ratio) * UNIT).cast("long").alias("gain"))


def _noise(seed: int | str, doc_id: Column) -> Column:
    """Gumbel noise of a document, of 32 bits of the SHA-256 of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -UNIT).cast("long")


def scores(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = 10_000, seed: int | str = 2024) -> DataFrame:
    """One row per document: ``row`` (a number of its own), ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``.

    Buckets are written once, so texts are read once; their counts and the sums by document each go through one
    exchange of rows that were summed within tasks before, however common a word or long a document is.
    """
    cut = with_buckets(docs.select("doc_id", "text"), most, buckets)
    parts = cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), "buckets")
    parts = materialize(parts, "resample-buckets")
    table = gains(bucket_counts(parts), bucket_counts(with_buckets(target.select("text"), most, buckets)), buckets)
    told = ["row", "doc_id", "n_words", "n_features"]
    each = parts.select(*told, F.explode_outer("buckets").alias("bucket")).join(F.broadcast(table), "bucket", "left")
    total = F.coalesce(F.col("total"), F.lit(0).cast("long"))
    n = F.greatest(F.col("n_features"), F.lit(1).cast("long"))
    weighed = each.groupBy(*told).agg(F.sum("gain").alias("total")).withColumn("weight", ((total - F.pmod(total, n)) / n).cast("long"))
    return weighed.drop("total").withColumn("score", F.col("weight") + _noise(seed, F.col("doc_id")))


def ranked(rows: DataFrame, order: list[Column], place: str = "place", total: str = "total") -> DataFrame:
    """Adds to each row its ``place`` in ``order``, from 1, and the ``total`` of rows; ``order`` should leave no ties.

    Rows are dealt to partitions by ranges of the order and sorted there; the rows of a partition are counted, and
    the counts of those before it added to the place within it. No task sees more than one range, and only a row for
    each partition meets in one place.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumns({"_part": F.shiftright("_at", _PLACE_BITS), "_at": F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}), "ranked")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"), F.sum("_n").over(Window.partitionBy()).alias(total))
    return dealt.join(F.broadcast(offsets), "_part").withColumn(place, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most: int = 1, buckets: int = 10_000, seed: int | str = 2024) -> DataFrame:
    """Draws ``percent`` of the documents of ``least_words`` words or more, without replacement, towards ``target``'s distribution.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``; other columns are left out. All documents come back:
    ``doc_id``, ``n_features``, ``weight`` (floored mean gain), ``score`` (weight and Gumbel noise) and ``rank`` (1, 2, ...
    from the highest score, ties to the smaller ``doc_id``; null where it was not drawn).

    A null or empty text has no features and weighs 0. A null ``doc_id`` counts as an empty one in the noise and comes
    first among ties. Repeated rows have equal scores and ranks of their own, in the order of reading. Without target
    texts the gains differ by the corpus alone; an empty table gives an empty one.
    """
    scored = materialize(scores(docs, target, most, buckets, seed), "resample-scores")
    open_ = scored.filter(F.col("n_words") >= least_words)
    placed = ranked(open_, [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row").asc()])
    drawn = F.when(100 * F.col("place") <= percent * F.col("total"), F.col("place"))
    names = ["doc_id", "n_features", "weight", "score"]
    rest = scored.filter(F.col("n_words") < least_words).select(*names, F.lit(None).cast("long").alias("rank"))
    return placed.select(*names, drawn.alias("rank")).union(rest)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target)


#: The CRC-32 is worked out bit by bit, once for each different word.
OP11_SQL = """
WITH steps AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS tab),
cut AS (
  SELECT 'd' AS kind, doc_id, row_number() OVER () AS row, text FROM documents
  UNION ALL SELECT 'b', NULL, NULL, text FROM benchmark),
worded AS (
  SELECT kind, doc_id, row, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS words FROM cut),
each AS (SELECT kind, row, unnest(words) AS w FROM worded),
hexed AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM each)),
bytes AS (SELECT w, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT) AS b FROM hexed),
hashed AS (
  SELECT w, xor(list_reduce(b, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket FROM bytes, steps),
counts AS (
  SELECT bucket, count(*) FILTER (WHERE kind = 'd') AS s, count(*) FILTER (WHERE kind = 'b') AS t FROM each JOIN hashed USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
sums AS (SELECT row, sum(gain)::BIGINT AS total FROM each JOIN hashed USING (w) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row),
weighed AS (
  SELECT doc_id, row, len(words)::BIGINT AS n_features, coalesce(total, 0) AS total, greatest(len(words), 1)::BIGINT AS n,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM worded LEFT JOIN sums USING (row) WHERE kind = 'd'),
scored AS (
  SELECT doc_id, n_features, (total - ((total % n) + n) % n) // n AS weight, row,
    (total - ((total % n) + n) % n) // n + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, row) AS place, count(*) FILTER (WHERE n_features >= 20) OVER () AS total FROM scored)
SELECT doc_id, n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN n_features >= 20 AND place <= total * 10 // 100 THEN place END AS rank FROM placed
"""
