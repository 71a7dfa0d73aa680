"""Quality rules: base counts, then a hashed n-gram likelihood ratio (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import broadcast_if_small, materialize
from .text import held_out, words

#: Buckets into which words and pairs of words are hashed; the table of ratios has this many rows.
BUCKETS = 1 << 16
#: Added to every bucket's count.
SMOOTHING = 4.0
#: Ratios are whole numbers of this unit, so that sums do not depend on their order.
UNIT = 1 << 20
#: Mean log-likelihood ratio (natural, per n-gram) below which a document goes. It was chosen on labelled rows that are
#: not held out: of those, cuts from -0.25 to -0.1 tell the labels apart about equally well.
THRESHOLD = -0.2
WINDOW = 5


def _repeat_windows(docs: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from ``hashes_`` (of the words): words in windows found twice or more.

    Hash sets tell the texts without any repeated window; only the rest are sorted.
    """
    n = F.size("hashes_")
    starts = F.when(n >= WINDOW, F.slice("hashes_", F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<bigint>"))
    window = F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get("hashes_", i + k) for k in range(1, WINDOW)]))
    out = docs.withColumn("windows_", window)
    unique = F.size(F.array_distinct("windows_")) == F.size("windows_")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs = F.array_sort(F.transform("windows_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("pairs_", F.when(unique, none).otherwise(pairs))
    alike = lambda p, i, step: F.coalesce(F.get("pairs_", i + step)["h"] == p["h"], F.lit(False))
    repeated = F.filter("pairs_", lambda p, i: alike(p, i, -1) | alike(p, i, 1))
    out = out.withColumn("at_", F.array_sort(F.transform(repeated, lambda p: p["i"])))
    covered = F.transform("at_", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at_", i + 1) - p, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return out.withColumn("n_repeat_words", total).drop("windows_", "pairs_", "at_")


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds the base counts and ``base_failed`` to rows that have ``text`` and ``hashes_``."""
    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    zero = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    out = docs.withColumn("lines_", F.coalesce(lines, F.array().cast("array<string>")))
    out = out.withColumns({
        "n_words": F.size("hashes_").cast("long"),
        "word_chars": F.length(F.array_join("words_", "")).cast("long"),
        "n_symbols": zero(F.regexp_count("text", F.lit("[#*$%&|<>]"))),
        "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
    }).drop("lines_")
    out = _repeat_windows(out)
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _hashed(docs: DataFrame) -> DataFrame:
    """Adds ``words_`` and ``hashes_``."""
    return docs.withColumn("words_", words(F.col("text"))).withColumn("hashes_", F.transform("words_", lambda w: F.xxhash64(w)))


def _pair_hashes() -> Column:
    """A hash of each word and its successor."""
    firsts = F.slice("hashes_", F.lit(1), F.greatest(F.size("hashes_") - 1, F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, F.get("hashes_", i + 1)))


def _buckets(hashes: Column, buckets: int) -> Column:
    return F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row with ``ratios``: for each bucket the log of its smoothed share among trusted documents over that among all.

    The raw counts are first scaled to as many n-grams as the trusted documents have, so that smoothing weighs alike
    on both sides, however much smaller the trusted one is; then both shares have one denominator, which drops out.

    Every n-gram of every document counts; the counts are summed map-side, at most ``buckets`` rows a task. The row
    has ``buckets`` numbers, however large the corpus is.
    """
    spark = docs.sparkSession
    ids = broadcast_if_small(trusted.select(F.col("doc_id").alias("trusted_id")).filter("trusted_id IS NOT NULL").distinct())
    flagged = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
    grams = F.concat(_buckets(F.col("hashes_"), buckets), _buckets(_pair_hashes(), buckets))
    grams = _hashed(flagged).select(F.explode(grams).alias("bucket"), F.col("trusted_id").isNotNull().cast("long").alias("trusted"))
    counts = materialize(grams.groupBy("bucket").agg(F.sum("trusted").alias("in_trusted"), F.count("*").alias("in_all")), "rule-counts")
    totals = counts.agg(F.sum("in_trusted").alias("all_trusted"), F.sum("in_all").alias("all_grams"))
    part = totals.select((F.col("all_trusted") / F.col("all_grams")).alias("part")).scalar()
    ratio = (F.col("in_trusted") + smoothing) / (F.col("in_all") * part + smoothing)
    known = counts.select("bucket", F.round(F.log(ratio) * UNIT).cast("long").alias("ratio"))
    every = spark.range(buckets).withColumnRenamed("id", "slot").join(F.broadcast(known), F.col("slot") == F.col("bucket"), "left")
    pairs = F.array_sort(F.collect_list(F.struct("slot", F.coalesce("ratio", F.lit(0)).cast("long").alias("ratio"))))
    return materialize(every.agg(F.transform(pairs, lambda x: x["ratio"]).alias("ratios")), "rule-ratios")


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: ``doc_id``, base counts, ``base_failed``, ``ratio`` (mean, natural log) and ``kept``.

    ``trusted`` has the ``doc_id`` of the trusted-target documents. Words and pairs of neighbouring words
    are hashed to buckets; a document's log-likelihood ratio between the trusted and the raw multinomial,
    divided by its n-grams, must reach ``threshold``. The test is a fixed comparison of whole numbers, with
    no sampling. Documents that fail the base rules are not kept. Ratios are summed where a document is: no
    n-gram leaves its row.

    A null or empty text has no words and fails. Repeated rows are judged each; a null doc_id is never
    trusted. Without trusted documents, all ratios differ only by smoothing. Other columns are left out; an
    empty table gives an empty one.
    """
    table = ratios(docs, trusted, buckets).select("ratios").scalar()
    told = base_counts(_hashed(docs.select("doc_id", "text"))).withColumn("ratios_", table)
    worth = lambda s, h: s + F.get("ratios_", F.pmod(h, F.lit(buckets)).cast("int"))
    total = F.aggregate(F.concat("hashes_", _pair_hashes()), F.lit(0).cast("long"), worth)
    summed = told.withColumn("sum_", total).withColumn("n_", F.col("n_words") + F.greatest(F.col("n_words") - 1, F.lit(0)))
    ratio = F.col("sum_") / F.greatest(F.col("n_"), F.lit(1)) / UNIT
    passes = F.col("sum_") >= F.col("n_") * F.lit(round(threshold * UNIT))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return summed.select(*names, ratio.alias("ratio"), (~F.col("base_failed") & passes).alias("kept"))


def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with those labelled good and not held out as trusted ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = labels.filter((F.col("quality") == 1) & ~held_out(F.col("doc_id")))
    return quality_rules(docs, trusted)
