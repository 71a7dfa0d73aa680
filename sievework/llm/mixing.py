"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import materialize
from .text import hash_unit, n_words

#: Bins of the sampling order to one unit of the logarithm of the ranking variable. Sizes are first summed by bin, and
#: only the bin that holds a cut is sorted. Logarithms of random odds are densest about even odds, one in four to a unit,
#: so a bin holds one in 1,024 of the documents of equal inclusion odds at most, and a source has some thousands of bins.
BINS = 256
#: Weight of a document's inclusion odds: this, and the tilt times the binary digits of its size.
LEAST_LEAN, TILT = 8, 1
#: Share of its target by which a source may miss it unmended, and documents at most that are put in or out to mend it.
NEAR, SWAPS = 0.002, 6
#: Rows up to which the plan, one for each source and binary length of a size, is broadcast to the documents; more are joined by shuffle.
BROADCAST_PLAN = 100_000


def _running(rows: DataFrame, order: list[Column], before: dict[str, Column], upward: dict[str, Column], name: str) -> DataFrame:
    """Adds each row's ``place`` in ``order`` from 0, the sums ``before`` it, and the sums from it ``upward``; ``order`` leaves no ties.

    Rows are dealt to partitions by ranges of the order and written. Sums are taken within a range, and those of the
    ranges before or after it are added: no task sees more than a range, and one row for each range meets in one place.
    """
    dealt = materialize(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    before = {"place": F.lit(1).cast("long")} | before
    ranges = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_{k}") for k, c in (before | upward).items()])
    to = {k: Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1) for k in before} | {k: Window.orderBy("_range").rowsBetween(1, Window.unboundedFollowing) for k in upward}
    ranges = ranges.select("_range", *[F.coalesce(F.sum(f"_{k}").over(w), F.lit(0)).alias(f"_{k}") for k, w in to.items()])
    inside = Window.partitionBy("_range").orderBy(*order)
    sums = {k: F.coalesce(F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) for k, c in before.items()}
    sums |= {k: F.sum(c).over(inside.rowsBetween(0, Window.unboundedFollowing)) for k, c in upward.items()}
    return dealt.join(F.broadcast(ranges), "_range").select(*rows.columns, *[(F.col(f"_{k}") + c).alias(k) for k, c in sums.items()])


def source_targets(totals: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    Sources by code point, null last, take the weights in turn. ``share`` times all sizes is dealt by
    weight; no target exceeds ``cap`` times its source's size, and the excess is dealt again by weight.
    In order of the level at which a source fills up, each is full if the level without those before
    it reaches that far, so one pass of running sums finds the final level. Both orders are kept in ranges,
    so any number of sources is dealt with by many tasks.
    """
    by_name = F.col("source").asc_nulls_last()
    named = _running(totals, [by_name], {}, {}, "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(cap))
    weighed = named.withColumn("weight", weight).drop("place").withColumn("fills_at", limit / F.col("weight"))
    wanted = float(totals.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    level = _running(weighed, [F.col("fills_at").asc(), by_name], {"before": limit}, {"weight_left": F.col("weight")}, "mix-levels")
    level = level.withColumn("level", (F.lit(wanted) - F.col("before")) / F.col("weight_left")).withColumn("full", F.col("level") >= F.col("fills_at"))
    last = level.filter(~F.col("full")).agg(F.min(F.struct("fills_at", "source", "level"))["level"]).first()[0]  # one number
    return level.select("source", "source_size", F.when(F.col("full"), limit).otherwise(F.least(limit, F.lit(last).cast("double") * F.col("weight"))).alias("target"))


def size_kind(size: Column) -> Column:
    """Binary digits of a size: documents of one kind have equal inclusion odds."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def inclusion_rates(kinds: DataFrame, cap: float, tilt: int) -> DataFrame:
    """Adds ``whole`` and ``p`` to one row per source and kind (``source``, ``kind``, ``kind_size``, ``source_size``, ``target``).

    Within a source the expected copies of a document are in proportion to its lean, up to ``cap``, and the sizes
    times the expected copies sum to the target. Kinds of the largest lean reach the cap first; one pass of running
    sums over a source's few kinds tells which do. Whole copies are certain, ``p`` is the inclusion odds of one more.
    """
    of_source, by_fill = Window.partitionBy("source"), Window.partitionBy("source").orderBy(F.desc("lean"))
    earlier = F.coalesce(F.sum("kind_size").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (
        kinds.withColumn("lean", LEAST_LEAN + tilt * F.col("kind") if tilt else LEAST_LEAN - F.col("kind") * 0)
        .withColumn("left", F.sum(F.col("lean") * F.col("kind_size")).over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", F.when(F.col("left") > 0, (F.col("target") - float(cap) * earlier) / F.col("left")))
        .withColumn("full", F.col("level") * F.col("lean") >= float(cap))
        .withColumn("final", F.min(F.when(~F.col("full"), F.struct((-F.col("lean")).alias("o"), "level"))).over(of_source)["level"])
    )
    rate = F.when(F.col("full"), F.lit(float(cap))).otherwise(F.coalesce(F.least(F.lit(float(cap)), F.col("final") * F.col("lean")), F.lit(0.0)))
    rated = level.withColumn("rate", rate).withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))
    return rated.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("kind_size")).over(of_source)).drop("lean", "left", "level", "full", "final", "rate", "kind_size")


def _order(p: Column, unit: Column) -> Column:
    """Pareto's ranking variable: random odds over inclusion odds."""
    return (unit / (1.0 - unit)) / (p / (1.0 - p))


def _few(plan: DataFrame) -> bool:
    return plan.limit(BROADCAST_PLAN + 1).count() <= BROADCAST_PLAN


def _ordered(sized: DataFrame, plan: DataFrame, few: bool) -> DataFrame:
    """Every document with its source's and kind's plan, its place in the sampling order and that place's bin."""
    plan = plan.withColumnsRenamed({"source": "plan_source", "kind": "plan_kind"})
    plan = F.broadcast(plan) if few else plan
    out = sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("kind") == F.col("plan_kind"))).drop("plan_source", "plan_kind")
    out = out.withColumn("v", F.when(F.col("p") > 0, _order(F.col("p"), F.col("unit"))))
    return out.withColumn("bin", F.floor(F.log("v") * BINS).cast("int"))


def _key() -> Column:
    return F.struct("v", "id", "size")


def _cut(open_docs: DataFrame) -> DataFrame:
    """Per source, the place in the order up to which all sizes together come nearest to ``rest``.

    Rows: cut_source, bin (all earlier bins are within; null: all bins are), place (last key within that bin; null: none)
    and used, the sizes up to there. The document that crosses ``rest`` is within if that is nearer.
    Sizes are summed by bin first, so a source that holds most rows is never sorted in one task.
    """
    bins = open_docs.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"), F.first("rest").alias("rest"))
    running = Window.partitionBy("source").orderBy("bin")
    crossing = F.when(F.col("upto") > F.col("rest"), F.struct("bin", F.expr("upto - bin_size").alias("before")))
    first = bins.withColumn("upto", F.sum("bin_size").over(running)).groupBy("source").agg(F.min(crossing).alias("at"), F.sum("bin_size").alias("all"))
    first = materialize(first.select(F.col("source").alias("cut_source"), F.col("at.bin").alias("cut_bin"), F.col("at.before").alias("before"), "all"), "mix-bins")
    some = first.select(F.col("cut_source").alias("source_"), F.col("cut_bin").alias("bin_"), F.col("before").alias("before_")).filter("bin_ IS NOT NULL")
    inside = open_docs.join(some, F.col("source").eqNullSafe(F.col("source_")) & (F.col("bin") == F.col("bin_")))
    upto = F.col("before_") + F.sum("size").over(Window.partitionBy("source_", "bin_").orderBy("v", "id", "size"))
    reached = F.struct(_key().alias("place"), F.col("upto"))
    ends = inside.withColumn("upto", upto).groupBy("source_").agg(F.max(F.when(F.col("upto") <= F.col("rest"), reached)).alias("last"), F.min(F.when(F.col("upto") > F.col("rest"), reached)).alias("next"), F.first("rest").alias("rest"))
    joined = first.join(ends, F.col("cut_source").eqNullSafe(F.col("source_")), "left")
    short = F.coalesce(F.col("last.upto"), F.col("before"))
    nearer = F.col("next.upto") - F.col("rest") < F.col("rest") - short
    place = F.when(nearer, F.col("next.place")).otherwise(F.col("last.place"))
    used = F.when(F.col("cut_bin").isNull(), F.col("all")).when(nearer, F.col("next.upto")).otherwise(short)
    return joined.select("cut_source", F.col("cut_bin").alias("bin_1"), place.alias("place_1"), used.alias("used"))


def _within(bin_: Column, cut_bin: Column, place: Column) -> Column:
    return F.col("v").isNotNull() & (cut_bin.isNull() | (bin_ < cut_bin) | ((bin_ == cut_bin) & F.coalesce(_key() <= place, F.lit(False))))


def _first_choice() -> Column:
    return _within(F.col("bin"), F.col("bin_1"), F.col("place_1"))


def _swapped(open_docs: DataFrame) -> DataFrame:
    """Per source that misses its target by more than ``NEAR``, the document that, put in or out, brings it nearest."""
    change = F.when(_first_choice(), -F.col("size")).otherwise(F.col("size"))
    off = F.abs(F.col("gap") - change)
    able = (F.abs("gap") > NEAR * F.col("target")) & (off < F.abs("gap")) & ~F.array_contains("swaps", _key())
    best = open_docs.filter(able).groupBy(F.col("source").alias("swap_source")).agg(F.min(F.struct(off.alias("off"), _key().alias("key"), change.alias("change"))).alias("best"))
    return best.select("swap_source", F.col("best.key").alias("swap"), F.col("best.change").alias("change"))


def mixing_plan(sized: DataFrame, weights: tuple[float, ...], share: float, cap: float, tilt: int) -> DataFrame:
    """One row per source and kind: target, whole copies that are certain, odds of one more, the cut of the order, and swaps.

    ``sized``: source, id, size, kind, unit. After the cut, documents are put in or out one by one, each the one that
    brings its source nearest to its target, until all are near or nothing helps, ``SWAPS`` times at most.
    """
    kinds = materialize(sized.groupBy("source", "kind").agg(F.sum("size").alias("kind_size")), "mix-kinds")
    targets = source_targets(kinds.groupBy("source").agg(F.sum("kind_size").alias("source_size")), weights, share, cap).withColumnRenamed("source", "target_source")
    rated = kinds.join(targets, F.col("source").eqNullSafe(F.col("target_source"))).drop("target_source")
    plan = materialize(inclusion_rates(rated, cap, tilt), "mix-plan")
    few = _few(plan)
    open_docs = lambda: _ordered(sized, plan, few).filter(F.col("p") > 0)
    plan = plan.join(_cut(open_docs()), F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    none = F.array().cast("array<struct<v:double,id:bigint,size:bigint>>")
    plan = materialize(plan.withColumns({"gap": F.col("rest") - F.coalesce("used", F.lit(0)), "swaps": none}).drop("used"), "mix-cut")
    for _ in range(SWAPS):
        swaps = materialize(_swapped(open_docs()), "mix-swap")
        if swaps.isEmpty():
            break
        plan = plan.join(swaps, F.col("source").eqNullSafe(F.col("swap_source")), "left").drop("swap_source")
        more = F.when(F.col("swap").isNotNull(), F.array_append("swaps", F.col("swap"))).otherwise(F.col("swaps"))
        plan = materialize(plan.withColumns({"gap": F.col("gap") - F.coalesce("change", F.lit(0)), "swaps": more}).drop("swap", "change"), "mix-plan")
    return plan


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, cap: float = 2.0, seed: str = "mix", tilt: int = TILT) -> DataFrame:
    """Adds to each document ``size``, ``source_size``, ``target`` and ``copies`` (how often the mix takes it).

    Each source's target is dealt to its documents as expected copies, more to long ones: in proportion to
    ``LEAST_LEAN`` and ``tilt`` times the binary digits of the size (0: alike), up to ``cap``. The whole part is
    certain; for the rest, documents are ranked by Pareto's variable, random odds over their own inclusion odds,
    and taken in that order up to the place nearest to the target. Then a few documents are put in or out, up to
    ``SWAPS`` a source, whatever their odds, until it is within ``NEAR`` of its target. Only the plan, a few rows per
    source, is joined to the documents.

    A null text has size 0, a null source is a source of its own, a null id counts as the smallest.
    Rows with equal id and size have one place in the order and are taken or left together (one that is put in or
    out counts once). An empty table gives an empty one. Other columns are kept; those four names are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies")
    row = _sized(docs, seed, F.struct("*").alias("row"))
    plan = mixing_plan(materialize(row.drop("row"), "mix-sizes"), weights, share, cap, tilt)
    return _copies(row, plan).select("row.*", "size", "source_size", "target", "copies")


def _sized(docs: DataFrame, seed: str, more: Column) -> DataFrame:
    size = n_words(F.col("text"))
    row = docs.select(more, "source", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"), size.alias("size"), hash_unit(F.lit(seed), F.col("doc_id")).alias("unit"))
    return row.withColumn("kind", size_kind(F.col("size")))


def _copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    swapped = F.array_contains("swaps", _key())
    more = F.coalesce(_first_choice() != swapped, F.lit(False))
    return _ordered(sized, plan, _few(plan)).withColumn("copies", (F.col("whole") + more.cast("int")).cast("long"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    sized = materialize(_sized(docs, "mix", F.col("doc_id")), "mix-sizes")
    mixed = _copies(sized, mixing_plan(sized, (5.0, 2.0, 1.0), 1.5, 2.0, TILT))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _sql_swap(n: int) -> str:
    """The swap after ``n`` earlier ones: ``t`` tells whether a document is in by the cut, ``o`` whether it was put in or out since."""
    return f"""
best{n} AS (
  SELECT source, arg_min({{'v': v, 'id': id, 'size': size}}, {{'o': abs(gap - CASE WHEN t THEN -size ELSE size END), 'v': v, 'i': id, 's': size}}) AS swap FROM state{n}
  WHERE p > 0 AND NOT o AND abs(gap) > {NEAR}::DOUBLE * target AND abs(gap - CASE WHEN t THEN -size ELSE size END) < abs(gap) GROUP BY source),
state{n + 1} AS (
  SELECT s.* EXCLUDE (o, gap), o OR coalesce(v = swap.v AND id = swap.id AND size = swap.size, false) AS o,
    gap - coalesce(max(CASE WHEN v = swap.v AND id = swap.id AND size = swap.size THEN CASE WHEN t THEN -size ELSE size END END) OVER (PARTITION BY s.source), 0) AS gap
  FROM state{n} s LEFT JOIN best{n} b ON s.source IS NOT DISTINCT FROM b.source),"""


OP2_SQL = f"""
WITH counted AS (
  SELECT doc_id, source, coalesce(doc_id, -9223372036854775808) AS id,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5('mix' || chr(31) || coalesce(doc_id::VARCHAR, chr(0))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS unit
  FROM documents),
sized AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS kind FROM counted),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
    sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS wanted FROM totals),
filled AS (
  SELECT *, wanted - coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
    source_size * 2.0::DOUBLE / weight AS fills_at FROM weighed),
levelled AS (SELECT *, remaining / weight_left AS level FROM filled),
final AS (SELECT arg_min(level, fills_at) AS final FROM levelled WHERE level < fills_at),
targets AS (
  SELECT source, source_size, CASE WHEN level >= fills_at THEN source_size * 2.0::DOUBLE ELSE least(source_size * 2.0::DOUBLE, final * weight) END AS target
  FROM levelled LEFT JOIN final ON true),
kinds AS (SELECT source, kind, sum(size)::BIGINT AS kind_size FROM sized GROUP BY 1, 2),
leaning AS (
  SELECT kinds.*, source_size, target, {LEAST_LEAN} + {TILT} * kind AS lean,
    coalesce(sum(kind_size) OVER (PARTITION BY kinds.source ORDER BY kind DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS earlier,
    sum(({LEAST_LEAN} + {TILT} * kind) * kind_size) OVER (PARTITION BY kinds.source ORDER BY kind DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS rest_lean
  FROM kinds JOIN targets ON kinds.source IS NOT DISTINCT FROM targets.source),
lifted AS (SELECT *, CASE WHEN rest_lean > 0 THEN (target - 2.0::DOUBLE * earlier) / rest_lean END AS lift FROM leaning),
lasts AS (SELECT source, arg_max(lift, lean) AS last_lift FROM lifted WHERE lift * lean < 2.0::DOUBLE GROUP BY source),
rated AS (
  SELECT lifted.*, CASE WHEN lift * lean >= 2.0::DOUBLE THEN 2.0::DOUBLE ELSE coalesce(least(2.0::DOUBLE, last_lift * lean), 0.0::DOUBLE) END AS rate
  FROM lifted LEFT JOIN lasts ON lifted.source IS NOT DISTINCT FROM lasts.source),
plan AS (SELECT *, floor(rate) AS whole, rate - floor(rate) AS p, target - sum(floor(rate) * kind_size) OVER (PARTITION BY source) AS rest FROM rated),
ordered AS (
  SELECT s.*, plan.source_size, target, whole, p, rest,
    CASE WHEN p > 0 THEN (unit / (1.0::DOUBLE - unit)) / (p / (1.0::DOUBLE - p)) END AS v
  FROM sized s JOIN plan ON s.source IS NOT DISTINCT FROM plan.source AND s.kind = plan.kind),
first AS (SELECT *, sum(size) OVER (PARTITION BY source, p > 0 ORDER BY v, id, size) AS upto FROM ordered),
cuts AS (
  SELECT source, coalesce(max(upto) FILTER (WHERE p > 0 AND upto <= rest), 0) AS short, min(upto) FILTER (WHERE p > 0 AND upto > rest) AS long, any_value(rest) AS r FROM first GROUP BY source),
state0 AS (
  SELECT f.*, coalesce(p > 0 AND upto <= CASE WHEN long - r < r - short THEN long ELSE short END, false) AS t, false AS o, rest - CASE WHEN long - r < r - short THEN long ELSE short END AS gap
  FROM first f JOIN cuts c ON f.source IS NOT DISTINCT FROM c.source),{"".join(map(_sql_swap, range(SWAPS)))}
last AS (SELECT * FROM state{SWAPS})
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN t <> o THEN 1 ELSE 0 END))::BIGINT AS taken FROM last
"""
