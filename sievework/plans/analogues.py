"""The operators applied to the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import naming
from ..functions.boxes import size_class
from ..functions.rules import clamp, first_failing, safe_ratio, weighted_mean
from ..operators import arrays, audit, decide, dedup, sampling, split
from ..operators.percentiles import exact_percentiles
from ..shared import materialize

TARGETS = ("SMALL", "PROMO")
THRESHOLDS = [round(0.002 * i, 3) for i in range(1, 19)]
QUERIES, SQL = {"dedup_canonical": dedup.dedup_canonical}, {"dedup_canonical": dedup.DEDUP_CANONICAL_SQL}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left")


@_query("""
WITH p AS (SELECT sha256(coalesce(text, '')) AS content_sha, quality::VARCHAR || '/' || toxic::VARCHAR AS sign FROM documents LEFT JOIN labels USING (doc_id))
SELECT content_sha, count(*)::BIGINT AS copies, count(DISTINCT sign) AS n_signatures, count(DISTINCT sign) > 1 AS conflict FROM p GROUP BY 1 HAVING count(*) > 1""")
def dedup_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sign = F.concat("quality", F.lit("/"), "toxic")
    return dedup.conflicts(_labelled(spark, sf_dir).withColumn("sign", sign), "text", "sign")


@_query("""
SELECT sha256(coalesce(text, '')) AS content_sha, count(DISTINCT source) AS n_groups, count(*)::BIGINT AS copies FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1""")
def cross_group_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.across_groups(_table(spark, sf_dir, "documents"), "text", "source")


@_query("""
SELECT source AS "group", count(*) AS images, count(quality)::BIGINT AS boxes FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.group_stats(_labelled(spark, sf_dir), "source", F.col("quality").isNotNull())


_HASHED = """h AS (SELECT *, ('0x' || substr(md5(coalesce(source, '')), 1, 8))::BIGINT % 100 AS slot FROM documents LEFT JOIN labels USING (doc_id)),
d AS (SELECT *, CASE WHEN slot < 70 THEN 'train' WHEN slot < 85 THEN 'val' ELSE 'test' END AS split FROM h)"""


@_query(f"""
WITH {_HASHED}, t AS (SELECT count(*) AS i, count(quality) AS b FROM d)
SELECT split, count(DISTINCT source) AS n_groups, count(*)::BIGINT AS images, count(quality)::BIGINT AS boxes,
  round(100.0::DOUBLE * count(*) / greatest((SELECT i FROM t), 1), 2) AS image_percent, round(100.0::DOUBLE * count(quality) / greatest((SELECT b FROM t), 1), 2) AS box_percent
FROM d GROUP BY split""")
def hash_group_split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = split.group_stats(_labelled(spark, sf_dir), "source", F.col("quality").isNotNull())
    return split.split_stats(stats.withColumn("split", split.hash_split(F.col("group"))))


@_query()
def balanced_group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.balanced_split(group_stats(spark, sf_dir))


@_query(f"""
WITH {_HASHED}, k AS (SELECT split, 'group' AS kind, source AS key FROM d UNION SELECT split, 'content', md5(coalesce(text, '')) FROM d),
n AS (SELECT kind, key, list(DISTINCT split) AS s FROM k GROUP BY 1, 2),
p AS (SELECT * FROM (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) v(split_a, split_b))
SELECT kind, split_a, split_b, count(*) FILTER (WHERE list_contains(s, split_a) AND list_contains(s, split_b)) AS n_shared FROM n, p GROUP BY 1, 2, 3""")
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("split", split.hash_split(F.col("source")))
    return split.shared_between_splits(docs, {"group": F.col("source"), "content": F.md5(F.coalesce("text", F.lit("")).cast("binary"))})


@_query("""
SELECT 'orphan_children' AS issue, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'total', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def orphan_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.orphans(_table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey")
    return audit.issue_totals({"orphan_children": rows}, spark)


@_query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def parents_without_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.childless(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_orderstatus")


@_query("""
SELECT o_orderkey, count(l_orderkey) AS n_items, coalesce(list_sort(list(l_partkey) FILTER (WHERE l_partkey IS NOT NULL))[1], -1) AS first_part
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def attach_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = audit.attach(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey", F.col("l_partkey"), "items")
    return joined.select("o_orderkey", F.size("items").cast("long").alias("n_items"), F.coalesce(F.get("items", F.lit(0)), F.lit(-1)).alias("first_part"))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.lower(F.trim("p_type")).alias("category")
    return _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "part").select("p_partkey", kind), F.col("l_partkey") == F.col("p_partkey"))


@_query("SELECT lower(trim(p_type)) AS category, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.count_by(_typed(spark, sf_dir), "category")


@_query("""
SELECT l_orderkey, count(*) FILTER (WHERE p_type IN ('SMALL', 'PROMO')) AS target_count, count(*) FILTER (WHERE p_type NOT IN ('SMALL', 'PROMO')) AS other_count
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def target_vs_other_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.target_counts(_typed(spark, sf_dir), "l_orderkey", F.col("category").isin([t.lower() for t in TARGETS]))


_RULES = [("non_positive_quantity", "l_quantity <= 0"), ("quantity_above_limit", "l_quantity > 45"), ("discount_above_limit", "l_discount > 0.08"), ("tax_above_limit", "l_tax > 0.06"), ("price_above_limit", "l_extendedprice > 90000")]
_RULE_CASE = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in _RULES) + " END"


@_query(f"SELECT coalesce({_RULE_CASE}, 'ok') AS reason, count(*) AS n FROM lineitem GROUP BY 1")
def first_failing_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = first_failing([(n, F.expr(c)) for n, c in _RULES])
    return audit.count_by(_table(spark, sf_dir, "lineitem").select(F.coalesce(reason, F.lit("ok")).alias("reason")), "reason")


@_query(f"""
WITH x AS (SELECT 'orphan_children' AS issue, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'childless_parents', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'broken_rules', count(*) FROM lineitem WHERE {_RULE_CASE} IS NOT NULL)
SELECT * FROM x UNION ALL SELECT 'total', sum(n)::BIGINT FROM x""")
def issue_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    return audit.issue_totals({
        "orphan_children": audit.orphans(items, orders, "l_orderkey", "o_orderkey"),
        "childless_parents": audit.childless(orders, items, "o_orderkey", "l_orderkey"),
        "broken_rules": items.filter(first_failing([(n, F.expr(c)) for n, c in _RULES]).isNotNull()),
    }, spark)


@_query("""
SELECT l_returnflag, CASE WHEN r < 0.05 THEN 'tiny' WHEN r < 0.25 THEN 'small' ELSE 'medium_large' END AS size_class, count(*) AS n
FROM (SELECT l_returnflag, l_extendedprice / greatest(o_totalprice, 1.0::DOUBLE) AS r FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1, 2""")
def size_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    kind = size_class(safe_ratio(F.col("l_extendedprice"), F.col("o_totalprice"), 1.0), 0.05, 0.25)
    return audit.count_by(joined.select("l_returnflag", kind.alias("size_class")), "l_returnflag", "size_class")


@_query("""
SELECT p_partkey, least(greatest((p_size + p_size / 2.0::DOUBLE) / 50.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS center, least(greatest(p_retailprice / 1500.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS share FROM part""")
def clamped_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return _table(spark, sf_dir, "part").select("p_partkey", clamp((size + size / 2.0) / 50.0, 0.0, 1.0).alias("center"), clamp(F.col("p_retailprice") / 1500.0, 0.0, 1.0).alias("share"))


@_query(r"""
WITH f AS (SELECT page_id, regexp_replace(split_part(split_part(url, '?', 1), '#', 1), '[^A-Za-z0-9]+', '-', 'g') || '_' || page_id::VARCHAR || '_jpg.rf.' || left(md5(url), 8) || '.jpg' AS name FROM pages),
s AS (SELECT *, split_part(split_part(regexp_replace(name, '\.[^.]*$', ''), '.rf.', 1), '_jpg', 1) AS stem FROM f)
SELECT page_id, CASE WHEN contains(stem, '-') THEN regexp_replace(stem, '-[^-]*$', '') ELSE regexp_replace(stem, '_[0-9]+$', '') END AS "group",
  regexp_replace(name, '[^A-Za-z0-9_-]+', '_', 'g') AS safe, 'train__' || page_id::VARCHAR || '__' || name AS prepared FROM s""")
def name_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.regexp_replace(F.substring_index(F.substring_index("url", "?", 1), "#", 1), "[^A-Za-z0-9]+", "-")
    name = F.concat(plain, F.lit("_"), F.col("page_id").cast("string"), F.lit("_jpg.rf."), F.substring(F.md5("url"), 1, 8), F.lit(".jpg"))
    named = _table(spark, sf_dir, "pages").select("page_id", name.alias("name"))
    path = naming.posix_path(F.concat(F.lit("source\\images//"), F.col("name")))
    return named.select("page_id", naming.group_name(path).alias("group"), naming.safe_identifier(F.col("name")).alias("safe"), naming.prepared_name(F.lit("train"), F.col("page_id"), path).alias("prepared"))


@_query("""
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max((props->>'$.k')::BIGINT, (ts, event_id)) AS k FROM events GROUP BY 1""")
def latest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.progress import latest

    events = _table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return latest(events, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "k")


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as 8 x 8 images of doubles."""
    return _table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform(F.slice("embedding", 1, 64), lambda x: x.cast("double")).alias("grid"))


_GRID = "grids AS (SELECT vec_id, label, list_transform(embedding[1:64], lambda x: x::DOUBLE) AS grid FROM embeddings)"
_CELLS = "cells AS (SELECT vec_id, grid, unnest(range(64)) AS i, unnest(grid) AS v FROM grids)"


@_query(f"""
WITH {_GRID}, {_CELLS}, b AS (SELECT vec_id, least(greatest(floor((v + 0.5::DOUBLE) * 16.0::DOUBLE), 0), 15)::INT AS bin, count(*) AS n FROM cells GROUP BY 1, 2)
SELECT vec_id, count(*) AS bins_used, log2(sum(n)::DOUBLE) - sum(n * log2(n::DOUBLE)) / sum(n) AS entropy, (log2(sum(n)::DOUBLE) - sum(n * log2(n::DOUBLE)) / sum(n)) / 4.0::DOUBLE AS entropy_share FROM b GROUP BY 1""")
def histogram_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = F.transform("grid", lambda x: F.least(F.greatest(F.floor((x + 0.5) * 16.0), F.lit(0)), F.lit(15)).cast("int"))
    return arrays.entropy(_grid(spark, sf_dir), "vec_id", bins, 16)


@_query(f"""
WITH {_GRID}, {_CELLS},
l AS (SELECT vec_id, grid[i] + grid[i + 2] + grid[i + 1 - 8] + grid[i + 1 + 8] - 4 * grid[i + 1] AS lap FROM cells WHERE i % 8 BETWEEN 1 AND 6 AND i // 8 BETWEEN 1 AND 6),
v AS (SELECT vec_id, var_pop(lap) AS lap_var FROM l GROUP BY 1),
m AS (SELECT vec_id, avg(v) AS brightness, stddev_pop(v) AS contrast, (count(*) FILTER (WHERE v <= -0.2))::DOUBLE / count(*) AS black_clip, (count(*) FILTER (WHERE v >= 0.2))::DOUBLE / count(*) AS white_clip FROM cells GROUP BY 1)
SELECT m.*, lap_var, ln(1 + lap_var) / ln(1 + 1500.0::DOUBLE) AS sharpness, least(greatest(1 - abs(brightness - 0.5::DOUBLE) / 0.5::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS brightness_quality FROM m JOIN v USING (vec_id)""")
def array_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, b = F.col("grid"), F.col("brightness")
    out = _grid(spark, sf_dir).select("vec_id", arrays.mean(g).alias("brightness"), arrays.spread(g).alias("contrast"), arrays.share(g, lambda x: x <= -0.2).alias("black_clip"), arrays.share(g, lambda x: x >= 0.2).alias("white_clip"), arrays.laplacian_variance(g, 8).alias("lap_var"))
    return out.withColumn("sharpness", F.log1p("lap_var") / F.log1p(F.lit(1500.0))).withColumn("brightness_quality", clamp(1 - F.abs(b - 0.5) / 0.5, 0.0, 1.0))


@_query(f"""
WITH {_GRID}, {_CELLS}, t AS (SELECT vec_id, (i // 32) * 2 + (i % 8) // 4 AS tile, avg(v * v) AS energy FROM cells GROUP BY 1, 2)
SELECT vec_id, quantile_cont(energy, 0.1) AS p10, quantile_cont(energy, 0.5) AS p50, quantile_cont(energy, 0.9) AS p90, count(*) FILTER (WHERE r <= 3) AS n_kept
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY energy DESC, tile) AS r FROM t) GROUP BY 1""")
def tile_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _grid(spark, sf_dir).select("vec_id", F.posexplode("grid").alias("i", "v"))
    tile = F.floor(F.col("i") / 32) * 2 + F.floor(F.pmod("i", F.lit(8)) / 4)
    tiles = cells.groupBy("vec_id", tile.alias("tile")).agg(F.avg(F.col("v") * F.col("v")).alias("energy"))
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("energy"), "tile"))
    p = lambda q: F.percentile("energy", F.lit(q)).alias(f"p{round(q * 100)}")
    return tiles.withColumn("r", rank).groupBy("vec_id").agg(p(0.1), p(0.5), p(0.9), F.count_if(F.col("r") <= 3).alias("n_kept"))


@_query(f"""
WITH {_GRID}, {_CELLS},
d AS (SELECT vec_id, i, sqrt((grid[i + 2] - grid[i + 1]) ** 2 + (grid[i + 9] - grid[i + 1]) ** 2) AS g FROM cells WHERE i % 8 < 7 AND i < 56)
SELECT a.vec_id, least(greatest(corr(a.g, b.g), 0.0::DOUBLE), 1.0::DOUBLE) AS detail_retention FROM d a JOIN d b ON b.vec_id = a.vec_id + 1 AND a.i = b.i GROUP BY 1""")
def gradient_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _grid(spark, sf_dir).select("vec_id", arrays.gradient(F.col("grid"), 8).alias("g"))
    after = g.select((F.col("vec_id") - 1).alias("vec_id"), F.col("g").alias("g_next"))
    return g.join(after, "vec_id").select("vec_id", arrays.correlation(F.col("g"), F.col("g_next")).alias("detail_retention"))


@_query("""
SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.05) AS p05, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.99) AS p99 FROM lineitem GROUP BY 1, 2""")
def price_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of few groups that hold all rows."""
    return exact_percentiles(_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", {"p05": 0.05, "p50": 0.5, "p99": 0.99})


@_query("""
SELECT l_linestatus, l_returnflag, sum(l_discount * l_quantity) / sum(l_quantity) AS weighted_discount FROM lineitem GROUP BY 1, 2""")
def weighted_mean_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").groupBy("l_linestatus", "l_returnflag").agg(weighted_mean(F.col("l_discount"), F.col("l_quantity")).alias("weighted_discount"))


_MODES = list(decide.MODES)
_GATES = [("detail_loss", "detail", "<", 0.85), ("noise_increase", "noise", ">", 1.6), ("lab_shift", "lab", ">", 20.0)]


def _evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluations in long form made from the vectors: a row per vector and mode."""
    modes = F.explode(F.array(*[F.struct(F.lit(i).alias("priority"), F.lit(m).alias("mode"), F.lit(r).alias("risk")) for i, (m, r) in enumerate(decide.MODES.items())])).alias("m")
    rows = _grid(spark, sf_dir).select(F.col("vec_id").alias("image"), "grid", modes).select("image", "grid", "m.*")
    at = lambda k: F.get("grid", F.col("priority") + k)
    rows = rows.select("image", "mode", "risk", "priority", (at(0) * 0.1).alias("benefit"), F.abs(at(8)).alias("margin"), (1 - F.abs(at(16))).alias("detail"), (1 + 4 * F.abs(at(24))).alias("noise"), (100 * F.abs(at(32))).alias("lab"), (at(40) < 0.25).alias("region_passed"))
    rows = materialize(rows, "evaluations")  # each use has several branches
    return decide.gate(rows, [(n, F.col(c) < v if side == "<" else F.col(c) > v) for n, c, side, v in _GATES])


_EVAL = f"""{_GRID},
modes AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{m}', '{r}')" for i, (m, r) in enumerate(decide.MODES.items()))}) v(priority, mode, risk)),
raw AS (SELECT vec_id AS image, mode, risk, priority, grid[priority + 1] * 0.1::DOUBLE AS benefit, abs(grid[priority + 9]) AS margin, 1 - abs(grid[priority + 17]) AS detail,
  1 + 4 * abs(grid[priority + 25]) AS noise, 100 * abs(grid[priority + 33]) AS lab, grid[priority + 41] < 0.25 AS region_passed FROM grids, modes),
evals AS (SELECT *, NOT (detail < 0.85 OR noise > 1.6 OR lab > 20) AS passed FROM raw)"""


@_query(f"""
WITH {_EVAL} SELECT image, mode, concat_ws(',', CASE WHEN detail < 0.85 THEN 'detail_loss' END, CASE WHEN noise > 1.6 THEN 'noise_increase' END, CASE WHEN lab > 20 THEN 'lab_shift' END) AS reasons, passed FROM evals""")
def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluations(spark, sf_dir).select("image", "mode", F.array_join("reasons", ",").alias("reasons"), "passed")


@_query(f"""
WITH {_EVAL}, r AS (SELECT mode, 'detail_loss' AS reason FROM evals WHERE detail < 0.85 UNION ALL SELECT mode, 'noise_increase' FROM evals WHERE noise > 1.6 UNION ALL SELECT mode, 'lab_shift' FROM evals WHERE lab > 20)
SELECT mode, reason, count(*) AS n FROM r GROUP BY 1, 2""")
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.reason_histogram(_evaluations(spark, sf_dir))


@_query(f"""
WITH {_EVAL} SELECT mode, count(*) FILTER (WHERE passed) AS n_passed, count(*) FILTER (WHERE NOT passed) AS n_rejected, min(benefit) AS benefit_min, avg(benefit) AS benefit_mean,
quantile_cont(benefit, 0.5) AS benefit_median, quantile_cont(benefit, 0.9) AS benefit_p90, max(benefit) AS benefit_max FROM evals GROUP BY 1""")
def mode_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.mode_report(_evaluations(spark, sf_dir))


_WON = f"""{_EVAL}, grid_t AS (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in THRESHOLDS)}]) AS threshold),
able AS (SELECT * FROM evals, grid_t WHERE passed AND benefit >= threshold),
s1 AS (SELECT *, max(benefit) OVER (PARTITION BY image, threshold) AS top FROM able WHERE risk = 'normal'),
safe AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image, threshold ORDER BY margin DESC, priority) AS rn FROM s1 WHERE benefit >= top - 0.0005) WHERE rn = 1),
h1 AS (SELECT a.*, s.benefit AS sb FROM able a LEFT JOIN safe s USING (image, threshold) WHERE a.risk = 'higher' AND a.benefit >= a.threshold + 0.003 AND (s.benefit IS NULL OR a.benefit >= s.benefit + 0.002)),
h2 AS (SELECT *, max(benefit) OVER (PARTITION BY image, threshold) AS top FROM h1),
bold AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image, threshold ORDER BY margin DESC, priority) AS rn FROM h2 WHERE benefit >= top - 0.0005) WHERE rn = 1),
won AS (SELECT i.image, i.threshold, coalesce(b.mode, s.mode, 'raw_baseline') AS mode, coalesce(b.benefit, s.benefit, 0.0::DOUBLE) AS benefit, coalesce(b.margin, s.margin, 1.0::DOUBLE) AS margin
  FROM (SELECT DISTINCT image, threshold FROM evals, grid_t) i LEFT JOIN safe s USING (image, threshold) LEFT JOIN bold b USING (image, threshold)),
replayed AS (SELECT threshold, count(*) AS images, count(*) FILTER (WHERE w.mode <> 'raw_baseline') AS processed, coalesce(avg(w.benefit) FILTER (WHERE w.mode <> 'raw_baseline'), 0.0::DOUBLE) AS mean_benefit,
  coalesce(quantile_cont(w.benefit, 0.5) FILTER (WHERE w.mode <> 'raw_baseline'), 0.0::DOUBLE) AS median_benefit, coalesce(min(w.benefit) FILTER (WHERE w.mode <> 'raw_baseline'), 0.0::DOUBLE) AS min_benefit,
  count(*) FILTER (WHERE NOT region_passed) AS damaged FROM won w LEFT JOIN evals e ON w.image = e.image AND w.mode = e.mode GROUP BY 1),
told AS (SELECT *, processed::DOUBLE / images AS rate, processed >= 10 AND processed::DOUBLE / images >= 0.05 AND damaged = 0 AS eligible FROM replayed)"""


def _won(spark: SparkSession, sf_dir: str, grid: list[float]) -> DataFrame:
    return decide.winners(_evaluations(spark, sf_dir), spark.createDataFrame([(t,) for t in grid], "threshold double"))


@_query(f"WITH {_WON} SELECT * FROM won WHERE threshold = 0.02")
def winner_by_benefit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _won(spark, sf_dir, [0.02])


@_query(f"WITH {_WON} SELECT * FROM told")
def threshold_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _evaluations(spark, sf_dir)
    return decide.replay(decide.winners(rows, spark.createDataFrame([(t,) for t in THRESHOLDS], "threshold double")), rows)


@_query(f"""
WITH {_WON}, one AS (SELECT min(threshold) FILTER (WHERE eligible) AS a, min(threshold) FILTER (WHERE damaged = 0) AS b FROM told)
SELECT coalesce(a, b, 0.02::DOUBLE) AS threshold, CASE WHEN a IS NOT NULL THEN 'eligible' WHEN b IS NOT NULL THEN 'undamaged' ELSE 'default' END AS chosen_as FROM one""")
def threshold_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.choose_threshold(threshold_replay(spark, sf_dir))


@_query(f"""
WITH {_WON}, s AS (SELECT CASE WHEN image % 10 < 7 THEN 'train' WHEN image % 10 < 9 THEN 'val' ELSE 'test' END AS split, mode FROM won WHERE threshold = 0.02)
SELECT split, {', '.join(f"count(*) FILTER (WHERE mode = '{m}') AS {m}" for m in ['raw_baseline', *decide.MODES])} FROM s GROUP BY 1""")
def winner_by_split_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.pmod("image", F.lit(10))
    won = _won(spark, sf_dir, [0.02]).withColumn("split", F.when(at < 7, "train").when(at < 9, "val").otherwise("test"))
    return decide.winners_by_split(won, [decide.RAW, *_MODES])


_ROBIN = """r AS (SELECT doc_id, source, md5('314159|' || doc_id::VARCHAR) AS k, md5('314159|' || source) AS g FROM documents {where}),
t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id) AS turn FROM r)"""


@_query("WITH " + _ROBIN.format(where="") + " SELECT doc_id, source, turn::INT AS turn FROM t WHERE turn <= 6 ORDER BY turn, g, doc_id LIMIT 100")
def capped_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.capped_by_group(_table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 6, 100, 314159)


@_query("WITH " + _ROBIN.format(where="WHERE source NOT IN ('src1', 'src2')") + """, c AS (SELECT doc_id, source FROM t WHERE turn <= 6 ORDER BY turn, g, doc_id LIMIT 60),
a AS (SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src2'))
SELECT (SELECT count(*) FROM (SELECT doc_id FROM a INTERSECT SELECT doc_id FROM c)) AS shared_keys, (SELECT count(*) FROM (SELECT source FROM a INTERSECT SELECT source FROM c)) AS shared_groups,
  (SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM c GROUP BY source)) AS most_of_a_group, true AS independent""")
def sampling_independence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    smoke = docs.filter(F.col("source").isin("src1", "src2"))
    rest = docs.filter(~F.col("source").isin("src1", "src2"))
    return sampling.independence(smoke, sampling.capped_by_group(rest, "source", "doc_id", 6, 60, 314159), "doc_id", "source", 6)


@_query("""
WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT o_orderkey FROM o WHERE i IN (SELECT round_even(k * (n - 1) / 19.0::DOUBLE, 0) FROM (SELECT unnest(range(20)) AS k))""")
def evenly_spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.evenly_spaced(_table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 20)


@_query("""
WITH x AS (SELECT count(*) FILTER (WHERE a.doc_id IS NULL) AS missing, count(*) FILTER (WHERE e.doc_id IS NULL) AS extra FROM (SELECT DISTINCT doc_id FROM documents) e FULL JOIN (SELECT DISTINCT doc_id FROM labels) a USING (doc_id))
SELECT *, missing = 0 AND extra = 0 AS equal FROM x""")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.set_difference(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), "doc_id")


_PARTS = [f"sum(('0x' || substr(h, {1 + 12 * i}, 12))::BIGINT::HUGEINT * n)::VARCHAR" for i in range(5)]


@_query(f"""
WITH r AS (SELECT sha256('{{"path":"' || doc_id::VARCHAR || '","sha":"' || sha256(coalesce(text, '')) || '","split":"' || CASE WHEN slot < 70 THEN 'train' WHEN slot < 85 THEN 'val' ELSE 'test' END || '"}}') AS h
  FROM (SELECT *, ('0x' || substr(md5(coalesce(source, '')), 1, 8))::BIGINT % 100 AS slot FROM documents)),
c AS (SELECT h, count(*) AS n FROM r GROUP BY 1), g AS (SELECT substr(h, 1, 4) AS g, sum(n)::BIGINT AS n, sha256(concat_ws('|', substr(h, 1, 4), sum(n)::VARCHAR, {', '.join(_PARTS)})) AS h FROM c GROUP BY 1),
b AS (SELECT substr(g, 1, 2) AS b, sha256(string_agg(h, '' ORDER BY h)) AS h, sum(n)::BIGINT AS n FROM g GROUP BY 1)
SELECT sum(n)::BIGINT AS records, sha256(string_agg(h, '' ORDER BY h)) AS fingerprint FROM b""")
def canonical_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.certify import fingerprint

    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"), split.hash_split(F.col("source")).alias("split"))
    return fingerprint(docs, ["path", "sha", "split"])


@_query("""
WITH a AS (SELECT user_id, max(event_id) AS last FROM events WHERE 2 * event_id <= (SELECT max(event_id) FROM events) GROUP BY 1), n AS (SELECT user_id, max(event_id) AS last FROM events GROUP BY 1)
SELECT CASE WHEN a.last IS NULL THEN 'new' WHEN a.last = n.last THEN 'resumed' ELSE 'reprocessed' END AS state, count(*) AS users FROM n LEFT JOIN a USING (user_id) GROUP BY 1""")
def incremental_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.certify import resume_states

    events = _table(spark, sf_dir, "events")
    end = events.agg(F.max("event_id").alias("end")).scalar()
    last = lambda rows: rows.groupBy("user_id").agg(F.max("event_id").alias("fingerprint"))
    states = resume_states(last(events), last(events.filter(2 * F.col("event_id") <= end)), "user_id", "fingerprint")
    return states.groupBy("state").agg(F.count("*").alias("users"))
