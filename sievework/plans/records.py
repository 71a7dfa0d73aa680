"""Annotation, box, label, index, log and report operators applied to the driver's tables, with their SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes, naming, rules
from ..operators import audit, certify, decide, dedup, split
from ..shared import broadcast_if_small, materialize, shared_path
from ..sources import coco, indexes, reports
from ..sources.images import read_texts, write_files, write_parts
from ..sources.progress import read_progress
from ..streaming import progress as live
from .analogues import _table

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# Boxes: a lineitem is a box on an image of 640 x 400 pixels

_X, _Y, _W, _H = "(l_partkey % 620 - 3)::DOUBLE", "(l_suppkey * 7 % 395 - 1)::DOUBLE", "(l_quantity - 1)::DOUBLE", "(l_linenumber * 10)::DOUBLE"
_BOX = f"""box AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey, l_suppkey, l_shipdate, CASE WHEN l_tax > 0.075 THEN [{_X}, {_Y}, {_W}] WHEN l_discount > 0.095 THEN [{_X}, 'nan'::DOUBLE, {_W}, {_H}] ELSE [{_X}, {_Y}, {_W}, {_H}] END AS b FROM lineitem)"""
_SOUND = "len(b) = 4 AND NOT isnan(b[2]) AND b[3] > 0 AND b[4] > 0 AND b[1] >= 0 AND b[2] >= 0 AND b[1] + b[3] <= 640.001 AND b[2] + b[4] <= 400.001"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.pmod("l_partkey", F.lit(620)) - 3, F.pmod(F.col("l_suppkey") * 7, F.lit(395)) - 1
    parts = [v.cast("double") for v in (x, y, F.col("l_quantity") - 1, F.col("l_linenumber") * 10)]
    box = F.when(F.col("l_tax") > 0.075, F.array(*parts[:3])).when(F.col("l_discount") > 0.095, F.array(parts[0], F.lit(float("nan")), *parts[2:])).otherwise(F.array(*parts))
    return _table(spark, sf_dir, "lineitem").withColumn("b", box)


@_query(f"""
WITH {_BOX} SELECT CASE WHEN len(b) <> 4 THEN 'not_xywh' WHEN isnan(b[2]) THEN 'non_numeric' WHEN b[3] <= 0 OR b[4] <= 0 THEN 'non_positive_size' WHEN b[1] < 0 OR b[2] < 0 THEN 'negative_origin'
  WHEN b[1] + b[3] > 640.001 THEN 'exceeds_width' WHEN b[2] + b[4] > 400.001 THEN 'exceeds_height' ELSE 'ok' END AS problem, count(*) AS n FROM box GROUP BY 1""")
def box_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    problem = boxes.box_problem(F.col("b"), F.lit(640), F.lit(400))
    return audit.count_by(_boxes(spark, sf_dir).select(F.coalesce(problem, F.lit("ok")).alias("problem")), "problem")


@_query(f"""
WITH {_BOX} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, printf('0 %.8f %.8f %.8f %.8f', least(greatest((b[1] + b[3] / 2) / 640, 0), 1), least(greatest((b[2] + b[4] / 2) / 400, 0), 1), least(b[3] / 640, 1), least(b[4] / 400, 1)) AS line FROM box WHERE {_SOUND}""")
def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound boxes as lines of a label file."""
    w, h = F.lit(640), F.lit(400)
    sound = _boxes(spark, sf_dir).filter(boxes.box_problem(F.col("b"), w, h).isNull())
    return sound.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", boxes.label_line(boxes.to_yolo(F.col("b"), w, h)).alias("line"))


_LINE = "concat_ws(' ', (l_linenumber % 4 // 3)::VARCHAR, (l_discount * 12)::DECIMAL(8,4)::VARCHAR, CASE WHEN l_quantity = 7 THEN 'x' ELSE '0.5' END, (l_tax * 13)::DECIMAL(8,4)::VARCHAR, CASE WHEN l_quantity > 48 THEN NULL ELSE '0.25' END)"


@_query(f"""
WITH t AS (SELECT l_orderkey, {_LINE} AS line FROM lineitem), p AS (SELECT *, string_split(line, ' ') AS c FROM t),
v AS (SELECT *, CASE WHEN len(c) <> 5 THEN 'not_five_columns' WHEN try_cast(c[3] AS DOUBLE) IS NULL THEN 'not_numeric' WHEN c[1] <> '0' THEN 'unknown_class'
  WHEN NOT (c[2]::DOUBLE BETWEEN 0 AND 1) THEN 'center_out_of_range' WHEN NOT (c[4]::DOUBLE > 0 AND c[4]::DOUBLE <= 1) THEN 'size_out_of_range' ELSE 'ok' END AS problem FROM p)
SELECT problem, count(*) AS n FROM v GROUP BY 1""")
def label_line_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.count_by(_lines(spark, sf_dir).select(F.coalesce(boxes.label_problem(F.col("line")), F.lit("ok")).alias("problem")), "problem")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = lambda c, k: (F.col(c) * k).cast("decimal(8,4)").cast("string")
    kind = F.floor(F.pmod("l_linenumber", F.lit(4)) / 3).cast("string")
    parts = [kind, number("l_discount", 12), F.when(F.col("l_quantity") == 7, "x").otherwise("0.5"), number("l_tax", 13), F.when(F.col("l_quantity") <= 48, "0.25")]
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat_ws(" ", *parts).alias("line"))


@_query(f"""
WITH t AS (SELECT l_orderkey, {_LINE} AS line FROM lineitem), g AS (SELECT l_orderkey, count(*) AS n, list(line) AS lines FROM t GROUP BY 1)
SELECT CASE WHEN n <> 1 + l_orderkey % 5 THEN 'line_count' WHEN len(list_filter(lines, lambda x: len(string_split(x, ' ')) <> 5 OR try_cast(string_split(x, ' ')[3] AS DOUBLE) IS NULL OR x[1] <> '0'
  OR NOT (string_split(x, ' ')[2]::DOUBLE BETWEEN 0 AND 1) OR NOT (string_split(x, ' ')[4]::DOUBLE > 0 AND string_split(x, ' ')[4]::DOUBLE <= 1))) > 0 THEN 'bad_line' ELSE 'ok' END AS problem, count(*) AS n FROM g GROUP BY 1""")
def label_file_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label files, an order's lines each, against the number of boxes that they should have."""
    files = _lines(spark, sf_dir).groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("text"))
    problem = boxes.label_file_problem(F.col("text"), 1 + F.pmod("l_orderkey", F.lit(5)))
    told = F.when(problem.isNull(), "ok").when(problem == "line_count", problem).otherwise("bad_line")
    return audit.count_by(files.select(told.alias("problem")), "problem")


@_query(f"""
WITH {_BOX}, s AS (SELECT l_orderkey, b[3] * b[4] / 256000.0::DOUBLE AS r FROM box WHERE len(b) = 4)
SELECT l_orderkey, count(*) FILTER (WHERE r < 0.0015) AS tiny, count(*) FILTER (WHERE r >= 0.0015 AND r < 0.0075) AS small, count(*) FILTER (WHERE r >= 0.0075) AS medium_large FROM s GROUP BY 1
UNION ALL SELECT l_orderkey, 0, 0, 0 FROM box GROUP BY 1 HAVING count(*) FILTER (WHERE len(b) = 4) = 0""")
def size_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of each size class on an order's image; boxes that are not four numbers are skipped."""
    lists = _boxes(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_list("b").alias("boxes"))
    counts = lists.select("l_orderkey", boxes.size_counts(F.col("boxes"), F.lit(640), F.lit(400)).alias("c"))
    return counts.select("l_orderkey", *[F.col(f"c.{k}").cast("long").alias(k) for k in ("tiny", "small", "medium_large")])


_PAD = "greatest(b[{i}] * 0.2::DOUBLE, 24)"


@_query(f"""
WITH {_BOX} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(floor(b[1] - {_PAD.format(i=3)}), 0)::BIGINT AS "left", greatest(floor(b[2] - {_PAD.format(i=4)}), 0)::BIGINT AS top,
  least(ceil(b[1] + b[3] + {_PAD.format(i=3)}), 640)::BIGINT AS "right", least(ceil(b[2] + b[4] + {_PAD.format(i=4)}), 400)::BIGINT AS bottom FROM box WHERE {_SOUND}""")
def protected_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.lit(640), F.lit(400)
    sound = _boxes(spark, sf_dir).filter(boxes.box_problem(F.col("b"), w, h).isNull())
    return sound.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", boxes.protected_region(F.col("b"), w, h).alias("r")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "r.*")


@_query("""
WITH s AS (SELECT l_orderkey, list_sort(list([l_linenumber::DOUBLE, round(l_quantity / 3.0::DOUBLE, 4)])) AS sign FROM lineitem GROUP BY 1)
SELECT count(*) AS orders, count(DISTINCT sign) AS signatures, max(len(sign)) AS most FROM s""")
def box_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of boxes that do not depend on their order."""
    box = F.array(F.col("l_linenumber").cast("double"), F.col("l_quantity") / 3.0)
    signs = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(box).alias("boxes")).select("boxes", dedup.signature(F.col("boxes")).alias("sign"))
    return signs.agg(F.count("*").alias("orders"), F.count_distinct("sign").alias("signatures"), F.max(F.size("boxes")).alias("most"))


@_query("""
SELECT p_brand, count(*) FILTER (WHERE regexp_full_match(trim(x), '[0-9]+([.][0-9]+)?')) AS numbers, count(*) FILTER (WHERE abs(try_cast(x AS DOUBLE) - 7) <= 0.000000000001) AS sevens FROM
(SELECT p_brand, CASE p_partkey % 4 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN ' 7 ' WHEN 2 THEN 'NaN' ELSE p_name END AS x FROM part) GROUP BY 1""")
def number_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts are finite numbers, and which are near seven."""
    at = F.pmod("p_partkey", F.lit(4))
    x = F.when(at == 0, F.col("p_size").cast("string")).when(at == 1, " 7 ").when(at == 2, "NaN").otherwise(F.col("p_name"))
    rows = _table(spark, sf_dir, "part").select("p_brand", x.alias("x"))
    return rows.groupBy("p_brand").agg(F.count_if(rules.valid_number(F.col("x"))).alias("numbers"), F.count_if(rules.close_to(F.col("x"), 7.0)).alias("sevens"))


@_query(r"""
SELECT page_id, 'data/train/' || page_id::VARCHAR || '.jpg' AS source, page_id::VARCHAR || '.jpg' AS below, lpad((page_id % 100)::VARCHAR, 2, '0') AS number FROM pages""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("page_id").cast("string"), F.lit(".jpg"))
    source = naming.source_path(F.lit("data//."), F.lit("train"), name)
    return _table(spark, sf_dir, "pages").select("page_id", source.alias("source"), naming.relative_path(source, F.lit("data\\train/")).alias("below"), naming.numbered(F.pmod("page_id", F.lit(100))).alias("number"))


# Annotation documents: suppliers are images, parts their annotations

_DOC = """img AS (SELECT s_suppkey AS id, ['train', 'valid', 'test'][s_suppkey % 3 + 1] AS split, 'img' || s_suppkey::VARCHAR || '.png' AS file_name, 640 AS width, 400 AS height FROM supplier),
top AS (SELECT max(s_suppkey) + 2 AS n FROM supplier),
ann AS (SELECT p_partkey AS id, p_partkey % (SELECT n FROM top) AS image_id, ['train', 'valid', 'test'][(p_partkey % (SELECT n FROM top)) % 3 + 1] AS split, 1 + p_size % 7 AS category_id,
  [(p_size * 13 - 10)::DOUBLE, (p_partkey % 400 - 2)::DOUBLE, (p_size % 9 * 8)::DOUBLE, (p_partkey % 31)::DOUBLE] AS b FROM part),
cat AS (SELECT * FROM (VALUES (1, 'fish'), (2, 'small_fish'), (3, 'crab'), (4, 'shrimp'), (5, 'jellyfish'), (6, 'starfish')) c(category_id, category)),
aud AS (SELECT ann.*, file_name, category, CASE WHEN file_name IS NULL THEN 'orphan_annotation' WHEN category IS NULL THEN 'unknown_category' WHEN b[3] <= 0 OR b[4] <= 0 THEN 'non_positive_size' WHEN b[1] < 0 OR b[2] < 0 THEN 'negative_origin'
  WHEN b[1] + b[3] > 640.001 THEN 'exceeds_width' WHEN b[2] + b[4] > 400.001 THEN 'exceeds_height' END AS problem FROM ann LEFT JOIN img ON img.split = ann.split AND img.id = image_id LEFT JOIN cat USING (category_id))"""
_CATEGORIES = (" Fish", "small_fish", "crab ", "Shrimp", "jellyfish", "starfish")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON, one for each split and item by item, and read back."""
    folder = shared_path(spark, "coco")
    splits = F.array(*[F.lit(s) for s in coco.SPLITS])
    of = lambda c: F.get(splits, F.pmod(c, F.lit(3)).cast("int"))
    supplier, part = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "part")
    image = F.struct(F.col("s_suppkey").alias("id"), F.concat(F.lit("img"), F.col("s_suppkey").cast("string"), F.lit(".png")).alias("file_name"), F.lit(640).alias("width"), F.lit(400).alias("height"))
    n = supplier.agg(F.max("s_suppkey") + 2).first()[0]
    owner = F.pmod("p_partkey", F.lit(n))
    box = F.array(*[c.cast("double") for c in (F.col("p_size") * 13 - 10, F.pmod("p_partkey", F.lit(400)) - 2, F.pmod("p_size", F.lit(9)) * 8, F.pmod("p_partkey", F.lit(31)))])
    note = F.struct(F.col("p_partkey").alias("id"), owner.alias("image_id"), (1 + F.pmod("p_size", F.lit(7))).cast("long").alias("category_id"), box.alias("bbox"))
    named = json.dumps([{"id": i + 1, "name": c} for i, c in enumerate(_CATEGORIES)])
    kinds = "split string, kind int, id long, text string"
    frame = spark.createDataFrame([(s, k, 0, t) for s in coco.SPLITS for k, t in ((0, f'{{"categories":{named},"images":['), (2, '],"annotations":['), (4, "]}"))], kinds)
    rows = frame.unionByName(supplier.select(of(F.col("s_suppkey")).alias("split"), F.lit(1).alias("kind"), F.col("s_suppkey").cast("long").alias("id"), F.to_json(image).alias("text")))
    rows = rows.unionByName(part.select(of(owner).alias("split"), F.lit(3).alias("kind"), F.col("p_partkey").cast("long").alias("id"), F.to_json(note).alias("text")))
    first = rows.filter("kind IN (1, 3)").groupBy("split", "kind").agg(F.min("id").alias("first"))  # no comma goes before it
    comma = F.when(F.col("id") > F.col("first"), ",").otherwise("")
    items = rows.join(F.broadcast(first), ["split", "kind"], "left").select(F.concat("split", F.lit("/" + coco.FILE)).alias("name"), "kind", "id", F.concat(comma, "text").cast("binary").alias("content"))
    materialize(write_parts(items, folder, "kind", "id"), "written")
    if missing := coco.missing_parts(folder):
        raise ValueError(f"no document for {missing}")
    return coco.read_documents(spark, folder)


@_query(f"WITH {_DOC} SELECT split, coalesce(problem, 'ok') AS problem, count(*) AS n FROM aud GROUP BY 1, 2")
def document_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations by split and by the first thing that is wrong with them."""
    return audit.count_by(coco.audited(_documents(spark, sf_dir)).select("split", F.coalesce("problem", F.lit("ok")).alias("problem")), "split", "problem")


@_query(f"""
WITH {_DOC} SELECT img.split, img.id AS image_id, count(*) FILTER (WHERE problem IS NULL AND category = 'fish') AS fish_count, count(*) FILTER (WHERE problem IS NULL AND category = 'small_fish') AS small_fish_count,
  count(*) FILTER (WHERE problem IS NULL AND category IN ('fish', 'small_fish')) AS target_count, count(*) FILTER (WHERE problem IS NULL AND category NOT IN ('fish', 'small_fish')) AS non_target_count
FROM img LEFT JOIN aud ON aud.split = img.split AND aud.image_id = img.id GROUP BY 1, 2""")
def image_target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coco.image_counts(_documents(spark, sf_dir), ["fish", "small_fish"]).select("split", "image_id", "fish_count", "small_fish_count", "target_count", "non_target_count")


@_query(f"""
WITH {_DOC}, ok AS (SELECT *, printf('0 %.8f %.8f %.8f %.8f', least(greatest((b[1] + b[3] / 2) / 640, 0), 1), least(greatest((b[2] + b[4] / 2) / 400, 0), 1), b[3] / 640, b[4] / 400) || chr(10) AS line FROM aud WHERE problem IS NULL AND category IN ('fish', 'small_fish'))
SELECT img.split, img.file_name, coalesce(string_agg(line, '' ORDER BY ok.id), '') AS label FROM img LEFT JOIN ok ON ok.split = img.split AND ok.image_id = img.id GROUP BY 1, 2""")
def label_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label file of every image: two categories merged into one class."""
    return coco.label_files(_documents(spark, sf_dir), ["fish", "small_fish"])


@_query(f"""
WITH {_DOC}, f AS (SELECT split, file_name, CASE WHEN id % 5 = 1 THEN 0 ELSE 640 END AS w, CASE WHEN id % 7 = 2 THEN 300 ELSE 400 END AS h FROM img WHERE id % 4 > 0 UNION ALL SELECT 'train', 'more.png', 640, 400),
k AS (SELECT * FROM (VALUES {', '.join(f"('{x}')" for x in coco.FATAL)}) k(issue)),
i AS (SELECT 'missing_image' AS issue FROM img WHERE id % 4 = 0 UNION ALL SELECT 'unlisted_file'
  UNION ALL SELECT CASE WHEN w < 1 THEN 'undecodable_image' ELSE 'size_mismatch' END FROM f JOIN img USING (split, file_name) WHERE w < 1 OR w <> 640 OR h <> 400
  UNION ALL SELECT CASE WHEN problem IN ('orphan_annotation', 'unknown_category') THEN problem ELSE 'invalid_box' END FROM aud WHERE problem IS NOT NULL
  UNION ALL SELECT 'missing_target_category' FROM (SELECT DISTINCT split FROM img)),
n AS (SELECT issue, count(i.issue) AS n FROM k LEFT JOIN i USING (issue) GROUP BY 1)
SELECT * FROM n UNION ALL SELECT 'total', sum(n)::BIGINT FROM n""")
def source_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All issues of a source by kind: its files, sizes, annotations and categories."""
    docs = materialize(_documents(spark, sf_dir), "documents")
    id_ = F.regexp_extract("file_name", "([0-9]+)", 1).cast("int")
    files = coco.images(docs).filter(F.pmod(id_, F.lit(4)) > 0).select("split", "file_name", F.when(F.pmod(id_, F.lit(5)) == 1, 0).otherwise(640).alias("width"), F.when(F.pmod(id_, F.lit(7)) == 2, 300).otherwise(400).alias("height"))
    files = files.unionByName(spark.createDataFrame([("train", "more.png", 640, 400)], "split string, file_name string, width int, height int"))
    return coco.issue_counts(docs, files, ["fish", "small_fish", "whale"])


@_query("""
SELECT s_suppkey::VARCHAR || '.png' AS prepared_image, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 + s_suppkey % 3 END AS n, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey * 0.5::DOUBLE END AS first_x, s_nationkey::INT AS width FROM supplier""")
def index_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both indexes of a prepared dataset, written as JSON, read back and joined."""
    folder = shared_path(spark, "index")
    supplier = _table(spark, sf_dir, "supplier")
    key = F.concat(F.col("s_suppkey").cast("string"), F.lit(".png"))
    image = F.struct(key.alias("prepared_image"), F.lit("train").alias("split"), F.col("s_nationkey").alias("width"), F.array(F.lit("x")).alias("duplicate_sources"))
    note = F.struct(F.lit(0).alias("class_id"), F.lit("fish").alias("class_name"), F.array(F.col("s_suppkey") * 0.5, F.lit(1.0), F.lit(2.0), F.lit(3.0)).alias("bbox_xywh"))
    some = supplier.filter(F.pmod("s_suppkey", F.lit(4)) != 0)
    indexes.write_image_index(supplier.select(image.alias("i")).select("i.*"), f"{folder}/images")
    indexes.write_annotation_index(some.select(key.alias("image"), F.array_repeat(note, (1 + F.pmod("s_suppkey", F.lit(3))).cast("int")).alias("annotations")), f"{folder}/annotations")
    joined = indexes.with_annotations(indexes.read_image_index(spark, f"{folder}/images"), indexes.read_annotation_index(spark, f"{folder}/annotations"))
    return joined.select("prepared_image", F.size("annotations").alias("n"), F.get(F.get("annotations", F.lit(0))["bbox_xywh"], F.lit(0)).alias("first_x"), "width")


@_query("SELECT doc_id::VARCHAR AS prepared_image, md5(coalesce(text, '')) AS text_md5, source AS deployment, n_chars::INT AS width FROM documents")
def json_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, brackets and escapes in JSON documents, each of which several tasks read."""
    folder = shared_path(spark, "texts")
    named = {"prepared_image": F.col("doc_id").cast("string"), "source_relative_path": F.coalesce("text", F.lit("")), "deployment": F.col("source"), "width": F.col("n_chars").cast("int")}
    indexes.write_image_index(_table(spark, sf_dir, "documents").select(*[c.alias(n) for n, c in named.items()]), folder)
    read = indexes.read_image_index(spark, folder, 1 << 18)
    return read.select("prepared_image", F.md5(F.col("source_relative_path").cast("binary")).alias("text_md5"), "deployment", "width")


@_query("SELECT source || '/' || doc_id::VARCHAR || '.txt' AS name, octet_length(encode(coalesce(text, ''))) AS length, sha256(coalesce(text, '')) AS sha256, sha256(coalesce(text, '')) AS read_back FROM documents")
def published_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each text, all of which become visible together; the manifest, and what is then read from the files."""
    folder = shared_path(spark, "published")
    texts = _table(spark, sf_dir, "documents").select(F.format_string("%s/%d.txt", "source", "doc_id").alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    manifest = write_files(texts, folder)
    read = read_texts(manifest, folder).select("name", F.sha2("text", 256).alias("read_back"))
    return manifest.join(read, "name")


# Copies, splits and sets


@_query("""
WITH c AS (SELECT sha256(coalesce(text, '')) AS content_sha, min(doc_id) AS canonical, count(*) - 1 AS duplicates, max(doc_id) AS last FROM documents GROUP BY 1 HAVING count(*) > 1) SELECT * FROM c""")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_sources(_table(spark, sf_dir, "documents"), "doc_id", "text")


@_query("""
WITH h AS (SELECT doc_id, source, ('0x' || substr(md5(coalesce(source, '')), 1, 8))::BIGINT % 100 AS slot FROM documents)
SELECT doc_id, CASE WHEN slot < 70 THEN 'train' WHEN slot < 85 THEN 'val' ELSE 'test' END AS split FROM h""")
def assigned_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records joined to the split of their group, groups that were counted few being broadcast."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    groups = docs.select(F.coalesce("source", F.lit("")).alias("g")).distinct().withColumn("split", split.hash_split(F.col("g")))
    return docs.join(broadcast_if_small(groups), F.coalesce("source", F.lit("")) == F.col("g")).select("doc_id", "split")


@_query("""
SELECT source, count(DISTINCT lang) FILTER (WHERE lang IN ('en', 'de')) = 2 AS has_all, count(*) AS n FROM documents GROUP BY 1""")
def required_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts united, and whether each group has all that is required."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    both = docs.filter(F.pmod("doc_id", F.lit(3)) == 0).unionByName(docs.filter(F.pmod("doc_id", F.lit(3)) != 0))
    return audit.required_values(both, "source", "lang", ["en", "de"])


@_query(f"SELECT doc_id, m.mode, m.risk FROM documents, (VALUES {', '.join(f'({chr(39)}{m}{chr(39)}, {chr(39)}{r}{chr(39)})' for m, r in decide.MODES.items())}) m(mode, risk) WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def candidate_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pool of records by look-up, and each of them with all modes."""
    pool = _table(spark, sf_dir, "documents").select("doc_id").join(_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id", "left_semi")
    return decide.with_modes(pool).select("doc_id", "mode", "risk")


# Logs, checkpoints, reports


@_query("SELECT user_id AS key, max(event_id) AS n, arg_max(event_type, event_id) AS kind FROM events GROUP BY 1 UNION ALL SELECT -1, 2, 'late'")
def progress_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of JSON lines with repeated keys, in files by the order of events, and one whose last line is torn, read as each key's last record."""
    folder = shared_path(spark, "log")
    lines = F.to_json(F.struct(F.col("user_id").alias("key"), F.col("event_id").alias("n"), F.col("event_type").alias("kind")))
    _table(spark, sf_dir, "events").repartitionByRange("event_id").sortWithinPartitions("event_id").select(lines.alias("value")).write.text(f"{folder}/a")
    torn = spark.createDataFrame([("z.txt", b'{"key": -1, "n": 1, "kind": "early"}\n{"key": -1, "n": 2, "kind": "late"}\n{"key": -1, "n"')], "name string, content binary")
    materialize(write_files(torn, f"{folder}/b"), "written")
    schema = spark.createDataFrame([], "key long, n long, kind string").schema
    return read_progress(spark, f"{folder}/*", schema, "key").select("key", "n", "kind")


@_query("SELECT user_id AS key, max(event_id) AS n, arg_max(event_type, event_id) AS kind FROM events GROUP BY 1")
def streamed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a log that is read as a stream: one half of its files, then, after a restart, the other."""
    folder = shared_path(spark, "stream")
    rows = _table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("n"), F.col("event_type").alias("kind"))
    half = rows.agg(F.max("n")).first()[0] // 2
    schema = spark.createDataFrame([], "key long, n long, kind string").schema
    for part, some in (("0", rows.filter(F.col("n") <= half)), ("1", rows.filter(F.col("n") > half))):
        some.repartitionByRange("n").sortWithinPartitions("n").select(F.to_json(F.struct("key", "n", "kind")).alias("value")).write.text(f"{folder}/log/{part}")
        live.keep_latest(live.latest_records(live.read_log(spark, f"{folder}/log/*", schema, "key"), "key"), f"{folder}/out", f"{folder}/mark").awaitTermination()
    return live.read_latest(spark, f"{folder}/out", "key").select("key", "n", "kind")


@_query("""
WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS m FROM documents), x AS (SELECT doc_id, m, CASE WHEN doc_id % 7 = 0 THEN 'old' ELSE m END AS was, CASE WHEN doc_id % 11 = 0 THEN 'gone' ELSE md5(m) END AS out FROM d)
SELECT doc_id FROM x WHERE was = m AND out = md5(m)""")
def valid_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished records whose source and output are as the log has them."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("m"))
    out = F.md5(F.col("m").cast("binary"))
    done = rows.select("doc_id", F.when(F.pmod("doc_id", F.lit(7)) == 0, "old").otherwise(F.col("m")).alias("mark"), F.col("doc_id").cast("string").alias("name"), out.alias("sha256"))
    files = rows.select(F.col("doc_id").cast("string").alias("name"), F.when(F.pmod("doc_id", F.lit(11)) == 0, "gone").otherwise(out).alias("sha256"))
    return certify.valid_checkpoints(done, rows, files, "doc_id", {"mark": "m"}).select("doc_id")


@_query("""
SELECT reason, count(*) AS n FROM (SELECT 'missing' AS reason FROM documents WHERE doc_id % 9 = 0 UNION ALL SELECT 'n_chars differs' FROM documents WHERE doc_id % 9 > 0 AND doc_id % 5 = 0 UNION ALL SELECT 'extra' FROM documents WHERE doc_id % 4 = 1) GROUP BY 1""")
def output_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is missing, extra or different among outputs."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    told = docs.filter(F.pmod("doc_id", F.lit(9)) != 0).withColumn("n_chars", F.when(F.pmod("doc_id", F.lit(5)) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    more = docs.filter(F.pmod("doc_id", F.lit(4)) == 1).select((-1 - F.col("doc_id")).alias("doc_id"), "n_chars")
    return audit.count_by(certify.verify(docs, told.unionByName(more), "doc_id", ["n_chars"]), "reason")


@_query("""
SELECT 'train/images/' || doc_id::VARCHAR || '.png' AS source_prepared_image, source AS deployment, n_chars % 3 AS target_count, CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END AS processed, md5(doc_id::VARCHAR) AS output_image_sha256 FROM documents""")
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of a run, written as JSON lines and as CSV, and read back from both."""
    folder = shared_path(spark, "manifest")
    rows = _table(spark, sf_dir, "documents").select(
        F.format_string("train/images/%d.png", "doc_id").alias("source_prepared_image"), F.col("source").alias("deployment"), F.pmod("n_chars", F.lit(3)).alias("target_count"),
        (F.pmod("doc_id", F.lit(2)) == 0).alias("processed"), F.md5(F.col("doc_id").cast("string").cast("binary")).alias("output_image_sha256"), F.create_map(F.lit("a"), F.lit(1)).alias("rejections"),
    )
    reports.write_manifest(rows, folder)
    csv = spark.read.option("header", True).csv(f"{folder}/csv").select("source_prepared_image", "deployment", F.col("target_count").cast("long").alias("target_count"), "processed")
    lines = spark.read.schema(rows.schema).json(f"{folder}/jsonl").select("source_prepared_image", "output_image_sha256")
    return csv.join(lines, "source_prepared_image")


@_query("SELECT p_partkey AS sample_number, 'positive' AS sample_type, p_name AS selection_reason, p_size::BIGINT AS target_count, p_retailprice AS winner_benefit_score FROM part")
def decision_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions written as CSV and read back."""
    folder = shared_path(spark, "decisions")
    given = {"sample_number": F.col("p_partkey"), "sample_type": F.lit("positive"), "selection_reason": F.col("p_name"), "target_count": F.col("p_size"), "winner_benefit_score": F.col("p_retailprice")}
    rows = _table(spark, sf_dir, "part").select(*[given.get(c, F.lit("-")).alias(c) for c in reports.DECISION_COLUMNS])
    reports.write_decisions(rows, folder)
    read = spark.read.option("header", True).csv(folder)
    return read.select(F.col("sample_number").cast("long").alias("sample_number"), "sample_type", "selection_reason", F.col("target_count").cast("long").alias("target_count"), F.col("winner_benefit_score").cast("double").alias("winner_benefit_score"))


@_query("""SELECT sha256('{"modes":["a","b"],"name":"ü","threshold":0.02}') AS fingerprint, sha256('{"modes":["a","b"],"name":"\\u00fc","threshold":0.02}') AS ascii_fingerprint""")
def object_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of a small object, whatever the order of its keys."""
    value = {"threshold": 0.02, "name": "ü", "modes": ["a", "b"]}
    return spark.range(1).select(F.lit(certify.canonical_hash(value)).alias("fingerprint"), F.lit(certify.canonical_hash(value, True)).alias("ascii_fingerprint"))


@_query("""
SELECT source, CASE WHEN upper(trim(lang)) IN ('EN', 'DE') THEN 'fish' ELSE 'other' END AS class, count(*) AS n FROM documents GROUP BY 1, 2""")
def merged_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories merged into one class, the others together."""
    return audit.count_by(_table(spark, sf_dir, "documents").select("source", naming.merged_class(F.col("lang"), ["EN", "DE"], "fish").alias("class")), "source", "class")


def _split_of(doc_id: Column) -> Column:
    at = F.pmod(doc_id, F.lit(10))
    return F.when(at < 7, "train").when(at < 9, "val").otherwise("test")


@_query("""
WITH s AS (SELECT count(*) FILTER (WHERE doc_id % 10 < 7) AS train, count(*) AS n, count(DISTINCT doc_id) AS d FROM documents)
SELECT k AS number, CASE k WHEN 12 THEN n = d WHEN 13 THEN train = 700 WHEN 8 THEN false WHEN 11 THEN false ELSE true END AS passed FROM s, (SELECT unnest(range(1, 14))::INT AS k)""")
def preflight_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks before a full run, on reports of which one says that calibration was unsafe and one that a sample is too small."""
    at = _split_of(F.col("doc_id"))
    named = lambda folder: F.concat_ws("/", at, F.lit(folder), F.col("doc_id").cast("string"))
    rows = materialize(_table(spark, sf_dir, "documents").select(named("images").alias("image"), named("labels").alias("label"), at.alias("split")), "records")
    told = {r["split"]: r["n"] for r in audit.count_by(rows, "split").collect()}
    trial = {"policy_version": "v", "calibrated_minimum_improvement": 0.02, "runtime_selector_label_free": True, "winner_roi_audit_failures": 0}
    neutral = dict.fromkeys(("annotations_used_for_runtime_selection", "class_labels_used_for_threshold_reward", "positive_images_rewarded", "negative_images_penalized"), False)
    calibration = {"policy_version": "v", "selected_threshold": 0.02, "runtime_selector": "label_free", "calibration_safe": False, "threshold_analysis": [{"threshold": 0.02, "roi_unsafe_selected": 0, "eligible_for_selection": True}], **neutral}
    how = {"smoke_deployments_excluded_from_calibration": True, "group_aware_round_robin": True, "positive_and_negative_share_deployment_cap": True, "maximum_calibration_images_per_deployment": 6}
    sample = {"policy_version": "v", "status": " passed ", "policy": how, "counts": {"smoke_images": 19}, "checks": {f"{k}_overlap{s}": v for k in ("image", "deployment") for s, v in (("_count", 0), ("_passed", True), ("", []))}}
    config = {"policy_version": "v", "threshold": 0.02, "modes": 8, "cap": 6, "trial_images": 20, "splits": told | {"train": 700}}
    found = certify.preflight(trial, calibration, sample, rows, config)
    return spark.createDataFrame([(n, ok) for n, _, ok in found], "number int, passed boolean")


@_query("""
SELECT 'report' AS file, '{"a":"ü","b":[1,2.5],"c":null}' AS content UNION ALL SELECT 'none', '{}' UNION ALL SELECT 'yaml',
  'path: "/data/x"' || chr(10) || 'train: train/images' || chr(10) || 'val: val/images' || chr(10) || 'test: test/images' || chr(10) || 'names:' || chr(10) || '  0: "fish"' || chr(10) || 'nc: 1' || chr(10)""")
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small reports written whole, replaced, and read back; a missing one counts as empty."""
    folder = shared_path(spark, "reports")
    reports.write_json(f"{folder}/report.json", {"old": True})
    reports.write_json(f"{folder}/report.json", {"b": [1, 2.5], "a": "ü", "c": None})
    told = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    rows = [("report", told(reports.read_object(f"{folder}/report.json"))), ("none", told(reports.read_object(f"{folder}/none.json"))), ("yaml", reports.dataset_yaml("/data/x", {0: "fish"}, True))]
    return spark.createDataFrame(rows, "file string, content string")
