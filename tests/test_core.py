"""The relational core, sources, pixels, stages and streams."""

import hashlib
import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions import boxes, naming, rules
from sievework.operators import certify, decide, kernels, percentiles, pixels, sampling, split
from sievework.plans import curation, stages
from sievework.plans.registry import QUERIES, SQL
from sievework import __main__ as command
from sievework.sources import bigjson, coco, filecache, filesink, images, indexes, progress, reports, runlog
from sievework.streaming import incremental
from sievework.streaming import progress as live

SF = "/root/testdata/sf0.001"


def shown(x):
    return f"{x:.6g}" if isinstance(x, float) else str(int(x)) if isinstance(x, (bool, np.bool_)) else str(x)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    mine = sorted(tuple(shown(r[c]) for c in names) for r in got.collect())
    if name not in SQL:
        assert mine
        return
    db = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        db.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    found = db.execute(SQL[name])
    told = [d[0] for d in found.description]
    assert sorted(told) == names
    theirs = sorted(tuple(shown(dict(zip(told, r, strict=True))[c]) for c in names) for r in found.fetchall())
    assert mine == theirs


def test_box_rules_and_labels(spark):
    cases = [([1.0, 2.0, 3.0], "not_xywh"), (None, "not_xywh"), ([1.0, float("nan"), 2.0, 2.0], "non_numeric"), ([1.0, 1.0, 0.0, 5.0], "non_positive_size"), ([-1.0, 1.0, 5.0, 5.0], "negative_origin"), ([95.0, 1.0, 5.1, 5.0], "exceeds_width"), ([1.0, 46.0, 5.0, 5.0], "exceeds_height"), ([95.0, 1.0, 5.0005, 5.0], None)]
    table = spark.createDataFrame(cases, "box array<double>, want string").select("*", boxes.box_problem(F.col("box"), F.lit(100), F.lit(50)).alias("got"))
    assert all(r["got"] == r["want"] for r in table.collect())
    box = spark.createDataFrame([([10.0, 5.0, 20.0, 10.0],)], "box array<double>")
    line = box.select(boxes.label_line(boxes.to_yolo(F.col("box"), F.lit(100), F.lit(50))).alias("x"))
    assert line.first()[0] == "0 0.20000000 0.20000000 0.20000000 0.20000000"
    bad = ["0 .5 .5 .5", "0 a .5 .5 .5", "1 .5 .5 .5 .5", "0 1.5 .5 .5 .5", "0 .5 .5 0 .5", "0 .5 .5 .5 .5"]
    told = spark.createDataFrame([(x,) for x in bad], "x string").select(boxes.label_problem(F.col("x")).alias("p"))
    assert [r[0] for r in told.collect()] == ["not_five_columns", "not_numeric", "unknown_class", "center_out_of_range", "size_out_of_range", None]
    region = box.select(boxes.protected_region(F.col("box"), F.lit(100), F.lit(50)).alias("r")).first()["r"]
    assert tuple(region) == (0, 0, 54, 39)


def test_names_and_guards(spark):
    names = {"a/reef-12-003_jpg.rf.abc.jpg": "reef-12", "cam_7.png": "cam", "x/plain.jpg": "plain", "b/dive_x_png.rf.1.jpg": "dive_x"}
    got = spark.createDataFrame([(k,) for k in names], "p string").select("p", naming.group_name(F.col("p")).alias("g")).collect()
    assert {r["p"]: r["g"] for r in got} == names
    path = spark.createDataFrame([("a\\.\\b//c/./d.jpg",)], "p string").select(naming.posix_path(F.col("p"))).first()[0]
    assert path == "a/b/c/d.jpg"
    one = spark.createDataFrame([("1e-3", "nan", "x", None)], "a string, b string, c string, d string")
    assert tuple(one.select(*[rules.valid_number(F.col(c)) for c in "abcd"]).first()) == (True, False, False, False)
    with pytest.raises(Exception, match="no group"):
        spark.createDataFrame([(" ",)], "g string").select(naming.required_group(F.col("g"))).collect()


def test_split_is_balanced_and_leaks_nothing(spark):
    records = spark.createDataFrame([(f"g{i % 23}", i % 3) for i in range(900)], "g string, b int")
    found = split.balanced_split(split.group_stats(records, "g", F.col("b")), 40)
    again = split.balanced_split(split.group_stats(records.repartition(7), "g", F.col("b")), 40)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))
    joined = records.join(found, records["g"] == found["group"])
    stats = {r["split"]: r["image_percent"] for r in split.split_stats(split.group_stats(records, "g", F.col("b")).join(found, "group")).collect()}
    assert abs(stats["train"] - 70) < 6 and abs(stats["val"] - 15) < 6
    assert all(r["n_shared"] == 0 for r in split.shared_between_splits(joined, {"group": F.col("g")}).collect())
    with pytest.raises(ValueError):
        split.balanced_split(split.group_stats(records.filter("g = 'g1'"), "g", F.col("b")))


def winner(spark, *modes, t=0.02):
    rows = [("i", m, decide.MODES[m], list(decide.MODES).index(m), passed, benefit, margin) for m, passed, benefit, margin in modes]
    table = spark.createDataFrame(rows, "image string, mode string, risk string, priority int, passed boolean, benefit double, margin double")
    return decide.winners(table, spark.createDataFrame([(t,)], "threshold double")).first()["mode"]


def test_winner_rules(spark):
    light, standard, white = "adaptive_gamma_light", "adaptive_gamma_standard", "white_balance_conservative"
    assert winner(spark, (light, True, 0.02, 0.5)) == light
    assert winner(spark, (light, True, 0.0199, 0.5)) == decide.RAW
    assert winner(spark, (light, False, 0.5, 0.5)) == decide.RAW
    assert winner(spark, (light, True, 0.0300, 0.4), (standard, True, 0.0304, 0.3)) == light
    assert winner(spark, (light, True, 0.0300, 0.3), (standard, True, 0.0304, 0.3)) == light
    assert winner(spark, (light, True, 0.0300, 0.4), (standard, True, 0.0310, 0.3)) == standard
    assert winner(spark, (white, True, 0.0229, 0.4)) == decide.RAW and winner(spark, (white, True, 0.0231, 0.4)) == white
    assert winner(spark, (light, True, 0.03, 0.4), (white, True, 0.0319, 0.9)) == light
    assert winner(spark, (light, True, 0.03, 0.4), (white, True, 0.0321, 0.1)) == white


def test_samplers(spark):
    table = spark.createDataFrame([(i, f"g{i % 4}") for i in range(100)], "k long, g string")
    got = sampling.capped_by_group(table, "g", "k", 6, 20, 7).collect()
    assert len(got) == 20 and max(sum(r["g"] == g for r in got) for g in ("g0", "g1", "g2", "g3")) <= 6
    used = spark.createDataFrame([("g0", 6)], "group string, used int")
    assert not any(r["g"] == "g0" for r in sampling.capped_by_group(table, "g", "k", 6, 20, 7, used).collect())
    assert [r["k"] for r in sampling.evenly_spaced(table, "k", 5).orderBy("k").collect()] == [round(i * 99 / 4) for i in range(5)]
    assert sampling.evenly_spaced(table, "k", 1).first()["k"] == 50 and sampling.evenly_spaced(table, "k", 200).count() == 100
    assert sampling.evenly_spaced(table.repartition(7), "k", 40).count() == 40
    assert sampling.random_fill(table, table.filter("k < 95"), "k", 9, 1).count() == 5


def test_progress_log(spark, tmp_path):
    schema = T.StructType().add("key", "string").add("n", "integer")
    lines = [{"key": "a", "n": 1}, {"key": "b", "n": 2}, {"key": "a", "n": 3}]
    (tmp_path / "torn.jsonl").write_text("\n".join(map(json.dumps, lines)) + '\n{"key": "c", "n"')
    assert {tuple(r) for r in progress.read_progress(spark, f"{tmp_path}/torn.jsonl", schema, "key").collect()} == {("a", 3), ("b", 2)}
    (tmp_path / "bad.jsonl").write_text('{"key": "a", "n": 1}\n{"key\n{"key": "b", "n": 2}\n')
    with pytest.raises(Exception, match="damaged"):
        progress.read_progress(spark, f"{tmp_path}/bad.jsonl", schema, "key").collect()


def test_coco_audit_and_labels(spark, tmp_path):
    doc = {"categories": [{"id": 1, "name": " Fish "}], "images": [{"id": 1, "file_name": "a.png", "width": 100, "height": 50}, {"id": 2, "file_name": "b.png", "width": 10, "height": 10}], "annotations": [{"id": 1, "image_id": 1, "category_id": 1, "bbox": [10, 5, 20, 10]}, {"id": 2, "image_id": 9, "category_id": 9, "bbox": [0, 0, 1, 1]}, {"id": 3, "image_id": 1, "category_id": 9, "bbox": [0, 0, 1, 1]}, {"id": 4, "image_id": 1, "category_id": 1, "bbox": [0, 0, 0, 1]}]}
    for s in coco.SPLITS:
        (tmp_path / s).mkdir()
        (tmp_path / s / coco.FILE).write_text(json.dumps(doc, indent=1))
    docs = coco.read_documents(spark, str(tmp_path))
    got = {(r["annotation_id"], r["problem"]) for r in coco.audited(docs).filter("split = 'train'").collect()}
    assert got == {(1, None), (2, "orphan_annotation"), (3, "unknown_category"), (4, "non_positive_size")}
    labels = {r["file_name"]: r["label"] for r in coco.label_files(docs, ["fish"]).filter("split = 'test'").collect()}
    assert labels == {"a.png": "0 0.20000000 0.20000000 0.20000000 0.20000000\n", "b.png": ""}
    files = spark.createDataFrame([(s, f) for s in coco.SPLITS for f in ("a.png", "c.png")], "split string, file_name string")
    assert {tuple(r) for r in coco.file_issues(docs, files).filter("split = 'train'").collect()} == {("train", "b.png", "missing_image"), ("train", "c.png", "unlisted_file")}


def test_an_audit_counts_while_it_writes(spark, tmp_path):
    doc = {"categories": [{"id": 1, "name": " Fish "}], "images": [{"id": i, "file_name": f"{n}.png", "width": 100, "height": 50} for i, n in enumerate("abcd")], "annotations": [{"id": 1, "image_id": 1, "category_id": 1, "bbox": [10, 5, 20, 10]}, {"id": 2, "image_id": 9, "category_id": 9, "bbox": [0, 0, 1, 1]}, {"id": 3, "image_id": 1, "category_id": 9, "bbox": [0, 0, 1, 1]}, {"image_id": 1, "category_id": 1, "bbox": [0, 0, 0, 1]}, {"id": 5, "image_id": 2, "category_id": 1, "bbox": [0, 0, 1]}]}
    for s in coco.SPLITS:
        (tmp_path / s).mkdir()
        (tmp_path / s / coco.FILE).write_text(json.dumps(doc if s == "train" else {"categories": [], "images": [], "annotations": []}))
    docs = coco.read_documents(spark, str(tmp_path))
    files = spark.createDataFrame([("train", "a.png", 100, 50), ("train", "b.png", 100, 51), ("train", "c.png", None, None), ("valid", "z.png", 1, 1)], "split string, file_name string, width int, height int")
    items, counts = coco.audit_source(docs, files, ["fish", "whale"])
    assert counts == {"missing_image": 1, "undecodable_image": 1, "unlisted_file": 1, "orphan_annotation": 1, "unknown_category": 1, "invalid_box": 2, "size_mismatch": 1, "missing_target_category": 5}
    assert counts == {k: items.filter(F.col("issue") == k).count() for k in coco.FATAL}
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert rows(coco.audited_annotations(items)) == rows(coco.audited(docs))  # one without an id too
    for made in (coco.image_counts, coco.label_files):
        assert rows(made(docs, ["fish"], coco.audited_annotations(items))) == rows(made(docs, ["fish"]))
    assert {r["issue"]: r["n"] for r in coco.issue_counts(docs, files, ["fish", "whale"]).collect()} == counts | {"total": 13}
    none, zero = coco.audit_source(docs.limit(0), files.limit(0), [])
    assert none.count() == 0 and set(zero.values()) == {0}


def picture(seed=0, h=48, w=64):
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[:h, :w]
    base = np.stack([60 + x, 40 + 2 * y, 30 + x + y], axis=-1) + rng.normal(0, 6, (h, w, 3))
    return np.clip(base, 0, 255).astype(np.uint8)


def plain_gradient(g):
    p = np.pad(g, 1, mode="reflect")
    k = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]])
    at = lambda k: sum(k[i, j] * p[i : i + g.shape[0], j : j + g.shape[1]] for i in range(3) for j in range(3))
    return np.sqrt(at(k) ** 2 + at(k.T) ** 2)


def plain_filter(g, k):
    p = np.pad(g, 1, mode="reflect")
    return sum(k[i][j] * p[i : i + g.shape[0], j : j + g.shape[1]] for i in range(3) for j in range(3))


LAPLACE, BLUR = [[0, 1, 0], [1, -4, 1], [0, 1, 0]], np.outer([1, 2, 1], [1, 2, 1]) / 16


def plain_gray(image):
    return ((image.astype(int) @ [114, 587, 299] + 500) // 1000).astype(float)


def plain_quality(image):
    g, unit = plain_gray(image), lambda v: min(max(float(v), 0.0), 1.0)
    b, gr, r = (image[..., i].astype(float) for i in range(3))
    means, rg, yb = image.reshape(-1, 3).mean(axis=0), r - gr, 0.5 * (r + gr) - b
    lab = np.clip(np.rint(kernels.to_lab(image)), 0, 255).astype(float)
    chroma = np.hypot(lab[..., 1] - 128, lab[..., 2] - 128)
    share = np.bincount(g.astype(int).ravel()) / g.size
    q = {"brightness": g.mean() / 255, "contrast": g.std(), "sharpness": plain_filter(g, LAPLACE).var(), "noise": (g - plain_filter(g, BLUR)).std(), "black_clip": (g <= 5).mean(), "white_clip": (g >= 250).mean()}
    q["entropy"] = -sum(x * np.log2(x) for x in share if x)
    q["color_balance"] = unit(1 - means.std() / means.mean())
    q["colorfulness"] = unit((np.hypot(rg.std(), yb.std()) + 0.3 * np.hypot(rg.mean(), yb.mean())) / 100)
    q["uciqe_proxy"] = unit(0.468 * unit(chroma.std() / 64) + 0.2745 * np.subtract(*np.percentile(lab[..., 0] / 255, [99, 1])) + 0.2576 * (chroma / (np.hypot(chroma, lab[..., 0]) + 1e-6)).mean())
    q |= {"brightness_quality": unit(1 - abs(q["brightness"] - 0.5) / 0.5), "contrast_quality": unit(q["contrast"] / 64), "sharpness_quality": unit(np.log1p(q["sharpness"]) / np.log1p(1500)), "entropy_quality": unit(q["entropy"] / 8)}
    q["uiqm_proxy"] = unit(0.35 * q["colorfulness"] + 0.35 * q["sharpness_quality"] + 0.3 * q["contrast_quality"])
    return q


def plain_ratios(a, b):
    """Detail, edge, sharpness, noise and contrast of two gray areas."""
    ga, gb = plain_gradient(a), plain_gradient(b)
    strong = lambda g: g >= (np.percentile(g[g > 0], 75) if (g > 0).any() else np.inf)
    flat = ga.std() * gb.std() < 1e-9
    detail = float(np.allclose(ga, gb)) if flat else min(max(np.corrcoef(ga.ravel(), gb.ravel())[0, 1], 0), 1)
    wide = np.pad(strong(gb), 1)
    near = np.any([wide[i : i + a.shape[0], j : j + a.shape[1]] for i in range(3) for j in range(3)], axis=0)
    edge = (strong(ga) & near).sum() / strong(ga).sum() if strong(ga).any() else 1.0
    var = lambda g: plain_filter(g, LAPLACE).var()
    noise = lambda g: (g - plain_filter(g, BLUR)).std()
    return [detail, edge, var(b) / max(var(a), 1), noise(b) / max(noise(a), 0.25), b.std() / max(a.std(), 1)]


def as_table(spark, *pictures):
    return spark.createDataFrame([(f"i{i}", *x.shape[:2], x.tobytes()) for i, x in enumerate(pictures)], "image string, height int, width int, data binary")


def test_metrics_equal_plain_numpy(spark):
    made = [picture(), picture(5, 96, 70) // 3, np.full((40, 40, 3), 77, np.uint8), picture(7, 6, 5)]
    table = as_table(spark, *made)
    sums = pixels.area_sums(table).cache()
    got = {(r["image"], r["mode"]): r for r in pixels.quality(sums).collect()}
    found = {(r["image"], r["mode"]): r for r in pixels.evaluate_sums(sums).collect()}
    assert len(got) == 4 * 8 and len(found) == 4 * 7
    for i, raw in enumerate(made):
        base = plain_quality(raw)
        for mode, image in kernels.TRANSFORMS.items():
            q, r, other = plain_quality(image(raw)), found[(f"i{i}", mode)], image(raw)
            for k, v in q.items():
                assert got[(f"i{i}", mode)][k] == pytest.approx(v, rel=1e-4, abs=1e-5), (mode, k)
            assert r["benefit"] == pytest.approx(sum(w * (q[k] - base[k]) for k, w in pixels.BENEFIT_WEIGHTS.items()), abs=1e-5)
            a, b = plain_gray(raw), plain_gray(other)
            detail, edge, *_ = plain_ratios(a, b)
            assert (r["detail_retention"], r["edge_recall"]) == pytest.approx((detail, edge), abs=1e-4)
            tiles = []
            for n in pixels.GRIDS:
                for y0, y1, x0, x1 in kernels.tile_bounds(*a.shape, n, pixels.TILE_SIDE):
                    tiles.append((-plain_gradient(a[y0:y1, x0:x1]).mean(), len(tiles), plain_ratios(a[y0:y1, x0:x1], b[y0:y1, x0:x1])))
            kept = [t[2] for t in sorted(tiles)[: max(8, int(np.ceil(0.6 * len(tiles))))]] or [[1.0] * 5]
            for name, column in zip(pixels.RATIOS, zip(*kept, strict=True), strict=True):
                for p in (10, 50, 90):
                    assert r[f"{name}_p{p}"] == pytest.approx(np.percentile(column, p), rel=2e-3, abs=2e-4), (i, mode, name, p)
    profile = {r["image"]: r for r in pixels.profile_images(table).collect()}
    q = plain_quality(made[0])
    means = made[0].reshape(-1, 3).mean(axis=0)
    assert [profile["i0"][k] for k in ("brightness", "contrast", "sharpness", "colour_cast")] == pytest.approx([q["brightness"], q["contrast"], q["sharpness"], means.std() / means.mean()], rel=1e-4)


def test_a_file_is_written_from_its_parts_in_order(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i % 2}/x", i, f"{i},".encode()) for i in range(400)], "name string, at int, content binary").repartition(7)
    folder = f"file://{tmp_path}/out"
    told = {r["name"]: r for r in images.write_parts(rows, folder, "at").collect()}
    for k in (0, 1):
        want = "".join(f"{i}," for i in range(k, 400, 2)).encode()
        assert (tmp_path / "out" / f"d{k}" / "x").read_bytes() == want
        assert (told[f"d{k}/x"]["length"], told[f"d{k}/x"]["sha256"]) == (len(want), hashlib.sha256(want).hexdigest())


def test_documents_of_an_index_are_written_item_by_item(spark, tmp_path, monkeypatch):
    seen, write = [], indexes.write_parts
    monkeypatch.setattr(indexes, "write_parts", lambda parts, *a, **k: seen.append(parts.count()) or write(parts, *a, **k))
    rows = spark.createDataFrame([(f"{i}.png", i, f'a "{i}" [') for i in range(500)], "prepared_image string, width int, deployment string")
    indexes.write_image_index(rows, f"file://{tmp_path}/images")
    notes = rows.select(F.col("prepared_image").alias("image"), F.array(F.struct(F.col("width").alias("class_id"), F.lit("fish").alias("class_name"))).alias("annotations"))
    indexes.write_annotation_index(notes, f"file://{tmp_path}/notes")
    assert seen == [500, 500]  # a row for each item, none for a whole document
    read = json.loads((tmp_path / "images" / "part-000000.json").read_text())
    assert read == [{"prepared_image": f"{i}.png", "width": i, "deployment": f'a "{i}" ['} for i in sorted(range(500), key=lambda i: f"{i}.png")]
    assert json.loads((tmp_path / "notes" / "part-000000.json").read_text())["7.png"] == [{"class_id": 7, "class_name": "fish"}]
    with pytest.raises(Exception, match="twice"):
        indexes.write_annotation_index(notes.unionByName(notes.limit(1)), f"file://{tmp_path}/again")


def test_small_images_of_one_shape_are_worked_through_together(monkeypatch):
    made, built = [picture(i, 12, 10) for i in range(20)], []
    side = pixels.Side
    monkeypatch.setattr(pixels, "Side", lambda g: built.append(len(g)) or side(g))
    modes = ("adaptive_gamma_light", "white_balance_conservative")
    found = [(p["of"][j], p["mode"], {k: v[j] for k, v in p.items() if k[:2] == "p_"}) for p in pixels._area_rows(made, (1,), modes, False) for j in range(len(p["of"]))]
    assert built == [20, 20, 20]  # of all images at once: raw and each candidate
    alone = [(i, p["mode"], {k: v[0] for k, v in p.items() if k[:2] == "p_"}) for i, x in enumerate(made) for p in pixels._area_rows([x], (1,), modes, False)]
    assert sorted(found, key=lambda r: r[:2]) == sorted(alone, key=lambda r: r[:2])


def test_regions_of_many_images_are_those_of_each(spark):
    made = [picture(i, 30 + i % 3, 28) for i in range(12)]
    boxes = spark.createDataFrame([(f"i{i}", b) for i in range(12) for b in ([1.0, 2.0, 3.0, 1.0 + i % 2], [26.0, 1.0, 1.0, 1.0])], "image string, bbox array<double>")
    rows = lambda table: {(r["image"], r["mode"]): r for r in pixels.region_metrics(table, boxes, ("clahe_very_mild",)).collect()}
    table = as_table(spark, *made).repartition(1)
    together, alone = rows(table), {}
    for i in (0, 1, 5):
        alone |= rows(table.filter(F.col("image") == f"i{i}"))
    assert len(together) == 12 and {k: together[k] for k in alone} == alone


def plain_bilateral(image, sigma=20.0):
    p, out = np.pad(image.astype(float), ((1, 1), (1, 1), (0, 0)), mode="reflect"), np.zeros(image.shape)
    for y in range(image.shape[0]):
        for x in range(image.shape[1]):
            here, total, weight = p[y + 1, x + 1], np.zeros(3), 0.0
            for dy, dx in ((0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)):
                near = p[y + 1 + dy, x + 1 + dx]
                k = np.exp(-(np.abs(near - here).sum() ** 2 + dy * dy + dx * dx) / (2 * sigma**2))
                total, weight = total + k * near, weight + k
            out[y, x] = total / weight
    return out


def plain_dehaze(image, blend, omega):
    x = image / 255.0
    h, w = x.shape[:2]
    least = lambda m: np.array([[m[max(y - 7, 0) : y + 8, max(z - 7, 0) : z + 8].min() for z in range(w)] for y in range(h)])
    dark = least(x.min(axis=2))
    brightest = np.argsort(-dark.ravel(), kind="stable")[: max(1, int(dark.size * 0.001))]
    air = np.maximum(x.reshape(-1, 3)[brightest].mean(axis=0), 0.10)
    t, k = np.pad(1 - omega * least((x / air).min(axis=2)), 2, mode="reflect"), np.array([1, 4, 6, 4, 1]) / 16
    t = np.clip(sum(k[i] * k[j] * t[i : i + h, j : j + w] for i in range(5) for j in range(5)), 0.6, 1.0)[..., None]
    return ((1 - blend) * x + blend * np.clip((x - air) / t + air, 0, 1)) * 255


def plain_clahe(image, clip=1.25, n=8):
    lab = kernels.to_lab(image).astype(float)
    light = np.clip(np.rint(lab[..., 0]), 0, 255).astype(int)
    h, w = light.shape
    th, tw = -(-h // n), -(-w // n)
    tables = {}
    for i in range(n):
        for j in range(n):
            cell = [light[min(y, h - 1), min(x, w - 1)] for y in range(i * th, i * th + th) for x in range(j * tw, j * tw + tw)]
            counts, limit = np.bincount(cell, minlength=256), max(int(clip * th * tw / 256), 1)
            extra = int(np.maximum(counts - limit, 0).sum())
            counts = np.minimum(counts, limit) + extra // 256
            for at in range(0, 256, max(256 // (extra % 256), 1) if extra % 256 else 256)[: extra % 256]:
                counts[at] += 1
            tables[i, j] = np.clip(np.rint(np.cumsum(counts) * 255 / (th * tw)), 0, 255)
    inside = lambda v: min(max(v, 0), n - 1)
    for y in range(h):
        for x in range(w):
            a, b = y / th - 0.5, x / tw - 0.5
            i, j = int(np.floor(a)), int(np.floor(b))
            at = lambda p, q, v=light[y, x]: tables[inside(p), inside(q)][v]
            lab[y, x, 0] = (1 - a + i) * ((1 - b + j) * at(i, j) + (b - j) * at(i, j + 1)) + (a - i) * ((1 - b + j) * at(i + 1, j) + (b - j) * at(i + 1, j + 1))
    return lab


def test_candidates_equal_plain_loops():
    """Candidates that are no look-up tables, pixel by pixel; a rounding may fall the other way where it is nearly a tie."""
    image = picture(4, 40, 48)
    assert np.abs(kernels.bilateral(image) - plain_bilateral(image)).max() <= 0.51
    for blend, omega, mode in ((0.20, 0.40, "mild_dehaze_low"), (0.35, 0.50, "mild_dehaze_medium")):
        off = plain_dehaze(image, blend, omega) - kernels.TRANSFORMS[mode](image)
        assert off.min() > -0.01 and off.max() < 1.01  # cut off, not rounded
    want, got = plain_clahe(image), kernels.clahe(image)
    assert np.abs(kernels.from_lab(want).astype(int) - got).max() <= 1 and (kernels.from_lab(want) == got).mean() > 0.999


def test_kernels():
    image = picture()
    for make in kernels.TRANSFORMS.values():
        assert make(image).shape == image.shape and make(image).dtype == np.uint8
    flat = np.full((20, 20, 3), 77, np.uint8)
    for mode in ("bilateral_denoise_mild", "white_balance_conservative"):
        assert (kernels.TRANSFORMS[mode](flat) == flat).all()
    assert np.abs(kernels.from_lab(kernels.to_lab(image)).astype(int) - image).max() <= 1
    x = np.random.default_rng(1).normal(size=(23, 17)).astype(np.float32)
    wide = np.pad(x, 7, constant_values=np.inf)
    assert (kernels.erode(x, 15) == np.array([[wide[i : i + 15, j : j + 15].min() for j in range(17)] for i in range(23)])).all()
    assert kernels.shrink(np.full((1280, 640, 3), 9, np.uint8), 640).shape == (640, 320, 3) and (kernels.shrink(np.full((1281, 7, 3), 9, np.uint8), 640) == 9).all()
    square = np.full((30, 30), 20, np.float32)
    square[10:20, 10:20] = 220
    assert 30 <= kernels.edge_pixels(square) <= 48 and kernels.edge_pixels(np.full((9, 9), 5, np.float32)) == 0
    with pytest.raises(ValueError):
        kernels.as_bgr(np.zeros((3, 3)))


def test_weak_edges_join_strong_ones_however_long_the_way():
    def grown(weak, strong):
        while True:
            more = kernels.dilate3(strong) & weak
            if (more == strong).all():
                return strong
            strong = more

    rng = np.random.default_rng(6)
    spiral = np.zeros((41, 41), bool)
    for k in range(0, 20, 2):
        spiral[k, k : 41 - k] = spiral[k : 41 - k, 40 - k] = spiral[40 - k, k : 41 - k] = spiral[k + 2 : 41 - k, k] = spiral[k + 2, k : k + 2] = True
    cases = [(spiral, np.arange(41 * 41).reshape(41, 41) == 0)]
    for share in (0.0, 0.1, 0.35, 0.5, 1.0):
        weak = rng.random((rng.integers(1, 40), rng.integers(1, 40))) < share
        cases.append((weak, weak & (rng.random(weak.shape) < 0.03)))
    for weak, strong in cases:
        got = np.zeros(weak.shape, bool)
        got[weak] = kernels._joined(weak, strong)
        assert (got == grown(weak, strong)).all()


def test_images_from_file_to_processed_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"im{i}.png").write_bytes(images.encode_png(picture(i)))
    (tmp_path / "broken.png").write_bytes(b"no image")
    read = images.read_images(spark, f"file://{tmp_path}").cache()
    found = {r["image"].rsplit("/", 1)[-1]: r for r in read.collect()}
    assert bytes(found["im1.png"]["data"]) == picture(1).tobytes() and found["broken.png"]["data"] is None
    assert images.list_images(spark, f"file://{tmp_path}").count() == images.hash_images(spark, f"file://{tmp_path}").count() == 4
    gated = curation.evaluated(read)
    assert gated.count() == 3 * len(decide.MODES) and gated.filter("margin < 0 OR margin > 1").count() == 0
    won = decide.winners(gated, spark.createDataFrame([(0.02,)], "threshold double"))
    out = curation.process(read, won, f"file://{tmp_path}/out").collect()
    assert len(out) == 3 and all((tmp_path / "out" / r["name"]).exists() for r in out)
    assert curation.policy(0.02)["policy_fingerprint_sha256"] != curation.policy(0.03)["policy_fingerprint_sha256"]


def test_preparation_drops_copies_and_stops_at_conflicts(spark):
    rows = [(f"reef{i % 20}-{i}.png", f"s{i}", i % 3, "x") for i in range(60)]
    records = spark.createDataFrame([*rows, ("zz-1.png", "s3", 0, "x")], "path string, sha256 string, boxes int, sign string")
    got = curation.prepare(records, 20)
    assert got.count() == 60 and got.select("group", "split").distinct().count() == got.select("group").distinct().count()
    with pytest.raises(Exception, match="different boxes"):
        curation.prepare(records.unionByName(spark.createDataFrame([("y.png", "s4", 0, "other")], records.schema)), 20).collect()


def test_certification(spark):
    a = spark.createDataFrame([(i, f"h{i}") for i in range(50)], "k long, h string")
    b = a.filter("k > 0").withColumn("h", F.when(F.col("k") == 7, "other").otherwise(F.col("h"))).unionByName(spark.createDataFrame([(99, "h")], "k long, h string"))
    assert {tuple(r) for r in certify.verify(a, b, "k", ["h"]).collect()} == {(0, "missing"), (99, "extra"), (7, "h differs")}
    one = certify.fingerprint(a, ["k", "h"]).first()
    assert one == certify.fingerprint(a.repartition(5), ["k", "h"]).first() != certify.fingerprint(b, ["k", "h"]).first()
    assert {r["state"]: r["n"] for r in certify.resume_states(a, b, "k", "h").groupBy("state").agg(F.count("*").alias("n")).collect()} == {"new": 1, "reprocessed": 1, "resumed": 48}
    with pytest.raises(Exception, match="another policy"):
        certify.require_policy(spark.createDataFrame([("x",)], "policy_fingerprint_sha256 string"), "y").collect()


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    schema = T.StructType().add("key", "string").add("at", "timestamp")
    source = tmp_path / "in"
    source.mkdir()
    for n, keys in enumerate((["a", "b", "a"], ["b", "c"])):
        (source / f"{n}.json").write_text("\n".join(json.dumps({"key": k, "at": "2024-01-01 00:00:00"}) for k in keys))
        stream = incremental.once_per_key(incremental.read_stream(spark, str(source), schema), "key", "at")
        incremental.append_available(stream, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    assert sorted(r["key"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_a_log_as_a_stream_is_what_the_reader_of_logs_has(spark, tmp_path):
    """Over restarts, with keys that come again and torn last lines."""
    schema = T.StructType().add("key", "string").add("n", "integer")
    (tmp_path / "log").mkdir()
    where = [f"{tmp_path}/{x}" for x in ("log", "out", "mark")]
    files = ([("a", 1), ("b", 2), ("a", 3)], [("b", 4), ("c", 5)], [("a", 6), ("d", 7), ("d", 8)])
    for i, lines in enumerate(files):
        (tmp_path / "log" / f"{i}.jsonl").write_text("\n".join(json.dumps({"key": k, "n": n}) for k, n in lines) + '\n{"key": "z", "n"' * (i != 1) + "\n")
        records = live.latest_records(live.read_log(spark, where[0], schema, "key"), "key")
        live.keep_latest(records, where[1], where[2]).awaitTermination()
        got = {tuple(r) for r in live.read_latest(spark, where[1], "key").collect()}
        assert got == {tuple(r) for r in progress.read_progress(spark, where[0], schema, "key").collect()}
    assert got == {("a", 6), ("b", 4), ("c", 5), ("d", 8)}
    (tmp_path / "log" / "3.jsonl").write_text('{"key": "a"\n{"key": "a", "n": 9}\n')
    with pytest.raises(Exception, match="damaged"):
        live.keep_latest(live.latest_records(live.read_log(spark, where[0], schema, "key"), "key"), where[1], where[2]).awaitTermination()


def test_a_large_file_of_a_streamed_log_is_read_by_lines_and_in_parts(spark, tmp_path):
    """Never whole, also where the torn last line begins in one part and ends in another, in which no line begins."""
    schema = T.StructType().add("key", "string").add("n", "integer")
    (tmp_path / "log").mkdir()
    text = "".join(json.dumps({"key": f"k{i % 7}", "n": i}) + "\n" for i in range(3000))
    (tmp_path / "log" / "0.jsonl").write_text(text + '{"key": "z", "x": "' + "y" * 9000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        log = live.read_log(spark, f"{tmp_path}/log", schema, "key")
        query = live.keep_latest(live.latest_records(log, "key"), f"{tmp_path}/out", f"{tmp_path}/mark")
        query.awaitTermination()
        got = {tuple(r) for r in live.read_latest(spark, f"{tmp_path}/out", "key").collect()}
        assert got == {tuple(r) for r in progress.read_progress(spark, f"{tmp_path}/log", schema, "key").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(f"k{i % 7}", i) for i in range(2993, 3000)}
    assert sum(p["numInputRows"] for p in query.recentProgress) >= 3000  # rows are lines, not files


def test_windows_count_by_time(spark, tmp_path):
    schema = T.StructType().add("key", "string").add("at", "timestamp")
    (tmp_path / "in").mkdir()
    times = ["00:01:00", "00:04:00", "00:12:00", "01:00:00"]
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"key": "x", "at": f"2024-01-01 {t}"}) for t in times))
    counts = incremental.windowed_counts(incremental.read_stream(spark, str(tmp_path / "in"), schema), "at", "key")
    counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    got = {r["start"].strftime("%H:%M"): r["n"] for r in spark.table("windows").collect()}
    assert sorted(got.values()) == [1, 1, 2] and len(got) == 3


def test_regions_are_weighed_by_size(spark, tmp_path):
    raw = picture(3, 64, 800)
    table = spark.createDataFrame([("a", 64, 800, raw.tobytes()), ("b", 64, 800, raw.tobytes())], "image string, height int, width int, data binary")
    given = [[100.0, 20.0, 6.0, 6.0], [300.0, 10.0, 15.0, 15.0], [500.0, 5.0, 50.0, 50.0], [1.0, 2.0]]  # tiny, small, larger, malformed
    got = {r["mode"]: r for r in pixels.region_metrics(table, spark.createDataFrame([("a", x) for x in given], "image string, bbox array<double>")).collect()}
    assert set(got) == set(decide.MODES)
    for mode in ("clahe_very_mild", "mild_dehaze_low"):
        made, r = kernels.TRANSFORMS[mode](raw), got[mode]
        assert (r["image"], r["boxes"], r["tiny_boxes"], r["small_boxes"], r["medium_large_boxes"]) == ("a", 3, 1, 1, 1)
        parts = []
        for (x, y, w, h), weight in zip(given[:3], (2.0, 1.5, 1.0), strict=True):
            px, py = max(0.2 * w, 24), max(0.2 * h, 24)
            at = (int(max(np.floor(x - px), 0)), int(max(np.floor(y - py), 0)), int(min(np.ceil(x + w + px), 800)), int(min(np.ceil(y + h + py), 64)))
            left, top, right, bottom = at
            a, b = raw[top:bottom, left:right], made[top:bottom, left:right]
            told = dict(zip(pixels.RATIOS, plain_ratios(plain_gray(a), plain_gray(b)), strict=True))
            parts.append((told | {"lab": np.sqrt(((kernels.whole_lab(a) - kernels.whole_lab(b)) ** 2).sum(axis=-1)).mean()}, weight))
        for name in (*pixels.RATIOS, "lab"):
            assert r[f"any_{name}"] == pytest.approx(sum(p[name] * w for p, w in parts) / 4.5, rel=1e-3)
            assert r[f"tiny_{name}"] == pytest.approx(parts[0][0][name], rel=1e-3)
    evaluations = pixels.evaluate_images(table)
    audited = {(r["image"], r["mode"]): r for r in curation.audited_regions(evaluations, table, spark.createDataFrame([("a", x) for x in given], "image string, bbox array<double>")).collect()}
    assert all(r["region_passed"] for (image, _), r in audited.items() if image == "b") and len(audited) == 14


def test_region_limits(spark):
    columns = ["boxes", "tiny_boxes", *[f"{a}_{m}" for a in ("any", "tiny") for m in ("detail", "edge", "sharpness", "noise", "lab")]]
    good = [0.9, 0.9, 1.0, 1.0, 1.0]
    rows = [(1, 1, *good, *good), (1, 1, 0.85, *good[1:], 0.85, *good[1:]), (0, 1, 0.1, *good[1:], *good), (2, 1, 0.9, 0.9, 2.6, 1.0, 46.0, *[None] * 5)]
    table = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if 'boxes' in c else 'double'}" for c in columns))
    assert [r["region_reasons"] for r in decide.region_audit(table).collect()] == [[], ["tiny_fish_detail_loss"], [], ["fish_roi_over_sharpening", "fish_roi_colour_shift"]]
    assert decide.run_status(False, 3) == "CALIBRATION_NOT_APPROVABLE" and decide.run_status(True, 1) == "DETAIL_AUDIT_FAILED" and decide.run_status(True, 0) == "REVIEW_REQUIRED"


def test_other_numbers_of_channels():
    g = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert (kernels.pixels_of(g.tobytes(), 3, 4) == g[..., None]).all()
    four = np.arange(48, dtype=np.uint8).reshape(3, 4, 4)
    assert (kernels.pixels_of(four.tobytes(), 3, 4) == four[..., :3]).all()
    assert kernels.pixels_of(b"12", 3, 4) is None and kernels.pixels_of(None, -1, -1) is None


def test_trial_and_calibration_samples(spark):
    rows = [(f"i{i:04}", f"g{i % 60}", i % 4, int(i % 4 > 0 and i % 5 == 0), int(i % 4 > 0 and i % 7 == 0)) for i in range(1200)]
    records = spark.createDataFrame(rows, "image string, group string, target_count int, tiny_count int, small_count int")
    profile = lambda pool: pool.withColumns({c: F.conv(F.substring(F.md5(F.concat("image", F.lit(c))), 1, 8), 16, 10).cast("double") for c in ("brightness", "contrast", "sharpness", "colour_cast")})
    trial = sampling.trial_sample(records, profile)
    got = trial.join(records, "image").collect()
    assert len({r["image"] for r in got}) == len(got) == 20 and sum(r["target_count"] > 0 for r in got) == 14
    assert {r["reason"] for r in got} >= {r[0] for r in (*sampling.POSITIVE_RANKS, *sampling.NEGATIVE_RANKS)}
    chosen = sampling.calibration_sample(records, trial, positives=60, negatives=20, with_tiny=24, with_small=18)
    found = chosen.join(records.drop("group"), "image").collect()
    groups = [r["group"] for r in found]
    assert len({r["image"] for r in found}) == 80 and not {r["group"] for r in got} & set(groups) and max(map(groups.count, groups)) <= 6
    count = lambda s: sum(r["stratum"] == s for r in found)
    assert (count("tiny"), count("small"), count("positive"), count("negative")) == (24, 18, 18, 20)
    assert all(r["tiny_count"] > 0 for r in found if r["stratum"] == "tiny") and all(r["target_count"] == 0 for r in found if r["stratum"] == "negative")
    with pytest.raises(ValueError, match="only"):
        sampling.calibration_sample(records, trial, positives=5000)


def test_reports_are_written_whole(spark, tmp_path):
    reports.write_json(f"file://{tmp_path}/a/r.json", {"b": 1, "a": "ü"})
    assert reports.read_json(f"file://{tmp_path}/a/r.json") == {"b": 1, "a": "ü"} and reports.read_object(f"file://{tmp_path}/none.json") == {}
    with pytest.raises(FileNotFoundError):
        reports.read_json(f"file://{tmp_path}/none.json")
    assert reports.dataset_yaml("/data/x", {0: "fish"}, True) == 'path: "/data/x"\ntrain: train/images\nval: val/images\ntest: test/images\nnames:\n  0: "fish"\nnc: 1\n'
    one = spark.createDataFrame([(2, "b"), (1, "a")], "sample_number int, sample_type string").select("*", *[F.lit("v").alias(c) for c in reports.DECISION_COLUMNS[2:]])
    reports.write_decisions(one, str(tmp_path / "d"))
    lines = next((tmp_path / "d").glob("*.csv")).read_text().splitlines()
    assert lines[0] == ",".join(reports.DECISION_COLUMNS) and [x[:3] for x in lines[1:]] == ["1,a", "2,b"]


VERSION = "v"
TRIAL = {"policy_version": VERSION, "calibrated_minimum_improvement": 0.02, "runtime_selector_label_free": True, "winner_roi_audit_failures": 0}
CALIBRATION = {
    "policy_version": VERSION, "selected_threshold": 0.02, "runtime_selector": "label_free", "annotations_used_for_runtime_selection": False, "class_labels_used_for_threshold_reward": False,
    "positive_images_rewarded": False, "negative_images_penalized": False, "calibration_safe": True, "threshold_analysis": [{"threshold": 0.02, "roi_unsafe_selected": 0, "eligible_for_selection": True}],
}
SAMPLING = {
    "policy_version": VERSION, "status": "pass", "policy": {"smoke_deployments_excluded_from_calibration": True, "group_aware_round_robin": True, "positive_and_negative_share_deployment_cap": True, "maximum_calibration_images_per_deployment": 6},
    "counts": {"smoke_images": 20}, "checks": {"image_overlap_count": 0, "image_overlap_passed": True, "image_overlap": [], "deployment_overlap_count": 0, "deployment_overlap_passed": True},
}


def test_preflight_tells_the_check_that_fails(spark):
    records = spark.createDataFrame([("train/images/a.png", "train/labels/a.txt", "train"), ("val/images/b.png", "val/labels/b.txt", "val")], "image string, label string, split string")
    config = {"policy_version": VERSION, "threshold": 0.02, "modes": 8, "cap": 6, "trial_images": 20, "splits": {"train": 1, "val": 1}}
    failed = lambda t=TRIAL, c=CALIBRATION, s=SAMPLING, r=records, g=config: [n for n, _, ok in certify.preflight(t, c, s, r, g) if not ok]
    assert failed() == []
    assert failed(t={}) == [3, 4, 5, 6, 9] and failed(c=CALIBRATION | {"threshold_analysis": []}) == [8]
    assert failed(s=SAMPLING | {"status": "FAIL"}) == [10] and failed(g=config | {"trial_images": 21, "splits": {"train": 2}}) == [11, 13]
    assert failed(r=records.unionByName(records.limit(1))) == [12, 13]
    with pytest.raises(RuntimeError, match="check 8"):
        certify.require_passed(certify.preflight(TRIAL, CALIBRATION | {"calibration_safe": False}, SAMPLING, records, config))


def test_run_goes_on_where_it_ended(spark, tmp_path, monkeypatch):
    root, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    rows = []
    for i in range(6):
        split_ = ("train", "val", "test")[i % 3]
        (tmp_path / "in" / split_ / "images").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / split_ / "images" / f"i{i}.png").write_bytes(images.encode_png(picture(i) // 4 if i % 2 else np.full((48, 64, 3), 122, np.uint8)))
        rows.append((f"{split_}/images/i{i}.png", f"{split_}/labels/i{i}.txt", f"0 0.5 0.5 0.{i + 1} 0.1\n", split_, f"g{i}", 1, 64, 48))
    records = spark.createDataFrame(rows, "image string, label_path string, label string, split string, group string, target_count int, width int, height int")
    monkeypatch.setattr(curation, "BATCH", 2)
    whole, parts = curation._batch, []

    def dying(*given):
        parts.append(given)
        if len(parts) == 2:
            raise RuntimeError("the power went")
        return whole(*given)

    monkeypatch.setattr(curation, "_batch", dying)
    with pytest.raises(RuntimeError, match="the power went"):
        curation.run(spark, records, root, out, 0.005)
    done = spark.read.parquet(f"{out}/manifest").count()
    assert 0 < done < 6
    monkeypatch.setattr(curation, "_batch", whole)
    first = {r["output_image"]: r for r in curation.run(spark, records, root, out, 0.005).collect()}
    assert reports.read_json(f"{out}/reports/run.json")["resumed"] == done
    assert len(first) == 6 and any(r["processed"] for r in first.values()) and not all(r["processed"] for r in first.values())
    for name, r in first.items():
        same = (tmp_path / "out" / name).read_bytes() == (tmp_path / "in" / name).read_bytes()
        assert same != r["processed"] and (tmp_path / "out" / r["output_label"]).read_text().startswith("0 0.5 0.5")
    (tmp_path / "out" / "val/images/i1.png").write_bytes(b"damaged")
    again = {r["output_image"]: r for r in curation.run(spark, records, root, out, 0.005).collect()}
    assert reports.read_json(f"{out}/reports/run.json")["resumed"] == 5
    assert {n for n in first if again[n]["finished"] != first[n]["finished"]} == {"val/images/i1.png"}
    assert all(again[n]["output_image_sha256"] == first[n]["output_image_sha256"] for n in first)
    with pytest.raises(Exception, match="another policy"):
        curation.run(spark, records, root, out, 0.02)
    assert reports.read_json(f"{out}/reports/failure.json")["status"] == "FAIL"

    records.write.parquet(str(tmp_path / "records"))
    config = {"policy_version": VERSION, "threshold": 0.02, "cap": 6, "splits": {"train": 2, "val": 2, "test": 2}}
    for name, value in (("trial", TRIAL | {"decisions": [{"prepared_image": "train/images/i3.png", "processed_selected": True}]}), ("calibration", CALIBRATION), ("sampling", SAMPLING), ("config", config)):
        reports.write_json(f"file://{tmp_path}/reports/{name}.json", value)
    given = ["--records", str(tmp_path / "records"), "--images", root, "--reports", f"file://{tmp_path}/reports", "--out", out]
    assert command.main(["--preflight", *given], spark) == 0 and command.main(["--smoke-test", "1", *given], spark) == 0
    assert (tmp_path / "out-smoke/train/images/i3.png").exists() and not (tmp_path / "out-smoke/train/images/i0.png").exists()
    with pytest.raises(SystemExit):
        command.arguments(["--preflight", "--full", *given])


def test_published_split_score():
    """The published counts of the split give the published score."""
    counts = {"train": (10181, 10370), "val": (2273, 1930), "test": (2220, 1820)}
    assert split.score(counts, split.RATIOS) == pytest.approx(0.04679489382272545, abs=1e-15)


def test_a_source_is_prepared_and_the_selector_tried(spark, tmp_path):
    root, out = tmp_path / "source", f"file://{tmp_path}/prepared"
    rng, n = np.random.default_rng(3), 0
    for s in coco.SPLITS:
        (root / s).mkdir(parents=True)
        doc = {"categories": [{"id": 1, "name": "Fish"}, {"id": 2, "name": "small_fish"}, {"id": 3, "name": "crab"}], "images": [], "annotations": []}
        for i in range(30):
            n += 1
            name = f"reef{n % 60}-{n}_jpg.rf.x.png"
            dark = picture(n, 64, 80) // (3 if n % 3 else 1)
            (root / s / name).write_bytes(images.encode_png(dark))
            doc["images"].append({"id": i, "file_name": name, "width": 80, "height": 64})
            if n % 3:
                doc["annotations"] += [{"id": 10 * n + k, "image_id": i, "category_id": 1 + k % 3, "bbox": [float(rng.integers(0, 40)), 5.0, *([2.0, 2.0] if n % 2 else [6.0, 5.0])]} for k in range(3)]
        (root / s / coco.FILE).write_text(json.dumps(doc))
    (root / "train" / "reef1-900_jpg.rf.x.png").write_bytes((root / "train" / "reef1-1_jpg.rf.x.png").read_bytes())
    doc = json.loads((root / "train" / coco.FILE).read_text())
    (root / "train" / coco.FILE).write_text(json.dumps(doc | {"images": [*doc["images"], {"id": 90, "file_name": "reef1-900_jpg.rf.x.png", "width": 80, "height": 60}]}))
    with pytest.raises(ValueError, match="fatal issues"):
        stages.prepare_dataset(spark, f"file://{root}", out, attempts=20)
    assert reports.read_json(f"{out}/reports/source_audit.json")["fatal_issues"]["size_mismatch"] == 1
    twin = [{**a, "id": 9000 + a["id"], "image_id": 90} for a in doc["annotations"] if a["image_id"] == 0]
    (root / "train" / coco.FILE).write_text(json.dumps(doc | {"images": [*doc["images"], {"id": 90, "file_name": "reef1-900_jpg.rf.x.png", "width": 80, "height": 64}], "annotations": doc["annotations"] + twin}))
    assert command.main(["--prepare", f"file://{root}", "--out", out], spark) == 0
    index = spark.read.parquet(f"{out}/records")
    report = reports.read_json(f"{out}/reports/preparation_report.json")
    assert index.count() == 90 and report["status"] == "PASS" and report["copies"] == {"groups_of_copies": 1, "copies_dropped": 1}
    assert index.groupBy("group").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    one = index.filter("target_count > 0").first()
    assert (tmp_path / "prepared" / one["label_path"]).read_text() == one["label"] and len(one["label"].splitlines()) == one["target_count"] == 2
    assert (tmp_path / "prepared" / one["image"]).exists() and (tmp_path / "prepared" / "dataset.yaml").exists()

    info = reports.read_json(f"{out}/metadata/dataset_info.json")
    assert (info["images"], info["source_target_mapping"], info["split_seed"]) == (90, {"fish": "fish", "small_fish": "fish"}, 42) and info["target_boxes"] == index.agg(F.sum("target_count")).first()[0]
    assert reports.read_json(f"{out}/metadata/dataset_provenance.json")["final_class"] == "fish"
    as_json = command.read_records(spark, f"{out}/metadata/image_index", out)
    names = ["image", "label_path", "label", "split", "group", "width", "height", "target_count", "sha256"]
    assert sorted(map(tuple, as_json.select(names).collect())) == sorted(map(tuple, index.select(names).collect()))
    notes = indexes.read_annotation_index(spark, f"{out}/metadata/annotation_index")
    assert {r["image"]: len(r["annotations"]) for r in notes.collect()} == {r["image"]: r["target_count"] for r in index.collect()}

    shape = {"positives": 8, "negatives": 4, "with_tiny": 3, "with_small": 2, "cap": 6}
    policy = stages.try_out(spark, index, out, f"file://{tmp_path}/reports", **shape)
    told = {name: reports.read_json(f"file://{tmp_path}/reports/{name}.json") for name in ("trial", "calibration", "sampling", "policy_candidate")}
    assert policy["policy_fingerprint_sha256"] == told["policy_candidate"]["policy_fingerprint_sha256"] and told["sampling"]["status"] == "PASS"
    assert told["calibration"]["selected_threshold"] in decide.THRESHOLD_GRID and len(told["calibration"]["threshold_analysis"]) == 18 and len(told["trial"]["decisions"]) == told["sampling"]["counts"]["smoke_images"] > 10
    assert sum(told["trial"]["winners"].values()) == len(told["trial"]["decisions"])
    config = {"policy_version": stages.VERSION, "threshold": told["calibration"]["selected_threshold"], "modes": 8, "cap": 6, "splits": {r["split"]: r["n"] for r in index.groupBy("split").agg(F.count("*").alias("n")).collect()}}
    checks = certify.preflight(told["trial"], told["calibration"], told["sampling"], index.withColumn("label", F.col("label_path")), config)
    assert {n for n, _, ok in checks if not ok} <= {8, 9}  # these depend on what the pictures allow


def test_exact_percentiles_narrow_to_the_same_values(spark):
    """Groups of all kinds, one of which has nearly all rows, with few digits a round so that many rounds are needed."""
    rng = np.random.default_rng(2)
    values = [*rng.normal(0, 1e-3, 900), *rng.normal(1e300, 1e299, 20), 0.0, -0.0, 5e-324, -5e-324, float("inf"), float("-inf"), *[0.25] * 500]
    rows = [("a", float(v)) for v in values] + [("b", 7.0), ("c", None), ("d", None), ("d", 1.5), (None, 2.0), (None, 4.0)]
    table = spark.createDataFrame(rows, "g string, v double")
    shares = {"lo": 0.0, "p10": 0.1, "mid": 0.5, "p9": 0.937, "hi": 1.0}
    want = {r["g"]: tuple(r)[1:] for r in table.groupBy("g").agg(*[F.percentile("v", F.lit(q)).alias(n) for n, q in shares.items()]).collect()}
    for digits in (8, 16):
        got = {r["g"]: tuple(r)[1:] for r in percentiles.exact_percentiles(table, ["g"], "v", shares, digits).collect()}
        assert got == want, digits
    assert percentiles.exact_percentiles(table.filter("g = 'b'"), [], "v", shares).first()["mid"] == 7.0
    assert percentiles.exact_percentiles(table.limit(0), ["g"], "v", shares).collect() == []
    back = table.filter("v IS NOT NULL").select("v", percentiles.unsortable(percentiles.sortable(F.col("v"))).alias("w")).collect()
    assert all(r["v"] == r["w"] for r in back)
    nan = spark.createDataFrame([(float(x),) for x in ("nan", "1", "2")], "v double")
    assert np.isnan(percentiles.exact_percentiles(nan, [], "v", {"hi": 1.0}).first()["hi"]) and percentiles.exact_percentiles(nan, [], "v", {"mid": 0.5}).first()["mid"] == 2.0


def test_no_group_keeps_its_values_in_one_map(spark):
    """No aggregate that collects values stands in the plans of the reports by mode and threshold."""
    rows = spark.range(100).select(F.col("id").cast("string").alias("image"), F.lit("m").alias("mode"), F.lit(True).alias("passed"), (F.col("id") / 7).alias("benefit"))
    plan = decide.mode_report(rows)._jdf.queryExecution().toString()
    assert "percentile(" not in plan


def test_json_is_read_in_parts(spark, tmp_path, monkeypatch):
    odd = ['a"b', "\\", '\\\\"', "}{", "[,]", "", ",\"", "漢", None, 1.5, True, {"x": [1, {"y": "]"}]}, [], {}]
    docs = {f"k{i}": [odd[(i + j) % len(odd)] for j in range(i)] for i in range(9)} | {'q"\\': {"m": 1, "n": [2]}, "none": [], "scalar": 3}
    whole = [{"id": i, "v": odd[i % len(odd)]} for i in range(40)]
    for name, doc, indent in (("object", docs, None), ("pretty", docs, 2), ("array", whole, 1)):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=False))
    uri = lambda name: f"file://{tmp_path}/{name}.json"
    monkeypatch.setattr(bigjson, "MORE", 5)
    for chunk in (23, 1 << 20):
        items = bigjson.json_items(spark, [uri("array")], 1, chunk).orderBy("at").collect()
        assert [json.loads(r["text"]) for r in items] == whole
        members = {}
        for r in bigjson.json_items(spark, [uri("object")], 1, chunk).collect():
            members |= json.loads("{" + r["text"] + "}")
        assert members == docs
        got = bigjson.json_items(spark, [uri("object"), uri("pretty")], 2, chunk).orderBy("file", "at").collect()
        for name in ("object", "pretty"):
            for key, value in docs.items():
                texts = [r["text"] for r in got if r["file"] == uri(name) and r["key"] == key]
                assert [json.loads(t if isinstance(value, list) else "{" + t + "}") for t in texts] == (value if isinstance(value, list) else [{k: v} for k, v in value.items()] if isinstance(value, dict) else [])
    starts = bigjson.chunk_states(spark, [uri("array")], 17)
    assert starts.count() == -(-(tmp_path / "array.json").stat().st_size // 17) and starts.rdd.getNumPartitions() >= 1
    (tmp_path / "torn.json").write_text('{"a": [1, 2')
    with pytest.raises(Exception, match="damaged"):
        bigjson.json_items(spark, [uri("torn")]).collect()
    with pytest.raises(FileNotFoundError):
        bigjson.json_items(spark, [uri("absent")])


def test_indexes_are_read_and_written_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(indexes, "ITEMS", 7)
    rows = spark.range(30).select(F.concat("id", F.lit(".png")).alias("prepared_image"), F.lit("train").alias("split"), F.col("id").cast("int").alias("width"))
    indexes.write_image_index(rows, f"file://{tmp_path}/images")
    assert len(list((tmp_path / "images").glob("*.json"))) > 2
    read = indexes.read_image_index(spark, f"file://{tmp_path}/images", 50)
    assert sorted((r["prepared_image"], r["width"]) for r in read.collect()) == sorted((f"{i}.png", i) for i in range(30))
    (tmp_path / "one.json").write_text(json.dumps({f"{i}.png": [{"class_id": 0, "bbox_xywh": [1.0, 2.0, 3.0, float(i)]}] * i for i in range(5)}, indent=2))
    notes = {r["image"]: r["annotations"] for r in indexes.read_annotation_index(spark, f"file://{tmp_path}/one.json", 30).collect()}
    assert {k: len(v) for k, v in notes.items()} == {f"{i}.png": i for i in range(5)} and notes["3.png"][0]["bbox_xywh"][3] == 3.0
    (tmp_path / "bad.json").write_text('[{"prepared_image": 1}, {"prepared_image": ]')
    with pytest.raises(Exception):  # noqa: B017
        indexes.read_image_index(spark, f"file://{tmp_path}/bad.json").collect()


def test_files_become_visible_together_or_not_at_all(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    files = spark.range(20).select(F.format_string("s%d/f%d.txt", F.col("id") % 3, F.col("id")).alias("name"), F.col("id").cast("string").cast("binary").alias("content"), F.lit("k").alias("kind"))
    seen = lambda: sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*.txt") if "_staging" not in p.parts)
    broken = files.withColumn("content", F.when(F.col("name") == "s1/f13.txt", F.raise_error(F.lit("the disk went"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="the disk went"):
        images.write_files(broken, folder)
    assert seen() == []
    filesink.recover(spark, folder)  # a task that was still writing may have left something that no one sees
    assert not (tmp_path / "out" / "_staging").exists()
    job = filesink.stage(files.repartition(3), folder, ["kind"])
    assert seen() == []  # committed, and the driver died before the move
    filesink.stage(files, folder)
    (tmp_path / "out" / "_staging" / "torn" / "x" / "files").mkdir(parents=True)
    assert filesink.recover(spark, folder) == {"published": 2, "dropped": 1}
    assert len(seen()) == 20 and not (tmp_path / "out" / "_staging").exists()
    told = images.write_files(files.withColumn("content", F.lit("new").cast("binary")), folder, ["kind"]).collect()
    assert {r["name"] for r in told} == set(seen()) and {(r["length"], r["kind"]) for r in told} == {(3, "k")}
    assert all((tmp_path / "out" / n).read_text() == "new" for n in seen()) and len({r["sha256"] for r in told}) == 1
    job = filesink.stage(files, folder)
    place = next((tmp_path / "out" / "_staging" / job).glob("*/files/s0/f0.txt"))
    place.rename(tmp_path / "out" / "s0" / "f0.txt")  # the first move was done, then the driver died
    assert filesink.publish(spark, folder, job).count() == 20 and (tmp_path / "out" / "s0" / "f0.txt").read_text() == "0"
    assert images.write_files(files.limit(0), folder).count() == 0


def test_one_run_at_a_time_and_what_it_tells_first(spark, tmp_path, monkeypatch):
    root, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for i in range(4):
        (tmp_path / "in" / "train" / "images").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / "train" / "images" / f"i{i}.png").write_bytes(images.encode_png(picture(i)))
    records = spark.createDataFrame([(f"train/images/i{i}.png", "", "train", f"g{i}", 0, 64, 48) for i in range(4)], "image string, label string, split string, group string, target_count int, width int, height int")

    def dying(spark, todo, out_, rules):
        told = reports.read_json(f"{out}/metadata/run_configuration.json")
        assert told["runtime_selector_label_free"] and told["frozen_threshold"] == 0.02 and reports.read_json(f"{out}/metadata/frozen_policy.json") == json.loads(json.dumps(rules))
        assert reports.read_json(f"{out}/metadata/source_dataset_info.json") == {"about": 1}
        with pytest.raises(runlog.Locked, match=told["run"]):
            curation.run(spark, records, root, out)
        raise RuntimeError("stopped")

    monkeypatch.setattr(curation, "_batch", dying)
    with pytest.raises(RuntimeError, match="stopped"):
        curation.run(spark, records, root, out, told={"about": 1})
    assert not (tmp_path / "out" / runlog.LOCK).exists()
    (tmp_path / "out" / runlog.LOCK).write_text('{"run": "dead"}')
    with pytest.raises(runlog.Locked, match="dead"):
        curation.run(spark, records, root, out, told={"about": 1})
    with pytest.raises(RuntimeError, match="stopped"):
        curation.run(spark, records, root, out, take_over=True, told={"about": 1})
    assert not (tmp_path / "out" / runlog.LOCK).exists()


def test_a_batch_reads_its_own_records_only(spark):
    rows = spark.range(100).withColumn("image", F.concat(F.lit("i"), "id"))
    parts = runlog.in_batches(rows, "image", 15, "todo")
    assert 2 < len(parts) <= 7 and sorted(r["id"] for p in parts for r in p.collect()) == list(range(100))
    files = [set(p.inputFiles()) for p in parts]
    assert all(len(f) == 1 for f in files) and len(set().union(*files)) == len(parts)
    assert runlog.in_batches(rows.limit(0), "image", 15, "todo") == []


def test_a_prepared_set_is_verified_and_made_anew(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = []
    for i in range(4):
        data = images.encode_png(picture(i))
        for kind, name, content in (("images", f"i{i}.png", data), ("labels", f"i{i}.txt", b"0 0.5 0.5 0.1 0.1\n")):
            (tmp_path / "out" / "train" / kind).mkdir(parents=True, exist_ok=True)
            (tmp_path / "out" / "train" / kind / name).write_bytes(content)
        rows.append((f"train/images/i{i}.png", f"train/labels/i{i}.txt", "0 0.5 0.5 0.1 0.1\n", 1, 64, 48, hashlib.sha256(data).hexdigest()))
    index = spark.createDataFrame(rows, "image string, label_path string, label string, target_count int, width int, height int, sha256 string")
    faults = lambda: {tuple(r) for r in stages.prepared_faults(spark, index, out, True).collect()}
    assert faults() == set()
    (tmp_path / "out/train/labels/i0.txt").write_text("0 0.5 0.5 0.1 0.2\n")
    (tmp_path / "out/train/labels/i1.txt").unlink()
    (tmp_path / "out/train/labels/more.txt").write_text("0")
    (tmp_path / "out/train/images/i2.png").write_bytes(images.encode_png(picture(9, 40, 64)))
    (tmp_path / "out/train/images/i3.png").write_bytes(b"no image")
    got = faults()
    assert {("train/labels/i0.txt", "label differs"), ("train/labels/i1.txt", "missing"), ("train/labels/more.txt", "extra"), ("train/images/i2.png", "sha256 differs"), ("train/images/i2.png", "height differs"), ("train/images/i3.png", "sha256 differs"), ("train/images/i3.png", "width differs")} <= got
    (tmp_path / "out" / "kept.txt").write_text("of someone else")
    stages.clear_prepared(out)
    assert not list((tmp_path / "out" / "train").rglob("*.txt")) and (tmp_path / "out" / "kept.txt").exists()


def test_the_entry_works_without_the_text_operators(tmp_path):
    """From a copy that lacks their folders, with and without the pipeline's file."""
    root = Path(__file__).parents[1]
    shutil.copytree(root / "sievework", tmp_path / "sievework", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; names = set(e.queries()); assert names > set(e.oracle_sql()) and len(names) > 80 and not any(n.startswith('op') or n == 'pipeline' for n in names)"
    for name in ("", "corpus_pipeline.py"):
        if name and (root / name).exists():
            shutil.copy(root / name, tmp_path)
        told = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
        assert told.returncode == 0, told.stderr


def test_limits_are_the_published_ones():
    """Written out here once more: SQL that is made from the limits would not notice a wrong one."""
    of = lambda table: {k: v[1:] for k, v in table.items()}
    assert of(decide.GLOBAL_LIMITS) == {
        "geometry_changed": ("<", 1.0), "global_detail_loss": ("<", 0.85), "global_edge_loss": ("<", 0.72), "global_blur": ("<", 0.65), "global_over_sharpening": (">", 3.0), "global_noise_increase": (">", 2.0),
        "edge_explosion_or_artifacts": (">", 2.5), "excessive_black_clipping": (">", 0.1), "excessive_white_clipping": (">", 0.1), "added_clipping_above_limit": (">", 0.05),
        "image_too_dark": ("<", 0.06), "image_too_bright": (">", 0.94), "extreme_colour_shift": (">", 55.0), "extreme_saturation_shift": (">", 0.25),
    }
    local = of(decide.LOCAL_LIMITS)
    assert [local[k][:2] for k in ("local_detail_loss", "local_edge_loss", "local_blur", "local_over_sharpening", "local_noise_increase")] == [("<", 0.78), ("<", 0.72), ("<", 0.72), (">", 2.4), (">", 1.8)]
    assert pixels.BENEFIT_WEIGHTS == {"uciqe_proxy": 0.24, "uiqm_proxy": 0.18, "brightness_quality": 0.16, "contrast_quality": 0.14, "entropy_quality": 0.1, "color_balance": 0.1, "sharpness_quality": 0.08}
    assert (decide.NEAR_TIE, decide.HIGHER_EXTRA, decide.HIGHER_OVER_SAFE, decide.LEAST_PROCESSED, decide.LEAST_RATE, decide.DEFAULT_THRESHOLD) == (0.0005, 0.003, 0.002, 10, 0.05, 0.02)
    assert decide.THRESHOLD_GRID == (0.0005, 0.001, 0.0015, 0.002, 0.003, 0.004, 0.005, 0.006, 0.008, 0.01, 0.012, 0.014, 0.016, 0.018, 0.02, 0.022, 0.025, 0.03)
    assert (pixels.GRIDS, pixels.TILE_SHARE) == ((4, 8), 0.6)
    assert {m for m, r in decide.MODES.items() if r == "higher"} == {"bilateral_denoise_mild", "clahe_very_mild", "white_balance_conservative"} and len(decide.MODES) == 7


def test_unchanged_files_are_not_read_again(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/out"
    folder = tmp_path / "out" / "train" / "images"
    folder.mkdir(parents=True)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for i in range(12):
        (folder / f"i{i}.png").write_bytes(b"picture %d" % i)
    now = lambda: {r["name"].rsplit("/", 1)[-1]: r["sha256"] for r in filecache.hashes(spark, root, spark.read.parquet(str(tmp_path / "kept"))).collect()}
    first = filecache.hashes(spark, root, None)
    assert {r["sha256"] for r in first.collect()} == {sha(b"picture %d" % i) for i in range(12)}
    filecache.remember(spark, root, first.withColumn("sha256", F.lit("remembered")), str(tmp_path / "kept"))
    for buckets in (1, 4, 4096):  # with one bucket, a change makes all files be compared
        monkeypatch.setattr(filecache, "BUCKETS", buckets)
        assert set(now().values()) == {"remembered"}
    (folder / "i3.png").write_bytes(b"other 3")
    (folder / "i5.png").unlink()
    (folder / "new.png").write_bytes(b"new")
    for buckets in (1, 4, 4096):
        monkeypatch.setattr(filecache, "BUCKETS", buckets)
        assert now() == {f"i{i}.png": "remembered" for i in range(12) if i not in (3, 5)} | {"i3.png": sha(b"other 3"), "new.png": sha(b"new")}


def test_more_groups_than_a_task_holds_are_split_in_bundles(spark, monkeypatch):
    monkeypatch.setattr(split, "MAX_GROUPS", 60)
    stats = spark.createDataFrame([(f"g{i}", 400 if i < 9 else 1 + i % 5, i % 4) for i in range(2000)], "group string, images long, boxes long")
    bundles = {r["group"]: r["bundle"] for r in split.bundled(stats).collect()}
    assert len(bundles) == 2000 and len(set(bundles.values())) <= 60 and all(bundles[f"g{i}"] == f"group g{i}" for i in range(9))
    got = split.balanced_split(stats, 30).collect()
    assert len(got) == 2000 and {r["group"] for r in got} == set(bundles)
    by = {}
    for r in got:
        assert by.setdefault(bundles[r["group"]], r["split"]) == r["split"]
    assert got[0]["score"] < 0.05
