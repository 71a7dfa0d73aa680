"""Quality, structure and regions of image candidates: tasks give raw sums over areas, Spark works out all metrics.

A task decodes an image once, makes each candidate and gives a row of sums for the whole image, for each tile and for
each region around a box. Ratios, the choice of tiles, percentiles, benefit and weighted means are columns and groupings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.boxes import area_ratio, protected_region, size_class
from ..functions.rules import clamp, safe_ratio, weighted_mean, weighted_sum
from ..shared import materialize
from .decide import MODES, RAW
from .kernels import TRANSFORMS, Side, gray, image_sums, lab_distance, lab_distances, pair_sums, pixels_of, shrink, tile_bounds, whole_lab

#: Fixed weights of the benefit score.
BENEFIT_WEIGHTS = {"uciqe_proxy": 0.24, "uiqm_proxy": 0.18, "brightness_quality": 0.16, "contrast_quality": 0.14, "entropy_quality": 0.10, "color_balance": 0.10, "sharpness_quality": 0.08}
#: Longest side at which structure is compared, tile grids, least tile side, share and least number of tiles kept.
WORK_SIDE, GRIDS, TILE_SIDE, TILE_SHARE, TILE_LEAST = 640, (4, 8), 8, 0.6, 8
RATIOS = ("detail", "edge", "sharpness", "noise", "contrast")
#: Sums of a whole image, and those of an area of a raw image and its candidate.
IMAGE_SUMS = ("n", "b_sum", "g_sum", "r_sum", "edges", "light_1", "light_99", *[f"{k}_{s}" for k in ("lap", "noise", "rg", "yb", "chroma") for s in ("sum", "sq")], "purity_sum", "hsv_sum")
PAIR_SUMS = ("n", *[f"{side}_{k}_{s}" for side in "ab" for k in ("gray", "lap", "noise", "size") for s in ("sum", "sq")], "size_both", "alike", "strong", "strong_kept")


def candidates(image: np.ndarray, modes: tuple[str, ...] = tuple(MODES)) -> Iterator[tuple[str, np.ndarray]]:
    """The raw image and each candidate, one at a time."""
    yield RAW, image
    for mode in modes:
        yield mode, TRANSFORMS[mode](image)


def _made(images: list[np.ndarray], modes: tuple[str, ...]) -> Iterator[tuple[str, list[np.ndarray]]]:
    """The raw images and each candidate of all of them; of a single one, which may be large, one candidate at a time."""
    runs = [candidates(x, modes) for x in images]
    for step in zip(*(runs if len(runs) == 1 else map(list, runs)), strict=True):
        yield step[0][0], [x for _, x in step]


def _area_rows(images: list[np.ndarray], grids: tuple[int, ...], modes: tuple[str, ...], whole: bool) -> Iterator[dict]:
    """Columns of rows, of images of one shape: the whole sums of each candidate (grid 0), and its sums with the raw image over the areas of each grid.

    ``of`` is a row's image by its place. Areas of equal size are worked through together, those of all images.
    """
    work, k = [shrink(x, WORK_SIDE) for x in images], len(images)
    areas: dict[tuple, list] = {}
    for n in grids:
        for i, at in enumerate(tile_bounds(*work[0].shape[:2], n, 1 if n == 1 else TILE_SIDE)):
            areas.setdefault((n, at[1] - at[0], at[3] - at[2]), []).append((i, at))
    stack = lambda g, group: Side(np.stack([g[:, a:b, c:d] for _, (a, b, c, d) in group], axis=1).reshape(-1, *g[0, slice(*group[0][1][:2]), slice(*group[0][1][2:])].shape))
    raw, raw_labs = None, [None] * k
    for mode, made in _made(images, modes):
        same = np.array([x.shape == image.shape for x, image in zip(made, images, strict=True)])
        small = [shrink(x, WORK_SIDE) if ok else y for x, y, ok in zip(made, work, same, strict=True)]  # rows of those of another shape are left out below
        if whole:
            grays, sums, labs = [], [], []
            for i, (x, y) in enumerate(zip(made, small, strict=True)):
                g, lab = gray(x), whole_lab(x)
                sums.append(image_sums(x, g, lab))
                if y is not x:
                    g, lab = gray(y), whole_lab(y)
                raw_labs[i] = lab if mode == RAW else raw_labs[i]
                grays.append(g)
                labs.append(lab_distance(raw_labs[i], lab) if same[i] else None)
            yield {"of": np.arange(k), "mode": mode, "grid": [0] * k, "tile": [0] * k, "same_shape": same.astype(float), "lab": labs, **{f"w_{c}": [r[c] for r in sums] for c in sums[0]}}
        if not areas:
            continue
        g = np.stack(grays) if whole else gray(np.stack(small))
        sides = {key: stack(g, group) for key, group in areas.items()}
        raw = raw or sides
        if mode != RAW:
            for key, group in areas.items():
                kept = np.repeat(same, len(group))
                tiles = np.tile([i for i, _ in group], k)[kept]
                yield {"of": np.repeat(np.arange(k), len(group))[kept], "mode": mode, "grid": [key[0]] * len(tiles), "tile": tiles, **{f"p_{c}": v[kept] for c, v in pair_sums(raw[key], sides[key]).items()}}


def _record(keys: list[str], part: dict, kinds: pa.Schema) -> pa.RecordBatch:
    """Rows from their columns: ``of`` is the place of a row's key, ``mode`` is the same for all, those that are not given are null."""
    n = len(part["of"])
    given = part | {"image": [keys[i] for i in part["of"]], "mode": [part["mode"]] * n}
    return pa.RecordBatch.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in kinds], schema=kinds)


#: Pixels of small images that a task works through together; a larger image is worked through alone.
PIXELS = 1 << 19
#: Images are dealt to this many partitions at most.
PARTITIONS = 10_000


def _per_group(images: DataFrame, more: list[str], make: Callable[[list[tuple]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Record batches that ``make`` gives for groups of decodable images: their keys, pixels and columns ``more``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, held = [], 0
            for row in range(len(batch)):
                key, h, w, data, *rest = (c[row].as_py() for c in batch.columns)
                if (image := pixels_of(data, h, w)) is None:
                    continue
                if group and held + h * w > PIXELS:
                    yield from make(group)
                    group, held = [], 0
                group.append((key, image, *rest))
                held += h * w
            if group:
                yield from make(group)

    return images.select(F.col("image").cast("string"), "height", "width", "data", *more).mapInArrow(run, schema)


def _schema(fields: dict[str, pa.DataType]) -> tuple[pa.Schema, str]:
    names = {pa.string(): "string", pa.int32(): "int", pa.float64(): "double", pa.list_(pa.int64()): "array<bigint>"}
    return pa.schema(list(fields.items())), ", ".join(f"{k} {names[t]}" for k, t in fields.items())


def area_sums(images: DataFrame, grids: tuple[int, ...] = (1, *GRIDS), modes: tuple[str, ...] = tuple(MODES), whole: bool = True) -> DataFrame:
    """Rows of raw sums: per image and mode one of the whole image (grid 0, columns ``w_``; none unless ``whole``) and those of areas (``p_``).

    ``images``: ``image`` (its key) and ``height``, ``width``, ``data`` (bytes), as the readers of ``sources.images`` give
    them. Each image is decoded once for all modes; rows whose pixels are missing or too few give nothing. Small images
    of one shape are worked through together.
    """
    fields = {"image": pa.string(), "mode": pa.string(), "grid": pa.int32(), "tile": pa.int32(), "same_shape": pa.float64(), "lab": pa.float64()}
    fields |= {f"w_{k}": pa.float64() for k in IMAGE_SUMS} | {"w_hist": pa.list_(pa.int64())} | {f"p_{k}": pa.float64() for k in PAIR_SUMS}
    kinds, schema = _schema(fields)

    def make(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        shapes: dict[tuple, list] = {}
        for key, image in group:
            shapes.setdefault(image.shape, []).append((key, image))
        for alike in shapes.values():
            keys, pictures = map(list, zip(*alike, strict=True))
            for part in _area_rows(pictures, grids, modes, whole):
                yield _record(keys, part, kinds)

    return _per_group(images, [], make, schema)


def _sd(total: Column, square: Column, n: Column) -> Column:
    return F.sqrt(F.greatest(square / n - (total / n) ** 2, F.lit(0.0)))


def quality(sums: DataFrame) -> DataFrame:
    """The quality of whole images from their sums (``w_``): ``image``, ``mode``, ``same_shape``, ``lab`` and 17 measures."""
    w, n = lambda k: F.col(f"w_{k}"), F.col("w_n")
    sd = lambda k: _sd(w(f"{k}_sum"), w(f"{k}_sq"), n)
    levels = F.sequence(F.lit(0), F.lit(255))
    over = lambda f: F.aggregate(F.zip_with(w("hist"), levels, f), F.lit(0.0), lambda s, x: s + x)
    gray_sum, gray_sq = over(lambda c, v: (c * v).cast("double")), over(lambda c, v: (c * v * v).cast("double"))
    bits = -over(lambda c, v: F.when(c > 0, c / n * F.log2(c / n)).otherwise(0.0))
    means = [w(f"{c}_sum") / n for c in "bgr"]
    mean = (means[0] + means[1] + means[2]) / 3
    spread = F.sqrt(((means[0] - mean) ** 2 + (means[1] - mean) ** 2 + (means[2] - mean) ** 2) / 3)
    unit = lambda c: clamp(c, 0.0, 1.0)
    first = sums.filter("grid = 0").withColumns({
        "brightness": gray_sum / n / 255, "contrast": _sd(gray_sum, gray_sq, n), "sharpness": sd("lap") ** 2, "entropy": bits, "noise": sd("noise"), "edge_density": w("edges") / n,
        "black_clip": F.aggregate(F.slice("w_hist", 1, 6), F.lit(0).cast("long"), lambda s, x: s + x) / n,
        "white_clip": F.aggregate(F.slice("w_hist", 251, 6), F.lit(0).cast("long"), lambda s, x: s + x) / n,
        "color_balance": F.when(mean > 1e-6, unit(1 - spread / mean)).otherwise(0.0), "saturation": w("hsv_sum") / n,
        "colorfulness": unit((F.hypot(sd("rg"), sd("yb")) + 0.3 * F.hypot(w("rg_sum") / n, w("yb_sum") / n)) / 100),
        "uciqe_proxy": unit(0.4680 * unit(sd("chroma") / 64) + 0.2745 * (w("light_99") - w("light_1")) / 255 + 0.2576 * unit(w("purity_sum") / n)),
    })
    second = first.withColumns({
        "brightness_quality": unit(1 - F.abs(F.col("brightness") - 0.5) / 0.5), "contrast_quality": unit(F.col("contrast") / 64),
        "sharpness_quality": unit(F.log1p("sharpness") / F.log1p(F.lit(1500.0))), "entropy_quality": unit(F.col("entropy") / 8),
    })
    uiqm = 0.35 * F.col("colorfulness") + 0.35 * F.col("sharpness_quality") + 0.30 * F.col("contrast_quality")
    return second.withColumn("uiqm_proxy", unit(uiqm)).select("image", "mode", "same_shape", "lab", *QUALITY)


QUALITY = ["brightness", "brightness_quality", "contrast", "contrast_quality", "sharpness", "sharpness_quality", "entropy", "entropy_quality", "black_clip", "white_clip", "color_balance", "colorfulness", "saturation", "noise", "edge_density", "uciqe_proxy", "uiqm_proxy"]


def with_ratios(areas: DataFrame) -> DataFrame:
    """Adds ``energy`` and the five ratios of candidate over raw to rows of sums of areas (``p_``).

    ``detail`` is the correlation of the gradients within [0, 1], of flat ones 1 if they are alike; ``edge`` the share of
    strong raw gradients that the candidate has within a pixel, 1 without any.
    """
    p, n = lambda k: F.col(f"p_{k}"), F.col("p_n")
    sd = lambda k: _sd(p(f"{k}_sum"), p(f"{k}_sq"), n)
    under = sd("a_size") * sd("b_size")
    both = p("size_both") / n - p("a_size_sum") * p("b_size_sum") / (n * n)
    return areas.withColumns({
        "energy": p("a_size_sum") / n,
        "detail": F.when(under < 1e-9, p("alike")).otherwise(clamp(both / under, 0.0, 1.0)),
        "edge": F.when(p("strong") > 0, p("strong_kept") / p("strong")).otherwise(1.0),
        "sharpness": safe_ratio(sd("b_lap") ** 2, sd("a_lap") ** 2, 1.0), "noise": safe_ratio(sd("b_noise"), sd("a_noise"), 0.25), "contrast": safe_ratio(sd("b_gray"), sd("a_gray"), 1.0),
    })


def local_detail(areas: DataFrame) -> DataFrame:
    """Per image and mode the 10th, 50th and 90th percentile of each ratio over its most detailed tiles.

    Of all tiles of the grids, ``TILE_SHARE`` of the highest energy count, ``TILE_LEAST`` at least.
    """
    tiles = with_ratios(areas.filter("grid > 1"))
    key = ["image", "mode"]
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("energy"), "grid", "tile"))
    ranked = tiles.withColumn("place", place).withColumn("n_tiles", F.count("*").over(Window.partitionBy(key)))
    kept = ranked.filter(F.col("place") <= F.greatest(F.lit(TILE_LEAST), F.ceil(TILE_SHARE * F.col("n_tiles"))))
    return kept.groupBy(key).agg(F.count("*").alias("tiles"), *[F.percentile(r, F.lit(q / 100)).alias(f"{r}_p{q}") for r in RATIOS for q in (10, 50, 90)])


METRICS = ["brightness", "black_clip", "white_clip", "benefit", "geometry_preserved", "detail_retention", "edge_recall", "sharpness_ratio", "noise_ratio", "edge_density_ratio", "extra_clip", "lab_shift", "saturation_shift", *[f"{r}_p{q}" for r in RATIOS for q in (10, 50, 90)]]


def benefit(quality_: Callable[[str], Column], raw: Callable[[str], Column]) -> Column:
    """The weighted gains of a candidate's quality over the raw image's."""
    return weighted_sum([(quality_(k) - raw(k), w) for k, w in BENEFIT_WEIGHTS.items()])


def structure(rated: DataFrame) -> DataFrame:
    """Adds how far candidates keep the structure of the raw image, to their quality, the raw one's (``raw_``) and the whole pair's ratios (``w_``).

    A candidate of another size keeps nothing: its ratios are infinite.
    """
    same, inf = F.col("same_shape") == 1, F.lit(float("inf"))
    of = lambda c, other: F.when(same, c).otherwise(other)
    r = lambda k: F.col(f"raw_{k}")
    more = lambda k: F.greatest(F.col(k) - r(k), F.lit(0.0))
    return rated.withColumns({
        "geometry_preserved": F.col("same_shape"), "detail_retention": of(F.col("w_detail"), F.lit(0.0)), "edge_recall": of(F.col("w_edge"), F.lit(0.0)),
        "sharpness_ratio": of(safe_ratio(F.col("sharpness"), r("sharpness"), 1.0), inf), "noise_ratio": of(safe_ratio(F.col("noise"), r("noise"), 0.25), inf),
        "edge_density_ratio": of(safe_ratio(F.col("edge_density"), r("edge_density"), 1e-4), inf), "extra_clip": of(more("black_clip") + more("white_clip"), F.lit(1.0)),
        "lab_shift": of(F.col("lab"), inf), "saturation_shift": of(F.abs(F.col("saturation") - r("saturation")), F.lit(1.0)),
    })


def evaluate_sums(sums: DataFrame) -> DataFrame:
    """``image``, ``mode``, ``risk``, ``priority`` and the metrics of every candidate but the raw image, from ``area_sums``.

    The sums and the qualities are written once: the pixels are not worked through again for each use of them. All
    groupings and joins are by image. Without tiles each local ratio is 1.
    """
    sums = materialize(sums, "area-sums")
    rated = materialize(quality(sums), "quality")
    raw = rated.filter(F.col("mode") == RAW).select("image", *[F.col(k).alias(f"raw_{k}") for k in QUALITY])
    whole = with_ratios(sums.filter("grid = 1")).select("image", "mode", F.col("detail").alias("w_detail"), F.col("edge").alias("w_edge"))
    out = rated.filter(F.col("mode") != RAW).join(raw, "image").join(whole, ["image", "mode"], "left").join(local_detail(sums), ["image", "mode"], "left")
    out = structure(out).withColumn("benefit", benefit(F.col, lambda k: F.col(f"raw_{k}")))
    local = {f"{r}_p{q}": F.coalesce(f"{r}_p{q}", F.lit(1.0)) for r in RATIOS for q in (10, 50, 90)}
    told = F.create_map(*[F.lit(x) for i, m in enumerate(MODES) for x in (m, i)])
    risk = F.create_map(*[F.lit(x) for m, r in MODES.items() for x in (m, r)])
    rows = out.withColumns(local).select("image", "mode", F.element_at(risk, F.col("mode")).alias("risk"), F.element_at(told, F.col("mode")).alias("priority"), *METRICS)
    return materialize(rows, "evaluations")  # the rules that come next would repeat each metric's expression many times over


def evaluate_images(images: DataFrame) -> DataFrame:
    """``image``, ``mode``, ``risk``, ``priority`` and the metrics of every decodable image."""
    return evaluate_sums(area_sums(images))


def profile_images(images: DataFrame) -> DataFrame:
    """``image``, brightness, contrast, sharpness and colour cast of the scene, for every decodable image."""
    kinds, schema = _schema({"image": pa.string(), "n": pa.float64(), "b": pa.float64(), "g": pa.float64(), "r": pa.float64(), "lap_sum": pa.float64(), "lap_sq": pa.float64(), "gray_sum": pa.float64(), "gray_sq": pa.float64()})

    def make(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows = []
        for key, image in group:
            side = Side(gray(image)[None])
            b, g, r = (float(image[..., i].sum(dtype=np.int64)) for i in range(3))
            rows.append({"image": key, "n": float(image.size // 3), "b": b, "g": g, "r": r} | {k: float(v[0]) for k, v in side.sums.items() if k in kinds.names})
        yield pa.RecordBatch.from_pylist(rows, kinds)

    n, mean = F.col("n"), (F.col("b") + F.col("g") + F.col("r")) / (3 * F.col("n"))
    cast = F.sqrt(sum(((F.col(c) / n - mean) ** 2 for c in "gr"), (F.col("b") / n - mean) ** 2) / 3) / F.greatest(mean, F.lit(1e-6))
    return _per_group(images, [], make, schema).select("image", (F.col("gray_sum") / n / 255).alias("brightness"), _sd(F.col("gray_sum"), F.col("gray_sq"), n).alias("contrast"), (_sd(F.col("lap_sum"), F.col("lap_sq"), n) ** 2).alias("sharpness"), cast.alias("colour_cast"))


def profile_records(records: DataFrame, profiles: DataFrame) -> DataFrame:
    """Records (``image``, ``boxes``, ``width``, ``height``) with their scene's profile and how many boxes of each size they have."""
    from ..functions.boxes import size_counts

    counts = size_counts(F.col("boxes"), F.col("width"), F.col("height"))
    sized = records.withColumn("sizes_", counts).select("*", *[F.col(f"sizes_.{k}").alias(n) for k, n in (("tiny", "tiny_count"), ("small", "small_count"), ("medium_large", "medium_large_count"))]).drop("sizes_")
    return sized.join(profiles, "image")


#: Weights of regions by the size of their boxes.
REGION_WEIGHTS = {"tiny": 2.0, "small": 1.5, "medium_large": 1.0}


def region_metrics(images: DataFrame, boxes: DataFrame, modes: tuple[str, ...] = tuple(MODES), lab: bool = True) -> DataFrame:
    """Per image and mode: ``boxes`` (measured), boxes of each size class, and weighted means of the region ratios and, if wanted, of the distance in Lab.

    ``boxes``: ``image`` and ``bbox`` (x, y, width, height), any number per image. Boxes that are not four
    numbers are skipped; each other counts by size, and is measured with its surroundings unless those are
    below three pixels. ``any_*`` weighs tiny and small boxes more, ``tiny_*`` is the mean over tiny ones;
    both are null without such boxes. Regions leave the tasks as rows of sums and are averaged map-side; those of
    one shape are worked through together, also of several small images.
    """
    sized = materialize(images.select("image", F.col("height").alias("h_"), F.col("width").alias("w_")), "sizes")
    total = sized.agg(F.sum(F.greatest(F.col("h_"), F.lit(0)).cast("long") * F.greatest(F.col("w_"), F.lit(0)))).first()[0]
    tasks = max(1, min((total or 0) // PIXELS, PARTITIONS))  # by pixels, for small images are much work for few bytes
    box = boxes.filter(F.size("bbox") == 4).filter(~F.exists("bbox", lambda v: v.isNull() | F.isnan(v))).join(sized, "image")
    size = size_class(area_ratio(F.col("bbox"), F.col("w_"), F.col("h_")))
    region = protected_region(F.col("bbox"), F.col("w_"), F.col("h_"))
    lists = box.select("image", F.struct(region.alias("at"), size.alias("size")).alias("b")).groupBy("image").agg(F.collect_list("b").alias("regions"))  # the boxes of one image
    kinds, schema = _schema({"image": pa.string(), "mode": pa.string(), "size": pa.string(), "lab": pa.float64(), **{f"p_{k}": pa.float64() for k in PAIR_SUMS}})

    def make(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys, pictures, lists = map(list, zip(*group, strict=True))
        runs: list[list] = []
        latest: dict[tuple, list] = {}
        for i, regions in enumerate(lists):
            for r in regions:
                top, bottom, left, right = (max(int(r["at"][k]), 0) for k in ("top", "bottom", "left", "right"))
                shape = pictures[i][top:bottom, left:right].shape[:2]
                shape = shape if min(shape) >= 3 else (0, 0)
                if shape not in latest or (len(latest[shape]) + 1) * shape[0] * shape[1] > PIXELS:
                    latest[shape] = []
                    runs.append(latest[shape])
                latest[shape].append((i, np.s_[top:bottom, left:right], r["size"], shape[0] > 0))
        cut = lambda made, run: [made[i][at] for i, at, *_ in run]
        labs = lambda parts: whole_lab(np.stack([shrink(x, WORK_SIDE) for x in parts]))
        raw = raw_labs = []
        for mode, made in _made(pictures, modes):
            sides = [Side(gray(np.stack(cut(made, run)))) if run[0][3] else None for run in runs]
            if mode == RAW:
                raw, raw_labs = sides, [labs(cut(made, run)) if lab and run[0][3] else None for run in runs]
                continue
            for run, a, b, raw_lab in zip(runs, raw, sides, raw_labs, strict=True):
                part = {"of": [i for i, *_ in run], "mode": mode, "size": [x[2] for x in run]}
                if a is not None:
                    part |= {f"p_{k}": v for k, v in pair_sums(a, b).items()} | ({"lab": lab_distances(raw_lab, labs(cut(made, run)))} if lab else {})
                yield _record(keys, part, kinds)

    names = [*RATIOS, "lab"] if lab else RATIOS
    rows = with_ratios(_per_group(images.repartition(tasks, "image").join(lists, "image"), ["regions"], make, schema))
    weight = F.coalesce(*[F.when(F.col("size") == k, w) for k, w in REGION_WEIGHTS.items()])
    seen, tiny = F.col("p_n").isNotNull(), F.col("size") == "tiny"
    rows = rows.withColumn("weight", F.when(seen, weight)).withColumn("tiny_weight", F.when(seen & tiny, 1.0))
    means = [weighted_mean(F.when(seen, F.col(n)), F.col("weight")).alias(f"any_{n}") for n in names] + [weighted_mean(F.when(seen & tiny, F.col(n)), F.col("tiny_weight")).alias(f"tiny_{n}") for n in names]
    return rows.groupBy("image", "mode").agg(F.count_if(seen).alias("boxes"), *[F.count_if(F.col("size") == k).alias(f"{k}_boxes") for k in REGION_WEIGHTS], *means)
