"""Bounding boxes: validity, normalisation, size classes, protected regions, label text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import Rules, clamp, first_failing, safe_ratio, valid_number

#: Tolerance at the image's edges; area ratios below which a box is tiny or small; padding of a region.
EDGE, TINY, SMALL, PAD, PAD_LEAST = 1e-3, 0.0015, 0.0075, 0.2, 24


def box_rules(box: Column, width: Column, height: Column) -> Rules:
    """Rules on an (x, y, width, height) array, in the order in which the first failing one counts."""
    x, y, w, h = (F.get(box, i) for i in range(4))
    return [
        ("not_xywh", box.isNull() | (F.size(box) != 4)),
        ("non_numeric", ~F.coalesce(F.forall(box, valid_number), F.lit(False))),
        ("non_positive_size", (w <= 0) | (h <= 0)),
        ("negative_origin", (x < 0) | (y < 0)),
        ("exceeds_width", x + w > width + EDGE),
        ("exceeds_height", y + h > height + EDGE),
    ]


def box_problem(box: Column, width: Column, height: Column) -> Column:
    return first_failing(box_rules(box, width, height))


def to_yolo(box: Column, width: Column, height: Column) -> Column:
    """Centre and size as shares of the image, each clamped to [0, 1]."""
    x, y, w, h = (F.get(box, i) for i in range(4))
    return F.array(*[clamp(v, 0.0, 1.0) for v in ((x + w / 2) / width, (y + h / 2) / height, w / width, h / height)])


def label_line(yolo: Column) -> Column:
    return F.format_string("0 %.8f %.8f %.8f %.8f", *[F.get(yolo, i) for i in range(4)])


def label_problem(line: Column) -> Column:
    """What is wrong with one line of a label file; null if nothing is."""
    parts = F.split(F.trim(line), r"\s+")
    number = lambda i: F.get(parts, i).try_cast("double")
    kind = F.get(parts, 0).try_cast("int")
    bad = lambda c: ~F.coalesce(c, F.lit(False))
    return first_failing([
        ("not_five_columns", F.size(parts) != 5),
        ("not_numeric", kind.isNull() | bad(F.forall(F.slice(parts, 2, 4), valid_number))),
        ("unknown_class", kind != 0),
        ("center_out_of_range", bad(number(1).between(0, 1) & number(2).between(0, 1))),
        ("size_out_of_range", bad((number(3) > 0) & (number(3) <= 1) & (number(4) > 0) & (number(4) <= 1))),
    ])


def label_file_problem(text: Column, boxes: Column) -> Column:
    """What is wrong with a label file's text: too few or many lines for its boxes, or the first line that is wrong."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    problems = F.filter(F.transform(lines, label_problem), lambda x: x.isNotNull())
    return F.when(F.size(lines) != boxes, "line_count").otherwise(F.get(problems, F.lit(0)))


def area_ratio(box: Column, width: Column, height: Column) -> Column:
    return safe_ratio(F.get(box, 2) * F.get(box, 3), (width * height).cast("double"), 1.0)


def size_class(ratio: Column, tiny: float = TINY, small: float = SMALL) -> Column:
    return F.when(ratio < tiny, "tiny").when(ratio < small, "small").otherwise("medium_large")


def size_counts(boxes: Column, width: Column, height: Column) -> Column:
    """Boxes of each size class as a struct; boxes that are not four numbers are skipped."""
    whole = F.filter(boxes, lambda b: F.size(b) == 4)
    kinds = F.transform(whole, lambda b: size_class(area_ratio(b, width, height)))
    count = lambda kind: F.size(F.filter(kinds, lambda k: k == kind))
    return F.struct(*[count(k).alias(k) for k in ("tiny", "small", "medium_large")])


def protected_region(box: Column, width: Column, height: Column) -> Column:
    """The box padded by a fifth, ``PAD_LEAST`` pixels at least, on every side, within the image."""
    x, y, w, h = (F.get(box, i) for i in range(4))
    px, py = F.greatest(w * PAD, F.lit(float(PAD_LEAST))), F.greatest(h * PAD, F.lit(float(PAD_LEAST)))
    return F.struct(
        F.greatest(F.floor(x - px), F.lit(0)).alias("left"),
        F.greatest(F.floor(y - py), F.lit(0)).alias("top"),
        F.least(F.ceil(x + w + px), width.cast("long")).alias("right"),
        F.least(F.ceil(y + h + py), height.cast("long")).alias("bottom"),
    )
