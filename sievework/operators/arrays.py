"""Measures of small grids held as arrays, by DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)


def variance(values: Column) -> Column:
    """Population variance; the array is worked out once."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    add = lambda m, x: F.struct((m["n"] + 1).alias("n"), (m["s"] + x).alias("s"), (m["q"] + x * x).alias("q"))
    return F.aggregate(values, zero, add, lambda m: F.greatest(m["q"] / m["n"] - (m["s"] / m["n"]) ** 2, F.lit(0.0)))


def spread(values: Column) -> Column:
    """Population standard deviation."""
    return F.sqrt(variance(values))


def share(values: Column, test) -> Column:
    return F.size(F.filter(values, test)) / F.size(values)


def entropy(records: DataFrame, key: str, bins: Column, n_bins: int) -> DataFrame:
    """Entropy in bits of each record's histogram; ``bins`` is an array of bin numbers."""
    counts = records.select(key, F.explode(bins).alias("bin")).groupBy(key, "bin").agg(F.count("*").alias("n"))
    sums = counts.groupBy(key).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("weighted"), F.count("*").alias("bins_used"))
    bits = F.log2("total") - F.col("weighted") / F.col("total")
    return sums.select(key, "bins_used", bits.alias("entropy"), (bits / F.log2(F.lit(float(n_bins)))).alias("entropy_share"))


def laplacian_variance(grid: Column, width: int) -> Column:
    """Population variance of the four-neighbour Laplacian over the inner cells of a row-major grid."""
    inner = F.array(*[F.lit(y * width + x) for y in range(1, width - 1) for x in range(1, width - 1)])
    lap = F.transform(inner, lambda i: F.get(grid, i - 1) + F.get(grid, i + 1) + F.get(grid, i - width) + F.get(grid, i + width) - 4 * F.get(grid, i))
    return variance(lap)


def gradient(grid: Column, width: int) -> Column:
    """Magnitude of the forward differences, over all cells that have a right and a lower neighbour."""
    cells = F.array(*[F.lit(y * width + x) for y in range(width - 1) for x in range(width - 1)])
    return F.transform(cells, lambda i: F.sqrt((F.get(grid, i + 1) - F.get(grid, i)) ** 2 + (F.get(grid, i + width) - F.get(grid, i)) ** 2))


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation clamped to [0, 1]; of flat arrays 1 if they are equal, else 0. One pass over both arrays."""
    names = ("n", "x", "y", "xx", "yy", "xy", "same")
    zero = F.struct(*[F.lit(1.0 if k == "same" else 0.0).alias(k) for k in names])
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))

    def add(m: Column, p: Column) -> Column:
        x, y = p["x"], p["y"]
        more = {"n": F.lit(1.0), "x": x, "y": y, "xx": x * x, "yy": y * y, "xy": x * y}
        return F.struct(*[(m[k] + v).alias(k) for k, v in more.items()], F.when(x == y, m["same"]).otherwise(0.0).alias("same"))

    def done(m: Column) -> Column:
        vx, vy, both = (m[k] / m["n"] - m[i] * m[j] / (m["n"] * m["n"]) for k, i, j in (("xx", "x", "x"), ("yy", "y", "y"), ("xy", "x", "y")))
        under = F.sqrt(F.greatest(vx, F.lit(0.0)) * F.greatest(vy, F.lit(0.0)))
        return F.when(under <= 1e-14, m["same"]).otherwise(F.least(F.greatest(both / under, F.lit(0.0)), F.lit(1.0)))

    return F.aggregate(pairs, zero, add, done)
