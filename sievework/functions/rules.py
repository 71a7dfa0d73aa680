"""Ordered rules and guarded arithmetic as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = list[tuple[str, Column]]


def first_failing(rules: Rules) -> Column:
    """Name of the first rule whose condition holds; null if none does. A null condition does not hold."""
    return F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in rules])


def all_failing(rules: Rules) -> Column:
    """Names of all rules whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in rules]))


def valid_number(x: Column) -> Column:
    """Whether ``x`` reads as a finite number."""
    y = x.try_cast("double")
    return F.coalesce(y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")), F.lit(False))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def safe_ratio(num: Column, den: Column, floor: float) -> Column:
    return num / F.greatest(den, F.lit(floor))


def close_to(x: Column, expected: float, tolerance: float = 1e-12) -> Column:
    """Equality of numbers within a tolerance; anything else is not close."""
    return F.coalesce(valid_number(x) & (F.abs(x.try_cast("double") - expected) <= tolerance), F.lit(False))


def closeness_to_one(ratio: Column, widest: float = 2.5) -> Column:
    """1 at a ratio of 1, falling with the logarithm to 0 at ``widest`` and its inverse."""
    return clamp(1 - F.abs(F.log(F.greatest(ratio, F.lit(1e-6)))) / F.log(F.lit(widest)), 0.0, 1.0)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Null without rows or with no positive weight."""
    total = F.sum(weight)
    return F.when(total > 0, F.sum(value * weight) / total)


def weighted_sum(parts: list[tuple[Column, float]]) -> Column:
    return reduce(lambda a, b: a + b, [c * w for c, w in parts])
