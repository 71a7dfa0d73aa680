"""Exact percentiles of groups of any size, by repeated narrowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import broadcast_if_small, materialize

#: Binary digits of a value that one round tells apart, so also the logarithm of the rows that a histogram, or the last
#: round over single values, has for each wanted rank.
DIGITS = 16
_TOP = (1 << 63) - 1


def sortable(value: Column) -> Column:
    """A whole number of 64 bits for each double, in the same order (NaN last); both zeros are one."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(_TOP))).otherwise(bits)


def unsortable(number: Column) -> Column:
    """The double of such a number."""
    bits = F.when(number < 0, number.bitwiseXOR(F.lit(_TOP))).otherwise(number)
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def _same(left: DataFrame, by: list[str], names: list[str]) -> Column:
    on = F.lit(True)
    for b, n in zip(by, names, strict=True):
        on &= left[b].eqNullSafe(F.col(n))
    return on


def _narrowed(keys: DataFrame, wanted: DataFrame, by: list[str], taken: int, digits: int) -> DataFrame:
    """The wanted ranks with ``digits`` binary digits more of the value that has them, after ``taken``.

    ``wanted``: the group, ``goal`` (the rank asked for), ``prefix`` (the value's first ``taken`` digits), ``rank``
    (within the values that begin so) and ``n`` (how many these are). Counts are summed within tasks first, so a group
    sends no more rows than its histogram has.
    """
    shift = 64 - taken - digits
    cut = lambda n: F.shiftright("key", n) if n < 64 else F.lit(0).cast("long")
    names = [f"_by{i}" for i in range(len(by))]
    open_ = broadcast_if_small(wanted.select(*[F.col(b).alias(n) for b, n in zip(by, names, strict=True)], "prefix").distinct())
    inside = keys.join(open_, _same(keys, by, names) & (cut(64 - taken) == F.col("prefix")), "left_semi")
    counts = inside.groupBy(*by, cut(64 - taken).alias("_prefix"), cut(shift).alias("next")).agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*by, "_prefix").orderBy("next")
    spans = counts.withColumn("_upto", F.sum("_n").over(running)).withColumnsRenamed(dict(zip(by, names, strict=True)))
    hit = _same(wanted, by, names) & (F.col("prefix") == F.col("_prefix")) & (F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_n"))
    found = wanted.join(spans, hit)
    return found.select(*by, "goal", F.col("next").alias("prefix"), (F.col("rank") - F.col("_upto") + F.col("_n")).alias("rank"), F.col("_n").alias("n"))


def exact_percentiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float], digits: int = DIGITS) -> DataFrame:
    """One row per group: its keys and, under each name of ``shares``, that share's percentile of ``value``.

    The percentile lies between the two values next to it in order, as Spark's own ``percentile`` has it, which keeps
    every different value of a group in one task. Here a round counts the values by their next ``digits`` binary digits
    and keeps those that begin as the wanted one does; once no more than two to the power of ``digits`` are left of
    any, they are ordered one by one. No task or window holds more rows than that for a wanted rank, however large a
    group is, and four rounds of 16 digits end every case.

    Nulls do not count; a group without values has null percentiles. Null keys are a group of their own. NaN is the
    largest value. ``by`` may be empty: then all rows are one group. An empty table has no group.
    """
    if not by:
        return exact_percentiles(rows.withColumn("_all", F.lit(0)), ["_all"], value, shares, digits).drop("_all")
    groups = materialize(rows.groupBy(*by).agg(F.count(value).alias("_rows")), "percentile-groups")
    keys = materialize(rows.filter(F.col(value).isNotNull()).select(*by, sortable(F.col(value)).alias("key")), "percentile-keys")
    at = {name: (F.col("_rows") - 1) * F.lit(float(share)) for name, share in shares.items()}
    low, high = ({name: op(x).cast("long") for name, x in at.items()} for op in (F.floor, F.ceil))
    goal = F.explode(F.array_distinct(F.array(*low.values(), *high.values())))
    wanted = groups.filter("_rows > 0").select(*by, goal.alias("goal"), F.lit(0).cast("long").alias("prefix"), F.col("_rows").alias("n")).withColumn("rank", F.col("goal"))
    taken = 0
    while taken < 64:
        most = wanted.agg(F.max("n")).first()[0]  # null without any value
        step = 64 - taken if (most or 0) <= 1 << digits else min(digits, 64 - taken)
        wanted, taken = materialize(_narrowed(keys, wanted, by, taken, step), "percentile-round"), taken + step
    return _told(groups, wanted, by, {name: (low[name], high[name], at[name]) for name in shares})


def _told(groups: DataFrame, found: DataFrame, by: list[str], places: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Each group with its percentiles: a mean of two values, weighed by how near their ranks are."""
    names = [f"_by{i}" for i in range(len(by))]
    values = F.map_from_entries(F.collect_list(F.struct("goal", "value"))).alias("_values")  # two for each share at most
    found = found.withColumnsRenamed(dict(zip(by, names, strict=True))).withColumn("value", unsortable(F.col("prefix")))
    joined = groups.join(found.groupBy(*names).agg(values), _same(groups, by, names), "left")
    of = lambda rank: F.element_at("_values", rank)
    mean = lambda low, high, at: F.when(low == high, of(low)).otherwise((high - at) * of(low) + (at - low) * of(high))
    return joined.select(*by, *[mean(*place).alias(name) for name, place in places.items()])
