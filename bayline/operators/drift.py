"""Drift between an older and a newer sample: Kolmogorov-Smirnov distance and population stability.

A row belongs to the newer sample where ``newer`` is true, to the older one where it is false, to
neither where it is NULL. Values are collapsed to counts before anything is sorted; the distinct
values are cut into ranges by Spark's range partitioning, and one row per range is what the
ranges tell each other. An empty sample gives NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.operators.quantiles import quantiles_wide, scalar_row

SERIES_TERMS = 100
#: Below this the Kolmogorov distribution is zero to more digits than a double has.
SERIES_FROM = 0.2
BINS = 10
#: Share that an empty bin counts as.
LEAST_SHARE = 1e-4
# fixed values: usual limits of the population stability index
MODERATE, LARGE = 0.1, 0.25


def ks_p_value(distance: Column, n_old: Column, n_new: Column) -> Column:
    """Asymptotic two-sided p-value of a Kolmogorov-Smirnov distance."""
    size = F.sqrt(n_old.cast("double") * n_new / (n_old + n_new))
    x = size * distance
    terms = F.sequence(F.lit(1), F.lit(SERIES_TERMS))

    def term(total: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        return total + sign * F.exp(F.lit(-2.0) * k * k * x * x)

    tail = F.lit(2.0) * F.aggregate(terms, F.lit(0.0), term)
    return F.when(x < SERIES_FROM, 1.0).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))


def _long(df: DataFrame, newer: Column, cols: Sequence[str], kind: str) -> DataFrame:
    """(newer, metric, value) with missing values kept."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast(kind).alias("value")) for c in cols]
    return df.select(newer.alias("newer"), F.inline(F.array(*pairs))).filter(F.col("newer").isNotNull())


def _sizes() -> list[Column]:
    return [F.count_if(~F.col("newer")).alias("n_old"), F.count_if(F.col("newer")).alias("n_new")]


def ks_distance(df: DataFrame, newer: Column, cols: Sequence[str]) -> DataFrame:
    """metric, n_old, n_new, ks, ks_p: the largest gap between the two distribution functions.

    Within a range the gap is a running difference; what lies before the range shifts all of it
    by one number, so the largest and the smallest gap of a range are enough.
    """
    counts = _long(df, newer, cols, "double").dropna(subset=["value"]).groupBy("metric", "value").agg(*_sizes())
    totals = counts.groupBy("metric").agg(F.sum("n_old").alias("all_old"), F.sum("n_new").alias("all_new"))
    ranged = counts.repartitionByRange("metric", "value").withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("metric", "_range").orderBy("value")
    gap = F.try_divide(F.sum("n_old").over(inside), F.col("all_old")) - F.try_divide(F.sum("n_new").over(inside), F.col("all_new"))
    local = ranged.join(totals, "metric").withColumn("_gap", gap)
    ranges = local.groupBy("metric", "_range", "all_old", "all_new").agg(
        F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"), F.max("_gap").alias("_high"), F.min("_gap").alias("_low")
    )
    # one row per metric and range from here on
    below = Window.partitionBy("metric").orderBy("_range")
    before = F.try_divide(F.sum("n_old").over(below) - F.col("n_old"), F.col("all_old")) - F.try_divide(
        F.sum("n_new").over(below) - F.col("n_new"), F.col("all_new")
    )
    placed = ranges.withColumn("_before", before)
    largest = F.max(F.greatest(F.abs(F.col("_before") + F.col("_high")), F.abs(F.col("_before") + F.col("_low"))))
    found = placed.groupBy("metric").agg(
        F.max("all_old").alias("n_old"), F.max("all_new").alias("n_new"), largest.alias("ks")
    )
    return found.withColumn("ks_p", ks_p_value(F.col("ks"), F.col("n_old"), F.col("n_new")))


def _stability(counts: DataFrame) -> DataFrame:
    """metric, bin, n_old, n_new -> metric, psi."""
    totals = counts.groupBy("metric").agg(F.sum("n_old").alias("all_old"), F.sum("n_new").alias("all_new"))
    old, new = (F.greatest(F.try_divide(F.col(f"n_{s}"), F.col(f"all_{s}")), F.lit(LEAST_SHARE)) for s in ("old", "new"))
    both = (F.col("all_old") > 0) & (F.col("all_new") > 0)
    term = F.when(both, (new - old) * F.log(new / old))
    return counts.join(totals, "metric").groupBy("metric").agg(F.sum(term).alias("psi"))


def stability(df: DataFrame, newer: Column, cols: Sequence[str], bins: int = BINS) -> DataFrame:
    """metric, psi over bins cut at the quantiles of the older sample; missing values are a bin.

    A value equal to a cut belongs below it; equal cuts are one.
    """
    probs = [i / bins for i in range(1, bins)]
    older = df.filter(~newer).select(*cols)
    wide = quantiles_wide(older, {f"{c}:{p}": (c, p) for c in cols for p in probs})
    cuts = wide.select(*[F.array_compact(F.array(*[F.col(f"`{c}:{p}`") for p in probs])).alias(f"cuts_{i}") for i, c in enumerate(cols)])
    rows = df.withColumn("_cuts", scalar_row(cuts))

    def bin_of(i: int, column: str) -> Column:
        below = F.size(F.filter(F.col("_cuts")[f"cuts_{i}"], lambda cut: cut < F.col(column)))
        return F.when(F.col(column).isNull(), -1).otherwise(F.coalesce(below, F.lit(0)))

    binned = rows.select(newer.alias("newer"), *[bin_of(i, c).alias(c) for i, c in enumerate(cols)])
    return _stability(_long(binned, F.col("newer"), cols, "int").groupBy("metric", "value").agg(*_sizes()))


def label_stability(df: DataFrame, newer: Column, cols: Sequence[str]) -> DataFrame:
    """metric, psi over the values of columns with a short closed list of labels; missing is one."""
    return _stability(_long(df, newer, cols, "string").groupBy("metric", "value").agg(*_sizes()))


def drift(df: DataFrame, newer: Column, numbers: Sequence[str], labels: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """A row for each column: sizes, distance with p-value (numbers only), stability and its grade."""
    found = ks_distance(df, newer, numbers).join(stability(df, newer, numbers, bins), "metric", "full")
    if labels:
        sizes = _long(df, newer, labels, "string").dropna(subset=["value"]).groupBy("metric").agg(*_sizes())
        named = label_stability(df, newer, labels).join(sizes, "metric", "left")
        found = found.unionByName(named, allowMissingColumns=True)
    psi = F.col("psi")
    grade = F.when(psi < MODERATE, "stable").when(psi < LARGE, "moderate").when(psi >= LARGE, "large")
    return found.withColumn("shift", grade)
