"""Exact quantiles, medians and mid-ranks that never gather a group in one task.

Equal values are first collapsed to (value, count). The distinct values are then cut into
ranges of about equal size by Spark's range partitioning, which samples the data, so neither
a large group nor a dense stretch of values lands in one task. One row per range tells how many
rows lie before it; only what a result needs is sorted within its range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _long(
    df: DataFrame, cols: Sequence[str], by: Sequence[str], weight: str | None
) -> DataFrame:
    """(by..., metric, value, _w) without missing groups and values."""
    times = (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_w")
    if len(cols) == 1:
        value = F.col(cols[0]).cast("double").alias("value")
        long = df.select(*by, times, F.lit(cols[0]).alias("metric"), value)
    else:
        pairs = F.array(
            *[
                F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                for c in cols
            ]
        )
        long = df.select(*by, times, F.inline(pairs))
    return long.dropna(subset=[*by, "value"])


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    closed_domain: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles as rows (by..., metric, p, value).

    ``weight`` names a column that tells how many rows a row stands for.
    ``closed_domain`` says that the columns hold a short closed list of values (a 1..5
    score, a 0/1 flag); then the built-in ``percentile``, which keeps one counter per
    distinct value, is the cheaper plan.
    """
    keys = [*by, "metric"]
    long = _long(df, cols, by, weight)
    if closed_domain:
        values = F.percentile("value", F.array(*[F.lit(p) for p in probs]), F.col("_w"))
        return (
            long.groupBy(*keys)
            .agg(values.alias("_values"))
            .select(
                *keys,
                F.inline(
                    F.arrays_zip(
                        F.array(*[F.lit(p) for p in probs]).alias("p"),
                        F.col("_values").alias("value"),
                    )
                ),
            )
            .toDF(*keys, "p", "value")
        )

    counts = long.groupBy(*keys, "value").agg(F.sum("_w").alias("_n"))
    ranges = (
        counts.repartitionByRange(*keys, "value")
        .withColumn("_range", F.spark_partition_id())
        .groupBy(*keys, "_range")
        .agg(
            F.sum("_n").alias("_range_n"),
            F.min("value").alias("_from"),
            F.max("value").alias("_to"),
        )
    )
    ordered = Window.partitionBy(*keys).orderBy("_range")
    placed = ranges.withColumn(
        "_before", F.sum("_range_n").over(ordered) - F.col("_range_n")
    ).withColumn("_total", F.sum("_range_n").over(Window.partitionBy(*keys)))
    wanted = F.transform(
        F.array(*[F.lit(float(p)) for p in probs]),
        lambda p: F.struct(p.alias("p"), (p * (F.col("_total") - 1)).alias("position")),
    )
    here = F.filter(
        wanted,
        lambda w: (F.ceil(w["position"]) >= F.col("_before"))
        & (F.floor(w["position"]) < F.col("_before") + F.col("_range_n")),
    )
    targets = (
        placed.withColumn("_wanted", here)
        .filter(F.size("_wanted") > 0)
        .select(*keys, "_from", "_to", "_before", "_wanted")
    )
    # at most two ranges per metric, probability and group: without groups, or with boolean
    # ones, that is a fixed number of rows, and the counts need no further shuffle
    if all(df.schema[c].dataType.typeName() == "boolean" for c in by):
        targets = F.broadcast(targets)
    inside = Window.partitionBy(*keys, "_from").orderBy("value")
    end = F.col("_before") + F.sum("_n").over(inside)
    hits = (
        counts.join(targets, keys)
        .filter(F.col("value").between(F.col("_from"), F.col("_to")))
        .withColumn("_end", end)
        .withColumn("_w", F.explode("_wanted"))
        .select(
            *keys,
            F.col("_w.p").alias("p"),
            F.col("_w.position").alias("_position"),
            (F.col("_end") - F.col("_n")).alias("_start"),
            "_end",
            "value",
        )
    )

    def value_at(position: Column) -> Column:
        return F.max(
            F.when((position >= F.col("_start")) & (position < F.col("_end")), F.col("value"))
        )

    position = F.col("_position")
    return (
        hits.groupBy(*keys, "p")
        .agg(
            F.max(position - F.floor(position)).alias("_frac"),
            value_at(F.floor(position)).alias("_low"),
            value_at(F.ceil(position)).alias("_high"),
        )
        .select(
            *keys,
            "p",
            (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_frac")).alias("value"),
        )
    )


def quantiles_wide(
    df: DataFrame,
    wanted: Mapping[str, tuple[str, float]],
    by: Sequence[str] = (),
    closed_domain: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """One row per group with a named column for each wanted (column, probability)."""
    cols = sorted({c for c, _ in wanted.values()})
    probs = sorted({p for _, p in wanted.values()})
    long = quantiles(df, cols, probs, by, closed_domain, weight)
    picks = [
        F.max(F.when((F.col("metric") == c) & (F.col("p") == F.lit(float(p))), F.col("value")))
        .alias(name)
        for name, (c, p) in wanted.items()
    ]
    return long.groupBy(*by).agg(*picks)


def median_of(
    df: DataFrame,
    cols: Sequence[str],
    by: Sequence[str] = (),
    closed_domain: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Exact medians, one row per group, under the names of the columns."""
    return quantiles_wide(df, {c: (c, 0.5) for c in cols}, by, closed_domain, weight)


def scalar_row(one_row: DataFrame) -> Column:
    """A one-row table as a struct column: a scalar subquery, so no join is planned.

    Add it as a column once and read its fields from there; every further use of the
    expression itself would be planned as a subquery of its own.
    """
    return one_row.select(F.struct(*one_row.columns).alias("row")).scalar()


def fill_median(df: DataFrame, cols: Sequence[str], closed_domain: bool = False) -> DataFrame:
    """Replace missing values by the median of their column."""
    medians = scalar_row(median_of(df, cols, closed_domain=closed_domain))
    return (
        df.withColumn("_medians", medians)
        .withColumns({c: F.coalesce(F.col(c), F.col("_medians")[c]) for c in cols})
        .drop("_medians")
    )


def rank_sums(
    df: DataFrame,
    first: Column,
    value: Column,
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Rank-sum ingredients of two samples pooled by value.

    ``first`` is true for rows of sample 1, false for sample 2 and NULL for rows in neither.
    Gives n1, n2, the sum of tie-averaged ranks of sample 1 and the tie term sum(t^3 - t).
    """
    times = (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_w")
    counts = (
        df.select(*by, times, first.alias("_first"), value.cast("double").alias("_value"))
        .dropna(subset=[*by, "_first", "_value"])
        .groupBy(*by, "_value")
        .agg(
            F.sum("_w").alias("_n"),
            F.sum(F.when(F.col("_first"), F.col("_w")).otherwise(0)).alias("_n1"),
        )
    )
    ranged = counts.repartitionByRange(*by, "_value").withColumn(
        "_range", F.spark_partition_id()
    )
    inside = Window.partitionBy(*by, "_range").orderBy("_value")
    ranked = ranged.withColumn("_before", F.sum("_n").over(inside) - F.col("_n"))
    n = F.col("_n").cast("double")
    n1 = F.col("_n1").cast("double")
    ranges = ranked.groupBy(*by, "_range").agg(
        F.sum("_n").alias("_n"),
        F.sum("_n1").alias("_n1"),
        F.sum(n1 * (F.col("_before") + (n + F.lit(1.0)) / F.lit(2.0))).alias("_local"),
        F.sum(n * n * n - n).alias("_ties"),
    )
    # one row per range from here on, at most one per shuffle partition
    below = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range")
    offset = (F.sum("_n").over(below) - F.col("_n")).cast("double")
    return (
        ranges.withColumn("_rank", F.col("_local") + F.col("_n1") * offset)
        .groupBy(*by)
        .agg(
            F.sum("_n1").alias("n1"),
            (F.sum("_n") - F.sum("_n1")).alias("n2"),
            F.sum("_rank").alias("rank_sum"),
            F.sum("_ties").alias("ties"),
        )
    )
