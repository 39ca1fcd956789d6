"""Hypothesis tests, effect sizes and chart data.

Every test reduces the rows to a table of result size in one distributed aggregation; the
closed forms then run on that table.
"""

from __future__ import annotations

from collections.abc import Mapping
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.functions.flags import is_true
from bayline.functions.noncentral import let, t_test_size
from bayline.functions.ranktest import u_two_sided
from bayline.functions.special import chi_square_sf, normal_two_sided
from bayline.operators.kpi import cell_counts
from bayline.operators.quantiles import median_of, quantiles_wide, rank_sums, scalar_row
from bayline.sources.sinks import stage

# fixed values: level of the tests, power and smallest effect of the sample size
ALPHA = 0.05
POWER = 0.80
MIN_EFFECT = 0.01
#: Rows of the smaller and of the larger sample up to which a rank test without ties is exact.
EXACT_UP_TO = (8, 200)


def significant(p: Column, alpha: float = ALPHA) -> Column:
    """An undefined p-value is not significant."""
    return is_true(p < alpha)


def mann_whitney(
    df: DataFrame,
    group: str,
    value: str,
    first,
    second,
    closed_domain: bool = False,
    exact_up_to: tuple[int, int] = EXACT_UP_TO,
) -> DataFrame:
    """Two-sided Mann-Whitney test of the values of two groups, one row.

    U belongs to the first group. Tie-averaged ranks, tie-corrected normal approximation
    with continuity correction; NULL where the variance is zero or a group is empty. Without ties, and
    with samples of at most ``exact_up_to`` rows (the smaller and the larger one), the p-value is exact.
    """
    g = F.col(group)
    is_first = F.when(g == F.lit(first), F.lit(True)).when(g == F.lit(second), F.lit(False))
    # ranks and medians both read this one table of counts, so the rows are read once
    counts = stage(
        df.select(is_first.alias("_first"), F.col(value).cast("double").alias("_value"))
        .dropna()
        .groupBy("_first", "_value")
        .agg(F.count(F.lit(1)).alias("_count")),
        "rank_counts",
    )
    sums = rank_sums(counts, F.col("_first"), F.col("_value"), weight="_count")
    by_group = median_of(counts, ["_value"], ["_first"], closed_domain, weight="_count")
    medians = scalar_row(
        by_group.agg(
            F.max(F.when(F.col("_first"), F.col("_value"))).alias("m1"),
            F.max(F.when(~F.col("_first"), F.col("_value"))).alias("m2"),
        )
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    pairs = n1 * n2
    total = n1 + n2
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    variance = pairs / 12 * ((total + 1) - F.try_divide(F.col("ties"), total * (total - 1)))
    z = F.try_divide(
        F.greatest(u, pairs - u) - pairs / 2 - F.lit(0.5),
        F.when(variance > 0, F.sqrt(variance)),
    )
    smaller, larger = exact_up_to
    small = (F.col("ties") == 0) & (pairs > 0) & (F.least(n1, n2) <= smaller) & (F.greatest(n1, n2) <= larger)
    return (
        sums.withColumns({"u_statistic": u, "z_statistic": z})
        .withColumn("p_value", F.when(small, u_two_sided(u, n1, n2)).otherwise(_upper_tail_twice(F.col("z_statistic"))))
        .withColumn("significant_at_0_05", significant(F.col("p_value")))
        .withColumn("_m", medians)
        .select(
            "n1",
            "n2",
            F.col("_m.m1").alias("median_1"),
            F.col("_m.m2").alias("median_2"),
            "u_statistic",
            "z_statistic",
            "p_value",
            "significant_at_0_05",
        )
    )


def _upper_tail_twice(z: Column) -> Column:
    """min(1, 2 sf(z)); z is at least -0.5/sd, so a negative one means p = 1."""
    return F.when(z < 0, F.lit(1.0)).otherwise(normal_two_sided(z))


def chi_square(df: DataFrame, a: str, b: str, yates: bool = True) -> DataFrame:
    """Chi-square test of independence of two columns, one row.

    Yates' correction applies to one degree of freedom unless switched off. A table
    with a single row or column, or with an empty margin, gives NULL.
    """
    return chi_square_of(cell_counts(df, a, b), a, b, yates)


def chi_square_of(cells: DataFrame, a: str, b: str, yates: bool = True) -> DataFrame:
    """The same from counts (a, b, n), one row per cell; a cell that is not there is empty.

    The grid is not filled in: an empty cell adds its expected count, and all expected counts
    sum to the total. In a table of two by two, every cell is off by the same amount.
    """
    cells = stage(cells, "cells")
    total = cells.agg(F.sum("n").cast("double")).scalar()

    def margin(of: str, across: str) -> list[Column]:
        first = F.row_number().over(Window.partitionBy(of).orderBy(across)) == 1
        size = F.sum("n").over(Window.partitionBy(of)).cast("double")
        return [size, F.when(first, size)]

    row, row_once = margin(a, b)
    col, col_once = margin(b, a)
    table = cells.select(
        F.col("n").cast("double").alias("_n"),
        row.alias("_row"),
        row_once.alias("_row_once"),
        col.alias("_col"),
        col_once.alias("_col_once"),
        total.alias("_total"),
    ).withColumn("_expected", F.try_divide(F.col("_row") * F.col("_col"), F.col("_total")))
    gap = F.abs(F.col("_n") - F.col("_expected"))
    one = F.lit(1.0)
    sums = table.agg(
        F.sum(F.try_divide(gap * gap, F.col("_expected"))).alias("_observed"),
        F.max(gap).alias("_gap"),
        F.max("_total").alias("_total"),
        F.sum("_expected").alias("_covered"),
        F.count(one).alias("_cells"),
        F.count("_row_once").alias("_rows"),
        F.count("_col_once").alias("_cols"),
        F.sum(F.try_divide(one, F.col("_row_once"))).alias("_per_row"),
        F.sum(F.try_divide(one, F.col("_col_once"))).alias("_per_col"),
        # a zero margin makes the whole statistic undefined, not just its cell
        F.max(F.coalesce(F.col("_expected") == 0, F.lit(True))).alias("_empty"),
    )
    dof = (F.col("_rows") - 1) * (F.col("_cols") - 1)
    missing = F.when(F.col("_cells") == F.col("_rows") * F.col("_cols"), F.lit(0.0)).otherwise(
        F.col("_total") - F.col("_covered")
    )
    plain = F.col("_observed") + missing
    off = F.col("_gap") - F.least(F.lit(0.5), F.col("_gap"))
    corrected = off * off * F.col("_total") * F.col("_per_row") * F.col("_per_col")
    statistic = F.when(dof == 1, corrected).otherwise(plain) if yates else plain
    return (
        sums.select(
            F.when(~F.col("_empty") & (dof > 0), statistic).alias("chi_square"),
            F.when(F.col("_cells") > 0, dof).cast("int").alias("degrees_of_freedom"),
        )
        .withColumn("p_value", chi_square_sf(F.col("chi_square"), F.col("degrees_of_freedom")))
        .withColumn("significant_at_0_05", significant(F.col("p_value")))
        .select("chi_square", "degrees_of_freedom", "p_value", "significant_at_0_05")
    )


def sample_stats(df: DataFrame, group: str, value: str, first, second) -> DataFrame:
    """Count, sum, mean and sample variance of two groups in one row (suffix _1 and _2)."""
    aggs = []
    for suffix, level in (("1", first), ("2", second)):
        x = F.when(F.col(group) == F.lit(level), F.col(value).cast("double"))
        aggs += [
            F.count(x).alias(f"n_{suffix}"),
            F.sum(x).alias(f"sum_{suffix}"),
            F.avg(x).alias(f"mean_{suffix}"),
            F.var_samp(x).alias(f"var_{suffix}"),
        ]
    return df.agg(*aggs)


def lift(stats: DataFrame, control: str = "mean_1", treatment: str = "mean_2") -> DataFrame:
    """Absolute and relative (percent) difference of the treatment to the control."""
    gap = F.col(treatment) - F.col(control)
    return stats.withColumns(
        {
            "absolute_difference": gap,
            "relative_difference_percent": F.try_divide(gap * 100.0, F.col(control)),
        }
    )


def two_proportion_z(df: DataFrame, group: str, flag: str, treatment, control) -> DataFrame:
    """Pooled z-test of two rates, one row; NULL where the pooled variance is zero."""
    stats = sample_stats(df, group, flag, control, treatment)
    nc, nt = F.col("n_1").cast("double"), F.col("n_2").cast("double")
    pooled = F.try_divide(F.col("sum_1") + F.col("sum_2"), nc + nt)
    variance = pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), nc) + F.try_divide(F.lit(1.0), nt))
    z = F.try_divide(
        F.col("mean_2") - F.col("mean_1"), F.when(variance > 0, F.sqrt(variance))
    )
    return (
        lift(stats)
        .select(
            F.col("mean_1").alias("control_rate"),
            F.col("mean_2").alias("treatment_rate"),
            "absolute_difference",
            F.col("relative_difference_percent").alias("relative_change_percent"),
            z.alias("z_statistic"),
        )
        .withColumn("p_value", normal_two_sided(F.col("z_statistic")))
        .withColumn("significant_at_0_05", significant(F.col("p_value")))
    )


def cohens_d_of(stats: DataFrame) -> Column:
    """Effect size from a row of ``sample_stats`` (1 control, 2 treatment)."""
    nc, nt = F.col("n_1"), F.col("n_2")
    pooled = F.try_divide(
        (nc - 1) * F.col("var_1") + (nt - 1) * F.col("var_2"), (nc + nt - 2).cast("double")
    )
    return F.try_divide(
        F.col("mean_2") - F.col("mean_1"), F.when(pooled > 0, F.sqrt(pooled))
    )


def cohens_d(df: DataFrame, group: str, value: str, treatment, control) -> DataFrame:
    stats = sample_stats(df, group, value, control, treatment)
    return stats.select(cohens_d_of(stats).alias("cohens_d"))


def sample_size(
    df: DataFrame,
    group: str,
    value: str,
    treatment,
    control,
    alpha: float = ALPHA,
    power: float = POWER,
    exact: bool = False,
) -> DataFrame:
    """Rows needed per group for the observed effect, as rows (parameter, value).

    Normal approximation 2 ((z_alpha/2 + z_power) / d)^2 with the effect floored; ``exact`` solves the power
    of the t-test instead, which takes some seconds and gives up to one row more for usual effects.
    """
    quantile = NormalDist().inv_cdf
    factor = 2.0 * (quantile(1 - alpha / 2) + quantile(power)) ** 2
    stats = sample_stats(df, group, value, control, treatment)
    effect = F.abs(cohens_d_of(stats))
    floored = F.greatest(effect, F.lit(MIN_EFFECT))
    needed = F.lit(factor) / (floored * floored)
    if exact:
        needed = let(floored, lambda d: t_test_size(d, alpha, power))
    needed = F.when(effect.isNotNull(), needed)
    rows = [
        ("Observed Cohen's d", effect),
        ("Alpha", F.lit(alpha)),
        ("Desired Power", F.lit(power)),
        ("Required Sample Size Per Group", needed),
        ("Actual Control Size", F.col("n_1").cast("double")),
        ("Actual Treatment Size", F.col("n_2").cast("double")),
    ]
    return stats.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(k).alias("parameter"), v.alias("value")) for k, v in rows]
            )
        )
    )


# fixed values: texts of the decision table, (metric, text if significant, text if not)
DECISION_TEXTS = (
    (
        "Primary — CSAT",
        "Statistically significant difference in CSAT between treatment and control.",
        "No statistically significant difference in CSAT was detected.",
    ),
    (
        "Secondary — Delay",
        "Statistically significant difference in delay rate.",
        "No statistically significant difference in delay rate was detected.",
    ),
    (
        "Secondary — Complaint",
        "Statistically significant difference in complaint rate.",
        "No statistically significant difference in complaint rate was detected.",
    ),
)


def decisions(tests: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Verdict text per metric from rows (metric, p_value)."""
    result = None
    for metric, yes, no in DECISION_TEXTS:
        text = F.when(significant(F.col("p_value"), alpha), F.lit(yes)).otherwise(F.lit(no))
        case = F.col("metric") == metric
        result = F.when(case, text) if result is None else result.when(case, text)
    return tests.select("metric", result.alias("result"), "p_value")


def box_stats(
    df: DataFrame, group: str, value: str, closed_domain: bool = False
) -> DataFrame:
    """Box-plot numbers per group: quartiles, extremes and whiskers within 1.5 IQR."""
    quartiles = quantiles_wide(
        df,
        {"q1": (value, 0.25), "median": (value, 0.5), "q3": (value, 0.75)},
        [group],
        closed_domain,
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    x = F.col(value)
    # distinct values are enough for extremes and whiskers and make hot groups small
    values = df.select(group, value).dropna().distinct()
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    edges = (
        values.join(quartiles, group)
        .groupBy(group)
        .agg(
            F.min(x).alias("minimum"),
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.max(x).alias("maximum"),
        )
    )
    return edges.join(quartiles, group).select(
        group, "minimum", "whisker_low", "q1", "median", "q3", "whisker_high", "maximum"
    )


def tests_table(tests: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (metric, p_value) from one-row test results."""
    frames = [
        df.select(F.lit(metric).alias("metric"), "p_value") for metric, df in tests.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
