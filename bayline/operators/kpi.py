"""KPI summaries, scorecards, distributions and tables of counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.operators.quantiles import median_of
from bayline.sources.sinks import stage

# fixed values: labels of the overall summary
OVERALL_METRICS = (
    "Total Visits",
    "Delayed Visits",
    "Delay Rate",
    "Average Delay Hours",
    "Median Delay Hours",
    "Average CSAT",
    "Complaint Rate",
)
# fixed value: hours from which a delay is severe in the KPI catalogue
SEVERE_DELAY_HOURS = 4


def kpi_overall(visits: DataFrame) -> DataFrame:
    """Overall KPIs as rows (metric, value)."""
    late = F.col("delayed").cast("int")
    median = median_of(visits, ["delay_hours"]).scalar()
    one = visits.agg(
        F.count(F.lit(1)).cast("double").alias("total"),
        F.sum(late).cast("double").alias("late"),
        F.avg(late).alias("late_rate"),
        F.avg("delay_hours").alias("delay"),
        F.avg("csat_score").alias("csat"),
        F.avg("complaint_flag").alias("complaints"),
    ).withColumn("median", median)
    values = ("total", "late", "late_rate", "delay", "median", "csat", "complaints")
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("metric"), F.col(v).alias("value"))
            for label, v in zip(OVERALL_METRICS, values, strict=True)
        ]
    )
    return one.select(F.inline(rows))


def kpi_scorecard(visits: DataFrame, by: str | Sequence[str]) -> DataFrame:
    keys = [by] if isinstance(by, str) else list(by)
    return (
        visits.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count("visit_id").alias("visits"),
            F.avg(F.col("delayed").cast("int")).alias("delay_rate"),
            F.avg("delay_hours").alias("avg_delay_hours"),
            F.avg("csat_score").alias("avg_csat"),
            F.avg("complaint_flag").alias("complaint_rate"),
        )
    )


def distribution(df: DataFrame, col: str, domain: Sequence[str]) -> DataFrame:
    """Rows and percent of all rows for each listed category, also the empty ones."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("visits"))
    total = counts.agg(F.sum("visits")).scalar()
    wanted = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(label) for label in domain])).alias(col)
    )
    visits = F.coalesce("visits", F.lit(0))
    return wanted.join(counts, col, "left").select(
        col,
        visits.alias("visits"),
        F.try_divide(visits * 100.0, total.cast("double")).alias("percentage"),
    )


def rate_by(df: DataFrame, by: str, col: str) -> DataFrame:
    """Mean of a 0/1 flag and rows with the flag present, per group."""
    return df.groupBy(by).agg(F.avg(col).alias("rate"), F.count(col).alias("visits"))


def summary_by(df: DataFrame, by: str, col: str) -> DataFrame:
    """Count, mean and exact median of a column per group.

    Mean and median both read one staged table of (group, value, count).
    """
    counts = stage(
        df.select(by, F.col(col).cast("double").alias("_x"))
        .filter(F.col(by).isNotNull())
        .groupBy(by, "_x")
        .agg(F.count("_x").alias("_n")),
        "summary_counts",
    )
    means = counts.groupBy(by).agg(
        F.sum("_n").alias("visits"),
        F.try_divide(F.sum(F.col("_x") * F.col("_n")), F.sum("_n")).alias("average"),
    )
    medians = median_of(counts, ["_x"], [by], weight="_n").withColumnRenamed("_x", "median")
    return means.join(medians, by, "left")


def frequency(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Rows per value, and the share of all rows with a value if wanted."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total.cast("double"))


def cell_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of the pairs of levels that occur, without the rows that lack one."""
    return df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts for the full grid of the levels of two columns, long form.

    ``b`` has few levels, ``a`` may have any number: a level of ``a`` gathers its own cells, and its empty ones
    are filled in from the list of all levels of ``b``, which is one row.
    """
    cells = cell_counts(df, a, b)
    levels = cells.agg(F.array_sort(F.collect_set(b))).scalar()
    own = cells.groupBy(a).agg(F.map_from_entries(F.collect_list(F.struct(b, "n"))).alias("_own"))
    grid = own.withColumn("_levels", levels).select(a, "_own", F.explode("_levels").alias(b))
    return grid.select(a, b, F.coalesce(F.try_element_at("_own", F.col(b)), F.lit(0)).alias("n"))


def contingency_wide(df: DataFrame, a: str, b: str, domain: Sequence) -> DataFrame:
    """Counts with one column per listed level of ``b``."""
    return df.dropna(subset=[a, b]).groupBy(a).pivot(b, list(domain)).agg(F.count(F.lit(1))).fillna(0)


def n_unique(df: DataFrame, cols: Sequence[str], approx_rsd: float | None = None) -> DataFrame:
    """Distinct values per column as rows (column, unique_count); missing values not counted.

    With ``approx_rsd`` a fixed-size sketch replaces the exact count.
    """
    def counted(c: str) -> Column:
        if approx_rsd is None:
            return F.count_distinct(F.col(c)).alias(c)
        return F.approx_count_distinct(F.col(c), approx_rsd).alias(c)

    return df.agg(*[counted(c) for c in cols]).unpivot([], list(cols), "column", "unique_count")


def labels(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct().orderBy(col)


def spread(df: DataFrame, by: str, col: str) -> DataFrame:
    """Sample variance and standard deviation per group."""
    return df.groupBy(by).agg(
        F.count(col).alias("n"), F.var_samp(col).alias("variance"), F.stddev_samp(col).alias("sd")
    )


def band_summary(scored: DataFrame, by: str = "risk_band") -> DataFrame:
    """Rows, actual rate and mean probability of each band that occurs."""
    return (
        scored.dropna(subset=[by])
        .groupBy(by)
        .agg(
            F.count("predicted_delayed").alias("visits"),
            F.avg("actual_delayed").alias("actual_delay_rate"),
            F.avg("delay_probability").alias("avg_predicted_probability"),
        )
    )


def group_summary(experiment: DataFrame, by: str = "experiment_group") -> DataFrame:
    """Readout per experiment group; ``customers`` counts rows."""
    return experiment.groupBy(by).agg(
        F.count(by).alias("customers"),
        F.avg("final_delay_flag").alias("delay_rate"),
        F.avg("csat_score").alias("avg_csat"),
        F.avg("complaint_flag").alias("complaint_rate"),
    )


def share_of_total(df: DataFrame, col: str, scale: float = 1.0) -> Column:
    """Share of a column in its total, for tables of result size."""
    everything = Window.partitionBy(F.lit(0))
    return F.col(col) * F.lit(scale) / F.sum(col).over(everything)


def segment_profile(customers: DataFrame, by: str = "segment") -> DataFrame:
    """Means of the customer features per segment and the share of customers."""
    means = customers.groupBy(by).agg(
        F.count("customer_id").alias("customers"),
        F.avg("total_visits").alias("avg_visits"),
        F.avg("avg_delay_hours").alias("avg_delay_hours"),
        F.avg("delay_rate").alias("delay_rate"),
        F.avg("avg_csat").alias("avg_csat"),
        F.avg("complaint_rate").alias("complaint_rate"),
    )
    return means.withColumn("customer_share", share_of_total(means, "customers"))


def cluster_profile(customers: DataFrame, by: str = "cluster_id") -> DataFrame:
    """Means of the clustering features per cluster and the percent of customers."""
    means = customers.groupBy(by).agg(
        F.count("customer_id").alias("customers"),
        F.avg("visit_count").alias("avg_visits"),
        F.avg("unique_vehicles").alias("avg_unique_vehicles"),
        F.avg("avg_delay_hours").alias("avg_delay_hours"),
        F.avg("delay_rate").alias("delay_rate"),
        F.avg("avg_csat").alias("avg_csat"),
        F.avg("complaint_rate").alias("complaint_rate"),
        F.avg("service_type_count").alias("avg_service_types"),
        F.avg("recency_days").alias("avg_recency_days"),
    )
    return means.withColumn("customer_percentage", share_of_total(means, "customers", 100.0))


def kpi_cube(fact: DataFrame, dims: Sequence[str], how: str = "cube") -> DataFrame:
    """The KPI catalogue for every combination of the dimensions.

    ``grouping_level`` tells a subtotal row from a row whose dimension is missing. Customers
    are counted from rows reduced to one per customer and finest group; ``dims`` are
    low-cardinality report dimensions.
    """
    grouped = {"cube": DataFrame.cube, "rollup": DataFrame.rollup, "group": DataFrame.groupBy}[how]
    finest = fact.groupBy(*dims, "customer_id").agg(
        F.count("visit_id").alias("_n"),
        F.sum(F.col("delayed_visit").cast("bigint")).alias("_late"),
        F.sum(F.col("severe_delay").cast("bigint")).alias("_severe"),
        F.sum(F.col("first_time_fix").cast("bigint")).alias("_fixed"),
        F.sum("delay_hours").alias("_delay"),
        F.count("delay_hours").alias("_delay_n"),
        F.sum("csat_score").alias("_csat"),
        F.count("csat_score").alias("_csat_n"),
        F.sum(F.col("complaint_flag").cast("bigint")).alias("_complaints"),
        F.count("complaint_flag").alias("_complaints_n"),
    )
    visits = F.sum("_n")
    unique = F.count_distinct("customer_id")

    def over(total: str, n: str) -> Column:
        return F.try_divide(F.sum(total).cast("double"), F.sum(n).cast("double"))

    level = [] if how == "group" else [F.grouping_id().alias("grouping_level")]
    return grouped(finest, *dims).agg(
        *level,
        visits.alias("total_visits"),
        F.sum("_late").alias("delayed_visits"),
        over("_late", "_n").alias("delay_rate"),
        over("_delay", "_delay_n").alias("avg_delay_hours"),
        over("_csat", "_csat_n").alias("avg_csat"),
        over("_complaints", "_complaints_n").alias("complaint_rate"),
        over("_fixed", "_n").alias("first_time_fix_rate"),
        unique.alias("unique_customers"),
        F.try_divide(visits.cast("double"), unique.cast("double")).alias("visits_per_customer"),
        F.sum("_severe").alias("severe_delays"),
    )
