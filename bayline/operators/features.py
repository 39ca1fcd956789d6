"""Visit-level and customer-level feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.functions.flags import first_match, is_true, threshold_flag
from bayline.functions.scalars import days_between, finite_or_null
from bayline.operators.cleaning import LATE_PARTS_DAYS
from bayline.operators.joins import attach_agg, attach_optional, attach_parent
from bayline.operators.quantiles import fill_median

# fixed values: delay categories by hours, each bound belonging to the lower category
DELAY_CATEGORIES = ("On Time", "Minor Delay", "Moderate Delay", "Severe Delay")
DELAY_BOUNDS = (0, 4, 8)
UNKNOWN_DELAY = "Unknown"


def lead_time_days(booking: Column, appointment: Column) -> Column:
    return days_between(booking, appointment)


def delayed(delay_hours: Column) -> Column:
    """True for a positive delay; a missing delay counts as on time."""
    return is_true(delay_hours > 0)


def delay_category(delay_hours: Column) -> Column:
    *named, worst = DELAY_CATEGORIES
    cases = [(delay_hours <= bound, name) for bound, name in zip(DELAY_BOUNDS, named)]
    return first_match([*cases, (delay_hours > DELAY_BOUNDS[-1], worst)], UNKNOWN_DELAY)


def visit_base(
    visits: DataFrame,
    appointments: DataFrame,
    surveys: DataFrame,
    appointment_cols: Sequence[str] = ("customer_id", "booking_date", "appointment_date"),
    parts: DataFrame | None = None,
    date_col: str = "appointment_date",
) -> DataFrame:
    """Visit with its appointment, its optional survey and, if given, its parts rollup."""
    base = attach_parent(visits, appointments, "appointment_id", appointment_cols)
    base = attach_optional(base, surveys, "visit_id", ["csat_score", "complaint_flag"])
    base = base.withColumns(
        {
            "lead_time_days": lead_time_days(F.col("booking_date"), F.col(date_col)),
            "delayed": delayed(F.col("delay_hours")),
            "delay_category": delay_category(F.col("delay_hours")),
        }
    )
    if parts is None:
        return base
    return attach_agg(base, parts, "visit_id").withColumn(
        "parts_delayed", is_true(F.col("parts_delayed"))
    )


def max_to_parent(child: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Largest value per parent; for booleans true if any child is true."""
    return child.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def parts_delay(repairs: DataFrame, parts: DataFrame, from_flag: bool = False) -> DataFrame:
    """Worst parts delay per visit.

    Parts are rolled up to their repair before the join, so the join multiplies no rows.
    A repair listed twice changes no maximum.
    """
    days = days_between(F.col("part_order_date"), F.col("part_received_date"))
    late = F.col("parts_delay_flag") == 1 if from_flag else days > LATE_PARTS_DAYS
    per_repair = max_to_parent(
        parts.select("repair_id", days.alias("max_parts_delay_days"), late.alias("parts_delayed")),
        "repair_id",
        ["max_parts_delay_days", "parts_delayed"],
    )
    per_visit = max_to_parent(
        attach_agg(repairs.select("repair_id", "visit_id"), per_repair, "repair_id"),
        "visit_id",
        ["max_parts_delay_days", "parts_delayed"],
    ).withColumn("parts_delayed", is_true(F.col("parts_delayed")))
    if not from_flag:
        return per_visit
    return per_visit.withColumn(
        "max_parts_delay_days", F.coalesce("max_parts_delay_days", F.lit(0))
    )


def customer_rollup_v1(visits: DataFrame) -> DataFrame:
    """Per customer: visits, delay, satisfaction, complaints and duration."""
    return (
        visits.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("visit_id").alias("total_visits"),
            F.avg("delay_hours").alias("avg_delay_hours"),
            F.avg(threshold_flag(F.col("delay_hours"), 0)).alias("delay_rate"),
            F.avg("csat_score").alias("avg_csat"),
            F.avg("complaint_flag").alias("complaint_rate"),
            F.coalesce(F.sum("complaint_flag"), F.lit(0)).alias("total_complaints"),
            F.avg("actual_duration_hours").alias("avg_service_duration"),
        )
    )


def customer_rollup_v2(visits: DataFrame) -> DataFrame:
    """Per customer: visits, vehicles, service types and the last visit.

    Vehicles and service types are first reduced to one row per customer and pair, so
    the two distinct counts need no expansion of the visits. Sums and counts carry the means.
    """
    measures = ("delay_hours", "delay_flag", "csat_score", "complaint_flag", "actual_duration_hours")
    pairs = (
        visits.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "vehicle_id", "service_type")
        .agg(
            F.count("visit_id").alias("n"),
            F.max("check_in_time").alias("last"),
            *[F.sum(F.col(m).cast("double")).alias(f"s_{m}") for m in measures],
            *[F.count(m).alias(f"n_{m}") for m in measures],
        )
    )

    def mean(measure: str) -> Column:
        return F.try_divide(F.sum(f"s_{measure}"), F.sum(f"n_{measure}"))

    return pairs.groupBy("customer_id").agg(
        F.sum("n").alias("visit_count"),
        F.count_distinct("vehicle_id").alias("unique_vehicles"),
        mean("delay_hours").alias("avg_delay_hours"),
        mean("delay_flag").alias("delay_rate"),
        mean("csat_score").alias("avg_csat"),
        mean("complaint_flag").alias("complaint_rate"),
        mean("actual_duration_hours").alias("avg_service_duration"),
        F.count_distinct("service_type").alias("service_type_count"),
        F.max("last").alias("last_visit_date"),
    )


def recency(
    customers: DataFrame,
    visits: DataFrame,
    time_col: str = "check_in_time",
    fill: bool = True,
) -> DataFrame:
    """Whole days from the last visit of a customer to the latest visit of all.

    A missing value takes the median, unless a later imputation fills it the same way.
    """
    latest = visits.agg(F.max(time_col)).scalar()
    with_days = customers.withColumn(
        "recency_days", days_between(F.col("last_visit_date"), latest).cast("double")
    )
    return fill_median(with_days, ["recency_days"]) if fill else with_days


# policies for missing customer features: columns filled by their median, others by a constant
IMPUTE_V1 = {
    "median": ("avg_csat", "avg_service_duration"),
    "constant": {"complaint_rate": 0.0, "avg_delay_hours": 0.0},
    "finite": (),
}
IMPUTE_V2 = {
    "median": ("avg_csat",),
    "constant": {"complaint_rate": 0.0},
    "finite": (
        "visit_count",
        "unique_vehicles",
        "avg_delay_hours",
        "delay_rate",
        "service_type_count",
        "recency_days",
    ),
}


def impute_customers(features: DataFrame, policy: dict) -> DataFrame:
    """Fill missing customer features; infinities count as missing and take the median."""
    finite = [c for c in policy["finite"] if c in features.columns]
    df = features.withColumns(
        {c: finite_or_null(F.col(c).cast("double")) for c in finite}
    ) if finite else features
    df = df.fillna(policy["constant"])
    return fill_median(df, [*policy["median"], *finite])


def model_frame(visits: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return visits.select(*features, target).dropna(subset=[target])

