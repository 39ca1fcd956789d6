"""Star schema for reporting: one fact, three dimensions and two summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.functions.flags import threshold_flag
from bayline.functions.scalars import day_name, iso_week, month_abbr
from bayline.operators.joins import alias_join, attach_agg, attach_optional, attach_parent
from bayline.operators.kpi import SEVERE_DELAY_HOURS, cluster_profile, group_summary

APPOINTMENT_COLUMNS = ("customer_id", "booking_date", "service_type", "appointment_status")
SURVEY_COLUMNS = ("csat_score", "complaint_flag")
SEGMENT_COLUMNS = (
    "segment_name",
    "visit_count",
    "delay_rate",
    "avg_csat",
    "complaint_rate",
    "recency_days",
)


def calendar_columns(df: DataFrame, ts: str) -> DataFrame:
    """Date, year, month, month name, ISO week and day name of a timestamp."""
    t = F.col(ts)
    return df.withColumns(
        {
            "service_date": F.to_date(t),
            "service_year": F.year(t),
            "service_month": F.month(t),
            "service_month_name": month_abbr(t),
            "service_week": iso_week(t),
            "day_of_week": day_name(t),
        }
    )


def business_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "delayed_visit": threshold_flag(F.col("delay_hours"), 0),
            "severe_delay": threshold_flag(F.col("delay_hours"), SEVERE_DELAY_HOURS, ">="),
            "first_time_fix": threshold_flag(F.col("first_time_fix_flag"), 1, "="),
        }
    )


def fact_visits(
    visits: DataFrame, appointments: DataFrame, surveys: DataFrame, dealers: DataFrame
) -> DataFrame:
    """One row per visit with appointment, survey, dealer, calendar and flags."""
    fact = attach_parent(visits, appointments, "appointment_id", APPOINTMENT_COLUMNS)
    fact = attach_optional(fact, surveys, "visit_id", SURVEY_COLUMNS)
    fact = alias_join(fact, dealers, "dealer_id", "dealer_")
    return business_flags(calendar_columns(fact, "check_in_time"))


def dim_customers(customers: DataFrame, segments: DataFrame) -> DataFrame:
    return attach_agg(customers, segments.select("customer_id", *SEGMENT_COLUMNS), "customer_id")


def dim_vehicles(vehicles: DataFrame) -> DataFrame:
    return vehicles.select("vehicle_id", "customer_id", "part_id")


def dim_dealers(dealers: DataFrame) -> DataFrame:
    return dealers.select("dealer_id", "dealer_name", "region")


def segment_summary(customers: DataFrame) -> DataFrame:
    return cluster_profile(customers, "segment_name")


def experiment_summary(experiment: DataFrame) -> DataFrame:
    return group_summary(experiment)
