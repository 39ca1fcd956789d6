"""Cleaning rules and the cascade along the foreign keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.functions.flags import (
    in_domain,
    null_unless,
    nullable_flag,
    remap,
    threshold_flag,
)
from bayline.functions.scalars import days_between, hours_between
from bayline.operators.joins import keep_valid
from bayline.sources.sinks import stage


# fixed values of the cleaning rules
MAX_REPAIR_HOURS = 24
LATE_PARTS_DAYS = 2
CSAT_VALUES = (1, 2, 3, 4, 5)
COMPLAINT_MAX_CSAT = 2
REPAIR_CATEGORY_FIXES = {
    "general repair": "General Repair",
    "GENERAL REPAIR": "General Repair",
    "GEN_REPAIR": "General Repair",
}


def require_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def require_order(df: DataFrame, early: str, late: str) -> DataFrame:
    """Rows with late >= early; a missing side drops the row."""
    return df.filter(F.col(late) >= F.col(early))


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first one by ``order`` and then by the other columns.

    An aggregate instead of a window: each task sends on one row per key, so a key
    with very many rows is small before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def clean_customers(customers: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return keep_first(require_key(customers, "customer_id"), "customer_id", order)


def clean_vehicles(vehicles: DataFrame, customers: DataFrame) -> DataFrame:
    keyed = require_key(vehicles, "vehicle_id")
    return keep_valid(keyed, "customer_id", customers, "customer_id")


def clean_appointments(
    appointments: DataFrame, customers: DataFrame, vehicles: DataFrame, dealers: DataFrame
) -> DataFrame:
    kept = require_order(
        require_key(appointments, "appointment_id"), "booking_date", "appointment_date"
    ).filter(F.col("scheduled_duration_hours") > 0)
    for fk, parent in (
        ("dealer_id", dealers),
        ("customer_id", customers),
        ("vehicle_id", vehicles),
    ):
        kept = keep_valid(kept, fk, parent, fk)
    return kept


def clean_visits(visits: DataFrame, appointments: DataFrame) -> DataFrame:
    """Valid visits with duration, delay and delay flag computed from the timestamps."""
    kept = require_order(
        require_key(visits, "visit_id"), "service_start_time", "completion_time"
    )
    delay = hours_between(F.col("promised_completion"), F.col("completion_time"))
    return keep_valid(kept, "appointment_id", appointments, "appointment_id").withColumns(
        {
            "actual_duration_hours": hours_between(
                F.col("service_start_time"), F.col("completion_time")
            ),
            "delay_hours": delay,
            "delay_flag": threshold_flag(delay, 0),
        }
    )


def clean_repairs(
    repairs: DataFrame,
    visits: DataFrame,
    category_fixes: Mapping[str, str] = REPAIR_CATEGORY_FIXES,
) -> DataFrame:
    hours = F.col("actual_hours")
    return keep_valid(
        require_key(repairs, "repair_id"), "visit_id", visits, "visit_id"
    ).withColumns(
        {
            "actual_hours": null_unless(hours, (hours >= 0) & (hours <= MAX_REPAIR_HOURS)),
            "repair_category": remap(F.col("repair_category"), category_fixes),
        }
    )


def clean_parts(
    parts: DataFrame,
    repairs: DataFrame,
    complete: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Valid parts with the delay flag computed from the dates.

    ``complete`` makes whole parts of rows that have no more than the repair and what it needs. It is
    given the rows of valid repairs only, so that whatever it joins meets fewer and narrower rows.
    """
    ordered, received = F.col("part_order_date"), F.col("part_received_date")
    # a missing order date is no proof of a wrong received date
    valid = F.coalesce(received >= ordered, F.lit(True))
    kept = keep_valid(parts, "repair_id", repairs, "repair_id")
    kept = require_key(kept if complete is None else complete(kept), "part_transaction_id")
    kept = kept.withColumn("part_received_date", null_unless(received, valid))
    late = threshold_flag(days_between(ordered, received), LATE_PARTS_DAYS)
    return kept.withColumn("parts_delay_flag", null_unless(late, received.isNotNull()))


def clean_surveys(surveys: DataFrame, visits: DataFrame) -> DataFrame:
    csat = F.col("csat_score")
    return (
        keep_valid(require_key(surveys, "survey_id"), "visit_id", visits, "visit_id")
        .withColumn("csat_score", null_unless(csat, in_domain(csat, CSAT_VALUES)))
        .withColumn("complaint_flag", nullable_flag(csat, COMPLAINT_MAX_CSAT, "<="))
    )


def clean_all(
    raw: Mapping[str, DataFrame],
    customer_order: Sequence[str] = (),
    category_fixes: Mapping[str, str] = REPAIR_CATEGORY_FIXES,
) -> dict[str, DataFrame]:
    """All eight tables, each child against its cleaned parent, in one pass."""
    customers = clean_customers(raw["customers"], customer_order)
    dealers = raw["dealers"]
    vehicles = clean_vehicles(raw["vehicles"], customers)
    appointments = clean_appointments(raw["appointments"], customers, vehicles, dealers)
    visits = clean_visits(raw["service_visits"], appointments)
    repairs = clean_repairs(raw["repairs"], visits, category_fixes)
    return {
        "customers": customers,
        "vehicles": vehicles,
        "dealers": dealers,
        "appointments": appointments,
        "service_visits": visits,
        "repairs": repairs,
        "parts": clean_parts(raw["parts"], repairs),
        "customer_surveys": clean_surveys(raw["customer_surveys"], visits),
    }


def cascade(
    tables: Mapping[str, DataFrame], relationships: Sequence[tuple[str, str, str, str]]
) -> dict[str, DataFrame]:
    """Filter every child against its filtered parents.

    ``relationships`` holds (child, fk, parent, pk), parents before their own children. Every
    filtered table is staged once it is whole, so that no child repeats the chain above it.
    """
    kept = dict(tables)
    last = {child: i for i, (child, *_) in enumerate(relationships)}
    for i, (child, fk, parent, pk) in enumerate(relationships):
        kept[child] = keep_valid(kept[child], fk, kept[parent], pk)
        if last[child] == i:
            kept[child] = stage(kept[child], f"kept_{child}")
    return kept
