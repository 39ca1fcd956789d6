"""Visit and customer features (FEA)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.operators import features
from bayline.operators.cleaning import clean_parts, clean_repairs
from bayline.plans.binding import CATEGORY_FIXES, Tables, with_roles
from bayline.plans.registry import query, rounded

_BASE_COLUMNS = (
    "visit_id, appointment_id, customer_id, vehicle_id, dealer_id, service_type, "
    "csat_score, complaint_flag, lead_time_days, delayed, delay_category"
)


@query(
    "fea1_visit_base",
    with_roles("base", "visit_parts")
    + f"""select {_BASE_COLUMNS.replace('visit_id', 'b.visit_id', 1)},
               round(delay_hours, 6) + 0.0 as delay_hours, p.max_parts_delay_days,
               coalesce(p.parts_delayed, false) as parts_delayed
         from base b left join visit_parts p on b.visit_id = p.visit_id""",
)
def visit_base(t: Tables):
    base = features.visit_base(
        t.visits,
        t.appointments,
        t.surveys,
        ("customer_id", "booking_date", "service_type"),
        t.visit_parts,
        "check_in_time",
    ).withColumn("vehicle_id", F.concat_ws("-", "customer_id", "part_id"))
    return rounded(base).select(
        *_BASE_COLUMNS.split(", "), "delay_hours", "max_parts_delay_days", "parts_delayed"
    )


@query("fea2_lead_time", with_roles("base") + "select visit_id, lead_time_days from base")
def lead_time(t: Tables):
    return t.base.select("visit_id", "lead_time_days")


@query(
    "fea3_delayed",
    with_roles("visits") + "select visit_id, delay_hours > 0 as delayed from visits",
)
def delayed(t: Tables):
    return t.visits.select("visit_id", features.delayed(F.col("delay_hours")).alias("delayed"))


@query("fea4_delay_category", with_roles("base") + "select visit_id, delay_category from base")
def delay_category(t: Tables):
    category = features.delay_category(F.col("delay_hours"))
    return t.visits.select("visit_id", category.alias("delay_category"))


@query(
    "fea5_parts_delay",
    with_roles("visit_parts")
    + "select visit_id, max_parts_delay_days, parts_delayed from visit_parts",
)
def parts_delay(t: Tables):
    return t.visit_parts


@query(
    "fea6_parts_delay_from_flag",
    with_roles("clean_repairs", "clean_parts")
    + """select r.visit_id,
               coalesce(max(floor(date_diff('microsecond', p.part_order_date,
                 p.part_received_date) / 8.64e10)::bigint), 0) as max_parts_delay_days,
               coalesce(bool_or(p.parts_delay_flag = 1), false) as parts_delayed
         from (select distinct repair_id, visit_id from clean_repairs) r
         left join clean_parts p using (repair_id) group by r.visit_id""",
)
def parts_delay_from_flag(t: Tables):
    repairs = clean_repairs(t.repairs, t.clean_visits, CATEGORY_FIXES)
    return features.parts_delay(repairs, clean_parts(t.parts, repairs), from_flag=True)


@query(
    "fea7_recency",
    with_roles("features_v2", "base")
    + """select customer_id,
               floor(date_diff('microsecond', last_visit_date,
                 (select max(check_in_time) from base)) / 8.64e10)::double as recency_days
         from features_v2""",
)
def recency(t: Tables):
    return features.recency(t.rollup_v2, t.visits).select("customer_id", "recency_days")


@query(
    "fea8_imputed_v1",
    with_roles("imputed_v1")
    + """select customer_id, total_visits, round(avg_csat, 6) as avg_csat,
               round(complaint_rate, 6) as complaint_rate,
               round(avg_delay_hours, 6) + 0.0 as avg_delay_hours,
               round(avg_service_duration, 6) as avg_service_duration
         from imputed_v1""",
)
def imputed_v1(t: Tables):
    imputed = features.impute_customers(t.rollup_v1, features.IMPUTE_V1)
    return rounded(imputed).select(
        "customer_id",
        "total_visits",
        "avg_csat",
        "complaint_rate",
        "avg_delay_hours",
        "avg_service_duration",
    )


@query(
    "fea8_imputed_v2",
    with_roles("imputed_v2")
    + """select customer_id, visit_count::double as visit_count,
               unique_vehicles::double as unique_vehicles,
               round(avg_delay_hours, 6) + 0.0 as avg_delay_hours, round(delay_rate, 6) as delay_rate,
               round(avg_csat, 6) as avg_csat, round(complaint_rate, 6) as complaint_rate,
               service_type_count::double as service_type_count, recency_days
         from imputed_v2""",
)
def imputed_v2(t: Tables):
    return rounded(t.imputed_v2).select(
        "customer_id",
        "visit_count",
        "unique_vehicles",
        "avg_delay_hours",
        "delay_rate",
        "avg_csat",
        "complaint_rate",
        "service_type_count",
        "recency_days",
    )


@query(
    "fea9_model_frame",
    with_roles("base", "surveys")
    + """select dealer_id, service_type, lead_time_days, scheduled_duration_hours,
               complaint_flag from base where complaint_flag is not null""",
)
def model_frame(t: Tables):
    return features.model_frame(
        t.base,
        ["dealer_id", "service_type", "lead_time_days", "scheduled_duration_hours"],
        "complaint_flag",
    )
