"""Projections, filters and scalar functions (PRJ, FIL, SCL) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.functions import flags, scalars
from bayline.operators import cleaning
from bayline.operators.features import delay_category
from bayline.operators.model import risk_band
from bayline.operators.quantiles import fill_median
from bayline.plans.binding import Tables, with_roles
from bayline.plans.registry import query, rounded

# ---- projections -----------------------------------------------------------------------


@query("prj1_column_subset", "select o_orderkey, o_custkey, o_orderstatus from orders")
def column_subset(t: Tables):
    return t.given("orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "prj2_two_way_label",
    """select s_suppkey, case when s_acctbal > 5000 then 'Active' else 'Expired' end as status
       from supplier""",
)
def two_way_label(t: Tables):
    label = flags.flag_label(F.col("s_acctbal") > 5000, "Active", "Expired")
    return t.given("supplier").select("s_suppkey", label.alias("status"))


@query(
    "prj3_first_match",
    with_roles("visits")
    + """select visit_id,
               case when delay_hours is null then 'Unknown'
                    when delay_hours <= 0 then 'On Time' when delay_hours <= 4 then 'Minor Delay'
                    when delay_hours <= 8 then 'Moderate Delay' else 'Severe Delay' end as category
         from visits""",
)
def first_match(t: Tables):
    return t.visits.select("visit_id", delay_category(F.col("delay_hours")).alias("category"))


@query("prj4_age_at", "select o_orderkey, (2026 - year(o_orderdate))::int as age from orders")
def age_at(t: Tables):
    age = scalars.age_at(F.year("o_orderdate"), 2026)
    return t.given("orders").select("o_orderkey", age.alias("age"))


@query(
    "prj5_ratio",
    """select p_partkey, round(p_retailprice / nullif(p_size % 10, 0), 6) as workload
       from part""",
)
def ratio(t: Tables):
    value = scalars.ratio(F.col("p_retailprice"), F.col("p_size") % 10)
    return rounded(t.given("part").select("p_partkey", value.alias("workload")))


@query(
    "prj6_threshold_flag",
    with_roles("visits")
    + """select visit_id, (delay_hours > 0)::int as delayed_visit,
               (delay_hours >= 4)::int as severe_delay,
               (first_time_fix_flag = 1)::int as first_time_fix
         from visits""",
)
def threshold_flag(t: Tables):
    return t.visits.select(
        "visit_id",
        flags.threshold_flag(F.col("delay_hours"), 0).alias("delayed_visit"),
        flags.threshold_flag(F.col("delay_hours"), 4, ">=").alias("severe_delay"),
        flags.threshold_flag(F.col("first_time_fix_flag"), 1, "=").alias("first_time_fix"),
    )


@query(
    "prj7_nullable_flag",
    with_roles("raw_surveys")
    + "select survey_id, (csat_score <= 2)::int as complaint from raw_surveys",
)
def nullable_flag(t: Tables):
    flag = flags.nullable_flag(F.col("csat_score"), 2, "<=")
    return t.raw_surveys.select("survey_id", flag.alias("complaint"))


@query(
    "prj8_right_closed_band",
    """select l_orderkey, l_linenumber, l_tax,
              case when l_discount * 10 <= 0.3 then 'Low Risk'
                   when l_discount * 10 <= 0.6 then 'Medium Risk'
                   when l_discount * 10 <= 1.0 then 'High Risk' end as risk_band
       from lineitem""",
)
def right_closed_band(t: Tables):
    return t.given("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_tax",
        risk_band(F.col("l_discount") * 10).alias("risk_band"),
    )


@query(
    "prj9_remap",
    """select o_orderkey, case o_orderpriority when '5-LOW' then 'LOW'
                               when '4-NOT SPECIFIED' then 'LOW'
                               else o_orderpriority end as priority
       from orders""",
)
def remap(t: Tables):
    mapping = {"5-LOW": "LOW", "4-NOT SPECIFIED": "LOW"}
    value = flags.remap(F.col("o_orderpriority"), mapping)
    return t.given("orders").select("o_orderkey", value.alias("priority"))


@query(
    "prj10_lookup_label",
    """select o_orderkey, case o_orderstatus when 'F' then 'Finished'
                               when 'O' then 'Open' end as status
       from orders""",
)
def lookup_label(t: Tables):
    value = flags.lookup_label(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"})
    return t.given("orders").select("o_orderkey", value.alias("status"))


@query(
    "prj11_parse_timestamp",
    """select o_orderkey,
              case when o_orderstatus <> 'P' then o_orderdate end as booked
       from orders""",
)
def parse_timestamp(t: Tables):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).otherwise(text)
    return t.given("orders").select("o_orderkey", scalars.parse_ts(broken).alias("booked"))


@query(
    "prj12_key_to_long",
    """select case when c_acctbal > 0 then c_custkey end as customer_id, c_name from customer""",
)
def key_to_long(t: Tables):
    text = F.col("c_custkey").cast("double").cast("string")
    broken = F.when(F.col("c_acctbal") > 0, text).otherwise(F.lit("n/a"))
    return t.given("customer").select(scalars.key_long(broken).alias("customer_id"), "c_name")


@query("prj13_rename", "select o_orderkey as appointment_id, o_orderstatus as status from orders")
def rename(t: Tables):
    orders = t.given("orders").select("o_orderkey", "o_orderstatus")
    return orders.withColumnsRenamed({"o_orderkey": "appointment_id", "o_orderstatus": "status"})


# ---- filters ---------------------------------------------------------------------------


@query(
    "fil1_require_key",
    with_roles("raw_customers")
    + "select customer_id, region from raw_customers where customer_id is not null",
)
def require_key(t: Tables):
    return cleaning.require_key(t.raw["customers"], "customer_id").select("customer_id", "region")


@query(
    "fil2_require_order",
    with_roles("full_appointments")
    + """select appointment_id, booking_date, appointment_date from full_appointments
         where appointment_date >= booking_date""",
)
def require_order(t: Tables):
    kept = cleaning.require_order(t.full_appointments, "booking_date", "appointment_date")
    return kept.select("appointment_id", "booking_date", "appointment_date")


@query(
    "fil3_constant_filter",
    "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 0",
)
def constant_filter(t: Tables):
    cond = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 0)
    return t.given("orders").filter(cond).select("o_orderkey", "o_totalprice")


@query(
    "fil4_membership",
    with_roles("raw_surveys")
    + """select survey_id, csat_score,
               coalesce(csat_score in (1, 2, 3, 4, 5), false) as in_domain,
               coalesce(csat_score not in (1, 2, 3, 4, 5), false) as out_of_domain
         from raw_surveys""",
)
def membership(t: Tables):
    csat = F.col("csat_score")
    return t.raw_surveys.select(
        "survey_id",
        "csat_score",
        flags.in_domain(csat, cleaning.CSAT_VALUES).alias("in_domain"),
        flags.out_of_domain(csat, cleaning.CSAT_VALUES).alias("out_of_domain"),
    )


@query(
    "fil5_null_out",
    with_roles("repairs")
    + """select repair_id, visit_id,
               case when actual_hours between 0 and 24 then actual_hours end as actual_hours
         from repairs""",
)
def null_out(t: Tables):
    hours = F.col("actual_hours")
    valid = (hours >= 0) & (hours <= cleaning.MAX_REPAIR_HOURS)
    return t.repairs.select(
        "repair_id", "visit_id", flags.null_unless(hours, valid).alias("actual_hours")
    )


@query(
    "fil6_drop_missing",
    with_roles("base")
    + "select visit_id, delayed, csat_score from base where csat_score is not null",
)
def drop_missing(t: Tables):
    return t.surveyed.select("visit_id", "delayed", "csat_score").dropna(subset=["csat_score", "delayed"])


@query(
    "fil7_finite_or_null",
    """select l_orderkey, l_linenumber,
              case when l_discount <> 0 then round(l_quantity / l_discount, 6) end as density
       from lineitem""",
)
def finite_or_null(t: Tables):
    # a zero discount stands for the infinite and undefined ratios of a float column
    density = F.when(
        F.col("l_discount") == 0,
        F.when(F.col("l_quantity") > 25, F.lit(float("inf"))).otherwise(F.lit(float("nan"))),
    ).otherwise(F.try_divide("l_quantity", "l_discount"))
    lines = t.given("lineitem").withColumn("density", density)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.round(scalars.finite_or_null(F.col("density")), 6).alias("density"),
    )


# ---- scalar functions ------------------------------------------------------------------


@query(
    "scl1_hours_between",
    """select event_id, round(date_diff('microsecond', o_orderdate, ts) / 3.6e9, 6) as hours
       from events join orders on event_id = o_orderkey""",
)
def hours_between(t: Tables):
    joined = t.given("events").join(t.given("orders"), F.col("event_id") == F.col("o_orderkey"))
    hours = scalars.hours_between(F.col("o_orderdate"), F.col("ts"))
    return rounded(joined.select("event_id", hours.alias("hours")))


@query(
    "scl2_days_between",
    """select event_id,
              floor(date_diff('microsecond', o_orderdate, ts) / 8.64e10)::bigint as days_forward,
              floor(date_diff('microsecond', ts, o_orderdate) / 8.64e10)::bigint as days_back
       from events join orders on event_id = o_orderkey""",
)
def days_between(t: Tables):
    joined = t.given("events").join(t.given("orders"), F.col("event_id") == F.col("o_orderkey"))
    booked, seen = F.col("o_orderdate"), F.col("ts")
    return joined.select(
        "event_id",
        scalars.days_between(booked, seen).alias("days_forward"),
        scalars.days_between(seen, booked).alias("days_back"),
    )


@query(
    "scl3_add_time",
    """select l_orderkey, l_linenumber,
              l_shipdate + to_days(l_linenumber) + to_microseconds((l_quantity * 720000000)::bigint)
                as promised
       from lineitem""",
)
def add_time(t: Tables):
    promised = scalars.add_time(F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_quantity") / 5)
    return t.given("lineitem").select("l_orderkey", "l_linenumber", promised.alias("promised"))


@query("scl4_sub_days", "select event_id, ts - interval 5 day as earlier from events")
def sub_days(t: Tables):
    return t.given("events").select("event_id", scalars.sub_days(F.col("ts"), 5).alias("earlier"))


@query("scl5_date_part", "select event_id, ts::date as day from events")
def date_part(t: Tables):
    return t.given("events").select("event_id", F.to_date("ts").alias("day"))


@query(
    "scl6_year_month",
    "select event_id, year(ts)::int as y, month(ts)::int as m from events",
)
def year_month(t: Tables):
    return t.given("events").select("event_id", F.year("ts").alias("y"), F.month("ts").alias("m"))


@query("scl7_month_name", "select o_orderkey, strftime(o_orderdate, '%b') as m from orders")
def month_name(t: Tables):
    return t.given("orders").select(
        "o_orderkey", scalars.month_abbr(F.col("o_orderdate")).alias("m")
    )


@query("scl8_iso_week", "select o_orderkey, week(o_orderdate)::int as w from orders")
def iso_week(t: Tables):
    return t.given("orders").select("o_orderkey", scalars.iso_week(F.col("o_orderdate")).alias("w"))


@query("scl9_day_name", "select o_orderkey, strftime(o_orderdate, '%A') as d from orders")
def day_name(t: Tables):
    return t.given("orders").select("o_orderkey", scalars.day_name(F.col("o_orderdate")).alias("d"))


@query("scl10_round", "select l_orderkey, l_linenumber, round(l_quantity / 7, 2) as x from lineitem")
def round2(t: Tables):
    x = scalars.round2(F.col("l_quantity") / 7)
    return t.given("lineitem").select("l_orderkey", "l_linenumber", x.alias("x"))


@query(
    "scl11_clip",
    with_roles("raw_surveys")
    + """select survey_id,
               case when csat_score is not null then least(greatest(csat_score, 1), 5) end as csat
         from raw_surveys""",
)
def clip(t: Tables):
    return t.raw_surveys.select(
        "survey_id", scalars.clip(F.col("csat_score"), 1.0, 5.0).alias("csat")
    )


@query(
    "scl12_abs_sqrt",
    with_roles("visits")
    + """select visit_id, abs(delay_hours) as size, round(sqrt(abs(delay_hours)), 6) as root
         from visits""",
)
def abs_sqrt(t: Tables):
    size = F.abs("delay_hours")
    return rounded(t.visits.select("visit_id", size.alias("size"), F.sqrt(size).alias("root")))


@query(
    "scl13_fill_constant",
    with_roles("base")
    + "select visit_id, coalesce(complaint_flag, 0) as complaint_flag from base",
)
def fill_constant(t: Tables):
    return t.surveyed.select(
        "visit_id", scalars.fill(F.col("complaint_flag"), 0).alias("complaint_flag")
    )


@query(
    "scl14_fill_median",
    with_roles("repairs")
    + """, gaps as (select repair_id, visit_id,
                case when actual_hours >= 0 then actual_hours end as hours,
                case when estimated_hours > 2 then estimated_hours end as estimate from repairs)
         select repair_id, visit_id,
                round(coalesce(hours, (select median(hours) from gaps)), 6) as hours,
                round(coalesce(estimate, (select median(estimate) from gaps)), 6) as estimate
         from gaps""",
)
def fill_by_median(t: Tables):
    hours, estimate = F.col("actual_hours"), F.col("estimated_hours")
    gaps = t.repairs.select(
        "repair_id",
        "visit_id",
        flags.null_unless(hours, hours >= 0).alias("hours"),
        flags.null_unless(estimate, estimate > 2).alias("estimate"),
    )
    return rounded(fill_median(gaps, ["hours", "estimate"]))
