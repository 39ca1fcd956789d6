"""Cleaned tables (CLN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.operators import cleaning
from bayline.plans.binding import Tables, with_roles
from bayline.plans.registry import query, rounded
from bayline.sources.schemas import RELATIONSHIPS


@query(
    "cln1_customers",
    with_roles("clean_customers")
    + "select customer_id, region, customer_type, account_balance from clean_customers",
)
def customers(t: Tables):
    return t.clean_customers


@query(
    "cln2_keep_first",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
       from lineitem
       qualify row_number() over (partition by l_orderkey, l_linenumber
         order by l_partkey, l_suppkey, l_shipdate, l_extendedprice) = 1""",
)
def keep_first(t: Tables):
    lines = t.given("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    return cleaning.keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query(
    "cln3_vehicles",
    with_roles("clean_vehicles") + "select vehicle_id, customer_id, part_id from clean_vehicles",
)
def vehicles(t: Tables):
    return t.clean_vehicles


_APPOINTMENTS = """select appointment_id, customer_id, vehicle_id, dealer_id, booking_date,
       appointment_date, service_type, scheduled_duration_hours, appointment_status,
       promised_completion from clean_appointments"""


@query("cln4_appointments", with_roles("clean_appointments") + _APPOINTMENTS)
def appointments(t: Tables):
    return t.clean_appointments


@query(
    "cln5_visits",
    with_roles("clean_visits")
    + """select visit_id, appointment_id, dealer_id, service_start_time, completion_time,
               promised_completion, round(actual_duration_hours, 6) as actual_duration_hours,
               round(delay_hours, 6) + 0.0 as delay_hours, delay_flag from clean_visits""",
)
def visits(t: Tables):
    return rounded(cleaning.clean_visits(t.visits, t.clean_appointments)).select(
        "visit_id",
        "appointment_id",
        "dealer_id",
        "service_start_time",
        "completion_time",
        "promised_completion",
        "actual_duration_hours",
        "delay_hours",
        "delay_flag",
    )


@query(
    "cln6_repairs",
    with_roles("clean_repairs")
    + """select repair_id, visit_id, repair_category, round(estimated_hours, 6) as estimated_hours,
               actual_hours, repair_status from clean_repairs""",
)
def repairs(t: Tables):
    return rounded(t.clean_repairs)


@query("cln7_parts", with_roles("clean_parts") + "select * from clean_parts")
def parts(t: Tables):
    return t.clean["parts"]


@query("cln8_surveys", with_roles("clean_surveys") + "select * from clean_surveys")
def surveys(t: Tables):
    return t.clean["customer_surveys"]


_CASCADE_SQL = with_roles(
    "raw_customers", "raw_dealers", "vehicles", "full_appointments", "visits", "repairs", "parts",
    "raw_surveys",
) + """,
k_vehicles as (select * from vehicles where customer_id in
    (select customer_id from raw_customers where customer_id is not null)),
k_appointments as (select * from full_appointments
    where customer_id in (select customer_id from raw_customers where customer_id is not null)
      and vehicle_id in (select vehicle_id from k_vehicles)
      and dealer_id in (select dealer_id from raw_dealers)),
k_visits as (select * from visits where appointment_id in
    (select appointment_id from k_appointments)),
k_repairs as (select * from repairs where visit_id in (select visit_id from k_visits)),
k_parts as (select * from parts where repair_id in (select repair_id from k_repairs)),
k_surveys as (select * from raw_surveys where visit_id in (select visit_id from k_visits))
select 'vehicles' as "table", count(*) as row_count from k_vehicles
union all select 'appointments', count(*) from k_appointments
union all select 'service_visits', count(*) from k_visits
union all select 'repairs', count(*) from k_repairs
union all select 'parts', count(*) from k_parts
union all select 'customer_surveys', count(*) from k_surveys
"""


@query("cln9_cascade", _CASCADE_SQL)
def cascade(t: Tables):
    """Rows that are left in each child table when only the keys decide."""
    children = dict.fromkeys(child for child, *_ in RELATIONSHIPS)
    keys: dict[str, dict[str, None]] = {}
    for child, fk, parent, pk in RELATIONSHIPS:
        keys.setdefault(child, {})[fk] = None
        keys.setdefault(parent, {})[pk] = None
    tables = {name: t.raw_layer[name].select(*columns) for name, columns in keys.items()}
    kept = cleaning.cascade(tables, RELATIONSHIPS)
    frames = [
        kept[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table"), "row_count"
        )
        for name in children
    ]
    report = frames[0]
    for frame in frames[1:]:
        report = report.unionByName(frame)
    return report
