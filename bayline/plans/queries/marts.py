"""Star schema for reporting (MRT)."""

from __future__ import annotations

from bayline.operators import marts
from bayline.operators.kpi import cluster_profile
from bayline.operators.segments import CLUSTER_ACTIONS_V2, label_customers, name_clusters_v2
from bayline.plans.binding import Tables, with_roles
from bayline.plans.queries.kpis import EXPERIMENT_SQL, experiment_rows, pseudo_clusters
from bayline.plans.queries.segments import NAMED_V2_SQL, PSEUDO_SQL
from bayline.plans.registry import query, rounded

FACT_SQL = with_roles("base", "raw_dealers") + """, fact as (
  select b.visit_id, b.appointment_id, b.customer_id, b.dealer_id, b.booking_date,
         b.service_type, b.appointment_status, b.csat_score, b.complaint_flag,
         d.dealer_name, d.region, b.delay_hours,
         b.check_in_time::date as service_date, year(b.check_in_time)::int as service_year,
         month(b.check_in_time)::int as service_month,
         strftime(b.check_in_time, '%b') as service_month_name,
         week(b.check_in_time)::int as service_week,
         strftime(b.check_in_time, '%A') as day_of_week,
         coalesce(b.delay_hours > 0, false)::int as delayed_visit,
         coalesce(b.delay_hours >= 4, false)::int as severe_delay,
         coalesce(b.first_time_fix_flag = 1, false)::int as first_time_fix
  from base b left join raw_dealers d on b.dealer_id = d.dealer_id)
"""
FACT_COLUMNS = (
    "visit_id",
    "appointment_id",
    "customer_id",
    "dealer_id",
    "booking_date",
    "service_type",
    "appointment_status",
    "csat_score",
    "complaint_flag",
    "dealer_name",
    "region",
    "delay_hours",
    "service_date",
    "service_year",
    "service_month",
    "service_month_name",
    "service_week",
    "day_of_week",
    "delayed_visit",
    "severe_delay",
    "first_time_fix",
)


def fact_visits(t: Tables):
    dealers = t.raw["dealers"].select("dealer_id", "dealer_name", "region")
    return marts.fact_visits(t.visits, t.appointments, t.surveys, dealers).select(*FACT_COLUMNS)


@query(
    "mrt1_fact_visits",
    FACT_SQL + "select * replace (round(delay_hours, 6) + 0.0 as delay_hours) from fact",
)
def fact(t: Tables):
    return rounded(fact_visits(t))


def labelled(t: Tables):
    """Customer features with the name of their cluster."""
    clusters = pseudo_clusters(t)
    named = name_clusters_v2(cluster_profile(clusters))
    return label_customers(clusters, named, CLUSTER_ACTIONS_V2)


LABELLED_SQL = PSEUDO_SQL + NAMED_V2_SQL + """, labelled as (
  select c.*, n.segment_name from clusters c join named n using (cluster_id))
"""


@query(
    "mrt2_dim_customers",
    LABELLED_SQL + """select u.customer_id, u.region, u.customer_type, l.segment_name,
        l.visit_count::double as visit_count, round(l.delay_rate, 6) as delay_rate,
        round(l.avg_csat, 6) as avg_csat, round(l.complaint_rate, 6) as complaint_rate,
        l.recency_days
 from (select c_custkey as customer_id, r_name as region, c_mktsegment as customer_type
       from customer join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey) u
 left join labelled l using (customer_id)""",
)
def dim_customers(t: Tables):
    customers = t.customers.drop("account_balance")
    return rounded(marts.dim_customers(customers, labelled(t)))


@query("mrt3_dim_vehicles", with_roles("vehicles") + "select * from vehicles")
def dim_vehicles(t: Tables):
    return marts.dim_vehicles(t.vehicles)


@query(
    "mrt3_dim_dealers",
    with_roles("dealers") + "select dealer_id, dealer_name, region from dealers",
)
def dim_dealers(t: Tables):
    return marts.dim_dealers(t.dealers)


@query(
    "mrt4_segment_summary",
    LABELLED_SQL + """select segment_name, count(*) as customers,
        round(avg(visit_count), 6) as avg_visits,
        round(avg(unique_vehicles), 6) as avg_unique_vehicles,
        round(avg(avg_delay_hours), 6) + 0.0 as avg_delay_hours, round(avg(delay_rate), 6) as delay_rate,
        round(avg(avg_csat), 6) as avg_csat, round(avg(complaint_rate), 6) as complaint_rate,
        round(avg(service_type_count), 6) as avg_service_types,
        round(avg(recency_days), 6) as avg_recency_days,
        round(count(*) * 100.0 / sum(count(*)) over (), 6) as customer_percentage
 from labelled group by segment_name""",
)
def segment_summary(t: Tables):
    return rounded(marts.segment_summary(labelled(t)))


@query(
    "mrt4_experiment_summary",
    EXPERIMENT_SQL
    + """select experiment_group, count(*) as customers,
               round(avg(final_delay_flag), 6) as delay_rate, round(avg(csat_score), 6) as avg_csat,
               round(avg(complaint_flag), 6) as complaint_rate
         from experiment group by experiment_group""",
)
def experiment_summary(t: Tables):
    return rounded(marts.experiment_summary(experiment_rows(t)))
