"""Aggregations and KPI tables (AGG)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.operators import features, kpi, marts, quality, sketches
from bayline.operators.experiment import GROUP, assign
from bayline.operators.model import risk_band
from bayline.operators.quantiles import median_of, quantiles
from bayline.operators.segments import rule_segments
from bayline.plans.binding import Tables, with_roles
from bayline.plans.registry import query, rounded
from bayline.sources.sinks import stage


@query(
    "agg1_overall_summary",
    with_roles("base")
    + """, one as (select count(*)::double as total, sum(delayed::int)::double as late,
                avg(delayed::int) as rate, avg(delay_hours) as delay, median(delay_hours) as mid,
                avg(csat_score) as csat, avg(complaint_flag) as complaints from base)
         select 'Total Visits' as metric, total as value from one
         union all select 'Delayed Visits', late from one
         union all select 'Delay Rate', round(rate, 6) from one
         union all select 'Average Delay Hours', round(delay, 6) from one
         union all select 'Median Delay Hours', round(mid, 6) from one
         union all select 'Average CSAT', round(csat, 6) from one
         union all select 'Complaint Rate', round(complaints, 6) from one""",
)
def overall_summary(t: Tables):
    measures = t.surveyed.select("delay_hours", "delayed", "csat_score", "complaint_flag")
    return rounded(kpi.kpi_overall(stage(measures, "measures")))


_SCORECARD = """select {key}, count(*) as visits, round(avg(delayed::int), 8) as delay_rate,
               round(avg(delay_hours), 8) + 0.0 as avg_delay_hours, round(avg(csat_score), 8) as avg_csat,
               round(avg(complaint_flag), 8) as complaint_rate
         from base group by {key}"""


@query("agg2_dealer_scorecard", with_roles("base") + _SCORECARD.format(key="dealer_id"))
def dealer_scorecard(t: Tables):
    return rounded(kpi.kpi_scorecard(t.surveyed, "dealer_id"), 8)


@query("agg3_service_type_scorecard", with_roles("base") + _SCORECARD.format(key="service_type"))
def service_type_scorecard(t: Tables):
    return rounded(kpi.kpi_scorecard(t.base, "service_type"), 8)


@query(
    "agg4_delay_distribution",
    with_roles("base")
    + """select d.delay_category, count(b.visit_id) as visits,
               round(count(b.visit_id) * 100.0 / (select count(*) from base), 6) as percentage
         from (values ('On Time'), ('Minor Delay'), ('Moderate Delay'), ('Severe Delay'),
                      ('Never')) d(delay_category)
         left join base b using (delay_category)
         group by d.delay_category""",
)
def delay_distribution(t: Tables):
    domain = [*features.DELAY_CATEGORIES, "Never"]
    category = features.delay_category(F.col("delay_hours")).alias("delay_category")
    return rounded(kpi.distribution(t.visits.select(category), "delay_category", domain))


@query(
    "agg5_complaints_by_delay",
    with_roles("base")
    + """select delayed, round(avg(complaint_flag), 6) as rate, count(complaint_flag) as visits
         from base group by delayed""",
)
def complaints_by_delay(t: Tables):
    return rounded(kpi.rate_by(t.surveyed, "delayed", "complaint_flag"))


@query(
    "agg6_parts_delay_comparison",
    with_roles("base", "visit_parts")
    + """select coalesce(p.parts_delayed, false) as parts_delayed, count(b.delay_hours) as visits,
               round(avg(b.delay_hours), 6) + 0.0 as average, round(median(b.delay_hours), 6) as median
         from base b left join visit_parts p on b.visit_id = p.visit_id
         group by 1""",
)
def parts_delay_comparison(t: Tables):
    parts = t.visit_parts.select("visit_id", "parts_delayed")
    visits = t.visits.select("visit_id", "delay_hours").join(parts, "visit_id", "left")
    visits = visits.withColumn("parts_delayed", F.coalesce("parts_delayed", F.lit(False)))
    return rounded(kpi.summary_by(visits, "parts_delayed", "delay_hours"))


@query(
    "agg7_max_to_parent",
    """select l_orderkey, max(l_quantity) as l_quantity, bool_or(l_tax > 0.05) as taxed
       from lineitem group by l_orderkey""",
)
def max_to_parent(t: Tables):
    lines = t.given("lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_tax") > 0.05).alias("taxed")
    )
    return features.max_to_parent(lines, "l_orderkey", ["l_quantity", "taxed"])


@query(
    "agg8_customer_rollup_v1",
    with_roles("features_v1")
    + """select customer_id, total_visits, round(avg_delay_hours, 6) + 0.0 as avg_delay_hours,
               round(delay_rate, 6) as delay_rate, round(avg_csat, 6) as avg_csat,
               round(complaint_rate, 6) as complaint_rate, total_complaints,
               round(avg_service_duration, 6) as avg_service_duration
         from features_v1""",
)
def customer_rollup_v1(t: Tables):
    return rounded(features.customer_rollup_v1(t.base))


@query(
    "agg9_customer_rollup_v2",
    with_roles("features_v2")
    + """select customer_id, visit_count, unique_vehicles,
               round(avg_delay_hours, 6) + 0.0 as avg_delay_hours, round(delay_rate, 6) as delay_rate,
               round(avg_csat, 6) as avg_csat, round(complaint_rate, 6) as complaint_rate,
               round(avg_service_duration, 6) as avg_service_duration, service_type_count,
               last_visit_date
         from features_v2""",
)
def customer_rollup_v2(t: Tables):
    return rounded(features.customer_rollup_v2(t.base))


@query(
    "agg10_segment_profile",
    with_roles("rule_segments")
    + """select segment, count(*) as customers, round(avg(total_visits), 6) as avg_visits,
               round(avg(avg_delay_hours), 6) + 0.0 as avg_delay_hours,
               round(avg(delay_rate), 6) as delay_rate, round(avg(avg_csat), 6) as avg_csat,
               round(avg(complaint_rate), 6) as complaint_rate,
               round(count(*) / sum(count(*)) over (), 6) as customer_share
         from rule_segments group by segment""",
)
def segment_profile(t: Tables):
    return rounded(kpi.segment_profile(rule_segments(t.imputed_v1)))


_CLUSTER_PROFILE = """select (customer_id % 4)::int as cluster_id, count(*) as customers,
               avg(visit_count) as avg_visits, avg(unique_vehicles) as avg_unique_vehicles,
               avg(avg_delay_hours) as avg_delay_hours, avg(delay_rate) as delay_rate,
               avg(avg_csat) as avg_csat, avg(complaint_rate) as complaint_rate,
               avg(service_type_count) as avg_service_types,
               avg(recency_days) as avg_recency_days,
               count(*) * 100.0 / sum(count(*)) over () as customer_percentage
         from imputed_v2 group by 1"""


@query(
    "agg11_cluster_profile",
    with_roles("imputed_v2")
    + f""", p as ({_CLUSTER_PROFILE})
         select cluster_id, customers, round(avg_visits, 6) as avg_visits,
                round(avg_unique_vehicles, 6) as avg_unique_vehicles,
                round(avg_delay_hours, 6) + 0.0 as avg_delay_hours, round(delay_rate, 6) as delay_rate,
                round(avg_csat, 6) as avg_csat, round(complaint_rate, 6) as complaint_rate,
                round(avg_service_types, 6) as avg_service_types,
                round(avg_recency_days, 6) as avg_recency_days,
                round(customer_percentage, 6) as customer_percentage
         from p""",
)
def cluster_profile(t: Tables):
    return rounded(kpi.cluster_profile(pseudo_clusters(t)))


def pseudo_clusters(t: Tables):
    """Imputed customer features with a cluster derived from the key."""
    return t.imputed_v2.withColumn("cluster_id", (F.col("customer_id") % 4).cast("int"))


def scored_lines(t: Tables):
    """Line items as scored rows: a risk, a verdict and an outcome from given columns."""
    risk = F.col("l_quantity") / 50
    return t.given("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        risk.alias("delay_probability"),
        (risk > 0.5).cast("int").alias("predicted_delayed"),
        (F.col("l_returnflag") == "R").cast("int").alias("actual_delayed"),
        risk_band(risk).alias("risk_band"),
    )


SCORED_SQL = """scored as (select l_orderkey, l_linenumber, l_quantity / 50 as delay_probability,
            (l_quantity / 50 > 0.5)::int as predicted_delayed,
            (l_returnflag = 'R')::int as actual_delayed,
            case when l_quantity / 50 <= 0.3 then 'Low Risk'
                 when l_quantity / 50 <= 0.6 then 'Medium Risk' else 'High Risk' end as risk_band
     from lineitem)
"""


@query(
    "agg12_band_summary",
    "with " + SCORED_SQL
    + """select risk_band, count(*) as visits, round(avg(actual_delayed), 6) as actual_delay_rate,
               round(avg(delay_probability), 6) as avg_predicted_probability
         from scored group by risk_band""",
)
def band_summary(t: Tables):
    return rounded(kpi.band_summary(scored_lines(t)))


def experiment_rows(t: Tables):
    """Visits in two hash-assigned groups with their observed outcomes."""
    visits = t.visits.select("visit_id", F.col("delay_flag").alias("final_delay_flag"))
    surveys = t.surveys.select("visit_id", "csat_score", "complaint_flag")
    return assign(visits.join(surveys, "visit_id", "left"), "visit_id", "ab")


EXPERIMENT_SQL = with_roles("visits", "surveys") + """, experiment as (
  select v.visit_id, v.delay_flag as final_delay_flag, s.csat_score, s.complaint_flag,
         case when ('0x' || substr(md5('ab:' || v.visit_id), 1, 8))::ubigint / 4294967296.0 < 0.5
              then 'Control' else 'Treatment' end as experiment_group
  from visits v left join surveys s on v.visit_id = s.visit_id)
"""


@query(
    "agg13_group_summary",
    EXPERIMENT_SQL
    + """select experiment_group, count(*) as customers,
               round(avg(final_delay_flag), 6) as delay_rate, round(avg(csat_score), 6) as avg_csat,
               round(avg(complaint_flag), 6) as complaint_rate
         from experiment group by experiment_group""",
)
def group_summary(t: Tables):
    return rounded(kpi.group_summary(experiment_rows(t), GROUP))


@query(
    "agg14_frequency",
    """select event_type, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share
       from events group by event_type""",
)
def frequency(t: Tables):
    return rounded(kpi.frequency(t.given("events"), "event_type", normalize=True))


@query(
    "agg15_contingency",
    """select o_orderpriority, o_orderstatus, count(o_orderkey) as n
       from (select distinct o_orderpriority from orders) a
       cross join (select distinct o_orderstatus from orders) b
       left join orders using (o_orderpriority, o_orderstatus)
       group by 1, 2""",
)
def contingency(t: Tables):
    return kpi.contingency(t.given("orders"), "o_orderpriority", "o_orderstatus")


@query(
    "agg15_contingency_wide",
    """select o_orderpriority, count_if(o_orderstatus = 'F')::bigint as "F",
              count_if(o_orderstatus = 'O')::bigint as "O",
              count_if(o_orderstatus = 'P')::bigint as "P",
              count_if(o_orderstatus = 'X')::bigint as "X"
       from orders group by 1""",
)
def contingency_wide(t: Tables):
    return kpi.contingency_wide(
        t.given("orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P", "X"]
    )


@query(
    "agg16_quantiles",
    """select 'l_extendedprice' as metric, p, round(case p when 0.1 then quantile_cont(l_extendedprice, 0.1)
                when 0.25 then quantile_cont(l_extendedprice, 0.25)
                when 0.75 then quantile_cont(l_extendedprice, 0.75)
                else quantile_cont(l_extendedprice, 0.99) end, 6) as value
       from lineitem, (values (0.1::double), (0.25), (0.75), (0.99)) q(p) group by p
       union all
       select 'l_quantity', p, round(case p when 0.1 then quantile_cont(l_quantity, 0.1)
                when 0.25 then quantile_cont(l_quantity, 0.25)
                when 0.75 then quantile_cont(l_quantity, 0.75)
                else quantile_cont(l_quantity, 0.99) end, 6)
       from lineitem, (values (0.1::double), (0.25), (0.75), (0.99)) q(p) group by p""",
)
def quantile_table(t: Tables):
    return rounded(
        quantiles(
            t.given("lineitem"), ["l_quantity", "l_extendedprice"], [0.1, 0.25, 0.75, 0.99]
        )
    )


@query(
    "agg16_sketch_quantiles",
    """select l_returnflag, metric, p, true as within
       from (select distinct l_returnflag from lineitem where l_returnflag is not null),
            (values ('l_quantity'), ('l_extendedprice')) m(metric), (values (0.1::double), (0.5), (0.9)) q(p)""",
)
def sketch_quantile_table(t: Tables):
    """Approximate quantiles per group; their values have the wanted rank within the stated error."""
    lines = t.given("lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    metrics = ["l_quantity", "l_extendedprice"]
    found = sketches.sketch_quantiles(lines, metrics, [0.1, 0.5, 0.9], ["l_returnflag"])
    long = lines.unpivot(["l_returnflag"], metrics, "metric", "x")
    # a handful of quantiles per group and metric
    shares = long.join(found, ["l_returnflag", "metric"]).groupBy("l_returnflag", "metric", "p").agg(
        F.avg((F.col("x") < F.col("value")).cast("int")).alias("low"),
        F.avg((F.col("x") <= F.col("value")).cast("int")).alias("high"),
    )
    error = F.lit(sketches.rank_error())
    within = (F.col("low") <= F.col("p") + error) & (F.col("high") >= F.col("p") - error)
    return shares.select("l_returnflag", "metric", "p", within.alias("within"))


@query(
    "agg17_median",
    """select l_returnflag, round(median(l_extendedprice), 6) as l_extendedprice,
              median(l_quantity) as l_quantity
       from lineitem group by l_returnflag""",
)
def median(t: Tables):
    lines = t.given("lineitem")
    return rounded(median_of(lines, ["l_extendedprice", "l_quantity"], ["l_returnflag"]))


@query(
    "agg18_distinct_count",
    """select 'o_custkey' as "column", count(distinct o_custkey) as unique_count from orders
       union all select 'o_orderstatus', count(distinct o_orderstatus) from orders
       union all select 'o_orderdate', count(distinct o_orderdate) from orders""",
)
def distinct_count(t: Tables):
    return kpi.n_unique(t.given("orders"), ["o_custkey", "o_orderstatus", "o_orderdate"])


@query(
    "agg18_approx_distinct",
    """select 'o_custkey' as "column", true as within from orders union select 'o_orderstatus', true from orders
       union select 'o_orderdate', true from orders""",
)
def approx_distinct(t: Tables):
    """Sketched distinct counts against the exact ones, within three standard deviations."""
    columns, rsd = ["o_custkey", "o_orderstatus", "o_orderdate"], 0.01
    exact = kpi.n_unique(t.given("orders"), columns)
    found = kpi.n_unique(t.given("orders"), columns, rsd).withColumnRenamed("unique_count", "estimate")
    off = F.abs(F.col("estimate") - F.col("unique_count"))
    return exact.join(found, "column").select("column", (off <= F.ceil(3 * rsd * F.col("unique_count"))).alias("within"))


@query("agg19_labels", "select distinct p_type from part order by p_type")
def labels(t: Tables):
    return kpi.labels(t.given("part"), "p_type")


@query(
    "agg20_table_sizes",
    """select 'orders' as "table", count(*) as row_count, 6 as column_count from orders
       union all select 'customer', count(*), 5 from customer
       union all select 'events', count(*), 6 from events
       union all select 'lineitem', count(*), 11 from lineitem
       union all select 'region', count(*), 2 from region
       union all select 'nation', count(*), 3 from nation
       union all select 'supplier', count(*), 4 from supplier
       union all select 'part', count(*), 6 from part""",
)
def table_sizes(t: Tables):
    return quality.table_sizes(
        {
            n: t.given(n)
            for n in "orders customer events lineitem region nation supplier part".split()
        }
    )


@query(
    "agg21_spread",
    """select event_type, count(value) as n, round(var_samp(value), 6) as variance,
              round(stddev_samp(value), 6) as sd
       from events group by event_type""",
)
def spread(t: Tables):
    return rounded(kpi.spread(t.given("events"), "event_type", "value"))


@query(
    "agg22_kpi_cube",
    with_roles("base", "dealers")
    + """, fact as (select base.*, d.region from base left join dealers d using (dealer_id))
         select region, service_type, grouping_id(region, service_type)::bigint as grouping_level,
                count(*) as total_visits, sum(delayed::int)::bigint as delayed_visits,
                round(avg(delayed::int), 8) as delay_rate,
                round(avg(delay_hours), 8) + 0.0 as avg_delay_hours, round(avg(csat_score), 8) as avg_csat,
                round(avg(complaint_flag), 8) as complaint_rate,
                round(avg(first_time_fix_flag), 8) as first_time_fix_rate,
                count(distinct customer_id) as unique_customers,
                round(count(*) / count(distinct customer_id), 8) as visits_per_customer,
                sum((delay_hours >= 4)::int)::bigint as severe_delays
         from fact group by cube (region, service_type)""",
)
def kpi_cube(t: Tables):
    dealers = t.dealers.select("dealer_id", "region")
    fact = marts.business_flags(t.base.join(dealers, "dealer_id", "left"))
    return rounded(kpi.kpi_cube(fact, ["region", "service_type"]), 8)
