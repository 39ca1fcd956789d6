"""Segmentation by rules and by clusters (SEG)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.operators import clustering, segments
from bayline.operators.kpi import cluster_profile, segment_profile
from bayline.operators.silhouette import euclidean_silhouette
from bayline.plans.binding import Tables, with_roles
from bayline.plans.queries.kpis import pseudo_clusters
from bayline.plans.registry import query, rounded
from bayline.sources.sinks import stage


def _text(mapping) -> str:
    """A mapping as rows of a VALUES list."""
    return ", ".join(f"('{key}', '{value}')" for key, value in mapping.items())


@query(
    "seg1_rule_segments",
    with_roles("rule_segments") + "select customer_id, segment from rule_segments",
)
def rule_segments(t: Tables):
    return segments.rule_segments(t.imputed_v1).select("customer_id", "segment")


_PROFILE_SQL = """profile as (
  select segment, count(*) as customers, avg(total_visits) as avg_visits,
         avg(avg_delay_hours) as avg_delay_hours, avg(delay_rate) as delay_rate,
         avg(avg_csat) as avg_csat, avg(complaint_rate) as complaint_rate,
         count(*) / sum(count(*)) over () as customer_share
  from rule_segments group by segment)
"""


@query(
    "seg2_segment_report",
    with_roles("rule_segments") + "," + _PROFILE_SQL
    + f""", actions(segment, business_strategy) as (values {_text(segments.RULE_STRATEGIES)})
         select segment, customers, round(avg_visits, 6) as avg_visits,
                round(avg_delay_hours, 6) + 0.0 as avg_delay_hours, round(delay_rate, 6) as delay_rate,
                round(avg_csat, 6) as avg_csat, round(complaint_rate, 6) as complaint_rate,
                round(customer_share, 6) as customer_share, business_strategy
         from profile left join actions using (segment)""",
)
def segment_report(t: Tables):
    return rounded(segments.segment_report(segments.rule_segments(t.imputed_v1)))


@query(
    "seg3_at_risk_list",
    with_roles("rule_segments")
    + """select customer_id, round(complaint_rate, 6) as complaint_rate,
               round(delay_rate, 6) as delay_rate, round(avg_csat, 6) as avg_csat
         from rule_segments where segment = 'At-Risk'""",
)
def at_risk_list(t: Tables):
    listed = segments.at_risk_list(segments.rule_segments(t.imputed_v1))
    return rounded(listed.select("customer_id", "complaint_rate", "delay_rate", "avg_csat"))


@query(
    "seg4_key_findings",
    with_roles("rule_segments") + "," + _PROFILE_SQL
    + """select 'Largest segment' as finding,
               (select segment from profile order by customers desc, segment limit 1) as segment
         union all select 'Highest complaint segment',
               (select segment from profile order by complaint_rate desc, segment limit 1)
         union all select 'Highest delay-rate segment',
               (select segment from profile order by delay_rate desc, segment limit 1)""",
)
def key_findings(t: Tables):
    return segments.key_findings(segment_profile(segments.rule_segments(t.imputed_v1)))


_SCALED = ("visit_count", "avg_delay_hours", "recency_days")


@query(
    "seg5_standardize",
    with_roles("imputed_v2")
    + "select customer_id, "
    + ", ".join(
        f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) + 0.0 as {c}" for c in _SCALED
    )
    + ", 0.0::double as flat from imputed_v2",
)
def standardize(t: Tables):
    """Three features and a constant column, whose deviation counts as 1."""
    columns = t.imputed_v2.select("customer_id", *_SCALED).withColumn("flat", F.lit(3.0))
    scaled = clustering.standardize(columns, [*_SCALED, "flat"])
    return rounded(scaled)


@query("seg6_kmeans")
def kmeans(t: Tables):
    clustered = clustering.kmeans_fit(t.imputed_v2, "customer_id", clustering.FEATURES_V1)
    return cluster_profile(clustered)


@query("seg7_k_search")
def k_search(t: Tables):
    return clustering.k_search(t.imputed_v2, "customer_id", clustering.FEATURES_V1, range(2, 7))


@query("seg8_k_compare")
def k_compare(t: Tables):
    return clustering.k_search(t.imputed_v2, "customer_id", clustering.FEATURES_V2, [3, 4])


@query("seg9_kmeans_refined")
def kmeans_refined(t: Tables):
    clustered = clustering.kmeans_fit(t.imputed_v2, "customer_id", clustering.FEATURES_V2)
    return segments.with_actions(
        segments.name_clusters_v2(cluster_profile(clustered)), segments.CLUSTER_ACTIONS_V2
    )


def _corners(t: Tables):
    """Customers in four groups by their number, around the corners of a square, by two real rates."""
    return t.imputed_v2.withColumns(
        {
            "x": F.col("customer_id") % 2 * 10.0 + F.col("delay_rate"),
            "y": F.floor(F.col("customer_id") % 4 / 2) * 10.0 + F.col("complaint_rate"),
        }
    )


@query(
    "seg6_corner_clusters",
    with_roles("imputed_v2")
    + """select customer_id, min(customer_id) over (partition by customer_id % 4) as first_customer,
               count(*) over (partition by customer_id % 4) as customers
         from imputed_v2""",
)
def corner_clusters(t: Tables):
    """Each customer with the first customer and the size of its cluster."""
    clustered = clustering.kmeans_fit(_corners(t), "customer_id", ["x", "y"])
    sizes = clustered.groupBy("cluster_id").agg(
        F.min("customer_id").alias("first_customer"), F.count(F.lit(1)).alias("customers")
    )
    # one row per cluster
    return clustered.join(F.broadcast(sizes), "cluster_id").select(
        "customer_id", "first_customer", "customers"
    )


PSEUDO_SQL = with_roles("imputed_v2") + """, clusters as (
  select *, (customer_id % 4)::int as cluster_id from imputed_v2),
profile as (
  select cluster_id, count(*) as customers, avg(visit_count) as avg_visits,
         avg(delay_rate) as delay_rate, avg(avg_csat) as avg_csat
  from clusters group by cluster_id)
"""

NAMED_V1_SQL = """, winners as (
  select (select cluster_id from profile order by delay_rate desc, cluster_id limit 1) as late,
         (select cluster_id from profile order by avg_csat desc, cluster_id limit 1) as content,
         (select cluster_id from profile order by avg_visits desc, cluster_id limit 1) as busy),
named as (
  select p.*, case when cluster_id = late then 'Delay-Sensitive Customers'
                   when cluster_id = content then 'Satisfied Loyal Customers'
                   when cluster_id = busy then 'High-Engagement Customers'
                   else 'Occasional Customers' end as segment_name
  from profile p, winners)
"""

NAMED_V2_SQL = """, first as (
  select cluster_id as satisfied from profile order by avg_csat desc, delay_rate, cluster_id limit 1),
second as (
  select cluster_id as risky from profile where cluster_id <> (select satisfied from first)
  order by delay_rate desc, avg_csat, cluster_id limit 1),
third as (
  select cluster_id as engaged from profile
  where cluster_id not in (select satisfied from first union all select risky from second)
  order by avg_visits desc, cluster_id limit 1),
named as (
  select p.*, case when cluster_id = (select satisfied from first)
                     then 'Satisfied / Stable Customers'
                   when cluster_id = (select risky from second) then 'High-Risk Delay Customers'
                   when cluster_id = (select engaged from third) then 'Highly Engaged Customers'
                   else 'At-Risk Experience Customers' end as segment_name
  from profile p)
"""


@query(
    "seg10_cluster_names_v1",
    PSEUDO_SQL + NAMED_V1_SQL + "select cluster_id, customers, segment_name from named",
)
def cluster_names_v1(t: Tables):
    named = segments.name_clusters_v1(cluster_profile(pseudo_clusters(t)))
    return named.select("cluster_id", "customers", "segment_name")


@query(
    "seg11_cluster_names_v2",
    PSEUDO_SQL + NAMED_V2_SQL + "select cluster_id, customers, segment_name from named",
)
def cluster_names_v2(t: Tables):
    named = segments.name_clusters_v2(cluster_profile(pseudo_clusters(t)))
    return named.select("cluster_id", "customers", "segment_name")


def _labelled_sql(actions) -> str:
    return f""", actions(segment_name, recommended_action) as (values {_text(actions)})
         select c.customer_id, c.cluster_id, n.segment_name, a.recommended_action
         from clusters c join named n using (cluster_id) left join actions a using (segment_name)"""


@query(
    "seg12_labelled_customers",
    PSEUDO_SQL + NAMED_V2_SQL + _labelled_sql(segments.CLUSTER_ACTIONS_V2),
)
def labelled_customers(t: Tables):
    clusters = pseudo_clusters(t)
    named = segments.name_clusters_v2(cluster_profile(clusters))
    labelled = segments.label_customers(clusters, named, segments.CLUSTER_ACTIONS_V2)
    return labelled.select("customer_id", "cluster_id", "segment_name", "recommended_action")


@query(
    "seg12_labelled_customers_v1",
    PSEUDO_SQL + NAMED_V1_SQL + _labelled_sql(segments.CLUSTER_ACTIONS_V1),
)
def labelled_customers_v1(t: Tables):
    clusters = pseudo_clusters(t)
    named = segments.name_clusters_v1(cluster_profile(clusters))
    labelled = segments.label_customers(clusters, named, segments.CLUSTER_ACTIONS_V1)
    return labelled.select("customer_id", "cluster_id", "segment_name", "recommended_action")


@query(
    "seg9_corner_segments",
    PSEUDO_SQL + NAMED_V2_SQL
    + f""", actions(segment_name, recommended_action) as (values {_text(segments.CLUSTER_ACTIONS_V2)})
         select customers, round(avg_visits, 6) as avg_visits, round(delay_rate, 6) as delay_rate,
                round(avg_csat, 6) as avg_csat, segment_name, recommended_action
         from named left join actions using (segment_name)""",
)
def corner_segments(t: Tables):
    clustered = clustering.kmeans_fit(_corners(t), "customer_id", ["x", "y"])
    named = segments.name_clusters_v2(cluster_profile(clustered))
    return rounded(
        segments.with_actions(named, segments.CLUSTER_ACTIONS_V2).select(
            "customers", "avg_visits", "delay_rate", "avg_csat", "segment_name", "recommended_action"
        )
    )


# the check forms every pair of rows, which the query never does
_DISTANCES_SQL = """
dist as (select a.id, a.label, b.label as other,
                sum(list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) ^ 2)))
                  as total, count(*) as n
         from points a, points b group by a.id, a.label, b.label),
parts as (select id, max(case when label = other then n end) as own_n,
                 max(case when label = other then total / nullif(n - 1, 0) end) as a,
                 min(case when label <> other then total / n end) as b
          from dist group by id)
"""
_SCORE_SQL = "round(avg(case when own_n = 1 then 0 else (b - a) / greatest(a, b) end), 6) as silhouette_score"
_EUCLIDEAN_SQL = _DISTANCES_SQL.replace("sum(list_sum(", "sum(sqrt(list_sum(").replace("^ 2)))", "^ 2))))")
_SILHOUETTE_SQL = _DISTANCES_SQL + f"select count(*) as n, {_SCORE_SQL} from parts"

_CORNER_SEARCH_SQL = (
    with_roles("imputed_v2")
    + """, corners as (
  select customer_id, 10.0 * (customer_id % 2) + delay_rate as x,
         10.0 * (customer_id % 4 // 2) + complaint_rate as y from imputed_v2),
points as (
  select customer_id as id, customer_id % 4 as label,
         [(x - avg(x) over ()) / stddev_pop(x) over (), (y - avg(y) over ()) / stddev_pop(y) over ()]::double[] as x
  from corners),"""
    + _DISTANCES_SQL
    + f"select 4::int as k, {_SCORE_SQL}, true as best from parts"
)


@query("seg7_corner_search", _CORNER_SEARCH_SQL)
def corner_search(t: Tables):
    """The best number of clusters, of two to six, for the four groups."""
    found = clustering.k_search(_corners(t), "customer_id", ["x", "y"], range(2, 7))
    return rounded(found.filter("best"))


@query("seg8_corner_compare", _CORNER_SEARCH_SQL)
def corner_compare(t: Tables):
    found = clustering.k_search(_corners(t), "customer_id", ["x", "y"], [3, 4])
    return rounded(found.filter("best"))


@query(
    "seg13_silhouette",
    """with points as (select vec_id as id, label, embedding::double[] as x from embeddings
                    where embedding is not null and label is not null),"""
    + _SILHOUETTE_SQL,
)
def silhouette(t: Tables):
    return rounded(clustering.silhouette(t.given("embeddings"), "embedding", "label"))


@query(
    "seg13_segment_silhouette",
    with_roles("rule_segments")
    + """, points as (select customer_id as id, segment as label,
                [total_visits / 10, avg_delay_hours, avg_csat]::double[] as x
           from rule_segments),"""
    + _SILHOUETTE_SQL,
)
def segment_silhouette(t: Tables):
    """How well the rule segments separate three customer features."""
    customers = stage(segments.rule_segments(t.imputed_v1), "segments")
    vector = F.array(F.col("total_visits") / 10, "avg_delay_hours", "avg_csat")
    return rounded(clustering.silhouette(customers.withColumn("x", vector), "x", "segment"))


_EMBEDDINGS_SQL = """with points as (select vec_id as id, label, embedding::double[] as x from embeddings
                    where embedding is not null and label is not null),"""


@query(
    "seg13_euclidean_silhouette",
    _EMBEDDINGS_SQL + _EUCLIDEAN_SQL + f"select count(*) as n, {_SCORE_SQL}, 0.0::double as standard_error from parts",
)
def plain_silhouette(t: Tables):
    """Silhouette of the given labels in plain Euclidean distance, over all pairs of vectors."""
    return rounded(euclidean_silhouette(t.given("embeddings"), "embedding", "label"))


@query(
    "seg13_sampled_silhouette",
    _EMBEDDINGS_SQL + _EUCLIDEAN_SQL + f"select count(*) as n, {_SCORE_SQL}, true as within from parts",
)
def sampled_silhouette(t: Tables):
    """A fifth of the vectors against all: the mean lies within five standard errors of the exact one."""
    vectors = t.given("embeddings")
    exact = euclidean_silhouette(vectors, "embedding", "label")
    found = euclidean_silhouette(vectors, "embedding", "label", sample=0.2)
    found = found.select("n", F.col("silhouette_score").alias("estimate"), F.col("standard_error").alias("error"))
    within = F.abs(F.col("estimate") - F.col("silhouette_score")) <= 5 * F.col("error")
    return rounded(exact.join(found, "n").select("n", "silhouette_score", within.alias("within")))


_EUCLIDEAN_SEARCH_SQL = _CORNER_SEARCH_SQL.replace(_DISTANCES_SQL, _EUCLIDEAN_SQL)


@query("seg7_euclidean_search", _EUCLIDEAN_SEARCH_SQL)
def euclidean_search(t: Tables):
    """The best number of clusters, of two to five, by the plain silhouette."""
    found = clustering.k_search(_corners(t), "customer_id", ["x", "y"], range(2, 6), restarts=4, distance="euclidean")
    return rounded(found.filter("best"))


@query("seg8_euclidean_compare", _EUCLIDEAN_SEARCH_SQL)
def euclidean_compare(t: Tables):
    found = clustering.k_search(_corners(t), "customer_id", ["x", "y"], [3, 4], restarts=4, distance="euclidean")
    return rounded(found.filter("best"))
