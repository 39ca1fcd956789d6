"""Rule-based segments, cluster names and segment reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.functions.flags import first_match, lookup_label
from bayline.operators.joins import attach_agg
from bayline.operators.kpi import segment_profile
from bayline.operators.ordering import priority_list
from bayline.operators.quantiles import quantiles_wide, scalar_row

# fixed values: segment names of the rules, and the strategy of each
AT_RISK = "At-Risk"
LOYAL = "Loyal / Satisfied"
HIGH_NEED = "High-Service-Need"
OCCASIONAL = "Occasional / Low-Engagement"
RULE_STRATEGIES = {
    "Loyal / Satisfied": "Maintain service quality and encourage retention",
    "At-Risk": "Prioritize proactive communication and service recovery",
    "High-Service-Need": "Focus on appointment efficiency and preventive service planning",
    "Occasional / Low-Engagement": "Improve engagement and provide relevant service reminders",
}

# fixed values: cluster names of the first segmentation, and the action of each
CLUSTER_NAMES_V1 = (
    "Delay-Sensitive Customers",
    "Satisfied Loyal Customers",
    "High-Engagement Customers",
    "Occasional Customers",
)
CLUSTER_ACTIONS_V1 = {
    "Delay-Sensitive Customers": "Prioritize proactive delay communication, "
    "appointment monitoring, and recovery outreach.",
    "Satisfied Loyal Customers": "Maintain service quality and encourage "
    "retention, repeat service, and advocacy.",
    "High-Engagement Customers": "Use personalized service reminders, "
    "maintenance recommendations, and loyalty messaging.",
    "Occasional Customers": "Use targeted reminders and service education "
    "to increase repeat engagement.",
}

# fixed values: cluster names of the refined segmentation, and the action of each
SATISFIED = "Satisfied / Stable Customers"
HIGH_RISK = "High-Risk Delay Customers"
ENGAGED = "Highly Engaged Customers"
AT_RISK_EXPERIENCE = "At-Risk Experience Customers"
CLUSTER_ACTIONS_V2 = {
    "Satisfied / Stable Customers": "Maintain service quality and encourage retention and advocacy.",
    "High-Risk Delay Customers": "Prioritize proactive delay alerts, appointment monitoring, "
    "and service recovery.",
    "Highly Engaged Customers": "Use personalized maintenance reminders and loyalty-oriented "
    "service communications.",
    "At-Risk Experience Customers": "Target complaint prevention, service education, and "
    "experience improvement.",
}


def segment_thresholds(customers: DataFrame) -> DataFrame:
    """Population quartiles that the rules compare with, one row."""
    return quantiles_wide(
        customers,
        {
            "high_delay": ("delay_rate", 0.75),
            "low_delay": ("delay_rate", 0.25),
            "high_complaint": ("complaint_rate", 0.75),
            "high_csat": ("avg_csat", 0.75),
            "low_csat": ("avg_csat", 0.25),
            "high_visits": ("total_visits", 0.75),
        },
    )


def rule_segments(customers: DataFrame) -> DataFrame:
    """Add the segment of each customer; an earlier rule wins over a later one."""
    t = F.col("_t")
    csat, delay = F.col("avg_csat"), F.col("delay_rate")
    poor = (csat <= t["low_csat"]) & (
        (delay >= t["high_delay"]) | (F.col("complaint_rate") >= t["high_complaint"])
    )
    content = (csat >= t["high_csat"]) & (delay <= t["low_delay"])
    frequent = F.col("total_visits") >= t["high_visits"]
    segment = first_match([(poor, AT_RISK), (content, LOYAL), (frequent, HIGH_NEED)], OCCASIONAL)
    return (
        customers.withColumn("_t", scalar_row(segment_thresholds(customers)))
        .withColumn("segment", segment)
        .drop("_t")
    )


def mapping_table(df: DataFrame, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A literal mapping as a table."""
    rows = F.array(
        *[F.struct(F.lit(k).alias(key), F.lit(v).alias(value)) for k, v in mapping.items()]
    )
    return df.sparkSession.range(1).select(F.inline(rows))


def segment_report(
    customers: DataFrame, actions: Mapping[str, str] = RULE_STRATEGIES
) -> DataFrame:
    profile = segment_profile(customers)
    return attach_agg(
        profile, mapping_table(profile, actions, "segment", "business_strategy"), "segment"
    )


def at_risk_list(customers: DataFrame) -> DataFrame:
    """At-risk customers, the most pressing first."""
    return priority_list(
        customers.filter(F.col("segment") == AT_RISK),
        [("complaint_rate", "desc"), ("delay_rate", "desc"), ("avg_csat", "asc")],
        "customer_id",
    )


def _best(metric: str, way: str, *more: tuple[str, str], among: Column | None = None) -> Column:
    """Row number by the metrics, key last, over a profile table."""
    order = [F.col(c).desc() if w == "desc" else F.col(c).asc() for c, w in ((metric, way), *more)]
    if among is not None:
        order = [F.coalesce(among, F.lit(False)).desc(), *order]
    return F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))


def key_findings(profile: DataFrame, by: str = "segment") -> DataFrame:
    """Largest segment, highest complaint rate and highest delay rate: (finding, segment)."""
    findings = (
        ("Largest segment", "customers"),
        ("Highest complaint segment", "complaint_rate"),
        ("Highest delay-rate segment", "delay_rate"),
    )
    ranked = profile.withColumns(
        {f"_r{i}": _best(metric, "desc", (by, "asc")) for i, (_, metric) in enumerate(findings)}
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("finding"),
                F.when(F.col(f"_r{i}") == 1, F.col(by)).alias(by),
            )
            for i, (name, _) in enumerate(findings)
        ]
    )
    return ranked.select(F.inline(rows)).filter(F.col(by).isNotNull())


def name_clusters_v1(profile: DataFrame, by: str = "cluster_id") -> DataFrame:
    """Names by the largest delay rate, then satisfaction, then visits.

    A cluster that already won an earlier title keeps it, and the later title goes to nobody.
    """
    titles = ("delay_rate", "avg_csat", "avg_visits")
    ranked = profile.withColumns(
        {f"_r{i}": _best(m, "desc", (by, "asc")) for i, m in enumerate(titles)}
    )
    *won, default = CLUSTER_NAMES_V1
    cases = [(F.col(f"_r{i}") == 1, name) for i, name in enumerate(won)]
    return ranked.withColumn("segment_name", first_match(cases, default)).drop(
        *[f"_r{i}" for i in range(len(titles))]
    )


def name_clusters_v2(profile: DataFrame, by: str = "cluster_id") -> DataFrame:
    """Names by ranked rules; a named cluster is out of the running for later names."""
    rules = (
        (SATISFIED, (("avg_csat", "desc"), ("delay_rate", "asc"))),
        (HIGH_RISK, (("delay_rate", "desc"), ("avg_csat", "asc"))),
        (ENGAGED, (("avg_visits", "desc"),)),
    )
    named = profile.withColumn("segment_name", F.lit(None).cast("string"))
    for name, order in rules:
        free = F.col("segment_name").isNull()
        first = _best(*order[0], *order[1:], (by, "asc"), among=free)
        named = named.withColumn("_r", first).withColumn(
            "segment_name",
            F.when(free & (F.col("_r") == 1), F.lit(name)).otherwise(F.col("segment_name")),
        )
    return named.drop("_r").fillna({"segment_name": AT_RISK_EXPERIENCE})


def with_actions(named: DataFrame, actions: Mapping[str, str]) -> DataFrame:
    return named.withColumn("recommended_action", lookup_label(F.col("segment_name"), actions))


def label_customers(
    customers: DataFrame, named: DataFrame, actions: Mapping[str, str], by: str = "cluster_id"
) -> DataFrame:
    """Segment name and recommended action on every customer.

    ``named`` has one row per cluster, as many as the k of a clustering, so it is broadcast
    and the customers are not shuffled on a few cluster numbers.
    """
    labels = with_actions(named, actions).select(by, "segment_name", "recommended_action")
    return attach_agg(customers, F.broadcast(labels), by)
