"""Profile, rules, relationships and gate (DQ)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from bayline.operators import quality, sketches
from bayline.operators.quality import Rule, domain_rule, label_rule, order_rule, range_rule
from bayline.operators.quantiles import scalar_row
from bayline.plans.binding import CATEGORY_FIXES, GIVEN_SCHEMAS, Tables, with_roles
from bayline.plans.registry import query
from bayline.session import scratch_dir
from bayline.sources.schemas import PRIMARY_KEYS, RELATIONSHIPS
from bayline.sources.sinks import stage

# fixed values: names, severities and actions of the issues in the reports
HIGH_ACTION = "Remove invalid records"

RULES: list[Rule] = [
    order_rule(
        "appointments",
        "appointment_date",
        "booking_date",
        "<",
        "Appointment Before Booking",
        "Remove invalid appointment records",
    ),
    order_rule(
        "service_visits",
        "service_start_time",
        "completion_time",
        ">",
        "Start After Completion",
        "Remove or investigate invalid service records",
    ),
    order_rule(
        "parts",
        "part_received_date",
        "part_order_date",
        "<",
        "Parts Received Before Ordered",
        "Remove or correct invalid dates",
    ),
    range_rule(
        "repairs",
        "actual_hours",
        "<",
        0,
        "Negative Duration",
        "Set invalid values to missing and investigate",
    ),
    range_rule(
        "repairs",
        "actual_hours",
        ">",
        24,
        "Extreme Outlier",
        "Treat extreme values as invalid/outliers",
        quality.MEDIUM,
    ),
    range_rule(
        "appointments",
        "scheduled_duration_hours",
        "<=",
        0,
        "Invalid Duration",
        "Remove invalid appointments",
    ),
    domain_rule(
        "customer_surveys",
        "csat_score",
        (1, 2, 3, 4, 5),
        "Invalid CSAT",
        "Set invalid values to missing",
    ),
    label_rule(
        "repairs",
        "repair_category",
        list(CATEGORY_FIXES),
        "Inconsistent Category Labels",
        "Standardize category labels",
    ),
]


def _pick(*issues: str) -> list[Rule]:
    return [rule for rule in RULES if rule.issue_type in issues]


def _issue_sql(table, column, issue, count, severity, action, always=False) -> str:
    guard = "" if always else " where affected_rows > 0"
    return f"""select * from (select '{table}' as "table", '{column}' as "column",
               '{issue}' as issue_type, ({count})::bigint as affected_rows,
               '{severity}' as severity, '{action}' as recommended_action){guard}"""


_ORDER_SQL = {
    "Appointment Before Booking": _issue_sql(
        "appointments",
        "appointment_date",
        "Appointment Before Booking",
        "select count(*) from full_appointments where appointment_date < booking_date",
        "High",
        "Remove invalid appointment records",
    ),
    "Start After Completion": _issue_sql(
        "service_visits",
        "service_start_time",
        "Start After Completion",
        "select count(*) from visits where service_start_time > completion_time",
        "High",
        "Remove or investigate invalid service records",
    ),
    "Parts Received Before Ordered": _issue_sql(
        "parts",
        "part_received_date",
        "Parts Received Before Ordered",
        "select count(*) from parts where part_received_date < part_order_date",
        "High",
        "Remove or correct invalid dates",
    ),
}
_RANGE_SQL = {
    "Negative Duration": _issue_sql(
        "repairs",
        "actual_hours",
        "Negative Duration",
        "select count(*) from repairs where actual_hours < 0",
        "High",
        "Set invalid values to missing and investigate",
    ),
    "Extreme Outlier": _issue_sql(
        "repairs",
        "actual_hours",
        "Extreme Outlier",
        "select count(*) from repairs where actual_hours > 24",
        "Medium",
        "Treat extreme values as invalid/outliers",
    ),
    "Invalid Duration": _issue_sql(
        "appointments",
        "scheduled_duration_hours",
        "Invalid Duration",
        "select count(*) from full_appointments where scheduled_duration_hours <= 0",
        "High",
        "Remove invalid appointments",
    ),
}
_DOMAIN_SQL = _issue_sql(
    "customer_surveys",
    "csat_score",
    "Invalid CSAT",
    "select count(*) from raw_surveys where csat_score not in (1, 2, 3, 4, 5)",
    "High",
    "Set invalid values to missing",
)
_LABEL_SQL = _issue_sql(
    "repairs",
    "repair_category",
    "Inconsistent Category Labels",
    "select count(*) from repairs where repair_category = 'R'",
    "Medium",
    "Standardize category labels",
    always=True,
)
RULE_SQL = "\nunion all ".join(
    [*_ORDER_SQL.values(), *_RANGE_SQL.values(), _DOMAIN_SQL, _LABEL_SQL]
)

# role of each raw table in the SQL checks
RAW_ROLES = {
    "customers": "raw_customers",
    "vehicles": "vehicles",
    "dealers": "raw_dealers",
    "appointments": "full_appointments",
    "service_visits": "visits",
    "repairs": "repairs",
    "parts": "parts",
    "customer_surveys": "raw_surveys",
}
CLEAN_ROLES = {
    "customers": "clean_customers",
    "vehicles": "clean_vehicles",
    "dealers": "raw_dealers",
    "appointments": "clean_appointments",
    "service_visits": "clean_visits",
    "repairs": "clean_repairs",
    "parts": "clean_parts",
    "customer_surveys": "clean_surveys",
}
RAW_WITH = with_roles(*RAW_ROLES.values())

_PROFILED = {
    "customers": "customer_id:bigint region:string customer_type:string account_balance:double",
    "vehicles": "vehicle_id:string customer_id:bigint part_id:bigint",
    "dealers": "dealer_id:bigint dealer_name:string region:string balance:double",
    "appointments": """appointment_id:bigint customer_id:bigint booking_date:timestamp_ntz
        service_type:string appointment_status:string dealer_id:bigint
        appointment_date:timestamp_ntz scheduled_duration_hours:double
        promised_completion:timestamp_ntz vehicle_id:string""",
    "service_visits": """visit_id:bigint appointment_id:bigint part_id:bigint dealer_id:bigint
        check_in_time:timestamp_ntz service_start_time:timestamp_ntz
        completion_time:timestamp_ntz promised_completion:timestamp_ntz visit_status:string
        actual_duration_hours:double scheduled_duration_hours:double delay_hours:double
        delay_flag:int first_time_fix_flag:int""",
    "repairs": """repair_id:bigint visit_id:bigint repair_category:string
        estimated_hours:double actual_hours:double repair_status:string""",
    "parts": """part_transaction_id:string repair_id:bigint part_id:bigint
        part_order_date:timestamp_ntz part_received_date:timestamp_ntz parts_delay_flag:int""",
    "customer_surveys": """survey_id:bigint visit_id:bigint survey_date:timestamp_ntz
        csat_score:double complaint_flag:int""",
}


def _profile_sql(table: str, columns: str) -> str:
    role = RAW_ROLES[table]
    rows = []
    for entry in columns.split():
        column, kind = entry.split(":")
        rows.append(
            f"""select '{table}' as "table", '{column}' as "column", '{kind}' as data_type,
                count(*) as row_count, count(*) - count({column}) as missing_count,
                round((count(*) - count({column})) * 100.0 / count(*), 2) as missing_pct,
                count(distinct {column}) as unique_count from {role}"""
        )
    return "\nunion all ".join(rows)


PROFILE_SQL = "\nunion all ".join(_profile_sql(t, c) for t, c in _PROFILED.items())


@query("dq1_profile", RAW_WITH + PROFILE_SQL)
def profile(t: Tables):
    return quality.profile(t.raw_layer)


_LOADS = 4
_SKETCHED = [f.split()[0] for f in GIVEN_SCHEMAS["lineitem"].split(", ")]
_PROBS = (0.05, 0.5, 0.95)


@query(
    "dq1_sketch_profile",
    "\nunion all ".join(
        f"""select 'lineitem' as "table", '{c}' as "column", count(*) as row_count, count(*) - count({c}) as missing_count,
                   count(distinct {c}) as unique_count, true as unique_within,
                   {"true" if dict(f.split() for f in GIVEN_SCHEMAS["lineitem"].split(", "))[c] not in ("STRING", "TIMESTAMP_NTZ") else "null::boolean"} as ranks_within
            from lineitem"""
        for c in _SKETCHED
    ),
)
def sketch_profile(t: Tables):
    """Sketches of four loads, one of them recorded twice, merged and held against the exact profile."""
    store = scratch_dir(t.spark, "sketches")
    lines = t.given("lineitem")
    for load in (*range(_LOADS), 1):
        rows = lines.filter(F.col("l_orderkey") % _LOADS == load)
        sketches.record(sketches.load_sketches(rows, "lineitem", f"load-{load}"), store)
    merged = stage(sketches.merged_profile(sketches.read_sketches(t.spark, store), _PROBS), "merged-profile")
    exact = quality.profile({"lineitem": lines}).select("table", "column", F.col("unique_count").alias("exact"))
    off = F.abs(F.col("unique_count") - F.col("exact"))
    rows = merged.join(exact, ["table", "column"])
    found = rows.join(_rank_errors(lines, merged), "column", "left")
    return found.select(
        "table",
        "column",
        "row_count",
        "missing_count",
        F.col("exact").alias("unique_count"),
        (off <= F.ceil(sketches.distinct_error() * F.col("exact"))).alias("unique_within"),
        (F.col("rank_error") <= sketches.rank_error()).alias("ranks_within"),
    )


def _rank_errors(df: DataFrame, merged: DataFrame) -> DataFrame:
    """column, largest distance between the probability of a quantile and the ranks of its value."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    values = merged.groupBy().pivot("column", numbers).agg(F.first("quantiles.value"))
    rows = df.withColumn("_values", scalar_row(values))
    shares = []
    for c in numbers:
        for i, p in enumerate(_PROBS):
            at = F.col("_values")[c][i]
            low, high = F.avg((F.col(c) < at).cast("int")), F.avg((F.col(c) <= at).cast("int"))
            shares.append(F.greatest(low - p, p - high, F.lit(0.0)).alias(f"{c}:{i}"))
    worst = [F.greatest(*[F.col(f"`{c}:{i}`") for i in range(len(_PROBS))]).alias(c) for c in numbers]
    return rows.agg(*shares).select(*worst).unpivot([], numbers, "column", "rank_error")


@query(
    "dq2_missing_issues",
    RAW_WITH
    + f""", profiled as ({PROFILE_SQL})
        select "table", "column", 'Missing Values' as issue_type,
               missing_count as affected_rows,
               case when missing_count / row_count > 0.05 then 'High' else 'Medium' end as severity,
               'Investigate and handle based on business meaning' as recommended_action
        from profiled where missing_count > 0""",
)
def missing_issues(t: Tables):
    return quality.missing_issues(quality.profile(t.raw_layer))


def _duplicate_sql(table: str, key: str) -> str:
    return _issue_sql(
        table,
        key,
        "Duplicate Primary Key",
        f"select coalesce(sum(n), 0) from (select count(*) as n from {RAW_ROLES[table]} "
        f"group by {key}) where n > 1",
        "High",
        "Remove duplicate records after investigation",
    )


DUPLICATE_SQL = "\nunion all ".join(_duplicate_sql(t, k) for t, k in PRIMARY_KEYS.items())


@query("dq3_duplicate_keys", RAW_WITH + DUPLICATE_SQL)
def duplicate_keys(t: Tables):
    return quality.duplicate_keys(t.raw_layer, PRIMARY_KEYS)


@query(
    "dq4_appointment_before_booking",
    with_roles("full_appointments") + _ORDER_SQL["Appointment Before Booking"],
)
def appointment_before_booking(t: Tables):
    return quality.rule_issues(t.raw, _pick("Appointment Before Booking"))


@query(
    "dq5_start_after_completion",
    with_roles("visits", "full_appointments")
    + _ORDER_SQL["Start After Completion"]
    + " union all "
    + _issue_sql(
        "appointments",
        "booking_date",
        "Booking After Appointment",
        "select count(*) from full_appointments where booking_date > appointment_date",
        "High",
        HIGH_ACTION,
    ),
)
def start_after_completion(t: Tables):
    """The visit rule finds nothing here and stays silent; the same rule finds bookings."""
    other = order_rule(
        "appointments",
        "booking_date",
        "appointment_date",
        ">",
        "Booking After Appointment",
        HIGH_ACTION,
    )
    return quality.rule_issues(t.raw, [*_pick("Start After Completion"), other])


@query(
    "dq6_received_before_ordered",
    with_roles("parts") + _ORDER_SQL["Parts Received Before Ordered"],
)
def received_before_ordered(t: Tables):
    return quality.rule_issues(t.raw, _pick("Parts Received Before Ordered"))


def _relation_sql(roles: dict, relation) -> str:
    child, fk, parent, pk = relation
    return f"""select '{child}' as child_table, '{fk}' as child_column,
               '{parent}' as parent_table, '{pk}' as parent_column,
               count({fk}) as keyed_rows,
               count_if({fk} in (select {pk} from {roles[parent]} where {pk} is not null))::bigint
                 as valid_rows
        from {roles[child]}"""


RELATIONS_SQL = "relations as (" + "\nunion all ".join(
    _relation_sql(RAW_ROLES, r) for r in RELATIONSHIPS
) + ")"
FK_SQL = """select child_table as "table", child_column as "column",
        'Invalid Foreign Key' as issue_type, keyed_rows - valid_rows as affected_rows,
        'High' as severity, 'Remove or correct orphan records' as recommended_action
 from relations where keyed_rows > valid_rows"""


@query("dq7_foreign_key_issues", RAW_WITH + ", " + RELATIONS_SQL + FK_SQL)
def foreign_key_issues(t: Tables):
    return quality.fk_issues(t.raw_layer, RELATIONSHIPS)


@query(
    "dq8_range_rules",
    with_roles("repairs", "full_appointments") + "\nunion all ".join(_RANGE_SQL.values()),
)
def range_rules(t: Tables):
    return quality.rule_issues(t.raw, _pick(*_RANGE_SQL))


@query("dq9_allowed_values", with_roles("raw_surveys") + _DOMAIN_SQL)
def allowed_values(t: Tables):
    return quality.rule_issues(t.raw, _pick("Invalid CSAT"))


@query("dq10_label_consistency", with_roles("repairs") + _LABEL_SQL)
def label_consistency(t: Tables):
    return quality.rule_issues(t.raw, _pick("Inconsistent Category Labels"))


def _missing_sql(columns_of: dict[str, tuple[str, ...]]) -> str:
    parts = []
    for table, columns in columns_of.items():
        for column in columns:
            parts.append(
                f"""select '{table}' as "table", '{column}' as "column",
                    'Missing Values' as issue_type, count(*) - count({column}) as affected_rows,
                    case when (count(*) - count({column})) / count(*) > 0.05
                         then 'High' else 'Medium' end as severity,
                    'Investigate and handle based on business meaning' as recommended_action
                    from {RAW_ROLES[table]}"""
            )
    return "select * from (" + "\nunion all ".join(parts) + ") where affected_rows > 0"


# columns in which values can be missing; in all others the report finds none
_NULLABLE = {
    "customers": ("customer_id",),
    "appointments": (
        "dealer_id",
        "vehicle_id",
        "appointment_date",
        "scheduled_duration_hours",
        "promised_completion",
    ),
    "customer_surveys": ("csat_score", "complaint_flag"),
}


@query(
    "dq11_quality_report",
    RAW_WITH
    + ", "
    + RELATIONS_SQL
    + f"""
      select *, 1 as rule_group from ({_missing_sql(_NULLABLE)})
      union all select *, 2 from ({DUPLICATE_SQL})
      union all select *, 3 from ({FK_SQL})
      union all select *, 4 from ({RULE_SQL})""",
)
def quality_report(t: Tables):
    return quality.quality_report(t.raw_layer, RULES, PRIMARY_KEYS, RELATIONSHIPS)


@query(
    "dq12_relationship_report",
    RAW_WITH
    + ", "
    + RELATIONS_SQL
    + """select child_table, child_column, parent_table, parent_column,
               round(coalesce(valid_rows * 100.0 / nullif(keyed_rows, 0), 100.0), 2)
                 as valid_relationship_pct
        from relations""",
)
def relationship_report(t: Tables):
    return quality.relationship_report(t.raw_layer, RELATIONSHIPS)


@query(
    "dq13_orphan_report",
    RAW_WITH
    + ", "
    + RELATIONS_SQL
    + """select child_table, child_column, parent_table, parent_column,
               keyed_rows - valid_rows as orphan_rows
        from relations""",
)
def orphan_report(t: Tables):
    return quality.orphan_report(t.raw_layer, RELATIONSHIPS)


@query(
    "dq14_integrity_gate",
    RAW_WITH
    + ", "
    + RELATIONS_SQL
    + """select child_table, child_column,
               round(valid_rows * 100.0 / keyed_rows, 2) as valid_relationship_pct
        from relations where round(valid_rows * 100.0 / keyed_rows, 2) < 100""",
)
def integrity_gate(t: Tables):
    """What the gate would stop on, before cleaning."""
    report = quality.relationship_report(t.raw_layer, RELATIONSHIPS)
    return quality.failed_relationships(report).select(
        "child_table", "child_column", "valid_relationship_pct"
    )


@query(
    "dq15_cleaning_summary",
    with_roles(*RAW_ROLES.values(), *CLEAN_ROLES.values())
    + "\nunion all ".join(
        f"""select '{name}' as "table", (select count(*) from {RAW_ROLES[name]}) as rows_before,
                   (select count(*) from {CLEAN_ROLES[name]}) as rows_after"""
        for name in CLEAN_ROLES
    ),
)
def cleaning_summary(t: Tables):
    return quality.cleaning_summary(t.raw, t.clean)


@query(
    "dq15_clean_integrity",
    with_roles(*CLEAN_ROLES.values())
    + ", relations as ("
    + "\nunion all ".join(_relation_sql(CLEAN_ROLES, r) for r in RELATIONSHIPS)
    + """) select child_table, child_column, parent_table, parent_column,
                round(coalesce(valid_rows * 100.0 / nullif(keyed_rows, 0), 100.0), 2)
                  as valid_relationship_pct
         from relations""",
)
def clean_integrity(t: Tables):
    """The relationship report after cleaning, which the gate lets pass."""
    report = quality.relationship_report(t.clean, RELATIONSHIPS)
    quality.assert_integrity(report)
    return report
