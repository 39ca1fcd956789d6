"""The given tables in the roles of the eight service tables.

Each role exists twice: as a DataFrame here, and as a named SQL subquery for the checks.
Nulls, orphans and rule violations follow from the data by fixed conditions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.functions.flags import in_domain, null_unless, nullable_flag, threshold_flag
from bayline.functions.scalars import add_time
from bayline.operators.cleaning import (
    COMPLAINT_MAX_CSAT,
    CSAT_VALUES,
    clean_appointments,
    clean_customers,
    clean_parts,
    clean_repairs,
    clean_surveys,
    clean_vehicles,
    clean_visits,
    keep_first,
)
from bayline.operators.features import (
    IMPUTE_V1,
    IMPUTE_V2,
    customer_rollup_v1,
    customer_rollup_v2,
    delay_category,
    delayed,
    impute_customers,
    parts_delay,
    recency,
    visit_base,
)
from bayline.operators.joins import attach_optional
from bayline.sources.sinks import stage

# schemas of the given tables: a declared schema saves the job that reads file footers
GIVEN_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}

# the label of the given tables that counts as a misspelling, and its standard form
CATEGORY_FIXES = {"R": "A"}

FIRST_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def repair_id() -> Column:
    """One number per order and line number, which run from 1 to 7."""
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


class Tables:
    """Given tables by name, and the roles built from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def given(self, name: str) -> DataFrame:
        schema = GIVEN_SCHEMAS[name]
        return self.spark.read.schema(schema).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def regions(self) -> DataFrame:
        nation, region = self.given("nation"), self.given("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", F.col("r_name").alias("region")
        )

    @cached_property
    def customers(self) -> DataFrame:
        return (
            self.given("customer")
            .join(self.regions, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                "region",
                F.col("c_mktsegment").alias("customer_type"),
                F.col("c_acctbal").alias("account_balance"),
            )
        )

    @cached_property
    def dealers(self) -> DataFrame:
        return (
            self.given("supplier")
            .join(self.regions, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("s_suppkey").alias("dealer_id"),
                F.col("s_name").alias("dealer_name"),
                "region",
                F.col("s_acctbal").alias("balance"),
            )
        )

    @cached_property
    def first_lines(self) -> DataFrame:
        lines = self.given("lineitem").select(
            "l_orderkey",
            *FIRST_LINE_ORDER,
            "l_quantity",
            "l_discount",
            "l_returnflag",
            "l_linestatus",
        )
        return keep_first(lines, "l_orderkey", FIRST_LINE_ORDER)

    @cached_property
    def visits(self) -> DataFrame:
        """The first line of each order as its visit.

        Quantity stands for the duration in steps of 0.2 hours, discount for the scheduled
        duration in steps of half an hour, the ship date for the day of the visit.
        """
        start, quantity = F.col("l_shipdate"), F.col("l_quantity")
        half_hours = F.round(F.col("l_discount") * 100).cast("bigint")
        delay = (2 * quantity - 5 * half_hours) / F.lit(10.0)
        return self.first_lines.select(
            F.col("l_orderkey").alias("visit_id"),
            F.col("l_orderkey").alias("appointment_id"),
            F.col("l_partkey").alias("part_id"),
            F.col("l_suppkey").alias("dealer_id"),
            start.alias("check_in_time"),
            start.alias("service_start_time"),
            add_time(start, hours=quantity / 5).alias("completion_time"),
            add_time(start, hours=half_hours / 2).alias("promised_completion"),
            F.col("l_linestatus").alias("visit_status"),
            (quantity / 5).alias("actual_duration_hours"),
            (half_hours / 2).alias("scheduled_duration_hours"),
            delay.alias("delay_hours"),
            threshold_flag(delay, 0).alias("delay_flag"),
            (F.col("l_returnflag") != "R").cast("int").alias("first_time_fix_flag"),
        )

    def keep_first_lines(self) -> None:
        """Stage the first lines, for queries that build several roles from the visits."""
        self.first_lines = stage(self.first_lines, "first_lines")

    @cached_property
    def appointments(self) -> DataFrame:
        return self.given("orders").select(
            F.col("o_orderkey").alias("appointment_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("booking_date"),
            F.col("o_orderpriority").alias("service_type"),
            F.col("o_orderstatus").alias("appointment_status"),
        )

    @cached_property
    def raw_surveys(self) -> DataFrame:
        csat = F.when(F.col("event_type") != "error", 5.0 - F.floor(F.col("value") / 20))
        return self.given("events").select(
            F.col("event_id").alias("survey_id"),
            F.col("event_id").alias("visit_id"),
            F.col("ts").alias("survey_date"),
            csat.cast("double").alias("csat_score"),
            nullable_flag(csat, COMPLAINT_MAX_CSAT, "<=").alias("complaint_flag"),
        )

    @cached_property
    def surveys(self) -> DataFrame:
        csat = F.col("csat_score")
        return self.raw_surveys.withColumn(
            "csat_score", null_unless(csat, in_domain(csat, CSAT_VALUES))
        ).withColumn("complaint_flag", nullable_flag(csat, COMPLAINT_MAX_CSAT, "<="))

    @cached_property
    def vehicles(self) -> DataFrame:
        return self._vehicles_of(self.visits)

    def _vehicles_of(self, visits: DataFrame) -> DataFrame:
        pairs = visits.select("appointment_id", "part_id").join(
            self.appointments.select("appointment_id", "customer_id"), "appointment_id"
        )
        return (
            pairs.select("customer_id", "part_id")
            .distinct()
            .select(
                F.concat_ws("-", "customer_id", "part_id").alias("vehicle_id"),
                "customer_id",
                "part_id",
            )
        )

    @cached_property
    def repairs(self) -> DataFrame:
        return self.given("lineitem").select(
            repair_id().alias("repair_id"),
            F.col("l_orderkey").alias("visit_id"),
            F.col("l_returnflag").alias("repair_category"),
            (F.col("l_discount") * 100).alias("estimated_hours"),
            (F.col("l_quantity") - 10).alias("actual_hours"),
            F.col("l_linestatus").alias("repair_status"),
        )

    @cached_property
    def _part_lines(self) -> DataFrame:
        return self.given("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", repair_id().alias("repair_id")
        )

    @cached_property
    def parts(self) -> DataFrame:
        return self._parts_of(self._part_lines)

    def _parts_of(self, lines: DataFrame) -> DataFrame:
        order_dates = self.given("orders").select("o_orderkey", "o_orderdate")
        lines = lines.join(order_dates, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        return lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias(
                "part_transaction_id"
            ),
            "repair_id",
            F.col("l_partkey").alias("part_id"),
            F.col("o_orderdate").alias("part_order_date"),
            F.col("l_shipdate").alias("part_received_date"),
            F.lit(0).alias("parts_delay_flag"),
        )

    @cached_property
    def full_appointments(self) -> DataFrame:
        return self._full_appointments_of(self.visits)

    def _full_appointments_of(self, visits: DataFrame) -> DataFrame:
        """Appointments with the vehicle, dealer and times taken from their visit."""
        booked = visits.select(
            "appointment_id",
            "part_id",
            "dealer_id",
            F.col("check_in_time").alias("appointment_date"),
            "scheduled_duration_hours",
            "promised_completion",
        )
        vehicle = F.when(
            F.col("part_id").isNotNull(), F.concat_ws("-", "customer_id", "part_id")
        )
        return (
            self.appointments.join(booked, "appointment_id", "left")
            .withColumn("vehicle_id", vehicle)
            .drop("part_id")
        )

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        """The eight tables with their defects: missing keys, orphans, broken rules."""
        return self._raw_of(self.visits, self.full_appointments, self.vehicles, self.parts)

    @cached_property
    def raw_layer(self) -> dict[str, DataFrame]:
        """The same with every table that is derived by a join staged, for reports that read them many times."""
        visits = stage(self.visits, "raw_visits")
        tables = self._raw_of(
            visits, self._full_appointments_of(visits), self._vehicles_of(visits), self.parts
        )
        read_as_given = ("service_visits", "dealers", "repairs", "customer_surveys")
        return {
            name: df if name in read_as_given else stage(df, f"raw_{name}")
            for name, df in tables.items()
        }

    def _raw_of(
        self, visits: DataFrame, appointments: DataFrame, vehicles: DataFrame, parts: DataFrame
    ) -> dict[str, DataFrame]:
        customers = self.customers.withColumn(
            "customer_id", null_unless(F.col("customer_id"), F.col("account_balance") > 0)
        )
        return {
            "customers": customers,
            "vehicles": vehicles,
            "dealers": self.dealers.filter(F.col("balance") > 0),
            "appointments": appointments,
            "service_visits": visits,
            "repairs": self.repairs,
            "parts": parts,
            "customer_surveys": self.raw_surveys,
        }

    @cached_property
    def clean_customers(self) -> DataFrame:
        return clean_customers(self.raw["customers"], ["account_balance"])

    @cached_property
    def clean_vehicles(self) -> DataFrame:
        return clean_vehicles(self.raw["vehicles"], self.clean_customers)

    @cached_property
    def clean_appointments(self) -> DataFrame:
        """Cleaned appointments, staged: visits are filtered by them."""
        kept = clean_appointments(
            self.raw["appointments"], self.clean_customers, self.clean_vehicles, self.raw["dealers"]
        )
        return stage(kept, "clean_appointments")

    @cached_property
    def clean_visits(self) -> DataFrame:
        """Cleaned visits, staged as a layer: repairs, parts and surveys are filtered by them."""
        return stage(clean_visits(self.visits, self.clean_appointments), "clean_visits")

    @cached_property
    def clean_repairs(self) -> DataFrame:
        """Cleaned repairs, staged: parts are filtered by them."""
        return stage(clean_repairs(self.repairs, self.clean_visits, CATEGORY_FIXES), "clean_repairs")

    @cached_property
    def clean(self) -> dict[str, DataFrame]:
        """The eight tables after cleaning, each child against its cleaned parent."""
        return {
            "customers": self.clean_customers,
            "vehicles": self.clean_vehicles,
            "dealers": self.raw["dealers"],
            "appointments": self.clean_appointments,
            "service_visits": self.clean_visits,
            "repairs": self.clean_repairs,
            "parts": clean_parts(self._part_lines, self.clean_repairs, self._parts_of),
            "customer_surveys": clean_surveys(self.raw_surveys, self.clean_visits),
        }

    @cached_property
    def base(self) -> DataFrame:
        """Visit base of the analyses."""
        base = visit_base(
            self.visits,
            self.appointments,
            self.surveys,
            ("customer_id", "booking_date", "service_type", "appointment_status"),
            date_col="check_in_time",
        )
        return base.withColumn("vehicle_id", F.concat_ws("-", "customer_id", "part_id"))

    @cached_property
    def surveyed(self) -> DataFrame:
        """Visits with their survey, for reports that need no appointment."""
        delay = F.col("delay_hours")
        return attach_optional(
            self.visits, self.surveys, "visit_id", ["csat_score", "complaint_flag"]
        ).withColumns({"delayed": delayed(delay), "delay_category": delay_category(delay)})

    @cached_property
    def rollup_v1(self) -> DataFrame:
        """Customer features, staged: thresholds, medians and rows all read them."""
        return stage(customer_rollup_v1(self.base), "rollup_v1")

    @cached_property
    def rollup_v2(self) -> DataFrame:
        return stage(customer_rollup_v2(self.base), "rollup_v2")

    @cached_property
    def imputed_v1(self) -> DataFrame:
        return stage(impute_customers(self.rollup_v1, IMPUTE_V1), "imputed_v1")

    @cached_property
    def imputed_v2(self) -> DataFrame:
        with_recency = recency(self.rollup_v2, self.visits, fill=False)
        return stage(impute_customers(with_recency, IMPUTE_V2), "imputed_v2")

    @cached_property
    def visit_parts(self) -> DataFrame:
        return parts_delay(self.repairs, self.parts)


# ---- the same roles as SQL -------------------------------------------------------------

_ROLE_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "regions": (
        (),
        "select n_nationkey, r_name as region from nation join region on n_regionkey = r_regionkey",
    ),
    "customers": (
        ("regions",),
        """select c_custkey as customer_id, region, c_mktsegment as customer_type,
                  c_acctbal as account_balance
           from customer left join regions on c_nationkey = n_nationkey""",
    ),
    "dealers": (
        ("regions",),
        """select s_suppkey as dealer_id, s_name as dealer_name, region, s_acctbal as balance
           from supplier left join regions on s_nationkey = n_nationkey""",
    ),
    "first_lines": (
        (),
        """select * from lineitem
           qualify row_number() over (partition by l_orderkey
             order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) = 1""",
    ),
    "visits": (
        ("first_lines",),
        """select l_orderkey as visit_id, l_orderkey as appointment_id, l_partkey as part_id,
                  l_suppkey as dealer_id, l_shipdate as check_in_time,
                  l_shipdate as service_start_time,
                  l_shipdate + to_microseconds((l_quantity * 720000000)::bigint) as completion_time,
                  l_shipdate + to_microseconds(round(l_discount * 100)::bigint * 1800000000)
                    as promised_completion,
                  l_linestatus as visit_status, l_quantity / 5 as actual_duration_hours,
                  round(l_discount * 100) / 2 as scheduled_duration_hours,
                  (2 * l_quantity - 5 * round(l_discount * 100)) / 10 as delay_hours,
                  (2 * l_quantity > 5 * round(l_discount * 100))::int as delay_flag,
                  (l_returnflag <> 'R')::int as first_time_fix_flag
           from first_lines""",
    ),
    "appointments": (
        (),
        """select o_orderkey as appointment_id, o_custkey as customer_id,
                  o_orderdate as booking_date, o_orderpriority as service_type,
                  o_orderstatus as appointment_status
           from orders""",
    ),
    "raw_surveys": (
        (),
        """select event_id as survey_id, event_id as visit_id, ts as survey_date,
                  case when event_type <> 'error' then 5.0 - floor(value / 20) end::double
                    as csat_score,
                  (case when event_type <> 'error' then 5.0 - floor(value / 20) end <= 2)::int
                    as complaint_flag
           from events""",
    ),
    "surveys": (
        ("raw_surveys",),
        """select survey_id, visit_id, survey_date,
                  case when csat_score in (1, 2, 3, 4, 5) then csat_score end as csat_score,
                  case when csat_score in (1, 2, 3, 4, 5) then (csat_score <= 2)::int end
                    as complaint_flag
           from raw_surveys""",
    ),
    "vehicles": (
        ("visits", "appointments"),
        """select distinct customer_id || '-' || part_id as vehicle_id, customer_id, part_id
           from visits join appointments using (appointment_id)""",
    ),
    "repairs": (
        (),
        """select l_orderkey * 10 + l_linenumber as repair_id, l_orderkey as visit_id,
                  l_returnflag as repair_category, l_discount * 100 as estimated_hours,
                  l_quantity - 10 as actual_hours, l_linestatus as repair_status
           from lineitem""",
    ),
    "parts": (
        (),
        """select l_orderkey || '-' || l_linenumber || '-' || l_partkey as part_transaction_id,
                  l_orderkey * 10 + l_linenumber as repair_id, l_partkey as part_id,
                  o_orderdate as part_order_date, l_shipdate as part_received_date,
                  0 as parts_delay_flag
           from lineitem left join orders on l_orderkey = o_orderkey""",
    ),
    "full_appointments": (
        ("appointments", "visits"),
        """select a.*, v.dealer_id, v.check_in_time as appointment_date,
                  v.scheduled_duration_hours, v.promised_completion,
                  a.customer_id || '-' || v.part_id as vehicle_id
           from appointments a left join visits v using (appointment_id)""",
    ),
    "raw_customers": (
        ("customers",),
        """select case when account_balance > 0 then customer_id end as customer_id,
                  region, customer_type, account_balance
           from customers""",
    ),
    "raw_dealers": (("dealers",), "select * from dealers where balance > 0"),
    "base": (
        ("visits", "appointments", "surveys"),
        """select v.*, a.customer_id, a.booking_date, a.service_type, a.appointment_status,
                  s.csat_score, s.complaint_flag,
                  floor(date_diff('microsecond', a.booking_date, v.check_in_time) / 8.64e10)::bigint
                    as lead_time_days,
                  coalesce(v.delay_hours > 0, false) as delayed,
                  case when v.delay_hours is null then 'Unknown'
                       when v.delay_hours > 8 then 'Severe Delay'
                       when v.delay_hours > 4 then 'Moderate Delay'
                       when v.delay_hours > 0 then 'Minor Delay'
                       else 'On Time' end as delay_category,
                  a.customer_id || '-' || v.part_id as vehicle_id
           from visits v
           left join appointments a using (appointment_id)
           left join surveys s on s.visit_id = v.visit_id""",
    ),
    "visit_parts": (
        ("repairs", "parts"),
        """select r.visit_id,
                  max(floor(date_diff('microsecond', p.part_order_date, p.part_received_date)
                      / 8.64e10)::bigint) as max_parts_delay_days,
                  coalesce(bool_or(date_diff('microsecond', p.part_order_date, p.part_received_date)
                      >= 3 * 8.64e10), false) as parts_delayed
           from (select distinct repair_id, visit_id from repairs) r
           left join parts p using (repair_id)
           group by r.visit_id""",
    ),
    "clean_customers": (
        ("raw_customers",),
        "select * from raw_customers where customer_id is not null",
    ),
    "clean_vehicles": (
        ("vehicles", "clean_customers"),
        "select * from vehicles where customer_id in (select customer_id from clean_customers)",
    ),
    "clean_appointments": (
        ("full_appointments", "clean_customers", "clean_vehicles", "raw_dealers"),
        """select * from full_appointments
           where appointment_date >= booking_date and scheduled_duration_hours > 0
             and customer_id in (select customer_id from clean_customers)
             and vehicle_id in (select vehicle_id from clean_vehicles)
             and dealer_id in (select dealer_id from raw_dealers)""",
    ),
    "clean_visits": (
        ("visits", "clean_appointments"),
        """select * replace (
                  date_diff('microsecond', service_start_time, completion_time) / 3.6e9
                    as actual_duration_hours,
                  date_diff('microsecond', promised_completion, completion_time) / 3.6e9
                    as delay_hours,
                  (completion_time > promised_completion)::int as delay_flag)
           from visits
           where service_start_time <= completion_time
             and appointment_id in (select appointment_id from clean_appointments)""",
    ),
    "clean_repairs": (
        ("repairs", "clean_visits"),
        """select * replace (
                  case when actual_hours between 0 and 24 then actual_hours end as actual_hours,
                  case repair_category when 'R' then 'A' else repair_category end
                    as repair_category)
           from repairs where visit_id in (select visit_id from clean_visits)""",
    ),
    "clean_parts": (
        ("parts", "clean_repairs"),
        """select part_transaction_id, repair_id, part_id, part_order_date,
                  case when part_received_date >= part_order_date then part_received_date end
                    as part_received_date,
                  case when part_received_date >= part_order_date
                       then (part_received_date >= part_order_date + interval 3 day)::int end
                    as parts_delay_flag
           from parts where repair_id in (select repair_id from clean_repairs)""",
    ),
    "clean_surveys": (
        ("surveys", "clean_visits"),
        "select * from surveys where visit_id in (select visit_id from clean_visits)",
    ),
    "features_v1": (
        ("base",),
        """select customer_id, count(*) as total_visits, avg(delay_hours) as avg_delay_hours,
                  avg(delayed::int) as delay_rate, avg(csat_score) as avg_csat,
                  avg(complaint_flag) as complaint_rate,
                  coalesce(sum(complaint_flag), 0)::bigint as total_complaints,
                  avg(actual_duration_hours) as avg_service_duration
           from base where customer_id is not null group by customer_id""",
    ),
    "features_v2": (
        ("base",),
        """select customer_id, count(*) as visit_count,
                  count(distinct vehicle_id) as unique_vehicles,
                  avg(delay_hours) as avg_delay_hours, avg(delay_flag) as delay_rate,
                  avg(csat_score) as avg_csat, avg(complaint_flag) as complaint_rate,
                  avg(actual_duration_hours) as avg_service_duration,
                  count(distinct service_type) as service_type_count,
                  max(check_in_time) as last_visit_date
           from base where customer_id is not null group by customer_id""",
    ),
    "imputed_v1": (
        ("features_v1",),
        """select * replace (
                  coalesce(avg_csat, (select median(avg_csat) from features_v1)) as avg_csat,
                  coalesce(complaint_rate, 0) as complaint_rate)
           from features_v1""",
    ),
    "imputed_v2": (
        ("features_v2", "base"),
        """select * replace (
                  coalesce(avg_csat, (select median(avg_csat) from features_v2)) as avg_csat,
                  coalesce(complaint_rate, 0) as complaint_rate),
                  floor(date_diff('microsecond', last_visit_date,
                    (select max(check_in_time) from base)) / 8.64e10)::double as recency_days
           from features_v2""",
    ),
    "rule_segments": (
        ("imputed_v1",),
        """select c.*,
                  case when avg_csat <= t.csat_25
                            and (delay_rate >= t.delay_75 or complaint_rate >= t.complaint_75)
                         then 'At-Risk'
                       when avg_csat >= t.csat_75 and delay_rate <= t.delay_25
                         then 'Loyal / Satisfied'
                       when total_visits >= t.visits_75 then 'High-Service-Need'
                       else 'Occasional / Low-Engagement' end as segment
           from imputed_v1 c, (select quantile_cont(avg_csat, 0.25) as csat_25,
                                      quantile_cont(avg_csat, 0.75) as csat_75,
                                      quantile_cont(delay_rate, 0.25) as delay_25,
                                      quantile_cont(delay_rate, 0.75) as delay_75,
                                      quantile_cont(complaint_rate, 0.75) as complaint_75,
                                      quantile_cont(total_visits, 0.75) as visits_75
                               from imputed_v1) t""",
    ),
}


def with_roles(*names: str) -> str:
    """A WITH clause that defines the named roles and all they are built from."""
    needed: list[str] = []

    def add(name: str) -> None:
        for parent in _ROLE_SQL[name][0]:
            add(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{n} as ({_ROLE_SQL[n][1]})" for n in needed) + "\n"
