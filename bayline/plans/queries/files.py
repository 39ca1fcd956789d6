"""Sources, sinks and SQL scripts (SRC, SNK, SQL): whole tables written and read back.

Files go to a fresh folder below the shared scratch folder of the session.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.plans.binding import GIVEN_SCHEMAS, Tables
from bayline.plans.queries import marts
from bayline.plans.registry import ORACLES, query
from bayline.plans.script import result_catalog, run_script
from bayline.session import scratch_dir
from bayline.sources.contract import check_inputs
from bayline.sources.csv import load_csv, register_csv
from bayline.sources.sinks import (
    current_version,
    publish_marts,
    read_published,
    write_marts,
    write_numbered,
    write_result,
)


@query("src1_csv_scan", "select * from events")
def csv_scan(t: Tables):
    path = write_result(t.given("events"), scratch_dir(t.spark, "src1"), "csv")
    return load_csv(t.spark, path, GIVEN_SCHEMAS["events"])


@query(
    "src1_csv_missing_values",
    """select l_orderkey, l_linenumber, case when l_returnflag <> 'R' then l_quantity end as l_quantity,
              case when l_linestatus = 'F' then l_shipdate end as l_shipdate
       from lineitem""",
)
def csv_missing_values(t: Tables):
    """Empty fields and fields that do not parse come back as missing."""
    quantity = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(
        F.col("l_quantity").cast("string")
    )
    shipped = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    lines = t.given("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        quantity.alias("l_quantity"),
        shipped.alias("l_shipdate"),
    )
    path = write_result(lines, scratch_dir(t.spark, "src1"), "csv")
    schema = "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ"
    return load_csv(t.spark, path, schema)


@query(
    "src2_csv_drop_malformed",
    "select o_orderkey, o_custkey from orders where o_orderstatus <> 'P'",
)
def csv_drop_malformed(t: Tables):
    """Rows with a broken price are dropped, also when the price is not selected."""
    price = F.when(F.col("o_orderstatus") == "P", F.lit("broken")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    orders = t.given("orders").select("o_orderkey", "o_custkey", price.alias("o_totalprice"))
    path = write_result(orders, scratch_dir(t.spark, "src2"), "csv")
    register_csv(
        t.spark, "checked_orders", path, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE"
    )
    return t.spark.sql("SELECT o_orderkey, o_custkey FROM checked_orders")


@query(
    "src3_input_contract",
    """select 'orders' as "table", '' as missing_columns, '' as mistyped_columns,
              count(*) as row_count, count(*) > 0 as ok from orders
       union all select 'customer', '', '', count(*), count(*) > 0 from customer
       union all select 'part', 'p_container', 'p_size', count(*), false from part""",
)
def input_contract(t: Tables):
    """Two tables that fit their contract and one that does not."""
    schemas = {
        "orders": GIVEN_SCHEMAS["orders"],
        "customer": GIVEN_SCHEMAS["customer"],
        "part": "p_partkey BIGINT, p_size BIGINT, p_container STRING",
    }
    return check_inputs({name: t.given(name) for name in schemas}, schemas)


@query("snk1_write_csv", "select * from lineitem")
def write_csv(t: Tables):
    path = write_result(t.given("lineitem"), scratch_dir(t.spark, "snk1"), "csv")
    return load_csv(t.spark, path, GIVEN_SCHEMAS["lineitem"])


@query("snk1_write_parquet", "select * from orders")
def write_parquet(t: Tables):
    path = write_result(t.given("orders"), scratch_dir(t.spark, "snk1"))
    return t.spark.read.schema(GIVEN_SCHEMAS["orders"]).parquet(path)


@query(
    "snk2_numbered_results",
    """select 'kpi_01' as result, o_orderstatus as label, count(*) as n from orders group by 2
       union all
       select 'kpi_02', event_type, count(*) from events group by 2""",
)
def numbered_results(t: Tables):
    results = [
        t.given("orders").groupBy(F.col("o_orderstatus").alias("label")).agg(
            F.count(F.lit(1)).alias("n")
        ),
        t.given("events").groupBy(F.col("event_type").alias("label")).agg(
            F.count(F.lit(1)).alias("n")
        ),
    ]
    paths = write_numbered(results, scratch_dir(t.spark, "snk2"), "kpi")
    frames = [
        t.spark.read.parquet(path).select(
            F.lit(path.rsplit("/", 1)[1]).alias("result"), "label", "n"
        )
        for path in paths
    ]
    return frames[0].unionByName(frames[1])


# table of the mart -> its query and its columns
_MARTS = {
    "fact_service_visits": (
        "mrt1_fact_visits",
        marts.fact,
        """visit_id appointment_id customer_id dealer_id booking_date:time service_type
        appointment_status csat_score:double complaint_flag dealer_name region delay_hours:double
        service_date service_year service_month service_month_name service_week day_of_week
        delayed_visit severe_delay first_time_fix""",
    ),
    "dim_customers": (
        "mrt2_dim_customers",
        marts.dim_customers,
        """customer_id region customer_type segment_name visit_count:double delay_rate:double
        avg_csat:double complaint_rate:double recency_days:double""",
    ),
    "dim_vehicles": ("mrt3_dim_vehicles", marts.dim_vehicles, "vehicle_id customer_id part_id"),
    "dim_dealers": ("mrt3_dim_dealers", marts.dim_dealers, "dealer_id dealer_name region"),
    "segment_summary": (
        "mrt4_segment_summary",
        marts.segment_summary,
        """segment_name customers avg_visits:double avg_unique_vehicles:double
        avg_delay_hours:double delay_rate:double avg_csat:double complaint_rate:double
        avg_service_types:double avg_recency_days:double customer_percentage:double""",
    ),
    "experiment_summary": (
        "mrt4_experiment_summary",
        marts.experiment_summary,
        "experiment_group customers delay_rate:double avg_csat:double complaint_rate:double",
    ),
}


def _digest(columns: str) -> str:
    """First eight hex digits of a hash of a row, in the SQL of both engines."""
    texts = []
    for entry in columns.split():
        column, _, kind = entry.partition(":")
        if kind == "double":
            column = f"cast(round({column} * 10000) as bigint)"
        elif kind == "time":
            column = f"cast({column} as date)"
        texts.append(f"coalesce(cast({column} as string), '~')")
    return f"substr(md5(concat_ws('|', {', '.join(texts)})), 1, 8)"


_MARTS_SQL = "\nunion all ".join(
    f"""select '{name}' as "table", count(*) as row_count,
        cast(sum(cast('0x' || {_digest(columns)} as bigint)) as bigint) as checksum
        from ({ORACLES[oracle]})"""
    for name, (oracle, _, columns) in _MARTS.items()
)


@query("snk3_write_marts", _MARTS_SQL)
def write_star(t: Tables):
    """All six tables of the mart, the fact partitioned by month; rows and checksum as read back."""
    t.keep_first_lines()
    paths = write_marts(
        {name: build(t) for name, (_, build, _) in _MARTS.items()},
        scratch_dir(t.spark, "snk3"),
        {"fact_service_visits": ["service_year", "service_month"]},
    )
    return _checksums({name: t.spark.read.parquet(path) for name, path in paths.items()})


def _checksums(tables: dict[str, DataFrame]) -> DataFrame:
    frames = [
        tables[name].agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.conv(F.expr(_digest(columns)), 16, 10).cast("long")).alias("checksum"),
        )
        for name, (_, _, columns) in _MARTS.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query(
    "snk3_published_marts",
    f"""select 'run-2' as version, m.* from ({_MARTS_SQL}) m""",
)
def published_star(t: Tables):
    """The mart published by a first run without rows and by a second one; what readers see after it."""
    t.keep_first_lines()
    path = scratch_dir(t.spark, "published")
    tables = {name: build(t) for name, (_, build, _) in _MARTS.items()}
    publish_marts({name: df.limit(0) for name, df in tables.items()}, path, "run-1")
    publish_marts(tables, path, "run-2", {"fact_service_visits": ["service_year", "service_month"]})
    version = current_version(t.spark, path)["version"]
    return _checksums(read_published(t.spark, path)).select(F.lit(version).alias("version"), "table", "row_count", "checksum")


_SCRIPT = """
-- number of orders per status; the comment holds a semicolon
SELECT o_orderstatus AS label, count(*) AS n FROM script_orders GROUP BY o_orderstatus;

CREATE OR REPLACE TEMPORARY VIEW script_big AS
SELECT * FROM script_orders WHERE o_totalprice > 200000;

-- nothing but a comment
;
WITH urgent AS (SELECT * FROM script_big WHERE o_orderpriority <> 'a;b')
SELECT o_orderpriority AS label, count(*) AS n FROM urgent GROUP BY o_orderpriority
"""


@query(
    "sql1_run_script",
    """select 'orders_01' as result, o_orderstatus as label, count(*) as n from orders group by 2
       union all
       select 'orders_02', o_orderpriority, count(*) from orders where o_totalprice > 200000
       group by 2""",
)
def script(t: Tables):
    t.given("orders").createOrReplaceTempView("script_orders")
    written = run_script(t.spark, _SCRIPT, scratch_dir(t.spark, "sql1"), "orders")
    frames = [
        t.spark.read.parquet(path).select(F.lit(name).alias("result"), "label", "n")
        for name, path in written.items()
    ]
    return frames[0].unionByName(frames[1])


@query(
    "sql2_result_catalog",
    """select 'customers' as result, count(*) as row_count, 2 as column_count,
              'c_custkey, c_mktsegment' as columns,
              (select string_agg(row, chr(10) order by row) from (
                 select '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' as row
                 from customer order by row limit 5)) as preview
       from customer
       union all
       select 'statuses', count(distinct o_orderstatus), 2, 'status, n',
              (select string_agg(row, chr(10) order by row) from (
                 select '{"status":"' || o_orderstatus || '","n":' || count(*) || '}' as row
                 from orders group by o_orderstatus order by row limit 5))
       from orders""",
)
def catalog(t: Tables):
    customers = t.given("customer").select("c_custkey", "c_mktsegment")
    statuses = t.given("orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return result_catalog({"customers": customers, "statuses": statuses})
