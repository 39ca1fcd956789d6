"""Scoring of arriving rows, run to the end of the given files."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.plans.binding import GIVEN_SCHEMAS, Tables
from bayline.plans.queries.kpis import SCORED_SQL
from bayline.plans.queries.models import LEVELS_SQL, levels
from bayline.plans.registry import query, rounded
from bayline.session import scratch_dir
from bayline.sources.sinks import write_result
from bayline.streaming.scoring import (
    band_stream,
    first_arrivals,
    parquet_table_stream,
    score_stream,
    write_available,
    write_batches,
)


@query(
    "str1_banded_stream",
    "with " + SCORED_SQL
    + """select l_orderkey, l_linenumber, round(delay_probability, 6) as delay_probability, risk_band
         from scored""",
)
def banded_stream(t: Tables):
    lines = parquet_table_stream(
        t.spark, f"{t.sf_dir}/lineitem.parquet", GIVEN_SCHEMAS["lineitem"]
    )
    scored = band_stream(
        lines.select(
            "l_orderkey", "l_linenumber", (F.col("l_quantity") / 50).alias("delay_probability")
        )
    )
    out = scratch_dir(t.spark, "stream")
    path = write_available(scored, f"{out}/rows", f"{out}/checkpoint")
    return rounded(t.spark.read.schema(scored.schema).parquet(path))


@query(
    "str2_scored_stream",
    LEVELS_SQL
    + """select l_orderkey, l_linenumber, dear, round(p, 4) as delay_probability, (p > 0.5)::int as predicted_delayed,
                case when p <= 0.3 then 'Low Risk' when p <= 0.6 then 'Medium Risk' else 'High Risk' end as risk_band
         from scored""",
)
def scored_stream(t: Tables):
    """Test lines that arrive in two deliveries, many of them in both, scored by the fitted model across a restart.

    The result has every line once and is that of scoring the table.
    """
    fit, test = levels(t)
    place = scratch_dir(t.spark, "scored-stream")
    # deliveries: two thirds of the lines, then two thirds again, one third in common
    part = F.pmod(F.xxhash64("event"), F.lit(3))
    for number, kept in enumerate((part < 2, part > 0), 1):
        arrived = F.lit(f"2024-01-01 0{number}:00:00").cast("timestamp")
        delivery = test.filter(kept).withColumn("arrived", arrived)
        write_result(delivery, f"{place}/in/delivery={number}")
        arriving = t.spark.readStream.schema(delivery.schema).parquet(f"{place}/in/*")
        fresh = first_arrivals(arriving, ["event"], "arrived", "1 day")
        write_batches(score_stream(fit, fresh), f"{place}/out", f"{place}/checkpoint")
    rows = t.spark.read.parquet(f"{place}/out")
    return rounded(rows.select("l_orderkey", "l_linenumber", "dear", "delay_probability", "predicted_delayed", "risk_band"), 4)
