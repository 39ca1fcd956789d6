"""Metrics of runs: kept in an append-only table, judged against earlier runs, and freshness.

The table has one row per run and table. ``record`` adds only what is not there yet, so a repeated run
changes nothing. Metrics of a table that is being written come from an ``Observation`` of that write; newest
times of files that are already there come from the statistics in their footers. Neither reads the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bayline.sources.sinks import append_missing, read_if_there, write_result

METRICS = (
    "run STRING, taken_at TIMESTAMP_NTZ, table STRING, row_count BIGINT, newest TIMESTAMP_NTZ, "
    "nulls ARRAY<STRUCT<column: STRING, null_rate: DOUBLE>>"
)
#: Scaled median deviations that a value may be off, runs that a verdict needs, and what is never an anomaly:
#: a share of the median row count, an amount of the null rate.
DEVIATIONS, LEAST_RUNS = 3.5, 3
ROW_SLACK, NULL_SLACK = 0.01, 0.01
#: The median deviation of a normal distribution, as a factor.
MAD_SCALE = 1.4826


# ---- taking metrics ----------------------------------------------------------------------


def _measures(df: DataFrame, time: str | None) -> list[Column]:
    newest = F.max(F.col(time)) if time else F.lit(None)
    counts = [F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(df.columns)]
    return [F.count(F.lit(1)).alias("row_count"), newest.cast("timestamp_ntz").alias("newest"), *counts]


def _metrics_row(measured: DataFrame, columns: Sequence[str], run: str, taken_at: str, table: str) -> DataFrame:
    rates = [
        F.struct(F.lit(c).alias("column"), F.try_divide(F.col(f"missing_{i}"), F.col("row_count")).alias("null_rate"))
        for i, c in enumerate(columns)
    ]
    return measured.select(
        F.lit(run).alias("run"),
        F.lit(taken_at).cast("timestamp_ntz").alias("taken_at"),
        F.lit(table).alias("table"),
        "row_count",
        "newest",
        F.array(*rates).alias("nulls"),
    )


def scanned_metrics(df: DataFrame, table: str, run: str, taken_at: str, time: str | None = None) -> DataFrame:
    """Row count, newest time and null rates of a table, from one scan."""
    return _metrics_row(df.agg(*_measures(df, time)), df.columns, run, taken_at, table)


def written_metrics(df: DataFrame, path: str, table: str, run: str, taken_at: str, time: str | None = None) -> DataFrame:
    """Write the table and take its metrics on the way: the rows are neither counted nor read again."""
    seen = Observation(f"{table}:{run}")
    measures = _measures(df, time)
    write_result(df.observe(seen, *measures), path)
    spark, found = df.sparkSession, seen.get
    kinds = ["row_count BIGINT", "newest TIMESTAMP_NTZ"] + [f"missing_{i} BIGINT" for i in range(len(df.columns))]
    values = tuple(found[k.split()[0]] for k in kinds)
    return _metrics_row(spark.createDataFrame([values], ", ".join(kinds)), df.columns, run, taken_at, table)


# ---- the table of metrics ----------------------------------------------------------------


def read_metrics(spark: SparkSession, store: str) -> DataFrame:
    return read_if_there(spark, store, METRICS)


def record(metrics: DataFrame, store: str) -> None:
    """Append the rows whose run and table are not there yet."""
    append_missing(metrics, store, METRICS, ["run", "table"])


def _values(metrics: DataFrame) -> DataFrame:
    """(run, taken_at, table, column, metric, value)"""
    counted = F.struct(F.lit("").alias("column"), F.lit("row_count").alias("metric"), F.col("row_count").cast("double").alias("value"))
    rates = F.transform(
        "nulls", lambda n: F.struct(n["column"].alias("column"), F.lit("null_rate").alias("metric"), n["null_rate"].alias("value"))
    )
    return metrics.select("run", "taken_at", "table", F.inline(F.concat(F.array(counted), rates)))


def judge(metrics: DataFrame, run: str, deviations: float = DEVIATIONS, least_runs: int = LEAST_RUNS) -> DataFrame:
    """Each value of a run against the median of earlier runs.

    Off by more than ``deviations`` scaled median deviations, and by more than the slack, is an anomaly.
    Fewer than ``least_runs`` earlier values give 'new'; a missing value gives 'missing'.
    """
    key = ["table", "column", "metric"]
    values = _values(metrics)
    mine = values.filter(F.col("run") == run)
    started = mine.groupBy("table").agg(F.min("taken_at").alias("started"))
    earlier = values.join(started, "table").filter(F.col("taken_at") < F.col("started"))
    # as many rows in a group as there are runs
    middle = earlier.groupBy(*key).agg(F.median("value").alias("median"), F.count("value").alias("runs"))
    spread = (
        earlier.join(middle, key)
        .groupBy(*key)
        .agg(F.median(F.abs(F.col("value") - F.col("median"))).alias("deviation"))
    )
    rows = mine.join(middle, key, "left").join(spread, key, "left")
    slack = F.when(F.col("metric") == "row_count", F.lit(ROW_SLACK) * F.col("median")).otherwise(NULL_SLACK)
    limit = F.greatest(F.lit(deviations * MAD_SCALE) * F.col("deviation"), slack)
    off = F.abs(F.col("value") - F.col("median"))
    status = (
        F.when(F.coalesce("runs", F.lit(0)) < least_runs, "new")
        .when(F.col("value").isNull(), "missing")
        .when(off > limit, "anomaly")
        .otherwise("ok")
    )
    return rows.select("run", *key, "value", F.coalesce("runs", F.lit(0)).alias("runs"), "median", "deviation", status.alias("status"))


# ---- freshness ---------------------------------------------------------------------------


def footer_times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (table, file, time column) -> rows and newest time by the statistics of the footer."""
    schema = pa.schema([("table", pa.string()), ("rows", pa.int64()), ("newest", pa.timestamp("us")), ("known", pa.bool_())])
    for batch in batches:
        out = []
        for table, file, column in zip(*(batch.column(n).to_pylist() for n in ("table", "file", "time"))):
            parsed = urlparse(file)
            store, path = (
                (fs.LocalFileSystem(), unquote(parsed.path)) if parsed.scheme in ("", "file") else fs.FileSystem.from_uri(unquote(file))
            )
            with store.open_input_file(path) as source:
                footer = pq.read_metadata(source)
            at = footer.schema.to_arrow_schema().get_field_index(column)
            newest, known = None, True
            for i in range(footer.num_row_groups):
                group = footer.row_group(i)
                stats = group.column(at).statistics
                if stats is not None and stats.has_min_max:
                    value = stats.max.replace(tzinfo=None)
                    newest = value if newest is None else max(newest, value)
                elif not (stats is not None and stats.has_null_count and stats.null_count == group.num_rows):
                    known = False  # values without statistics
            out.append({"table": table, "rows": footer.num_rows, "newest": newest, "known": known})
        yield pa.RecordBatch.from_pylist(out, schema)


def file_times(spark: SparkSession, tables: Mapping[str, tuple[str, str]]) -> DataFrame:
    """table, row_count and newest time of parquet tables (name -> path, time column), from their footers.

    The driver lists the files, as it does for any scan; tasks read the footers. The newest time is NULL
    where a file has values without statistics.
    """
    files = [(name, f, time) for name, (path, time) in tables.items() for f in spark.read.parquet(path).inputFiles()]
    listed = spark.createDataFrame(files, "table STRING, file STRING, time STRING").repartition(max(1, min(len(files), 1000)), "file")
    found = listed.mapInArrow(footer_times, "table STRING, rows BIGINT, newest TIMESTAMP_NTZ, known BOOLEAN")
    return found.groupBy("table").agg(
        F.sum("rows").alias("row_count"), F.when(F.bool_and("known"), F.max("newest")).alias("newest")
    )


def freshness(newest: DataFrame, as_of: Column, limits: Mapping[str, float]) -> DataFrame:
    """Hours between each table's newest time and ``as_of``, against the table's limit in hours.

    A table without a known time, or without a limit, has no verdict.
    """
    lag = F.timestamp_diff("SECOND", F.col("newest"), as_of) / F.lit(3600.0)
    limit = F.lit(None).cast("double")
    for table, hours in limits.items():
        limit = F.when(F.col("table") == table, F.lit(float(hours))).otherwise(limit)
    rows = newest.withColumn("lag_hours", lag).withColumn("limit_hours", limit)
    return rows.withColumn("stale", F.col("lag_hours") > F.col("limit_hours"))
