"""Profiles of growing tables from sketches that are stored per load and merged.

A load is profiled once, in one pass: rows, missing values, a HyperLogLog sketch of the distinct values of each
column and a KLL sketch of its numbers. Profiles of the whole table come from the stored sketches of all loads,
so they read the new load only. Sketches have a fixed size whatever the number of rows.

Errors: with ``2 ** precision`` registers the distinct count is off by ``1.04 / sqrt(registers)`` (one standard
deviation); a KLL sketch of size k gives values whose rank is off by about ``2.3 / k ** 0.9`` at 99 per cent.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField

from bayline.sources.sinks import append_missing, read_if_there

SKETCHES = (
    "load STRING, table STRING, column STRING, row_count BIGINT, missing_count BIGINT, "
    "distinct_sketch BINARY, number_sketch BINARY"
)
PRECISION = 14
RANK_SIZE = 800


def distinct_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """Relative error that an estimated distinct count keeps within."""
    return deviations * 1.04 / math.sqrt(2**precision)


def rank_error(size: int = RANK_SIZE) -> float:
    """Error of rank, as a share of all values, that a quantile keeps within."""
    return 2.3 / size**0.9


def distinct_sketch(column: str, kind: StructField, precision: int) -> Column:
    """Sketch of a column; a type that the sketch does not know counts by its text."""
    name = kind.dataType.typeName()
    value = F.col(f"`{column}`")
    value = value if name in ("integer", "long", "string", "binary") else value.cast("string")
    return F.hll_sketch_agg(value, precision)


def load_sketches(df: DataFrame, table: str, load: str, precision: int = PRECISION, size: int = RANK_SIZE) -> DataFrame:
    """A row of sketches for each column of a load, from one pass over it."""
    fields = df.schema.fields
    measures = [F.count(F.lit(1)).alias("row_count")]
    for i, field in enumerate(fields):
        value = F.col(f"`{field.name}`")
        measures += [F.count_if(value.isNull()).alias(f"missing_{i}"), distinct_sketch(field.name, field, precision).alias(f"distinct_{i}")]
        if isinstance(field.dataType, NumericType):
            measures.append(F.kll_sketch_agg_double(value.cast("double"), F.lit(size)).alias(f"numbers_{i}"))
    rows = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.col("row_count"),
            F.col(f"missing_{i}").alias("missing_count"),
            F.col(f"distinct_{i}").alias("distinct_sketch"),
            (F.col(f"numbers_{i}") if isinstance(field.dataType, NumericType) else F.lit(None).cast("binary")).alias("number_sketch"),
        )
        for i, field in enumerate(fields)
    ]
    return df.agg(*measures).select(F.lit(load).alias("load"), F.lit(table).alias("table"), F.inline(F.array(*rows)))


def record(sketches: DataFrame, store: str) -> None:
    """Append the sketches of loads that are not there yet."""
    append_missing(sketches, store, SKETCHES, ["load", "table", "column"])


def read_sketches(spark: SparkSession, store: str) -> DataFrame:
    return read_if_there(spark, store, SKETCHES)


def merged_profile(sketches: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """table, column, row_count, missing_count, unique_count (estimated) and quantiles, over all loads.

    ``quantiles`` is an array of (p, value) and NULL for columns that are no numbers or hold none.
    """
    merged = sketches.groupBy("table", "column").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("missing_count").alias("missing_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("unique_count"),
        F.kll_merge_agg_double("number_sketch").alias("numbers"),
        F.count("number_sketch").alias("number_loads"),
    )
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    some = (F.col("number_loads") > 0) & (F.col("row_count") > F.col("missing_count"))
    values = F.when(some, F.kll_sketch_get_quantile_double("numbers", ranks))
    pairs = F.arrays_zip(ranks.alias("p"), values.alias("value"))
    return merged.select(
        "table", "column", "row_count", "missing_count", "unique_count", F.when(values.isNotNull(), pairs).alias("quantiles")
    )


def sketch_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), size: int = RANK_SIZE) -> DataFrame:
    """Approximate quantiles as rows (by..., metric, p, value), within ``rank_error(size)``, in one aggregate.

    What is shuffled is one sketch per group and task. Values come from the data, nothing is interpolated;
    missing groups and values are left out.
    """
    kept = df.dropna(subset=list(by)) if by else df
    measured = kept.groupBy(*by).agg(
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"_sketch_{i}") for i, c in enumerate(cols)],
        *[F.count(F.col(c)).alias(f"_n_{i}") for i, c in enumerate(cols)],
    )
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    rows = [
        F.struct(
            F.lit(c).alias("metric"),
            F.arrays_zip(ranks.alias("p"), F.when(F.col(f"_n_{i}") > 0, F.kll_sketch_get_quantile_double(f"_sketch_{i}", ranks)).alias("value")).alias("_pairs"),
        )
        for i, c in enumerate(cols)
    ]
    long = measured.select(*by, F.inline(F.array(*rows)))
    return long.select(*by, "metric", F.inline("_pairs")).toDF(*by, "metric", "p", "value").filter(F.col("value").isNotNull())
