"""Input contract: the columns and types that a job expects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def check_inputs(
    tables: Mapping[str, DataFrame], schemas: Mapping[str, str]
) -> DataFrame:
    """One row per table: missing columns, columns of another type, rows, verdict.

    ``schemas`` holds the expected columns as DDL text.
    """
    frames = []
    for name, ddl in schemas.items():
        wanted = StructType.fromDDL(ddl)
        found = {f.name: f.dataType for f in tables[name].schema.fields}
        missing = [f.name for f in wanted.fields if f.name not in found]
        other = [f.name for f in wanted.fields if found.get(f.name, f.dataType) != f.dataType]
        counted = tables[name].agg(F.count(F.lit(1)).alias("row_count"))
        frames.append(
            counted.select(
                F.lit(name).alias("table"),
                F.lit(",".join(missing)).alias("missing_columns"),
                F.lit(",".join(other)).alias("mistyped_columns"),
                "row_count",
                ((F.col("row_count") > 0) & F.lit(not missing and not other)).alias("ok"),
            )
        )
    report = frames[0]
    for frame in frames[1:]:
        report = report.unionByName(frame)
    return report
