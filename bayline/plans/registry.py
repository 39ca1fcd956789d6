"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.plans.binding import Tables
from bayline.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under a name, with its SQL for the same tables."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(tune(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, so that two engines can be compared by value.

    Adding zero turns a negative zero into zero.
    """
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    if not doubles:
        return df
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in doubles})
