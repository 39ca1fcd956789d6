"""Ordered lists and top rows with a deterministic tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sort(order: Sequence[tuple[str, str]], key: str) -> list[Column]:
    columns = [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order]
    return [*columns, F.col(key).asc()]


def priority_list(df: DataFrame, order: Sequence[tuple[str, str]], key: str) -> DataFrame:
    """All rows, sorted by columns with their own direction and then by key."""
    return df.orderBy(*_sort(order, key))


def top_n(df: DataFrame, order: Sequence[tuple[str, str]], key: str, n: int) -> DataFrame:
    """The first n rows of the list; Spark keeps n rows per task, without a full sort."""
    return df.orderBy(*_sort(order, key)).limit(n)


def top1(
    df: DataFrame, order: Sequence[tuple[str, str]], key: str, exclude: Column | None = None
) -> DataFrame:
    """The first row, leaving out rows for which ``exclude`` holds."""
    kept = df if exclude is None else df.filter(~F.coalesce(exclude, F.lit(False)))
    return top_n(kept, order, key, 1)


def argmax(df: DataFrame, metric: str, key: str) -> DataFrame:
    """Key of the largest value, the smallest key on ties; missing values never win."""
    return top_n(df.filter(F.col(metric).isNotNull()), [(metric, "desc")], key, 1).select(key)


def by_magnitude(df: DataFrame, col: str, key: str) -> DataFrame:
    return df.orderBy(F.abs(F.col(col)).desc(), F.col(key).asc())
