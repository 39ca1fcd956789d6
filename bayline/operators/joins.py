"""Equi-joins between facts, parents, children and dimensions.

No broadcast hints: which side is small enough is left to the size statistics of Catalyst
and AQE. The side that may hold a hot key is always the streamed side, which AQE can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_parent(
    fact: DataFrame, parent: DataFrame, on: str | Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Add parent columns to every fact row; facts without a parent stay."""
    keys = [on] if isinstance(on, str) else list(on)
    return fact.join(parent.select(*keys, *cols), keys, "left")


def attach_optional(
    fact: DataFrame, child: DataFrame, on: str | Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Add the columns of a child that exists at most once per fact row."""
    return attach_parent(fact, child, on, cols)


def attach_dim(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    return fact.join(dim, on, "left")


def attach_agg(df: DataFrame, agg: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Join an aggregate back to the rows it was built from."""
    return df.join(agg, on, "left")


def expand_children(parent: DataFrame, child: DataFrame, on: str) -> DataFrame:
    """All (parent, child) rows, and childless parents once with missing child columns.

    A parent may have very many children, and a left join could not split that side.
    So children stream through an inner join, and childless parents come from an anti-join
    with the distinct child keys.
    """
    matched = child.join(parent, on).select(
        *parent.columns, *[c for c in child.columns if c != on]
    )
    childless = parent.join(child.select(on).distinct(), on, "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)


def keep_valid(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key exists in the parent; a missing key does not count."""
    keys = parent.select(F.col(pk).alias(fk)).filter(F.col(fk).isNotNull())
    return child.join(keys, fk, "left_semi").select(*child.columns)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows with a key that the parent does not have."""
    keys = parent.select(F.col(pk).alias(fk))
    return (
        child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti").select(*child.columns)
    )


def lookup_key(df: DataFrame, ref: DataFrame, on: str, col: str) -> DataFrame:
    """Exchange a key for another one; rows whose key is unknown are dropped."""
    return df.join(ref.select(on, col), on)


def alias_join(
    left: DataFrame, right: DataFrame, on: str, prefix: str, how: str = "left"
) -> DataFrame:
    """Join in which right columns that also exist on the left get a prefix."""
    shared = [c for c in right.columns if c != on and c in left.columns]
    return left.join(right.withColumnsRenamed({c: f"{prefix}{c}" for c in shared}), on, how)
