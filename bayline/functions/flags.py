"""Conditional columns: labels, 0/1 flags, bands, mappings and domain tests."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from itertools import pairwise

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "=": operator.eq,
}


def compare(col: Column, op: str, bound) -> Column:
    return _COMPARE[op](col, bound)


def is_true(cond: Column) -> Column:
    """A condition that counts a missing input as false."""
    return F.coalesce(cond, F.lit(False))


def flag_label(cond: Column, if_true, if_false) -> Column:
    """Two-way label; a missing condition takes the second label."""
    return F.when(cond, F.lit(if_true)).otherwise(F.lit(if_false))


def first_match(cases: Sequence[tuple[Column, object]], default=None) -> Column:
    """Label of the first true condition, else the default."""
    (cond, label), *rest = cases
    chain = F.when(cond, F.lit(label))
    for cond, label in rest:
        chain = chain.when(cond, F.lit(label))
    return chain.otherwise(F.lit(default))


def threshold_flag(col: Column, bound, op: str = ">") -> Column:
    """1 or 0; a missing value counts as 0."""
    return is_true(compare(col, op, bound)).cast("int")


def nullable_flag(col: Column, bound, op: str = ">") -> Column:
    """1 or 0, and NULL where the value is missing."""
    return compare(col, op, bound).cast("int")


def band(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands ``(edges[i], edges[i+1]]``; outside all of them NULL."""
    cases = [
        ((col > low) & (col <= high), label)
        for (low, high), label in zip(pairwise(edges), labels, strict=True)
    ]
    return first_match(cases)


def remap(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values and keep all others."""
    return F.coalesce(lookup_label(col, mapping), col)


def lookup_label(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values; all others become NULL."""
    return first_match([(col == key, label) for key, label in mapping.items()])


def in_domain(col: Column, values: Sequence) -> Column:
    return is_true(col.isin(*values))


def out_of_domain(col: Column, values: Sequence) -> Column:
    """Present, but none of the listed values."""
    return is_true(~col.isin(*values))


def null_unless(col: Column, valid: Column) -> Column:
    return F.when(valid, col)
