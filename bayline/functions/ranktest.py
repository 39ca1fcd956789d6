"""Exact null distribution of the Mann-Whitney statistic as column expressions over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shifted(values: Column, by: Column, length: Column) -> Column:
    return F.slice(F.concat(F.array_repeat(F.lit(0.0), by), values), F.lit(1), length)


def u_counts(smaller: Column, larger: Column) -> Column:
    """How many of the orderings of two samples without ties give U = 0, 1, ..., smaller * larger.

    Ranks are dealt one after the other: the j-th rank of the smaller sample, at place k of all, adds k - j to U. One
    array per number of ranks dealt so far.
    """
    m, n = smaller.cast("int"), larger.cast("int")
    length = m * n + 1
    first = F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), length - 1))
    start = F.transform(
        F.sequence(F.lit(0), m), lambda j: F.when(j == 0, first).otherwise(F.array_repeat(F.lit(0.0), length))
    )

    def deal(table: Column, k: Column) -> Column:
        def row(values: Column, j: Column) -> Column:
            # without the dealt rank, or with it as the j-th one
            taken = _shifted(F.get(table, j - 1), k - j, length)
            return F.when((j == 0) | (j > k), values).otherwise(F.zip_with(values, taken, lambda a, b: a + b))

        return F.transform(table, row)

    return F.get(F.aggregate(F.sequence(F.lit(1), m + n), start, deal), m)


def u_two_sided(u: Column, n1: Column, n2: Column) -> Column:
    """Exact two-sided p-value of U for samples without ties: twice the tail of the larger of U and n1 n2 - U."""
    smaller, larger = F.least(n1, n2), F.greatest(n1, n2)
    at = F.greatest(u, n1 * n2 - u).cast("int")
    add = lambda total, x: total + x

    def tail(counts: Column) -> Column:
        beyond = F.slice(counts, at + 1, F.size(counts))
        return F.lit(2.0) * F.aggregate(beyond, F.lit(0.0), add) / F.aggregate(counts, F.lit(0.0), add)

    twice = F.get(F.transform(F.array(u_counts(smaller, larger)), tail), F.lit(0))
    return F.least(twice, F.lit(1.0))
