"""Tails of the t distribution, central or not, and the sample size that gives a test its power.

A noncentral t is (Z + delta) / S with S * S a chi-square over its degrees of freedom. Given S the tail is that of a
normal, so it is a weighted mean of normal tails over a grid of log S. The density of log S is analytic and dies
out on both sides, so the mean over an even grid converges faster than any power; dividing by the sum of
the weights spares the gamma functions. All of it is column expressions for result-sized tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from bayline.functions.special import erfc

#: Points of the grid, and the exponent at which its weights end.
GRID = 200
WEIGHT_END = 39.0
NEWTON_STEPS = 7
BISECTIONS = 34
#: The normal approximation is at most so much below the exact size; a t-test needs two rows per group.
SIZE_MARGIN, LEAST_SIZE = 6.0, 2.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normal_cdf(x: Column) -> Column:
    half = F.lit(0.5) * erfc(F.abs(x) / F.lit(math.sqrt(2.0)))
    return F.when(x < 0, half).otherwise(F.lit(1.0) - half)


def scale_grid(df: Column) -> Column:
    """Points (s, weight) of the distribution of S."""
    right = F.sqrt(F.lit(WEIGHT_END) / df)
    left = right + F.lit(WEIGHT_END) / df

    def point(u: Column) -> Column:
        weight = F.exp(df * (u - (F.exp(F.lit(2.0) * u) - F.lit(1.0)) / F.lit(2.0)))
        return F.struct(F.exp(u).alias("s"), weight.alias("w"))

    places = F.transform(F.sequence(F.lit(0), F.lit(GRID)), lambda i: (left + right) * i / F.lit(float(GRID)) - left)
    return F.transform(places, point)


def _mean(grid: Column, value: Callable[[Column], Column]) -> Column:
    total = F.aggregate(grid, F.lit(0.0), lambda acc, g: acc + g["w"] * value(g["s"]))
    return total / F.aggregate(grid, F.lit(0.0), lambda acc, g: acc + g["w"])


def two_sided_power(t: Column, delta: Column, grid: Column) -> Column:
    """Probability that a noncentral t lies beyond t on either side."""
    return _mean(grid, lambda s: normal_cdf(delta - t * s) + normal_cdf(-delta - t * s))


def t_critical(alpha: float, df: Column, grid: Column) -> Column:
    """Two-sided critical value by Newton's method, from below, where the tail is convex."""
    z = NormalDist().inv_cdf(1 - alpha / 2)
    start = F.lit(z) + F.lit((z**3 + z) / 4) / df
    density = 1 / math.sqrt(2 * math.pi)

    def step(t: Column, _: Column) -> Column:
        tail = _mean(grid, lambda s: F.lit(2.0) * normal_cdf(-t * s))
        slope = _mean(grid, lambda s: F.lit(2.0 * density) * s * F.exp(-t * t * s * s / F.lit(2.0)))
        return t + (tail - F.lit(alpha)) / slope

    return F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), start, step)


def t_test_power(size: Column, effect: Column, alpha: float) -> Column:
    """Power of a two-sided t-test of two groups of ``size`` rows (a real number) each."""
    delta = effect * F.sqrt(size / F.lit(2.0))

    def power(df: Column) -> Column:
        return let(scale_grid(df), lambda grid: let(t_critical(alpha, df, grid), lambda t: two_sided_power(t, delta, grid)))

    return let(F.lit(2.0) * size - F.lit(2.0), power)


def t_test_size(effect: Column, alpha: float, power: float) -> Column:
    """Rows per group, a real number, for which the power is reached; NULL for a missing or zero effect."""
    normal = NormalDist().inv_cdf
    factor = 2.0 * (normal(1 - alpha / 2) + normal(power)) ** 2
    first = F.lit(factor) / (effect * effect)
    bracket = F.struct(
        F.greatest(first, F.lit(LEAST_SIZE)).alias("low"), (F.greatest(first, F.lit(LEAST_SIZE)) + F.lit(SIZE_MARGIN)).alias("high")
    )

    def halve(b: Column, _: Column) -> Column:
        return let(
            let(
                (b["low"] + b["high"]) / F.lit(2.0),
                lambda m: F.struct(m.alias("m"), (t_test_power(m, effect, alpha) < F.lit(power)).alias("short")),
            ),
            lambda x: F.struct(
                F.when(x["short"], x["m"]).otherwise(b["low"]).alias("low"),
                F.when(x["short"], b["high"]).otherwise(x["m"]).alias("high"),
            ),
        )

    found = F.aggregate(F.sequence(F.lit(1), F.lit(BISECTIONS)), bracket, halve, lambda b: (b["low"] + b["high"]) / F.lit(2.0))
    return F.when(effect > 0, found).alias("size")
