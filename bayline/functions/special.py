"""Tail probabilities as native column expressions.

Meant for result-sized tables (one row per test), so the folds below run over a
fixed number of steps per row and nothing leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: switch point and depth of the two expansions of erfc
ERFC_SWITCH = 2.5
ERFC_STEPS = 60


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, about 1e-12 relative.

    Below the switch point the Maclaurin-type series of erf with positive terms,
    above it the continued fraction, both folded from the inside out.
    """
    gauss = F.exp(-x * x)
    near = F.aggregate(
        F.sequence(F.lit(ERFC_STEPS), F.lit(1), F.lit(-1)),
        F.lit(1.0),
        lambda acc, k: F.lit(1.0) + acc * F.lit(2.0) * x * x / (F.lit(2.0) * k + F.lit(1.0)),
    )
    far = F.aggregate(
        F.sequence(F.lit(ERFC_STEPS), F.lit(1), F.lit(-1)),
        x,
        lambda acc, k: x + k / F.lit(2.0) / acc,
    )
    series = F.lit(1.0) - F.lit(2.0 / math.sqrt(math.pi)) * gauss * x * near
    fraction = gauss / (F.lit(math.sqrt(math.pi)) * far)
    return F.when(x < F.lit(ERFC_SWITCH), series).when(x.isNotNull(), fraction)


def normal_two_sided(z: Column) -> Column:
    """Two-sided p-value of a standard normal statistic."""
    return F.least(F.lit(1.0), erfc(F.abs(z) / F.lit(math.sqrt(2.0)))) * F.when(
        z.isNotNull(), F.lit(1.0)
    )


def chi_square_sf(x: Column, dof: Column) -> Column:
    """Upper tail of chi-square for any whole number of degrees of freedom."""
    half = x / F.lit(2.0)
    # terms half^(k+s)/Gamma(k+s+1) with s = 0 (even) or 1/2 (odd), each from the one before
    shift = F.when(dof % 2 == 0, F.lit(0.0)).otherwise(F.lit(0.5))
    first = F.when(dof % 2 == 0, F.lit(1.0)).otherwise(
        F.sqrt(half) * F.lit(2.0 / math.sqrt(math.pi))
    )
    count = F.floor(dof / 2).cast("int")
    start = F.struct(first.alias("term"), F.lit(0.0).alias("total"))
    steps = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    folded = F.aggregate(
        steps,
        start,
        lambda acc, k: F.struct(
            (acc["term"] * half / (k + shift)).alias("term"),
            (acc["total"] + acc["term"]).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    body = F.exp(-half) * folded
    odd = F.when(dof % 2 == 1, erfc(F.sqrt(half))).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), body + odd) * F.when(x.isNotNull(), F.lit(1.0))
