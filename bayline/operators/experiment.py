"""Experiment on high-risk visits: assignment, readout, tests and bootstrap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.functions.flags import flag_label
from bayline.functions.hashing import hash_uniform
from bayline.operators.kpi import group_summary
from bayline.operators.model import RISK_LABELS
from bayline.operators.sampling import PARTS, weight_blocks
from bayline.operators.stats import (
    chi_square,
    cohens_d,
    decisions,
    lift,
    mann_whitney,
    sample_size,
    sample_stats,
    tests_table,
    two_proportion_z,
)

# fixed values: group names
CONTROL = "Control"
TREATMENT = "Treatment"
GROUP = "experiment_group"


def eligible(scored: DataFrame, band: str = RISK_LABELS[-1]) -> DataFrame:
    """The visits of one risk band."""
    return scored.filter(F.col("risk_band") == band)


def assign(df: DataFrame, key: str, salt: str, split: float = 0.5) -> DataFrame:
    """Random group by a hash of the key: control below the split."""
    u = hash_uniform(F.col(key), salt)
    return df.withColumn(GROUP, flag_label(u < split, CONTROL, TREATMENT))


def readout(experiment: DataFrame) -> DataFrame:
    return group_summary(experiment, GROUP)


def primary_test(
    experiment: DataFrame, metric: str = "csat_score", closed_domain: bool = True
) -> DataFrame:
    """Means, lift and rank test of the primary metric, one row."""
    test = mann_whitney(experiment, GROUP, metric, CONTROL, TREATMENT, closed_domain)
    means = lift(sample_stats(experiment, GROUP, metric, CONTROL, TREATMENT))
    row = means.select(
        F.struct(
            F.col("mean_1").alias("control_mean"),
            F.col("mean_2").alias("treatment_mean"),
            "absolute_difference",
            "relative_difference_percent",
        )
    ).scalar()
    return test.withColumn("_means", row).select(
        "_means.*", "u_statistic", "p_value", "significant_at_0_05"
    )


def complaint_test(experiment: DataFrame, flag: str = "complaint_flag") -> DataFrame:
    """Chi-square test of a 0/1 flag between the groups, with both rates."""
    test = chi_square(experiment, GROUP, flag)
    rates = lift(sample_stats(experiment, GROUP, flag, CONTROL, TREATMENT))
    row = rates.select(
        F.struct(
            F.col("mean_1").alias("control_rate"),
            F.col("mean_2").alias("treatment_rate"),
            "absolute_difference",
        )
    ).scalar()
    return test.withColumn("_rates", row).select(
        "_rates.*", "chi_square", "p_value", "significant_at_0_05"
    )


def secondary_tests(experiment: DataFrame) -> dict[str, DataFrame]:
    """Delay, complaint, effect size and sample size of the experiment."""
    return {
        "delay": two_proportion_z(experiment, GROUP, "final_delay_flag", TREATMENT, CONTROL),
        "complaint": complaint_test(experiment),
        "effect_size": cohens_d(experiment, GROUP, "csat_score", TREATMENT, CONTROL),
        "sample_size": sample_size(experiment, GROUP, "csat_score", TREATMENT, CONTROL),
    }


def decision_report(experiment: DataFrame) -> DataFrame:
    """Verdict for the primary and the two secondary metrics."""
    secondary = secondary_tests(experiment)
    return decisions(
        tests_table(
            {
                "Primary — CSAT": primary_test(experiment),
                "Secondary — Delay": secondary["delay"],
                "Secondary — Complaint": secondary["complaint"],
            }
        )
    )


def bootstrap_lifts(
    experiment: DataFrame, key: str, metric: str, replicates: int, salt: str
) -> DataFrame:
    """Lift of the metric in every replicate.

    Weights are summed per block and group inside each task, so what is shuffled has the
    size of the result.
    """
    rows = experiment.select(key, GROUP, F.col(metric).cast("double").alias("_x")).dropna()
    parts = range(PARTS)
    sums = (
        weight_blocks(rows, key, replicates, salt)
        .groupBy("block", GROUP)
        .agg(
            *[F.sum(f"w{part}").alias(f"n{part}") for part in parts],
            *[F.sum(F.col(f"w{part}") * F.col("_x")).alias(f"t{part}") for part in parts],
        )
    )
    cells = F.array(
        *[
            F.struct(
                (F.col("block") * PARTS + part).alias("replicate"),
                F.try_divide(F.col(f"t{part}"), F.col(f"n{part}").cast("double")).alias("mean"),
            )
            for part in parts
        ]
    )
    means = sums.select(GROUP, F.inline(cells)).filter(F.col("replicate") < replicates)
    treated = F.max(F.when(F.col(GROUP) == TREATMENT, F.col("mean")))
    control = F.max(F.when(F.col(GROUP) == CONTROL, F.col("mean")))
    return means.groupBy("replicate").agg((treated - control).alias("lift"))


def bootstrap_lift(
    experiment: DataFrame, key: str, metric: str, replicates: int = 200, salt: str = "bootstrap"
) -> DataFrame:
    """Mean lift over the replicates and its 95 percent interval, one row.

    The quantiles run over one number per replicate.
    """
    lifts = bootstrap_lifts(experiment, key, metric, replicates, salt)
    return lifts.agg(
        F.count("lift").alias("replicates"),
        F.avg("lift").alias("mean_lift"),
        F.percentile("lift", F.lit(0.025)).alias("ci_low"),
        F.percentile("lift", F.lit(0.975)).alias("ci_high"),
    )
