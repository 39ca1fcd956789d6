import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bayline.operators import experiment, stats
from bayline.operators.kpi import contingency


def rows_of(spark, counts, ddl):
    """A table from (row, times) pairs."""
    frames = [
        spark.range(n).select(*[F.lit(v).alias(c.split()[0]) for v, c in zip(row, ddl.split(", "))])
        for row, n in counts
        if n
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def test_mann_whitney_by_hand(spark):
    rows = [("c", 1.0), ("c", 2.0), ("c", 2.0), ("t", 2.0), ("t", 3.0), ("x", 9.0), ("t", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    r = stats.mann_whitney(df, "g", "v", "c", "t").first()
    assert (r.n1, r.n2, r.median_1, r.median_2, r.u_statistic) == (3, 2, 2.0, 2.5, 1.0)
    variance = 6 / 12 * (6 - 24 / 20)
    z = (5 - 3 - 0.5) / math.sqrt(variance)
    assert r.z_statistic == pytest.approx(z)
    assert r.p_value == pytest.approx(math.erfc(z / math.sqrt(2)))
    assert r.significant_at_0_05 is False


def test_mann_whitney_counts_pairs(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 40) / 2, rng.integers(2, 12, 55) / 2
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    u = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x, y in itertools.product(a, b))
    assert stats.mann_whitney(df, "g", "v", "a", "b").first().u_statistic == u


def test_published_rank_test(spark):
    """U = 12,916,237.5 of 5580 and 5457 rows has p of about 2.71e-43."""
    n1, n2, u = 5580, 5457, 12_916_237.5
    z = (n1 * n2 - u - n1 * n2 / 2 - 0.5) / math.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
    df = spark.createDataFrame([(z,)], "z double")
    from bayline.functions.special import normal_two_sided

    p = df.select(normal_two_sided(F.col("z"))).first()[0]
    assert p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-9)
    assert -math.log10(p) > 40


def test_tests_without_variance_are_undefined(spark):
    same = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0)], "g string, v double")
    assert stats.mann_whitney(same, "g", "v", "a", "b").first().p_value is None
    assert stats.cohens_d(same, "g", "v", "b", "a").first()[0] is None
    z = stats.two_proportion_z(same, "g", "v", "b", "a").first()
    assert z.z_statistic is None and z.p_value is None and z.significant_at_0_05 is False
    one_group = same.filter("g = 'a'")
    assert stats.mann_whitney(one_group, "g", "v", "a", "b").first().p_value is None
    chi = stats.chi_square(same, "g", "v").first()
    assert chi.chi_square is None and chi.degrees_of_freedom == 0 and not chi.significant_at_0_05


def test_published_chi_square_with_correction(spark):
    """3137 of 5580 against 0 of 5457 gives 4283.297 with Yates' correction."""
    counts = [(("Control", 1), 3137), (("Control", 0), 2443), (("Treatment", 0), 5457)]
    df = rows_of(spark, counts, "g string, f int")
    r = stats.chi_square(df, "g", "f").first()
    assert r.chi_square == pytest.approx(4283.2968512934485, rel=1e-12)
    assert (r.degrees_of_freedom, r.p_value, r.significant_at_0_05) == (1, 0.0, True)
    plain = stats.chi_square(df, "g", "f", yates=False).first()
    assert plain.chi_square == pytest.approx(4286.06, abs=0.01)


def test_chi_square_of_an_empty_margin(spark):
    cells = spark.createDataFrame([("a", 0, 5), ("a", 1, 0), ("b", 0, 4), ("b", 1, 0)], "x string, y int, n long")
    assert stats.chi_square_of(cells, "x", "y").first().chi_square is None


def test_chi_square_with_empty_cells_and_large_counts(spark):
    """Cells that are not there count as empty; a small gap in large counts keeps its digits."""
    table = np.array([[12, 0, 30], [0, 9, 17], [5, 8, 0]])
    cells = [(f"r{i}", f"c{j}", int(table[i, j])) for i in range(3) for j in range(3) if table[i, j]]
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    chi = float(((table - expected) ** 2 / expected).sum())
    sparse = stats.chi_square_of(spark.createDataFrame(cells, "a string, b string, n long"), "a", "b").first()
    assert sparse.chi_square == pytest.approx(chi, rel=1e-12) and sparse.degrees_of_freedom == 4
    n = 10**12
    large = [("r0", "c0", n + 10**6), ("r0", "c1", n), ("r1", "c0", n), ("r1", "c1", n + 10**6)]
    frame = spark.createDataFrame(large, "a string, b string, n long")
    got = stats.chi_square_of(frame, "a", "b", yates=False).first().chi_square
    assert got == pytest.approx(4 * (5 * 10**5) ** 2 / (n + 5 * 10**5), rel=1e-9)
    none = stats.chi_square_of(frame.limit(0), "a", "b").first()
    assert none.chi_square is None and none.degrees_of_freedom is None


def test_chi_square_larger_table(spark):
    table = np.array([[10, 20, 30], [6, 9, 17]])
    counts = [((f"r{i}", f"c{j}"), int(table[i, j])) for i in range(2) for j in range(3)]
    df = rows_of(spark, counts, "a string, b string")
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    chi = float(((table - expected) ** 2 / expected).sum())
    r = stats.chi_square(df, "a", "b").first()
    assert r.chi_square == pytest.approx(chi) and r.p_value == pytest.approx(math.exp(-chi / 2))
    assert contingency(df, "a", "b").agg(F.sum("n")).first()[0] == table.sum()


def test_two_proportions(spark):
    df = rows_of(spark, [(("c", 1), 30), (("c", 0), 70), (("t", 1), 45), (("t", 0), 55)], "g string, f int")
    r = stats.two_proportion_z(df, "g", "f", "t", "c").first()
    z = 0.15 / math.sqrt(0.375 * 0.625 * 0.02)
    assert r.z_statistic == pytest.approx(z) and r.p_value == pytest.approx(math.erfc(z / math.sqrt(2)))
    assert r.absolute_difference == pytest.approx(0.15) and r.relative_change_percent == pytest.approx(50)


def test_effect_and_sample_size(spark):
    c, t = [1.0, 2.0, 3.0, 4.0], [3.0, 4.0, 5.0, 6.0, 7.0]
    df = spark.createDataFrame([("c", v) for v in c] + [("t", v) for v in t], "g string, v double")
    pooled = (3 * np.var(c, ddof=1) + 4 * np.var(t, ddof=1)) / 7
    d = (np.mean(t) - np.mean(c)) / math.sqrt(pooled)
    assert stats.cohens_d(df, "g", "v", "t", "c").first()[0] == pytest.approx(d)
    report = {r.parameter: r.value for r in stats.sample_size(df, "g", "v", "t", "c").collect()}
    assert report["Actual Treatment Size"] == 5
    assert report["Required Sample Size Per Group"] == pytest.approx(
        2 * ((1.959964 + 0.841621) / d) ** 2, rel=1e-6
    )


def test_decisions(spark):
    df = spark.createDataFrame(
        [("Primary — CSAT", 0.01), ("Secondary — Delay", None), ("Secondary — Complaint", 0.05)],
        "metric string, p_value double",
    )
    got = {r.metric: r.result for r in stats.decisions(df).collect()}
    assert got["Primary — CSAT"].startswith("Statistically significant")
    assert got["Secondary — Delay"].startswith("No statistically")
    assert got["Secondary — Complaint"].startswith("No statistically")


def test_box_numbers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 50.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None)], "g string, v double")
    r = stats.box_stats(df, "g", "v").first()
    assert (r.minimum, r.whisker_low, r.q1, r.median, r.q3, r.whisker_high, r.maximum) == (
        1.0, 1.0, 2.25, 3.5, 4.75, 5.0, 50.0
    )


def test_assignment_does_not_depend_on_partitions(spark):
    df = spark.range(2000)
    one = {tuple(r) for r in experiment.assign(df, "id", "a").collect()}
    two = {tuple(r) for r in experiment.assign(df.repartition(9), "id", "a").collect()}
    assert one == two
    both = experiment.assign(df, "id", "a").join(
        experiment.assign(df, "id", "b").withColumnRenamed(experiment.GROUP, "other"), "id"
    )
    agree = both.filter(F.col(experiment.GROUP) == F.col("other")).count()
    assert abs(agree - 1000) < 120  # two salts are independent draws


def test_experiment_reports(spark):
    rng = np.random.default_rng(2)
    rows = [
        (i, "Control" if i % 2 else "Treatment", 1, float(rng.integers(1, 6) if i % 2 else rng.integers(2, 6)), int(i % 7 == 0))
        for i in range(600)
    ]
    df = spark.createDataFrame(
        rows, "visit_id int, experiment_group string, final_delay_flag int, csat_score double, complaint_flag int"
    )
    report = {r.metric: r for r in experiment.decision_report(df).collect()}
    assert report["Primary — CSAT"].result.startswith("Statistically significant")
    assert report["Secondary — Delay"].p_value is None  # both rates are one
    control = [r[3] for r in rows if r[1] == "Control"]
    treated = [r[3] for r in rows if r[1] == "Treatment"]
    lift = np.mean(treated) - np.mean(control)
    ci = experiment.bootstrap_lift(df, "visit_id", "csat_score", 60).first()
    assert ci.replicates == 60 and ci.ci_low < lift < ci.ci_high
    assert ci.mean_lift == pytest.approx(lift, abs=0.1)
