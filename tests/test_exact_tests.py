"""Exact rank test against enumeration, power of the t-test against published values."""

from itertools import combinations
from math import comb

import pytest
from pyspark.sql import functions as F

from bayline.functions.noncentral import let, scale_grid, t_critical, t_test_power, t_test_size
from bayline.functions.ranktest import u_counts, u_two_sided
from bayline.operators import stats


def enumerated(m, n):
    counts = [0] * (m * n + 1)
    for chosen in combinations(range(m + n), m):
        counts[sum(chosen) - m * (m - 1) // 2] += 1
    return counts


def test_counts_match_enumeration_for_all_sizes_to_eight(spark):
    sizes = [(m, n) for m in range(1, 9) for n in range(m, 9)]
    rows = spark.createDataFrame(sizes, "m int, n int").withColumn("counts", u_counts(F.col("m"), F.col("n"))).collect()
    for r in rows:
        assert r.counts == enumerated(r.m, r.n)


def test_p_values_match_enumeration(spark):
    cases = [(u, m, n) for m, n in ((3, 5), (5, 3), (8, 8), (1, 4)) for u in range(m * n + 1)]
    rows = spark.createDataFrame([(float(u), m, n) for u, m, n in cases], "u double, m int, n int")
    got = rows.withColumn("p", u_two_sided(F.col("u"), F.col("m"), F.col("n"))).collect()
    for r in got:
        counts = enumerated(min(r.m, r.n), max(r.m, r.n))
        at = int(max(r.u, r.m * r.n - r.u))
        assert r.p == pytest.approx(min(1, 2 * sum(counts[at:]) / comb(r.m + r.n, r.m)))


def grouped(spark, a, b):
    return spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b], "g string, v double")


def test_the_rule_for_small_samples(spark):
    apart = grouped(spark, range(4), range(10, 15))
    assert stats.mann_whitney(apart, "g", "v", "a", "b").first().p_value == pytest.approx(2 / comb(9, 4))
    normal = stats.mann_whitney(apart, "g", "v", "a", "b", exact_up_to=(0, 0)).first()
    assert normal.p_value == pytest.approx(0.0200, abs=5e-4)
    tied = grouped(spark, [1, 2, 2, 3], [2, 5, 6])
    assert stats.mann_whitney(tied, "g", "v", "a", "b").first().p_value == stats.mann_whitney(tied, "g", "v", "a", "b", exact_up_to=(0, 0)).first().p_value
    large = grouped(spark, range(0, 60, 2), range(1, 60, 2))
    assert stats.mann_whitney(large, "g", "v", "a", "b").first().p_value == stats.mann_whitney(large, "g", "v", "a", "b", exact_up_to=(0, 0)).first().p_value


def test_critical_values_match_published_ones(spark):
    known = {1.0: 12.706205, 2.0: 4.302653, 5.0: 2.570582, 10.0: 2.228139, 30.0: 2.042272, 120.0: 1.979930}
    rows = spark.createDataFrame([(df,) for df in known], "df double")
    got = rows.withColumn("t", let(scale_grid(F.col("df")), lambda g: t_critical(0.05, F.col("df"), g))).collect()
    for r in got:
        assert r.t == pytest.approx(known[r.df], abs=1e-6)


def test_sizes_match_published_ones(spark):
    known = {0.2: 393.405695, 0.5: 63.765610, 0.8: 25.524572, 1.0: 16.714722}
    rows = spark.createDataFrame([(d,) for d in known] + [(None,), (0.0,), (9.0,)], "d double")
    rows = rows.withColumn("n", t_test_size(F.col("d"), 0.05, 0.8))
    got = {r.d: r.n for r in rows.collect()}
    for d, n in known.items():
        assert got[d] == pytest.approx(n, abs=2e-6)
    assert got[None] is None and got[0.0] is None and got[9.0] == pytest.approx(2)
    reached = spark.createDataFrame([(known[0.5], 0.5)], "n double, d double").select(t_test_power(F.col("n"), F.col("d"), 0.05)).first()[0]
    assert reached == pytest.approx(0.8, abs=1e-7)


def test_exact_size_in_the_report(spark):
    rows = [("t" if i % 2 else "c", float(i % 7) + (i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, v double")
    one = {r.parameter: r.value for r in stats.sample_size(df, "g", "v", "t", "c").collect()}
    two = {r.parameter: r.value for r in stats.sample_size(df, "g", "v", "t", "c", exact=True).collect()}
    key = "Required Sample Size Per Group"
    assert 0.5 < two.pop(key) - one.pop(key) < 1.5 and one == two
