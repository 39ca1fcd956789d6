import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bayline.operators.quantiles import fill_median, median_of, quantiles, rank_sums

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
numbers = st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 3))


def test_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    rows = [
        (str(i % 3), float(rng.normal() * 10.0 ** rng.integers(-3, 6)) if i % 3 else 7.0, i % 11)
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "g string, x double, y int").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for closed in (False, True):
        for g, metric, p, value in quantiles(df, ["x", "y"], probs, ["g"], closed).collect():
            values = [r[1 if metric == "x" else 2] for r in rows if r[0] == g]
            assert value == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-12)


@FEW
@given(st.lists(numbers, min_size=1, max_size=40))
def test_median_of_any_list(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert median_of(df, ["x"]).first()[0] == pytest.approx(np.median(values), rel=1e-9, abs=1e-9)


def test_weights_stand_for_repeated_rows(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 1), (9.0, 3)], "x double, n int")
    assert median_of(df, ["x"], weight="n").first()[0] == 1.0
    assert median_of(df, ["x"], weight="n", closed_domain=True).first()[0] == 1.0


def test_missing_values_and_groups_are_left_out(spark):
    df = spark.createDataFrame([("a", None), ("a", 3.0), (None, 9.0)], "g string, x double")
    assert [tuple(r) for r in median_of(df, ["x"], ["g"]).collect()] == [("a", 3.0)]
    assert median_of(df.filter("x is null"), ["x"]).collect()[0][0] is None


def test_fill_median(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0)], "k int, x double")
    got = {r.k: r.x for r in fill_median(df, ["x"]).collect()}
    assert got == {1: 1.0, 2: 2.5, 3: 4.0}


@pytest.fixture
def many_ranges(spark):
    """Range partitions are not merged again, so that small data spans many of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_results_do_not_depend_on_the_ranges(spark, many_ranges):
    # one group holds most rows, and most values crowd in two narrow bands
    rng = np.random.default_rng(7)
    bands = np.where(rng.random(4000) < 0.5, 1e9, 2e9) + np.round(rng.random(4000), 3)
    rows = [("hot" if i % 10 else "cold", bool(i % 3), float(v)) for i, v in enumerate(bands)]
    df = spark.createDataFrame(rows, "g string, f boolean, x double")
    probs = [0.0, 0.1, 0.499, 0.5, 0.501, 0.99, 1.0]
    got = quantiles(df, ["x"], probs, ["g"]).collect()
    assert len(got) == 14
    for g, _, p, value in got:
        assert value == pytest.approx(np.quantile([r[2] for r in rows if r[0] == g], p), rel=1e-14)
    by_flag = {r.f: r.x for r in median_of(df, ["x"], ["f"]).collect()}
    for flag in (True, False):
        assert by_flag[flag] == pytest.approx(np.median([r[2] for r in rows if r[1] == flag]))

    order = np.argsort(bands, kind="stable")
    ranks = np.empty(len(bands))
    ranks[order] = np.arange(1, len(bands) + 1)
    for v in np.unique(bands):
        ranks[bands == v] = ranks[bands == v].mean()
    first = np.array([r[1] for r in rows])
    r = rank_sums(df, F.col("f"), F.col("x")).first()
    assert (r.n1, r.n2) == (first.sum(), (~first).sum())
    assert r.rank_sum == pytest.approx(ranks[first].sum(), rel=1e-12)
    assert r.ties == sum(c**3 - c for c in np.unique(bands, return_counts=True)[1])


def test_mid_ranks_with_ties(spark):
    # samples 1,2,2 and 2,3: mid-ranks 1,3,3 and 3,5
    rows = [(True, 1.0), (True, 2.0), (True, 2.0), (False, 2.0), (False, 3.0)]
    df = spark.createDataFrame(rows, "f boolean, v double")
    n1, n2, rank_sum, ties = rank_sums(df, F.col("f"), F.col("v")).first()
    assert (n1, n2, rank_sum, ties) == (3, 2, 7.0, 24.0)


@FEW
@given(st.lists(st.tuples(st.booleans(), numbers), min_size=2, max_size=40))
def test_rank_sums_of_both_samples_add_up(spark, rows):
    df = spark.createDataFrame(rows, "f boolean, v double").repartition(3)
    n = len(rows)
    first = rank_sums(df, F.col("f"), F.col("v")).first()
    second = rank_sums(df, ~F.col("f"), F.col("v")).first()
    assert first.rank_sum + second.rank_sum == pytest.approx(n * (n + 1) / 2)
