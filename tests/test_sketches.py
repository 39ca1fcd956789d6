"""Stored and merged sketches against exact profiles; the exact profile over mixed types."""

import datetime as dt
import random

from pyspark.sql import functions as F

from bayline.operators import quality, sketches


def test_merged_sketches_are_within_the_stated_errors(spark, tmp_path):
    store = f"{tmp_path}/sketches"
    rng = random.Random(3)
    values = [rng.lognormvariate(0, 2) for _ in range(20_000)]
    rows = [(i % 7, v, f"k{i % 900}", None if i % 10 == 0 else i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "part int, x double, name string, y long")
    for part in (0, 1, 2, 3, 4, 5, 6, 3):  # one load comes twice
        sketches.record(sketches.load_sketches(df.filter(F.col("part") == part), "t", f"load-{part}"), store)
    stored = sketches.read_sketches(spark, store)
    assert stored.count() == 7 * 4
    got = {r.column: r for r in sketches.merged_profile(stored, [0.1, 0.5, 0.99]).collect()}
    assert (got["y"].row_count, got["y"].missing_count) == (20_000, 2000)
    for column, exact in (("x", len(set(values))), ("name", 900), ("y", 18_000), ("part", 7)):
        assert abs(got[column].unique_count - exact) <= sketches.distinct_error() * exact + 1
    assert got["name"].quantiles is None
    ordered = sorted(values)
    for p, value in got["x"].quantiles:
        assert abs(sum(v <= value for v in ordered) / len(ordered) - p) <= sketches.rank_error()


def test_a_new_load_does_not_read_the_old_ones(spark, tmp_path):
    store, reads = f"{tmp_path}/sketches", spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    for load in range(3):
        df = spark.range(100 * load, 100 * load + 100).mapInArrow(seen, "id long")
        sketches.record(sketches.load_sketches(df, "t", f"load-{load}"), store)
        assert sketches.merged_profile(sketches.read_sketches(spark, store)).first().row_count == 100 * (load + 1)
    assert reads.value == 300


def test_columns_without_values(spark, tmp_path):
    store = f"{tmp_path}/sketches"
    assert sketches.merged_profile(sketches.read_sketches(spark, store)).count() == 0
    empty = spark.createDataFrame([], "x double, s string, at timestamp_ntz")
    nulls = spark.createDataFrame([(None, None, None)] * 3, empty.schema)
    for name, df in (("a", empty), ("b", nulls)):
        sketches.record(sketches.load_sketches(df, "t", name), store)
    got = {r.column: tuple(r)[2:] for r in sketches.merged_profile(sketches.read_sketches(spark, store)).collect()}
    assert got == {c: (3, 3, 0, None) for c in ("x", "s", "at")}


def test_sketch_quantiles_by_group(spark):
    rows = [("a", float(v), None) for v in range(1000)] + [("b", float(v), 1.0) for v in range(50)] + [(None, 5.0, 5.0), ("c", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(r.g, r.metric, r.p): r.value for r in sketches.sketch_quantiles(df, ["x", "y"], [0.5, 1.0], ["g"]).collect()}
    assert set(got) == {("a", "x", 0.5), ("a", "x", 1.0), ("b", "x", 0.5), ("b", "x", 1.0), ("b", "y", 0.5), ("b", "y", 1.0)}
    assert abs(got["a", "x", 0.5] - 500) <= 1000 * sketches.rank_error() + 1 and got["a", "x", 1.0] == 999
    assert [r.value for r in sketches.sketch_quantiles(df, ["x"], [0.5]).collect()]


def test_exact_profile_of_all_types(spark):
    rows = [
        (1, 1.0, "a", True, dt.date(2024, 1, 1), [1, 2], -0.0),
        (2, float("nan"), "A", False, None, [1, 2], 0.0),
        (2, float("nan"), "", None, dt.date(2024, 1, 1), None, None),
        (None, None, None, None, None, [], 5.0),
    ]
    df = spark.createDataFrame(rows, "i int, d double, s string, b boolean, day date, many array<int>, zero double")
    empty = spark.createDataFrame([], "only int")
    got = {(r.table, r.column): (r.row_count, r.missing_count, r.missing_pct, r.unique_count) for r in quality.profile({"t": df, "e": empty}).collect()}
    assert got == {
        ("t", "i"): (4, 1, 25.0, 2), ("t", "d"): (4, 1, 25.0, 2), ("t", "s"): (4, 1, 25.0, 3), ("t", "b"): (4, 2, 50.0, 2),
        ("t", "day"): (4, 2, 50.0, 1), ("t", "many"): (4, 1, 25.0, 2), ("t", "zero"): (4, 1, 25.0, 2), ("e", "only"): (0, 0, None, 0),
    }
    plan = quality.profile({"t": df})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
