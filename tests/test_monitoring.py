"""Drift against plain loops, metrics of runs, freshness without a scan."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from bayline.operators import drift, monitoring


def plain_ks(old, new):
    return max(abs(sum(x <= v for x in old) / len(old) - sum(x <= v for x in new) / len(new)) for v in old + new)


def sample(spark, rows):
    return spark.createDataFrame(rows, "newer boolean, x double, y double, label string")


def test_ks_matches_both_distribution_functions(spark):
    rng = random.Random(1)
    rows = [(rng.random() < 0.4, rng.choice([rng.gauss(0, 1), 0.0, 1.0]), float(rng.randrange(4)), "a") for _ in range(600)]
    rows += [(True, None, None, None), (None, 1.0, 1.0, "a"), (False, None, 3.0, None)]
    got = {r.metric: r for r in drift.ks_distance(sample(spark, rows).repartition(7), F.col("newer"), ["x", "y"]).collect()}
    for i, name in ((1, "x"), (2, "y")):
        old, new = ([r[i] for r in rows if r[0] is side and r[i] is not None] for side in (False, True))
        assert (got[name].n_old, got[name].n_new) == (len(old), len(new))
        assert got[name].ks == pytest.approx(plain_ks(old, new))
        x = got[name].ks * math.sqrt(len(old) * len(new) / (len(old) + len(new)))
        tail = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
        assert got[name].ks_p == pytest.approx(1.0 if x < 0.2 else min(max(tail, 0), 1))


def test_ks_of_known_samples(spark):
    same = [(side, float(v), None, None) for side in (True, False) for v in range(10)]
    apart = [(True, 1.0, None, None)] * 5 + [(False, 0.0, None, None)] * 7
    assert drift.ks_distance(sample(spark, same), F.col("newer"), ["x"]).first().ks == 0
    found = drift.ks_distance(sample(spark, apart), F.col("newer"), ["x"]).first()
    assert found.ks == 1 and found.ks_p < 0.01


def test_an_empty_sample_gives_null(spark):
    rows = [(False, 1.0, None, "a"), (False, 2.0, None, "b")]
    found = {r.metric: r for r in drift.drift(sample(spark, rows), F.col("newer"), ["x", "y"], ["label"]).collect()}
    assert found["x"].ks is None and found["x"].psi is None and found["x"].shift is None
    assert found["label"].psi is None and (found["label"].n_old, found["label"].n_new) == (2, 0)
    assert drift.drift(sample(spark, []), F.col("newer"), ["x"], ["label"]).count() == 0


def plain_psi(old, new):
    return sum(
        (b - a) * math.log(b / a)
        for a, b in ((max(o / sum(old), 1e-4), max(n / sum(new), 1e-4)) for o, n in zip(old, new))
    )


def test_stability_of_labels_and_missing_values(spark):
    rows = [(False, 1.0, None, "a")] * 60 + [(False, 1.0, None, None)] * 40 + [(True, 1.0, None, "a")] * 30 + [(True, 1.0, None, "b")] * 70
    found = drift.label_stability(sample(spark, rows), F.col("newer"), ["label"]).first()
    assert found.psi == pytest.approx(plain_psi([60, 40, 0], [30, 0, 70]))


def test_bins_are_cut_at_the_older_quantiles(spark):
    old, new = [float(v) for v in range(100)], [float(v % 10) for v in range(50)]
    rows = [(False, v, 7.0, None) for v in old] + [(True, v, 7.0, None) for v in new] + [(True, None, 7.0, None)] * 50
    found = {r.metric: r.psi for r in drift.stability(sample(spark, rows), F.col("newer"), ["x", "y"]).collect()}
    assert found["x"] == pytest.approx(plain_psi([10] * 10 + [0], [50] + [0] * 9 + [50]))
    assert found["y"] == pytest.approx(0)  # equal cuts are one


def test_a_window_never_holds_all_rows(spark):
    plan = drift.ks_distance(sample(spark, [(True, 1.0, 1.0, "a")]), F.col("newer"), ["x"])._jdf.queryExecution().toString()
    assert "Window" in plan and "windowspecdefinition(value" not in plan


def run_of(spark, n, missing, run, at, table="t"):
    rows = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") >= missing, F.col("id")).alias("v"))
    return monitoring.scanned_metrics(rows, table, run, f"2024-01-{at:02d} 00:00:00")


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    store = f"{tmp_path}/metrics"
    assert monitoring.read_metrics(spark, store).count() == 0
    for run, at, n in (("a", 1, 10), ("b", 2, 20), ("a", 3, 99)):
        monitoring.record(run_of(spark, n, 0, run, at), store)
    monitoring.record(run_of(spark, 5, 0, "a", 1, table="other"), store)
    rows = sorted((r.run, r.table, r.row_count) for r in monitoring.read_metrics(spark, store).collect())
    assert rows == [("a", "other", 5), ("a", "t", 10), ("b", "t", 20)]


def test_runs_are_judged_by_earlier_ones_only(spark, tmp_path):
    store = f"{tmp_path}/metrics"
    sizes = [(1000, 10), (1010, 12), (990, 11), (1003, 10), (400, 300), (1005, 10)]
    for i, (n, missing) in enumerate(sizes, 1):
        monitoring.record(run_of(spark, n, missing, f"r{i}", i), store)
    metrics = monitoring.read_metrics(spark, store)
    status = {(i, r.column, r.metric): r.status for i in range(1, 7) for r in monitoring.judge(metrics, f"r{i}").collect()}
    assert {status[i, "", "row_count"] for i in (1, 2, 3)} == {"new"}
    assert [status[i, "", "row_count"] for i in (4, 5, 6)] == ["ok", "anomaly", "ok"]
    assert [status[i, "v", "null_rate"] for i in (4, 5, 6)] == ["ok", "anomaly", "ok"]
    assert status[5, "k", "null_rate"] == "ok"


def test_an_empty_table_has_missing_rates(spark, tmp_path):
    store = f"{tmp_path}/metrics"
    for i in range(1, 5):
        monitoring.record(run_of(spark, 10, 1, f"r{i}", i), store)
    monitoring.record(run_of(spark, 0, 0, "r5", 5), store)
    found = {r.metric: r.status for r in monitoring.judge(monitoring.read_metrics(spark, store), "r5").collect()}
    assert found == {"row_count": "anomaly", "null_rate": "missing"}


def test_freshness_reads_footers_only(spark, tmp_path):
    times = [dt.datetime(2024, 1, 1, 5, 6, 7, 890), None, dt.datetime(2023, 5, 1)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "k int, at timestamp_ntz")
    rows.repartition(3).write.parquet(f"{tmp_path}/with space")
    rows.filter("at is null").write.parquet(f"{tmp_path}/nulls")
    found = monitoring.file_times(spark, {"a": (f"{tmp_path}/with space", "at"), "b": (f"{tmp_path}/nulls", "at")})
    assert sorted(map(tuple, found.collect())) == [("a", 3, times[0]), ("b", 1, None)]
    assert "FileScan" not in found._jdf.queryExecution().toString()
    as_of = F.lit(dt.datetime(2024, 1, 1, 7, 6, 7)).cast("timestamp_ntz")
    late = {r.table: r.stale for r in monitoring.freshness(found, as_of, {"a": 1.5, "b": 1.0}).collect()}
    assert late == {"a": True, "b": None}


def test_times_without_statistics_are_unknown(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    column = pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us"))
    (tmp_path / "t").mkdir()
    pq.write_table(pa.table({"at": column}), tmp_path / "t" / "a.parquet", write_statistics=False)
    assert tuple(monitoring.file_times(spark, {"t": (f"{tmp_path}/t", "at")}).first()) == ("t", 1, None)


def test_a_write_is_observed_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.range(100).select(F.when(F.col("id") > 4, F.col("id")).alias("v")).mapInArrow(seen, "v long")
    row = monitoring.written_metrics(rows, f"{tmp_path}/t", "t", "r", "2024-01-01 00:00:00").first()
    assert (row.row_count, row.nulls[0].null_rate, reads.value) == (100, 0.05, 100)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 100
