"""Exact samples and splits by counting hash prefixes."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bayline.functions import hashing
from bayline.operators import sampling


def plain_order(keys, salt):
    return sorted(keys, key=lambda k: (int(hashlib.md5(f"{salt}:{k}".encode()).hexdigest()[:8], 16), k))


@pytest.mark.parametrize("n", [0, 1, 37, 999, 1000, 5000])
def test_a_sample_has_the_smallest_hashes(spark, n):
    df = spark.range(1000).withColumn("_other", F.col("id") % 3).repartition(5)
    got = sampling.sample_n(df, "id", n, "s")
    assert got.columns == df.columns
    assert sorted(r.id for r in got.collect()) == sorted(plain_order(range(1000), "s")[:n])


def test_ties_of_the_hash_go_by_key(spark, monkeypatch):
    monkeypatch.setattr(sampling, "hash_uniform", lambda key, salt: (key % 4) / F.lit(4.0))
    got = sorted(r.id for r in sampling.sample_n(spark.range(100), "id", 30, "s").collect())
    assert got == sorted([*range(0, 100, 4), *range(1, 20, 4)])


def test_no_sort_of_all_rows_and_no_limit(spark):
    plan = sampling.sample_n(spark.range(1000), "id", 10, "s")._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" not in plan and "Sort [" not in plan
    assert spark.createDataFrame([], "id long").transform(lambda d: sampling.sample_n(d, "id", 5, "s")).count() == 0


def test_shares_of_classes_are_exact(spark):
    rng = random.Random(4)
    labels = ["a"] * 333 + ["b"] * 101 + ["c"] * 7 + ["d"] + [None] * 20
    rng.shuffle(labels)
    df = spark.createDataFrame(list(enumerate(labels)), "id long, label string")
    rows = sampling.exact_split(df, "id", "label", 0.2, "x").collect()
    sizes = Counter(r.label for r in rows)
    test = Counter(r.label for r in rows if r.is_test)
    assert sizes == {"a": 333, "b": 101, "c": 7, "d": 1}
    assert sum(test.values()) == round(0.2 * 442)
    assert all(abs(test[c] - 0.2 * n) < 1 for c, n in sizes.items())
    for c in sizes:
        members = [i for i, label in enumerate(labels) if label == c]
        assert {r.id for r in rows if r.label == c and r.is_test} == set(plain_order(members, "x")[: test[c]])


def test_the_whole_and_none(spark):
    df = spark.range(50).withColumn("label", F.col("id") % 3)
    for share in (0.0, 1.0):
        assert {r.is_test for r in sampling.exact_split(df, "id", "label", share, "x").collect()} == {bool(share)}
    assert sampling.exact_split(df.limit(0), "id", "label", 0.5, "x").count() == 0


def test_hash_bits_are_whole(spark):
    rows = spark.range(2000).select((hashing.hash_uniform(F.col("id"), "s") * F.lit(float(2**32))).alias("h")).collect()
    assert all(r.h == int(r.h) for r in rows)
