"""Joins and aggregations in which one key holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from bayline.operators import cleaning, joins
from bayline.session import RUNTIME_CONF

ROWS = 90_000
CONF = {
    **RUNTIME_CONF,
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
}


@pytest.fixture(scope="module")
def skewed(spark):
    before = {key: spark.conf.get(key, None) for key in CONF}
    for key, value in CONF.items():
        spark.conf.set(key, value)
    i = F.col("id")
    fact = spark.range(0, ROWS, 1, 6).select(
        i.alias("row"),
        F.when(i % 3 == 0, F.lit(7)).otherwise(i % 5000).alias("k"),
        F.sha2(i.cast("string"), 256).alias("payload"),
    )
    parent = spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("p"))
    yield fact, parent
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def split(df):
    """Whether the executed plan splits the hot partition of a sort-merge join."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return "skew=true" in plan


def test_hot_key_is_split_in_every_join_of_a_fact(skewed):
    fact, parent = skewed
    known = fact.filter("k < 4000").count()
    left = joins.attach_parent(fact, parent, "k", ["p"])
    assert left.count() == ROWS and split(left)
    semi = joins.keep_valid(fact, "k", parent, "k")
    assert semi.count() == known and split(semi)
    anti = joins.orphans(fact.withColumn("k", F.col("k") + 3990), "k", parent, "k")
    assert split(anti)
    expanded = joins.expand_children(parent, fact, "k")
    childless = 4000 - fact.filter("k < 4000").select("k").distinct().count()
    assert expanded.count() == known + childless and split(expanded)


def test_a_join_before_a_group_on_the_same_key_is_split_too(skewed):
    fact, parent = skewed
    joined = joins.attach_parent(fact, parent, "k", ["p"])
    grouped = joined.groupBy("k").agg(F.sum("p").alias("s"), F.max("payload").alias("m"))
    assert split(grouped)


def test_keep_first_sends_one_row_per_key_and_task(skewed):
    fact, _ = skewed
    first = cleaning.keep_first(fact, "k", ["row"])
    rows = first.filter("k = 7").collect()
    assert [(r.k, r.row) for r in rows] == [(7, 0)]
    assert first.count() == fact.select("k").distinct().count()
