"""Connected components of a graph given as pairs of longs, labelled by the smallest member.

Alternating large-star and small-star rounds: every node hands its larger, then its smaller
neighbours to the smallest one it knows. Each round is a minimum per node (combined before the
shuffle) and a join back, whose hot keys AQE splits; its result is written to the shared scratch
folder. Nothing is collected but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.common import stage


def star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs (a > b) -> pairs, after one large-star or small-star step."""
    both = pairs if not large else pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    if large:
        least = least.select("a", F.least("a", "m").alias("m"))
        moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = both.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionAll(least.select("a", F.col("m").alias("b")))
    return moved.filter("a > b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """pairs (a, b) -> node, label for every node of a pair; label is the component's least node."""
    ordered = pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = stage(ordered.distinct(), "links"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            break
        before = seen
        now = stage(star(star(now, large=True), large=False), "links")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(roots)
