"""Mixing sources to target weights that change over the course of training.

Every source has a weight schedule: knots (time, weight) joined by straight lines, time from 0
to 1. The integral of the schedule is the source's weight. Sources share a number of words by
weight; no target exceeds ``cap`` times the source's size. The words of a source form a stream:
all its documents in the order of a hash, again from the start once it is used up. Where a
document's words start in the stream decides, through the inverse of the integrated schedule,
at which time of the training they are read.

Only DataFrame functions are used. A hot source is cut into buckets of the hash, so that no task
sorts more than a bucket; offsets come from one sum per bucket.

Defined results: a null text has size 0; null is a source of its own, the last one; a null key is
the empty text in the hash. Rows of equal key are ordered by size, equal rows are interchangeable.
A source without words has target 0. An empty table gives no rows. Result columns replace columns
of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.llm.common import packed, shuffle_partitions, stage, unpacked, with_rank, word_count

Schedule = Sequence[tuple[float, float]]

#: Level, rising and falling schedules with the integrals 3, 1 and 2.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 3.0), (1.0, 3.0)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 3.0), (0.5, 2.0), (1.0, 1.0)),
)
#: Rows of one source that are sorted together.
BUCKET_ROWS = 8_000
PREFIX_BITS = 28


def integral(schedule: Schedule) -> float:
    return sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(schedule, schedule[1:]))


def inverse(schedule: Schedule, share: Column) -> Column:
    """The time at which the given share of the schedule's integral is reached."""
    whole, done, pieces = integral(schedule), 0.0, []
    for (a, v), (b, w) in zip(schedule, schedule[1:]):
        area = (b - a) * (v + w) / 2
        if area > 0:
            rest = F.greatest(share * whole - F.lit(done), F.lit(0.0))
            speed = F.lit(v) + F.sqrt(F.greatest(F.lit(v * v) + rest * (2 * (w - v) / (b - a)), F.lit(0.0)))
            pieces.append((done + area, F.lit(a) + F.when(rest > 0, 2 * rest / speed).otherwise(F.lit(0.0)), b))
        done += area
    time = F.lit(pieces[-1][2])
    for end, at, b in reversed(pieces):
        time = F.when(share * whole <= end, F.least(at, F.lit(b))).otherwise(time)
    return time


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size -> with kind (rank modulo the number of weights) and target.

    Targets are ``least(level * weight, cap * size)``; the level rises as capped sources hand
    their excess on, until no other one is above its cap. Each round is one aggregation to one row.
    """
    ranked = with_rank(sizes, [F.col("source").asc_nulls_last()], "rank", partitions=8)
    kind = (F.col("rank") % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    rows = stage(
        ranked.withColumn("kind", kind).select(
            "source", "source_size", "kind", weight.alias("weight"), (F.col("source_size") * cap).alias("most")
        ),
        "sources",
    )
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.col("most") < F.lit(level) * F.col("weight")
        n, full, free = rows.agg(
            F.count_if(above), F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (total * share - (full or 0.0)) / free
    target = F.least(F.lit(level) * F.col("weight"), F.col("most"))
    return rows.select("source", "source_size", "kind", target.alias("target"))


def allocate(
    docs: DataFrame,
    size: Column | None = None,
    key: str = "doc_id",
    source: str = "source",
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """Each row with size, source_size, target, copies, taken and positions.

    ``copies`` is how often the mix takes the document, ``taken`` the words of all copies,
    ``positions`` the times of the copies between 0 and 1. A document at the end of the source's
    last round is taken if at least half of it is due, so a source misses its target by at most
    half of one document.
    """
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    prefix = F.conv(F.substring(order, 1, PREFIX_BITS // 4), 16, 10).cast("long")
    rows = packed(
        docs,
        source=F.col(source),
        size=word_count("text") if size is None else size.cast("long"),
        order=order,
        prefix=prefix,
    )
    rows = stage(rows, "sized")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sizes = stage(sizes, "source-sizes")
    most = sizes.agg(F.max("rows")).first()[0] or 0
    bits = min(PREFIX_BITS, max(0, math.ceil(math.log2(max(1, most / BUCKET_ROWS)))))
    rows = rows.withColumn("bucket", F.shiftright("prefix", PREFIX_BITS - bits))

    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    buckets = buckets.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    targets = source_targets(sizes.drop("rows"), [integral(s) for s in schedules], share, cap)
    buckets = (
        buckets.alias("b")
        .join(targets.alias("t"), F.expr("b.source <=> t.source"))
        .select("b.source", "b.bucket", "b.start", "t.source_size", "t.target", "t.kind")
    )
    ahead = (
        Window.partitionBy("source", "bucket")
        .orderBy("order", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    rows = (
        rows.alias("r")
        .join(buckets.alias("b"), F.expr("r.source <=> b.source AND r.bucket = b.bucket"))
        .select("r.row", "r.size", "b.source_size", "b.target", "b.kind", (F.col("start") + F.col("ahead")).alias("before"))
    )
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("int")
    due = F.col("target") - F.col("whole") * F.col("source_size")
    more = (F.col("due") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("due"))
    rows = rows.withColumn("whole", whole).withColumn("due", due)
    rows = rows.withColumn("copies", F.col("whole") + more.cast("int"))
    words = F.col("before") + F.col("size") / 2

    def time(copy: Column) -> Column:
        at = F.least((copy * F.col("source_size") + words) / F.nullif("target", F.lit(0.0)), F.lit(1.0))
        out = inverse(schedules[-1], at)
        for i, schedule in list(enumerate(schedules))[:-1]:
            out = F.when(F.col("kind") == i, inverse(schedule, at)).otherwise(out)
        return F.coalesce(out, F.lit(0.0))

    most = math.ceil(cap)
    times = F.slice(F.array(*[time(F.lit(i)) for i in range(most)]), F.lit(1), F.col("copies"))
    return unpacked(
        rows.withColumn("taken", F.col("copies") * F.col("size")).withColumn("positions", times),
        "size", "source_size", "target", "copies", "taken", "positions",
    )


def arranged(allocated: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per copy, range-sorted by position: the files, read in order, are the training order."""
    n = shuffle_partitions(allocated.sparkSession)
    rows = allocated.select("*", F.posexplode("positions").alias("copy", "position"))
    order = ["position", F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), "copy"]
    return rows.drop("positions").repartitionByRange(n, *order).sortWithinPartitions(*order)
