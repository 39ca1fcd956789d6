"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is cut into cells of about equal row counts (cut points over all rows), the cells
of a row give its index on the Hilbert curve, and rows are range-sorted by that index. Runs of
the sorted rows are the shards, so each shard covers a small box of every dimension and readers
can skip shards by the minimum and maximum of each column.

Equal texts are a group: the cell of its smallest key decides for all, so the copies lie side by side and only
a shard's edge can part them. Within a group rows follow the curve by their own cells, so shards of a large group
can be pruned as well.

Law ``rows``: the numbers of rows of two shards differ by one at most, whatever the keys are.

Defined results: null and NaN lie in the lowest cell of their dimension; strings are compared whole, by their
bytes; within a cell rows are ordered by the checksum and the hash of the text, their own place on the curve and
their key; a null text has checksum 0 and is a group of its own. Repeated rows keep their number. An empty
table gives no rows. Result columns replace columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bayline.llm.common import packed, shuffle_partitions, stage, unpacked, with_rank

BITS = 4
#: The curve is a table of 2 ** (dimensions * bits) rows; it is broadcast.
MOST_CURVE_BITS = 16
ACCURACY = 10_000
#: Groups of equal texts with several cells, of three numbers each, up to which they are broadcast.
BROADCAST_ROWS = 1 << 20


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``cells`` (rows x dimensions)."""
    x = cells.T.astype(np.int64).copy()
    dims, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations of the finer levels
        low = q - 1
        for i in range(dims):
            inverted = (x[i] & q) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverted, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), top
    while q > 1:
        flip ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def curve_table(spark: SparkSession, dims: int, bits: int) -> DataFrame:
    if dims * bits > MOST_CURVE_BITS:
        raise ValueError(f"{dims} dimensions of {bits} bits: at most {MOST_CURVE_BITS} bits together")
    code = np.arange(1 << (dims * bits))
    cells = np.stack([(code >> (bits * i)) & ((1 << bits) - 1) for i in range(dims)], axis=1)
    pairs = zip(code.tolist(), curve_index(cells, bits).tolist())
    return spark.createDataFrame(list(pairs), "cell long, curve long")


STRINGS = ("string", "varchar", "char", "binary")


def as_ordered(df: DataFrame, name: str) -> Column:
    """An order-preserving number; strings as they are."""
    kind, value = df.schema[name].dataType.typeName(), F.col(f"`{name}`")
    if kind in STRINGS:
        return value
    if kind in ("float", "double"):
        return F.when(~F.isnan(value), value.cast("double"))
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind == "timestamp_ntz":
        return value.cast("timestamp").cast("double")
    return value.cast("double")


def string_cuts(df: DataFrame, value: Column, shares: Sequence[float]) -> list:
    """The least strings up to which the given shares of all rows lie.

    Strings are counted, the counts range-partitioned and summed up within each range; one row per range
    gives what lies before it, and one string per share comes back.
    """
    counts = df.select(value.alias("value")).dropna().groupBy("value").agg(F.count("*").alias("n"))
    ranges = counts.repartitionByRange(shuffle_partitions(df.sparkSession), "value").withColumn("part", F.spark_partition_id())
    ranges = stage(ranges, "string-counts")
    offsets, total = [], 0
    for part, n in sorted(tuple(r) for r in ranges.groupBy("part").agg(F.sum("n")).collect()):  # one row per range
        offsets.append((part, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, "part int, start long")
    end = F.col("start") + F.sum("n").over(Window.partitionBy("part").orderBy("value"))
    placed = ranges.join(F.broadcast(starts), "part").withColumn("end", end)  # as many rows as ranges
    positions = F.array(*[F.lit(max(1, math.ceil(s * total))).cast("long") for s in shares])
    here = F.exists(positions, lambda p: (p <= F.col("end")) & (p > F.col("end") - F.col("n")))
    return [r[0] for r in placed.filter(here).select("value").collect()]  # at most one per share


def cell_code(df: DataFrame, dims: Sequence[str], bits: int) -> Column:
    """The cells of a row in one number; cut points are quantiles over all rows of ``df``."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    texts = [d for d in dims if df.schema[d].dataType.typeName() in STRINGS]
    numbers = [d for d in dims if d not in texts]
    cuts = {d: string_cuts(df, as_ordered(df, d), shares) for d in texts}
    if numbers:
        found = df.agg(*[F.percentile_approx(as_ordered(df, d), shares, ACCURACY) for d in numbers]).first()
        cuts |= dict(zip(numbers, found))
    code = F.lit(0).cast("long")
    for i, name in enumerate(dims):
        value = as_ordered(df, name)
        cell = sum((F.coalesce(value > F.lit(c), F.lit(False)).cast("long") for c in sorted(set(cuts[name] or []))), F.lit(0).cast("long"))
        code = code + F.shiftleft(cell, bits * i)
    return code


def with_group_cells(rows: DataFrame) -> DataFrame:
    """rows with cell, crc, hash and key: the cell of a group's smallest key for all its rows, beside own_cell.

    Only groups whose cells differ are joined; so few of them are broadcast that they fit a task, more are joined
    by a shuffle.
    """
    first = F.min(F.struct(F.col("key").isNull().alias("no"), "key", "cell"))
    groups = rows.groupBy("hash", "crc").agg(first.alias("first"), F.min("cell").alias("low"), F.max("cell").alias("high"))
    split = stage(groups.filter("low < high").select("hash", "crc", F.col("first.cell").alias("group_cell")), "split-groups")
    split = F.broadcast(split) if split.count() <= BROADCAST_ROWS else split
    joined = rows.join(split, ["hash", "crc"], "left")
    return joined.withColumn("own_cell", F.col("cell")).withColumn("cell", F.coalesce("group_cell", "cell")).drop("group_cell")


def shards(
    docs: DataFrame,
    count: int,
    dims: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    bits: int = BITS,
) -> DataFrame:
    """Each row with curve (its group's), shard and slot (position within the shard, from 0)."""
    checksum = F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0))
    rows = packed(docs, cell=cell_code(docs, dims, bits), crc=checksum, hash=F.xxhash64(F.col(text)), key=F.col(key))
    rows = with_group_cells(rows)
    curve = curve_table(docs.sparkSession, len(dims), bits)
    rows = rows.join(F.broadcast(curve), "cell").join(F.broadcast(curve.toDF("own_cell", "own")), "own_cell")
    order = [F.col(c) for c in ("curve", "crc", "hash", "own", "key")]
    rows = with_rank(rows, order, "rank", rows_name="n")
    rows = rows.withColumn("shard", F.expr(f"CAST(rank * {count} DIV n AS INT)"))
    first = f"((CAST(shard AS BIGINT) * n + {count - 1}) DIV {count})"
    return unpacked(rows.withColumn("slot", F.expr(f"rank - {first}")), "curve", "shard", "slot")


def write_shards(sharded: DataFrame, path: str, dims: Sequence[str]) -> DataFrame:
    """Write a folder per shard and a manifest with the bounds of each dimension; the manifest."""
    sharded.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/data")
    written = sharded.sparkSession.read.parquet(f"{path}/data")
    bounds = [f(f"`{d}`").alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(f"`{d}`").isNull()).alias(f"nulls_{d}") for d in dims]
    manifest = written.groupBy("shard").agg(F.count("*").alias("rows"), *bounds, *nulls)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return sharded.sparkSession.read.parquet(f"{path}/manifest")


def read_shards(spark: SparkSession, path: str, bounds: Mapping[str, tuple]) -> DataFrame:
    """Rows whose columns lie within closed bounds; shards outside are not read."""
    manifest, data = spark.read.parquet(f"{path}/manifest"), spark.read.parquet(f"{path}/data")
    near, inside = F.lit(True), F.lit(True)
    for name, (low, high) in bounds.items():
        near &= (F.col(f"max_{name}") >= low) & (F.col(f"min_{name}") <= high)
        inside &= F.col(f"`{name}`").between(low, high)
    wanted = [r.shard for r in manifest.filter(near).select("shard").collect()]  # one row per shard
    return data.filter(F.col("shard").isin(wanted) & inside)
