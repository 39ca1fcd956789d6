"""Row append and reproducible samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bayline.functions.hashing import digest_uniform, hash_uniform, poisson1
from bayline.operators.quantiles import scalar_row


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


#: Bits of a hash that are counted in one round; two rounds make a 32-bit hash.
ROUND_BITS = 16


def _boundary(counts: DataFrame, by: list[str], slot: str) -> DataFrame:
    """Per group the slot that holds the row of rank ``_take``, and how many rows lie before it."""
    inside = Window.partitionBy(*(by or [F.lit(0)])).orderBy(slot)  # at most 2 ** ROUND_BITS rows
    before = F.sum("_n").over(inside) - F.col("_n")
    placed = counts.withColumn("_before", before)
    return placed.filter((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_n")))


def _marked(df: DataFrame, key: str, salt: str, takes: DataFrame, label: str | None, name: str) -> DataFrame:
    """df with a flag for the ``_take`` rows with the smallest hash of their key, per label.

    The hash of that rank is found by counting: first its leading bits, then the rest among the rows that
    share them, then the keys of the few rows with that very hash. No row list is sorted or gathered. Keys
    are unique within a label.
    """
    by = [label] if label else []
    hashed = df.withColumn("_hash", (hash_uniform(F.col(key), salt) * F.lit(float(2**32))).cast("long"))
    slim = hashed.select(*by, F.col(key).alias("_key"), "_hash")

    def with_takes(rows: DataFrame) -> DataFrame:
        return rows.join(takes, by) if by else rows.withColumn("_take", takes.scalar())

    leading = F.shiftright("_hash", ROUND_BITS).alias("_lead")
    first = slim.groupBy(*by, leading).agg(F.count(F.lit(1)).alias("_n"))
    first = _boundary(with_takes(first), by, "_lead").select(*by, "_lead", (F.col("_take") - F.col("_before")).alias("_take"))
    # joined back is one row per label; without labels that is one row
    small = (lambda rows: rows) if by else F.broadcast
    near = slim.withColumn("_lead", F.shiftright("_hash", ROUND_BITS)).join(small(first), [*by, "_lead"])
    second = near.groupBy(*by, "_hash", "_take").agg(F.count(F.lit(1)).alias("_n"))
    second = _boundary(second, by, "_hash").select(*by, "_hash", (F.col("_take") - F.col("_before")).alias("_take"))
    same = near.drop("_lead", "_take").join(small(second), [*by, "_hash"])
    place = F.row_number().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("_key"))
    last = same.withColumn("_place", place).filter("_place = _take").select(*by, F.col("_hash").alias("_last"), F.col("_key").alias("_last_key"))

    if by:
        rows = hashed.join(takes.join(last, by, "left"), by, "left")
    else:
        rows = hashed.withColumn("_take", takes.scalar()).withColumn("_row", scalar_row(last))
        rows = rows.withColumn("_last", F.col("_row._last")).withColumn("_last_key", F.col("_row._last_key")).drop("_row")
    up_to = (F.col("_hash") < F.col("_last")) | ((F.col("_hash") == F.col("_last")) & (F.col(key) <= F.col("_last_key")))
    # without a boundary there are fewer rows than wanted, or none is wanted
    taken = (F.col("_take") > 0) & F.coalesce(up_to, F.lit(True))
    return rows.withColumn(name, F.coalesce(taken, F.lit(False))).drop("_hash", "_take", "_last", "_last_key")


def sample_n(df: DataFrame, key: str, n: int, salt: str) -> DataFrame:
    """n rows without replacement: those with the smallest hash of their key, in no order."""
    takes = df.sparkSession.range(1).select(F.lit(n).cast("long").alias("_take"))
    return _marked(df, key, salt, takes, None, "_taken").filter("_taken").drop("_taken")


PARTS = 4  # 32-bit parts of an md5 digest, one replicate each


def weight_blocks(df: DataFrame, key: str, replicates: int, salt: str) -> DataFrame:
    """Each row once per block of four replicates, with their weights as w0 to w3.

    A weight is a Poisson(1) number from the digest of salt, key and block: over many
    rows that is a sample with replacement, and each task draws it for its own rows.
    """
    blocks = -(-replicates // PARTS)
    digest = F.md5(
        F.concat_ws(":", F.lit(salt), F.col(key).cast("string"), F.col("block").cast("string"))
    )
    return (
        df.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("_digest", digest)
        .withColumns(
            {f"w{part}": poisson1(digest_uniform(F.col("_digest"), part)) for part in range(PARTS)}
        )
        .drop("_digest")
    )


def bootstrap_weights(df: DataFrame, key: str, replicates: int, salt: str) -> DataFrame:
    """Each row once per replicate that draws it, with the number of times as weight."""
    weights = F.array(*[F.col(f"w{part}") for part in range(PARTS)])
    return (
        weight_blocks(df, key, replicates, salt)
        .select(*df.columns, "block", F.posexplode(weights).alias("part", "weight"))
        .withColumn("replicate", F.col("block") * PARTS + F.col("part"))
        .filter((F.col("weight") > 0) & (F.col("replicate") < replicates))
        .drop("block", "part")
    )


def exact_split(df: DataFrame, key: str, label: str, share: float, salt: str) -> DataFrame:
    """Mark ``share`` of the rows of each class as ``is_test``, exactly: each class is off by less than one row.

    The wanted number of all test rows is rounded; classes with the largest remainders get the rows that
    rounding down leaves over, ties by label. Within a class the rows with the smallest hashes are taken. Rows
    without a label are left out.
    """
    rows = df.filter(F.col(label).isNotNull())
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    exact = F.lit(float(share)) * F.col("_n")
    # one row per class
    every = Window.partitionBy(F.lit(0))
    left_over = F.round(F.lit(float(share)) * F.sum("_n").over(every)) - F.sum(F.floor(exact)).over(every)
    place = F.row_number().over(every.orderBy((exact - F.floor(exact)).desc(), label))
    take = (F.floor(exact) + (place <= left_over).cast("int")).cast("long")
    takes = sizes.select(label, take.alias("_take"))
    return _marked(rows, key, salt, takes, label, "is_test")
