"""Hash products over sequences: the monoid of pairs (length, sum of h_i * B ** i) modulo 2 ** 61 - 1.

The product of two sequences is known from theirs: lengths add up, and the second sum is multiplied by the
power of the first length. So is that of a suffix, because B has an inverse. Two bases make two lanes; a plain
sum is a lane of base one.

``prefix_products`` sorts a table by key and order over ranges. Each task goes through its range once and
writes local products; one row per range (its last key) gives what the next one starts with, so a key with
very many rows is spread over ranges.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from bayline.llm.common import shuffle_partitions, stage

P = (1 << 61) - 1
LOW31, LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
MOD = np.uint64(P)


def folded(x: np.ndarray) -> np.ndarray:
    """Any unsigned 64-bit numbers modulo P."""
    x = (x & MOD) + (x >> np.uint64(61))
    return np.where(x >= MOD, x - MOD, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo P of numbers below P, by halves of 31 bits."""
    a1, a0, b1, b0 = a >> np.uint64(31), a & LOW31, b >> np.uint64(31), b & LOW31
    middle = a1 * b0 + a0 * b1
    return folded((a1 * b1 << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & LOW30) << np.uint64(31)) + a0 * b0)


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return folded(a + (MOD - b))


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** n modulo P; negative exponents are those of the inverse."""
    out = np.ones(len(exponents), np.uint64)
    for sign in (1, -1):
        left = np.maximum(exponents * sign, 0).astype(np.uint64)
        square = base if sign > 0 else pow(base, -1, P)
        while left.any():
            out = np.where(left & np.uint64(1), times(out, np.uint64(square)), out)
            left >>= np.uint64(1)
            square = square * square % P
    return out


def running(values: np.ndarray) -> np.ndarray:
    """Cumulative sums modulo P."""
    low, high = np.cumsum(values & LOW31), np.cumsum(values >> np.uint64(31))
    return folded(folded(low) + times(folded(high), np.uint64(1 << 31)))


def as_words(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64) if isinstance(column, pa.Array) else column.to_numpy().view(np.uint64)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def local_products(key: str, lanes: Sequence[tuple[str, int]], schema: StructType, kept: Sequence[str]):
    """For mapInArrow over sorted rows: products within the task's range, before and through each row."""
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        lead, now, n, sums = None, None, 0, [0] * len(lanes)
        for batch in batches:
            keys = batch.column(key).to_numpy()
            lead = keys[0] if lead is None else lead
            if now != keys[0]:
                now, n, sums = keys[0], 0, [0] * len(lanes)
            starts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
            which = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
            place = np.arange(len(keys)) - starts[which] + np.where(which == 0, n, 0)
            out = {c: batch.column(c) for c in kept}
            out |= {"_part": pa.array(np.full(len(keys), part, np.int32)), "_lead": pa.array(keys == lead), "place": pa.array(place)}
            for i, (lane, base) in enumerate(lanes):
                value = folded(as_words(batch.column(lane)))
                value = times(value, powers(base, place)) if base != 1 else value
                whole = running(value)
                before = minus(whole, value)
                before = minus(before, before[starts][which])  # from the start of the key
                before = folded(before + np.where(which == 0, np.uint64(sums[i]), np.uint64(0)))
                through = folded(before + value)
                out |= {f"{lane}_before": signed(before), f"{lane}_through": signed(through)}
                sums[i] = int(through[-1])
            now, n = keys[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([out[c] for c in names], names=names)

    return run


def continued(lanes: Sequence[tuple[str, int]], carried: dict[int, tuple[int, list[int]]], names: Sequence[str]):
    """For mapInArrow: local products, with what earlier ranges hold of the range's first key put before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("_part").to_numpy()
            lead = batch.column("_lead").to_numpy(zero_copy_only=False)
            out = {c: batch.column(c) for c in names}
            for p in np.unique(part[lead]).tolist():
                if p not in carried:
                    continue
                n, sums = carried[p]
                mine = lead & (part == p)
                out["place"] = pa.array(out["place"].to_numpy() + np.where(mine, n, 0))
                for (lane, base), first in zip(lanes, sums):
                    for side in ("before", "through"):
                        own = as_words(out[f"{lane}_{side}"])
                        moved = folded(times(own, np.uint64(pow(base, n, P))) + np.uint64(first))
                        out[f"{lane}_{side}"] = signed(np.where(mine, moved, own))
            yield pa.RecordBatch.from_arrays([out[c] for c in names], names=names)

    return run


def prefix_products(rows: DataFrame, key: str, order: Sequence[str], lanes: Sequence[tuple[str, int]], keep: Sequence[str]) -> DataFrame:
    """key, the columns of ``keep``, place (from 0 within the key), and for each lane (column, base) of longs
    the products ``<lane>_before`` and ``<lane>_through`` each row. The key is a long and not null."""
    spark = rows.sparkSession
    kept = [key, *(c for c in keep if c != key)]
    names = [f"{lane}_{side}" for lane, _ in lanes for side in ("before", "through")]
    fields = [rows.schema[c] for c in kept] + [StructField("_part", IntegerType()), StructField("_lead", BooleanType())]
    schema = StructType(fields + [StructField(n, LongType()) for n in ("place", *names)])
    ranges = rows.repartitionByRange(shuffle_partitions(spark), key, *order).sortWithinPartitions(key, *order)
    local = stage(ranges.mapInArrow(local_products(key, lanes, schema, kept), schema), "products")

    last = F.max_by(F.struct(key, "place", *[f"{lane}_through" for lane, _ in lanes]), F.struct(key, "place"))
    ends = local.groupBy("_part").agg(F.min(key).alias("first"), last.alias("last")).collect()  # one row per range
    carried, key_now, n, sums = {}, None, 0, [0] * len(lanes)
    for part, first, end in sorted((r["_part"], r["first"], tuple(r["last"])) for r in ends):
        here, own, own_n = end[0], list(end[2:]), end[1] + 1
        if first == key_now:
            carried[part] = (n, sums)
            if here == first:
                own = [(s + o * pow(base, n, P)) % P for s, o, (_, base) in zip(sums, own, lanes)]
                own_n += n
        key_now, n, sums = here, own_n, own
    whole = StructType([f for f in schema.fields if f.name not in ("_part", "_lead")])
    return local.mapInArrow(continued(lanes, carried, whole.names), whole)
