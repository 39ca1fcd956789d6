"""Exact top-k by integer inner product over a bit-sliced index.

A component x enters as floor(1024 * x). Vectors are dealt to blocks; in a block every dimension is
stored as bit slices, bitmaps with one bit per vector. The index is one file per block in the shared folder,
written once; vectors are not moved again, queries are dealt to the blocks. A query's scores are the sum of its
components times the dimensions: slices shifted by the set bits of the component, added by
carry-save full adders on whole bitmaps until one slice per weight is left. The best rows are then
selected from the most significant slice downward: rows certainly in, and rows still tied. Rows tied
at the boundary are resolved by the smaller id. The best rows of all blocks are merged per query.

A task answers a bounded number of queries over one block, which it maps or, where the folder is not mounted, reads;
nothing is broadcast. What is shuffled is each query once per block and its best rows of each block.

Defined results: vectors that are null, or hold a null, NaN or infinite component take no part. Slices are as
wide as a block's components need, and sums are exact at any width; a component, or a score among the best,
that leaves 64 bits ends the query with an error. A missing component counts as 0. Rows with a null id take no part. Rows that share an id are rows of their own, but a query is
never compared with rows of its own id; equal scores of equal ids are ordered arbitrarily, they are
equal rows of the result. Extra columns are ignored. Fewer candidates than k give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.llm.common import shuffle_partitions, stage
from bayline.llm.files import local_path, open_file, write_file
from bayline.session import scratch_dir

SCALE = 1024
#: Vectors in a block, and queries that a task answers over it.
BLOCK = 32_768
QUERY_BLOCK = 128
#: From here on a scaled component is no 64-bit number.
BEYOND = 2.0**63
SCORES = "query_id long, vec_id long, score long"


def slices(values: np.ndarray) -> tuple[list[list[np.ndarray]], np.ndarray, int]:
    """Bit slices of each column minus its least value; these values; the width."""
    low = values.min(0)
    shifted = values.view(np.uint64) - low.view(np.uint64)  # below 2 ** 64, whatever the signs
    width = max(1, int(shifted.max()).bit_length())
    n = -(-len(values) // 64) * 64
    out = []
    for column in shifted.T:
        padded = np.zeros(n, np.uint64)
        padded[: len(column)] = column
        bits = [(padded >> np.uint64(b)) & np.uint64(1) for b in range(width)]
        out.append([np.packbits(b.astype(np.uint8), bitorder="little").view("<u8") for b in bits])
    return out, low, width


def add(columns: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Bitmaps listed by weight -> one slice per weight, by full and half adders."""
    total, weight = [], 0
    while weight < len(columns):
        pending = columns[weight]
        if weight + 1 == len(columns) and len(pending) > 1:
            columns.append([])
        while len(pending) > 2:
            a, b, c = pending.pop(), pending.pop(), pending.pop()
            half = a ^ b
            columns[weight + 1].append((a & b) | (c & half))
            pending.append(half ^ c)
        if len(pending) == 2:
            a, b = pending.pop(), pending.pop()
            columns[weight + 1].append(a & b)
            pending.append(a ^ b)
        total.append(pending[0] if pending else np.zeros(words, np.uint64))
        weight += 1
    return total


def best_rows(total: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest sums among the rows of a bitmap; ties by position."""
    sure, tied = np.zeros_like(rows), rows
    for plane in reversed(total):
        high = tied & plane
        n = int(np.bitwise_count(sure).sum() + np.bitwise_count(high).sum())
        if n > k:
            tied = high
        else:
            sure, tied = sure | high, tied & ~plane
            if n == k:
                tied = np.zeros_like(tied)
                break
    found = positions(sure)
    return np.concatenate((found, positions(tied)[: k - len(found)]))


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


@dataclass
class Block:
    """Ids in ascending order, and for each dimension its least value and the slices above it."""

    ids: np.ndarray
    low: np.ndarray
    planes: np.ndarray  # dimension, bit, word

    def to_bytes(self) -> list[bytes]:
        dims, width, words = self.planes.shape
        head = np.array([len(self.ids), dims, width, words], "<u8")
        return [head.tobytes(), self.ids.astype("<i8").tobytes(), self.low.astype("<i8").tobytes(), self.planes.astype("<u8").tobytes()]

    @classmethod
    def at(cls, uri: str) -> Block:
        path = local_path(uri)
        if path is None:
            with open_file(uri) as source:
                data = np.frombuffer(source.read(), "<u8")
        else:
            data = np.memmap(path, "<u8", "r").view(np.ndarray)  # plain arrays: operations on maps are slower
        n, dims, width, words = (int(x) for x in data[:4])
        ids, low, planes = np.split(data[4:], [n, n + dims])
        return cls(ids.view(np.int64), low.view(np.int64), planes.reshape(dims, width, words))


def block_of(ids: np.ndarray, values: np.ndarray) -> Block:
    order = np.argsort(ids, kind="stable")
    sliced, low, _ = slices(values[order])
    return Block(ids[order], low, np.array(sliced, "<u8"))


def search(block: Block, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple]:
    """(query id, ids, scores) of the best rows of one block. A component that either side lacks counts as 0."""
    ids, low, sliced = block.ids, block.low, block.planes
    dims, width, words = sliced.shape
    everything = np.packbits(np.arange(words * 64) < len(ids), bitorder="little").view("<u8")
    inverted = ~sliced & everything  # as large as the block, once for all its queries
    full = (1 << width) - 1
    for query_id, query in zip(query_ids.tolist(), queries.tolist()):
        own = np.packbits(np.concatenate((ids == query_id, np.zeros(words * 64 - len(ids), bool))), bitorder="little").view("<u8")
        columns: list[list[np.ndarray]] = [[]]
        offset = 0
        for d, q in enumerate(query[:dims]):
            # a negative component is its absolute value times the inverted slices, and a constant
            offset += q * int(low[d]) + (q * full if q < 0 else 0)
            source, q = (sliced[d], q) if q >= 0 else (inverted[d], -q)
            shift = 0
            while q >> shift:
                if q >> shift & 1:
                    while len(columns) < shift + width:
                        columns.append([])
                    for b, plane in enumerate(source):
                        columns[shift + b].append(plane)
                shift += 1
        total = add(columns, words)
        best = best_rows(total, everything & ~own, k)
        scores = [offset] * len(best)
        for weight, plane in enumerate(total):
            bit = (plane[best >> 6] >> (best & 63).astype(np.uint64)) & np.uint64(1)
            scores = [s + (b << weight) for s, b in zip(scores, bit.tolist())]
        if any(not -(1 << 63) <= s < 1 << 63 for s in scores):
            raise OverflowError(f"a score of query {query_id} leaves 64 bits")
        yield query_id, ids[best], np.array(scores, np.int64)


def write_block(path: str):
    """For applyInArrow: the vectors of one block -> its file."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        lengths = pa.compute.list_value_length(table["x"]).to_numpy()
        values = matrix(table["x"].combine_chunks(), lengths, int(max(lengths.max(), 1)))
        write_file(f"{path}/block-{part:06d}", block_of(table["id"].to_numpy(), values).to_bytes())
        return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([len(table)], pa.int64())})

    return run


def block_search(path: str, k: int):
    """For applyInArrow: queries of one block of vectors -> its best rows."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lengths = pa.compute.list_value_length(table["x"]).to_numpy()
        queries = matrix(table["x"].combine_chunks(), lengths, int(max(lengths.max(), 1)))
        found = {"query_id": [np.empty(0, np.int64)], "vec_id": [np.empty(0, np.int64)], "score": [np.empty(0, np.int64)]}
        block = Block.at(f"{path}/block-{key[0].as_py():06d}")
        for query_id, best, scores in search(block, table["id"].to_numpy(), queries, k):
            found["query_id"].append(np.full(len(best), query_id))
            found["vec_id"].append(best)
            found["score"].append(scores)
        return pa.table({n: np.concatenate(c) for n, c in found.items()})

    return run


def matrix(lists, lengths: np.ndarray, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    out = np.zeros((len(lengths), width), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class Index:
    """Blocks of bit slices of the vectors (vec_id, embedding), written to the shared folder."""

    def __init__(self, vectors: DataFrame, scale: int = SCALE, block: int = BLOCK):
        spark, self.scale = vectors.sparkSession, scale
        self.path = scratch_dir(spark, "bit-slices")
        rows = quantised(vectors, scale)
        self.count = max(1, -(-rows.count() // block))
        part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(self.count)).cast("long").alias("part")
        dealt = rows.select(part, "id", "x").repartition(self.count, "part")
        written = dealt.groupBy("part").applyInArrow(write_block(self.path), "part long, n long")
        #: part and number of vectors of each block
        self.blocks = stage(written, "blocks")

    def top_k(self, queries: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK) -> DataFrame:
        """query_id, rank, vec_id, score for queries (vec_id, embedding); rows of a query's own id are left out."""
        asked = quantised(queries, self.scale)
        query_blocks = max(1, -(-asked.count() // query_block))
        # a block is empty only if there are few vectors
        empty: set[int] = set()
        if self.blocks.count() < self.count:
            empty = set(range(self.count)) - {r.part for r in self.blocks.select("part").collect()}
        group = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(query_blocks)).alias("query_part")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.count - 1).cast("long"))).alias("part")
        dealt = asked.select(every, group, "id", "x").filter(~F.col("part").isin(sorted(empty)) if empty else F.lit(True))
        dealt = dealt.repartition(max(shuffle_partitions(asked.sparkSession), 1), "part", "query_part")
        scored = dealt.groupBy("part", "query_part").applyInArrow(block_search(self.path, k), SCORES)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")


def quantised(df: DataFrame, scale: int) -> DataFrame:
    """id and whole components of the vectors that take part."""

    def component(v: Column) -> Column:
        scaled = v.cast("double") * scale
        too_large = F.raise_error(F.concat(F.lit("a component leaves 64 bits: "), v.cast("string"))).cast("long")
        return F.when((scaled >= -BEYOND) & (scaled < BEYOND), F.floor(scaled)).otherwise(too_large)

    x = F.transform("embedding", component)
    finite = F.forall("embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(v))
    kept = df.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return stage(kept.select(F.col("vec_id").cast("long").alias("id"), x.cast("array<long>").alias("x")), "quantised")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score. Both tables have vec_id and embedding; queries may be among the vectors."""
    return Index(vectors, scale, block).top_k(queries, k, query_block)
