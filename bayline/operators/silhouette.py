"""Silhouette in plain Euclidean distance, exact by default, or of a sample with its standard error.

The mean distance to a cluster does not follow from sums of the cluster, so every vector has to meet every
other one: the work is (distinct vectors) x (evaluated vectors) and nothing makes it less. It is dealt as a grid.
Repeated vectors of a label are one row with a weight. Rows are gathered once to tiles, which are what is shuffled, and
some tiles make a group of bounded size. Each pair of groups meets in one task, in matrix products that fit into the
cache of a core, and serves both groups. A task holds one group and a tile of the other and gives one sum per row and
cluster, so no pairs are written, and what is shuffled is each tile once per group: rows x rows / ``GROUP_BYTES`` of
vectors, in the width they came in. For large tables give ``sample``: only that share of the vectors is
evaluated, still against all others, and ``standard_error`` tells how far the mean may be off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.functions.hashing import hash_uniform
from bayline.sources.sinks import stage

TILE = 1024
#: A tile is one row of a shuffle and holds at most so many bytes of vectors, so that no row is too large to move.
TILE_BYTES = 2**20
#: A group holds at most so many bytes of vectors and so many tiles; small inputs are dealt to so many groups.
GROUP_BYTES = 2**23
GROUP_TILES = 16
LEAST_GROUPS = 24
#: So many rows of a tile meet so many of another in one product; its result stays in the cache of a core.
CELL = 256
#: A squared distance below this share of the two squared norms has lost digits in the product and is done again.
NEAR = 1e-6
SALT = "silhouette"


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(float, copy=False)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, one dimension after the other, so that near rows keep their digits."""
    total = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]))
    for i in range(a.shape[-1]):
        gap = a[..., i] - b[..., i]
        total += gap * gap
    return total


def _centre(x: np.ndarray) -> np.ndarray:
    """A middle that neither far rows nor rows that are not finite move away."""
    finite = x[np.isfinite(x).all(axis=1)]
    return np.median(finite, axis=0) if len(finite) else np.zeros(x.shape[1])


@dataclass
class _Rows:
    """Vectors and, less a centre, what they bring to a matrix product that gives squared distances."""

    x: np.ndarray
    norms: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def __len__(self) -> int:
        return len(self.x)

    def cells(self, step: int) -> list[_Rows]:
        parts = self.x, self.norms, self.left, self.right
        return [_Rows(*(p[i : i + step] for p in parts)) for i in range(0, len(self), step)]


def _centred(x: np.ndarray, centre: np.ndarray) -> _Rows:
    with np.errstate(over="ignore", invalid="ignore"):
        p = x - centre
        norms, ones = (p * p).sum(axis=1), np.ones(len(x))
        return _Rows(x, norms, np.column_stack([-2.0 * p, norms, ones]), np.column_stack([p, ones, norms]))


def _distances(a: np.ndarray | _Rows, b: np.ndarray | _Rows) -> np.ndarray:
    """All distances between rows (of one centre) by a matrix product; those of near rows by their differences."""
    if isinstance(b, np.ndarray):
        centre = _centre(b)
        a, b = _centred(a, centre), _centred(b, centre)
    with np.errstate(over="ignore", invalid="ignore"):
        total = a.left @ b.right.T
        if not total.min() > NEAR * (a.norms.max() + b.norms.max()):
            near = ~(total > NEAR * (a.norms[:, None] + b.norms))  # also what is not finite
            if 8 * np.count_nonzero(near) > near.size:
                total = _squared(a.x[:, None], b.x[None])
            else:
                i, j = np.nonzero(near)
                total[i, j] = _squared(a.x[i], b.x[j])
        return np.sqrt(total, out=total)


class _Tile:
    """Members with their sums of distances to the clusters of the tiles met so far, for those that are evaluated."""

    def __init__(self, number: int, members: pa.Array, centre: np.ndarray | None, clusters: int, step: int) -> None:
        label, weight, chosen, x = (members.field(f) for f in ("label", "weight", "chosen", "x"))
        x, chosen = _matrix(x, len(members)), chosen.to_numpy(zero_copy_only=False)
        self.number, self.centre = number, _centre(x) if centre is None else centre
        self.cells, self.whole = _centred(x, self.centre).cells(step), chosen.all()
        self.evaluated = self.cells if self.whole else _centred(x[chosen], self.centre).cells(step)
        towards = np.zeros((len(x), clusters))
        towards[np.arange(len(x)), label.to_numpy()] = weight.to_numpy()
        self.towards = [towards[i : i + step] for i in range(0, len(x), step)]
        self.sums = [np.zeros((len(cell), clusters)) for cell in self.evaluated]

    def add(self, other: _Tile) -> None:
        """Distances of the evaluated rows to another tile, or to the tile itself."""
        for own, out in zip(self.evaluated, self.sums):
            for cell, towards in zip(other.cells, other.towards):
                out += _distances(own, cell) @ towards

    def meet(self, other: _Tile) -> None:
        """Two tiles serve each other; where all rows are evaluated, by the same distances."""
        if not (self.whole and other.whole):
            self.add(other)
            other.add(self)
            return
        for own, own_towards, own_sums in zip(self.cells, self.towards, self.sums):
            for cell, towards, out in zip(other.cells, other.towards, other.sums):
                d = _distances(own, cell)
                own_sums += d @ towards
                out += d.T @ own_towards

    def result(self) -> Iterator[pa.RecordBatch]:
        if self.sums:
            columns = [pa.array([self.number], pa.int32()), pa.array([np.concatenate(self.sums).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["tile", "sums"])


def _summer(clusters: int, tile: int, group_tiles: int = 1):
    """For mapInArrow over tiles sorted by pair -> per tile of a pair, the sums of distances to the clusters of the other group.

    Tiles are numbered group by group. The first group of a pair is held, the tiles of the other go by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, []
        for batch in batches:
            for r in range(batch.num_rows):
                own_pair, number = batch.column("pair")[r].as_py(), batch.column("tile")[r].as_py()
                if pair != own_pair:
                    for kept in held:
                        yield from kept.result()
                    pair, held = own_pair, []
                members = batch.column("members").slice(r, 1).flatten()
                own = _Tile(number, members, held[0].centre if held else None, clusters, min(tile, CELL))
                itself = batch.column("itself")[r].as_py()
                other = bool(held) and held[0].number // group_tiles != number // group_tiles
                if itself or other:
                    for kept in held:
                        kept.meet(own)
                if itself:
                    own.add(own)
                if other:
                    yield from own.result()
                else:
                    held.append(own)
        for kept in held:
            yield from kept.result()

    return run


def _scorer(sizes: list[int]):
    """For mapInArrow over sums sorted by tile, labels and weights of the tile first -> (weight, score) per vector."""
    n = np.array(sizes, float)

    def scores(labels: np.ndarray, weights: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        rows = np.arange(len(labels))
        with np.errstate(divide="ignore", invalid="ignore"):
            inner = sums[rows, labels] / (n[labels] - 1)
            others = sums / n
            others[rows, labels] = np.inf
            outer = others.min(axis=1)
            score = (outer - inner) / np.maximum(inner, outer)
        score = np.where((n[labels] == 1) | ~np.isfinite(score), 0.0, score)
        return pa.RecordBatch.from_arrays([pa.array(weights), pa.array(score)], names=["weight", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for r in range(batch.num_rows):
                sums = batch.column("sums")[r].as_py()
                if sums is None:
                    if own is not None:
                        yield scores(*own)
                    members = batch.column("evaluated").slice(r, 1).flatten()
                    labels, weights = members.field("label").to_numpy(), members.field("weight").to_numpy()
                    own = labels, weights, np.zeros((len(labels), len(n)))
                else:
                    own[2][:] += np.frombuffer(sums).reshape(own[2].shape)
        if own is not None:
            yield scores(*own)

    return run


def euclidean_silhouette(
    df: DataFrame, vector: str, label: str, sample: float | None = None, tile: int = TILE
) -> DataFrame:
    """One row: n, silhouette_score, standard_error (0 without a sample).

    Rows without a label or vector are left out; a cluster of one row scores 0, as does a single cluster. Labels are a
    short closed list. A sample is drawn by a hash of label and vector and is the same in every run.
    """
    kind = df.select(vector).schema[0].dataType.simpleString()
    x = F.col(vector).cast(kind if kind == "array<float>" else "array<double>")
    rows = df.select(F.col(label).alias("_label"), x.alias("x")).dropna()
    rows = stage(rows.groupBy("_label", "x").agg(F.count(F.lit(1)).alias("weight")), "distinct-vectors")
    spark = rows.sparkSession
    per_label = rows.groupBy("_label").agg(
        F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows"), F.max(F.size("x")).alias("width")
    )
    sizes = sorted(per_label.collect(), key=lambda r: str(r[0]))
    if not sizes:
        return spark.createDataFrame([(0, None, None)], "n long, silhouette_score double, standard_error double")
    index = F.lit(0)
    for i, r in enumerate(sizes):
        index = F.when(F.col("_label") == F.lit(r[0]), i).otherwise(index)
    rows = rows.select(index.alias("label"), "weight", "x")
    drawn = hash_uniform(F.xxhash64("label", F.col("x").cast("array<double>")), SALT)
    chosen = F.lit(True) if sample is None else drawn < sample

    distinct, width = sum(r["rows"] for r in sizes), max(1, *(r["width"] for r in sizes))
    most = max(1, min(GROUP_TILES * tile, GROUP_BYTES // (8 * width)))
    groups = max(math.ceil(distinct / most), min(LEAST_GROUPS, math.ceil(distinct / tile)))
    tile_rows = max(1, min(tile, TILE_BYTES // (8 * width)))
    group_tiles = math.ceil(distinct / groups / tile_rows)
    number = F.pmod(F.xxhash64("x", "label"), F.lit(groups * group_tiles)).cast("int").alias("tile")
    members = F.collect_list(F.struct("label", "weight", chosen.alias("chosen"), "x")).alias("members")
    tiles = stage(rows.groupBy(number).agg(members), "tiles")  # written, so that the order within a tile stays
    # the pair of two groups is numbered by the smaller and the larger of them
    own = F.floor(F.col("tile") / group_tiles)
    spread = tiles.repartition(groups, "tile").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    paired = spread.select(
        (F.least(own, "other").cast("long") * groups + F.greatest(own, "other")).alias("pair"),
        "tile",
        (own == F.col("other")).alias("itself"),
        "members",
    )
    dealt = paired.repartition(groups * (groups + 1) // 2, "pair").sortWithinPartitions("pair", "tile")
    sums = dealt.mapInArrow(_summer(len(sizes), tile, group_tiles), "tile int, sums binary")
    chosen_members = F.transform(F.filter("members", lambda m: m["chosen"]), lambda m: F.struct(m["label"], m["weight"]))
    evaluated = tiles.select("tile", chosen_members.alias("evaluated"))
    both = sums.unionByName(evaluated, allowMissingColumns=True)
    gathered = both.repartition(groups, "tile").sortWithinPartitions("tile", F.col("sums").isNotNull())
    scored = gathered.mapInArrow(_scorer([r["n"] for r in sizes]), "weight long, score double")

    w, s = F.col("weight"), F.col("score")
    sums = scored.agg(F.sum("weight").alias("n"), F.sum(w * s).alias("ws"), F.sum(w * w).alias("w2"), F.sum(w * w * s).alias("w2s"), F.sum(w * w * s * s).alias("w2s2"))
    mean = F.col("ws") / F.col("n")
    spread = F.col("w2s2") - F.lit(2.0) * mean * F.col("w2s") + mean * mean * F.col("w2")
    error = F.lit(0.0) if sample is None else F.sqrt(F.greatest(spread, F.lit(0.0)) * F.lit(1.0 - sample)) / F.col("n")
    total = F.lit(sum(r["n"] for r in sizes)).cast("long")
    return sums.select(total.alias("n"), mean.alias("silhouette_score"), error.alias("standard_error"))
