"""SimHash fingerprints, their links within a Hamming radius, and near-duplicate groups.

Candidates: 64 bits are cut into six blocks. Fingerprints that differ in three bits at most agree
in three whole blocks, so each of the 20 choices of three blocks is a key of 30 to 33 bits, and
every linked pair shares a key. Within a key the comparison is bit-sliced: 64 fingerprints form a
block that is stored as 64 words, one per bit plane, lane by lane. A fingerprint is compared with
all lanes of a block at once: each plane is inverted where the bit is set, the differences enter
vertical counters by carry-save addition, and a block is dropped once no lane is within the radius.

A key with very many fingerprints is cut into tiles; each pair of tiles is a task of bounded size.
A task passes on one link per fingerprint to the smallest one it is joined with, not all pairs:
links matter for what they connect. Distinct fingerprints are compared, so copies cost nothing.

Words are runs of bytes other than the six ASCII spaces, A-Z are lower-cased, the shingles are
joined by one space, and a text with fewer words is one shingle. Defined results: null or blank
texts have the fingerprint 0, linked like any other. Rows with a null id have a component only
through others; ids may repeat. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from bayline.llm.common import packed, shuffle_partitions, stage, unpacked
from bayline.llm.components import components

SEED = 42
WIDTH = 3
RADIUS = 3
#: Widths of the six blocks; any three of them are one key.
BLOCKS = (11, 11, 11, 11, 10, 10)
TILE = 8192
#: Hashes whose bits are counted at once.
COUNT_AT_ONCE = 1 << 15
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Bit i is set if over half of the shingles' hashes have it set."""
    words = text.lower().split()  # bytes: ASCII letters and the six ASCII spaces only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    for i in range(0, n, COUNT_AT_ONCE):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + COUNT_AT_ONCE], stops[i : i + COUNT_AT_ONCE])]
        bits = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = ones * 2 > n
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprints(texts):
    values = [fingerprint(t.encode() if t is not None else b"") for t in texts]
    return pd.Series(np.array(values, np.uint64).view(np.int64))


def keys(fp: np.ndarray) -> np.ndarray:
    """The 20 keys of each fingerprint: number of the choice and its three blocks in one long."""
    starts = np.cumsum((0, *BLOCKS[:-1]))
    parts = [(fp >> np.uint64(s)) & np.uint64((1 << w) - 1) for s, w in zip(starts, BLOCKS)]
    out = []
    for number, chosen in enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - RADIUS)):
        key = np.full(len(fp), number, np.uint64)
        for c in chosen:
            key = (key << np.uint64(BLOCKS[c])) | parts[c]
        out.append(key)
    return np.stack(out, axis=1)


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: fp -> (key, fp), 20 rows each."""
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        found = keys(fp)
        columns = [found.ravel().view(np.int64), np.repeat(fp, found.shape[1]).view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "fp"])


def planes(fp: np.ndarray) -> np.ndarray:
    """Bit planes of blocks of 64 fingerprints: [block, bit] is a word with one lane per fingerprint."""
    blocks = -(-len(fp) // 64)
    full = np.zeros(blocks * 64, "<u8")
    full[: len(fp)] = fp
    bits = np.unpackbits(full.view(np.uint8).reshape(blocks, 64, 8), axis=2, bitorder="little")
    packed_bits = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed_bits).view("<u8").reshape(blocks, 64)


def near_lanes(sliced: np.ndarray, block: np.ndarray, fp: np.ndarray, lanes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each i the lanes of sliced[block[i]], among lanes[i], within the radius of fp[i].

    Counters are vertical: ``ones``, ``twos`` and, once more than three differ, ``over``.
    """
    if radius != 3:
        raise ValueError("the counters are two planes wide: the radius is 3")
    result, live = np.zeros(len(fp), np.uint64), np.arange(len(fp))
    ones, twos, over = np.zeros(len(fp), np.uint64), np.zeros(len(fp), np.uint64), ~lanes
    for bit in range(64):
        invert = np.where((fp >> np.uint64(bit)) & np.uint64(1), ALL, np.uint64(0))
        differs = sliced[block, bit] ^ invert
        carry = ones & differs
        ones = ones ^ differs
        over = over | (twos & carry)
        twos = twos ^ carry
        if bit % 8 == 7:  # blocks without a lane left are abandoned
            on = over != ALL
            if not on.all():
                live, block, fp, ones, twos, over = live[on], block[on], fp[on], ones[on], twos[on], over[on]
            if not len(live):
                break
    result[live] = ~over
    return result


class Forest:
    """Union of fingerprints by the smallest one."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def links(group: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of equal group; rows sorted by group. One link per joined row."""
    n = len(fp)
    sliced, row = planes(fp), np.arange(n)
    last = np.searchsorted(group, group, "right")  # end of the row's group
    forest = Forest(n)
    step, active = 0, row
    while len(active):
        block = active // 64 + step
        low, high = np.maximum(active + 1 - block * 64, 0), np.minimum(last[active] - block * 64, 64)
        onward = active[last[active] > (block + 1) * 64]  # also rows in the last lane of their block
        some = high > low
        active, block, low, high = active[some], block[some], low[some], high[some]
        upto = np.where(high >= 64, ALL, (np.uint64(1) << np.minimum(high, 63).astype(np.uint64)) - np.uint64(1))
        lanes = upto & ~((np.uint64(1) << low.astype(np.uint64)) - np.uint64(1))
        near = near_lanes(sliced, block, fp[active], lanes, radius)
        hit = np.flatnonzero(near)
        lane_bits = np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, lane = np.nonzero(lane_bits)
        for i, j in zip(active[hit][which].tolist(), (block[hit][which] * 64 + lane).tolist()):
            forest.join(i, j)
        active, step = onward, step + 1
    roots = np.array([forest.root(i) for i in range(n)], np.int64)
    joined = roots != row
    return fp[joined], fp[roots[joined]]


def tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: rows sorted by (key, part) -> links. A (key, part) is bounded by its tiles."""
    kept: list[np.ndarray] = [np.empty(0, np.int64)] * 3

    def found(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, part, fp = columns
        if len(key):
            group = np.cumsum(np.concatenate(([0], (np.diff(key) != 0) | (np.diff(part) != 0))))
            a, b = links(group, fp.view(np.uint64))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "part", "fp")]
        kept = [np.concatenate(c) for c in zip(kept, columns)]
        if len(kept[0]) >= 4 * TILE:  # whole groups only
            key, part, _ = kept
            cut = int(np.flatnonzero((key != key[-1]) | (part != part[-1]))[-1] + 1) if (key[0], part[0]) != (key[-1], part[-1]) else 0
            yield from found([c[:cut] for c in kept])
            kept = [c[cut:] for c in kept]
    yield from found(kept)


def fingerprint_links(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (column fp) -> links (a, b) that connect all within the radius."""
    spark = distinct.sparkSession
    keyed = distinct.mapInArrow(key_rows, "key long, fp long")
    sizes = keyed.groupBy("key").count().filter("count > 1")
    sizes = stage(sizes.select("key", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "keys")
    rows = keyed.join(sizes, "key")
    # tile t meets tile u >= t in part t * tiles + u; a key with one tile has the one part 0
    tile_of = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    parts = F.transform(others, lambda u: (F.least(u, tile_of) * F.col("tiles") + F.greatest(u, tile_of)).cast("long"))
    rows = rows.select("key", "fp", F.explode(parts).alias("part"))
    dealt = rows.repartition(shuffle_partitions(spark), "key", "part").sortWithinPartitions("key", "part", "fp")
    return dealt.mapInArrow(tile_links, "a long, b long").distinct()


def grouped(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Each row with fingerprint (16 hex digits) and component_id (least id of its component).

    ``keep`` names the columns of ``docs`` to return, all by default.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    rows = docs.select(row.alias("row"), F.col(key).alias("id"), fingerprints(F.col(text)).alias("fp"))
    rows = stage(rows, "fingerprints")
    return unpacked(with_components(rows), "fingerprint", "component_id")


def with_components(rows: DataFrame) -> DataFrame:
    """rows with id and fp -> the same with fingerprint and component_id."""
    least = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    labels = components(fingerprint_links(least.select("fp")))
    labelled = least.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "fp"))
    firsts = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = labelled.join(firsts, "label").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(classes, "fp").withColumn("fingerprint", hexed)


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of fingerprints: that with the smallest id, of equal ids the least whole row.

    Rows of a component without any id are one group as well; one of them stays. Whole rows are told apart
    by their 64-bit hash.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(key).alias("id"), fingerprints(F.col(text)).alias("fp"), F.xxhash64(whole).alias("tie"))
    rows = stage(rows, "fingerprints")
    group = F.coalesce("component_id", "fp").alias("group")
    found = with_components(rows).select("id", "tie", group, F.col("component_id").isNull().alias("nameless"))
    best = found.groupBy("group", "nameless").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "tie")).alias("best"))
    keep = best.select(F.col("best.id").alias("id"), F.col("best.tie").alias("tie")).distinct()
    marked = packed(docs, id=F.col(key)).withColumn("tie", F.xxhash64("row"))
    kept = marked.alias("r").join(keep.alias("k"), F.expr("r.id <=> k.id AND r.tie = k.tie"), "left_semi")
    return unpacked(kept.dropDuplicates(["id", "tie"]))
