"""Bytes of long repeated strings, found through a logarithmic family of sorted suffix tables.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.

Suffixes: a full suffix array holds several bytes for each byte of text, per level of the family, so only
suffixes at anchors are kept. The anchor of a string of LENGTH bytes is the start of the first of
its strings of ``GRAM`` bytes with the smallest hash; equal strings have equal anchors. Consecutive starts
with one anchor form a segment, at most LENGTH - GRAM + 1 starts. A table is sorted by ``key``, the
hash of the suffix's first GRAM bytes, and has for each ``context``, the hash of all bytes that the segment's
strings cover, how often it occurs.

Family: documents come in batches. The sorted table of a batch is merge-scanned against each
level for keys that occur in both, then becomes a level; two levels of equal rank merge to one of
the next rank, so there are logarithmically many. Keys that occur once have no repeated string.
A context that occurs twice is repeated whole. Where different contexts share a key, the hashes of their
strings are compared, in one task per key or, for a key with many contexts, in several that each
have a residue of the hash.

Defined results: null is the empty text; texts shorter than LENGTH stay as they are; repeated rows
are copies of each other, also with equal or null ids. A document is known by a hash of its id and
text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.llm.common import row_chunks, shuffle_partitions, stage, text_bytes
from bayline.llm.kneser_ney import BASE, mix, powers

LENGTH = 200
GRAM = 32
BATCHES = 2
#: Starts that a task looks at together, and contexts of one key that one task compares.
PIECE = 1 << 19
MANY_CONTEXTS = 5_000
LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Hashes:
    """Hash of any substring of a piece of text."""

    def __init__(self, raw: np.ndarray):
        size = 1 << max(12, len(raw).bit_length())
        if size not in _powers:
            _powers[size] = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)
        up, self.down = _powers[size]
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(LETTERS[raw] * up[: len(raw)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.down[starts])


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values."""
    n = len(values) - width + 1
    full = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max)
    full[: len(values)] = values
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first and last start, key and context of each segment of the texts."""
    n = len(raw)
    if n < LENGTH:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashes = Hashes(raw)
    at = np.arange(n - GRAM + 1, dtype=np.int64)
    grams = hashes.of(at, at + GRAM)
    bits = np.uint64(max(1, len(at).bit_length()))
    least = window_least(grams >> bits << bits | at.astype(np.uint64), LENGTH - GRAM + 1)
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = at[: len(anchor)]
    inside = row[starts] == row[starts + LENGTH - 1]
    starts, anchor = starts[inside], anchor[inside]
    if not len(starts):
        return segments(raw[:0], offsets)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first = np.flatnonzero(new)
    low, high, place = starts[first], starts[np.append(first[1:], len(starts)) - 1], anchor[first]
    key = grams[place]
    # the place of the anchor and the length belong to the context
    context = mix(hashes.of(low, high + LENGTH) ^ ((place - low) << 32 | (high - low)).astype(np.uint64))
    text = row[low]
    return text, low - offsets[text], high - offsets[text], key, context


def pieces(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts, and long texts in parts that overlap by LENGTH - 1 bytes: first row,
    place of the part in its text, bytes and offsets."""
    for i, j in row_chunks(offsets, PIECE):
        a, b = int(offsets[i]), int(offsets[j])
        if b - a <= 2 * PIECE:
            yield i, 0, raw[a:b], offsets[i : j + 1] - a
            continue
        for part in range(a, b - LENGTH + 1, PIECE):
            to = min(part + PIECE + LENGTH - 1, b)
            yield i, part - a, raw[part:to], np.array([0, to - part])


def segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: row and text -> row, low, high, key, context."""
    for batch in batches:
        rows = batch.column("row").to_numpy()
        raw, offsets = text_bytes(batch.column("text"))
        for first, place, part, ends in pieces(raw, offsets):
            text, low, high, key, context = segments(part, ends)
            columns = [rows[first + text], (low + place).astype(np.int32), (high + place).astype(np.int32), key.view(np.int64), context.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "low", "high", "key", "context"])


def merged_levels(found: DataFrame, batches: int) -> tuple[DataFrame, DataFrame]:
    """Table of the whole family, and the keys that occur more than once."""
    levels: list[tuple[int, DataFrame]] = []
    repeated = None
    for batch in range(batches):
        rows = found.filter(F.pmod("row", F.lit(batches)) == batch).groupBy("key", "context").agg(F.count("*").alias("n"))
        rows = stage(rows.sortWithinPartitions("key"), "suffixes")
        keys = rows.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
        for _, level in levels:  # merge-scan: both sides come sorted by key
            keys = keys.unionAll(rows.select("key").join(level.select("key"), "key", "left_semi"))
        keys = stage(keys.distinct(), "repeated-keys")
        repeated = keys if repeated is None else repeated.unionAll(keys)
        levels.append((0, rows))
        while len(levels) > 1 and levels[-1][0] == levels[-2][0]:
            (rank, a), (_, b) = levels.pop(), levels.pop()
            both = a.unionAll(b).groupBy("key", "context").agg(F.sum("n").alias("n"))
            levels.append((rank + 1, stage(both.sortWithinPartitions("key"), "suffixes") if batch + 1 < batches else both))
    family = levels[0][1]
    for _, level in levels[1:]:
        family = family.unionAll(level)
    return family, repeated.distinct()


def string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: texts with segments to compare -> (key, part, row, low, starts, strings), hashes packed."""
    schema = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("row", pa.int64()), ("low", pa.int32()), ("starts", pa.binary()), ("strings", pa.binary())])
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for row, text, listed in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("segments")):
            raw = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            for segment in sorted(listed.as_py(), key=lambda s: s["low"]):
                low, high = segment["low"], segment["high"]
                hashes = Hashes(raw[low : high + LENGTH])
                at = np.arange(high - low + 1)
                strings = hashes.of(at, at + LENGTH)
                residue = strings % np.uint64(segment["parts"])
                for part in range(segment["parts"]):
                    some = residue == part
                    if some.any():
                        for column, value in zip(out, (segment["key"], part, row, low, at[some].astype(np.uint8).tobytes(), strings[some].astype("<u8").tobytes())):
                            column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)


def shared_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: string_rows sorted by (key, part) -> (row, low, high) of strings that two contexts share."""

    def compared(table: pa.Table) -> pa.RecordBatch:
        lengths = np.array([len(s) for s in table["starts"].to_pylist()], np.int64)
        key = np.repeat(table["key"].to_numpy(), lengths).view(np.uint64)
        start = np.frombuffer(b"".join(table["starts"].to_pylist()), np.uint8) + np.repeat(table["low"].to_numpy().astype(np.int64), lengths)
        row = np.repeat(table["row"].to_numpy(), lengths)
        string = mix(key) ^ np.frombuffer(b"".join(table["strings"].to_pylist()), "<u8")
        _, back, n = np.unique(string, return_inverse=True, return_counts=True)
        twice = n[back] > 1
        found = np.unique(np.stack((row[twice], start[twice])), axis=1)
        row, start = found
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))) if len(row) else np.empty(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1 if len(first) else first
        return pa.RecordBatch.from_arrays([pa.array(row[first]), pa.array(start[first].astype(np.int32)), pa.array(start[last].astype(np.int32))], names=["row", "low", "high"])

    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        kept = table if kept is None else pa.concat_tables([kept, table])
        if len(kept) > 2 * MANY_CONTEXTS:
            key, part = kept["key"].to_numpy(), kept["part"].to_numpy()
            whole = np.flatnonzero((key != key[-1]) | (part != part[-1]))
            if len(whole):
                yield compared(kept.slice(0, int(whole[-1]) + 1))
                kept = kept.slice(int(whole[-1]) + 1)
    if kept is not None and len(kept):
        yield compared(kept)


def without_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: doc_id, text and ranges of starts -> what is left, and the removed spans."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary()), ("kept_sha256", pa.string())])
    for batch in batches:
        rows = []
        for doc, text, ranges in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("ranges")):
            raw, spans = (text.as_py() or "").encode(), []
            for low, high in sorted((r["low"], r["high"] + LENGTH) for r in ranges.as_py() or []):
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], high)
                else:
                    spans.append([low, high])
            edges = [0, *(x for span in spans for x in span), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((doc, len(raw), len(raw) - len(kept), spans, kept, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def repeated_ranges(texts: DataFrame, batches: int = BATCHES) -> DataFrame:
    """row, text -> row, low, high: ranges of starts of repeated strings, a few for each row."""
    spark = texts.sparkSession
    found = stage(texts.mapInArrow(segment_rows, "row long, low int, high int, key long, context long"), "segments")
    family, repeated = merged_levels(found, batches)
    groups = stage(family.join(repeated, "key", "left_semi").groupBy("key", "context").agg(F.sum("n").alias("n")), "repeated-contexts")
    shared = groups.groupBy("key").agg(F.count("*").alias("contexts")).filter("contexts > 1")
    shared = stage(shared.select("key", F.ceil(F.col("contexts") / MANY_CONTEXTS).cast("int").alias("parts")), "shared-keys")
    groups = groups.join(shared, "key", "left").filter("n > 1 OR parts IS NOT NULL")
    flagged = stage(found.join(groups, ["key", "context"]), "flagged-segments")
    whole = flagged.filter("n > 1").select("row", "low", "high")
    one = flagged.filter("parts IS NOT NULL").groupBy("key", "context", "parts").agg(F.min(F.struct("row", "low", "high")).alias("s"))
    lists = one.groupBy(F.col("s.row").alias("row")).agg(
        F.collect_list(F.struct("key", "parts", F.col("s.low").alias("low"), F.col("s.high").alias("high"))).alias("segments")
    )
    strings = texts.join(stage(lists, "segments-to-compare"), "row").mapInArrow(
        string_rows, "key long, part int, row long, low int, starts binary, strings binary"
    )
    dealt = strings.repartition(shuffle_partitions(spark), "key", "part").sortWithinPartitions("key", "part")
    partial = dealt.mapInArrow(shared_starts, "row long, low int, high int")
    return whole.unionAll(stage(partial, "shared-strings"))


def row_hash(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans, kept (bytes) and kept_sha256 of each row."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("row", row_hash("doc_id", "text"))
    ranges = repeated_ranges(rows.select("row", "text"), batches)
    # the ranges of a row are bounded by its length
    lists = ranges.groupBy("row").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    joined = rows.join(stage(lists, "ranges"), "row", "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(without_spans, "doc_id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary, kept_sha256 string")
