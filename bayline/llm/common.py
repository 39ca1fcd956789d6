"""What the operators share: session settings, tables, global ranks, UTF-8 bytes of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.session import scratch_dir, tune

#: Words are runs of bytes other than space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"
#: Rows that Spark hands to a Python worker at once; texts may be long.
ROWS_PER_BATCH = "256"
#: Bytes of text that a task works on at once; numpy temporaries take about 60 times as much.
CHUNK_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared scratch folder, tightly packed, and go on from the files."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one struct ``row`` beside working columns, so that no names clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, *names: str) -> DataFrame:
    """The columns of ``row`` and the named ones; a named one replaces one of the row."""
    kept = [f for f in df.schema["row"].dataType.names if f not in names]
    return df.select(*[F.col(f"row.`{f}`").alias(f) for f in kept], *names)


def word_count(text: str | Column) -> Column:
    """Number of words; null has none."""
    words = F.array_remove(F.split(text, SPACES), "")
    return F.coalesce(F.size(words), F.lit(0)).cast("long")


def with_rank(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None, rows_name: str | None = None) -> DataFrame:
    """df with the 0-based position of each row in a total order, as column ``name``.

    ``rows_name`` names a column for the number of all rows.

    Spark range-partitions and sorts; the sorted rows are written once to the shared scratch
    folder, and one row per range gives the offsets. No task holds more than its range.
    """
    ranges = df.repartitionByRange(partitions or shuffle_partitions(df.sparkSession), *order)
    at = F.monotonically_increasing_id()
    rows = stage(ranges.sortWithinPartitions(*order).withColumn("_at", at), "ranked")
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).count().collect()  # one row per range
    offsets, total = [], 0
    for part_id, n in sorted(tuple(r) for r in counts):
        offsets.append((part_id, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _start long")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    if rows_name:
        rows = rows.withColumn(rows_name, F.lit(total).cast("long"))
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # as many rows as ranges
        .withColumn(name, F.col("_start") + within)
        .drop("_at", "_part", "_start")
    )


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together; a longer row is alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
