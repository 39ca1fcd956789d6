"""Scoring arriving rows with a fitted pipeline or with the band rules.

Each row is scored on its own. A source that may deliver a row twice goes through ``first_arrivals``, whose
state holds the keys of the watermark's span. ``write_batches`` writes each batch to a folder of its own
number: a batch that is run again after a failure replaces what it had written, so every row is there once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.operators.model import risk_band, score_and_band


def read_parquet_stream(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """Files of a folder whose names match, as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def parquet_table_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of part files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(place).isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    folder, _, name = path.rpartition("/")
    return read_parquet_stream(spark, folder, name, schema)


def score_stream(model: PipelineModel, visits: DataFrame) -> DataFrame:
    return score_and_band(model, visits)


def band_stream(scored: DataFrame, probability: str = "delay_probability") -> DataFrame:
    return scored.withColumn("risk_band", risk_band(F.col(probability)))


def first_arrivals(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Rows whose keys have not arrived before, within ``delay`` of event time; later rows are dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def write_batches(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Write what is there now, one folder per batch, then stop; the number of batches of this run."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(query.recentProgress)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> str:
    """Write all rows that are there now as parquet, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return path
