import numpy as np
import pytest
from pyspark.sql import functions as F

from bayline.operators import model
from bayline.session import scratch_dir
from bayline.sources.sinks import stage
from bayline.streaming.scoring import (
    first_arrivals,
    parquet_table_stream,
    read_parquet_stream,
    score_stream,
    write_available,
    write_batches,
)


def test_a_fitted_pipeline_scores_a_stream_like_a_table(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, float(rng.normal()), "ab"[i % 2], int(rng.random() < 0.3 + 0.4 * (i % 2)))
        for i in range(200)
    ]
    ddl = "k INT, x DOUBLE, dealer STRING, late INT"
    frame = stage(spark.createDataFrame(rows, ddl), "stream_source")
    fitted = model.fit_logit(frame, "late", ["x"], ["dealer"])
    folder = frame.inputFiles()[0].rsplit("/", 1)[0]
    stream = read_parquet_stream(spark, folder, "*.parquet", ddl)
    out = scratch_dir(spark, "stream_out")
    path = write_available(score_stream(fitted, stream), f"{out}/rows", f"{out}/checkpoint")
    got = {tuple(r) for r in spark.read.parquet(path).collect()}
    assert got == {tuple(r) for r in model.score_and_band(fitted, frame).collect()}
    assert len(got) == 200


def test_a_table_of_part_files_streams_like_a_single_file(spark, tmp_path):
    import shutil

    spark.range(300).repartition(3).write.parquet(str(tmp_path / "lines.parquet"))
    spark.range(300).coalesce(1).write.parquet(str(tmp_path / "one"))
    (single,) = (tmp_path / "one").glob("part-*.parquet")
    shutil.copy(single, tmp_path / "single.parquet")
    for name in ("lines.parquet", "single.parquet"):
        stream = parquet_table_stream(spark, str(tmp_path / name), "id BIGINT")
        out = scratch_dir(spark, "stream_out")
        path = write_available(stream, f"{out}/rows", f"{out}/checkpoint")
        assert spark.read.parquet(path).count() == 300


def arriving(spark, folder):
    return spark.readStream.schema("k INT, x DOUBLE, dealer STRING, late INT, at TIMESTAMP").parquet(f"{folder}/*")


def deliver(spark, folder, number, keys):
    rows = [(k, float(k % 7), "ab"[k % 2], k % 3 == 0) for k in keys]
    df = spark.createDataFrame(rows, "k INT, x DOUBLE, dealer STRING, late BOOLEAN").withColumn("late", F.col("late").cast("int"))
    df = df.withColumn("at", F.lit(f"2024-01-0{number} 00:00:00").cast("timestamp"))
    df.repartition(2).write.parquet(f"{folder}/d{number}")
    return df


def test_repeated_rows_are_scored_once_across_a_restart(spark, tmp_path):
    place = f"{tmp_path}/in"
    first = deliver(spark, place, 1, range(0, 60))
    fit = model.fit_logit(first.drop("at"), "late", ["x"], ["dealer"])

    def run():
        fresh = first_arrivals(arriving(spark, place), ["k"], "at", "3 days")
        return write_batches(score_stream(fit, fresh), f"{tmp_path}/out", f"{tmp_path}/checkpoint")

    run()
    second = deliver(spark, place, 2, [*range(40, 100), *range(90, 100)])
    run()
    run()  # nothing new
    wanted = model.score_and_band(fit, first.unionByName(second).dropDuplicates(["k"]).drop("at"))
    got = spark.read.parquet(f"{tmp_path}/out").drop("at", "batch")
    assert got.count() == 100
    assert {tuple(r) for r in got.select(*wanted.columns).collect()} == {tuple(r) for r in wanted.collect()}


def test_a_batch_that_failed_is_written_once(spark, tmp_path, monkeypatch):
    place, out = f"{tmp_path}/in", f"{tmp_path}/out"
    deliver(spark, place, 1, range(30))
    stream = lambda: first_arrivals(arriving(spark, place), ["k"], "at", "3 days")
    failing = stream().writeStream.foreachBatch(lambda b, n: (b.write.parquet(f"{out}/batch={n}"), 1 / 0))
    with pytest.raises(Exception, match="division by zero|ZeroDivision"):
        failing.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 30  # written, but the batch is not done
    write_batches(stream(), out, f"{tmp_path}/checkpoint")
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == list(range(30))
