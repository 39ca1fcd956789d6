"""Writers: single results, numbered results of a script and the whole mart."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from bayline.session import scratch_dir


# the default pattern of the CSV writer would cut the microseconds
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def write_result(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> str:
    """Write one table, replacing an earlier one. Executors write; nothing is collected."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.options(
            header=True,
            timestampFormat=CSV_TIMESTAMP,
            timestampNTZFormat=CSV_TIMESTAMP,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_numbered(
    results: Sequence[DataFrame], out_dir: str, stem: str, fmt: str = "parquet"
) -> list[str]:
    """Write results under ``<out_dir>/<stem>_01``, ``_02`` and so on."""
    return [
        write_result(df, f"{out_dir}/{stem}_{i:02d}", fmt)
        for i, df in enumerate(results, start=1)
    ]


def write_marts(
    marts: Mapping[str, DataFrame],
    path: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Write each table of a mart below one folder, facts partitioned by month.

    Rows of one partition value go to few files: the value is shuffled together, and AQE
    splits values that hold very many rows.
    """
    written = {}
    for name, df in marts.items():
        columns = list((partition_by or {}).get(name, ()))
        out = df.hint("rebalance", *columns) if columns else df
        written[name] = write_result(out, f"{path}/{name}", partition_by=columns)
    return written


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared scratch folder and go on from the files.

    For a table that several later steps read: it is computed once, and a lost executor
    costs a re-read instead of the whole lineage.
    """
    path = write_result(df, scratch_dir(df.sparkSession, purpose))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A parquet table, or no rows where nothing has been written yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append_missing(rows: DataFrame, path: str, schema: str, keys: Sequence[str]) -> None:
    """Append the rows whose keys are not in the table yet, so that a repeated run changes nothing."""
    known = read_if_there(rows.sparkSession, path, schema).select(*keys)
    rows.join(known, list(keys), "left_anti").write.mode("append").parquet(path)


CURRENT = "_current.json"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it over the old one, in one step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place, store = _files(spark, path)
    other = hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    out = store.create(other, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    option = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = option.getField("OVERWRITE").get(None)
    context = hadoop.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(store.makeQualified(other), store.makeQualified(place), options)


def current_version(spark: SparkSession, path: str) -> dict | None:
    """The published manifest: version and folder of each table; None before the first one."""
    place, store = _files(spark, f"{path}/{CURRENT}")
    if not store.exists(place):
        return None
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(store.open(place), "UTF-8")
    return json.loads(text)


def publish_marts(
    marts: Mapping[str, DataFrame],
    path: str,
    version: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Write all tables of a mart to a folder of their own version, then switch the manifest to it.

    Until the switch readers see the former version, whole; a run that fails leaves a folder that no manifest
    names, and the next run of that version writes it anew. The published version itself is never rewritten.
    """
    spark = next(iter(marts.values())).sparkSession
    now = current_version(spark, path)
    if now is not None and now["version"] == version:
        raise ValueError(f"version {version} is published; a new one needs another name")
    written = write_marts(marts, f"{path}/versions/{version}", partition_by)
    relative = {name: f"versions/{version}/{name}" for name in written}
    _replace_file(spark, f"{path}/{CURRENT}", json.dumps({"version": version, "tables": relative}))
    return written


def read_published(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All tables of the published version; the manifest is read once, so they are of one run."""
    now = current_version(spark, path)
    if now is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return {name: spark.read.parquet(f"{path}/{folder}") for name, folder in now["tables"].items()}


def drop_versions(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> list[str]:
    """Delete all versions but the published one and those named; call it once no reader is at them."""
    now = current_version(spark, path)
    kept = {*keep, *([now["version"]] if now else [])}
    place, store = _files(spark, f"{path}/versions")
    if not store.exists(place):
        return []
    gone = [f.getPath() for f in store.listStatus(place) if f.getPath().getName() not in kept]
    for folder in gone:
        store.delete(folder, True)
    return sorted(folder.getName() for folder in gone)
