"""CSV scans with an explicit schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType


def _reader(spark: SparkSession, schema: str | StructType, mode: str, multiline: bool):
    options = {"header": True, "mode": mode, "multiLine": multiline, "escape": '"'}
    return spark.read.schema(schema).options(**options)


def _number(column: str, kind: DataType) -> Column:
    """Not a number is missing in floating columns; infinities stay."""
    value = F.col(f"`{column}`")
    return F.when(~F.isnan(value), value).alias(column) if kind.typeName() in ("float", "double") else value


def load_csv(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    """CSV with a header; an empty field is missing, a field that does not parse or is NaN too.

    A quoted field may hold line breaks, so a file is read by one task: write many files. With
    ``multiline=False`` the caller promises that there are none, and files are split.
    """
    df = _reader(spark, schema, "PERMISSIVE", multiline).csv(path)
    return df.select(*[_number(f.name, f.dataType) for f in df.schema.fields])


def register_csv(
    spark: SparkSession, name: str, path: str, schema: str, multiline: bool = True
) -> DataFrame:
    """CSV as a named view, without the rows that do not fit the schema.

    The reader alone checks only the columns a query selects, so a row that is bad in
    another column would come back. Here the fields are read as text, and a row is kept if
    every present field casts to its type; that test reads all columns in every query.
    """
    wanted = StructType.fromDDL(schema)
    text = StructType([StructField(f.name, StringType()) for f in wanted.fields])
    raw = _reader(spark, text, "DROPMALFORMED", multiline).csv(path)
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in wanted.fields}
    fits = [F.col(c).isNull() | cast.isNotNull() for c, cast in casts.items()]
    df = raw.filter(reduce(lambda a, b: a & b, fits)).select(
        *[cast.alias(c) for c, cast in casts.items()]
    )
    df = df.select(*[_number(f.name, f.dataType) for f in wanted.fields])
    df.createOrReplaceTempView(name)
    return df
