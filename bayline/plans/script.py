"""Running a list of SQL statements and listing their results."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.sources.sinks import write_result

_COMMENT_LINE = re.compile(r"^\s*--[^\n]*$|/\*.*?\*/", re.MULTILINE | re.DOTALL)
# a statement ends at a semicolon outside of quotes and comments
_STATEMENT = re.compile(
    r"(?:'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|--[^\n]*|/\*.*?\*/|[^;'\"])+", re.DOTALL
)


def statements_of(text: str) -> list[str]:
    """Statements of a script, without empty and comment-only ones."""
    found = [s.strip() for s in _STATEMENT.findall(text)]
    return [s for s in found if _COMMENT_LINE.sub("", s).strip()]


def returns_rows(statement: str) -> bool:
    return _COMMENT_LINE.sub("", statement).strip().upper().startswith(("SELECT", "WITH"))


def run_script(
    spark: SparkSession, statements: str | Sequence[str], out_dir: str, stem: str = "result"
) -> dict[str, str]:
    """Run the statements in order and write each query result under its number.

    Gives name and path of the results. The first failing statement ends the run.
    """
    if isinstance(statements, str):
        statements = statements_of(statements)
    written: dict[str, str] = {}
    for statement in statements:
        result = spark.sql(statement)
        if returns_rows(statement):
            name = f"{stem}_{len(written) + 1:02d}"
            written[name] = write_result(result, f"{out_dir}/{name}")
    return written


def result_catalog(results: Mapping[str, DataFrame], preview: int = 5) -> DataFrame:
    """Rows, columns, column names and a short preview of every result.

    The preview holds the first rows in the order of their text, so it does not depend
    on how the result is partitioned.
    """
    frames = []
    for name, df in results.items():
        text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row")
        sizes = df.agg(F.count(F.lit(1)).alias("row_count"))
        top = df.select(text).orderBy("row").limit(preview)
        rows = top.agg(F.array_join(F.sort_array(F.collect_list("row")), "\n")).scalar()
        frames.append(
            sizes.select(
                F.lit(name).alias("result"),
                "row_count",
                F.lit(len(df.columns)).alias("column_count"),
                F.lit(", ".join(df.columns)).alias("columns"),
                rows.alias("preview"),
            )
        )
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
