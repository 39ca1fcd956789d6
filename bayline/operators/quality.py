"""Profile, rules, relationship checks and the integrity gate.

Rules are data. All row rules of a table are counted in one scan, whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.functions.flags import flag_label

# fixed values: texts of the issue report
MISSING = ("Missing Values", "Investigate and handle based on business meaning")
DUPLICATE = ("Duplicate Primary Key", "Remove duplicate records after investigation")
ORPHAN = ("Invalid Foreign Key", "Remove or correct orphan records")
HIGH, MEDIUM = "High", "Medium"

# groups of the report, in the order in which the rules are checked
MISSING_GROUP, DUPLICATE_GROUP, FK_GROUP, RULE_GROUP = 1, 2, 3, 4

@dataclass(frozen=True)
class Rule:
    """Rows of a table for which the SQL condition ``broken`` holds are an issue."""

    table: str
    column: str
    issue_type: str
    broken: str
    severity: str
    action: str
    always: bool = False  # report the rule even if no row breaks it


def order_rule(table: str, column: str, other: str, op: str, issue: str, action: str) -> Rule:
    """Rule ``column op other``; a missing side breaks nothing."""
    return Rule(table, column, issue, f"`{column}` {op} `{other}`", HIGH, action)


def range_rule(
    table: str, column: str, op: str, bound: float, issue: str, action: str, severity: str = HIGH
) -> Rule:
    """Rule on values below, above or at most a bound."""
    return Rule(table, column, issue, f"`{column}` {op} {bound}", severity, action)


def domain_rule(
    table: str, column: str, values: Sequence[float], issue: str, action: str
) -> Rule:
    """Rule on values that are present but not in the list."""
    listed = ", ".join(str(v) for v in values)
    return Rule(table, column, issue, f"`{column}` NOT IN ({listed})", HIGH, action)


def label_rule(
    table: str, column: str, bad_labels: Sequence[str], issue: str, action: str
) -> Rule:
    """Rule on known misspellings; it is reported even without a finding."""
    listed = ", ".join("'" + label.replace("'", "\\'") + "'" for label in bad_labels)
    return Rule(table, column, issue, f"`{column}` IN ({listed})", MEDIUM, action, always=True)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count of each table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table"),
                "row_count",
                F.lit(len(df.columns)).alias("column_count"),
            )
            for name, df in tables.items()
        ]
    )


def missing_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(df.columns)]


def profile(tables: Mapping[str, DataFrame], approx_rsd: float | None = None) -> DataFrame:
    """One row per column: type, rows, missing count and percent, distinct values.

    Every value is counted under its column, so all columns of all tables share one shuffle of distinct
    values, combined per task. With ``approx_rsd`` fixed-size sketches count the distinct values, in one
    pass per table and without a shuffle of the values themselves.
    """
    fields = [(t, i, f) for t, df in enumerate(tables.values()) for i, f in enumerate(df.schema.fields)]
    names = list(tables)
    listed = [(t, i, names[t], f.name, f.dataType.simpleString()) for t, i, f in fields]
    spark = next(iter(tables.values())).sparkSession
    columns = spark.createDataFrame(listed, "_t INT, _i INT, table STRING, column STRING, data_type STRING")
    if approx_rsd is None:
        values = reduce(DataFrame.unionAll, [_column_values(t, df) for t, df in enumerate(tables.values())])
        kinds = ["_long", "_double", "_text"]
        groups = values.groupBy("_t", "_i", *kinds).agg(F.count(F.lit(1)).alias("_n"))
        missing = F.coalesce(*[F.col(k).cast("string") for k in kinds]).isNull()
        counted = groups.groupBy("_t", "_i").agg(
            F.sum("_n").alias("row_count"),
            F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("missing_count"),
            F.count_if(~missing).alias("unique_count"),
        )
    else:
        counted = union_all([_sketched(t, df, approx_rsd) for t, df in enumerate(tables.values())])
    # as many rows on both sides as there are columns
    rows = columns.join(counted, ["_t", "_i"], "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("row_count", "missing_count")]
    percent = F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("row_count")), 2).alias("missing_pct")
    return rows.select("table", "column", "data_type", *zero, percent, F.coalesce("unique_count", F.lit(0)).alias("unique_count"))


def _column_values(table: int, df: DataFrame) -> DataFrame:
    """(_t, _i, _long, _double, _text): a row for each value, in the column of its kind."""
    whole, real = ("byte", "short", "integer", "long", "boolean"), ("float", "double")
    rows = []
    for i, field in enumerate(df.schema.fields):
        value, name = F.col(f"`{field.name}`"), field.dataType.typeName()
        kinds = {"long": name in whole, "double": name in real, "string": name not in (*whole, *real)}
        cells = [value.cast(kind) if mine else F.lit(None).cast(kind) for kind, mine in kinds.items()]
        rows.append(F.struct(F.lit(table), F.lit(i), *cells))
    return df.select(F.inline(F.array(*rows))).toDF("_t", "_i", "_long", "_double", "_text")


def _sketched(table: int, df: DataFrame, rsd: float) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in df.columns]
    distinct = [F.approx_count_distinct(c, rsd).alias(f"unique_{i}") for i, c in enumerate(columns)]
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), *missing_counts(df), *distinct)
    rows = [
        F.struct(
            F.lit(table).alias("_t"),
            F.lit(i).alias("_i"),
            F.col("row_count"),
            F.col(f"missing_{i}").alias("missing_count"),
            F.col(f"unique_{i}").alias("unique_count"),
        )
        for i in range(len(columns))
    ]
    return counted.select(F.inline(F.array(*rows)))


def missing_issues(profiled: DataFrame, high: float = 0.05) -> DataFrame:
    """Issue rows for columns with missing values; High above the given fraction."""
    share = F.col("missing_count") / F.col("row_count")
    return profiled.filter(F.col("missing_count") > 0).select(
        "table",
        "column",
        F.lit(MISSING[0]).alias("issue_type"),
        F.col("missing_count").alias("affected_rows"),
        flag_label(share > high, HIGH, MEDIUM).alias("severity"),
        F.lit(MISSING[1]).alias("recommended_action"),
    )


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows in duplicate groups, every member counted; missing keys are one group."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("affected_rows"))


def duplicate_keys(tables: Mapping[str, DataFrame], pks: Mapping[str, str]) -> DataFrame:
    return union_all(
        [
            _issue(duplicate_count(tables[t], key), t, key, DUPLICATE[0], HIGH, DUPLICATE[1])
            for t, key in pks.items()
        ]
    ).filter(F.col("affected_rows") > 0)


def _issue(counted: DataFrame, table, column, issue_type, severity, action) -> DataFrame:
    return counted.select(
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(issue_type).alias("issue_type"),
        "affected_rows",
        F.lit(severity).alias("severity"),
        F.lit(action).alias("recommended_action"),
    )


def _checks(
    df: DataFrame, table: str, rules: Sequence[Rule], missing: bool, high: float
) -> DataFrame:
    """Issue rows of one table from one scan: its row rules and, if wanted, missing values."""
    mine = [rule for rule in rules if rule.table == table]
    counts = [F.count_if(F.expr(rule.broken)).alias(f"rule_{i}") for i, rule in enumerate(mine)]
    columns = df.columns if missing else []
    if missing:
        counts += [F.count(F.lit(1)).alias("row_count"), *missing_counts(df)]

    def issue(group: int, column: str, n: Column, kind: str, severity: Column, action: str, always):
        return F.struct(
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.lit(kind).alias("issue_type"),
            n.alias("affected_rows"),
            severity.alias("severity"),
            F.lit(action).alias("recommended_action"),
            F.lit(group).alias("rule_group"),
            F.lit(always).alias("_always"),
        )

    rows = []
    for i, column in enumerate(columns):
        n = F.col(f"missing_{i}")
        severity = flag_label(F.try_divide(n, F.col("row_count")) > high, HIGH, MEDIUM)
        rows.append(issue(MISSING_GROUP, column, n, MISSING[0], severity, MISSING[1], False))
    for i, rule in enumerate(mine):
        rows.append(
            issue(
                RULE_GROUP,
                rule.column,
                F.col(f"rule_{i}"),
                rule.issue_type,
                F.lit(rule.severity),
                rule.action,
                rule.always,
            )
        )
    found = df.agg(*counts).select(F.inline(F.array(*rows)))
    return found.filter((F.col("affected_rows") > 0) | F.col("_always")).drop("_always")


def rule_issues(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Issue rows of all row rules, one scan per table."""
    names = dict.fromkeys(rule.table for rule in rules)
    return union_all(
        [_checks(tables[name], name, rules, missing=False, high=0.0) for name in names]
    ).drop("rule_group")


def relationship_counts(
    tables: Mapping[str, DataFrame], relationships: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """Rows with a key and rows whose key has a parent, per relationship.

    Child rows and parent keys meet in one aggregation per key instead of a join, so a key
    shared by very many rows travels as one row per task, and each table is shuffled once.
    """
    frames = []
    for child, fk, parent, pk in relationships:
        children = tables[child].select(
            F.col(fk).alias("_key"), F.lit(1).alias("_child"), F.lit(0).alias("_parent")
        )
        parents = tables[parent].select(
            F.col(pk).alias("_key"), F.lit(0).alias("_child"), F.lit(1).alias("_parent")
        )
        per_key = (
            children.unionByName(parents)
            .filter(F.col("_key").isNotNull())
            .groupBy("_key")
            .agg(F.sum("_child").alias("_n"), F.max("_parent").alias("_found"))
        )
        counted = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("keyed_rows"),
            F.coalesce(F.sum(F.when(F.col("_found") == 1, F.col("_n"))), F.lit(0)).alias(
                "valid_rows"
            ),
        )
        frames.append(
            counted.select(
                F.lit(child).alias("child_table"),
                F.lit(fk).alias("child_column"),
                F.lit(parent).alias("parent_table"),
                F.lit(pk).alias("parent_column"),
                "keyed_rows",
                "valid_rows",
            )
        )
    return union_all(frames)


RELATION_COLUMNS = ("child_table", "child_column", "parent_table", "parent_column")


def relationship_report(
    tables: Mapping[str, DataFrame], relationships: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """Percent of keyed child rows with a parent; 100 where there are none."""
    pct = F.try_divide(F.col("valid_rows") * 100.0, F.col("keyed_rows"))
    return relationship_counts(tables, relationships).select(
        *RELATION_COLUMNS,
        F.round(F.coalesce(pct, F.lit(100.0)), 2).alias("valid_relationship_pct"),
    )


def orphan_report(
    tables: Mapping[str, DataFrame], relationships: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    return relationship_counts(tables, relationships).select(
        *RELATION_COLUMNS, (F.col("keyed_rows") - F.col("valid_rows")).alias("orphan_rows")
    )


def fk_issues(
    tables: Mapping[str, DataFrame], relationships: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    return (
        orphan_report(tables, relationships)
        .filter(F.col("orphan_rows") > 0)
        .select(
            F.col("child_table").alias("table"),
            F.col("child_column").alias("column"),
            F.lit(ORPHAN[0]).alias("issue_type"),
            F.col("orphan_rows").alias("affected_rows"),
            F.lit(HIGH).alias("severity"),
            F.lit(ORPHAN[1]).alias("recommended_action"),
        )
    )


def quality_report(
    tables: Mapping[str, DataFrame],
    rules: Sequence[Rule],
    pks: Mapping[str, str],
    relationships: Sequence[tuple[str, str, str, str]],
    high: float = 0.05,
) -> DataFrame:
    """All issues in one table, with the ordinal of the rule group they come from.

    Missing values and row rules of a table share one scan.
    """
    keys = duplicate_keys(tables, pks).withColumn("rule_group", F.lit(DUPLICATE_GROUP))
    parents = fk_issues(tables, relationships).withColumn("rule_group", F.lit(FK_GROUP))
    rows = [_checks(df, name, rules, missing=True, high=high) for name, df in tables.items()]
    return union_all([*rows, keys, parents])


def failed_relationships(report: DataFrame, min_pct: float = 100.0) -> DataFrame:
    return report.filter(F.col("valid_relationship_pct") < min_pct)


def assert_integrity(report: DataFrame, min_pct: float = 100.0) -> None:
    """Raise if a relationship is below the wanted percentage (one row per relationship)."""
    failed = failed_relationships(report, min_pct).collect()
    if failed:
        names = ", ".join(f"{r.child_table}.{r.child_column}" for r in failed)
        raise ValueError(f"orphan rows remain: {names}")


def cleaning_summary(
    raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame]
) -> DataFrame:
    """Rows before and after cleaning, per table."""
    frames = []
    for name in clean:
        marked = [
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
            for side, df in (("before", raw[name]), ("after", clean[name]))
        ]
        frames.append(
            union_all(marked).select(F.lit(name).alias("table"), "side", "n")
        )
    sides = union_all(frames)
    return sides.groupBy("table").agg(
        F.sum(F.when(F.col("side") == "before", F.col("n"))).alias("rows_before"),
        F.sum(F.when(F.col("side") == "after", F.col("n"))).alias("rows_after"),
    )
