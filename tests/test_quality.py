import datetime as dt

import pytest

from bayline.operators import quality
from bayline.operators.quality import domain_rule, label_rule, order_rule, range_rule

T = dt.datetime


def issues(df):
    return {(r.table, r.column, r.issue_type): (r.affected_rows, r.severity) for r in df.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "parents": spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int"),
        "children": spark.createDataFrame(
            [(1, None, 1.0, "ok", T(2024, 1, 1), T(2024, 1, 2))]
            + [(2, 1, -1.0, "BAD", T(2024, 1, 3), T(2024, 1, 2))]
            + [(3, 9, 30.0, "ok", None, T(2024, 1, 2))]
            + [(i, 2, 2.0, "ok", T(2024, 1, 1), T(2024, 1, 2)) for i in range(4, 41)],
            "id int, fk int, hours double, label string, a timestamp_ntz, b timestamp_ntz",
        ),
    }


def test_every_member_of_a_duplicate_group_counts_and_nulls_are_one_group(tables):
    got = issues(quality.duplicate_keys(tables, {"parents": "k", "children": "id"}))
    assert got == {("parents", "k", "Duplicate Primary Key"): (4, "High")}


def test_missing_values_and_their_severity(tables):
    got = issues(quality.missing_issues(quality.profile(tables)))
    # 2 of 5 is High; 1 of 40 is Medium
    assert got == {
        ("parents", "k", "Missing Values"): (2, "High"),
        ("children", "fk", "Missing Values"): (1, "Medium"),
        ("children", "a", "Missing Values"): (1, "Medium"),
    }


def test_profile(tables):
    rows = {(r.table, r.column): r for r in quality.profile(tables).collect()}
    k = rows["parents", "k"]
    assert (k.data_type, k.row_count, k.missing_count, k.missing_pct, k.unique_count) == (
        "int", 5, 2, 40.0, 2
    )
    sketch = {(r.table, r.column): r for r in quality.profile(tables, approx_rsd=0.05).collect()}
    assert sketch["children", "id"].unique_count == pytest.approx(40, abs=4)


RULES = [
    order_rule("children", "b", "a", "<", "Before", "Fix"),
    range_rule("children", "hours", "<", 0, "Negative", "Fix"),
    range_rule("children", "hours", ">", 24, "Extreme", "Fix", quality.MEDIUM),
    range_rule("children", "hours", ">", 99, "Never", "Fix"),
    domain_rule("children", "fk", [1, 2], "Domain", "Fix"),
    label_rule("children", "label", ["BAD"], "Label", "Fix"),
    label_rule("children", "label", ["WORSE"], "No label", "Fix"),
]


def test_rules_without_findings_stay_silent_except_labels(tables):
    got = issues(quality.rule_issues(tables, RULES))
    assert got == {
        ("children", "b", "Before"): (1, "High"),
        ("children", "hours", "Negative"): (1, "High"),
        ("children", "hours", "Extreme"): (1, "Medium"),
        ("children", "fk", "Domain"): (1, "High"),
        ("children", "label", "Label"): (1, "Medium"),
        ("children", "label", "No label"): (0, "Medium"),
    }


RELATIONS = [("children", "fk", "parents", "k")]


def test_relationships_ignore_missing_keys(tables):
    assert quality.orphan_report(tables, RELATIONS).first().orphan_rows == 1
    report = quality.relationship_report(tables, RELATIONS)
    assert report.first().valid_relationship_pct == 97.44
    with pytest.raises(ValueError, match="children.fk"):
        quality.assert_integrity(report)
    quality.assert_integrity(report, min_pct=97.0)


def test_relationship_without_rows_is_valid(spark, tables):
    empty = {**tables, "children": tables["children"].filter("id < 0")}
    assert quality.relationship_report(empty, RELATIONS).first().valid_relationship_pct == 100.0


def test_report_joins_all_groups(tables):
    report = quality.quality_report(tables, RULES, {"parents": "k"}, RELATIONS)
    groups = {}
    for row in report.collect():
        groups[row.rule_group] = groups.get(row.rule_group, 0) + 1
    assert groups == {1: 3, 2: 1, 3: 1, 4: 6}


def test_cleaning_summary(tables):
    clean = {"parents": tables["parents"].dropna()}
    assert [tuple(r) for r in quality.cleaning_summary(tables, clean).collect()] == [
        ("parents", 5, 3)
    ]
