import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bayline.operators import cleaning, joins
from bayline.sources.schemas import RELATIONSHIPS

T = dt.datetime
FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@pytest.fixture(scope="module")
def raw(spark):
    """Small tables: customer 1 is valid, 9 has no row, one customer has no key."""
    day = T(2024, 1, 1)

    def visit(k, appointment, hours, promised):
        done = None if hours is None else day + dt.timedelta(hours=hours)
        return (k, appointment, day, done, day + dt.timedelta(hours=promised))

    return {
        "customers": spark.createDataFrame(
            [(1, 5, "b"), (1, 3, "a"), (2, 1, "c"), (None, 0, "d")],
            "customer_id long, since int, region string",
        ),
        "vehicles": spark.createDataFrame(
            [(10, 1), (11, 9), (None, 1), (12, 2), (13, None)], "vehicle_id long, customer_id long"
        ),
        "dealers": spark.createDataFrame([(7,)], "dealer_id long"),
        "appointments": spark.createDataFrame(
            [
                (100, 1, 10, 7, day, day, 1.0),
                (101, 9, 10, 7, day, day, 1.0),  # unknown customer
                (102, 1, 11, 7, day, day, 1.0),  # vehicle of an unknown customer
                (103, 1, 10, 9999, day, day, 1.0),  # unknown dealer
                (104, 1, 10, 7, day, T(2023, 12, 27), 1.0),  # before booking
                (105, 1, 10, 7, day, day, 0.0),  # no duration
                (106, 2, 12, 7, None, day, 1.0),  # no booking date
            ],
            "appointment_id long, customer_id long, vehicle_id long, dealer_id long, "
            "booking_date timestamp_ntz, appointment_date timestamp_ntz, "
            "scheduled_duration_hours double",
        ),
        "service_visits": spark.createDataFrame(
            [visit(1, 100, 2, 1.5), visit(2, 101, 2, 1), visit(3, 100, -1, 1), visit(4, 100, None, 1)],
            "visit_id long, appointment_id long, service_start_time timestamp_ntz, "
            "completion_time timestamp_ntz, promised_completion timestamp_ntz",
        ),
        "repairs": spark.createDataFrame(
            [
                (1, 1, "GEN_REPAIR", -2.0),
                (2, 1, "Brakes", 100.0),
                (3, 1, "general repair", 24.0),
                (4, 2, "Brakes", 1.0),
            ],
            "repair_id long, visit_id long, repair_category string, actual_hours double",
        ),
        "parts": spark.createDataFrame(
            [
                (1, 1, day, T(2024, 1, 4)),
                (2, 1, day, T(2024, 1, 3, 23)),
                (3, 2, day, T(2023, 12, 31)),
                (4, 3, day, None),
                (5, 4, day, day),
            ],
            "part_transaction_id long, repair_id long, part_order_date timestamp_ntz, "
            "part_received_date timestamp_ntz",
        ),
        "customer_surveys": spark.createDataFrame(
            [(1, 1, 2.0), (2, 1, 7.0), (3, 1, None), (4, 2, 5.0), (5, 1, 3.0)],
            "survey_id long, visit_id long, csat_score double",
        ),
    }


def keys(df, key):
    return sorted(r[0] for r in df.select(key).collect())


def test_every_table_is_cleaned_against_its_cleaned_parent(raw):
    clean = cleaning.clean_all(raw, ["since"])
    assert {tuple(r) for r in clean["customers"].collect()} == {(1, 3, "a"), (2, 1, "c")}
    assert keys(clean["vehicles"], "vehicle_id") == [10, 12]
    assert keys(clean["appointments"], "appointment_id") == [100]
    visits = clean["service_visits"].select(
        "visit_id", "actual_duration_hours", "delay_hours", "delay_flag"
    )
    assert [tuple(r) for r in visits.collect()] == [(1, 2.0, 0.5, 1)]
    repairs = clean["repairs"].orderBy("repair_id").select("repair_category", "actual_hours")
    assert [tuple(r) for r in repairs.collect()] == [
        ("General Repair", None), ("Brakes", None), ("General Repair", 24.0)
    ]
    parts = clean["parts"].orderBy("part_transaction_id")
    assert [(r.part_received_date is None, r.parts_delay_flag) for r in parts.collect()] == [
        (False, 1), (False, 0), (True, None), (True, None)
    ]
    surveys = clean["customer_surveys"].orderBy("survey_id").select("csat_score", "complaint_flag")
    assert [tuple(r) for r in surveys.collect()] == [(2.0, 1), (None, None), (None, None), (3.0, 0)]


def test_cascade_is_complete_after_one_pass(raw):
    clean = cleaning.clean_all(raw, ["since"])
    again = cleaning.cascade(clean, RELATIONSHIPS)
    for name, df in clean.items():
        assert again[name].count() == df.count()


def test_an_orphan_takes_its_descendants_along(raw):
    kept = cleaning.cascade(raw, RELATIONSHIPS)
    assert keys(kept["service_visits"], "visit_id") == [1, 3, 4]
    assert keys(kept["repairs"], "repair_id") == [1, 2, 3]
    assert keys(kept["parts"], "part_transaction_id") == [1, 2, 3, 4]
    assert keys(kept["customer_surveys"], "survey_id") == [1, 2, 3, 5]


def test_keep_first_takes_the_smallest(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (2, 3, "z")], "k int, o int, v string")
    got = {tuple(r) for r in cleaning.keep_first(df, "k", ["o"]).collect()}
    assert got == {(1, 3, "y"), (2, 3, "z")}


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=30), st.sets(st.integers(0, 6)))
def test_valid_rows_and_orphans_partition_the_children(spark, fks, parents):
    child = spark.createDataFrame([(i, k) for i, k in enumerate(fks)], "i int, fk int")
    parent = spark.createDataFrame([(p,) for p in parents], "pk int")
    valid = keys(joins.keep_valid(child, "fk", parent, "pk"), "i")
    lost = keys(joins.orphans(child, "fk", parent, "pk"), "i")
    assert sorted(valid + lost) == [i for i, k in enumerate(fks) if k is not None]
    assert valid == [i for i, k in enumerate(fks) if k in parents]


def test_missing_keys_of_parents_match_nothing(spark):
    child = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "i int, fk int")
    parent = spark.createDataFrame([(1,), (None,)], "pk int")
    assert keys(joins.keep_valid(child, "fk", parent, "pk"), "i") == [2]
    assert keys(joins.orphans(child, "fk", parent, "pk"), "i") == [3]


def test_expand_children_keeps_childless_parents(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    child = spark.createDataFrame([(1, 10), (1, 11), (3, 12)], "k int, c int")
    got = sorted(tuple(r) for r in joins.expand_children(parent, child, "k").fillna(-1).collect())
    assert got == [(1, "a", 10), (1, "a", 11), (2, "b", -1)]


def test_alias_join_leaves_no_ambiguous_name(spark):
    left = spark.createDataFrame([(1, "n")], "k int, region string")
    right = spark.createDataFrame([(1, "s", 4)], "k int, region string, size int")
    joined = joins.alias_join(left, right, "k", "dealer_")
    assert joined.columns == ["k", "region", "dealer_region", "size"]
    assert joined.select(F.col("dealer_region")).first()[0] == "s"


def test_parts_are_completed_after_the_filter(spark):
    """What makes whole parts of narrow rows is given the rows of valid repairs only."""
    lines = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 10)], "line int, repair_id int")
    repairs = spark.createDataFrame([(10,), (10,), (30,)], "repair_id int")
    seen = []

    def complete(kept):
        seen.extend(sorted(r.line for r in kept.collect()))
        at = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
        return kept.select(
            F.when(F.col("line") == 1, "a").alias("part_transaction_id"),
            "repair_id",
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("part_order_date"),
            at.alias("part_received_date"),
        )

    found = cleaning.clean_parts(lines, repairs, complete).collect()
    assert seen == [1, 4]
    assert [(r.part_transaction_id, r.parts_delay_flag) for r in found] == [("a", 1)]
