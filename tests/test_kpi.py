import pytest

from bayline.operators import features, kpi, ordering, sampling

VISITS = "visit_id int, dealer_id int, delay_hours double, delayed boolean, csat_score double, complaint_flag int"


@pytest.fixture(scope="module")
def visits(spark):
    rows = [
        (1, 1, 2.0, True, 2.0, 1),
        (2, 1, -1.0, False, 5.0, 0),
        (3, 1, 6.0, True, None, None),
        (4, 2, None, False, 4.0, 0),
        (5, None, 1.0, True, 1.0, 1),
    ]
    return spark.createDataFrame(rows, VISITS)


def test_overall_summary(visits):
    got = {r.metric: r.value for r in kpi.kpi_overall(visits).collect()}
    assert got["Total Visits"] == 5 and got["Delayed Visits"] == 3 and got["Delay Rate"] == 0.6
    assert got["Average Delay Hours"] == 2.0 and got["Median Delay Hours"] == 1.5
    assert got["Average CSAT"] == 3.0 and got["Complaint Rate"] == 0.5


def test_scorecard_leaves_out_rows_without_a_key(visits):
    rows = {r.dealer_id: r for r in kpi.kpi_scorecard(visits, "dealer_id").collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].visits, rows[1].delay_rate, rows[1].avg_csat) == (3, pytest.approx(2 / 3), 3.5)
    assert rows[2].avg_delay_hours is None and rows[2].complaint_rate == 0.0


def test_distribution_has_all_categories_and_counts_the_unlisted_in_the_total(spark):
    df = spark.createDataFrame([("On Time",), ("On Time",), ("Unknown",), ("Minor Delay",)], "c string")
    got = {r.c: (r.visits, r.percentage) for r in kpi.distribution(df, "c", features.DELAY_CATEGORIES).collect()}
    assert got == {
        "On Time": (2, 50.0), "Minor Delay": (1, 25.0), "Moderate Delay": (0, 0.0),
        "Severe Delay": (0, 0.0),
    }


def test_contingency_fills_the_grid(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", None)], "x string, y int")
    assert sorted(tuple(r) for r in kpi.contingency(df, "x", "y").collect()) == [
        ("a", 1, 2), ("a", 2, 0), ("b", 1, 0), ("b", 2, 1)
    ]
    wide = kpi.contingency_wide(df, "x", "y", [1, 2, 3]).orderBy("x").collect()
    assert [tuple(r) for r in wide] == [("a", 2, 0, 0), ("b", 0, 1, 0)]


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    got = {r.x: r.share for r in kpi.frequency(df, "x", normalize=True).collect()}
    assert got == {"a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}


def test_customer_rollup_v1(spark):
    rows = [
        (1, 10, 2.0, 2.0, 1, 1.0),
        (2, 10, None, None, None, 3.0),
        (3, 20, -1.0, None, None, 2.0),
        (4, None, 1.0, 1.0, 1, 1.0),
    ]
    df = spark.createDataFrame(
        rows,
        "visit_id int, customer_id int, delay_hours double, csat_score double, "
        "complaint_flag int, actual_duration_hours double",
    )
    rolled = {r.customer_id: r for r in features.customer_rollup_v1(df).collect()}
    assert set(rolled) == {10, 20}
    # a missing delay counts as not delayed; missing complaints add up to zero
    assert (rolled[10].delay_rate, rolled[10].avg_delay_hours) == (0.5, 2.0)
    assert (rolled[20].total_complaints, rolled[20].complaint_rate) == (0, None)
    imputed = {
        r.customer_id: r
        for r in features.impute_customers(features.customer_rollup_v1(df), features.IMPUTE_V1).collect()
    }
    assert (imputed[20].avg_csat, imputed[20].complaint_rate) == (2.0, 0.0)


def test_parts_delay(spark):
    repairs = spark.createDataFrame([(1, 100), (2, 100), (3, 200)], "repair_id int, visit_id int")
    parts = spark.sql(
        """SELECT * FROM VALUES
           (1, TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-04 00:00:00', 1),
           (1, TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-02 00:00:00', 0),
           (2, TIMESTAMP_NTZ '2024-01-01 00:00:00', CAST(NULL AS TIMESTAMP_NTZ), NULL)
           AS t(repair_id, part_order_date, part_received_date, parts_delay_flag)"""
    )
    got = {tuple(r) for r in features.parts_delay(repairs, parts).collect()}
    assert got == {(100, 3, True), (200, None, False)}
    got = {tuple(r) for r in features.parts_delay(repairs, parts, from_flag=True).collect()}
    assert got == {(100, 3, True), (200, 0, False)}


def test_kpi_cube_tells_subtotals_from_missing_dimensions(spark):
    rows = [(1, 1, "n", 1, 0, 1, 2.0, 5.0, 0), (2, 1, "n", 0, 0, 1, 0.0, None, None), (3, 2, None, 1, 1, 0, 5.0, 1.0, 1)]
    df = spark.createDataFrame(
        rows,
        "visit_id int, customer_id int, region string, delayed_visit int, severe_delay int, "
        "first_time_fix int, delay_hours double, csat_score double, complaint_flag int",
    )
    got = {(r.region, r.grouping_level): r for r in kpi.kpi_cube(df, ["region"]).collect()}
    assert set(got) == {("n", 0), (None, 0), (None, 1)}
    total = got[None, 1]
    assert (total.total_visits, total.unique_customers, total.severe_delays) == (3, 2, 1)
    assert (total.visits_per_customer, total.avg_csat) == (1.5, 3.0)
    plain = kpi.kpi_cube(df, ["region"], "group")
    assert plain.count() == 2 and "grouping_level" not in plain.columns


def test_ordered_lists_break_ties_by_key(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, -5.0), (4, None)], "k int, x double")
    assert [r.k for r in ordering.priority_list(df, [("x", "desc")], "k").collect()] == [1, 3, 2, 4]
    assert ordering.argmax(df, "x", "k").first().k == 1
    from pyspark.sql import functions as F

    assert ordering.top1(df, [("x", "desc")], "k", F.col("k") == 1).first().k == 3
    assert [r.k for r in ordering.by_magnitude(df, "x", "k").collect()][:3] == [2, 1, 3]


def test_samples_are_replayable(spark):
    df = spark.range(500)
    one = {r.id for r in sampling.sample_n(df, "id", 50, "s").collect()}
    two = {r.id for r in sampling.sample_n(df.repartition(7), "id", 50, "s").collect()}
    other = {r.id for r in sampling.sample_n(df, "id", 50, "t").collect()}
    assert one == two and len(one) == 50 and one != other
    weights = sampling.bootstrap_weights(df, "id", 10, "s").groupBy("replicate").sum("weight").collect()
    assert len(weights) == 10 and all(abs(r[1] - 500) < 120 for r in weights)
