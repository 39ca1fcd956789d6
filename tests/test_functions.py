import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from bayline.functions import flags, hashing, scalars, special
from bayline.operators.features import delay_category, delayed
from bayline.operators.marts import business_flags
from bayline.operators.model import risk_band

T = dt.datetime


def test_delay_categories_at_their_bounds(column):
    hours = [None, -1.0, 0.0, 0.0001, 4.0, 4.1, 8.0, 8.1]
    got = column([(h,) for h in hours], "h double", delay_category(F.col("h")))
    minor, moderate = "Minor Delay", "Moderate Delay"
    assert got == [
        "Unknown", "On Time", "On Time", minor, minor, moderate, moderate, "Severe Delay"
    ]
    got = column([(h,) for h in hours], "h double", delayed(F.col("h")))
    assert got == [False, False, False, True, True, True, True, True]


def test_severe_flag_of_the_mart_starts_at_four_hours(spark):
    rows = spark.createDataFrame(
        [(1, 3.99, 1), (2, 4.0, 0), (3, None, None)], "k int, delay_hours double, first_time_fix_flag int"
    )
    got = [tuple(r)[3:] for r in business_flags(rows).orderBy("k").collect()]
    assert got == [(1, 0, 1), (1, 1, 0), (0, 0, 0)]


def test_risk_band_edges(column):
    p = [0.0, 0.30, 0.3000001, 0.60, 0.61, 1.0, None, 1.5]
    got = column([(x,) for x in p], "p double", risk_band(F.col("p")))
    low, medium, high = "Low Risk", "Medium Risk", "High Risk"
    assert got == [low, low, medium, medium, high, high, None, None]


def test_flags_and_missing_values(column):
    csat = [(None,), (2.0,), (3.0,)]
    assert column(csat, "x double", flags.nullable_flag(F.col("x"), 2, "<=")) == [None, 1, 0]
    assert column(csat, "x double", flags.threshold_flag(F.col("x"), 2, "<=")) == [0, 1, 0]
    assert column(csat, "x double", flags.in_domain(F.col("x"), [2])) == [False, True, False]
    assert column(csat, "x double", flags.out_of_domain(F.col("x"), [2])) == [False, False, True]


def test_mappings_keep_or_drop_unlisted_values(column):
    rows = [("a",), ("b",), (None,)]
    assert column(rows, "x string", flags.remap(F.col("x"), {"a": "z"})) == ["z", "b", None]
    assert column(rows, "x string", flags.lookup_label(F.col("x"), {"a": "z"})) == ["z", None, None]


def test_days_are_floored_and_not_calendar_days(column):
    rows = [
        (T(2024, 1, 1, 23), T(2024, 1, 2, 1)),
        (T(2024, 1, 1, 12), T(2024, 1, 1, 0)),
        (T(2024, 1, 1), T(2024, 1, 4)),
        (None, T(2024, 1, 4)),
    ]
    got = column(rows, "a timestamp_ntz, b timestamp_ntz", scalars.days_between(F.col("a"), F.col("b")))
    assert got == [0, -1, 3, None]
    got = column(rows, "a timestamp_ntz, b timestamp_ntz", scalars.hours_between(F.col("a"), F.col("b")))
    assert got == [2.0, -12.0, 72.0, None]


def test_add_time_and_parse(column):
    rows = [(T(2024, 2, 28, 12),)]
    got = column(rows, "a timestamp_ntz", scalars.add_time(F.col("a"), days=2, hours=0.5))
    assert got == [T(2024, 3, 1, 12, 30)]
    assert column(rows, "a timestamp_ntz", scalars.sub_days(F.col("a"), 28)) == [T(2024, 1, 31, 12)]
    texts = [("2024-01-05 10:00:00",), ("yesterday",), (None,)]
    assert column(texts, "a string", scalars.parse_ts(F.col("a"))) == [T(2024, 1, 5, 10), None, None]
    assert column([("05/01/2024",)], "a string", scalars.parse_ts(F.col("a"), "dd/MM/yyyy")) == [
        T(2024, 1, 5)
    ]


def test_numbers_that_cannot_be_used(column):
    rows = [(1.0, 2.0), (1.0, 0.0), (None, 1.0)]
    assert column(rows, "a double, b double", scalars.ratio(F.col("a"), F.col("b"))) == [
        0.5, None, None
    ]
    odd = [(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    assert column(odd, "a double", scalars.finite_or_null(F.col("a"))) == [
        1.0, None, None, None, None
    ]
    assert column([(0.0,), (9.0,), (None,)], "a double", scalars.clip(F.col("a"), 1.0, 5.0)) == [
        1.0, 5.0, None
    ]
    assert column([("123.0",), ("x",), (None,)], "a string", scalars.key_long(F.col("a"))) == [
        123, None, None
    ]


def test_iso_week_crosses_the_year(column):
    assert column([(T(2021, 1, 3),)], "a timestamp_ntz", scalars.iso_week(F.col("a"))) == [53]


def test_erfc_against_the_standard_library(spark):
    xs = [i / 8 for i in range(0, 121)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, got in df.select("x", special.erfc(F.col("x"))).collect():
        assert got == pytest.approx(math.erfc(x), rel=1e-11)


def test_chi_square_tail(spark):
    # exact tails: exp(-x/2) for 2 degrees, erfc for 1, recurrence for 3
    rows = [(3.0, 1), (3.0, 2), (3.0, 3), (20.0, 4), (0.0, 5), (None, 2)]
    df = spark.createDataFrame(rows, "x double, d int")
    got = [r[0] for r in df.select(special.chi_square_sf(F.col("x"), F.col("d"))).collect()]
    one = math.erfc(math.sqrt(1.5))
    three = one + math.exp(-1.5) * math.sqrt(1.5) * 2 / math.sqrt(math.pi)
    assert got[:5] == pytest.approx([one, math.exp(-1.5), three, math.exp(-10) * 11, 1.0], rel=1e-11)
    assert got[5] is None


def test_hash_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("u", hashing.hash_uniform(F.col("id"), "s"))
    again = spark.range(1000).repartition(7).withColumn("u", hashing.hash_uniform(F.col("id"), "s"))
    assert {tuple(r) for r in df.collect()} == {tuple(r) for r in again.collect()}
    low, high, mean = df.select(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < high < 1 and mean == pytest.approx(0.5, abs=0.05)


def test_poisson_inversion(column):
    u = [(0.0,), (0.36,), (0.37,), (0.74,), (0.9999999,)]
    assert column(u, "u double", hashing.poisson1(F.col("u"))) == [0, 0, 1, 2, 10]
