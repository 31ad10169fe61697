"""NaN, infinities and NULL in every operator that promises to handle what is missing."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pricewright import fixed_values as fv
from pricewright.functions import numbers, pricing
from pricewright.ml.scoring import SCENARIO, scenario_features
from pricewright.operators import cleaning, joins, statistics

NAN, INF = float("nan"), float("inf")


def values(spark, column, given):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v double")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("rounding", [numbers.round_half_up, numbers.round_nearest])
def test_rounding(spark, rounding):
    given = [NAN, None, INF, -INF, 1e300, -1e17, 2.344, 0.0]
    assert values(spark, rounding("v", 2), given) == [None, None, INF, -INF, 1e300, -1e17, 2.34, 0.0]


def test_whole_numbers(spark):
    given = [NAN, None, INF, 1e30, 2.9, -2.9]
    assert values(spark, numbers.truncate("v"), given) == [None, None, None, None, 2, -2]
    assert values(spark, numbers.cents("v"), [NAN, None, INF, 1.005]) == [None, None, None, 100]
    assert values(spark, numbers.convert_currency("v", 2.0), [NAN, None, 1.75]) == [None, None, 3]


def test_scores_need_a_measure(spark):
    score = numbers.capped_score([("v", 10, 40), (F.lit(1.0), 1, 30)])
    assert values(spark, score, [NAN, None, 5.0, 99.0, INF]) == [30.0, 30.0, 50.0, 70.0, 70.0]


def test_band_of_a_missing_price(spark):
    band = pricing.price_band("v", 100.0, floor=0.001)
    for name, column in band.items():
        got = values(spark, column, [NAN, None, -1.0])
        assert got[:2] == [None, None] and got[2] is not None, name


def test_optimal_price(spark):
    whole = pricing.optimal_price("v", F.lit(50), F.lit(NAN), F.lit(NAN), F.lit(1.0), F.lit(1.0))
    assert values(spark, whole, [0.1, NAN, None]) == [3.75, None, None]


def test_cleaning(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", NAN), ("a", None), ("a", 3.0), ("b", NAN), ("b", -1.0), (None, INF)], "k string, v double")
    assert rows(cleaning.keep_positive(df, ["v"])) == sorted([("a", 1.0), ("a", 3.0), (None, INF)], key=repr)
    assert rows(cleaning.null_profile(df)) == [("k", 1, 7), ("v", 3, 7)]
    filled = [r.v for r in cleaning.fill_null_median(df.filter("k = 'a'"), ["v"], "k").collect()]
    assert sorted(filled) == [1.0, 2.0, 2.0, 3.0]
    assert sorted(r.v for r in cleaning.fill_null_median(df.filter("k = 'a'"), ["v"]).collect()) == [1.0, 2.0, 2.0, 3.0]


def test_statistics(spark):
    points = [(1.0, 2.0, "a"), (2.0, 4.0, "a"), (3.0, 6.5, "b"), (NAN, 1.0, "b"), (5.0, None, "a"), (INF, 3.0, "a")]
    df = spark.createDataFrame(points, "x double, y double, k string")
    clean = spark.createDataFrame(points[:3], "x double, y double, k string")
    assert statistics.correlation_pairs(df, ["x", "y"]).first().r == pytest.approx(statistics.correlation_pairs(clean, ["x", "y"]).first().r)
    assert rows(statistics.group_mean(df.filter("k = 'b'"), "k", "x", "m")) == [("b", 3.0)]
    first = statistics.group_first(spark.createDataFrame([("a", NAN, 1), ("a", 4.0, 2)], "k string, v double, o int"), "k", "v", "o", "f")
    assert rows(first) == [("a", 4.0)]
    pivoted = statistics.pivot_mean(df.filter("y is null or x > 2"), "k", "k", ["a", "b"], "y").orderBy("k").collect()
    assert [tuple(r) for r in pivoted] == [("a", 3.0, None), ("b", None, 3.75)]


def test_scenarios_without_an_audience(spark):
    given = [(None, 50.0, None, 0.1, 25.0, None, None), ("x", 50.0, NAN, 0.1, 25.0, "SEA", "dolphin")]
    got = scenario_features(spark.createDataFrame(given, SCENARIO), {"x": 1}).collect()
    assert [r.community_health_score for r in got] == [20.0, 20.0]
    assert not any(math.isnan(r.dau_to_mau_ratio) for r in got)


def test_long_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "i int, k string")
    table = spark.createDataFrame([("a", 10), ("a", 9), (None, 5)] + [(f"k{i}", i) for i in range(200)], "k string, v int")
    assert rows(joins.lookup_join(df, "k", table, "v", "out", 0)) == [(1, "a", 9), (2, "zz", 0), (3, None, 0)]
    assert rows(joins.lookup_join(df, "k", table, "v", "i")) == sorted([("a", 9), ("zz", None), (None, None)], key=repr)
    assert fv.AGE_SENSITIVITY
