from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from pricewright.functions import bins, numbers, pricing


def evaluate(spark, values, column, ddl="v double"):
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], ddl)
    return [r[0] for r in df.select(column).collect()]


def test_rounding_is_half_up_on_both_sides_of_zero(spark):
    got = evaluate(spark, [0.125, 2.5, -0.125, 1.004999, None], numbers.round_half_up("v", 2))
    assert got == [0.13, 2.5, -0.12, 1.0, None]


def test_round_nearest_equals_python(spark):
    import random

    rng = random.Random(11)
    values = [2.675, 0.125, 0.375, -2.675, 1.005, 0.54375, 0.725 * 0.75, 1e9 + 0.125, 0.0]
    values += [rng.randint(-10**7, 10**7) / 10**rng.randint(1, 7) for _ in range(3000)]
    values += [(rng.randint(0, 10**6) + 0.5) / 10**d for d in (2, 3, 4) for _ in range(1000)]
    for digits in (1, 2, 3, 4, 6):
        assert evaluate(spark, values, numbers.round_nearest("v", digits)) == [round(v, digits) for v in values]


def test_conversion_drops_the_fraction(spark):
    assert evaluate(spark, [0.49, -0.49, 0.0], numbers.convert_currency("v", 16250)) == [7962, -7962, 0]


def test_cents(spark):
    assert evaluate(spark, [0.1, 19.99, 104949.5], numbers.cents("v")) == [10, 1999, 10494950]


def test_safe_ratio_guards_zero_negative_and_null(spark):
    data = [(1.0, 3.0), (1.0, 0.0), (1.0, -2.0), (None, 2.0), (1.0, None)]
    assert evaluate(spark, data, numbers.safe_ratio("a", "b", 3), "a double, b double") == [0.333, 0.0, 0.0, 0.0, 0.0]


def test_default_replaces_null_and_zero(spark):
    assert evaluate(spark, [5.0, 0.0, None], numbers.or_default("v", 1.5)) == [5.0, 1.5, 1.5]


def test_finite_or_null(spark):
    values = [1.0, float("nan"), float("inf"), float("-inf"), None]
    assert evaluate(spark, values, numbers.finite_or_null("v")) == [1.0, None, None, None, None]


def test_log_scale(spark):
    assert evaluate(spark, [0.0, 3000000.0], numbers.log_scale("v")) == [0.0, round(math.log1p(3000000), 4)]


def test_capped_score_stops_at_the_caps(spark):
    score = numbers.capped_score([("a", 130, 40), ("b", 0.35, 30), ("c", 1.5, 30)])
    data = [(110.0, 0.164, 1.0), (1000.0, 1.0, 9.0), (0.0, 0.0, 0.0)]
    assert evaluate(spark, data, score, "a double, b double, c double") == [67.9, 100.0, 0.0]


@pytest.mark.parametrize(
    ("label", "values", "expected"),
    [
        (bins.spend_tier, [1.99, 2.0, 9.99, 29.99, 59.99, 60.0], ["micro", "small", "small", "medium", "large", "mega"]),
        (bins.revenue_tier, [1e9, 4e8, 1e8, 1.0], ["blockbuster", "major", "mid", "small"]),
        (bins.competition_tier, [80.0, 60.0, 40.0, 39.9], ["Elite", "High", "Medium", "Low"]),
        (bins.age_sensitivity, [21.0, 22.0, 30.0], ["high", "medium", "low"]),
        (bins.price_strategy, [0.79, 0.8, 2.5, 8.0], ["penetration", "competitive", "controlled premium", "luxury premium"]),
        (bins.model_quality, [0.95, 0.8, 0.2], ["very good", "good", "needs work"]),
        (bins.spend_segment, [100.0, 10.0, 9.0], ["whale", "dolphin", "minnow"]),
    ],
)
def test_bins(spark, label, values, expected):
    assert evaluate(spark, values, label("v")) == expected


def test_lookup_default_and_size_limit(spark):
    assert evaluate(spark, ["a", "z", None], bins.lookup("v", {"a": 1}, 0), "v string") == [1, 0, 0]
    assert evaluate(spark, ["z"], bins.lookup("v", {"a": 1}), "v string") == [None]
    with pytest.raises(ValueError):
        bins.lookup("v", {i: i for i in range(100)})


def test_calendar(spark):
    data = [(1,), (5,), (13,)]
    assert evaluate(spark, data, bins.month_name("m"), "m int") == ["Jan", "Mei", None]
    assert evaluate(spark, data, bins.seasonal_multiplier("m"), "m int") == [1.35, 1.05, 1.0]


def test_tier_prices_of_the_smallest_tier(spark):
    df = spark.createDataFrame([(0.49, 5, 28.0)], "p double, n int, d double")
    got = df.select(*[c.alias(n) for n, c in pricing.tier_prices("p", "n", "d").items()]).first().asDict()
    assert got["price_official_idr"] == 7962
    assert got["price_3rdparty_usd"] == 0.353
    assert got["price_per_100_usd"] == 9.8
    assert got["value_score"] == 10.2


def test_optimal_price_factors(spark):
    price = pricing.optimal_price("arpdau", "comp", "age", "mau", "seg", "reg")
    data = [
        (0.126, 25.0, 35.0, 15.2, 2.8, 1.2),  # older players, small audience
        (0.018, 85.0, 22.0, 110.0, 1.4, 0.7),  # base at its floor times 0.9, large audience
        (0.0, 0.0, None, 50.0, 1.0, 1.0),  # unknown age is neutral, base floor applies
    ]
    got = evaluate(spark, data, price, "arpdau double, comp double, age double, mau double, seg double, reg double")
    assert got == pytest.approx([25.9308, 0.4463, 0.5], abs=1e-4)


def test_price_band_with_floor(spark):
    df = spark.createDataFrame([(2.0,), (-1.0,)], "v double")
    band = df.select(*[c.alias(n) for n, c in pricing.price_band("v", floor=0.001).items()]).collect()
    assert tuple(band[0]) == (2.0, 32500, 1.64, 2.44, 26650, 39650)
    assert band[1]["predicted_price_per_100_idr"] == 16


def test_bubble_size(spark):
    assert evaluate(spark, [1e8], pricing.bubble_size("v")) == [2.0]


def test_no_python_in_expressions(spark):
    df = spark.range(3).select(F.col("id").cast("double").alias("v"))
    plan = df.select(numbers.log_scale("v"), bins.spend_tier("v"))._jdf.queryExecution().toString()
    assert "Python" not in plan
