"""Price formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .numbers import Rounding, as_col, convert_currency, nan_to_null, round_half_up


def tier_prices(
    price: Column | str,
    units: Column | str,
    discount_pct: Column | str,
    rate: float = fv.IDR_PER_USD,
    rounding: Rounding = round_half_up,
) -> dict[str, Column]:
    """The derived prices of one purchasable amount of currency, by output column name."""
    p, n = as_col(price), as_col(units)
    reseller = rounding(p * (F.lit(1.0) - as_col(discount_pct) / F.lit(100.0)), 3)
    per_unit = F.try_divide(p, n)
    return {
        "price_official_usd": rounding(p, 2),
        "price_official_idr": convert_currency(p, rate),
        "price_3rdparty_usd": reseller,
        "price_3rdparty_idr": convert_currency(reseller, rate),
        "price_per_unit_usd": rounding(per_unit, 6),
        "price_per_100_usd": rounding(per_unit * F.lit(100.0), 4),
        "price_per_100_idr": convert_currency(per_unit * F.lit(100.0), rate),
        "value_score": rounding(F.try_divide(n, p), 2),
    }


def optimal_price(
    arpdau: Column | str,
    competition: Column | str,
    median_age: Column | str,
    mau: Column | str,
    segment_multiplier: Column | str,
    region_index: Column | str,
    rounding: Rounding = round_half_up,
) -> Column:
    """Recommended price per 100 units.  A missing age or audience counts as neutral; NULL without any of the other inputs."""
    age, audience = nan_to_null(median_age), nan_to_null(mau)
    income = nan_to_null(arpdau)
    base = F.when(income.isNotNull(), F.greatest(income * F.lit(50.0), F.lit(0.5)))
    competition_factor = F.lit(1.0) - as_col(competition) / F.lit(200.0)
    age_factor = F.when(age > 30, 1.25).when(age < 20, 0.80).otherwise(1.0)
    audience_factor = F.when(audience > 100, 0.88).when(audience < 20, 1.12).otherwise(1.0)
    return rounding(
        base
        * competition_factor
        * as_col(segment_multiplier)
        * age_factor
        * audience_factor
        * as_col(region_index),
        4,
    )


def price_band(
    price: Column | str, rate: float = fv.IDR_PER_USD, floor: float | None = None, rounding: Rounding = round_half_up
) -> dict[str, Column]:
    """A price with its low and high end in both currencies, by output column name; NULL for a missing price."""
    p = nan_to_null(price)
    if floor is not None:  # `greatest` passes over NULL, which would price an unpredicted row at the floor
        p = F.when(p.isNotNull(), F.greatest(p, F.lit(float(floor))))
    low, high = p * F.lit(fv.BAND_LOW), p * F.lit(fv.BAND_HIGH)
    return {
        "predicted_price_per_100_usd": rounding(p, 3),
        "predicted_price_per_100_idr": convert_currency(p, rate),
        "range_low_usd": rounding(low, 3),
        "range_high_usd": rounding(high, 3),
        "range_low_idr": convert_currency(low, rate),
        "range_high_idr": convert_currency(high, rate),
    }


def bubble_size(revenue: Column | str, unit: float = 5e7) -> Column:
    return as_col(revenue) / F.lit(unit)
