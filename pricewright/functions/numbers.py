"""Rounding, guarded ratios and money arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

Rounding = Callable[[Column | str, int], Column]

WHOLE_FROM = 2.0**52  # from here on a double has no fraction to round


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round with plain double arithmetic.

    `round()` goes through decimal text and its treatment of ties differs between engines; one floor
    over the scaled double is the same everywhere and stays in generated code.  NaN becomes NULL;
    infinities, and values without a fraction, stay as they are.
    """
    x, scale = as_col(value).cast("double"), float(10**digits)
    plain = _roundable(x, scale)
    return _or_as_it_is(x, scale, F.floor(plain * F.lit(scale) + F.lit(0.5)) / F.lit(scale))


def _roundable(x: Column, scale: float) -> Column:
    """The value where rounding can change it, and 0 elsewhere, so that no branch overflows."""
    return F.when(F.isnan(x) | (F.abs(x * F.lit(scale)) >= F.lit(WHOLE_FROM)), F.lit(0.0)).otherwise(x)


def _or_as_it_is(x: Column, scale: float, rounded: Column) -> Column:
    return F.when(F.isnan(x), None).when(F.abs(x * F.lit(scale)) >= F.lit(WHOLE_FROM), x).otherwise(rounded)


def round_nearest(value: Column | str, digits: int) -> Column:
    """Round the exact binary value, ties to even, as Python's `round` does.

    Scaling can turn a value just below a tie into the tie itself.  Only then the lost part of the
    product matters; splitting the value into two halves of its digits recovers it exactly, because a
    power of ten up to 1e6 has few enough digits to multiply either half without loss.  NaN becomes NULL;
    infinities, and values without a fraction, stay as they are.
    """
    if not 0 <= digits <= 6:
        raise ValueError("0 to 6 digits")
    given, scale = as_col(value).cast("double"), float(10**digits)
    x = _roundable(given, scale)
    product = x * F.lit(scale)
    whole = F.floor(product)
    shifted = x * F.lit(134217729.0)  # 2^27 + 1
    upper = shifted - (shifted - x)
    lost = (upper * F.lit(scale) - product) + (x - upper) * F.lit(scale)
    fraction = product - whole
    up = (fraction > 0.5) | ((fraction == 0.5) & ((lost > 0) | ((lost == 0) & (whole % 2 != 0))))
    return _or_as_it_is(given, scale, (whole + F.when(up, 1).otherwise(0)) / F.lit(scale))


def truncate(value: Column | str) -> Column:
    """Drop the fraction, towards zero; NULL for what is no number or fits no long."""
    return as_col(value).try_cast("long")


def convert_currency(value: Column | str, rate: float) -> Column:
    """Whole units of the other currency, fraction dropped."""
    return truncate(as_col(value) * F.lit(float(rate)))


def cents(value: Column | str) -> Column:
    """An amount as whole cents: sums of these do not depend on the order of the rows.  NULL if it is not finite."""
    return F.floor(finite_or_null(value) * F.lit(100.0) + F.lit(0.5))


def safe_ratio(
    numerator: Column | str, denominator: Column | str, digits: int, rounding: Rounding = round_half_up
) -> Column:
    """Rounded ratio; 0 where the denominator is not positive or anything is missing."""
    den = as_col(denominator)
    ratio = F.try_divide(as_col(numerator), F.when(den > 0, den))
    return F.coalesce(rounding(ratio, digits), F.lit(0.0))


def or_default(value: Column | str, default: Column | float) -> Column:
    """`default` where the value is missing or zero."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(as_col(value), F.lit(0)), fallback)


def nan_to_null(value: Column | str) -> Column:
    """NULL in place of NaN."""
    v = as_col(value)
    return F.when(~F.isnan(v), v)


def finite_or_null(value: Column | str) -> Column:
    """NULL in place of NaN and the infinities."""
    v = as_col(value)
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), None).otherwise(v)


def log_scale(value: Column | str, digits: int = 4) -> Column:
    return round_half_up(F.log1p(as_col(value)), digits)


def capped_score(
    parts: list[tuple[Column | str, float, float]], digits: int = 1, rounding: Rounding = round_half_up
) -> Column:
    """Weighted sum of measures, each counted up to its cap: (measure, cap, weight).

    A missing measure earns nothing; `least` alone would pass over it and give all points.
    """
    total = None
    for measure, cap, weight in parts:
        m = as_col(measure).cast("double")
        reached = F.when(m.isNull() | F.isnan(m), F.lit(0.0)).otherwise(F.least(m / F.lit(float(cap)), F.lit(1.0)))
        part = reached * F.lit(float(weight))
        total = part if total is None else total + part
    return rounding(total, digits)
