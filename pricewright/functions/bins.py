"""Threshold bins and lookups in small fixed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .numbers import as_col

MAX_LITERAL_LOOKUP = 64


def below(value: Column | str, bounds: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """Label of the first bound that exceeds the value."""
    v = as_col(value)
    out = None
    for bound, label in bounds:
        out = F.when(v < bound, label) if out is None else out.when(v < bound, label)
    return out.otherwise(otherwise)


def at_least(value: Column | str, bounds: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """Label of the first bound that the value reaches."""
    v = as_col(value)
    out = None
    for bound, label in bounds:
        out = F.when(v >= bound, label) if out is None else out.when(v >= bound, label)
    return out.otherwise(otherwise)


def lookup(key: Column | str, table: Mapping[object, object], default: object = None) -> Column:
    """Value of a small fixed table at `key`; no join, the table travels inside the plan."""
    if len(table) > MAX_LITERAL_LOOKUP:
        raise ValueError(f"{len(table)} entries: use operators.joins.lookup_join")
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.element_at(F.create_map(*entries), as_col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def spend_tier(price: Column | str) -> Column:
    return below(price, fv.SPEND_TIERS, fv.SPEND_TIER_ABOVE)


def elasticity(tier: Column | str) -> Column:
    return lookup(tier, fv.TIER_ELASTICITY)


def revenue_tier(revenue: Column | str, bounds=tuple(fv.REVENUE_TIERS)) -> Column:
    return at_least(revenue, bounds, fv.REVENUE_TIER_BELOW)


def competition_tier(score: Column | str) -> Column:
    return at_least(score, fv.COMPETITION_TIERS, fv.COMPETITION_TIER_BELOW)


def age_sensitivity(age: Column | str) -> Column:
    return below(age, fv.AGE_SENSITIVITY, fv.AGE_SENSITIVITY_ABOVE)


def price_strategy(price: Column | str) -> Column:
    return below(price, fv.PRICE_STRATEGY, fv.PRICE_STRATEGY_ABOVE)


def model_quality(r2: Column | str) -> Column:
    return at_least(as_col(r2) * 100, fv.MODEL_QUALITY, fv.MODEL_QUALITY_BELOW)


def is_stable(cv_std: Column | str) -> Column:
    """A spread of the fold scores below 0.05 counts as consistent, otherwise as overfitted."""
    return as_col(cv_std) < 0.05


def spend_segment(monthly_spend: Column | str) -> Column:
    return at_least(monthly_spend, fv.SPEND_SEGMENTS, fv.SPEND_SEGMENT_BELOW)


def month_name(month: Column | str) -> Column:
    return lookup(month, dict(enumerate(fv.MONTH_NAMES, start=1)))


def seasonal_multiplier(month: Column | str) -> Column:
    return lookup(month, fv.SEASONAL_MULTIPLIER, 1.0)
