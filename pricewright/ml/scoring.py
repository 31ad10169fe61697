"""Batch scoring of business scenarios."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions.bins import lookup
from ..functions.numbers import Rounding, as_col, capped_score, nan_to_null, round_half_up, round_nearest
from ..functions.pricing import price_band
from ..operators.encode import encode_fixed
from ..operators.reshape import with_grid
from .boosting import Boosted
from .models import needed_columns

SCENARIO = (
    "genre string, competition_score double, mau_millions double, arpdau_usd double, "
    "age_median double, region string, spending_segment string"
)
DOWNLOAD_POINTS = 20.0  # stands in for the download part of the health score, unknown in a scenario


def demo_scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.DEMO_SCENARIOS, SCENARIO)


def scenario_features(
    scenarios: DataFrame, genre_codes: DataFrame | dict[str, int], rounding: Rounding = round_half_up
) -> DataFrame:
    """The scenarios with the model features.  Unknown genres, regions and segments get neutral values.

    `genre_codes` is the table (genre, genre_encoded) saved with the model, or a small fixed dict.
    """
    if isinstance(genre_codes, dict):
        coded = scenarios.withColumn("genre_encoded", encode_fixed("genre", genre_codes))
    else:
        coded = scenarios.join(genre_codes, "genre", "left")
        coded = coded.withColumn("genre_encoded", F.coalesce("genre_encoded", F.lit(0)))
    mau = nan_to_null("mau_millions")
    dau = mau * F.lit(fv.DAU_SHARE_IN_SCENARIOS)
    coded = coded.withColumn("_ratio", F.coalesce(F.try_divide(dau, F.when(mau > 0, mau)), F.lit(0.0)))
    points = capped_score(
        [(mau, 130, 40), ("_ratio", 0.35, 30)], digits=1, rounding=lambda total, digits: rounding(total + F.lit(DOWNLOAD_POINTS), digits)
    )
    return coded.withColumns(
        {
            "dau_millions": rounding(dau, 2),
            "community_health_score": points,
            "game_median_age": F.col("age_median"),
            "dau_to_mau_ratio": rounding("_ratio", 3),
            "region_price_index": lookup("region", {r: index for r, index, _, _ in fv.REGIONS}, 1.0),
            "region_arpu_mult": lookup("region", {r: arpu for r, _, arpu, _ in fv.REGIONS}, 1.0),
            "segment_spend_mult": lookup("spending_segment", {s: m for s, m, _, _ in fv.SEGMENTS}, 1.0),
            "segment_player_pct": lookup(
                "spending_segment", {s: p for s, _, p, _ in fv.SEGMENTS}, fv.DEFAULT_SEGMENT_PLAYER_PCT
            ),
            "region_encoded": encode_fixed("region", {r: c for r, _, _, c in fv.REGIONS}),
            "segment_encoded": encode_fixed("spending_segment", {s: c for s, _, _, c in fv.SEGMENTS}),
        }
    ).drop("_ratio")


def score(
    scenarios: DataFrame, model: PipelineModel | Boosted, genre_codes: DataFrame | dict[str, int],
    rate: float = fv.IDR_PER_USD, floor: float | None = None,
) -> DataFrame:
    """The scenarios with predicted price and price band; `floor` keeps a prediction above zero.

    A scenario that lacks a number which the model needs is returned without prediction, and `not_scored` names
    what it lacks; it is NULL for the others.
    """
    features = scenario_features(scenarios, genre_codes, round_nearest)
    needed = needed_columns(model)
    lacking = F.concat_ws(", ", *[F.when(F.col(c).isNull() | F.isnan(c), F.lit(c)) for c in needed])
    marked = features.withColumn("not_scored", F.nullif(lacking, F.lit("")))
    band = price_band("prediction", rate, floor, round_nearest)
    predicted = model.transform(marked.filter("not_scored is null"))
    others = marked.filter("not_scored is not null").withColumn("prediction", F.lit(None).cast("double"))
    kept = [*scenarios.columns, "prediction", "not_scored"]
    return predicted.select(*kept).unionByName(others.select(*kept)).withColumns(band).select(*scenarios.columns, "prediction", *band, "not_scored")


def tier_estimates(
    priced: DataFrame, price: str, rate: float = fv.IDR_PER_USD, multipliers: list[tuple] | None = None
) -> DataFrame:
    """A price per 100 units as the price of each purchase tier."""
    tiers = with_grid(priced, multipliers or fv.TIER_PRICE_MULTIPLIERS, ["tier", "tier_multiplier"])
    usd = as_col(price) * F.col("tier_multiplier") * F.lit(100.0)
    return tiers.withColumns(
        {"tier_price_usd": round_half_up(usd, 2), "tier_price_idr": (usd * F.lit(float(rate))).cast("long")}
    )
