"""The six star-schema tables, each from raw records or from other tables.

Rounded columns round the exact value, so that they can be compared digit by digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions import bins
from ..functions.numbers import (
    capped_score,
    convert_currency,
    log_scale,
    or_default,
    round_nearest,
    safe_ratio,
    truncate,
)
from ..functions.pricing import optimal_price, tier_prices
from ..operators.cleaning import fill_null_median, keep_first, keep_positive
from ..operators.encode import encode_first_seen, encode_fixed
from ..operators.joins import enrich
from ..operators.reshape import explode_list, explode_map, field_by_key, join_text, unnest_series, with_grid
from ..operators.statistics import group_first
from ..schemas import ESPORTS_RECORD, STATS_RECORD, TOPUP_RECORD, conform
from ..sources.raw import DOCUMENT_ORDER, branch_records, configured_only, key_list, unreadable_documents

REGION_CODES = {region: code for region, _, _, code in fv.REGIONS}
SEGMENT_CODES = {segment: code for segment, _, _, code in fv.SEGMENTS}


def _or(column: str, default: object) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def raw_tiers(topup: DataFrame, keys: DataFrame) -> DataFrame:
    """Every tier of a configured game with its amounts and price, valid or not."""
    tiers = explode_list(configured_only(topup, keys), "tiers", "tier", "tier_no")
    currency = bins.lookup("game_key", fv.CURRENCY_FIELD, "amount")
    discount = (_or("third_party_discount_pct_min", 0) + _or("third_party_discount_pct_max", 0)) / F.lit(2.0)
    amount = field_by_key("tier", currency, fv.DEFAULT_CURRENCY_FIELD, "0").try_cast("double")
    bonus = _tier_number("bonus")
    return tiers.select(
        "game_key",
        "game",
        "ordinal",
        DOCUMENT_ORDER,
        "tier_no",
        _or("publisher", "").alias("publisher"),
        _or("currency", "").alias("currency_type"),
        F.coalesce(F.col("tier").getItem("label"), F.lit("Unknown")).alias("tier_label"),
        truncate(amount).alias("base_currency"),
        truncate(bonus).alias("bonus_currency"),
        (amount + bonus).alias("total_currency"),
        _tier_number("price_usd").alias("price"),
        discount.alias("discount_avg_pct"),
    )


# Columns whose gaps are filled with medians.
FILLED = {"fact_pricing": ["price_official_usd", "value_score"], "dim_game": ["mau_millions", "dau_millions", "arpdau_usd"]}


def fact_pricing(topup: DataFrame, keys: DataFrame, rate: float = fv.IDR_PER_USD) -> DataFrame:
    """One row per purchasable tier of a configured game."""
    filled = fill_null_median(priced_tiers(topup, keys, rate), FILLED["fact_pricing"], "game_key")
    return conform(keep_positive(filled, ["price_official_usd"]), "fact_pricing")


def priced_tiers(topup: DataFrame, keys: DataFrame, rate: float = fv.IDR_PER_USD) -> DataFrame:
    """The tiers before their gaps are filled."""
    tiers = raw_tiers(topup, keys)
    priced = keep_positive(tiers, ["price", "total_currency"])
    priced = priced.withColumns(tier_prices("price", "total_currency", "discount_avg_pct", rate, round_nearest))
    priced = priced.withColumn("spend_tier", bins.spend_tier("price"))
    priced = priced.withColumn("price_elasticity", bins.elasticity("spend_tier"))
    return keep_first(priced, ["game_key", "tier_label"], [DOCUMENT_ORDER, "tier_no"])


def _tier_number(name: str) -> Column:
    return F.coalesce(F.col("tier").getItem(name).try_cast("double"), F.lit(0.0))


def dim_game(stats: DataFrame, rejects: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per configured game.  A game without a record gets defaults, a failed one is left out."""
    return conform(fill_null_median(known_games(stats, rejects, keys), FILLED["dim_game"], "game_key"), "dim_game")


def known_games(stats: DataFrame, rejects: DataFrame, keys: DataFrame) -> DataFrame:
    """The games before their gaps are filled."""
    known = _without_failed(configured_only(stats, keys, keep_absent=True), rejects)
    mau = F.coalesce("mau_millions", F.lit(0.0))
    known = known.withColumns(
        {
            "game": F.coalesce("game", "game_key"),
            "mau": mau,
            "dau": or_default("dau_millions", mau * F.lit(fv.DAU_SHARE_IN_TABLES)),
            "downloads": F.coalesce("total_downloads_billions", F.lit(0.0)),
            "arpdau_usd": F.coalesce("arpdau_usd", F.lit(0.0)),
            "revenue_2024_usd": bins.lookup("game_key", fv.REVENUE_2024_USD, 0).cast("long"),
        }
    )
    known = known.withColumn("dau_to_mau_ratio", safe_ratio("dau", "mau", 3, round_nearest))
    known = known.select(
        "game_key",
        DOCUMENT_ORDER,
        "game",
        _or("publisher", "Unknown").alias("publisher"),
        _or("genre", "Unknown").alias("genre"),
        _or("release_year", 0).alias("release_year"),
        join_text("platforms").alias("platforms"),
        F.col("mau").alias("mau_millions"),
        round_nearest("dau", 2).alias("dau_millions"),
        "dau_to_mau_ratio",
        "registered_users_millions",
        round_nearest("downloads", 3).alias("total_downloads_billions"),
        "revenue_2024_usd",
        "arpdau_usd",
        round_nearest(F.col("arpdau_usd") * 30, 3).alias("arpu_monthly_usd"),
        safe_ratio("revenue_2024_usd", F.col("mau") * 1_000_000, 2, round_nearest).alias("revenue_per_mau_usd"),
        _or("session_minutes", 25).alias("session_minutes"),
        _or("competition_score", 50).alias("competition_score"),
        _or("android_share_pct", 75).alias("android_share_pct"),
        health_score("mau", "dau_to_mau_ratio", "downloads").alias("community_health_score"),
        bins.revenue_tier("revenue_2024_usd").alias("revenue_tier"),
        _or("age_median", 25).alias("age_median"),
        join_text("top_countries").alias("top_countries"),
    )
    return keep_first(known, ["game_key"], [DOCUMENT_ORDER])


def health_score(mau: str, ratio: str, downloads: str) -> Column:
    return capped_score([(mau, 130, 40), (ratio, 0.35, 30), (downloads, 1.5, 30)], rounding=round_nearest)


def _without_failed(records: DataFrame, rejects: DataFrame) -> DataFrame:
    failed = rejects.filter(F.col("reject_reason") == "source error").select("game_key").distinct()
    return records.join(failed, "game_key", "left_anti")


def dim_age(stats: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per game and age band."""
    bands = configured_only(stats, keys).select(
        "game_key",
        DOCUMENT_ORDER,
        F.coalesce("game", "game_key").alias("game"),
        _or("age_median", 25).alias("game_median_age"),
        "age_distribution",
    )
    bands = explode_map(bands, "age_distribution", "age_band", "pct")
    bands = bands.withColumns(
        {
            "age_price_sensitivity": bins.age_sensitivity("game_median_age"),
            "source_url": bins.lookup("game_key", fv.AGE_SOURCE_URL, ""),
        }
    )
    return conform(keep_first(bands, ["game_key", "age_band"], [DOCUMENT_ORDER]), "dim_age")


def fact_competition(esports: DataFrame, rejects: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per configured game; the tier follows from the score."""
    known = _without_failed(configured_only(esports, keys, keep_absent=True), rejects)
    known = known.select(
        "game_key",
        DOCUMENT_ORDER,
        _or("competition_score", 50).alias("competition_score"),
        _or("prize_pool_2025_usd", 0).alias("prize_pool_2025_usd"),
        _or("tournaments_total", 0).alias("tournaments_total"),
        _or("peak_viewers", 0).alias("peak_viewers"),
        _or("regional_leagues", 0).alias("regional_leagues"),
    )
    known = known.withColumns(
        {
            "competition_tier": bins.competition_tier("competition_score"),
            "prize_pool_log": log_scale("prize_pool_2025_usd"),
            "peak_viewers_log": log_scale("peak_viewers"),
        }
    )
    return conform(keep_first(known, ["game_key"], [DOCUMENT_ORDER]), "fact_competition")


def monthly_series(spark: SparkSession) -> DataFrame:
    """(game_key, ordinal, series): the embedded monthly revenue, year -> values."""
    entries = [(key, i, series) for i, (key, series) in enumerate(fv.MONTHLY_REVENUE_MILLIONS.items())]
    return spark.createDataFrame(entries, "game_key string, ordinal int, series map<int,array<double>>")


def fact_revenue_monthly(series: DataFrame, rate: float = fv.IDR_PER_USD) -> DataFrame:
    """One row per game and month; of a game's several series the first by `ordinal` counts."""
    months = unnest_series(series, "series", value="revenue_usd_millions")
    dollars = F.col("revenue_usd_millions") * 1_000_000
    months = months.withColumns(
        {
            "month_name": bins.month_name("month_num"),
            "revenue_usd": truncate(dollars),
            "revenue_idr": convert_currency(dollars, rate),
            "seasonal_multiplier": bins.seasonal_multiplier("month_num"),
        }
    )
    unique = keep_first(months, ["game_key", "year", "month_num"], ["ordinal"])
    return conform(unique, "fact_revenue_monthly")


def ml_features(
    games: DataFrame, competition: DataFrame, ages: DataFrame, keys: DataFrame, rate: float = fv.IDR_PER_USD
) -> DataFrame:
    """Every game with every region and segment, and its recommended price."""
    scores = competition.select("game_key", "competition_score", "competition_tier")
    median_age = group_first(ages, "game_key", "game_median_age", "age_band", "game_median_age")
    entities = enrich(enrich(games, scores, "game_key"), median_age, "game_key")
    entities = encode_first_seen(entities.join(F.broadcast(keys), "game_key"), "genre", "ordinal", "genre_encoded")
    regions = [(region, index, arpu) for region, index, arpu, _ in fv.REGIONS]
    segments = [(segment, multiplier, share) for segment, multiplier, share, _ in fv.SEGMENTS]
    grid = with_grid(entities, regions, ["region", "region_price_index", "region_arpu_mult"])
    grid = with_grid(grid, segments, ["spending_segment", "segment_spend_mult", "segment_player_pct"])
    price = optimal_price(
        "arpdau_usd", "competition_score", "game_median_age", "mau_millions",
        "segment_spend_mult", "region_price_index", round_nearest,
    )
    grid = grid.withColumns(
        {
            "region_encoded": encode_fixed("region", REGION_CODES),
            "segment_encoded": encode_fixed("spending_segment", SEGMENT_CODES),
            "optimal_price_per_100_usd": price,
        }
    )
    grid = grid.withColumn("optimal_price_per_100_idr", convert_currency("optimal_price_per_100_usd", rate))
    # games, regions and segments each occur once, and so do their combinations
    return conform(grid, "ml_features")


def build_tables(
    documents: DataFrame, game_keys: list[str] | None = None, rate: float = fv.IDR_PER_USD
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All six tables, lazily, and the rejected raw records."""
    spark = documents.sparkSession
    keys = key_list(spark, game_keys or fv.GAME_KEYS)
    topup, bad_topup = branch_records(documents, "topup", TOPUP_RECORD)
    stats, bad_stats = branch_records(documents, "stats", STATS_RECORD)
    esports, bad_esports = branch_records(documents, "esports", ESPORTS_RECORD)

    games = dim_game(stats, bad_stats, keys)
    ages = dim_age(stats, keys)
    competition = fact_competition(esports, bad_esports, keys)
    tables = {
        "dim_game": games,
        "fact_pricing": fact_pricing(topup, keys, rate),
        "dim_age": ages,
        "fact_competition": competition,
        "fact_revenue_monthly": fact_revenue_monthly(monthly_series(spark), rate),
        "ml_features": ml_features(games, competition, ages, keys, rate),
    }
    rejects = bad_topup.unionByName(bad_stats).unionByName(bad_esports).unionByName(unreadable_documents(documents))
    return tables, rejects
