"""Table schemas, as DDL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Branches stay maps of JSON text: keys are data, and one unreadable entry must not spoil the others.
RAW_DOCUMENT = (
    "topup map<string,string>, stats map<string,string>, esports map<string,string>, "
    "market map<string,string>, _pipeline_meta map<string,string>"
)

TOPUP_RECORD = (
    "game string, publisher string, currency string, sources array<string>, "
    "third_party_discount_pct_min int, third_party_discount_pct_max int, "
    "tiers array<map<string,string>>, _error string"
)

STATS_RECORD = (
    "game string, genre string, publisher string, release_year int, platforms array<string>, "
    "sources array<string>, mau_millions double, dau_millions double, registered_users_millions double, "
    "total_downloads_billions double, revenue_by_year map<string,bigint>, lifetime_revenue_usd bigint, "
    "arpdau_usd double, session_minutes int, competition_score int, android_share_pct int, "
    "top_countries array<string>, age_distribution map<string,int>, age_median int, _error string"
)

ESPORTS_RECORD = (
    "competition_tier string, competition_score int, prize_pool_2025_usd bigint, tournaments_total int, "
    "peak_viewers bigint, regional_leagues int, sources array<string>, _error string"
)

REGION_RECORD = ("price_index double, countries array<string>")

SEGMENT_RECORD = (
    "threshold_monthly_usd int, player_share_pct_min int, player_share_pct_max int, "
    "revenue_share_pct_min int, revenue_share_pct_max int"
)

TABLES = {
    "dim_game": (
        "game_key string, game string, publisher string, genre string, release_year int, platforms string, "
        "mau_millions double, dau_millions double, dau_to_mau_ratio double, registered_users_millions double, "
        "total_downloads_billions double, revenue_2024_usd bigint, arpdau_usd double, arpu_monthly_usd double, "
        "revenue_per_mau_usd double, session_minutes int, competition_score int, android_share_pct int, "
        "community_health_score double, revenue_tier string, age_median int, top_countries string"
    ),
    "fact_pricing": (
        "game_key string, game string, publisher string, currency_type string, tier_label string, "
        "base_currency int, bonus_currency int, total_currency int, price_official_usd double, "
        "price_official_idr bigint, price_3rdparty_usd double, price_3rdparty_idr bigint, "
        "discount_avg_pct double, price_per_unit_usd double, price_per_100_usd double, "
        "price_per_100_idr bigint, value_score double, spend_tier string, price_elasticity double"
    ),
    "dim_age": (
        "game_key string, game string, age_band string, pct int, game_median_age int, "
        "age_price_sensitivity string, source_url string"
    ),
    "fact_competition": (
        "game_key string, competition_score int, competition_tier string, prize_pool_2025_usd bigint, "
        "prize_pool_log double, tournaments_total int, peak_viewers bigint, peak_viewers_log double, "
        "regional_leagues int"
    ),
    "fact_revenue_monthly": (
        "game_key string, year int, month_num int, month_name string, revenue_usd_millions double, "
        "revenue_usd bigint, revenue_idr bigint, seasonal_multiplier double"
    ),
    "ml_features": (
        "game_key string, game string, genre string, region string, spending_segment string, "
        "mau_millions double, dau_millions double, arpdau_usd double, revenue_2024_usd bigint, "
        "competition_score double, community_health_score double, game_median_age double, "
        "dau_to_mau_ratio double, region_price_index double, region_arpu_mult double, "
        "segment_spend_mult double, segment_player_pct int, genre_encoded int, region_encoded int, "
        "segment_encoded int, optimal_price_per_100_usd double, optimal_price_per_100_idr bigint"
    ),
}

# Parquet folders by these columns, so that a filter on them skips files.
PARTITIONED_BY = {"fact_revenue_monthly": ["year"]}

AUDIT_LOG = (
    "table_name string, rows_loaded bigint, checksum string, status string, loaded_at timestamp, note string, run string"
)

TABLE_KEYS = {
    "dim_game": ["game_key"],
    "fact_pricing": ["game_key", "tier_label"],
    "dim_age": ["game_key", "age_band"],
    "fact_competition": ["game_key"],
    "fact_revenue_monthly": ["game_key", "year", "month_num"],
    "ml_features": ["game_key", "region", "spending_segment"],
}


def fields(ddl: str) -> StructType:
    """The parsed schema; parsing needs a running session."""
    return StructType.fromDDL(ddl)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of the table in schema order and type; a missing column is an error."""
    schema = fields(TABLES[table])
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
