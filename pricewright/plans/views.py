"""Dashboard views over the star tables.  Each is lazy, so filters and columns reach the scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..functions import bins
from ..functions.numbers import as_col, round_half_up
from ..functions.pricing import bubble_size
from ..operators.joins import enrich_if_absent, keep_in
from ..operators.statistics import correlation_pairs, group_mean, histogram, pivot_mean, ranked


@dataclass(frozen=True)
class Star:
    """The six tables."""

    game: DataFrame
    pricing: DataFrame
    age: DataFrame
    competition: DataFrame
    revenue: DataFrame
    ml: DataFrame

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> Star:
        return cls(
            tables["dim_game"], tables["fact_pricing"], tables["dim_age"],
            tables["fact_competition"], tables["fact_revenue_monthly"], tables["ml_features"],
        )

    def selected(self, game_keys: list[str]) -> Star:
        """All but the model table limited to the chosen games."""
        def chosen(df: DataFrame) -> DataFrame:
            return keep_in(df, "game_key", game_keys)

        return Star(
            chosen(self.game), chosen(self.pricing), chosen(self.age),
            chosen(self.competition), chosen(self.revenue), self.ml,
        )


def _short(df: DataFrame) -> DataFrame:
    return df.withColumn("game_short", bins.lookup("game_key", fv.GAME_SHORT_NAMES))


def kpis(star: Star) -> DataFrame:
    """One row; the mean discount runs over tiers, not games."""
    discount = star.pricing.agg(F.avg("discount_avg_pct"))
    return star.game.agg(
        F.sum("revenue_2024_usd").alias("total_revenue_usd"),
        F.sum("mau_millions").alias("total_mau_millions"),
        F.avg("arpdau_usd").alias("mean_arpdau_usd"),
        F.count(F.lit(1)).alias("games"),
    ).select("*", discount.scalar().alias("mean_discount_pct"))


def revenue_ranking(star: Star) -> DataFrame:
    return ranked(star.game.select("game_key", "revenue_2024_usd"), "revenue_2024_usd", "game_key")


def competition_bubble(star: Star) -> DataFrame:
    games = enrich_if_absent(star.game, star.competition, "game_key", "competition_score")
    return _short(games).select(
        "game_key", "game_short", "competition_score", "arpdau_usd", bubble_size("revenue_2024_usd").alias("size")
    )


def revenue_trend(star: Star, year: int = 2024) -> DataFrame:
    months = _short(star.revenue.filter(F.col("year") == year))
    return months.select("game_key", "game_short", "month_num", "month_name", "revenue_usd_millions").orderBy(
        "game_key", "month_num"
    )


def price_columns(in_idr: bool) -> list[str]:
    """Official and third-party price in the chosen currency."""
    currency = "idr" if in_idr else "usd"
    return [f"price_official_{currency}", f"price_3rdparty_{currency}"]


def price_table(star: Star, tiers: list[str] | None = None, in_idr: bool = False) -> DataFrame:
    rows = keep_in(star.pricing, "spend_tier", tiers or list(fv.TIER_ELASTICITY))
    official, reseller = price_columns(in_idr)
    return rows.select(
        "game", "tier_label", "spend_tier", "base_currency", "bonus_currency", "total_currency",
        F.col(official).alias("official_price"), F.col(reseller).alias("third_party_price"),
        "discount_avg_pct", "value_score", "price_elasticity",
    )


def discount_per_game(star: Star) -> DataFrame:
    return _short(group_mean(star.pricing, "game_key", "discount_avg_pct", "discount_avg_pct"))


def elasticity_per_tier(star: Star) -> DataFrame:
    return star.pricing.select("spend_tier", "price_elasticity").distinct().orderBy("price_elasticity")


MAX_BANDS = 200


def age_distribution(star: Star, bands: list[str] | None = None) -> DataFrame:
    """Shares per game, a column for each age band; all bands of the data unless some are chosen."""
    if bands is None:
        found = star.age.select("age_band").filter("age_band is not null").distinct().limit(MAX_BANDS + 1).collect()
        if len(found) > MAX_BANDS:
            raise ValueError(f"more than {MAX_BANDS} age bands: choose some")
        bands = sorted(r.age_band for r in found)
    return _short(pivot_mean(star.age, "game_key", "age_band", bands, "pct", fill=0.0))


def age_sensitivity(star: Star) -> DataFrame:
    games = _short(star.game).withColumn("sensitivity", bins.age_sensitivity("age_median"))
    score = bins.lookup("sensitivity", fv.AGE_SENSITIVITY_SCORE).alias("sensitivity_score")
    return games.select("game_key", "game_short", "age_median", "mau_millions", "sensitivity", score)


def segment_shares(spend: DataFrame, amount: Column | str) -> DataFrame:
    """(segment, player_months, player_pct, revenue_pct) of monthly spend, one row per player and month."""
    milli = F.floor(as_col(amount) * 1e3 + 0.5)
    per_segment = spend.groupBy(bins.spend_segment(amount).alias("segment")).agg(
        F.count(F.lit(1)).alias("player_months"), F.sum(milli).alias("_milli")
    )
    everyone = Window.partitionBy()  # one row per segment

    def share(column: str) -> Column:
        return round_half_up(F.try_divide(F.col(column) * 100.0, F.sum(column).over(everyone)), 2)

    return per_segment.select(
        "segment", "player_months", share("player_months").alias("player_pct"), share("_milli").alias("revenue_pct")
    )


def competition_ranking(star: Star) -> DataFrame:
    return ranked(_short(star.competition).select("game_key", "game_short", "competition_score"), "competition_score", "game_key")


def prize_ranking(star: Star) -> DataFrame:
    paying = star.competition.filter(F.col("prize_pool_2025_usd") > 0)
    return ranked(_short(paying).select("game_key", "game_short", "prize_pool_2025_usd"), "prize_pool_2025_usd", "game_key")


def competition_detail(star: Star) -> DataFrame:
    detail = star.competition.join(star.game.select("game_key", "game"), "game_key")
    return _short(detail).select(
        "game", "game_short", "competition_tier", "competition_score", "prize_pool_2025_usd",
        "tournaments_total", "peak_viewers", "regional_leagues",
    )


def correlation(star: Star) -> DataFrame:
    return correlation_pairs(star.ml, fv.CORRELATION_COLUMNS)


def price_by_region(star: Star) -> DataFrame:
    return pivot_mean(star.ml, "game", "region", sorted(r for r, *_ in fv.REGIONS), fv.TARGET)


def dataset_preview(star: Star) -> DataFrame:
    return star.ml.select(
        "game", "region", "spending_segment", "arpdau_usd", "competition_score", "game_median_age",
        F.col(fv.TARGET).alias("target_price"),
    )


def target_distribution(star: Star, bin_count: int = 20) -> DataFrame:
    return histogram(star.ml, fv.TARGET, bin_count)


def model_verdict(scores: DataFrame, rate: float = fv.IDR_PER_USD) -> DataFrame:
    """Scores with a quality label, a stability flag and the mean error in the second currency."""
    return scores.withColumns(
        {
            "quality": bins.model_quality("r2"),
            "stable": bins.is_stable("cv_std"),
            "mae_idr": (F.col("mae") * F.lit(rate)).cast("long"),
        }
    )
