from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pricewright import fixed_values as fv
from pricewright.plans import star, views
from pricewright.schemas import TABLE_KEYS, TABLES, fields
from pricewright.sources import raw


def test_shapes_and_schemas(tables):
    expected = {
        "dim_game": (6, 22), "fact_pricing": (51, 19), "dim_age": (24, 7),
        "fact_competition": (6, 9), "fact_revenue_monthly": (36, 8), "ml_features": (90, 22),
    }
    for name, df in tables.items():
        assert (df.count(), len(df.columns)) == expected[name]
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in fields(TABLES[name])]


def test_keys_are_unique(tables):
    for name, df in tables.items():
        assert df.select(*TABLE_KEYS[name]).distinct().count() == df.count()


# game, dau/mau, health, monthly ARPU, revenue per MAU, price in SEA for dolphins, East Asia whales, LATAM minnows
GOLDEN = [
    ("mlbb", 0.164, 67.9, 0.54, 1.77, 0.4463, 1.5301, 0.2562),
    ("free_fire", 0.254, 87.8, 0.9, 3.14, 0.9055, 3.1046, 0.5197),
    ("pubg_mobile", 0.15, 63.6, 1.95, 20.0, 1.911, 6.552, 1.0969),
    ("genshin_impact", 0.25, 30.5, 3.78, 46.05, 7.5632, 25.9308, 4.3411),
    ("honkai_star_rail", 0.15, 22.0, 3.69, 45.0, 5.1229, 17.5644, 2.9405),
    ("cod_mobile", 0.15, 38.2, 0.6, 7.2, 0.7105, 2.436, 0.4078),
]


@pytest.mark.parametrize("golden", GOLDEN, ids=[g[0] for g in GOLDEN])
def test_game_goldens(tables, golden):
    key, ratio, health, arpu, per_mau, *prices = golden
    game = tables["dim_game"].filter(F.col("game_key") == key).first()
    got = (game["dau_to_mau_ratio"], game["community_health_score"], game["arpu_monthly_usd"], game["revenue_per_mau_usd"])
    assert got == (ratio, health, arpu, per_mau)
    cells = [("SEA", "dolphin"), ("East_Asia", "whale"), ("LATAM", "minnow")]
    grid = {(r["region"], r["spending_segment"]): r["optimal_price_per_100_usd"]
            for r in tables["ml_features"].filter(F.col("game_key") == key).collect()}
    assert [grid[c] for c in cells] == prices


def test_grid_totals(tables):
    low, high, total = tables["ml_features"].agg(F.min(fv.TARGET), F.max(fv.TARGET), F.sum(fv.TARGET)).first()
    assert (low, high) == (0.2391, 25.9308)
    assert total == pytest.approx(378.6611, abs=1e-9)


def test_genre_codes(tables):
    codes = dict(rows(tables["ml_features"].select("genre", "genre_encoded").distinct()))
    assert codes == {
        "MOBA": 0, "Battle Royale": 1, "RPG / Gacha / Open World": 2,
        "Turn-based RPG / Gacha": 3, "Shooter / Battle Royale": 4,
    }


def test_pricing_goldens(tables):
    pricing = tables["fact_pricing"]
    counts = dict(rows(pricing.groupBy("spend_tier").count()))
    assert counts == {"micro": 10, "small": 12, "medium": 12, "large": 8, "mega": 9}
    assert pricing.agg(F.sum("price_official_usd")).first()[0] == pytest.approx(1907.49)
    starter = pricing.filter("game_key = 'mlbb' and tier_label = 'Starter'").first()
    assert starter["discount_avg_pct"] == 28.0
    assert (starter["price_3rdparty_usd"], starter["price_official_idr"]) == (0.353, 7962)
    assert (starter["price_per_100_usd"], starter["value_score"], starter["price_elasticity"]) == (9.8, 10.2, -2.1)


def test_revenue_rows(tables):
    first = tables["fact_revenue_monthly"].filter("game_key = 'mlbb' and year = 2025 and month_num = 1").first()
    assert first.asDict() == {
        "game_key": "mlbb", "year": 2025, "month_num": 1, "month_name": "Jan", "revenue_usd_millions": 24.3,
        "revenue_usd": 24300000, "revenue_idr": 394875000000, "seasonal_multiplier": 1.35,
    }


def test_absent_failed_and_incomplete_records(spark):
    document = {
        "topup": {
            "mlbb": {"game": "M", "tiers": [
                {"diamonds": 5, "price_usd": 1.0, "label": "x"},
                {"diamonds": 9, "price_usd": 2.0, "label": "x"},  # same label, later
                {"diamonds": 0, "price_usd": 1.0, "label": "no units"},
                {"diamonds": 5, "price_usd": 0, "label": "free"},
                {"diamonds": 5, "price_usd": "n/a", "label": "unreadable"},
                {"diamonds": 5, "price_usd": 1.0},
            ]},
            "pubg_mobile": {"game": "P", "tiers": [{"diamonds": 7, "price_usd": 3.0, "label": "fallback"}]},
            "not_configured": {"game": "N", "tiers": [{"diamonds": 5, "price_usd": 1.0, "label": "x"}]},
        },
        "stats": {
            "mlbb": {"game": "M", "mau_millions": 10.0, "dau_millions": 0},
            "free_fire": {"_error": "timeout"},
        },
        "esports": {"mlbb": {"competition_score": 60}, "cod_mobile": {"_error": "down"}},
    }
    built, rejects = star.build_tables(raw.document_frame(spark, document))
    pricing = rows(built["fact_pricing"], "game_key", "tier_label", "total_currency")
    assert pricing == [("mlbb", "Unknown", 5), ("mlbb", "x", 5), ("pubg_mobile", "fallback", 7)]
    games = {r["game_key"]: r for r in built["dim_game"].collect()}
    assert set(games) == set(fv.GAME_KEYS) - {"free_fire"}
    assert games["mlbb"]["dau_millions"] == 1.5  # zero counts as missing
    default = games["cod_mobile"]
    assert (default["game"], default["publisher"], default["platforms"]) == ("cod_mobile", "Unknown", "")
    assert (default["mau_millions"], default["dau_to_mau_ratio"], default["revenue_per_mau_usd"]) == (0.0, 0.0, 0.0)
    assert (default["session_minutes"], default["competition_score"], default["age_median"]) == (25, 50, 25)
    competition = dict(rows(built["fact_competition"], "game_key", "competition_tier"))
    assert set(competition) == set(fv.GAME_KEYS) - {"cod_mobile"}
    assert (competition["mlbb"], competition["free_fire"]) == ("High", "Medium")
    assert built["dim_age"].count() == 0
    assert rows(rejects, "game_key", "reject_reason") == [("cod_mobile", "source error"), ("free_fire", "source error")]


# -- views ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def market(tables):
    return views.Star.of(tables)


def test_kpis(market):
    got = views.kpis(market).first().asDict()
    assert got["total_revenue_usd"] == 4562990000 and got["games"] == 6
    assert got["total_mau_millions"] == pytest.approx(425.2)
    assert got["mean_arpdau_usd"] == pytest.approx(0.063667, abs=1e-6)
    assert got["mean_discount_pct"] == pytest.approx(973 / 51)


def test_selection_limits_all_but_the_model_table(market):
    chosen = market.selected(["mlbb", "cod_mobile"])
    assert (chosen.game.count(), chosen.pricing.count(), chosen.ml.count()) == (2, 24, 90)


def test_rankings(market):
    assert [r["game_key"] for r in views.revenue_ranking(market).collect()][0] == "mlbb"
    assert [r["competition_score"] for r in views.competition_ranking(market).collect()] == [25, 30, 55, 60, 80, 85]
    assert views.prize_ranking(market).count() == 5
    assert views.discount_per_game(market).first()["discount_avg_pct"] == 10.0


def test_bubble_and_detail(market):
    sizes = dict(rows(views.competition_bubble(market), "game_short", "size"))
    assert sizes["PUBG Mobile"] == 40.0
    assert views.competition_detail(market).count() == 6


def test_trend_and_price_table(market):
    trend = views.revenue_trend(market).collect()
    assert len(trend) == 24 and [r["month_num"] for r in trend[:12]] == list(range(1, 13))
    table = views.price_table(market, ["micro"], in_idr=True)
    assert table.count() == 10 and dict(table.dtypes)["official_price"] == "bigint"
    assert len(views.elasticity_per_tier(market).collect()) == 5


def test_demography(market):
    ages = {r["game_key"]: r for r in views.age_distribution(market).collect()}
    assert ages["free_fire"]["13-17"] == 35.0
    sensitivity = dict(rows(views.age_sensitivity(market), "game_key", "sensitivity"))
    assert sensitivity["free_fire"] == "high" and sensitivity["genshin_impact"] == "low"


def test_heatmap_frames(market):
    r = {(x["a"], x["b"]): x["r"] for x in views.correlation(market).collect()}
    assert len(r) == 36
    target = {b: v for (a, b), v in r.items() if a == fv.TARGET}
    expected = {
        "mau_millions": -0.6183, "dau_millions": -0.5013, "arpdau_usd": 0.7391, "competition_score": -0.6503,
        "community_health_score": -0.5422, "game_median_age": 0.7014, "region_price_index": 0.1632,
        "segment_spend_mult": 0.4191,
    }
    assert target == pytest.approx(expected, abs=1e-4)
    prices = {x["game"]: x for x in views.price_by_region(market).collect()}
    assert prices["Genshin Impact"]["East_Asia"] == pytest.approx(15.2807, abs=1e-4)
    assert prices["Mobile Legends: Bang Bang"]["SEA"] == pytest.approx(0.5260, abs=1e-4)


def test_dataset_views(market):
    assert views.dataset_preview(market).count() == 90
    assert views.target_distribution(market).agg(F.sum("rows")).first()[0] == 90


def test_segment_shares(spark):
    spend = spark.createDataFrame([(200.0,), (50.0,), (50.0,), (1.0,)], "v double")
    got = {r["segment"]: (r["player_months"], r["player_pct"], r["revenue_pct"]) for r in views.segment_shares(spend, "v").collect()}
    assert got == {"whale": (1, 25.0, 66.45), "dolphin": (2, 50.0, 33.22), "minnow": (1, 25.0, 0.33)}
