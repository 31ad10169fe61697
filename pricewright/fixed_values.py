"""Fixed values.

Everything in this module is data, stated plainly: the embedded market snapshot
(prices, usage statistics, esports figures), the business lookups and the model
feature list.  They have to equal the published figures for results to be right.
No function lives here; jobs turn these values into DataFrames.
"""

# -- keys and rates ---------------------------------------------------------------

IDR_PER_USD = 16250.0

GAME_KEYS = ["mlbb", "free_fire", "pubg_mobile", "genshin_impact", "honkai_star_rail", "cod_mobile"]

GAME_SHORT_NAMES = {
    "mlbb": "MLBB",
    "free_fire": "Free Fire",
    "pubg_mobile": "PUBG Mobile",
    "genshin_impact": "Genshin Impact",
    "honkai_star_rail": "Honkai: SR",
    "cod_mobile": "CoD Mobile",
}

# name of the amount field inside a price tier
CURRENCY_FIELD = {
    "mlbb": "diamonds",
    "free_fire": "diamonds",
    "pubg_mobile": "uc",
    "genshin_impact": "crystals",
    "honkai_star_rail": "shards",
    "cod_mobile": "cp",
}
DEFAULT_CURRENCY_FIELD = "diamonds"

# -- regions and spending segments ------------------------------------------------

# region, price index, ARPU multiplier, code
REGIONS = [
    ("SEA", 0.70, 0.65, 0),
    ("LATAM", 0.75, 0.70, 1),
    ("Global_West", 1.00, 1.00, 2),
    ("East_Asia", 1.20, 1.30, 3),
    ("MENA", 0.85, 0.80, 4),
]

# segment, spend multiplier, percent of players, code
SEGMENTS = [
    ("whale", 2.8, 3, 2),
    ("dolphin", 1.4, 15, 0),
    ("minnow", 0.75, 82, 1),
]
DEFAULT_SEGMENT_PLAYER_PCT = 15

# -- tier tables: (exclusive upper bound, label), then the label beyond the last bound ----

SPEND_TIERS = [(2, "micro"), (10, "small"), (30, "medium"), (60, "large")]
SPEND_TIER_ABOVE = "mega"
TIER_ELASTICITY = {"micro": -2.1, "small": -1.6, "medium": -0.9, "large": -0.5, "mega": -0.3}

AGE_SENSITIVITY = [(22, "high"), (30, "medium")]
AGE_SENSITIVITY_ABOVE = "low"
AGE_SENSITIVITY_SCORE = {"high": 3, "medium": 2, "low": 1}

PRICE_STRATEGY = [(0.80, "penetration"), (2.5, "competitive"), (8, "controlled premium")]
PRICE_STRATEGY_ABOVE = "luxury premium"

# (inclusive lower bound, label), then the label below the last bound
REVENUE_TIERS = [(1_000_000_000, "blockbuster"), (400_000_000, "major"), (100_000_000, "mid")]
REVENUE_TIER_BELOW = "small"
COMPETITION_TIERS = [(80, "Elite"), (60, "High"), (40, "Medium")]
COMPETITION_TIER_BELOW = "Low"
MODEL_QUALITY = [(90, "very good"), (75, "good")]
MODEL_QUALITY_BELOW = "needs work"
SPEND_SEGMENTS = [(100, "whale"), (10, "dolphin")]
SPEND_SEGMENT_BELOW = "minnow"

# tier, multiple of the price per 100 units
TIER_PRICE_MULTIPLIERS = [("micro", 0.08), ("small", 0.30), ("medium", 1.00), ("large", 3.50), ("mega", 12.00)]

# price band around a predicted price, and the floor applied to a prediction
BAND_LOW, BAND_HIGH, PRICE_FLOOR = 0.82, 1.22, 0.001

# daily users assumed as a share of monthly users: in the tables, and when scoring a scenario
DAU_SHARE_IN_TABLES, DAU_SHARE_IN_SCENARIOS = 0.15, 0.18

# -- calendar ---------------------------------------------------------------------

MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Agu", "Sep", "Okt", "Nov", "Des"]

SEASONAL_MULTIPLIER = {
    1: 1.35, 2: 0.90, 3: 1.20, 4: 0.95, 5: 1.05, 6: 0.88,
    7: 0.90, 8: 1.00, 9: 0.98, 10: 1.05, 11: 1.15, 12: 1.10,
}

REVENUE_2024_USD = {
    "mlbb": 194_990_000,
    "free_fire": 408_000_000,
    "pubg_mobile": 2_000_000_000,
    "genshin_impact": 700_000_000,
    "honkai_star_rail": 900_000_000,
    "cod_mobile": 360_000_000,
}

# millions of USD, January first
MONTHLY_REVENUE_MILLIONS = {
    "mlbb": {
        2024: [18.0, 14.0, 16.0, 15.0, 17.0, 13.0, 14.0, 16.0, 15.0, 17.0, 19.0, 14.0],
        2025: [24.3, 16.0, 22.4, 15.0, 16.0, 18.0],
    },
    "free_fire": {
        2024: [20.0, 17.0, 18.0, 16.0, 17.0, 16.0, 18.0, 17.0, 19.0, 18.0, 17.0, 31.0],
        2025: [30.9, 17.0, 18.0, 16.0, 17.0, 18.0],
    },
}

AGE_SOURCE_URL = {
    "mlbb": "https://icon-era.com/blog/mobile-legends-bang-bang-live-player-count-and-statistics.443/",
    "free_fire": "https://www.businessofapps.com/data/free-fire-statistics/",
    "pubg_mobile": "https://sqmagazine.co.uk/mobile-games-statistics/",
    "genshin_impact": "https://news.bittopup.com/news/genshin-impact-2025-15.2m-players-0.8b-revenue",
    "honkai_star_rail": "https://techrt.com/mobile-game-spending-statistics/",
    "cod_mobile": "https://techrt.com/mobile-game-spending-statistics/",
}

# -- model ------------------------------------------------------------------------

TARGET = "optimal_price_per_100_usd"

FEATURES = [
    "mau_millions",
    "dau_millions",
    "arpdau_usd",
    "competition_score",
    "community_health_score",
    "game_median_age",
    "dau_to_mau_ratio",
    "region_price_index",
    "region_arpu_mult",
    "segment_spend_mult",
    "segment_player_pct",
    "genre_encoded",
    "region_encoded",
    "segment_encoded",
]

FEATURE_LABELS = {
    "mau_millions": "Monthly active users",
    "dau_millions": "Daily active users",
    "arpdau_usd": "Revenue per daily user",
    "competition_score": "Competition score",
    "community_health_score": "Community health score",
    "game_median_age": "Median player age",
    "dau_to_mau_ratio": "Daily to monthly user ratio",
    "region_price_index": "Regional price index",
    "region_arpu_mult": "Regional ARPU multiplier",
    "segment_spend_mult": "Segment spend multiplier",
    "segment_player_pct": "Share of players in segment",
    "genre_encoded": "Genre (encoded)",
    "region_encoded": "Region (encoded)",
    "segment_encoded": "Segment (encoded)",
}

CORRELATION_COLUMNS = [
    "mau_millions",
    "dau_millions",
    "arpdau_usd",
    "competition_score",
    "community_health_score",
    "game_median_age",
    "region_price_index",
    "segment_spend_mult",
    "optimal_price_per_100_usd",
]

# genre, competition score, MAU (millions), ARPDAU, median age, region, segment
DEMO_SCENARIOS = [
    ("MOBA", 85.0, 110.0, 0.018, 22.0, "SEA", "dolphin"),
    ("Battle Royale", 60.0, 130.0, 0.030, 20.0, "LATAM", "minnow"),
    ("RPG / Gacha / Open World", 25.0, 15.0, 0.126, 35.0, "East_Asia", "whale"),
    ("Shooter / Battle Royale", 80.0, 100.0, 0.065, 27.0, "Global_West", "dolphin"),
]

# -- embedded snapshot: top-up prices ----------------------------------------------

# per game: title, publisher, currency, discount min and max in percent, sources,
# tiers as (amount, bonus, price in USD, label)
TOPUP = {
    "mlbb": (
        "Mobile Legends: Bang Bang", "Moonton (ByteDance)", "Diamonds", 20, 36,
        [
            "https://www.gamebar.gg/top-up/mobile-legends",
            "https://www.seagm.com/en-us/mobile-legends-diamonds-top-up",
            "https://www.gamsgo.com/top-up/mobile-legends",
        ],
        [
            (5, 0, 0.49, "Starter"), (12, 0, 0.99, "Micro"), (20, 0, 1.49, "Micro+"),
            (44, 0, 2.99, "Small"), (65, 0, 4.99, "Small+"), (77, 8, 4.99, "Weekly Pass"),
            (154, 16, 9.99, "Medium"), (217, 23, 14.99, "Medium+"), (256, 40, 14.99, "Twilight Pass"),
            (367, 41, 22.99, "Large"), (507, 65, 29.99, "Large+"), (706, 0, 39.99, "XLarge"),
            (774, 101, 49.99, "XLarge+"), (1007, 156, 59.99, "XXLarge"), (1708, 302, 99.99, "Mega"),
            (2015, 383, 109.99, "Mega+"), (4003, 827, 199.99, "Ultra"), (5035, 1007, 249.99, "Max"),
        ],
    ),
    "free_fire": (
        "Free Fire / Free Fire MAX", "Garena", "Diamonds", 15, 25,
        ["https://www.codashop.com/"],
        [
            (70, 0, 0.99, "Micro"), (140, 0, 1.99, "Small"), (355, 0, 4.99, "Medium"),
            (720, 0, 9.99, "Large"), (1450, 0, 19.99, "XLarge"), (2195, 0, 29.99, "XXLarge"),
            (3670, 0, 49.99, "Mega"), (7560, 0, 99.99, "Ultra"),
        ],
    ),
    "pubg_mobile": (
        "PUBG Mobile", "Tencent / Krafton", "Unknown Cash (UC)", 10, 20,
        ["https://buffbuff.com/"],
        [
            (60, 0, 0.99, "Micro"), (120, 0, 1.99, "Small"), (325, 0, 4.99, "Medium"),
            (660, 0, 9.99, "Large"), (1800, 0, 24.99, "XLarge"), (3850, 0, 49.99, "Mega"),
            (8100, 0, 99.99, "Ultra"),
        ],
    ),
    "genshin_impact": (
        "Genshin Impact", "miHoYo / HoYoverse", "Genesis Crystals", 5, 15,
        ["https://www.topuplive.com/"],
        [
            (60, 0, 0.99, "Micro"), (300, 0, 4.99, "Small"), (980, 0, 14.99, "Medium"),
            (1980, 0, 29.99, "Large"), (3280, 0, 49.99, "XLarge"), (6480, 0, 99.99, "Ultra"),
        ],
    ),
    "honkai_star_rail": (
        "Honkai: Star Rail", "miHoYo / HoYoverse", "Oneiric Shards", 5, 15,
        ["https://www.topuplive.com/"],
        [
            (60, 0, 0.99, "Micro"), (300, 0, 4.99, "Small"), (980, 0, 14.99, "Medium"),
            (1980, 0, 29.99, "Large"), (3280, 0, 49.99, "XLarge"), (6480, 0, 99.99, "Ultra"),
        ],
    ),
    "cod_mobile": (
        "Call of Duty: Mobile", "TiMi Studios / Activision", "COD Points (CP)", 10, 18,
        ["https://www.codashop.com/"],
        [
            (200, 0, 1.99, "Small"), (400, 0, 3.99, "Medium"), (1100, 0, 9.99, "Large"),
            (2400, 0, 19.99, "XLarge"), (5000, 0, 39.99, "Mega"), (13000, 0, 99.99, "Ultra"),
        ],
    ),
}

# -- embedded snapshot: usage statistics --------------------------------------------

STATS = {
    "mlbb": {
        "game": "Mobile Legends: Bang Bang", "genre": "MOBA", "publisher": "Moonton (ByteDance)",
        "release_year": 2016, "platforms": ["Android", "iOS"],
        "sources": [
            "https://www.quantumrun.com/consulting/mobile-legends-bang-bang/",
            "https://rec0ded88.com/statistics/mobile-legends-bang-bang/",
            "https://icon-era.com/blog/mobile-legends-bang-bang-live-player-count-and-statistics.443/",
        ],
        "mau_millions": 110.0, "dau_millions": 18.0, "registered_users_millions": 721.6,
        "total_downloads_billions": 1.0,
        "revenue_by_year": {"2021": 222240000, "2022": 201000000, "2023": 180410000, "2024": 194990000},
        "lifetime_revenue_usd": 1800000000, "arpdau_usd": 0.018, "session_minutes": 30,
        "competition_score": 85, "android_share_pct": 81,
        "top_countries": ["Philippines", "Indonesia", "Malaysia"],
        "age_distribution": {"13-17": 20, "18-24": 45, "25-34": 25, "35+": 10}, "age_median": 22,
    },
    "free_fire": {
        "game": "Free Fire / Free Fire MAX", "genre": "Battle Royale", "publisher": "Garena",
        "release_year": 2017, "platforms": ["Android", "iOS"],
        "sources": [
            "https://www.businessofapps.com/data/free-fire-statistics/",
            "https://rec0ded88.com/statistics/free-fire/",
            "https://www.blog.udonis.co/mobile-marketing/mobile-games/free-fire-player-count",
        ],
        "mau_millions": 130.0, "dau_millions": 33.0, "registered_users_millions": None,
        "total_downloads_billions": 1.3,
        "revenue_by_year": {"2023": 400000000, "2024": 408000000},
        "lifetime_revenue_usd": 4000000000, "arpdau_usd": 0.030, "session_minutes": 31,
        "competition_score": 60, "android_share_pct": 78,
        "top_countries": ["Brazil", "Indonesia", "India"],
        "age_distribution": {"13-17": 35, "18-24": 40, "25-34": 18, "35+": 7}, "age_median": 20,
    },
    "pubg_mobile": {
        "game": "PUBG Mobile", "genre": "Battle Royale", "publisher": "Tencent / Krafton",
        "release_year": 2018, "platforms": ["Android", "iOS"],
        "sources": [
            "https://sqmagazine.co.uk/mobile-games-statistics/",
            "https://techrt.com/mobile-game-spending-statistics/",
        ],
        "mau_millions": 100.0, "dau_millions": 15.0, "registered_users_millions": None,
        "total_downloads_billions": 1.0,
        "revenue_by_year": {"2024": 2000000000},
        "lifetime_revenue_usd": 8000000000, "arpdau_usd": 0.065, "session_minutes": 28,
        "competition_score": 80, "android_share_pct": 72,
        "top_countries": ["China", "USA", "Middle East"],
        "age_distribution": {"13-17": 10, "18-24": 30, "25-34": 42, "35+": 18}, "age_median": 27,
    },
    "genshin_impact": {
        "game": "Genshin Impact", "genre": "RPG / Gacha / Open World", "publisher": "miHoYo / HoYoverse",
        "release_year": 2020, "platforms": ["Android", "iOS", "PC", "PS4/5"],
        "sources": [
            "https://news.bittopup.com/news/genshin-impact-2025-15.2m-players-0.8b-revenue",
            "https://www.statista.com/statistics/1295196/genshin-impact-arpu-country/",
        ],
        "mau_millions": 15.2, "dau_millions": 3.8, "registered_users_millions": None,
        "total_downloads_billions": 0.218,
        "revenue_by_year": {"2023": 1560000000, "2024": 700000000},
        "lifetime_revenue_usd": 5000000000, "arpdau_usd": 0.126, "session_minutes": 45,
        "competition_score": 25, "android_share_pct": 55,
        "top_countries": ["China", "USA", "Japan"],
        "age_distribution": {"13-17": 5, "18-24": 22, "25-34": 38, "35+": 35}, "age_median": 35,
    },
    "honkai_star_rail": {
        "game": "Honkai: Star Rail", "genre": "Turn-based RPG / Gacha", "publisher": "miHoYo / HoYoverse",
        "release_year": 2023, "platforms": ["Android", "iOS", "PC"],
        "sources": ["https://techrt.com/mobile-game-spending-statistics/"],
        "mau_millions": 20.0, "dau_millions": 3.0, "registered_users_millions": None,
        "total_downloads_billions": 0.15,
        "revenue_by_year": {"2024": 900000000},
        "lifetime_revenue_usd": 1500000000, "arpdau_usd": 0.123, "session_minutes": 40,
        "competition_score": 30, "android_share_pct": 58,
        "top_countries": ["China", "Japan", "USA"],
        "age_distribution": {"13-17": 5, "18-24": 35, "25-34": 45, "35+": 15}, "age_median": 28,
    },
    "cod_mobile": {
        "game": "Call of Duty: Mobile", "genre": "Shooter / Battle Royale",
        "publisher": "TiMi Studios / Activision",
        "release_year": 2019, "platforms": ["Android", "iOS"],
        "sources": ["https://techrt.com/mobile-game-spending-statistics/"],
        "mau_millions": 50.0, "dau_millions": 7.5, "registered_users_millions": None,
        "total_downloads_billions": 0.5,
        "revenue_by_year": {"2024": 360000000},
        "lifetime_revenue_usd": 1800000000, "arpdau_usd": 0.020, "session_minutes": 35,
        "competition_score": 55, "android_share_pct": 70,
        "top_countries": ["USA", "Brazil", "India"],
        "age_distribution": {"13-17": 15, "18-24": 40, "25-34": 35, "35+": 10}, "age_median": 25,
    },
}

# -- embedded snapshot: esports ------------------------------------------------------

# game: tier, score, prize pool 2025 (USD), tournaments, peak viewers, regional leagues, sources
ESPORTS = {
    "mlbb": ("Elite", 85, 3000000, 150, 5680000, 6, [
        "https://liquipedia.net/mobilelegends/Portal:Statistics",
        "https://en.wikipedia.org/wiki/MSC_2025",
    ]),
    "free_fire": ("High", 60, 4884061, 1331, 751237, 8, [
        "https://liquipedia.net/freefire/Portal:Statistics",
        "https://escharts.com/games/free-fire",
    ]),
    "pubg_mobile": ("Elite", 80, 2000000, 80, 1380000, 5, []),
    "genshin_impact": ("Low", 25, 0, 5, 50000, 0, []),
    "honkai_star_rail": ("Low", 30, 100000, 10, 80000, 0, []),
    "cod_mobile": ("Medium", 55, 500000, 40, 300000, 3, []),
}

# -- embedded snapshot: market context -----------------------------------------------

MARKET_GLOBAL = {
    "mobile_gaming_revenue_2024_usd": 92000000000,
    "mobile_gaming_revenue_2025_usd": 103000000000,
    "arpu_global_2024_usd": 36.0,
    "arpu_global_2025_usd": 38.8,
    "downloads_2024_billions": 49,
    "sources": [
        "https://sqmagazine.co.uk/mobile-games-statistics/",
        "https://www.accio.com/business/most-profitable-mobile-games-2025-trend",
        "https://techrt.com/mobile-game-spending-statistics/",
    ],
}

# segment: monthly threshold (USD), player share min/max (percent), revenue share min/max (percent)
MARKET_SEGMENTS = {
    "whale": (100, 2, 5, 55, 65),
    "dolphin": (10, 10, 20, 25, 35),
    "minnow": (0, 75, 88, 10, 15),
}

# region: price index, countries
MARKET_REGIONS = {
    "SEA": (0.70, ["ID", "PH", "MY", "TH", "SG"]),
    "LATAM": (0.75, ["BR", "MX", "AR", "CO"]),
    "Global_West": (1.00, ["US", "EU", "AU"]),
    "East_Asia": (1.20, ["CN", "JP", "KR"]),
    "MENA": (0.85, ["SA", "AE", "TR"]),
}

# -- source registry ------------------------------------------------------------------

SOURCE_REGISTRY = {
    "top_up_platforms": {
        "gamsgo_mlbb": "https://www.gamsgo.com/top-up/mobile-legends",
        "seagm_mlbb": "https://www.seagm.com/en-us/mobile-legends-diamonds-top-up",
        "gamebar_mlbb": "https://www.gamebar.gg/top-up/mobile-legends",
        "ldshop_mlbb": "https://www.ldshop.gg/top-up/mobile-legends-bang-bang.html",
        "codashop": "https://www.codashop.com/id-en/mobile-legends/",
        "buffbuff": "https://buffbuff.com/",
        "topuplive": "https://www.topuplive.com/article/best-discounts-and-offers-for-mobile-legends-diamonds-december-2026.html",
    },
    "analytics": {
        "business_of_apps_ff": "https://www.businessofapps.com/data/free-fire-statistics/",
        "quantumrun_mlbb": "https://www.quantumrun.com/consulting/mobile-legends-bang-bang/",
        "rec0ded_mlbb": "https://rec0ded88.com/statistics/mobile-legends-bang-bang/",
        "rec0ded_ff": "https://rec0ded88.com/statistics/free-fire/",
        "coopboard_mlbb": "https://coopboardgames.com/online-gaming/mobile-legends-bang-bang/",
        "bittopup_genshin": "https://news.bittopup.com/news/genshin-impact-2025-15.2m-players-0.8b-revenue",
        "iconera_mlbb": "https://icon-era.com/blog/mobile-legends-bang-bang-live-player-count-and-statistics.443/",
        "udonis_ff": "https://www.blog.udonis.co/mobile-marketing/mobile-games/free-fire-player-count",
        "sqmagazine": "https://sqmagazine.co.uk/mobile-games-statistics/",
        "techrt": "https://techrt.com/mobile-game-spending-statistics/",
        "accio": "https://www.accio.com/business/most-profitable-mobile-games-2025-trend",
        "market_us": "https://scoop.market.us/gaming-monetization-statistics/",
        "quantumrun_mobile": "https://www.quantumrun.com/consulting/mobile-game-statistics/",
    },
    "esports": {
        "liquipedia_mlbb": "https://liquipedia.net/mobilelegends/Portal:Statistics",
        "liquipedia_ff": "https://liquipedia.net/freefire/Portal:Statistics",
        "escharts_ff": "https://escharts.com/games/free-fire",
        "wiki_msc2025": "https://en.wikipedia.org/wiki/MSC_2025",
        "iconera_stats": "https://icon-era.com/statistics/video-game-statistics/",
    },
}
