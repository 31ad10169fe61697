"""Price formulas, bins, scores and lookups over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions import bins
from ..functions.numbers import (
    capped_score,
    cents,
    convert_currency,
    log_scale,
    or_default,
    round_half_up,
    safe_ratio,
)
from ..functions.pricing import bubble_size, optimal_price, price_band, tier_prices
from ..ml.scoring import tier_estimates
from ..operators.joins import enrich_if_absent, keep_in
from ..operators.reshape import with_grid
from .registry import (
    query,
    sql_at_least,
    sql_below,
    sql_cents,
    sql_lookup,
    sql_round,
    sql_trunc,
    sql_values,
    table,
)

# Markets of the order tables: region with price index, customer segment with spend multiplier.
MARKETS = [("AFRICA", 0.85), ("AMERICA", 1.0), ("ASIA", 0.7), ("EUROPE", 1.2), ("MIDDLE EAST", 0.75)]
SEGMENTS = [("AUTOMOBILE", 2.8), ("BUILDING", 1.4), ("FURNITURE", 0.75), ("HOUSEHOLD", 1.0), ("MACHINERY", 1.2)]

RATE = fv.IDR_PER_USD

_PRICE_GRID_SQL = f"""
WITH per_group AS (
  SELECT p_brand, p_type, count(DISTINCT p_partkey) AS parts, sum(lines) AS lines, sum(units) AS units,
         sum(revenue_cents) AS revenue_cents, sum(p_size) AS sizes
  FROM part JOIN (
    SELECT l_partkey, count(*) AS lines, sum(CAST(l_quantity AS BIGINT)) AS units,
           sum({sql_cents('l_extendedprice')}) AS revenue_cents
    FROM lineitem GROUP BY l_partkey) AS sold ON l_partkey = p_partkey
  GROUP BY p_brand, p_type),
entity AS (
  SELECT p_brand, p_type,
         CAST(revenue_cents AS DOUBLE) / 100e0 / CAST(units AS DOUBLE) / 1e5 AS arpdau,
         CAST(units AS DOUBLE) / CAST(parts AS DOUBLE) / 8e0 AS mau,
         CAST(sizes AS DOUBLE) / CAST(parts AS DOUBLE) AS age
  FROM per_group),
priced AS (
  SELECT p_brand, p_type, region, segment, {sql_round(
      "greatest(arpdau * 50e0, 0.5e0) * (1e0 - (age * 2e0) / 200e0) * multiplier"
      " * (CASE WHEN age > 30 THEN 1.25e0 WHEN age < 20 THEN 0.8e0 ELSE 1e0 END)"
      " * (CASE WHEN mau > 100 THEN 0.88e0 WHEN mau < 20 THEN 1.12e0 ELSE 1e0 END) * price_index", 4)} AS price_usd
  FROM entity
  CROSS JOIN {sql_values(MARKETS, 'm', ['region', 'price_index'])}
  CROSS JOIN {sql_values(SEGMENTS, 's', ['segment', 'multiplier'])})
SELECT *, {sql_trunc(f'price_usd * {RATE}e0')} AS price_idr FROM priced
"""


@query(_PRICE_GRID_SQL)
def q_price_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Recommended price for every product line, region and segment (the flagship)."""
    sold = (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(F.col("l_quantity").cast("long")).alias("units"),
            F.sum(cents("l_extendedprice")).alias("revenue_cents"),
        )
    )
    entities = (
        table(spark, sf, "part")
        .join(sold, F.col("p_partkey") == F.col("l_partkey"))
        .groupBy("p_brand", "p_type")
        .agg(
            F.count(F.lit(1)).cast("double").alias("parts"),
            F.sum("units").cast("double").alias("units"),
            F.sum("revenue_cents").cast("double").alias("revenue_cents"),
            F.sum("p_size").cast("double").alias("sizes"),
        )
        .select(
            "p_brand",
            "p_type",
            (F.col("revenue_cents") / 100.0 / F.col("units") / 1e5).alias("arpdau"),
            (F.col("units") / F.col("parts") / 8.0).alias("mau"),
            (F.col("sizes") / F.col("parts")).alias("age"),
        )
    )
    grid = with_grid(entities, MARKETS, ["region", "price_index"])
    grid = with_grid(grid, SEGMENTS, ["segment", "multiplier"])
    price = optimal_price("arpdau", F.col("age") * 2.0, "age", "mau", "multiplier", "price_index")
    grid = grid.withColumn("price_usd", price)
    return grid.select(
        "p_brand", "p_type", "region", "segment", "price_usd", convert_currency("price_usd", RATE).alias("price_idr")
    )


@query(f"""
SELECT spend_tier, {sql_lookup('spend_tier', fv.TIER_ELASTICITY, None)} AS elasticity, lines, amount_cents
FROM (SELECT {sql_below('l_extendedprice / 1e3', fv.SPEND_TIERS, fv.SPEND_TIER_ABOVE)} AS spend_tier,
             count(*) AS lines, CAST(sum({sql_cents('l_extendedprice')}) AS BIGINT) AS amount_cents
      FROM lineitem GROUP BY 1)
""")
def q_spend_tier(spark: SparkSession, sf: str) -> DataFrame:
    tier = bins.spend_tier(F.col("l_extendedprice") / 1e3).alias("spend_tier")
    per_tier = table(spark, sf, "lineitem").groupBy(tier).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(cents("l_extendedprice")).alias("amount_cents")
    )
    return per_tier.select("spend_tier", bins.elasticity("spend_tier").alias("elasticity"), "lines", "amount_cents")


CUSTOMER_REVENUE_TIERS = [(4_000_000, "blockbuster"), (2_500_000, "major"), (1_000_000, "mid")]


@query(f"""
SELECT {sql_at_least('spent_cents / 100e0', CUSTOMER_REVENUE_TIERS, 'small')} AS revenue_tier,
       count(*) AS customers, CAST(sum(spent_cents) AS BIGINT) AS spent_cents
FROM (SELECT o_custkey, CAST(sum({sql_cents('o_totalprice')}) AS BIGINT) AS spent_cents FROM orders GROUP BY 1)
GROUP BY 1
""")
def q_revenue_tier(spark: SparkSession, sf: str) -> DataFrame:
    spent = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("spent"))
    tier = bins.revenue_tier(F.col("spent") / 100.0, CUSTOMER_REVENUE_TIERS).alias("revenue_tier")
    return spent.groupBy(tier).agg(F.count(F.lit(1)).alias("customers"), F.sum("spent").alias("spent_cents"))


@query(f"""
SELECT {sql_at_least('p_size * 2', fv.COMPETITION_TIERS, fv.COMPETITION_TIER_BELOW)} AS competition_tier,
       count(*) AS parts, min(p_size) AS smallest, max(p_size) AS largest
FROM part GROUP BY 1
""")
def q_competition_tier(spark: SparkSession, sf: str) -> DataFrame:
    tier = bins.competition_tier(F.col("p_size") * 2).alias("competition_tier")
    return table(spark, sf, "part").groupBy(tier).agg(
        F.count(F.lit(1)).alias("parts"), F.min("p_size").alias("smallest"), F.max("p_size").alias("largest")
    )


_SENSITIVITY = sql_below('p_size', fv.AGE_SENSITIVITY, fv.AGE_SENSITIVITY_ABOVE)


@query(f"""
SELECT p_brand, sensitivity, {sql_lookup('sensitivity', fv.AGE_SENSITIVITY_SCORE, None)} AS sensitivity_score, parts
FROM (SELECT p_brand, {_SENSITIVITY} AS sensitivity, count(*) AS parts FROM part GROUP BY 1, 2)
""")
def q_age_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    label = bins.age_sensitivity("p_size").alias("sensitivity")
    counts = table(spark, sf, "part").groupBy("p_brand", label).agg(F.count(F.lit(1)).alias("parts"))
    score = bins.lookup("sensitivity", fv.AGE_SENSITIVITY_SCORE).alias("sensitivity_score")
    return counts.select("p_brand", "sensitivity", score, "parts")


@query(f"""
SELECT {sql_below('l_extendedprice / 5e3', fv.PRICE_STRATEGY, fv.PRICE_STRATEGY_ABOVE)} AS strategy,
       count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
FROM lineitem GROUP BY 1
""")
def q_price_strategy(spark: SparkSession, sf: str) -> DataFrame:
    strategy = bins.price_strategy(F.col("l_extendedprice") / 5e3).alias("strategy")
    return table(spark, sf, "lineitem").groupBy(strategy).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("units")
    )


_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_RESELLER = sql_round("l_extendedprice * (1e0 - (l_discount * 100e0) / 100e0)", 3)
_LINE_PRICES_SQL = f"""
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    {sql_round('l_extendedprice', 2)} AS price_official_usd,
    {sql_trunc(f'l_extendedprice * {RATE}e0')} AS price_official_idr,
    {_RESELLER} AS price_3rdparty_usd,
    {sql_trunc(f'({_RESELLER}) * {RATE}e0')} AS price_3rdparty_idr,
    {sql_round('l_extendedprice / l_quantity', 6)} AS price_per_unit_usd,
    {sql_round('(l_extendedprice / l_quantity) * 100e0', 4)} AS price_per_100_usd,
    {sql_trunc(f'(l_extendedprice / l_quantity) * 100e0 * {RATE}e0')} AS price_per_100_idr,
    {sql_round('l_quantity / l_extendedprice', 2)} AS value_score,
    {sql_below('l_extendedprice / 1e3', fv.SPEND_TIERS, fv.SPEND_TIER_ABOVE)} AS spend_tier,
    l_discount
  FROM lineitem"""


def _line_prices(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    derived = tier_prices("l_extendedprice", "l_quantity", F.col("l_discount") * 100.0, RATE)
    tier = bins.spend_tier(F.col("l_extendedprice") / 1e3).alias("spend_tier")
    return lines.select(*_LINE_KEYS, *[c.alias(n) for n, c in derived.items()], tier, "l_discount")


@query(_LINE_PRICES_SQL)
def q_price_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _line_prices(spark, sf)


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, spend_tier, price_official_idr, price_3rdparty_idr,
       l_discount, value_score, {sql_lookup('spend_tier', fv.TIER_ELASTICITY, None)} AS elasticity
FROM ({_LINE_PRICES_SQL}) WHERE spend_tier IN ('small', 'large', 'mega')
""")
def q_price_table(spark: SparkSession, sf: str) -> DataFrame:
    """Price list of chosen tiers in the chosen currency."""
    from ..plans.views import price_columns

    prices = keep_in(_line_prices(spark, sf), "spend_tier", ["small", "large", "mega"])
    return prices.select(
        *_LINE_KEYS, "spend_tier", *price_columns(in_idr=True), "l_discount", "value_score",
        bins.elasticity("spend_tier").alias("elasticity"),
    )


@query(f"""
SELECT o_orderkey, {sql_trunc(f'o_totalprice * {RATE}e0')} AS total_idr,
       {sql_trunc('o_totalprice * 0.82e0')} AS total_other
FROM orders
""")
def q_currency_convert(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        convert_currency("o_totalprice", RATE).alias("total_idr"),
        convert_currency("o_totalprice", 0.82).alias("total_other"),
    )


_BASE_PRICE = "greatest((p_retailprice - 950e0) / 40e0, 0.001e0)"


@query(f"""
SELECT p_partkey, {sql_round(_BASE_PRICE, 3)} AS predicted_price_per_100_usd,
  {sql_trunc(f'{_BASE_PRICE} * {RATE}e0')} AS predicted_price_per_100_idr,
  {sql_round(f'{_BASE_PRICE} * 0.82e0', 3)} AS range_low_usd,
  {sql_round(f'{_BASE_PRICE} * 1.22e0', 3)} AS range_high_usd,
  {sql_trunc(f'{_BASE_PRICE} * 0.82e0 * {RATE}e0')} AS range_low_idr,
  {sql_trunc(f'{_BASE_PRICE} * 1.22e0 * {RATE}e0')} AS range_high_idr
FROM part
""")
def q_price_band(spark: SparkSession, sf: str) -> DataFrame:
    band = price_band((F.col("p_retailprice") - 950.0) / 40.0, RATE, floor=fv.PRICE_FLOOR)
    return table(spark, sf, "part").select("p_partkey", *[c.alias(n) for n, c in band.items()])


@query(f"""
SELECT p_partkey, tier, {sql_round('p_retailprice / 1e3 * tier_multiplier * 100e0', 2)} AS tier_price_usd,
       {sql_trunc(f'p_retailprice / 1e3 * tier_multiplier * 100e0 * {RATE}e0')} AS tier_price_idr
FROM part CROSS JOIN {sql_values(fv.TIER_PRICE_MULTIPLIERS, 't', ['tier', 'tier_multiplier'])}
""")
def q_tier_estimates(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") / 1e3).alias("price"))
    estimates = tier_estimates(parts, "price", RATE)
    return estimates.select("p_partkey", "tier", "tier_price_usd", "tier_price_idr")


@query(f"""
SELECT day, users, buyers,
  coalesce({sql_round('CAST(buyers AS DOUBLE) / nullif(users, 0)', 3)}, 0e0) AS buyer_ratio,
  coalesce({sql_round('spent_cents / 100e0 / CASE WHEN buyers > 6 THEN CAST(buyers AS DOUBLE) END', 2)}, 0e0) AS spend_per_buyer
FROM (SELECT day, count(*) AS users, count(*) FILTER (WHERE bought) AS buyers,
             CAST(sum(spent_cents) AS DOUBLE) AS spent_cents
      FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, bool_or(event_type = 'purchase') AS bought,
                   sum(CASE WHEN event_type = 'purchase' THEN {sql_cents('value')} ELSE 0 END) AS spent_cents
            FROM events GROUP BY 1, 2)
      GROUP BY 1)
""")
def q_safe_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Daily active users, buyers among them, and guarded ratios.

    Users are made distinct by grouping on (day, user) first, which spreads one busy user or day.
    """
    is_purchase = F.col("event_type") == "purchase"
    per_user = (
        table(spark, sf, "events")
        .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id")
        .agg(
            F.max(is_purchase).alias("bought"),
            F.sum(F.when(is_purchase, cents("value")).otherwise(0)).alias("spent_cents"),
        )
    )
    per_day = per_user.groupBy("day").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if("bought").alias("buyers"),
        F.sum("spent_cents").cast("double").alias("spent_cents"),
    )
    enough = F.when(F.col("buyers") > 6, F.col("buyers")).otherwise(0)
    return per_day.select(
        "day",
        "users",
        "buyers",
        safe_ratio("buyers", "users", 3).alias("buyer_ratio"),
        safe_ratio(F.col("spent_cents") / 100.0, enough, 2).alias("spend_per_buyer"),
    )


_HEALTH = "least(n / 130e0, 1e0) * 40e0 + least(ratio / 0.35e0, 1e0) * 30e0 + least(k / 5e3, 1e0) * 30e0"


@query(f"""
SELECT user_id, n AS events, ratio AS buyer_ratio, {sql_round(_HEALTH, 1)} AS health_score
FROM (SELECT user_id, n, k, {sql_round('CAST(buys AS DOUBLE) / n', 3)} AS ratio
      FROM (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS buys,
                   CAST(sum(CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS k
            FROM events GROUP BY user_id))
""")
def q_health_score(spark: SparkSession, sf: str) -> DataFrame:
    k = F.regexp_extract("props", r'"k": ([0-9]+)', 1).cast("long")
    users = table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("buys"),
        F.sum(k).alias("k"),
    )
    users = users.withColumn("buyer_ratio", safe_ratio("buys", "events", 3))
    score = capped_score([("events", 130, 40), ("buyer_ratio", 0.35, 30), ("k", 5e3, 30)])
    return users.select("user_id", "events", "buyer_ratio", score.alias("health_score"))


@query(f"""
SELECT o_custkey, {sql_round('ln(1e0 + spent_cents / 100e0)', 4)} AS spent_log, {sql_round('ln(1e0 + orders)', 4)} AS orders_log
FROM (SELECT o_custkey, sum({sql_cents('o_totalprice')}) AS spent_cents, count(*) AS orders FROM orders GROUP BY 1)
""")
def q_log_scale(spark: SparkSession, sf: str) -> DataFrame:
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(cents("o_totalprice")).alias("spent_cents"), F.count(F.lit(1)).alias("orders")
    )
    return per_customer.select(
        "o_custkey",
        log_scale(F.col("spent_cents") / 100.0).alias("spent_log"),
        log_scale("orders").alias("orders_log"),
    )


@query("""
SELECT event_id, coalesce(nullif(k, 0e0), value * 0.15e0) AS dau, coalesce(nullif(k, 0e0), 0e0) AS mau
FROM (SELECT event_id, value, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS k FROM events)
""")
def q_default_fill(spark: SparkSession, sf: str) -> DataFrame:
    k = F.regexp_extract("props", r'"k": ([0-9]+)', 1).cast("double")
    events = table(spark, sf, "events").select("event_id", "value", k.alias("k"))
    share = F.col("value") * F.lit(fv.DAU_SHARE_IN_TABLES)
    return events.select("event_id", or_default("k", share).alias("dau"), or_default("k", 0.0).alias("mau"))


SHORT_NAMES = {f"Brand#{i}": f"B{i}" for i in range(1, 21)}  # some brands have none


@query(f"""
WITH sold AS (SELECT p_brand, CAST(sum({sql_cents('l_extendedprice')}) AS DOUBLE) AS revenue_cents
              FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
scores AS (SELECT p_brand, {sql_round('avg(p_size * 2)', 4)} AS competition_score FROM part GROUP BY 1)
SELECT p_brand, CASE WHEN p_brand IN ({', '.join(f"'{b}'" for b in SHORT_NAMES)}) THEN 'B' || substr(p_brand, 7) END AS short_name,
       competition_score, revenue_cents / 100e0 / 5e7 AS bubble_size
FROM sold LEFT JOIN scores USING (p_brand)
""")
def q_bubble(spark: SparkSession, sf: str) -> DataFrame:
    """Competition against revenue per brand; the score is joined only because revenue lacks it."""
    parts = table(spark, sf, "part")
    sold = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(cents("l_extendedprice")).alias("revenue_cents")
    )
    revenue = parts.join(sold, "p_partkey").groupBy("p_brand").agg(F.sum("revenue_cents").alias("revenue_cents"))
    scores = parts.groupBy("p_brand").agg(
        round_half_up(F.avg(F.col("p_size") * 2), 4).alias("competition_score")
    )
    brands = enrich_if_absent(revenue, scores, "p_brand", "competition_score")
    return brands.select(
        "p_brand",
        bins.lookup("p_brand", SHORT_NAMES).alias("short_name"),
        "competition_score",
        bubble_size(F.col("revenue_cents").cast("double") / 100.0).alias("bubble_size"),
    )
