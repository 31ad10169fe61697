"""Joins, aggregates and views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import bins
from ..functions.numbers import cents, log_scale, round_half_up
from ..operators.joins import enrich, keep_in, keep_matching, orphans
from ..operators.ordering import exact_quantile, value_counts
from ..operators.reshape import explode_list
from ..operators.statistics import (
    arg_max,
    correlation_pairs,
    group_mean,
    histogram,
    pivot_mean,
    ranked,
    top_k,
)
from ..plans.views import segment_shares
from .. import fixed_values as fv
from .pricing import MARKETS
from .registry import query, sql_at_least, sql_cents, sql_round, sql_values, table


@query(f"""
SELECT n.n_nationkey, n.n_name, c.customers, s.suppliers, s.balance_cents,
       {sql_round('s.median_balance', 3)} AS median_balance
FROM nation AS n
LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) AS c ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers, CAST(sum({sql_cents('s_acctbal')}) AS BIGINT) AS balance_cents,
                  median(s_acctbal) AS median_balance
           FROM supplier GROUP BY 1) AS s ON s.s_nationkey = n.n_nationkey
""")
def q_left_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Nations with two aggregated right sides; on the shared column name the right one wins."""
    suppliers = table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    medians = exact_quantile(value_counts(suppliers, ["n_nationkey"], "s_acctbal"), ["n_nationkey"], name="median_balance")
    per_nation = suppliers.groupBy("n_nationkey").agg(
        F.count(F.lit(1)).alias("suppliers"), F.sum(cents("s_acctbal")).alias("balance_cents")
    )
    customers = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum(cents("c_acctbal")).alias("balance_cents")
    )
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    out = enrich(enrich(enrich(nations, customers, "n_nationkey"), per_nation, "n_nationkey"), medians, "n_nationkey")
    return out.select(
        "n_nationkey", "n_name", "customers", "suppliers", "balance_cents",
        round_half_up("median_balance", 3).alias("median_balance"),
    )


_SCORE = "CAST(trunc(s_acctbal / 100e0) AS BIGINT)"


@query(f"""
SELECT s_suppkey, n_name, {_SCORE} AS score,
       {sql_at_least(_SCORE, fv.COMPETITION_TIERS, fv.COMPETITION_TIER_BELOW)} AS tier,
       {sql_round('ln(1e0 + s_acctbal)', 4)} AS balance_log
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0
""")
def q_competition_detail(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0)
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    detail = enrich(suppliers, nations, "s_nationkey", "inner")
    score = (F.col("s_acctbal") / 100.0).cast("long")
    return detail.select(
        "s_suppkey",
        "n_name",
        score.alias("score"),
        bins.competition_tier(score).alias("tier"),
        log_scale("s_acctbal").alias("balance_log"),
    )


@query("""
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
""")
def q_semi_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in a short list of priorities, from a long list of customers."""
    chosen = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "MACHINERY")
    orders = keep_in(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"])
    return keep_matching(orders, "o_custkey", chosen, "c_custkey").select("o_orderkey", "o_custkey", "o_orderpriority")


@query("""
WITH f AS (SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS k FROM orders),
d AS (SELECT c_custkey AS k FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey % 5 <> 0)
SELECT count(*) FILTER (WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM d)) AS orphan_rows,
       count(*) FILTER (WHERE k IS NULL) AS null_key_rows, count(*) AS total_rows
FROM f
""")
def q_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without customer, with NULLs among the keys on both sides."""
    facts = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("k"))
    known = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    known = known.select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("k"))
    return orphans(facts, "k", known, "k")


NATIONS_BY_MARKET = {
    market: [f"NATION_{n}" for n in range(25) if n % 5 == position] for position, (market, _) in enumerate(MARKETS)
}


@query(f"""
SELECT n_name, market, price_index, customers, {sql_round('balance_cents / 100e0 * price_index', 2)} AS indexed_balance
FROM (SELECT n_name, CAST(split_part(n_name, '_', 2) AS INTEGER) % 5 AS position, count(*) AS customers,
             CAST(sum({sql_cents('c_acctbal')}) AS DOUBLE) AS balance_cents
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
JOIN {sql_values([(i, m, x) for i, (m, x) in enumerate(MARKETS)], 'm', ['position', 'market', 'price_index'])} USING (position)
""")
def q_region_price(spark: SparkSession, sf: str) -> DataFrame:
    """Balances at the price index of the market whose country list holds the nation."""
    nested = spark.createDataFrame(
        [(m, index, NATIONS_BY_MARKET[m]) for m, index in MARKETS], "market string, price_index double, n_name array<string>"
    )
    countries = explode_list(nested, "n_name", "n_name")
    per_nation = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum(cents("c_acctbal")).alias("balance_cents")
    )
    named = per_nation.join(table(spark, sf, "nation"), "n_nationkey").join(F.broadcast(countries), "n_name")
    indexed = round_half_up(F.col("balance_cents").cast("double") / 100.0 * F.col("price_index"), 2)
    return named.select("n_name", "market", "price_index", "customers", indexed.alias("indexed_balance"))


@query(f"""
SELECT CAST(o.revenue_cents AS DOUBLE) / 100e0 AS total_revenue, o.customers,
       {sql_round('o.mean_cents / 100e0', 3)} AS mean_order, {sql_round('l.mean_discount', 4)} AS mean_discount_pct
FROM (SELECT CAST(sum({sql_cents('o_totalprice')}) AS BIGINT) AS revenue_cents, count(DISTINCT o_custkey) AS customers,
             avg({sql_cents('o_totalprice')}) AS mean_cents
      FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')) AS o,
     (SELECT avg({sql_cents('l_discount')}) AS mean_discount FROM lineitem) AS l
""")
def q_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Headline numbers of a selection; the mean discount runs over order lines.

    Customers are counted by grouping on the key first, so the distinct set is never in one place.
    """
    orders = keep_in(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])
    per_customer = orders.groupBy("o_custkey").agg(
        F.sum(cents("o_totalprice")).alias("cents"), F.count(F.lit(1)).alias("orders")
    )
    totals = per_customer.agg(
        F.sum("cents").alias("cents"), F.sum("orders").alias("orders"), F.count("o_custkey").alias("customers")
    )
    discount = table(spark, sf, "lineitem").agg(F.avg(cents("l_discount")).alias("mean_discount"))
    return totals.select(
        (F.col("cents").cast("double") / 100.0).alias("total_revenue"),
        "customers",
        round_half_up(F.col("cents").cast("double") / F.col("orders") / 100.0, 3).alias("mean_order"),
        round_half_up(discount.scalar(), 4).alias("mean_discount_pct"),
    )


def _spent_per_nation(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue per nation; orders are summed per customer before they meet the customer table."""
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(cents("o_totalprice")).alias("cents")
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nation = spent.join(customers, "c_custkey").groupBy("c_nationkey").agg(F.sum("cents").alias("revenue_cents"))
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return per_nation.join(nations, "c_nationkey").select("n_name", "revenue_cents")


_SPENT_SQL = f"""
SELECT n_name, CAST(sum({sql_cents('o_totalprice')}) AS BIGINT) AS revenue_cents
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
"""


@query(_SPENT_SQL + " ORDER BY revenue_cents, n_name")
def q_ranked_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return ranked(_spent_per_nation(spark, sf), "revenue_cents", "n_name")


@query(f"""
SELECT o_custkey, CAST(sum({sql_cents('o_totalprice')}) AS BIGINT) AS spent_cents
FROM orders GROUP BY 1 ORDER BY spent_cents DESC, o_custkey LIMIT 10
""")
def q_topk(spark: SparkSession, sf: str) -> DataFrame:
    spent = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("spent_cents"))
    return top_k(spent, "spent_cents", "o_custkey", 10)


@query("""
SELECT l_linenumber, count(*) // 100 AS hundreds FROM lineitem GROUP BY 1 ORDER BY hundreds DESC, l_linenumber LIMIT 1
""")
def q_argmax(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent line number, counted in hundreds so that ties occur."""
    counts = table(spark, sf, "lineitem").groupBy("l_linenumber").agg(
        F.floor(F.count(F.lit(1)) / 100).alias("hundreds")
    )
    return arg_max(counts, "hundreds", "l_linenumber")


@query(f"""
SELECT l_suppkey, {sql_round('avg(CAST(floor(l_discount * 100e0 + 0.5e0) AS BIGINT))', 4)} AS mean_discount_pct
FROM lineitem GROUP BY 1
""")
def q_group_mean(spark: SparkSession, sf: str) -> DataFrame:
    means = group_mean(table(spark, sf, "lineitem"), "l_suppkey", cents("l_discount"), "mean_discount_pct")
    return means.withColumn("mean_discount_pct", round_half_up("mean_discount_pct", 4))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
REGION_NAMES = [m for m, _ in MARKETS]


@query(f"""
SELECT c_mktsegment, {', '.join(
    sql_round(f"avg({sql_cents('c_acctbal')}) FILTER (WHERE r_name = '{r}')", 2) + f' AS "{r}"' for r in REGION_NAMES)}
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def q_pivot_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Mean balance, segment by region."""
    regions = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    customers = table(spark, sf, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    means = pivot_mean(customers, "c_mktsegment", "r_name", REGION_NAMES, cents("c_acctbal"))
    return means.select("c_mktsegment", *[round_half_up(F.col(f"`{r}`"), 2).alias(r) for r in REGION_NAMES])


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(f"""
SELECT day, {', '.join(
    f"coalesce(" + sql_round(f"avg({sql_cents('value')}) FILTER (WHERE event_type = '{e}')", 2) + f", 0e0) AS {e}" for e in EVENT_TYPES)}
FROM (SELECT strftime(ts, '%Y-%m-%d %H') AS day, event_type, value FROM events) GROUP BY 1
""")
def q_pivot_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Mean value per hour and event type, 0 where there was none."""
    events = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd HH"))
    means = pivot_mean(events, "day", "event_type", EVENT_TYPES, cents("value"), fill=0.0)
    return means.select("day", *[round_half_up(e, 2).alias(e) for e in EVENT_TYPES])


_CORRELATED = {
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "discount": "l_discount",
    "tax": "nullif(l_tax, 0e0)",
    "net": "l_extendedprice * (1e0 - l_discount)",
    "flat": "l_tax * 0e0",
}
_PAIRS = [(a, b) for i, a in enumerate(_CORRELATED) for b in list(_CORRELATED)[:i]]


def _pair_sql(a: str, b: str) -> str:
    guard = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    spread = f"nullif(stddev_pop({a}) {guard} * stddev_pop({b}) {guard}, 0)"
    return f"SELECT '{a}' AS a, '{b}' AS b, {sql_round(f'covar_pop({a}, {b}) {guard} / {spread}', 4)} AS r FROM c"


@query(
    f"WITH c AS (SELECT {', '.join(f'{x} AS {n}' for n, x in _CORRELATED.items())} FROM lineitem) "
    + " UNION ALL ".join(_pair_sql(a, b) for a, b in _PAIRS)
)
def q_corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Pairwise correlation of six measures, one of them with gaps and one constant."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        (F.col("l_extendedprice") * (1.0 - F.col("l_discount"))).alias("net"),
        (F.col("l_tax") * 0.0).alias("flat"),
    )
    pairs = correlation_pairs(lines, list(_CORRELATED))
    return pairs.withColumn("r", round_half_up("r", 4))


@query(f"""
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
n AS (SELECT least(CAST(floor((o_totalprice - lo) * 20e0 / (hi - lo)) AS BIGINT) + 1, 20) AS bin, count(*) AS c FROM orders, b GROUP BY 1)
SELECT CAST(range AS INTEGER) AS bin, {sql_round('lo + (range - 1) * ((hi - lo) / 20e0)', 4)} AS bin_from,
       {sql_round('lo + range * ((hi - lo) / 20e0)', 4)} AS bin_to, coalesce(c, 0) AS "rows"
FROM range(1, 21) CROSS JOIN b LEFT JOIN n ON n.bin = range
""")
def q_histogram(spark: SparkSession, sf: str) -> DataFrame:
    counts = histogram(table(spark, sf, "orders"), "o_totalprice", 20)
    return counts.withColumns({c: round_half_up(c, 4) for c in ("bin_from", "bin_to")})


_MONTHLY_SPEND = "CAST(sum(" + sql_cents("value") + ") AS DOUBLE) / 3e3"


@query(f"""
WITH spend AS (SELECT user_id, strftime(ts, '%Y-%m') AS month, {_MONTHLY_SPEND} AS spent FROM events
               WHERE event_type = 'purchase' GROUP BY 1, 2),
s AS (SELECT {sql_at_least('spent', fv.SPEND_SEGMENTS, fv.SPEND_SEGMENT_BELOW)} AS segment, count(*) AS player_months,
             CAST(sum(CAST(floor(spent * 1e3 + 0.5e0) AS BIGINT)) AS BIGINT) AS milli FROM spend GROUP BY 1)
SELECT segment, player_months, {sql_round('100e0 * player_months / (SELECT sum(player_months) FROM s)', 2)} AS player_pct,
       {sql_round('100e0 * milli / (SELECT sum(milli) FROM s)', 2)} AS revenue_pct
FROM s
""")
def q_segment_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly spend per user, in segments, as shares of users and of revenue."""
    purchases = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    spend = purchases.groupBy("user_id", F.date_format("ts", "yyyy-MM").alias("month")).agg(
        (F.sum(cents("value")).cast("double") / 3e3).alias("spent")
    )
    return segment_shares(spend, "spent")
