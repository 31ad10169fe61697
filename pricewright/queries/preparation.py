"""Reshaping, cleaning, quality and encoding over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions import bins
from ..functions.numbers import cents, round_half_up, truncate
from ..operators import quality
from ..operators.cleaning import (
    drop_unusable,
    duplicate_report,
    fill_null_median,
    keep_first,
    keep_positive,
    null_profile,
)
from ..operators.encode import encode_first_seen, encode_fixed, extended_codes, first_seen_codes
from ..operators.reshape import explode_list, explode_map, field_by_key, join_text, unnest_series
from ..operators.statistics import group_first, share_totals
from ..sources.pages import extract_items
from ..sources.raw import configured_only, key_list
from .registry import query, sql_cents, sql_lookup, sql_round, sql_trunc, table

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LINE_SQL = ", ".join(_LINE)

CURRENCY_BY_FLAG = {"A": "uc", "N": "diamonds", "R": "crystals"}


def _tiered_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with a nested list of price tiers, prices in cents, whose amount field has a name per row."""
    field = bins.lookup("l_returnflag", CURRENCY_BY_FLAG)
    written = F.when(F.col("l_linestatus") == "O", F.lit("diamonds")).otherwise(field)

    def tier(label: str, units, price):
        entries = [F.lit("label"), F.lit(label), written, units.cast("string"), F.lit("price"), price.cast("string")]
        return F.create_map(*entries)

    quantity, price = F.col("l_quantity").cast("int"), cents("l_extendedprice")
    tiers = F.array(
        tier("single", quantity, price),
        tier("trial", quantity * 0, price),
        tier("return", quantity, price - 2_000_000),
        F.create_map(F.lit("label"), F.lit("blank"), F.lit("price"), F.lit("100")),
    )
    return table(spark, sf, "lineitem").select(*_LINE, field.alias("currency_field"), tiers.alias("tiers"))


@query(f"""
SELECT {_LINE_SQL}, tier_no, label, units, price
FROM (SELECT {_LINE_SQL}, 1 AS tier_no, 'single' AS label, CAST(l_quantity AS BIGINT) AS units, {sql_cents('l_extendedprice')} / 1e2 AS price FROM lineitem
      UNION ALL
      SELECT {_LINE_SQL}, 3, 'return', CAST(l_quantity AS BIGINT), ({sql_cents('l_extendedprice')} - 2000000) / 1e2 FROM lineitem)
WHERE price > 0 AND units > 0
""")
def q_explode_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Nested tiers to rows; the amount sits under a per-row key or the fallback key, or is absent."""
    tiers = explode_list(_tiered_lines(spark, sf), "tiers", "tier", "tier_no")
    flat = tiers.select(
        *_LINE,
        "tier_no",
        F.col("tier").getItem("label").alias("label"),
        field_by_key("tier", "currency_field", fv.DEFAULT_CURRENCY_FIELD, "0").try_cast("long").alias("units"),
        (F.col("tier").getItem("price").try_cast("long") / 100.0).alias("price"),
    )
    return keep_positive(flat, ["price", "units"])


@query("""
SELECT p_partkey, CASE WHEN p_size < 10 THEN '' ELSE array_to_string(list_reverse(string_split(p_name, ' ')), ', ') END AS words
FROM part
""")
def q_array_join(spark: SparkSession, sf: str) -> DataFrame:
    words = F.when(F.col("p_size") >= 10, F.reverse(F.split("p_name", " ")))
    return table(spark, sf, "part").select("p_partkey", join_text(words).alias("words"))


@query("""
SELECT event_type, key, count(*) AS entries, CAST(sum(n) AS BIGINT) AS total, min(n) AS smallest, max(n) AS largest
FROM (SELECT event_type, unnest(json_keys(props)) AS key, CAST(json_extract(props, '$.k') AS INTEGER) AS n FROM events)
GROUP BY 1, 2
""")
def q_explode_map(spark: SparkSession, sf: str) -> DataFrame:
    props = table(spark, sf, "events").select("event_type", F.from_json("props", "map<string,int>").alias("props"))
    entries = explode_map(props, "props", "key", "n")
    return entries.groupBy("event_type", "key").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum("n").alias("total"),
        F.min("n").alias("smallest"),
        F.max("n").alias("largest"),
    )


def _monthly_series(spark: SparkSession, sf: str) -> DataFrame:
    """(priority, series): year -> twelve monthly sums; the nested map holds one entry per calendar year."""
    months = [
        F.coalesce(F.sum(F.when(F.month("o_orderdate") == m, cents("o_totalprice"))), F.lit(0)) for m in range(1, 13)
    ]
    per_year = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year")
    ).agg(F.array(*months).alias("months"))
    return per_year.groupBy("priority").agg(
        F.map_from_entries(F.collect_list(F.struct("year", "months"))).alias("series")
    )


_SERIES_SQL = f"""
SELECT p.priority, y.year, m.month_num, coalesce(v.cents, 0) AS cents
FROM (SELECT DISTINCT o_orderpriority AS priority, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders) AS y
JOIN (SELECT DISTINCT o_orderpriority AS priority FROM orders) AS p ON p.priority = y.priority
CROSS JOIN (SELECT CAST(range AS INTEGER) AS month_num FROM range(1, 13)) AS m
LEFT JOIN (SELECT o_orderpriority, year(o_orderdate) AS yr, month(o_orderdate) AS mo,
                  CAST(sum({sql_cents('o_totalprice')}) AS BIGINT) AS cents FROM orders GROUP BY 1, 2, 3) AS v
  ON v.o_orderpriority = p.priority AND v.yr = y.year AND v.mo = m.month_num
"""


@query(_SERIES_SQL)
def q_series_unnest(spark: SparkSession, sf: str) -> DataFrame:
    return unnest_series(_monthly_series(spark, sf), "series", value="cents")


@query(f"""
SELECT priority, month_num, {sql_lookup('month_num', dict(enumerate(fv.MONTH_NAMES, start=1)), None)} AS month_name,
       cents / 1e8 AS revenue_millions
FROM ({_SERIES_SQL}) WHERE year = 1997
""")
def q_revenue_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly revenue of one year; the bounds reach the scan."""
    start, end = F.lit("1997-01-01").cast("timestamp"), F.lit("1998-01-01").cast("timestamp")
    orders = table(spark, sf, "orders").filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))
    months = [
        F.struct(
            F.lit(m).alias("month_num"),
            F.coalesce(F.sum(F.when(F.month("o_orderdate") == m, cents("o_totalprice"))), F.lit(0)).alias("cents"),
        )
        for m in range(1, 13)
    ]
    per_priority = orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.array(*months).alias("months"))
    return per_priority.select("priority", F.inline("months")).select(
        "priority",
        "month_num",
        bins.month_name("month_num").alias("month_name"),
        (F.col("cents") / 1e8).alias("revenue_millions"),
    )


@query(f"""
SELECT priority, year, month_num, cents, multiplier, {sql_round('cents / 100e0 / multiplier', 2)} AS deseasonalised
FROM (SELECT *, {sql_lookup('month_num', fv.SEASONAL_MULTIPLIER, 1.0)} AS multiplier FROM ({_SERIES_SQL}))
""")
def q_seasonal_lookup(spark: SparkSession, sf: str) -> DataFrame:
    series = unnest_series(_monthly_series(spark, sf), "series", value="cents")
    series = series.withColumn("multiplier", bins.seasonal_multiplier("month_num"))
    adjusted = round_half_up(F.col("cents") / 100.0 / F.col("multiplier"), 2)
    return series.withColumn("deseasonalised", adjusted)


@query(r"""
SELECT page_id, CAST(item_no AS INTEGER) AS item_no, trim(regexp_extract(item, '<a [^>]*>([^<]*)</a>', 1)) AS label,
       trim(regexp_extract(item, 'href="([^"]*)"', 1)) AS target
FROM (SELECT page_id, unnest(items) AS item, unnest(range(1, len(items) + 1)) AS item_no
      FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*>[^<]*</a>') AS items FROM pages))
WHERE item_no <= 5 AND trim(regexp_extract(item, '<a [^>]*>([^<]*)</a>', 1)) <> ''
  AND trim(regexp_extract(item, 'href="([^"]*)"', 1)) <> ''
""")
def q_page_items(spark: SparkSession, sf: str) -> DataFrame:
    """First five linked items of every page, with text and target."""
    pages = table(spark, sf, "pages").select("page_id", "html")
    return extract_items(pages, "html", r"<a [^>]*>[^<]*</a>", r"<a [^>]*>([^<]*)</a>", r'href="([^"]*)"').withColumnRenamed("price", "target")


@query(f"""
SELECT {_LINE_SQL}, l_extendedprice - 20000e0 AS price, l_quantity - 5e0 AS units FROM lineitem
WHERE l_extendedprice - 20000e0 > 0 AND l_quantity - 5e0 > 0
""")
def q_valid_prices(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        *_LINE, (F.col("l_extendedprice") - 20000.0).alias("price"), (F.col("l_quantity") - 5.0).alias("units")
    )
    return keep_positive(lines, ["price", "units"])


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'source error' WHEN k = 0 THEN 'empty' END AS reject_reason
FROM (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
WHERE event_type = 'error' OR k = 0
""")
def q_reject_split(spark: SparkSession, sf: str) -> DataFrame:
    """Events set aside, with the reason."""
    events = table(spark, sf, "events")
    error = F.when(F.col("event_type") == "error", F.col("props"))
    payload = F.nullif(F.from_json("props", "k int")["k"], F.lit(0))
    _, rejects = quality.split_rejects(events, error, payload)
    return rejects.select("event_id", "reject_reason")


@query(f"""
SELECT l_returnflag, count(*) AS rows_kept, CAST(sum({sql_cents('l_extendedprice')}) AS BIGINT) AS amount_cents
FROM lineitem WHERE l_tax <> 0 AND l_discount <> 0 GROUP BY 1
""")
def q_clean_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Rows left after infinities and NaN became NULL and incomplete rows went."""
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag",
        "l_extendedprice",
        F.when(F.col("l_tax") == 0, float("-inf")).otherwise(F.col("l_tax")).alias("tax"),
        F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_discount")).alias("discount"),
    )
    return drop_unusable(lines, ["tax", "discount"]).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows_kept"), F.sum(cents("l_extendedprice")).alias("amount_cents")
    )


def _gappy_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_linenumber", F.lit(7)).alias("l_linenumber"),
    )


@query("""
SELECT column_name, null_rows, total_rows FROM (
  SELECT 'l_orderkey' AS column_name, 0 AS null_rows, count(*) AS total_rows FROM lineitem
  UNION ALL SELECT 'l_discount', count(*) FILTER (WHERE l_discount = 0), count(*) FROM lineitem
  UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE l_tax = 0), count(*) FROM lineitem
  UNION ALL SELECT 'l_linenumber', count(*) FILTER (WHERE l_linenumber = 7), count(*) FROM lineitem)
""")
def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return null_profile(_gappy_lines(spark, sf))


@query(f"""
WITH t AS (SELECT count(*) AS n FROM lineitem)
SELECT 'duplicate key' AS rule, 'lineitem' AS table_name,
       CAST((SELECT n FROM t) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT) AS affected,
       (SELECT n FROM t) AS total
UNION ALL SELECT 'null discount', 'lineitem', count(*) FILTER (WHERE l_discount = 0), count(*) FROM lineitem
UNION ALL SELECT 'price not positive', 'lineitem', count(*) FILTER (WHERE l_extendedprice - 20000e0 <= 0), count(*) FROM lineitem
UNION ALL SELECT 'share total off', 'orders', count(*) FILTER (WHERE total_pct NOT BETWEEN 95 AND 105), count(*)
FROM (SELECT o_orderstatus, sum(CAST(floor(100e0 * n / total + 0.5e0) AS BIGINT)) AS total_pct
      FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
      JOIN (SELECT o_orderstatus, count(*) AS total FROM orders GROUP BY 1) USING (o_orderstatus) GROUP BY 1)
""")
def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """One line per rule: rows affected and rows checked."""
    lines = table(spark, sf, "lineitem")
    row_rules = quality.rule_report(
        "lineitem",
        lines,
        {
            "null discount": F.nullif("l_discount", F.lit(0.0)).isNull(),
            "price not positive": F.col("l_extendedprice") - 20000.0 <= 0,
        },
    )
    duplicates = duplicate_report(lines, ["l_orderkey", "l_linenumber"]).select(
        F.lit("duplicate key").alias("rule"),
        F.lit("lineitem").alias("table_name"),
        F.col("rows_dropped").alias("affected"),
        F.col("rows_in").alias("total"),
    )
    totals = quality.rule_report("orders", _status_shares(spark, sf), {"share total off": ~F.col("ok")})
    return row_rules.unionByName(duplicates).unionByName(totals)


def _status_shares(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("o_orderstatus").agg(F.sum("n").alias("total"))
    share = F.floor(F.col("n") * 100.0 / F.col("total") + 0.5).alias("pct")
    return share_totals(counts.join(totals, "o_orderstatus").select("o_orderstatus", share), "o_orderstatus", "pct")


@query("""
SELECT o_orderstatus, CAST(total_pct AS BIGINT) AS total_pct, total_pct BETWEEN 95 AND 105 AS ok
FROM (SELECT o_orderstatus, sum(CAST(floor(100e0 * n / total + 0.5e0) AS BIGINT)) AS total_pct
      FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
      JOIN (SELECT o_orderstatus, count(*) AS total FROM orders GROUP BY 1) USING (o_orderstatus) GROUP BY 1)
""")
def q_share_total_check(spark: SparkSession, sf: str) -> DataFrame:
    return _status_shares(spark, sf)


_ORDER_OF_LINES = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(f"""
SELECT * EXCLUDE (l_shipdate), strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_ORDER_OF_LINES)}) = 1
""")
def q_dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    kept = keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _ORDER_OF_LINES)
    return kept.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("""
SELECT count(*) AS rows_in, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_kept,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS rows_dropped
FROM lineitem
""")
def q_dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_report(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_GAPS_SQL = f"""
SELECT {_LINE_SQL}, CASE WHEN l_suppkey % 7 <> 3 THEN l_suppkey END AS supplier,
       CASE WHEN l_linenumber <> 7 AND l_suppkey % 10 <> 0 THEN l_extendedprice END AS price
FROM lineitem
"""


@query(f"""
WITH gaps AS ({_GAPS_SQL}),
medians AS (SELECT supplier, median(price) AS m FROM gaps WHERE supplier IS NOT NULL GROUP BY 1),
grouped AS (SELECT g.* EXCLUDE (price), coalesce(price, m) AS price FROM gaps AS g LEFT JOIN medians AS d ON g.supplier = d.supplier)
SELECT * EXCLUDE (price), {sql_round('coalesce(price, (SELECT median(price) FROM grouped))', 3)} AS price FROM grouped
""")
def q_impute_median(spark: SparkSession, sf: str) -> DataFrame:
    """Prices filled by supplier median, then by the overall median; some suppliers and keys are missing."""
    gaps = table(spark, sf, "lineitem").select(
        *_LINE,
        F.when(F.col("l_suppkey") % 7 != 3, F.col("l_suppkey")).alias("supplier"),
        F.when((F.col("l_linenumber") != 7) & (F.col("l_suppkey") % 10 != 0), F.col("l_extendedprice")).alias("price"),
    )
    filled = fill_null_median(gaps, ["price"], "supplier")
    return filled.withColumn("price", round_half_up("price", 3))


_FIRST_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(f"""
SELECT l_suppkey, l_discount AS first_discount FROM lineitem WHERE l_discount <> 0
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(_FIRST_ORDER)}) = 1
""")
def q_group_first(spark: SparkSession, sf: str) -> DataFrame:
    """First non-null discount of each supplier, by ship date."""
    lines = table(spark, sf, "lineitem").withColumn("discount", F.nullif("l_discount", F.lit(0.0)))
    return group_first(lines, "l_suppkey", "discount", F.struct(*_FIRST_ORDER), "first_discount")


@query("""
SELECT p_partkey, p_brand, CAST(brand_code AS INTEGER) AS brand_code
FROM part JOIN (SELECT p_brand, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS brand_code FROM part GROUP BY p_brand)
  USING (p_brand)
""")
def q_encode_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    return encode_first_seen(parts, "p_brand", "p_partkey", "brand_code")


@query("""
WITH a AS (SELECT p_brand, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS code FROM part WHERE p_size % 7 = 0 GROUP BY p_brand),
b AS (SELECT p_brand, row_number() OVER (ORDER BY min(p_partkey)) - 1 + (SELECT count(*) FROM a) AS code FROM part
      WHERE p_size % 7 <> 0 AND p_brand NOT IN (SELECT p_brand FROM a) GROUP BY p_brand)
SELECT 'brand' AS kind, p_brand AS category, CAST(code AS INTEGER) AS code FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
UNION ALL SELECT 'name', p_name, CAST(code AS INTEGER) FROM (
  SELECT p_name, row_number() OVER (ORDER BY min(CASE WHEN p_size < 25 THEN 0 ELSE 1 END), min(CASE WHEN p_size < 25 THEN p_partkey END), min(p_partkey)) - 1 AS code
  FROM part GROUP BY p_name)
""")
def q_codes_that_stay(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of brands and names after two batches of parts: the second batch numbers its new ones behind the first's."""
    parts = table(spark, sf, "part")
    out = []
    for kind, category, first in (("brand", "p_brand", F.col("p_size") % 7 == 0), ("name", "p_name", F.col("p_size") < 25)):
        codes = first_seen_codes(parts.filter(first), category, "p_partkey")
        both = extended_codes(codes, parts.filter(~first), category, "p_partkey")
        out.append(both.select(F.lit(kind).alias("kind"), F.col(category).alias("category"), "code"))
    return out[0].unionByName(out[1])


TYPE_CODES = {"SMALL": 1, "MEDIUM": 2, "LARGE": 3}


@query(f"""
SELECT p_partkey, p_type, CAST({sql_lookup('p_type', TYPE_CODES, 0)} AS INTEGER) AS type_code FROM part
""")
def q_encode_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", "p_type", encode_fixed("p_type", TYPE_CODES).alias("type_code"))


CONFIGURED_PRIORITIES = ["5-LOW", "1-URGENT", "0-NEVER", "3-MEDIUM"]


@query("""
SELECT o_orderpriority, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 3 END AS INTEGER) AS ordinal,
       count(*) AS orders
FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT', '3-MEDIUM') GROUP BY 1
""")
def q_configured_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Only the configured keys, with their place in the list."""
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "game_key")
    chosen = configured_only(orders, key_list(spark, CONFIGURED_PRIORITIES))
    counts = chosen.groupBy("game_key", "ordinal").agg(F.count(F.lit(1)).alias("orders"))
    return counts.withColumnRenamed("game_key", "o_orderpriority")


@query(f"""
SELECT l_suppkey, {sql_round('avg(CAST(l_quantity AS BIGINT)) * 30', 3)} AS monthly_quantity,
       {sql_trunc(f"CAST(sum({sql_cents('l_extendedprice')}) AS DOUBLE) / 1e8 * 1000000")} AS amount_units
FROM lineitem GROUP BY 1
""")
def q_unit_scaling(spark: SparkSession, sf: str) -> DataFrame:
    """Daily means to months, millions to whole units."""
    per_supplier = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.avg(F.col("l_quantity").cast("long")).alias("daily"), F.sum(cents("l_extendedprice")).alias("cents")
    )
    return per_supplier.select(
        "l_suppkey",
        round_half_up(F.col("daily") * 30, 3).alias("monthly_quantity"),
        truncate(F.col("cents").cast("double") / 1e8 * 1_000_000).alias("amount_units"),
    )


CHECKED_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
    "events": ["event_id", "user_id", "event_type", "props"],
}


def _checksum_sql(name: str, columns: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{quality.NULL_TEXT}')" for c in columns)
    value = f"('0x' || substr(md5({text}), 1, 8))::BIGINT"
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST(sum({value}) AS VARCHAR) AS checksum FROM {name}"


@query(" UNION ALL ".join(_checksum_sql(n, c) for n, c in CHECKED_COLUMNS.items()))
def q_table_checksum(spark: SparkSession, sf: str) -> DataFrame:
    parts = [quality.table_checksum(table(spark, sf, n), n, c) for n, c in CHECKED_COLUMNS.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


ORDERED = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "part": ["p_brand", "p_partkey"], "events": ["user_id", "event_id"]}


def _ordered_sql(name: str, order: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{quality.NULL_TEXT}')" for c in CHECKED_COLUMNS[name])
    value = f"('0x' || substr(md5({text}), 1, 8))::BIGINT % {quality.PRIME}"
    hashes = [f"list_reduce(list_prepend(0::BIGINT, list(v ORDER BY {', '.join(order)}, v)), lambda h, v: (h * {b} + v) % {quality.PRIME})" for b in quality.BASES]
    shown = " || ".join(f"format('{{:08x}}', {h})" for h in hashes)
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, {shown} AS checksum FROM (SELECT {', '.join(order)}, {value} AS v FROM {name})"


@query(" UNION ALL ".join(_ordered_sql(n, o) for n, o in ORDERED.items()))
def q_ordered_checksum(spark: SparkSession, sf: str) -> DataFrame:
    """A checksum that changes when two rows change places in the order of the key."""
    parts = [quality.ordered_checksum(table(spark, sf, n), n, o, CHECKED_COLUMNS[n]) for n, o in ORDERED.items()]
    return reduce(DataFrame.unionByName, parts)


ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, CASE WHEN count(*) = 0 THEN 'EMPTY' ELSE 'OK' END AS status FROM {n}"
    for n in ALL_TABLES
))
def q_table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.table_counts({n: table(spark, sf, n) for n in ALL_TABLES}).drop("column_count")
