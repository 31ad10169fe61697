"""Operators on given tables with induced NaN, infinities and NULL; long lookups; ingest and load reports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions.numbers import capped_score, cents, round_half_up
from ..functions.pricing import price_band
from ..operators.cleaning import duplicate_report, fill_null_median, fill_report, keep_positive, null_profile
from ..operators.joins import lookup_join, orphans
from ..operators.merge import merge_first, merged_table
from ..operators.quality import table_counts
from ..operators.statistics import correlation_pairs, group_mean
from ..schemas import TOPUP_RECORD
from ..session import ensure_checkpoint_dir, importable_in_workers
from ..sources.pages import extract_product_items
from ..sources.raw import UNREADABLE, branch_records, unreadable_documents
from .preparation import ALL_TABLES
from .registry import query, sql_cents, sql_round, sql_trunc, table

NAN, INFINITY = float("nan"), float("inf")


def _gap(value: str, nan: Column, null: Column) -> Column:
    """The value with NaN and NULL where the conditions say so."""
    return F.when(null, None).when(nan, F.lit(NAN)).otherwise(F.col(value))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice",
        _gap("l_discount", F.col("l_discount") == 0, F.col("l_linenumber") == 7).alias("discount"),
        F.when(F.col("l_tax") == 0, F.lit(INFINITY)).otherwise(F.col("l_tax")).alias("tax"),
    )


# the same columns with NULL for NaN, which is how the operators treat it
_LINES_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity, l_extendedprice,
       CASE WHEN l_linenumber <> 7 AND l_discount <> 0 THEN l_discount END AS discount,
       CASE WHEN l_tax <> 0 THEN l_tax END AS tax FROM lineitem
"""


@query(f"""
SELECT l_returnflag, count(*) AS rows_kept, CAST(sum({sql_cents('l_extendedprice')}) AS BIGINT) AS amount_cents
FROM ({_LINES_SQL}) WHERE discount > 0 GROUP BY 1
""")
def q_missing_valid(spark: SparkSession, sf: str) -> DataFrame:
    """NaN and NULL are not positive; an infinity is."""
    kept = keep_positive(_lines(spark, sf), ["discount", "tax"])
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows_kept"), F.sum(cents("l_extendedprice")).alias("amount_cents"))


@query("""
SELECT 'discount' AS column_name, count(*) FILTER (WHERE l_linenumber = 7 OR l_discount = 0) AS null_rows, count(*) AS total_rows FROM lineitem
UNION ALL SELECT 'tax', 0, count(*) FROM lineitem
""")
def q_missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    return null_profile(_lines(spark, sf), ["discount", "tax"])


_PAIRS = [("discount", "quantity"), ("tax", "quantity"), ("tax", "discount")]


@query(
    f"WITH c AS (SELECT l_quantity AS quantity, discount, tax FROM ({_LINES_SQL})) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {sql_round(f'corr({a}, {b})', 4)} AS r FROM c WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in _PAIRS)
)
def q_missing_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with NaN, NULL or an infinity on either side are left out."""
    lines = _lines(spark, sf).select(F.col("l_quantity").alias("quantity"), "discount", "tax")
    return correlation_pairs(lines, ["quantity", "discount", "tax"]).withColumn("r", round_half_up("r", 4))


@query(f"""
SELECT l_returnflag, {sql_round('avg(discount)', 6)} AS mean_discount FROM ({_LINES_SQL}) GROUP BY 1
""")
def q_missing_mean(spark: SparkSession, sf: str) -> DataFrame:
    return group_mean(_lines(spark, sf), "l_returnflag", "discount", "mean_discount").withColumn("mean_discount", round_half_up("mean_discount", 6))


@query(f"""
WITH gaps AS ({_LINES_SQL}),
medians AS (SELECT l_suppkey, median(discount) AS m FROM gaps WHERE l_suppkey % 9 <> 0 GROUP BY 1),
known AS (SELECT g.*, CASE WHEN l_suppkey % 9 <> 0 THEN discount END AS d FROM gaps AS g),
grouped AS (SELECT k.*, coalesce(d, m) AS filled FROM known AS k LEFT JOIN medians USING (l_suppkey))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_round('coalesce(filled, (SELECT median(filled) FROM grouped))', 4)} AS discount FROM grouped
""")
def q_missing_median(spark: SparkSession, sf: str) -> DataFrame:
    """NaN and NULL are filled alike; some groups have no value at all."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = _lines(spark, sf).select(*keys, F.when(F.col("l_suppkey") % 9 == 0, F.lit(NAN)).otherwise(F.col("discount")).alias("discount"))
    return fill_null_median(lines, ["discount"], "l_suppkey").withColumn("discount", round_half_up("discount", 4))


@query(f"""
SELECT user_id, {sql_round('CASE WHEN user_id % 3 = 0 THEN 0e0 ELSE least(n / 130e0, 1e0) * 40e0 END + CASE WHEN user_id % 5 = 0 THEN 0e0 ELSE least(buys / 20e0, 1e0) * 60e0 END', 1)} AS score
FROM (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS buys FROM events GROUP BY 1)
""")
def q_missing_score(spark: SparkSession, sf: str) -> DataFrame:
    """A measure that is NULL or NaN earns no points."""
    users = table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.count_if(F.col("event_type") == "purchase").cast("double").alias("buys")
    )
    events = F.when(F.col("user_id") % 3 != 0, F.col("n"))
    buys = F.when(F.col("user_id") % 5 == 0, F.lit(NAN)).otherwise(F.col("buys"))
    return users.select("user_id", capped_score([(events, 130, 40), (buys, 20, 60)]).alias("score"))


_PRICE = f"CASE WHEN p_partkey % 4 > 1 THEN greatest((p_retailprice - 950e0) / 40e0, {fv.PRICE_FLOOR}e0) END"


@query(f"""
SELECT p_partkey, {sql_round(_PRICE, 3)} AS usd, {sql_trunc(f'{_PRICE} * {fv.IDR_PER_USD}e0')} AS idr FROM part
""")
def q_missing_band(spark: SparkSession, sf: str) -> DataFrame:
    """A missing prediction has no price; only a low one is lifted to the floor."""
    missing = F.when(F.col("p_partkey") % 4 == 0, F.lit(NAN))
    price = F.when(F.col("p_partkey") % 4 > 1, (F.col("p_retailprice") - 950.0) / 40.0).otherwise(missing)
    band = price_band(price, fv.IDR_PER_USD, floor=fv.PRICE_FLOOR)
    return table(spark, sf, "part").select(
        "p_partkey", band["predicted_price_per_100_usd"].alias("usd"), band["predicted_price_per_100_idr"].alias("idr")
    )


@query("""
SELECT coalesce(c.c_mktsegment, 'none') AS segment, count(*) AS orders FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) AS c ON c_custkey = o_custkey GROUP BY 1
""")
def q_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup with as many entries as half of the customers."""
    entries = table(spark, sf, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_custkey")
    found = lookup_join(orders, "o_custkey", entries, "c_mktsegment", "segment", "none")
    return found.groupBy("segment").agg(F.count(F.lit(1)).alias("orders"))


@query("""
SELECT outcome, count(*) AS "rows" FROM (
  SELECT CASE WHEN event_id % 17 = 0 THEN 'unreadable' WHEN event_id % 11 = 0 THEN 'source error' WHEN event_id % 7 = 0 THEN 'empty'
              ELSE 'record of ' || event_type END AS outcome FROM events) GROUP BY 1
""")
def q_raw_branches(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a raw document, some unreadable, failed or empty: records and rejects add up to all of them."""
    event = F.col("event_id")
    record = F.concat(F.lit('{"game": "'), F.col("event_type"), F.lit('"}'))
    payload = F.when(event % 11 == 0, '{"_error": "timeout"}').when(event % 7 == 0, "{}").otherwise(record)
    documents = table(spark, sf, "events").select(
        F.when(event % 17 != 0, F.create_map(F.lit("any"), payload)).alias("topup"),
        F.when(event % 17 == 0, F.lit('{"topup": {')).alias(UNREADABLE),
    )
    records, rejects = branch_records(documents, "topup", TOPUP_RECORD)
    outcomes = records.select(F.concat(F.lit("record of "), "game").alias("outcome"))
    for side in (rejects, unreadable_documents(documents)):
        outcomes = outcomes.union(side.select("reject_reason"))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"],
}
_REFERENCES = [
    ("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]


def _count_sql(name: str) -> str:
    width = f"(SELECT count(*) FROM (DESCRIBE {name}))"
    return f"SELECT '{name}' AS subject, 'rows' AS finding, count(*) AS n FROM {name} UNION ALL SELECT '{name}', 'columns', {width}"


@query(" UNION ALL ".join(
    [_count_sql(n) for n in ALL_TABLES]
    + [f"SELECT '{n}', 'repeated keys', count(*) - count(DISTINCT ({', '.join(k)})) FROM {n}" for n, k in _KEYS.items()]
    + [f"SELECT '{f}.{k}', 'orphans', count(*) FROM {f} WHERE {k} NOT IN (SELECT {d} FROM {t})" for f, k, t, d in _REFERENCES]
))
def q_load_report(spark: SparkSession, sf: str) -> DataFrame:
    """What a load reports: rows and columns of every table, repeated keys, references that lead nowhere."""
    tables = {n: table(spark, sf, n) for n in ALL_TABLES}
    counts = table_counts({n: df for n, df in tables.items() if n not in _KEYS})
    parts = [counts.select(F.col("table_name").alias("subject"), F.lit("rows").alias("finding"), F.col("row_count").alias("n"))]
    for name, keys in _KEYS.items():  # rows and repeated keys in one pass
        found = F.array(
            F.struct(F.lit("rows").alias("finding"), F.col("rows_in").alias("n")), F.struct(F.lit("repeated keys").alias("finding"), F.col("rows_dropped").alias("n"))
        )
        parts.append(duplicate_report(tables[name], keys).select(F.lit(name).alias("subject"), F.inline(found)))
    widths = F.array(*[F.struct(F.lit(n).alias("subject"), F.lit("columns").alias("finding"), F.lit(len(df.columns)).cast("long").alias("n")) for n, df in tables.items()])
    parts.append(spark.range(1).select(F.inline(widths)))
    for fact, key, dim, dim_key in _REFERENCES:
        parts.append(orphans(tables[fact], key, tables[dim], dim_key).select(F.lit(f"{fact}.{key}"), F.lit("orphans"), "orphan_rows"))
    return reduce(DataFrame.union, parts)


_GAP_SQL = "CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS discount, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_quantity END AS quantity, CAST(NULL AS DOUBLE) AS nothing"


@query(f"""
WITH g AS (SELECT CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_suppkey END AS k, {_GAP_SQL} FROM lineitem),
c AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, k, count(*) - count({c}) AS gaps, count({c}) AS known FROM g GROUP BY k" for c in ('discount', 'quantity', 'nothing'))}),
s AS (SELECT column_name, sum(gaps) AS gaps, coalesce(sum(gaps) FILTER (known > 0 AND k IS NOT NULL), 0) AS from_group, sum(known) AS known, sum(gaps + known) AS n FROM c GROUP BY 1)
SELECT column_name, CAST(gaps AS BIGINT) AS gaps, CAST(from_group AS BIGINT) AS from_group, CAST(CASE WHEN known > 0 THEN gaps - from_group ELSE 0 END AS BIGINT) AS from_all,
       CAST(CASE WHEN known > 0 THEN 0 ELSE gaps - from_group END AS BIGINT) AS left_open, CAST(n AS BIGINT) AS total_rows FROM s
""")
def q_fill_report(spark: SparkSession, sf: str) -> DataFrame:
    """How many gaps a median fill closes, from the group and from all rows."""
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_suppkey")).alias("k"), F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.when(F.col("l_suppkey") % 3 != 0, F.col("l_quantity")).alias("quantity"), F.lit(None).cast("double").alias("nothing"),
    )
    return fill_report(lines, ["discount", "quantity", "nothing"], "k")


@query("""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM f WHERE r = 1
""")
def q_merged_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The first order of every customer, from three loads merged into a stored table one after the other."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/merged-{uuid.uuid4().hex}"
    for turn in (2, 0, 1):
        merge_first(path, orders.filter(F.col("o_orderkey") % 3 == turn), ["o_custkey"], ["o_orderdate", "o_orderkey"], 16)
    return merged_table(spark, path).select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")


_NAME = "regexp_replace(url, '[^a-z0-9/.:]', '', 'g')"


@query(f"""
WITH i AS (
  SELECT page_id, 1 AS item_no, {_NAME} AS label, CAST(page_id AS VARCHAR) AS price FROM pages
  UNION ALL SELECT page_id, 2, 'two ' || page_id || 'bold', 'USD ' || page_id * 2 FROM pages WHERE page_id % 3 <> 0
  UNION ALL SELECT page_id, 3, 'cell' || length(html), '3' FROM pages
  UNION ALL SELECT page_id, 4, 'inner', '4' FROM pages WHERE page_id % 2 = 0)
SELECT page_id, CAST(item_no AS INTEGER) AS item_no, label, price FROM i
""")
def q_nested_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items in nested markup with end tags left out or in the wrong order, in front of every page's own markup."""
    importable_in_workers(spark)
    page = F.col("page_id").cast("string")
    name = F.regexp_replace("url", "[^a-z0-9/.:]", "")
    second = F.when(F.col("page_id") % 3 != 0, F.concat(F.lit('<p class="amount">USD '), (F.col("page_id") * 2).cast("string"))).otherwise(F.lit("<p>none"))
    inner = F.when(F.col("page_id") % 2 == 0, F.lit('<div class="diamond"><b class="name">inner</b><i class="price">4</i></div>')).otherwise(F.lit(""))
    made = F.concat(
        F.lit('<ul><li class="product-item"><div><p class="name">'), name, F.lit('<p class="price">'), page, F.lit("</div></span>"),
        F.lit('<li class="product-item"><div class="title">two '), page, F.lit("<b><div>bold</b></div></div>"), second, F.lit("</ul>"),
        F.lit('<table class="package"><tr><td class="name">cell'), F.length("html").cast("string"), F.lit('</div><td class="price">3<tr><td>'), inner, F.lit("</table>"), F.col("html"),
    )
    return extract_product_items(table(spark, sf, "pages").select("page_id", made.alias("html")), "html")
