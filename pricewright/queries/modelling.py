"""Splits, metrics, scenario features and models over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions.numbers import cents, round_half_up
from ..functions.pricing import optimal_price
from ..ml.metrics import regression_metrics, residual_histogram
from ..ml.models import as_pipeline, compare, default_learners, fit_one, importance, random_forest, ridge
from ..ml.scoring import scenario_features
from ..ml.boosting import Setting, fit_all, published_settings
from ..ml.ridge import ALPHAS, ridge_folds
from ..ml.split import SEED, with_exact_folds, with_exact_split, with_fold, with_split
from .registry import query, sql_lookup, sql_round, sql_values, table

_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


def _bucket_sql(buckets: int, seed: int) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in _LINE_KEYS]])
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT % {buckets}"


@query(f"""
SELECT l_returnflag, count(*) FILTER (WHERE b >= 20) AS train_rows, count(*) FILTER (WHERE b < 20) AS test_rows
FROM (SELECT l_returnflag, {_bucket_sql(100, SEED)} AS b FROM lineitem) GROUP BY 1
""")
def q_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    split = with_split(table(spark, sf, "lineitem"), _LINE_KEYS)
    return split.groupBy("l_returnflag").agg(
        F.count_if(~F.col("is_test")).alias("train_rows"), F.count_if("is_test").alias("test_rows")
    )


@query(f"""
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS fold_rows, count(DISTINCT l_partkey) AS parts
FROM (SELECT l_partkey, {_bucket_sql(5, SEED + 1)} AS fold FROM lineitem) GROUP BY 1
""")
def q_fold_counts(spark: SparkSession, sf: str) -> DataFrame:
    folds = with_fold(table(spark, sf, "lineitem"), _LINE_KEYS)
    per_part = folds.groupBy("fold", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return per_part.groupBy("fold").agg(F.sum("n").alias("fold_rows"), F.count("l_partkey").alias("parts"))


_DRAWS = [f"('0x' || substr(md5('{{seed}}|' || {" || '|' || ".join(f'CAST({k} AS VARCHAR)' for k in _LINE_KEYS)}), {at}, 15))::BIGINT" for at in (1, 16)]


def _place_sql(seed: int) -> str:
    return f"row_number() OVER (ORDER BY {', '.join(d.format(seed=seed) for d in _DRAWS)})"


@query(f"""
SELECT l_returnflag, count(*) FILTER (WHERE NOT test) AS train_rows, count(*) FILTER (WHERE test) AS test_rows,
       CAST(coalesce(sum(l_orderkey) FILTER (WHERE test), 0) AS BIGINT) AS test_keys
FROM (SELECT l_returnflag, l_orderkey, {_place_sql(SEED)} <= (count(*) OVER () * 20 + 99) // 100 AS test FROM lineitem) GROUP BY 1
""")
def q_exact_split(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly a fifth of all lines, rounded up, held out."""
    split = with_exact_split(table(spark, sf, "lineitem"), _LINE_KEYS)
    return split.groupBy("l_returnflag").agg(
        F.count_if(~F.col("is_test")).alias("train_rows"), F.count_if("is_test").alias("test_rows"),
        F.coalesce(F.sum(F.when(F.col("is_test"), F.col("l_orderkey"))), F.lit(0)).alias("test_keys"),
    )


@query(f"""
WITH p AS (SELECT l_orderkey, {_place_sql(SEED + 1)} - 1 AS place, count(*) OVER () AS n FROM lineitem),
f AS (SELECT l_orderkey, CASE WHEN place < (n % 7) * (n // 7 + 1) THEN place // (n // 7 + 1) ELSE n % 7 + (place - (n % 7) * (n // 7 + 1)) // (n // 7) END AS fold FROM p)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS fold_rows, CAST(sum(l_orderkey) AS BIGINT) AS fold_keys FROM f GROUP BY 1
""")
def q_exact_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Seven folds of all lines whose sizes differ by one row at most."""
    folds = with_exact_folds(table(spark, sf, "lineitem"), _LINE_KEYS, 7)
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("fold_rows"), F.sum("l_orderkey").alias("fold_keys"))


_Y, _P = "l_extendedprice / 1e3", "l_quantity * 2e0 + l_linenumber"


@query(f"""
SELECT l_returnflag, count(*) AS "rows", {sql_round('1e0 - sum((p - y) * (p - y)) / (var_pop(y) * count(*))', 4)} AS r2,
       {sql_round('sum(abs(p - y)) / count(*)', 4)} AS mae, {sql_round('sqrt(sum((p - y) * (p - y)) / count(*))', 4)} AS rmse
FROM (SELECT l_returnflag, {_Y} AS y, {_P} AS p FROM lineitem) GROUP BY 1
""")
def q_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return regression_metrics(_fixed_predictor(spark, sf), "y", "p", by=["l_returnflag"])


def _fixed_predictor(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_returnflag",
        (F.col("l_extendedprice") / 1e3).alias("y"),
        (F.col("l_quantity") * 2.0 + F.col("l_linenumber")).alias("p"),
    )


@query(f"""
WITH r AS (SELECT {_P} - {_Y} AS v FROM lineitem),
b AS (SELECT min(v) AS lo, max(v) AS hi FROM r),
n AS (SELECT least(CAST(floor((v - lo) * 15e0 / (hi - lo)) AS BIGINT) + 1, 15) AS bin, count(*) AS c FROM r, b GROUP BY 1)
SELECT CAST(range AS INTEGER) AS bin, {sql_round('lo + (range - 1) * ((hi - lo) / 15e0)', 4)} AS bin_from,
       {sql_round('lo + range * ((hi - lo) / 15e0)', 4)} AS bin_to, coalesce(c, 0) AS "rows"
FROM range(1, 16) CROSS JOIN b LEFT JOIN n ON n.bin = range
""")
def q_residuals(spark: SparkSession, sf: str) -> DataFrame:
    counts = residual_histogram(_fixed_predictor(spark, sf), "y", "p", 15)
    return counts.withColumns({c: round_half_up(c, 4) for c in ("bin_from", "bin_to")})


GENRE_CODES = {"ECONOMY": 0, "SMALL": 1, "MEDIUM": 2, "PROMO": 3}  # other types count as unknown
REGION_CYCLE = [r for r, *_ in fv.REGIONS] + ["Antarctica"]
SEGMENT_CYCLE = [s for s, *_ in fv.SEGMENTS] + ["visitor"]


def _cycle_sql(items: list[str]) -> str:
    return sql_lookup(f"p_partkey % {len(items)}", dict(enumerate(items)), None)


_MAU = "greatest((p_retailprice - 920e0) * 2e0, 0e0)"
_HEALTH = "least(mau / 130e0, 1e0) * 40e0 + least(ratio / 0.35e0, 1e0) * 30e0 + 20e0"


@query(f"""
WITH s AS (SELECT p_partkey, p_type AS genre, {_cycle_sql(REGION_CYCLE)} AS region, {_cycle_sql(SEGMENT_CYCLE)} AS spending_segment,
                  CAST(p_size AS DOUBLE) AS game_median_age, {_MAU} AS mau FROM part),
t AS (SELECT *, coalesce(mau * 0.18e0 / nullif(mau, 0e0), 0e0) AS ratio FROM s)
SELECT p_partkey, {sql_round('mau * 0.18e0', 2)} AS dau_millions, {sql_round(_HEALTH, 1)} AS community_health_score,
       game_median_age, {sql_round('ratio', 3)} AS dau_to_mau_ratio,
       {sql_lookup('region', {r: i for r, i, _, _ in fv.REGIONS}, 1.0)} AS region_price_index,
       {sql_lookup('region', {r: a for r, _, a, _ in fv.REGIONS}, 1.0)} AS region_arpu_mult,
       {sql_lookup('spending_segment', {s: m for s, m, _, _ in fv.SEGMENTS}, 1.0)} AS segment_spend_mult,
       {sql_lookup('spending_segment', {s: p for s, _, p, _ in fv.SEGMENTS}, 15)} AS segment_player_pct,
       {sql_lookup('genre', GENRE_CODES, 0)} AS genre_encoded,
       {sql_lookup('region', {r: c for r, _, _, c in fv.REGIONS}, 0)} AS region_encoded,
       {sql_lookup('spending_segment', {s: c for s, _, _, c in fv.SEGMENTS}, 0)} AS segment_encoded
FROM t
""")
def q_scenario_features(spark: SparkSession, sf: str) -> DataFrame:
    """Every part as a pricing scenario, some with unknown region, segment or genre, or no audience."""
    def cycle(items: list[str]):
        return F.element_at(F.array(*[F.lit(i) for i in items]), (F.col("p_partkey") % len(items) + 1).cast("int"))

    scenarios = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_type").alias("genre"),
        F.lit(50.0).alias("competition_score"),
        F.greatest((F.col("p_retailprice") - 920.0) * 2.0, F.lit(0.0)).alias("mau_millions"),
        F.lit(0.05).alias("arpdau_usd"),
        F.col("p_size").cast("double").alias("age_median"),
        cycle(REGION_CYCLE).alias("region"),
        cycle(SEGMENT_CYCLE).alias("spending_segment"),
    )
    features = scenario_features(scenarios, GENRE_CODES)
    return features.select(
        "p_partkey", "dau_millions", "community_health_score", "game_median_age", "dau_to_mau_ratio",
        "region_price_index", "region_arpu_mult", "segment_spend_mult", "segment_player_pct",
        "genre_encoded", "region_encoded", "segment_encoded",
    )


MODEL_FEATURES = ["quantity", "discount", "line"]


def _model_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A learnable target: net price per line, from quantity, discount and line number."""
    lines = table(spark, sf, "lineitem")
    return lines.select(
        *_LINE_KEYS,
        F.col("l_quantity").alias("quantity"),
        (F.col("l_discount") * 100.0).alias("discount"),
        F.col("l_linenumber").cast("double").alias("line"),
        (F.col("l_quantity") * (1.0 - F.col("l_discount")) + F.col("l_extendedprice") / 1e4).alias("target"),
    )


# Normal equations of three centred features, solved by Cramer's rule.
_RIDGE_SQL = f"""
WITH d AS (SELECT l_quantity AS a, l_discount * 100e0 AS b, CAST(l_linenumber AS DOUBLE) AS c,
                  l_quantity * (1e0 - l_discount) + l_extendedprice / 1e4 AS y FROM lineitem),
m AS (SELECT count(*) * var_pop(a) + 1e0 AS aa, count(*) * var_pop(b) + 1e0 AS bb, count(*) * var_pop(c) + 1e0 AS cc,
             count(*) * covar_pop(a, b) AS ab, count(*) * covar_pop(a, c) AS ac, count(*) * covar_pop(b, c) AS bc,
             count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS by_, count(*) * covar_pop(c, y) AS cy FROM d),
s AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM m)
SELECT 'quantity' AS feature, {sql_round('(ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det', 3)} AS coefficient FROM s
UNION ALL SELECT 'discount', {sql_round('(aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det', 3)} FROM s
UNION ALL SELECT 'line', {sql_round('(aa * (bb * cy - bc * by_) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det', 3)} FROM s
"""


def _grid_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every sold part as a row of the price grid: the 14 model features and the recommended price."""
    sold = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).cast("double").alias("lines"), F.sum(F.col("l_quantity").cast("long")).cast("double").alias("units"),
        F.sum(cents("l_extendedprice")).cast("double").alias("revenue_cents"),
    )

    def cycle(items: list[str]):
        return F.element_at(F.array(*[F.lit(i) for i in items]), (F.col("p_partkey") % len(items) + 1).cast("int"))

    scenarios = table(spark, sf, "part").join(sold, F.col("p_partkey") == F.col("l_partkey")).select(
        "p_partkey", F.col("p_type").alias("genre"), (F.col("p_size") * 2.0).alias("competition_score"), (F.col("units") / 8.0).alias("mau_millions"),
        (F.col("revenue_cents") / 100.0 / F.col("units") / 1e5).alias("arpdau_usd"), F.col("p_size").cast("double").alias("age_median"),
        cycle([r for r, *_ in fv.REGIONS]).alias("region"), cycle([s for s, *_ in fv.SEGMENTS]).alias("spending_segment"),
    )
    rows = scenario_features(scenarios, GENRE_CODES)
    price = optimal_price("arpdau_usd", "competition_score", "game_median_age", "mau_millions", "segment_spend_mult", "region_price_index")
    return rows.select("p_partkey", *fv.FEATURES, price.alias(fv.TARGET))


@query(_RIDGE_SQL)
def q_ridge(spark: SparkSession, sf: str) -> DataFrame:
    model = fit_one(_model_rows(spark, sf), ridge(1.0), MODEL_FEATURES, "target")
    pairs = list(zip(MODEL_FEATURES, [float(c) for c in model.coefficients]))
    fitted = spark.createDataFrame(pairs, "feature string, coefficient double")
    return fitted.withColumn("coefficient", round_half_up("coefficient", 3))


def _ridge_folds_sql() -> str:
    """Normal equations of three centred features for every fold and penalty, by Cramer's rule."""
    values = {
        "aa": "saa + alpha", "bb": "sbb + alpha", "cc": "scc + alpha", "ab": "sab", "ac": "sac", "bc": "sbc", "ay": "say", "by_": "sby", "cy": "scy",
    }
    det = "aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac)"
    solved = {
        "ka": "ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)",
        "kb": "aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)",
        "kc": "aa * (bb * cy - bc * by_) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)",
    }
    pairs = ["aa", "bb", "cc", "ab", "ac", "bc", "ay", "by", "cy"]
    sums = ", ".join(f"count(*) * covar_pop({p[0]}, {p[1]}) AS s{p}" for p in pairs)
    rounded = ", ".join(f"{sql_round(k, 4)} AS {n}" for k, n in (("ka", "quantity"), ("kb", "discount"), ("kc", "line"), ("i", "intercept")))
    return f"""
WITH d AS (SELECT l_quantity AS a, l_discount * 100e0 AS b, CAST(l_linenumber AS DOUBLE) AS c,
                  l_quantity * (1e0 - l_discount) + l_extendedprice / 1e4 AS y, {_bucket_sql(5, SEED + 1)} AS fold FROM lineitem),
t AS (SELECT k, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, {sums} FROM d, range(5) AS r(k) WHERE fold <> k GROUP BY k),
m AS (SELECT k, alpha, n, ma, mb, mc, my, {", ".join(f"{v} AS {c}" for c, v in values.items())} FROM t, {sql_values([(a,) for a in ALPHAS], 'p', ['alpha'])}),
s AS (SELECT *, {det} AS det FROM m),
b AS (SELECT k, alpha, n, ma, mb, mc, my, {", ".join(f"({v}) / det AS {c}" for c, v in solved.items())} FROM s),
f AS (SELECT *, my - ka * ma - kb * mb - kc * mc AS i FROM b),
e AS (SELECT k, alpha, count(*) AS rows_test, 1e0 - sum((y - i - ka * a - kb * b - kc * c) ** 2) / (var_pop(y) * count(*)) AS r2
      FROM f JOIN d ON d.fold = f.k GROUP BY ALL)
SELECT CAST(k AS INTEGER) AS fold, alpha, n AS rows_train, rows_test, {rounded}, {sql_round('r2', 4)} AS r2 FROM f JOIN e USING (k, alpha)"""


@query(_ridge_folds_sql())
def q_ridge_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge for every fold and penalty from one pass over the lines."""
    rows = with_fold(_model_rows(spark, sf), _LINE_KEYS)
    found = ridge_folds(rows, MODEL_FEATURES, "target", F.col("fold"), 5)
    named = [round_half_up(F.col("coefficients")[i], 4).alias(f) for i, f in enumerate(MODEL_FEATURES)]
    return found.select("fold", "alpha", "rows_train", "rows_test", *named, round_half_up("intercept", 4).alias("intercept"), round_half_up("r2", 4).alias("r2"))


TREES = 100  # of the boosted models in queries; the library's default, and the published number, is 300
GRID_KEYS = ["p_partkey"]


@query()
def q_gbt_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Feature importance of the published boosted model on the price grid."""
    rows = _grid_rows(spark, sf)
    setting = published_settings(TREES)[0]
    model = fit_all(rows, fv.FEATURES, fv.TARGET, [setting], keys=GRID_KEYS).models[setting.name, -1]
    return importance(rows, model, fv.FEATURES)


def _boosted_tree_sql() -> str:
    """One tree of two levels: the best split of all rows, then the best of either side."""
    def best(rows: str, name: str, side: str) -> str:
        """The split of `rows` (value columns, y less the mean of all) that explains most."""
        each = " UNION ALL ".join(f"SELECT {i} AS f, {f} AS v, count(*) AS n, sum(y) AS s FROM {rows} GROUP BY {f}" for i, f in enumerate(MODEL_FEATURES))
        return f"""{name} AS (
  SELECT '{side}' AS node, f, v FROM (
    SELECT f, v, sum(n) OVER upto AS nl, sum(s) OVER upto AS sl, sum(n) OVER every AS nn, sum(s) OVER every AS ss FROM ({each})
    WINDOW upto AS (PARTITION BY f ORDER BY v), every AS (PARTITION BY f))
  WHERE nl < nn ORDER BY sl * sl / nl + (ss - sl) * (ss - sl) / (nn - nl) DESC, f, v LIMIT 1)"""

    side = "CASE b.f " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(MODEL_FEATURES)) + " END <= b.v"
    names = sql_lookup("b.f", dict(enumerate(MODEL_FEATURES)), None)
    return f"""
WITH d0 AS (SELECT l_quantity AS quantity, l_discount * 100e0 AS discount, CAST(l_linenumber AS DOUBLE) AS line,
                   l_quantity * (1e0 - l_discount) + l_extendedprice / 1e4 AS y FROM lineitem),
d AS (SELECT quantity, discount, line, y - (SELECT avg(y) FROM d0) AS y FROM d0),
{best('d', 'root', 'all')},
sided AS (SELECT d.*, {side} AS is_left FROM d, root AS b),
l AS (SELECT * FROM sided WHERE is_left), r AS (SELECT * FROM sided WHERE NOT is_left),
{best('l', 'bl', 'left')}, {best('r', 'br', 'right')},
leaves AS (
  SELECT 'left' AS node, {side} AS lower, y FROM l, bl AS b UNION ALL SELECT 'right', {side}, y FROM r, br AS b)
SELECT b.node, {names} AS feature, b.v AS upto, lower, count(*) AS "rows", {sql_round('avg(y)', 4)} AS value
FROM leaves JOIN (SELECT * FROM bl UNION ALL SELECT * FROM br) AS b USING (node) GROUP BY ALL"""


@query(_boosted_tree_sql())
def q_boosted_tree(spark: SparkSession, sf: str) -> DataFrame:
    """The first boosted tree of two levels over all lines: its four leaves."""
    rows = _model_rows(spark, sf)
    model = fit_all(rows, MODEL_FEATURES, "target", [Setting("tree", 1, 1.0, 2)], keys=_LINE_KEYS).models["tree", -1]
    tree, out = model.trees[0], []
    for node, side in ((1, "left"), (2, "right")):
        own = tree.feature[node]
        for child, lower in ((2 * node + 1, True), (2 * node + 2, False)):
            out.append((side, MODEL_FEATURES[own], model.ends[own][tree.cut[node]], lower, tree.rows[child], tree.value[child]))
    leaves = spark.createDataFrame(out, "node string, feature string, upto double, lower boolean, rows long, value double")
    return leaves.withColumn("value", round_half_up("value", 4))


@query()
def q_boosting_stages(spark: SparkSession, sf: str) -> DataFrame:
    """The mean score over the folds of several learning rates and depths, after every number of trees: one run for all."""
    rows = _grid_rows(spark, sf)
    settings = [Setting(f"rate {rate}, depth {depth}", 20, rate, depth, subsample=0.85, least_rows=5) for rate in (0.05, 0.1, 0.2) for depth in (2, 4)]
    folded = with_exact_folds(rows, GRID_KEYS, 3)
    stages = fit_all(folded, fv.FEATURES, fv.TARGET, settings, F.col("fold"), 3, keys=GRID_KEYS).stages.filter("fold >= 0")
    return stages.groupBy("setting", "trees").agg(F.count(F.lit(1)).alias("folds"), round_half_up(F.avg("r2"), 4).alias("cv_r2"), round_half_up(F.avg("mae"), 4).alias("cv_mae"))


_TREE_SQL = f"""
WITH d AS (SELECT l_quantity AS quantity, l_discount * 100e0 AS discount, CAST(l_linenumber AS DOUBLE) AS line,
                  l_quantity * (1e0 - l_discount) + l_extendedprice / 1e4 AS y FROM lineitem),
v AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, {f} AS value, count(*) AS n, sum(y) AS s FROM d GROUP BY {f}" for f in MODEL_FEATURES)}),
c AS (SELECT feature, sum(n) OVER upto AS nl, sum(s) OVER upto AS sl, sum(n) OVER every AS nn, sum(s) OVER every AS ss FROM v
      WINDOW upto AS (PARTITION BY feature ORDER BY value), every AS (PARTITION BY feature)),
best AS (SELECT * FROM c WHERE nl < nn ORDER BY sl * sl / nl + (ss - sl) * (ss - sl) / (nn - nl) DESC LIMIT 1)
SELECT feature, {sql_round('sl / nl', 4)} AS prediction, CAST(nl AS BIGINT) AS "rows" FROM best
UNION ALL SELECT feature, {sql_round('(ss - sl) / (nn - nl)', 4)}, CAST(nn - nl AS BIGINT) FROM best
"""


@query(_TREE_SQL)
def q_exact_tree(spark: SparkSession, sf: str) -> DataFrame:
    """One tree of one split over all rows and all values of the features: the split that explains most."""
    rows = _model_rows(spark, sf)
    model = fit_one(rows, random_forest(trees=1, depth=1, bootstrap=False), MODEL_FEATURES, "target")
    best = importance(rows, model, MODEL_FEATURES).first()["feature"]
    predicted = as_pipeline(model, MODEL_FEATURES).transform(rows)
    leaves = predicted.groupBy(round_half_up("prediction", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("rows"))
    return leaves.select(F.lit(best).alias("feature"), "prediction", "rows")


@query()
def q_model_compare(spark: SparkSession, sf: str) -> DataFrame:
    """The four learners at the published depths on the price grid, by test score and 5-fold cross-validation."""
    result = compare(_grid_rows(spark, sf), GRID_KEYS, default_learners(TREES), fv.FEATURES, fv.TARGET, folds=5, parallelism=4)
    return result.scores.orderBy("ordinal")
