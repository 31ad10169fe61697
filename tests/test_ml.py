from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from pricewright import fixed_values as fv
from pricewright.ml import metrics, models, scoring, split
from pricewright.schemas import TABLE_KEYS

KEYS = TABLE_KEYS["ml_features"]
CODES = {
    "MOBA": 0, "Battle Royale": 1, "RPG / Gacha / Open World": 2,
    "Turn-based RPG / Gacha": 3, "Shooter / Battle Royale": 4,
}


def test_split_does_not_depend_on_partitioning(tables):
    data = tables["ml_features"]
    one = rows(split.with_split(data, KEYS), *KEYS, "is_test")
    assert one == rows(split.with_split(data.repartition(5), KEYS), *KEYS, "is_test")
    share = sum(r[-1] for r in one) / len(one)
    assert 0.1 < share < 0.35


def test_folds_partition_the_rows(tables):
    folds = split.with_fold(tables["ml_features"], KEYS, 5)
    counts = dict(rows(folds.groupBy("fold").count()))
    assert set(counts) == set(range(5)) and sum(counts.values()) == 90


def test_split_and_fold_limits(spark):
    with pytest.raises(ValueError):
        split.with_split(spark.range(1), ["id"], 50)
    with pytest.raises(ValueError):
        split.with_fold(spark.range(1), ["id"], 2)


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(5, 2, 200)
    p = y + rng.normal(0, 1, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    got = metrics.regression_metrics(df, "y", "p").first()
    assert got["r2"] == pytest.approx(1 - ((p - y) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-4)
    assert got["mae"] == pytest.approx(np.abs(p - y).mean(), abs=1e-4)
    assert got["rmse"] == pytest.approx(np.sqrt(((p - y) ** 2).mean()), abs=1e-4)
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert metrics.regression_metrics(constant, "y", "p").first()["r2"] is None
    assert metrics.residual_histogram(df, "y", "p").agg(F.sum("rows")).first()[0] == 200


@pytest.mark.parametrize("alpha", [0.01, 1.0, 100.0])
def test_ridge_equals_the_closed_form(spark, alpha):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (150, 3)) * [1.0, 5.0, 0.2]
    y = x @ [2.0, -1.0, 3.0] + 7 + rng.normal(0, 0.3, 150)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(v),) for r, v in zip(x, y)], "a double, b double, c double, t double")
    model = models.fit_one(df, models.ridge(alpha), ["a", "b", "c"], "t")
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert list(model.coefficients) == pytest.approx(list(beta), rel=1e-5)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ beta, rel=1e-5)


def test_model_frame_checks_and_cleans(tables):
    with pytest.raises(ValueError, match="nope"):
        models.model_frame(tables["ml_features"], ["nope", "mau_millions", "dau_millions"], fv.TARGET, [])
    with pytest.raises(ValueError):
        models.model_frame(tables["ml_features"], ["mau_millions", "dau_millions"], fv.TARGET, [])
    broken = tables["ml_features"].withColumn("mau_millions", F.when(F.col("region") == "SEA", float("nan")).otherwise(1.0))
    assert models.model_frame(broken, fv.FEATURES, fv.TARGET, []).count() == 72


@pytest.fixture(scope="module")
def comparison(tables):
    learners = [models.gradient_boosting(25), models.random_forest(15), models.ridge()]
    return models.compare(tables["ml_features"], KEYS, learners, parallelism=4)


def test_comparison(comparison):
    scores = {r["model"]: r for r in comparison.scores.collect()}
    assert set(scores) == {"gbt", "random_forest", "ridge"}
    assert all(r["rows_train"] + r["rows_test"] == 90 for r in scores.values())
    assert scores["gbt"]["cv_r2"] > scores["ridge"]["cv_r2"]
    assert 0.4 < scores["ridge"]["cv_r2"] < 0.85  # published: about 0.64
    assert comparison.best() in ("gbt", "random_forest")
    folds = comparison.fold_scores.groupBy("model").agg(F.count("*"), F.avg("r2")).collect()
    for name, count, mean in folds:
        assert count == 5 and mean == pytest.approx(scores[name]["cv_r2"], abs=1e-4)
    assert comparison.predictions["ridge"].count() == scores["ridge"]["rows_test"]


def test_importance_adds_up_and_is_sorted(spark, tables, comparison):
    for name in ("gbt", "ridge"):
        table = models.importance(tables["ml_features"], comparison.models[name], fv.FEATURES).collect()
        weights = [r["importance"] for r in table]
        assert weights == sorted(weights, reverse=True)
        assert sum(r["importance_pct"] for r in table) == pytest.approx(100, abs=1)
    assert {r["label"] for r in table} == set(fv.FEATURE_LABELS.values())


def test_scenario_features(spark):
    got = scoring.scenario_features(scoring.demo_scenarios(spark), CODES)
    first = got.filter("genre = 'MOBA'").first()
    assert (first["dau_millions"], first["dau_to_mau_ratio"]) == (19.8, 0.18)
    assert first["community_health_score"] == 69.3
    assert (first["region_price_index"], first["segment_player_pct"], first["segment_encoded"]) == (0.7, 15, 0)
    shooter = got.filter("genre like 'Shooter%'").first()
    assert shooter["genre_encoded"] == 4  # the code used in training
    assert set(fv.FEATURES) <= set(got.columns)
    odd = spark.createDataFrame([("?", 10.0, 0.0, 0.1, 20.0, "?", "?")], scoring.SCENARIO)
    row = scoring.scenario_features(odd, CODES).first()
    assert (row["genre_encoded"], row["region_price_index"], row["segment_player_pct"]) == (0, 1.0, 15)
    assert (row["dau_to_mau_ratio"], row["community_health_score"]) == (0.0, 20.0)


def test_saved_model_scores_in_batches(spark, tables, comparison, tmp_path):
    from pyspark.ml import PipelineModel

    path = str(tmp_path / "model")
    models.save_model(models.as_pipeline(comparison.models["gbt"], fv.FEATURES), path)
    loaded = PipelineModel.load(path)
    codes = spark.createDataFrame(list(CODES.items()), "genre string, genre_encoded int")
    scored = scoring.score(scoring.demo_scenarios(spark), loaded, codes, floor=fv.PRICE_FLOOR)
    prices = {r["genre"]: r for r in scored.collect()}
    assert len(prices) == 4
    for r in prices.values():
        assert r["range_low_usd"] <= r["predicted_price_per_100_usd"] <= r["range_high_usd"]
        assert r["predicted_price_per_100_idr"] == int(r["prediction"] * fv.IDR_PER_USD)
    assert prices["RPG / Gacha / Open World"]["prediction"] > prices["MOBA"]["prediction"]


def test_tier_estimates(spark):
    got = scoring.tier_estimates(spark.createDataFrame([(2.0,)], "p double"), "p")
    assert rows(got, "tier", "tier_price_usd", "tier_price_idr") == [
        ("large", 700.0, 11375000), ("medium", 200.0, 3250000), ("mega", 2400.0, 39000000),
        ("micro", 16.0, 260000), ("small", 60.0, 975000),
    ]


def test_fewer_features(tables):
    chosen = ["arpdau_usd", "segment_spend_mult", "region_price_index"]
    result = models.compare(tables["ml_features"], KEYS, [models.ridge(10.0)], chosen, folds=3, test_pct=30)
    assert len(result.models["ridge"].coefficients) == 3


def test_a_model_does_not_depend_on_the_partitions(tables):
    data = tables["ml_features"]
    learner = models.gradient_boosting(trees=4, depth=2)
    one, other = (models.fit_one(data.repartition(n), learner) for n in (1, 7))
    assert list(one.featureImportances) == list(other.featureImportances)


def test_default_learners_are_four(tables):
    found = models.compare(tables["ml_features"], KEYS, models.default_learners(trees=2, forest_trees=2), folds=3)
    assert sorted(r.model for r in found.scores.collect()) == sorted(["gbt", "gbt_colsample", "random_forest", "ridge"])


def test_scenarios_that_lack_a_number_come_back_unscored(spark, tables):
    fitted = models.fit_one(tables["ml_features"], models.ridge())
    pipeline = models.as_pipeline(fitted, fv.FEATURES)
    given = [("MOBA", 50.0, 80.0, 0.1, 25.0, "SEA", "dolphin"), ("MOBA", None, 80.0, float("nan"), 25.0, "SEA", "dolphin")]
    got = scoring.score(spark.createDataFrame(given, scoring.SCENARIO), pipeline, CODES).collect()
    done, undone = sorted(got, key=lambda r: r.not_scored is not None)
    assert done.prediction is not None and done.not_scored is None
    assert undone.prediction is None and set(undone.not_scored.split(", ")) == {"competition_score", "arpdau_usd"}
    assert undone.predicted_price_per_100_usd is None


def test_exact_split_and_folds(tables):
    data = tables["ml_features"]
    one = rows(split.with_exact_split(data, KEYS), *KEYS, "is_test")
    assert sum(r[-1] for r in one) == 18 and len(one) == 90
    assert one == rows(split.with_exact_split(data.repartition(7), KEYS), *KEYS, "is_test")
    assert one != rows(split.with_exact_split(data, KEYS, seed=7), *KEYS, "is_test")
    for folds in (4, 7):
        by_fold = rows(split.with_exact_folds(data, KEYS, folds), *KEYS, "fold")
        counts = [sum(r[-1] == f for r in by_fold) for f in range(folds)]
        assert counts == [90 // folds + (f < 90 % folds) for f in range(folds)]
        assert by_fold == rows(split.with_exact_folds(data.coalesce(1), KEYS, folds), *KEYS, "fold")


def test_exact_split_of_equal_rows(spark):
    same = spark.createDataFrame([(1, "x")] * 250 + [(2, "y")] * 50, "id long, v string")
    assert split.with_exact_split(same, ["id"], 33).filter("is_test").count() == 99
    counts = split.with_exact_folds(same, ["id"], 7).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in counts) == [42, 43, 43, 43, 43, 43, 43]
    assert split.with_exact_split(same.limit(0), ["id"]).count() == 0
    keyless = spark.createDataFrame([(None, i) for i in range(10)], "id long, v int")
    assert split.with_exact_split(keyless, ["id"], 30).filter("is_test").count() == 3
