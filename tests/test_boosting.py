"""Boosting against a plain version that grows one tree at a time over all rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.ml import boosting, models
from pricewright.ml.boosting import Boosted, Setting, Tree, best_stage, drawn_columns, drawn_rows, fit_all
from pricewright.ml.ridge import ridge_folds, solve

NAMES = ["a", "b", "c"]


def data(n=240, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 40, n) / 8, rng.normal(size=n).round(2)], axis=1).astype(float)
    y = 3 * (x[:, 0] > 5) + x[:, 1] * (x[:, 2] > 0) + rng.normal(0, 0.3, n)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, *map(float, r), float(v), i % 4, i % 5 == 0) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, fold int, test boolean").repartition(parts)


def plain(x, y, setting, rows_of_tree, trees):
    """Predictions after every tree: exhaustive search of every split at every node."""
    score, out = np.full(len(y), y.mean()), []
    for t in range(trees):
        drawn, columns = rows_of_tree(t), drawn_columns(x.shape[1], t, setting)
        gradient = y - score
        value = np.zeros(len(y))

        def grow(of_tree, every, depth):
            g, n = gradient[of_tree].sum(), len(of_tree)
            value[every] = g / (n + setting.penalty) if n else 0.0
            if depth == setting.depth or n < max(2, setting.least_rows):
                return
            best = (1e-9, None, None)
            for c in columns:
                for cut in np.unique(x[:, c]):
                    left = of_tree[x[of_tree, c] <= cut]
                    if 0 < len(left) < n:
                        s = gradient[left].sum()
                        gain = s * s / (len(left) + setting.penalty) + (g - s) ** 2 / (n - len(left) + setting.penalty) - g * g / (n + setting.penalty)
                        if gain > best[0] + 1e-9:
                            best = (gain, c, cut)
            if best[1] is None:
                return
            _, c, cut = best
            grow(of_tree[x[of_tree, c] <= cut], every[x[every, c] <= cut], depth + 1)
            grow(of_tree[x[of_tree, c] > cut], every[x[every, c] > cut], depth + 1)

        grow(np.flatnonzero(drawn), np.arange(len(y)), 0)
        score = score + setting.rate * value
        out.append(score)
    return out


def draws(spark, df):
    return np.array([r.d for r in df.orderBy("id").select(F.xxhash64("id").alias("d")).collect()])


@pytest.mark.parametrize("setting", [
    Setting("plain", 4, 0.5, 3), Setting("drawn", 4, 0.3, 2, subsample=0.6, columns=0.6), Setting("careful", 3, 1.0, 4, least_rows=30, penalty=5.0),
])
def test_equals_the_plain_version(spark, setting):
    x, y = data()
    df = frame(spark, x, y)
    model = fit_all(df, NAMES, "y", [setting], keys=["id"]).models[setting.name, -1]
    draw = draws(spark, df)
    expected = plain(x, y, setting, lambda t: drawn_rows(draw, t, setting.seed, setting.subsample), setting.trees)
    for t in range(1, setting.trees + 1):
        assert model.predict_rows(x, t) == pytest.approx(expected[t - 1], abs=1e-6)
    assert all(n >= setting.least_rows for tree in model.trees for n, f in zip(tree.rows, tree.feature) if f >= 0)


def test_stages_are_the_scores_of_shorter_fits(spark):
    x, y = data()
    df = frame(spark, x, y)
    def fit(trees):
        setting = Setting("s", trees, 0.3, 3, subsample=0.8, columns=0.7)
        return fit_all(df, NAMES, "y", [setting], F.col("fold"), 4, F.col("test"), ["id"])
    long = fit(6)
    stages = {(r.fold, r.trees): r for r in long.stages.collect()}
    assert sorted(stages) == [(f, t) for f in (-1, 0, 1, 2, 3) for t in range(1, 7)]
    for trees in (1, 4):
        short = fit(trees)
        for held in (-1, 0, 3):
            model = short.models["s", held]
            assert model.trees == long.models["s", held].trees[:trees]
            out = np.arange(len(y)) % 5 == 0 if held < 0 else np.arange(len(y)) % 4 == held
            error = model.predict_rows(x[out]) - y[out]
            row = stages[held, trees]
            assert row.rows == out.sum() and row.mae == pytest.approx(np.abs(error).mean()) and row.rmse == pytest.approx(np.sqrt((error**2).mean()))
            assert row.r2 == pytest.approx(1 - (error**2).sum() / ((y[out] - y[out].mean()) ** 2).sum())


def test_ways_down_a_tree_are_those_of_its_rows():
    tree = Tree([1, 0, -1, -1, 2, -1, -1] + [-1] * 8, [3, 5, 0, 0, 2, 0, 0] + [0] * 8, [float(i) for i in range(15)], [0] * 15, [0.0] * 15)
    bins = np.random.default_rng(1).integers(0, 8, (500, 3))
    for levels in range(4):
        reached = np.array(tree.reached(levels))
        assert (reached[tree.ways(bins.T.astype(np.uint8), levels)] == tree.walk(bins, levels)).all()
    assert tree.steps(bins.T.astype(np.uint8), Setting("s", 1, 0.25, 3)) == pytest.approx(0.25 * tree.values(bins, 3))


def test_checkpoints_do_not_change_a_model(spark, monkeypatch):
    """However far checkpoints are apart, models and stages are the same, and the state holds blocks."""
    x, y = data()
    setting, advanced, states = Setting("s", 5, 0.3, 2, subsample=0.8), boosting._advanced, []

    def noted(state, fits, widest):
        states.append(state.count())
        return advanced(state, fits, widest)

    monkeypatch.setattr(boosting, "_advanced", noted)
    found = []
    for apart in (1, 2, 25):
        monkeypatch.setattr(boosting, "REFRESH", apart)
        fitted = fit_all(frame(spark, x, y), NAMES, "y", [setting], F.col("fold"), 4, F.col("test"), ["id"])
        found.append((fitted.models, [(r.fold, r.trees, r.rows, pytest.approx(r.mae)) for r in fitted.stages.orderBy("fold", "trees").collect()]))
    assert found[0] == found[1] == found[2]
    assert len(states) == 4 + 2 and max(states) <= boosting.LEAST_TASKS


def test_the_best_stage_is_found(spark):
    rows = [("a", 0, 1, 0.5), ("a", 1, 1, 0.7), ("a", 0, 2, 0.9), ("a", 1, 2, 0.7), ("b", 0, 1, 0.8), ("b", 1, 1, 0.8), ("c", 0, 5, 1.0), ("c", 1, 5, None), ("d", -1, 1, 0.99)]
    stages = spark.createDataFrame([(s, f, t, 10, r, 0.0, 0.0) for s, f, t, r in rows], "setting string, fold int, trees int, rows long, r2 double, mae double, rmse double")
    best = best_stage(stages).first()
    assert (best.setting, best.trees, best.folds) == ("b", 1, 2) and best.cv_r2 == pytest.approx(0.8) and best.cv_std == pytest.approx(0)
    assert best_stage(stages.limit(0)).count() == 0


def test_settings_share_passes_without_touching_each_other(spark):
    x, y = data()
    settings = [Setting("one", 3, 0.3, 2, subsample=0.7), Setting("two", 5, 0.1, 4, columns=0.6, penalty=1.0)]
    both = fit_all(frame(spark, x, y), NAMES, "y", settings, keys=["id"]).models
    for s in settings:
        assert both[s.name, -1] == fit_all(frame(spark, x, y, 7), NAMES, "y", [s], keys=["id"]).models[s.name, -1]


def test_more_values_than_bins(spark):
    x, y = data(600, 8)
    setting = Setting("s", 2, 1.0, 2)
    model = fit_all(frame(spark, x, y), NAMES, "y", [setting], keys=["id"], bins=8).models["s", -1]
    assert all(len(e) <= 8 for e in model.ends) and [e[-1] for e in model.ends] == list(x.max(axis=0))
    counts = np.bincount(np.searchsorted(model.ends[2], x[:, 2]), minlength=8)
    assert counts.max() <= 2 * 600 / 8
    cut = np.stack([np.array(e)[np.searchsorted(e, x[:, i])] for i, e in enumerate(model.ends)], axis=1)
    assert model.predict_rows(x) == pytest.approx(plain(cut, y, setting, lambda t: np.ones(len(y), bool), 2)[-1], abs=1e-6)


def test_scoring_missing_values_and_storing(spark, tmp_path):
    x, y = data()
    df = frame(spark, x, y).withColumn("a", F.when(F.col("id") == 5, None).when(F.col("id") == 6, float("nan")).otherwise(F.col("a")))
    fitted = fit_all(df, NAMES, "y", [Setting("s", 3, 0.5, 2)], keys=["id"])
    model = fitted.models["s", -1]
    known = np.array([i not in (5, 6) for i in range(len(y))])
    assert model.trees[0].rows[0] == known.sum()
    out = {r.id: r.prediction for r in model.transform(df).collect()}
    assert out[5] is None and out[6] is None
    assert [out[i] for i in range(len(y)) if known[i]] == pytest.approx(list(model.predict_rows(x[known])))
    assert Boosted.from_json(model.to_json()) == model
    models.save_model(model, str(tmp_path / "m"), spark)
    assert models.load_model(spark, str(tmp_path / "m")) == model
    assert models.importance(df, model, NAMES).agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_no_rows_one_row_and_a_constant(spark):
    x, y = data(20)
    setting = Setting("s", 2, 0.5, 2)
    empty = fit_all(frame(spark, x, y).limit(0), NAMES, "y", [setting], keys=["id"])
    assert empty.models == {} and empty.stages.count() == 0
    one = fit_all(frame(spark, x[:1], y[:1]), NAMES, "y", [setting], keys=["id"]).models["s", -1]
    assert one.predict_rows(x[:1]) == pytest.approx(y[:1])
    flat = fit_all(frame(spark, x, np.full(20, 7.0)), NAMES, "y", [setting], F.col("fold"), 4, keys=["id"])
    assert flat.models["s", -1].predict_rows(x) == pytest.approx(np.full(20, 7.0))
    assert {r.r2 for r in flat.stages.collect()} == {None}


def test_ridge_folds_equal_separate_fits(spark):
    x, y = data()
    df = frame(spark, x + 1e6, y)
    got = {(r.fold, r.alpha): r for r in ridge_folds(df, NAMES, "y", F.col("fold"), 4, [0.1, 10.0]).collect()}
    assert len(got) == 8
    fold = np.arange(len(y)) % 4
    for (k, alpha), r in got.items():
        tx, ty, hx, hy = x[fold != k] + 1e6, y[fold != k], x[fold == k] + 1e6, y[fold == k]
        centred = tx - tx.mean(axis=0)
        beta = np.linalg.solve(centred.T @ centred + alpha * np.eye(3), centred.T @ (ty - ty.mean()))
        error = ty.mean() + (hx - tx.mean(axis=0)) @ beta - hy
        assert r.coefficients == pytest.approx(list(beta), rel=1e-6) and (r.rows_train, r.rows_test) == (180, 60)
        assert r.r2 == pytest.approx(1 - (error**2).sum() / ((hy - hy.mean()) ** 2).sum(), rel=1e-6)


def test_ridge_folds_at_the_edges(spark):
    x, y = data(30)
    df = frame(spark, x, y)
    assert ridge_folds(df.limit(0), NAMES, "y", F.col("fold"), 4).count() == 0
    assert ridge_folds(df.filter("fold = 1"), NAMES, "y", F.col("fold"), 4).count() == 0  # nothing to train on
    flat = ridge_folds(df.withColumn("y", F.lit(2.0)).withColumn("a", F.lit(1.0)), NAMES, "y", F.col("fold"), 4, [1.0]).first()
    assert flat.r2 is None and flat.intercept == pytest.approx(2.0)
    moments = np.zeros((3, 3))
    moments[0, 0] = 5
    assert solve(moments, 1.0)[0] == 0.0


def plain_forest(x, y, setting, times):
    """Mean prediction of trees that each search all splits over the rows drawn for them, as often as drawn."""
    def grow(rows, every, weight, depth, value):
        n, s = weight[rows].sum(), (weight * y)[rows].sum()
        value[every] = s / n
        best = (1e-9, None, None)
        for c in range(x.shape[1]) if depth < setting.depth else ():
            for cut in np.unique(x[:, c]):
                left = rows[x[rows, c] <= cut]
                m, t = weight[left].sum(), (weight * y)[left].sum()
                if 0 < m < n:
                    gain = t * t / m + (s - t) ** 2 / (n - m) - s * s / n
                    if gain > best[0] + 1e-9:
                        best = (gain, c, cut)
        if best[1] is not None:
            _, c, cut = best
            grow(rows[x[rows, c] <= cut], every[x[every, c] <= cut], weight, depth + 1, value)
            grow(rows[x[rows, c] > cut], every[x[every, c] > cut], weight, depth + 1, value)

    out = np.zeros(len(y))
    for weight in times:
        value = np.zeros(len(y))
        grow(np.flatnonzero(weight), np.arange(len(y)), weight, 0, value)
        out += value / len(times)
    return out


def test_a_forest_equals_the_plain_version(spark):
    """Also of few trees at a time, and with a feature that is a function of another and one that never varies."""
    x, y = data()
    x = np.column_stack([x, x[:, 0] // 3, np.full(len(y), 4.0)])
    names = [*NAMES, "d", "e"]
    df = spark.createDataFrame([(i, *map(float, r), float(v), i % 4, i % 5 == 0) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, e double, y double, fold int, test boolean")
    setting, ids = boosting.forest(trees=7, depth=4), np.arange(len(y))
    fitted = fit_all(df.repartition(5), names, "y", [setting], F.col("fold"), 4, F.col("test"), ["id"])
    stages = {r.fold: r for r in fitted.stages.collect()}
    assert sorted(stages) == [-1, 0, 1, 2, 3]
    for held, row in stages.items():
        out = ids % 5 == 0 if held < 0 else ids % 4 == held
        times = [np.where(out, 0, boosting.drawn_times(draws(spark, df), t, setting.seed)) for t in range(7)]
        expected = plain_forest(x, y, setting, times)
        assert fitted.models["random_forest", held].predict_rows(x) == pytest.approx(expected, abs=1e-6)
        error = expected[out] - y[out]
        assert (row.trees, row.rows) == (7, out.sum()) and row.mae == pytest.approx(np.abs(error).mean())
        assert row.r2 == pytest.approx(1 - (error**2).sum() / ((y[out] - y[out].mean()) ** 2).sum())
    assert sum(fitted.models["random_forest", -1].importance().values()) == pytest.approx(1)


def test_forests_do_not_depend_on_partitions_or_trees_at_a_time(spark, monkeypatch):
    x, y = data()
    found = []
    for parts, cells, rows in ((1, 1 << 21, 1 << 16), (9, 1 << 8, 16)):
        monkeypatch.setattr(boosting, "FOREST_CELLS", cells)
        monkeypatch.setattr(boosting, "FOREST_BLOCK_ROWS", rows)
        fitted = fit_all(frame(spark, x, y, parts), NAMES, "y", [boosting.forest(trees=3, depth=3)], F.col("fold"), 4, keys=["id"])
        found.append(fitted.models)
    assert found[0] == found[1]


def test_rows_of_a_forest_are_drawn_as_often_as_there_are_rows():
    draw = np.random.default_rng(5).integers(-(2**62), 2**62, 200_000)
    one, other = (boosting.drawn_times(draw, t, 42).astype(int) for t in (0, 1))
    assert one.mean() == pytest.approx(1, abs=0.01) and one.var() == pytest.approx(1, abs=0.02)
    assert abs(np.corrcoef(one, other)[0, 1]) < 0.01


def test_features_that_follow_from_others_are_not_counted():
    sizes = [100, 20, 4, 4, 1, 30]
    columns = boosting.Counted.of(sizes, {(0, 1): np.arange(100) // 5, (2, 3): np.array([3, 2, 1, 0]), (3, 2): np.array([3, 2, 1, 0])})
    assert columns.packed == [[2, 5], [0]]
    rng = np.random.default_rng(2)
    bins = np.stack([rng.integers(0, n, 500) for n in sizes])
    bins[1], bins[3] = bins[0] // 5, 3 - bins[2]
    every = columns.added(bins)
    sums = np.zeros((2, 128, 1), np.int64)
    for own, row in zip(sums, columns.rows()):
        own[:, 0] = np.bincount(every[row], minlength=128)
    cells = columns.cells(sums)
    for f in range(6):
        assert (cells[f, :, 0] == np.bincount(bins[f], minlength=128)).all()


def test_all_fits_of_a_comparison_share_the_passes_of_its_forest(spark, monkeypatch):
    """A forest took a pass for each level and fit; one level of all trees of all fits is one pass while they are few."""
    x, y = data()
    passes, grow = [], boosting._grow_bagged
    monkeypatch.setattr(boosting, "_grow_bagged", lambda state, active, level, *rest: passes.append((level, len(active))) or grow(state, active, level, *rest))
    result = models.compare(frame(spark, x, y).drop("fold", "test"), ["id"], [models.default_learners(2, 6)[2]], NAMES, "y", folds=3)
    assert [level for level, _ in passes] == list(range(6)) and passes[0] == (0, 6 * 4)
    assert len(result.models["random_forest"].trees) == 6 and result.fold_scores.count() == 3
    assert result.scores.first()["cv_r2"] > 0.5
