"""Predictions of ``operators/forest.py`` and the runs that train on it, against MLlib's."""

import numpy as np
import pandas as pd
import pytest

from salesflow.operators import forest
from salesflow.operators import models as M

COLS = list("abcd")
PLAIN = {"maxIter": 13, "maxDepth": 4, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 3, "seed": 7}


def _rows(n=1500):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 4))
    x[:, 3] = rng.integers(0, 5, n)
    return pd.DataFrame(x, columns=COLS).assign(y=3 * x[:, 0] + 2 * x[:, 1] ** 2 + 0.5 * x[:, 3] * x[:, 2] + 1e3)


def _predicted(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("y").select("prediction").collect()])


def test_boosting_is_that_of_mllib_without_draws(spark):
    df = spark.createDataFrame(_rows()).repartition(3).persist()
    theirs = M.make_estimator("gbt", params=PLAIN).fit(M.assemble(df, COLS, "y"))
    ours = forest.fit(df, COLS, "y", "gbt", **PLAIN)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-6)
    odd = spark.createDataFrame([(None, 0.5, -1.0, 2.0, 1.0), (0.3, float("nan"), 9.0, 2.0, 2.0), (float("inf"), 1.0, None, -5.0, 3.0)],
                                df.schema)
    for rows in (df, odd):
        assert np.allclose(_predicted(ours, rows), _predicted(theirs, M.assemble(rows, COLS, "y")), rtol=1e-9)
    df.unpersist()


def test_boosting_over_many_tasks_and_stored_residuals(spark, monkeypatch):
    df = spark.createDataFrame(_rows(9000)).repartition(3).persist()
    first = _predicted(forest.fit(df, COLS, "y", "gbt", **PLAIN), df)
    monkeypatch.setattr(forest, "ROWS_PER_TASK", 500)  # eighteen tasks
    monkeypatch.setattr(forest, "MANY_TASKS", 2)
    monkeypatch.setattr(forest, "STORE_EVERY", 2)
    assert np.allclose(_predicted(forest.fit(df, COLS, "y", "gbt", **PLAIN), df), first, rtol=1e-9)
    df.unpersist()


def test_a_forest_predicts_as_well_as_mllibs(spark):
    df = spark.createDataFrame(_rows(3000)).repartition(3).persist()
    p = {"numTrees": 30, "maxDepth": 8, "minInstancesPerNode": 5, "seed": 3}
    ours = forest.fit(df, COLS, "y", "random_forest", **p)
    theirs = M.make_estimator("random_forest", params=p).fit(M.assemble(df, COLS, "y"))
    y = np.array([r[0] for r in df.select("y").orderBy("y").collect()])
    errors = [np.sqrt(np.mean((_predicted(m, x) - y) ** 2)) for m, x in ((ours, df), (theirs, M.assemble(df, COLS, "y")))]
    assert abs(errors[0] / errors[1] - 1) < 0.1 and errors[0] < 0.6 * y.std(), errors
    again = forest.Trees.from_df(ours.to_df(spark))
    assert (_predicted(again, df) == _predicted(ours, df)).all() and again.featureImportances == ours.featureImportances
    df.unpersist()


@pytest.mark.parametrize("kind", ["random_forest", "gbt"])
def test_labels_without_a_split_are_predicted_by_their_mean(spark, kind):
    df = spark.range(50).selectExpr("cast(id as double) a", "cast(id % 3 as double) b", "7D as y")
    model = forest.fit(df, ["a", "b"], "y", kind)
    assert np.allclose(_predicted(model, df), 7.0) and not model.featureImportances.toArray().any()
    two = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0)], "a double, y double")
    params = {"numTrees": 200} if kind == "random_forest" else {}
    assert np.allclose(_predicted(forest.fit(two, ["a"], "y", kind, **params), two), 2.0, atol=0.3)


def test_leaves_hold_the_means_of_their_rows(spark):
    pdf = _rows(600)[["a", "y"]]
    df = spark.createDataFrame(pdf).coalesce(1)
    x, y = pdf["a"].to_numpy(), pdf["y"].to_numpy()
    cut = max(forest.thresholds(x, 32), key=lambda c: sum((y[s].sum() - s.sum() * y.mean()) ** 2 / s.sum() for s in (x <= c, x > c)))
    sums = [(s.sum(), (y[s] - y.mean()).sum()) for s in (x <= cut, x > cut)]
    model = forest.fit(df, ["a"], "y", "gbt", maxIter=1, maxDepth=1)
    want = np.where(x <= cut, sums[0][1] / sums[0][0], sums[1][1] / sums[1][0]) + y.mean()
    assert np.allclose(model.predict(pdf), want)


def test_training_runs_fit_no_tree_row_by_row(spark, monkeypatch):
    make = M.make_estimator

    def linear_only(kind, *args, **kwargs):
        assert kind == "linear", "trees are fitted row by row, one after the other"
        return make(kind, *args, **kwargs)

    monkeypatch.setattr(M, "make_estimator", linear_only)
    pdf = _rows(2000)
    df = spark.createDataFrame(pdf.assign(split=np.where(np.arange(2000) < 1600, "train", "test")))
    models, runs = M.train_many(df, COLS, "y", params={"random_forest": {"numTrees": 20, "maxDepth": 6}, "gbt": {"maxIter": 30}})
    got = {r["run_id"]: r for r in runs.collect()}
    assert [got[k]["status"] for k in ("linear", "random_forest", "gbt")] == ["FINISHED"] * 3, got
    assert got["gbt"]["test_r2"] > got["random_forest"]["test_r2"] > got["linear"]["test_r2"]
    assert all(r["training_seconds"] > 0 and r["test_rmse"] is not None for r in got.values())
    assert {f for f, _ in M.feature_importances(models["gbt"], COLS)} == set(COLS)


def test_a_missing_value_fails_the_trees_runs(spark):
    df = spark.createDataFrame(_rows(300)).unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 5.0)], "a double, b double, c double, d double, y double"))
    got = {r["run_id"]: r for r in M.train_many(df, COLS, "y", kinds=("random_forest", "gbt"))[1].collect()}
    assert all(r["status"] == "FAILED" and r["rmse"] is None and "missing or infinite" in r["error"] for r in got.values())


def test_other_parameters_stay_with_mllib(spark):
    assert not forest.knows({"lossType": "absolute"}, "gbt") and not forest.knows({"featureSubsetStrategy": "sqrt"}, "gbt")
    assert not forest.knows({}, "linear") and forest.knows(M.DEFAULT_PARAMS["gbt"], "gbt")
    model, row = M.train(spark.createDataFrame(_rows(200)), COLS, "y", "gbt", {"maxIter": 2, "lossType": "absolute"})
    assert row["status"] == "FINISHED" and hasattr(model, "stages")
