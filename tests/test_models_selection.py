import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from salesflow.operators import models as M
from salesflow.operators import selection as FS


def test_regression_metrics_formulas(spark):
    y = np.array([3.0, -0.5, 2.0, 7.0, 0.0])
    p = np.array([2.5, 0.0, 2.0, 8.0, 0.1])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    r = M.regression_metrics(df, "y", "p").first()
    e = y - p
    assert np.isclose(r.rmse, np.sqrt(np.mean(e ** 2))) and np.isclose(r.mae, np.mean(np.abs(e)))
    assert np.isclose(r.r2, 1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2))
    assert np.isclose(r.mape, np.mean(np.abs(e) / np.maximum(np.abs(y), M.EPS)) * 100)


def test_r2_constant_target(spark):
    same = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    off = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert M.regression_metrics(same, "y", "p").first().r2 == 1.0
    assert M.regression_metrics(off, "y", "p").first().r2 == 0.0


def test_best_run_ignores_failed(spark):
    runs = spark.createDataFrame([("a", "FAILED", 1.0), ("b", "FINISHED", 3.0), ("c", "FINISHED", 2.0)],
                                 "run_id string, status string, test_rmse double")
    assert M.best_run(runs).first().run_id == "c"


def test_linear_regression_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=200)
    y = 3 * x + 2 + rng.normal(scale=0.1, size=200)
    df = M.assemble(spark.createDataFrame(pd.DataFrame({"x": x, "y": y})), ["x"], "y")
    model = M.make_estimator("linear").fit(df)
    slope, icpt = np.polyfit(x, y, 1)
    assert np.isclose(model.coefficients[0], slope) and np.isclose(model.intercept, icpt)


def test_train_many_tolerates_failure(spark):
    df = spark.createDataFrame([(float(i), float(2 * i), "train") for i in range(30)], "x double, y double, split string")
    models, runs = M.train_many(df, ["x"], "y", kinds=("linear", "no_such_model"))
    st = {r.run_id: r.status for r in runs.collect()}
    assert st == {"linear": "FINISHED", "no_such_model": "FAILED"} and "linear" in models


def _sel_frame(spark):
    rng = np.random.default_rng(42)
    X = rng.normal(size=(300, 6))
    y = 2 * X[:, 0] + 1.5 * X[:, 1] - X[:, 2] + rng.normal(scale=0.1, size=300)
    pdf = pd.DataFrame(X, columns=[f"f{i}" for i in range(6)])
    pdf["y"] = y
    pdf["const"] = 0.5
    return pdf, spark.createDataFrame(pdf)


def test_variance_and_correlation(spark):
    pdf, df = _sel_frame(spark)
    v = {r.feature: r.selected for r in FS.by_variance(df, ["f0", "const"]).collect()}
    assert v == {"f0": True, "const": False}
    c = {r.feature: r.corr for r in FS.correlations(df, ["f0", "f3"], "y").collect()}
    assert np.isclose(c["f0"], pdf["f0"].corr(pdf["y"]))
    s = {r.feature: r.corr for r in FS.correlations(df, ["f0", "f3"], "y", "spearman").collect()}
    assert np.isclose(s["f0"], pdf["f0"].rank().corr(pdf["y"].rank()))  # no scipy here


def test_f_test_top_k(spark):
    pdf, df = _sel_frame(spark)
    top = [r.feature for r in FS.by_f_test(df, [f"f{i}" for i in range(6)], "y", 3).where("selected").collect()]
    assert set(top) == {"f0", "f1", "f2"}


def test_rfe_matches_bruteforce_order(spark):
    pdf, df = _sel_frame(spark)
    got = {r.feature for r in FS.by_rfe(df, [f"f{i}" for i in range(6)], "y", 3).where("selected").collect()}
    assert got == {"f0", "f1", "f2"}


def test_drop_correlated_upper_triangle(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=100)
    pdf = pd.DataFrame({"a": a, "b": a * 2 + 1e-6 * rng.normal(size=100), "c": rng.normal(size=100)})
    keep = {r.feature: r.keep for r in FS.drop_correlated(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    assert keep == {"a": True, "b": False, "c": True}


def test_consensus_votes_and_fallback(spark):
    mk = lambda xs: spark.createDataFrame([(x,) for x in xs], "feature string")
    out = FS.consensus({"m1": mk(["a", "b"]), "m2": mk(["a", "c"]), "m3": mk(["b", "a"])}, k=2)
    sel = [r.feature for r in out.where(F.col("selected")).orderBy("rank").collect()]
    assert sel == ["a", "b"]


def test_default_consensus_votes_with_a_forest(spark):
    from salesflow.plans.registry import REGISTRY
    from salesflow.plans.selection_q import consensus_by_default
    assert "fs10_consensus_importance" in REGISTRY
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 4))
    # a is linear, b acts by its square: no correlation, but a forest sees it
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(y=x[:, 0] + 4 * x[:, 1] ** 2)
    r = pdf[list("abcd")].corrwith(pdf["y"]).abs().sort_values(ascending=False)
    votes = {}
    for name in [*r[r >= 0.05].index[:2], *r.index[:2], "a", "b"]:  # correlation, F-test (monotone in |r|), forest
        votes[name] = votes.get(name, 0) + 1
    out = consensus_by_default(spark.createDataFrame(pdf), 2, list("abcd"), "y").collect()
    assert {q.feature: q.votes for q in out} == votes


class _Doubler:
    def predict(self, x):
        return x["v"] * 2.0


def test_foreign_model_object_is_broadcast(spark):
    df = spark.range(5).selectExpr("id", "cast(id as double) as v")
    out = M.score_with_python(df, _Doubler(), ["v"]).orderBy("id").collect()
    assert [r.prediction for r in out] == [0.0, 2.0, 4.0, 6.0, 8.0]
