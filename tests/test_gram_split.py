"""Moment-matrix regression against refits, and splits by selection against sorting."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesflow.operators import blocks as B
from salesflow.operators import gram as G
from salesflow.operators import models as M
from salesflow.operators import preprocess as P


@pytest.fixture(scope="module")
def points(spark):
    r, rows = random.Random(2), []
    for i in range(900):
        g = r.choice(["a", "b", None, "tiny"]) if i else "alone"
        if g == "tiny" and r.random() < 0.9:
            g = "a"
        x, z = 1e6 + r.gauss(0, 3), r.gauss(5, 100)
        y = 4e6 + (2 if g == "a" else -1) * (x - 1e6) + 0.5 * z + r.gauss(0, 1)
        rows.append((i, g, x, z if i % 50 else None, float("nan") if i % 71 == 70 else y))
    return spark.createDataFrame(rows, "i long, g string, x double, z double, y double").repartition(4), rows


def refit(rows, reg):
    """Least squares on the rows themselves, penalty on standardised coefficients."""
    x, y = np.array([[r[2], r[3]] for r in rows]), np.array([r[4] for r in rows])
    mx, my = x.mean(0), y.mean()
    c = (x - mx).T @ (x - mx) / len(y)
    b = np.linalg.lstsq(c + reg * np.diag(np.diag(c)), (x - mx).T @ (y - my) / len(y), rcond=1e-12)[0]
    return np.r_[my - mx @ b, b]


def rmse(rows, beta):
    return math.sqrt(np.mean([(r[4] - beta[0] - beta[1] * r[2] - beta[2] * r[3]) ** 2 for r in rows]))


def complete(rows):
    return [r for r in rows if r[3] is not None and not math.isnan(r[4])]


def test_grouped_models_equal_refits(points):
    df, rows = points
    got = {r["g"]: r for r in G.grouped_regression(df, ["x", "z"], "y", by=["g"]).collect()}
    groups = {r[1] for r in complete(rows)}
    assert set(got) == groups and None in groups
    for g in groups - {"alone"}:
        own = [r for r in complete(rows) if r[1] == g]
        if len(own) < 4:
            continue
        beta = refit(own, 0.0)
        assert got[g]["n"] == len(own)
        assert np.allclose(got[g]["coefficients"], beta[1:], rtol=1e-5, atol=1e-5) and math.isclose(got[g]["intercept"], beta[0], rel_tol=1e-3, abs_tol=50)
        assert math.isclose(got[g]["rmse"], rmse(own, beta), rel_tol=1e-4)
    assert G.grouped_regression(df.where("false"), ["x"], "y", by=["g"]).count() == 0
    whole = G.grouped_regression(df, ["x", "z"], "y").collect()
    assert len(whole) == 1 and whole[0]["n"] == len(complete(rows))


def test_folds_equal_refits(points):
    df, rows = points
    folds = G.cross_validate(df, ["x", "z"], "y", F.col("i") % 4, (0.0, 0.3), by=["g"])
    got = {(r["g"], r["reg"], r["fold"]): r for r in folds.collect()}
    for g in ("a", "b", None):
        for reg in (0.0, 0.3):
            for k in range(4):
                own = [r for r in complete(rows) if r[1] == g]
                train, test = [r for r in own if r[0] % 4 != k], [r for r in own if r[0] % 4 == k]
                r, beta = got[g, reg, k], refit(train, reg)
                assert (r["n_train"], r["n_test"]) == (len(train), len(test))
                assert np.allclose(r["coefficients"], beta[1:], rtol=1e-4, atol=1e-5) and math.isclose(r["rmse"], rmse(test, beta), rel_tol=1e-3)
    assert not any(k[0] == "alone" for k in got)  # no training rows in the other folds
    best = {r["g"]: r["reg"] for r in G.best_regularisation(folds, ["g"]).where("best").collect()}
    assert best["a"] == best["b"] == 0.0


def test_linear_validation_reads_the_rows_once_and_agrees_with_mllib(points):
    df, rows = points
    clean = df.dropna(subset=["z"]).where(~F.isnan("y"))
    _, scores = M.cross_validate(clean, ["x", "z"], "y", "linear", fold=F.col("i") % 3, grid={"regParam": [0.0, 0.5]})
    want = []
    for k in range(3):
        own = complete(rows)
        want.append(rmse([r for r in own if r[0] % 3 == k], refit([r for r in own if r[0] % 3 != k], 0.0)))
    assert scores[0][0] == {"regParam": 0.0} and math.isclose(scores[0][1], np.mean(want), rel_tol=1e-3) and scores[1][1] > scores[0][1]
    model, trees = M.cross_validate(clean.limit(200), ["z"], "y", "random_forest", folds=2, key=["i"], params={"numTrees": 3}, grid={"maxDepth": [1, 4]})
    assert [p for p, _ in trees] == [{"maxDepth": 1}, {"maxDepth": 4}] and all(m > 0 for _, m in trees) and model.bestModel is not None


@pytest.mark.parametrize("most", [50, 100_000])
def test_selection_equals_sorting(spark, monkeypatch, most):
    monkeypatch.setattr(B, "MAX_ORDERED_ROWS", most)
    r = random.Random(6)
    rows = [(i, r.choice([None, 1, 2, 2, 2, 9]), r.choice(["a", "b", None]), r.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, a int, b string, c double").repartition(5)
    order = sorted(rows, key=lambda t: ((t[1] is not None, t[1] or 0), (t[2] is not None, t[2] or ""), t[3], t[0]))
    for rank in (0, 1, 17, 1500, 2400, 2999):
        got = B.row_at_rank(df, ["a", "b", "c", "id"], rank, 3000)
        assert tuple(got) == (order[rank][1], order[rank][2], order[rank][3], order[rank][0])


@pytest.mark.parametrize("n,test_size", [(1000, 0.2), (7, 0.5), (3, 0.99), (1, 0.2), (0, 0.2), (500, 1.0)])
def test_split_sizes_and_rows(spark, monkeypatch, n, test_size):
    monkeypatch.setattr(B, "MAX_ORDERED_ROWS", 60)
    r = random.Random(n)
    rows = [(i, r.randrange(40)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, day int").repartition(3)
    out = P.split(df, ["day", "id"], test_size)
    first = n - math.ceil(n * test_size)
    want = {row[0]: "train" if k < first else "test" for k, row in enumerate(sorted(rows, key=lambda t: (t[1], t[0])))}
    assert {x["id"]: x["split"] for x in out.collect()} == want
    # a tie at the cut, and rows alike in every column: exact sizes all the same
    ties = P.split(df.select("day"), ["day"], test_size).groupBy("split").count()
    assert {x["split"]: x["count"] for x in ties.collect()} == {k: v for k, v in (("train", first), ("test", n - first)) if v}
    shuffled = {x["split"]: x["count"] for x in P.split(df, ["id"], test_size, shuffle=True, key=["id"]).groupBy("split").count().collect()}
    assert shuffled == {k: v for k, v in (("train", first), ("test", n - first)) if v}


def test_rows_are_labelled_without_a_shuffle(spark):
    df = spark.range(5000).selectExpr("id", "id % 90 AS day")
    plan = P.split(df, ["day", "id"], 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
