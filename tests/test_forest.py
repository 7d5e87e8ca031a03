"""The histogram forest of ``operators/forest.py`` against MLlib's and plain loops."""

import math

import numpy as np
import pandas as pd
import pytest

from salesflow.operators import forest
from salesflow.operators import models as M
from salesflow.operators import selection as FS

COLS = list("abcd")


def _frame(spark, n=3000, parts=3):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 4))
    x[:, 3] = rng.integers(0, 5, n)
    y = 3 * x[:, 0] + 2 * x[:, 1] ** 2 + 0.5 * x[:, 3] + 1e3
    return spark.createDataFrame(pd.DataFrame(x, columns=COLS).assign(y=y)).repartition(parts)


def test_importances_are_those_of_mllib(spark, monkeypatch):
    df = _frame(spark).persist()
    p = {"numTrees": 40, "maxDepth": 5}
    want = dict(M.feature_importances(M.make_estimator("random_forest", params=p).fit(M.assemble(df, COLS, "y")), COLS))

    def no_mllib(*args, **kwargs):
        raise AssertionError("the forest is fitted row by row and tree by tree")

    monkeypatch.setattr(M, "make_estimator", no_mllib)
    got = {r["feature"]: (r["score"], r["rank"], r["selected"]) for r in FS.by_importance(df, COLS, "y", 2, "random_forest", p).collect()}
    df.unpersist()
    assert all(abs(got[c][0] - want[c]) < 0.05 for c in COLS), (got, want)
    assert math.isclose(sum(s for s, _, _ in got.values()), 1.0)
    assert {c for c in COLS if got[c][2]} == set(sorted(want, key=want.get)[-2:])


def test_same_forest_at_every_run_and_small_blocks(spark, monkeypatch):
    df = _frame(spark, 9000, 2).persist()
    p = {"numTrees": 3, "maxDepth": 3}
    first = forest.importances(df, COLS, "y", **p)
    assert forest.importances(df, COLS, "y", **p) == first
    monkeypatch.setattr(forest, "ROWS_PER_TASK", 500)  # eighteen tasks
    many = dict(forest.importances(df, COLS, "y", **p))
    df.unpersist()
    assert all(abs(many[c] - v) < 0.2 for c, v in first)


def test_other_parameters_go_to_mllib(spark):
    got = FS.by_importance(_frame(spark, 200), COLS, "y", 2, "random_forest", {"numTrees": 2, "subsamplingRate": 0.5}).collect()
    assert len(got) == 4


def test_missing_values_are_an_error(spark):
    df = spark.range(300).selectExpr("cast(id as double) a", "cast(id % 7 as double) b", "cast(id % 2 as double) y")
    for bad in (None, float("nan"), float("inf"), float("-inf")):
        for row in ((1.0, bad, 1.0), (1.0, 1.0, bad)):
            with pytest.raises(ValueError, match="1 of 301 rows"):
                forest.importances(df.union(spark.createDataFrame([row], df.schema)), ["a", "b"], "y")


def test_constant_labels_split_nothing(spark):
    df = spark.range(50).selectExpr("cast(id as double) a", "cast(id % 3 as double) b", "7D as y")
    assert dict(forest.importances(df, ["a", "b"], "y", numTrees=3)) == {"a": 0.0, "b": 0.0}


def test_best_splits_against_loops():
    rng = np.random.default_rng(3)
    w = rng.integers(0, 6, (2, 4, 7)).astype(float)
    wy = w * rng.normal(size=w.shape)
    w[1] = w[1] * 0 + w[0].sum(axis=1, keepdims=True) / 7  # both features hold the same rows
    wy[1] = wy[1] * 0 + wy[0].sum(axis=1, keepdims=True) / 7
    pick, cut, gain, left, right = forest.best_splits(w, wy, 5)
    for node in range(4):
        best = (0.0, 0, 0)
        for j in range(2):
            for c in range(6):
                wl, wr = w[j, node, :c + 1].sum(), w[j, node, c + 1:].sum()
                if wl >= 5 and wr >= 5:
                    sl, sr = wy[j, node, :c + 1].sum(), wy[j, node, c + 1:].sum()
                    g = sl * sl / wl + sr * sr / wr - (sl + sr) ** 2 / (wl + wr)
                    if g > best[0] + 1e-12:
                        best = (g, j, c)
        assert math.isclose(gain[node], best[0], abs_tol=1e-9) and (pick[node], cut[node]) == best[1:]
        assert math.isclose(left[node] + right[node], w[0, node].sum())


def test_top_places_and_thresholds():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 9, (1000, 4)).astype(np.uint8)
    path = [(rng.integers(0, 4, 1 << s), rng.integers(0, 9, 1 << s).astype(np.uint8)) for s in range(4)]
    want = np.zeros(1000, np.int64)
    for f, c in path:
        want = 2 * want + (bins[np.arange(1000), f[want]] > c[want])
    assert (forest._top_places(np.ascontiguousarray(bins.T), path) == want).all()
    assert forest.thresholds(np.array([1.0, 1, 2, 4]), 32).tolist() == [1.5, 3.0]
    assert forest.thresholds(np.array([2.0, 2.0]), 32).tolist() == []
    many = forest.thresholds(rng.normal(size=5000), 32)
    assert len(many) == 31 and (np.diff(many) > 0).all()
