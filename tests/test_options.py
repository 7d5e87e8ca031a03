"""Options that no registered query takes."""
import numpy as np
import pandas as pd

from salesflow.operators import relational as R
from salesflow.operators import selection as FS
from salesflow.operators import summary as S
from salesflow.session import scratch_path
from salesflow.sources import io as IO


def csv(spark, text):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(line,) for line in text.split("\n")[:-1]], "value string").coalesce(1).write.text(path)
    return path


def test_malformed_rows_are_kept_with_their_text(spark):
    path = csv(spark, "a,b\n1,x\nnot a number,y\n3,z,too many\n4,\n")
    rows = IO.read_csv(spark, path, "a int, b string", malformed="bad").collect()
    assert [(r["a"], r["b"], r["bad"]) for r in rows] == [
        (1, "x", None), (None, "y", "not a number,y"), (3, "z", "3,z,too many"), (4, None, None)]


def test_line_ends_inside_quotes(spark):
    path = csv(spark, 'a,b\n1,"two\nlines, and a ""quote"""\n2,one\n')
    rows = IO.read_csv(spark, path, "a int, b string", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, 'two\nlines, and a "quote"'), (2, "one")]


def test_keyset_pages_follow_each_other(spark):
    df = spark.createDataFrame([(i, i // 3) for i in range(20)], "id int, t int")
    seen, last = [], (None, None)
    while page := R.page_after(df, "t", "id", 7, *last).collect():
        seen += [r["id"] for r in page]
        last = (page[-1]["t"], page[-1]["id"])
    assert seen == list(range(19, -1, -1))
    assert seen[7:14] == [r["id"] for r in R.page(df, "t", "id", 7, 7).collect()]


def test_approximate_summaries_are_near_the_exact_ones(spark):
    pdf = pd.DataFrame({"x": np.random.default_rng(0).normal(size=5000), "k": ["a", "b"] * 2500})
    df = spark.createDataFrame(pdf)
    exact, near = (S.numeric_summary(df, ["x"], approx=a).first() for a in (False, True))
    assert all(abs(exact[c] - near[c]) < 0.01 for c in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    assert {r["column"]: r["n_distinct"] for r in S.distinct_values(df, ["k"], approx=True).collect()} == {"k": 2}


def test_importance_of_boosted_trees_and_linear_models(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 4))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")).assign(y=5 * x[:, 0] ** 2 + 2 * x[:, 2]))
    trees = FS.by_importance(df, list("abcd"), "y", 2, "gbt", {"maxIter": 10})
    assert {r["feature"] for r in trees.where("selected").collect()} == {"a", "c"}
    linear = {r["feature"]: r["score"] for r in FS.by_importance(df, list("abcd"), "y", 2, "linear").collect()}
    want = np.linalg.lstsq(np.c_[x, np.ones(400)], 5 * x[:, 0] ** 2 + 2 * x[:, 2], rcond=None)[0][:4]
    assert np.allclose([linear[c] for c in "abcd"], np.abs(want), rtol=1e-4, atol=1e-6)
