"""Brute-force checks of the shared building blocks on small, skewed inputs."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from salesflow.operators import blocks as B


def _skewed(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    # group "hot" holds a third of all rows
    g = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c", "d"], n))
    pdf = pd.DataFrame({"g": g, "k": np.arange(n), "v": rng.integers(0, 50, n).astype(float)})
    return pdf, spark.createDataFrame(pdf)


def test_prefix_sums_match_cumsum(spark):
    pdf, df = _skewed(spark)
    out = B.prefix_sums(df, ["g"], ["k"], ["v"], num_partitions=7).toPandas().sort_values(["g", "k"])
    exp = pdf.sort_values(["g", "k"]).groupby("g")["v"].cumsum()
    assert np.allclose(out["cum_v"].to_numpy(), exp.to_numpy())


def test_prefix_sums_by_value_match_cumsum(spark):
    pdf, df = _skewed(spark)
    counts = pdf.groupby(["g", "v"]).size().rename("n").reset_index()
    sdf = spark.createDataFrame(counts)
    out = B.prefix_sums_by_value(sdf, ["g"], "v", ["n"], buckets=5).toPandas().sort_values(["g", "v"])
    exp = counts.sort_values(["g", "v"]).groupby("g")["n"].cumsum()
    assert np.allclose(out["cum_n"].to_numpy(), exp.to_numpy())


def test_row_index_dense_and_ordered(spark):
    pdf, df = _skewed(spark)
    out = B.row_index(df, ["v", "k"], name="i", num_partitions=5).toPandas()
    exp = pdf.sort_values(["v", "k"]).reset_index(drop=True)
    got = out.sort_values("i").reset_index(drop=True)
    assert list(got["i"]) == list(range(len(pdf)))
    assert list(got["k"]) == list(exp["k"])


def test_exact_quantiles_match_numpy_linear(spark):
    pdf, df = _skewed(spark)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = B.exact_quantiles(df, ["g"], "v", probs).toPandas()
    for g, part in pdf.groupby("g"):
        exp = np.percentile(part["v"].to_numpy(), [p * 100 for p in probs])
        row = got[got.g == g].sort_values("p")
        assert np.allclose(row["q"].to_numpy(), exp)


def test_exact_quantiles_single_value_and_nulls(spark):
    df = spark.createDataFrame([("x", 5.0), ("x", None), ("y", 1.0), ("y", 3.0)], "g string, v double")
    got = {(r.g, r.p): r.q for r in B.exact_quantiles(df, ["g"], "v", (0.5,)).collect()}
    assert got[("x", 0.5)] == 5.0 and got[("y", 0.5)] == 2.0


def test_pair_moments_pairwise_complete_like_pandas(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=200)
    b = a * 0.5 + rng.normal(size=200)
    c = rng.normal(size=200)
    b[::7] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double")
    m = B.pair_moments(df, ["a", "b", "c"]).select("a", "b", B.pearson("cov", "var_a", "var_b").alias("r"))
    got = {(r.a, r.b): r.r for r in m.collect()}
    exp = pdf.corr()
    for (x, y), r in got.items():
        assert abs(r - exp.loc[x, y]) < 1e-9


def test_pair_moments_constant_column_gives_null_corr(spark):
    df = spark.createDataFrame([(1.0, 0.5), (2.0, 0.5), (3.0, 0.5)], "x double, k double")
    r = B.pair_moments(df, ["x", "k"], [("x", "k")]).select(B.pearson("cov", "var_a", "var_b").alias("r")).first().r
    assert r is None


def test_attach_one_row(spark):
    df = spark.range(5).withColumnRenamed("id", "v")
    stats = df.agg(F.max("v").alias("mx"))
    assert [r.mx for r in B.attach(df, stats).collect()] == [4] * 5


def test_prefix_sums_by_value_many_buckets(spark):
    # cluster-sized bucket counts: the binary-search bucket expression must stay exact
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 5000), "v": rng.normal(size=5000), "n": 1})
    out = B.prefix_sums_by_value(spark.createDataFrame(pdf), ["g"], "v", ["n"], buckets=1024).toPandas()
    out = out.sort_values(["g", "v"])
    exp = pdf.sort_values(["g", "v"]).groupby("g")["n"].cumsum()
    assert np.allclose(out["cum_n"].to_numpy(), exp.to_numpy())


def test_bucket_index_binary_search(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.5, 1.0, 2.5, 9.0)], "v double")
    got = [r.b for r in df.select(B.bucket_index("v", F.array(*[F.lit(x) for x in (0.0, 1.0, 2.0)]), 7)
                                  .alias("b")).collect()]
    assert got == [0, 0, 1, 1, 3, 3]
