"""Property tests (hypothesis) for the custom distributed blocks against numpy / pandas."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesflow.operators import blocks as B
from salesflow.operators import drift as D

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e3, 1e3, allow_nan=False)),
                  min_size=1, max_size=60)
groups = st.lists(st.sampled_from(["hot", "hot", "hot", "a", "b"]), min_size=60, max_size=60)


@SETTINGS
@given(values, groups, st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_quantiles_equal_numpy(spark, vals, gs, probs):
    pdf = pd.DataFrame({"g": gs[:len(vals)], "v": vals})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g string, v double")
    got = B.exact_quantiles(df, ["g"], "v", probs).toPandas()
    for g, part in pdf.dropna().groupby("g"):
        for p in probs:
            exp = np.percentile(part["v"].to_numpy(), p * 100)
            q = got[(got.g == g) & (np.isclose(got.p, p))]["q"].iloc[0]
            assert np.isclose(q, exp, rtol=1e-9, atol=1e-9)


@SETTINGS
@given(st.lists(st.integers(0, 20), min_size=1, max_size=80), st.integers(1, 6))
def test_row_index_is_a_permutation_in_order(spark, keys, parts):
    pdf = pd.DataFrame({"k": keys, "t": range(len(keys))})
    out = B.row_index(spark.createDataFrame(pdf), ["k", "t"], name="i", num_partitions=parts).toPandas()
    out = out.sort_values("i")
    assert list(out["i"]) == list(range(len(keys)))
    assert list(zip(out.k, out.t)) == sorted(zip(pdf.k, pdf.t))


@SETTINGS
@given(st.lists(st.integers(0, 9).map(float), min_size=1, max_size=40),
       st.lists(st.integers(0, 9).map(float), min_size=1, max_size=40))
def test_ks_equals_numpy_ecdf(spark, a, b):
    pdf = pd.DataFrame({"x": a + b, "period": ["reference"] * len(a) + ["current"] * len(b)})
    got = D.ks_statistics(spark.createDataFrame(pdf), ["x"]).first().ks_statistic
    v = np.sort(np.array(a + b))
    fa = np.searchsorted(np.sort(a), v, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), v, side="right") / len(b)
    assert np.isclose(got, np.max(np.abs(fa - fb)))
