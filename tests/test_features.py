"""Feature semantics against pandas on tiny frames (reference tests: lag-1 = previous row, null prefix, ranges)."""

import datetime as dt

import numpy as np
import pandas as pd

from salesflow.operators import features as FE
from salesflow.operators import windows as W


def test_time_features_match_pandas(spark):
    dates = pd.date_range("2023-12-25", "2025-01-06", freq="D")
    df = spark.createDataFrame([(d.date(),) for d in dates], "date date")
    got = FE.add_time_features(df).toPandas().sort_values("date").reset_index(drop=True)
    d = pd.to_datetime(got["date"])
    assert list(got["day_of_week"]) == list(d.dt.dayofweek)
    assert list(got["week_of_year"]) == list(d.dt.isocalendar().week.astype(int))
    assert list(got["day_of_year"]) == list(d.dt.dayofyear)
    assert list(got["is_month_end"]) == list(d.dt.is_month_end.astype(int))
    assert list(got["is_quarter_start"]) == list(d.dt.is_quarter_start.astype(int))
    assert list(got["is_quarter_end"]) == list(d.dt.is_quarter_end.astype(int))
    jan = got[d.dt.month == 1]
    assert set(jan["quarter"]) == {1} and set(jan["season"]) == {"Winter"}
    assert np.allclose(got["month_sin"], np.sin(2 * np.pi * d.dt.month / 12))


def test_time_features_pass_through_without_date(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert FE.add_time_features(df).columns == ["x"]


def _seq(spark, n=100):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "r", float(100 + i)) for i in range(n)]
    return spark.createDataFrame(rows, "date date, region string, sales double")


def test_lags_are_previous_rows_with_null_prefix(spark):
    out = W.add_lags(_seq(spark), "sales", ["region"], ["date"]).toPandas().sort_values("date")
    assert out["sales_lag_1"].iloc[1:].tolist() == out["sales"].iloc[:-1].tolist()
    assert out["sales_lag_7"].iloc[:7].isna().all() and out["sales_lag_7"].iloc[7] == 100.0


def test_rolling_matches_pandas_min_periods_1(spark):
    out = W.add_rolling(_seq(spark), "sales", ["region"], ["date"], windows=(7,)).toPandas().sort_values("date")
    exp = out["sales"].rolling(7, min_periods=1)
    assert np.allclose(out["sales_rolling_7_mean"], exp.mean())
    assert np.allclose(out["sales_rolling_7_std"].iloc[1:], exp.std().iloc[1:])
    assert pd.isna(out["sales_rolling_7_std"].iloc[0])


def test_halo_chunks_equal_plain_window(spark):
    rng = np.random.default_rng(0)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=int(i // 3)), str(g), int(i), float(v))
            for i, (g, v) in enumerate(zip(rng.choice(["hot", "hot", "cold"], 900), rng.normal(size=900)))]
    df = spark.createDataFrame(rows, "date date, g string, k int, sales double")
    plain = W.add_history(df, "sales", ["g"], ["date", "k"], lags=(1, 5), windows=(4,)).toPandas()
    halo = W.add_history(df, "sales", ["g"], ["date", "k"], lags=(1, 5), windows=(4,), chunk_rows=37).toPandas()
    a, b = plain.sort_values("k").reset_index(drop=True), halo.sort_values("k").reset_index(drop=True)
    pd.testing.assert_frame_equal(a[sorted(a.columns)], b[sorted(b.columns)])


def test_null_group_key_gets_null_history(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d), None, 1.0) for d in (1, 2)], "date date, region string, sales double")
    out = W.add_lags(df, "sales", ["region"], ["date"], lags=(1,)).toPandas()
    assert out["sales_lag_1"].isna().all()


def test_interactions_division_rule(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (3.0, None, 1.0)], "a double, b double, c double")
    out = FE.add_interactions(df, ["a", "b", "c"])
    # b has a NULL (counts as non-zero) -> a_div_b exists; c has a zero -> no division by c
    assert "a_div_b" in out.columns and "a_div_c" not in out.columns and "a_x_c" in out.columns


def test_group_stats_null_key(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), (None, 5.0)], "region string, sales double")
    out = {r.sales: r.sales_region_mean for r in FE.add_group_stats(df, "sales", ["region"]).collect()}
    assert out[1.0] == 2.0 and out[5.0] is None


def test_nan_is_missing_in_rolling_and_group_stats(spark):
    rows = [(dt.date(2024, 1, d), "r", v) for d, v in ((1, 1.0), (2, float("nan")), (3, 3.0))]
    df = spark.createDataFrame(rows, "date date, region string, sales double")
    out = W.add_rolling(df, "sales", ["region"], ["date"], windows=(3,), aggs=("mean",)).toPandas()
    assert out.sort_values("date")["sales_rolling_3_mean"].tolist()[-1] == 2.0
    g = FE.add_group_stats(df, "sales", ["region"], aggs=("mean",)).first()
    assert g.sales_region_mean == 2.0
