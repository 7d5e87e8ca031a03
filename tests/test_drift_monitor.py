import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesflow.operators import drift as D
from salesflow.operators import monitor as PM
from salesflow.operators import windows as W


def _two_samples(spark, shift=0.5, n=500, seed=42):
    rng = np.random.default_rng(seed)
    ref = pd.DataFrame({"f1": rng.normal(0, 1, n), "f2": rng.normal(0, 1, n), "period": "reference"})
    cur = pd.DataFrame({"f1": rng.normal(shift, 1, n), "f2": rng.normal(0, 1, n), "period": "current"})
    pdf = pd.concat([ref, cur], ignore_index=True)
    return pdf, spark.createDataFrame(pdf)


def _ks_numpy(a, b):
    v = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), v, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), v, side="right") / len(b)
    return np.max(np.abs(fa - fb))


def _psi_numpy(ref, cur, bins=10):
    edges = np.unique(np.percentile(ref, np.linspace(0, 100, bins + 1)))
    r = np.bincount(np.digitize(ref, edges[:-1]), minlength=len(edges)) / len(ref) + 1e-10
    c = np.bincount(np.digitize(cur, edges[:-1]), minlength=len(edges)) / len(cur) + 1e-10
    return float(np.sum((c - r) * np.log(c / r)))


def test_ks_statistic_matches_ecdf(spark):
    pdf, df = _two_samples(spark)
    got = {r.feature: r.ks_statistic for r in D.ks_statistics(df, ["f1", "f2"]).collect()}
    for f in ("f1", "f2"):
        exp = _ks_numpy(pdf[pdf.period == "reference"][f].to_numpy(), pdf[pdf.period == "current"][f].to_numpy())
        assert abs(got[f] - exp) < 1e-12


def test_ks_of_identical_samples_is_zero(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 2.0, 3.0] * 2, "period": ["reference"] * 4 + ["current"] * 4})
    r = D.ks_test(spark.createDataFrame(pdf), ["x"]).first()
    assert r.ks_statistic == 0 and r.p_value == 1.0 and not r.drift_detected


def test_shifted_feature_flags_drift(spark):
    _, df = _two_samples(spark, shift=1.0)
    res = {r.feature: r for r in D.ks_test(df, ["f1", "f2"]).collect()}
    assert res["f1"].drift_detected and res["f1"].p_value < 1e-6
    rep = D.drift_report(D.ks_test(df, ["f1", "f2"]), ["f1", "f2"]).first()
    assert rep.has_drift and "f1" in rep.drifted_features and rep.total_features == 2


def test_psi_matches_reference_binning(spark):
    pdf, df = _two_samples(spark)
    got = {r.feature: r.psi for r in D.psi(df, ["f1", "f2"]).collect()}
    for f in ("f1", "f2"):
        exp = _psi_numpy(pdf[pdf.period == "reference"][f].to_numpy(), pdf[pdf.period == "current"][f].to_numpy())
        assert abs(got[f] - exp) < 1e-9
    assert all(v >= 0 for v in got.values())


def test_psi_same_distribution_zero(spark):
    pdf = pd.DataFrame({"x": list(range(50)) * 2, "period": ["reference"] * 50 + ["current"] * 50})
    assert abs(D.psi(spark.createDataFrame(pdf), ["x"]).first().psi) < 1e-12


def test_hopping_windows_exclude_last_end(spark):
    df = spark.range(400).withColumnRenamed("id", "t")
    ends = sorted({r.window_end for r in W.hopping_windows(df, ["t"], 100).select("window_end").collect()})
    assert ends == list(range(100, 400, 50))  # 400 itself is not produced
    with pytest.raises(ValueError):
        W.hopping_windows(df, ["t"], 1)


def test_check_performance_two_sided_flag(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 18.0)], "actual double, predicted double")
    base = PM.baseline_frame(spark, {"rmse": 10.0, "mae": 2.0, "r2": 0.5})
    rows = {r.metric: r for r in PM.check_performance(df, base, "actual", "predicted").collect()}
    assert np.isclose(rows["rmse"].degradation_pct, -80.0) and rows["rmse"].is_degraded  # improvement counts too
    assert not rows["mae"].is_degraded and rows["mae"].degradation_detected


def test_retrain_decision_and_gate(spark):
    perf = spark.createDataFrame([(True,)], "degradation_detected boolean")
    drift = spark.createDataFrame([(True, 50.0)], "has_drift boolean, drift_percentage double")
    d = PM.retrain_decision(perf, drift).first()
    assert d.should_retrain and d.priority == "HIGH" and len(d.reasons) == 2
    g = PM.retrain_gate(PM.retrain_decision(perf, drift), F.lit("2024-01-01 00:00:00").cast("timestamp"),
                        F.lit("2024-01-01 06:00:00").cast("timestamp")).first()
    assert g.proceed  # HIGH priority ignores the 24 h cooldown


@pytest.mark.parametrize("shift", [0.0, 0.3])
def test_pruned_ks_equals_full_ecdf(spark, shift):
    pdf, df = _two_samples(spark, shift=shift, n=2000, seed=7)
    got = {r.feature: r.ks_statistic for r in D.ks_pruned(df, ["f1", "f2"], buckets=32).collect()}
    for f in ("f1", "f2"):
        exp = _ks_numpy(pdf[pdf.period == "reference"][f].to_numpy(), pdf[pdf.period == "current"][f].to_numpy())
        assert abs(got[f] - exp) < 1e-12


def test_large_run_counts_cells_instead_of_values(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for g in ("a", None):
        for i in range(600):
            x = float(rng.choice([np.inf, -np.inf, np.nan])) if i % 50 == 0 else float(rng.normal())
            day = None if i % 40 == 0 else "2024-02-20" if i % 3 == 0 else "2024-01-01"
            rows.append((g, day, x, float(rng.integers(0, 4)) if i % 7 else None, float(np.exp(20 * rng.normal()))))
    rows.append(("one period", "2024-02-20", 1.0, 1.0, 1.0))
    df = spark.createDataFrame(rows, "g string, day string, x double, k double, wide double").withColumn("day", F.to_date("day")).checkpoint()

    def run():
        return {(r["g"], r["feature_name"]): r for r in D.monitoring_run(df, ["x", "k", "wide"], "day", by=["g"]).collect()}

    counted = run()
    monkeypatch.setattr(D, "COUNTED_VALUES", 100)
    monkeypatch.setattr(D, "SWEPT_VALUES", 200)  # takes more than one round
    monkeypatch.setattr(D, "KS_CELLS", 60)
    monkeypatch.setattr(D, "period_counts", lambda *a, **k: pytest.fail("a table of all distinct values"))
    pruned = run()
    assert counted.keys() == pruned.keys() and len(counted) == 6
    for k, r in counted.items():
        assert abs(r["ks_statistic"] - pruned[k]["ks_statistic"]) < 1e-12 and abs(r["psi_score"] - pruned[k]["psi_score"]) < 1e-9
        assert (r["as_of"], r["drift_detected"], r["ks_pvalue"]) == (pruned[k]["as_of"], pruned[k]["drift_detected"], pruned[k]["ks_pvalue"])
