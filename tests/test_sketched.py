import math
import random

from pyspark.sql import functions as F

from salesflow.operators import drift as D
from salesflow.operators import models as M
from salesflow.operators import sketched as SK
from salesflow.session import scratch_path


def frame(spark):
    """Two months: ``shifted`` drifts by far, ``same`` not at all, ``edge`` a little; a group of its own for NULL."""
    r, rows = random.Random(11), []
    for i in range(4000):
        late = i >= 2000
        day = f"2024-0{2 if late else 1}-{1 + i % 28:02d}"
        rows.append((day, r.choice(["a", "a", None]), r.gauss(2.0 * late, 1), r.random(), r.gauss(0.07 * late, 1), r.gauss(100, 5), r.gauss(100, 5) if i % 50 else None))
    return spark.createDataFrame(rows, "date string, g string, shifted double, same double, edge double, y double, p double").withColumn("date", F.to_date("date"))


FEATURES = ["shifted", "same", "edge"]


def decisions(df, by=()):
    run = D.monitoring_run(df, FEATURES, "date", as_of=F.lit("2024-02-28").cast("date"), days=27, threshold=0.01, by=list(by))
    return {(*(r[b] for b in by), r["feature_name"]): (r["drift_detected"], r["psi_score"] > D.PSI_SIGNIFICANT) for r in run.collect()}


def test_decisions_equal_the_exact_run(spark):
    df = frame(spark)
    for by in ((), ("g",)):
        for k in (SK.SKETCH_K, 20_000):
            out = SK.monitoring_run(df, SK.daily_summaries(df, FEATURES, by=by, k=k), FEATURES, "2024-02-28", days=27, threshold=0.01, by=by, k=k).collect()
            assert {(*(r[b] for b in by), r["feature_name"]): (r["drift_detected"], r["psi_significant"]) for r in out} == decisions(df, by)
            settled = {r["feature_name"] for r in out if not r["exact"]}
            assert "shifted" in settled  # decided by the sketches alone
        assert by or "same" in settled  # finer sketches settle more


def test_bounds_hold_the_exact_values(spark):
    df = frame(spark)
    b = SK.bounds(SK._windows(SK.daily_summaries(df, FEATURES, k=200), "2024-02-28", 27, [], 200), SK.rank_error(200)).collect()
    run = {r["feature_name"]: r for r in D.monitoring_run(df, FEATURES, "date", as_of=F.lit("2024-02-28").cast("date"), days=27).collect()}
    for r in b:
        exact = run[r["feature"]]
        assert r["ks_low"] <= exact["ks_statistic"] <= r["ks_high"] and r["psi_low"] <= exact["psi_score"] <= r["psi_high"]


def test_a_second_update_reads_the_new_days_only(spark):
    df = frame(spark)
    path, seen = scratch_path(spark, "summaries"), []

    def summarise(part):
        seen.append(sorted({str(r[0]) for r in part.select("date").distinct().collect()}))
        return SK.daily_summaries(part, FEATURES)

    assert SK.update(df.where("date <= '2024-02-27'"), path, summarise) == 55
    assert SK.update(df, path, summarise) == 1 and seen[1] == ["2024-02-28"]
    assert SK.update(df, path, summarise) == 0 and len(seen) == 2
    stored = SK.stored(spark, path)
    assert stored.agg(F.sum("n")).first()[0] == 3 * 4000 and stored.select("day", "feature").distinct().count() == 56 * 3


def test_error_sums_give_the_metrics(spark):
    df = frame(spark)
    path = scratch_path(spark, "errors")
    for upto in ("2024-01-20", "2024-02-28"):
        SK.update(df.where(F.col("date") <= upto), path, lambda part: SK.daily_errors(part, "y", "p", by=["g"]))
    got = {r["g"]: r for r in SK.metrics_of(SK.stored(spark, path), ["g"]).collect()}
    for want in M.regression_metrics(df, "y", "p", by=["g"]).collect():
        assert got[want["g"]]["n"] == want["n"] and all(math.isclose(got[want["g"]][m], want[m], rel_tol=1e-9) for m in ("rmse", "mae", "r2", "mape"))
