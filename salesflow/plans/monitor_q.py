"""Registered monitoring queries (PM1-PM7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import drift as D
from salesflow.operators import models as M
from salesflow.operators import monitor as PM
from salesflow.operators.relational import label_period, recent
from salesflow.plans.common import max_literal, max_scalar, rounded, rsql, sales, sig
from salesflow.plans.drift_q import FEATURES, _with
from salesflow.plans.models_q import metric_sql
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import ALERTS_SQL, PREDICTIONS_SQL, with_views

PRED = {"predictions": PREDICTIONS_SQL}
BASE = PM.DEFAULT_BASELINE


def _perf(spark, sf_dir, by=()):
    p = fx.predictions(spark, sf_dir)
    base = PM.baseline_frame(spark, BASE)
    return PM.check_performance(p, base, "actual_sales", "predicted_sales", max_literal(p, "timestamp"), 7, by=by)


def _perf_sql(by=()):
    keys = "".join(f"{b}, " for b in by)
    grp = f"GROUP BY {', '.join(by)}" if by else ""
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    base = " UNION ALL ".join(f"SELECT '{k}' AS metric, CAST({v} AS DOUBLE) AS baseline" for k, v in BASE.items())
    return with_views(f"""
WITH r AS (SELECT * FROM predictions WHERE "timestamp" >= (SELECT max("timestamp") FROM predictions) - INTERVAL 7 DAY),
m AS (SELECT {keys}count(*) AS sample_size, sqrt(avg((actual_sales - predicted_sales) * (actual_sales - predicted_sales))) AS rmse,
        avg(abs(actual_sales - predicted_sales)) AS mae,
        1 - sum((actual_sales - predicted_sales) * (actual_sales - predicted_sales)) / (count(actual_sales) * var_pop(actual_sales)) AS r2
      FROM r {grp}),
l AS (SELECT {keys}sample_size, 'rmse' AS metric, rmse AS current FROM m UNION ALL
      SELECT {keys}sample_size, 'mae', mae FROM m UNION ALL SELECT {keys}sample_size, 'r2', r2 FROM m),
b AS ({base}),
c AS (SELECT l.*, b.baseline, CASE WHEN b.baseline <> 0 THEN (current - b.baseline) / abs(b.baseline) * 100 ELSE 0.0 END
        AS degradation_pct FROM l JOIN b USING (metric))
SELECT {keys}metric, sample_size, {rsql('current')} AS current, baseline, {rsql('degradation_pct')} AS degradation_pct,
  abs(degradation_pct) > 10 AS is_degraded,
  bool_or(abs(degradation_pct) > 10 AND metric IN ('rmse', 'mae', 'mape')) OVER ({part}) AS degradation_detected
FROM c""", **PRED)


@register("pm1_check_performance", _perf_sql(), ("PM1", "P3"))
def check_performance(spark, sf_dir):
    return rounded(_perf(spark, sf_dir), cols=["current", "degradation_pct"])


@register("pm1_performance_by_region", _perf_sql(("region",)), ("PM1",))
def performance_by_region(spark, sf_dir):
    return rounded(_perf(spark, sf_dir, ["region"]), cols=["current", "degradation_pct"])


@register("pm2_performance_trend", with_views(f"""
WITH i AS (SELECT *, row_number() OVER (ORDER BY "timestamp", prediction_id) - 1 AS idx FROM predictions),
n AS (SELECT count(*) AS n FROM predictions),
k AS (SELECT unnest(range(0, (SELECT (n - 1 - 100) // 50 + 1 FROM n))) AS window_id),
w AS (SELECT k.window_id, i.* FROM k JOIN i ON i.idx >= k.window_id * 50 AND i.idx < 100 + k.window_id * 50)
SELECT window_id, 100 + window_id * 50 AS row_index, {metric_sql('actual_sales', 'predicted_sales')},
  arg_max("timestamp", idx) AS "timestamp" FROM w GROUP BY window_id""", **PRED), ("PM2", "W5"))
def performance_trend(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    t = PM.performance_trend(p, "actual_sales", "predicted_sales", ["timestamp", "prediction_id"], 100)
    return rounded(t, cols=["rmse", "mae", "r2"]).withColumn("mape", sig("mape", 9))


# PM3 / PM4 / PM6 / PM7 combine the predictions performance report with the drift report on sales
def _labelled(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", *FEATURES])
    return label_period(s, "date", max_scalar(s, "date"), 30)


def _report(spark, sf_dir, counts=None):
    ks = D.ks_test(_labelled(spark, sf_dir), FEATURES, "period", counts=counts)
    return D.drift_report(ks, FEATURES)


def _drift(spark, sf_dir):
    lab = _labelled(spark, sf_dir)
    counts = D.period_counts(lab, FEATURES, "period")  # one pass over the data for both tests
    return _report(spark, sf_dir, counts), D.psi(lab, FEATURES, "period", counts=counts)


_REPORT_SQL = _with(f"""SELECT count(*) FILTER (WHERE p_value < 0.05) > 0 AS has_drift,
  count(*) FILTER (WHERE p_value < 0.05) * 100.0 / {len(FEATURES)} AS drift_percentage,
  coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE p_value < 0.05)), ','), '') AS drifted_features,
  count(*) FILTER (WHERE p_value < 0.05) AS drift_count FROM kp""")
_PSI_SQL = _with("SELECT feature, psi FROM ps", parts=("psi",))
_DECISION_SQL = f"""
SELECT degradation_detected, has_drift, drift_percentage,
  array_to_string(list_filter([CASE WHEN degradation_detected THEN 'performance_degradation' END,
    CASE WHEN has_drift AND drift_percentage > 20 THEN 'significant_data_drift' END], lambda x: x IS NOT NULL), ',') AS reasons,
  degradation_detected OR (has_drift AND drift_percentage > 20) AS should_retrain,
  CASE WHEN degradation_detected OR (has_drift AND drift_percentage > 20) THEN 'HIGH' ELSE 'LOW' END AS priority
FROM (SELECT bool_or(degradation_detected) AS degradation_detected FROM ({_perf_sql()})), ({_REPORT_SQL})"""


def _decision(spark, sf_dir):
    return PM.retrain_decision(_perf(spark, sf_dir), _report(spark, sf_dir))


@register("pm3_retrain_decision", _DECISION_SQL, ("PM3",))
def retrain_decision(spark, sf_dir):
    d = _decision(spark, sf_dir)
    return rounded(d.select("degradation_detected", "has_drift", "drift_percentage",
                            F.array_join("reasons", ",").alias("reasons"), "should_retrain", "priority"))


@register("pm4_alerts", f"""
SELECT 'DATA_DRIFT' AS alert_type, CASE WHEN drift_percentage > 30 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
  'Data drift detected in ' || drift_count || ' features' AS message, drifted_features AS subject
FROM ({_REPORT_SQL}) WHERE has_drift
UNION ALL
SELECT 'HIGH_PSI', CASE WHEN psi > 0.3 THEN 'HIGH' ELSE 'MEDIUM' END, 'High PSI score for ' || feature || ': ' ||
  printf('%.4f', psi), feature FROM ({_PSI_SQL}) WHERE psi > 0.2
UNION ALL
SELECT 'PERFORMANCE_DEGRADATION', 'HIGH', 'Model performance has degraded', NULL
FROM (SELECT bool_or(degradation_detected) AS d FROM ({_perf_sql()})) WHERE d""", ("PM4", "U3"))
def alerts(spark, sf_dir):
    rep, psi = _drift(spark, sf_dir)
    a = PM.generate_alerts(rep, psi, _perf(spark, sf_dir), F.lit(None).cast("timestamp"))
    return a.select("alert_type", "severity", "message", "subject")


@register("pm5_open_alerts_by_type", with_views("""
SELECT * FROM alerts WHERE NOT resolved QUALIFY row_number() OVER (PARTITION BY alert_type
  ORDER BY CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 WHEN 'info' THEN 1 END DESC, "timestamp" DESC, alert_id DESC) <= 3""",
                                          alerts=ALERTS_SQL), ("PM5", "W8"))
def open_alerts_by_type(spark, sf_dir):
    return PM.open_alerts(fx.alerts(spark, sf_dir), 3, by_rank=True, by=["alert_type"])


@register("pm5_open_alerts", with_views("""
SELECT * FROM alerts WHERE NOT resolved ORDER BY severity DESC, "timestamp" DESC, alert_id DESC LIMIT 10""",
                                        alerts=ALERTS_SQL), ("PM5",))
def open_alerts(spark, sf_dir):
    return PM.open_alerts(fx.alerts(spark, sf_dir), 10)


@register("pm6_retrain_gate", f"""
SELECT should_retrain, priority, CAST(12.0 AS DOUBLE) AS hours_since_training,
  should_retrain AND (12.0 >= 24 OR priority = 'HIGH') AS proceed FROM ({_DECISION_SQL})""", ("PM6", "S6"))
def retrain_gate(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    now = max_scalar(p, "timestamp")
    last = now - F.expr("INTERVAL 12 HOURS")
    g = PM.retrain_gate(_decision(spark, sf_dir), last, now)
    return g.select("should_retrain", "priority", F.col("hours_since_training").cast("double"), "proceed")


@register("pm7_monitoring_summary", f"""
WITH r AS (SELECT * FROM ({PREDICTIONS_SQL}) WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY)
SELECT d.has_drift, {rsql('d.drift_percentage')} AS drift_percentage, d.drifted_features,
  (SELECT bool_or(degradation_detected) FROM ({_perf_sql()})) AS degradation_detected,
  (SELECT count(*) FROM (SELECT 1 FROM ({_REPORT_SQL}) WHERE has_drift
     UNION ALL SELECT 1 FROM ({_PSI_SQL}) WHERE psi > 0.2
     UNION ALL SELECT 1 FROM (SELECT bool_or(degradation_detected) AS x FROM ({_perf_sql()})) WHERE x)) AS alert_count,
  m.current_rmse, m.current_mae, m.current_r2, m.current_mape, (SELECT max(ts) FROM events) AS "timestamp"
FROM ({_REPORT_SQL}) d, (SELECT {metric_sql('actual_sales', 'predicted_sales', prefix='current_')} FROM r) m""", ("PM7",))
def monitoring_summary(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    as_of = max_literal(p, "timestamp")
    rep, psi = _drift(spark, sf_dir)
    perf = _perf(spark, sf_dir)
    al = PM.generate_alerts(rep, psi, perf, as_of)
    cur = M.regression_metrics(recent(p, "timestamp", as_of, 7), "actual_sales", "predicted_sales")
    s = PM.monitoring_summary(as_of, rep, perf, al, cur)
    s = rounded(s, cols=["drift_percentage", "current_rmse", "current_mae", "current_r2"])
    return s.withColumn("current_mape", sig("current_mape", 9))
