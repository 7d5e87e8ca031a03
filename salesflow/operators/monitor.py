"""Performance monitoring, alerts and retrain decisions (PM1-PM7).

Metrics over the data are single aggregations (optionally grouped with
``by``); everything after that works on report frames with one row per group
or per metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.operators import windows as W
from salesflow.operators.blocks import attach, null_safe_join
from salesflow.operators.models import metric_exprs
from salesflow.operators.relational import recent, recent_rows

# Default baseline metrics of the reference monitoring job.
DEFAULT_BASELINE = {"rmse": 100.0, "mae": 80.0, "r2": 0.85}
# Degradation threshold (10 %), metrics that drive the overall flag,
# retrain drift share (20 %), DATA_DRIFT HIGH above 30 %, HIGH_PSI above 0.2
# (HIGH above 0.3), retrain cooldown 24 h.
DEGRADATION_PCT = 10.0
FLAG_METRICS = ("rmse", "mae", "mape")
RETRAIN_DRIFT_PCT = 20.0
DRIFT_HIGH_PCT = 30.0
PSI_ALERT, PSI_HIGH = 0.2, 0.3
COOLDOWN_HOURS = 24
METRICS = ("rmse", "mae", "r2", "mape")


def baseline_frame(spark, baseline: dict) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in baseline.items()], "metric string, baseline double")


# PM1 --------------------------------------------------------------------------------------------
def check_performance(df: DataFrame, baseline: DataFrame, actual: str, predicted: str, as_of=None,
                      window_days: int = 7, ts: str = "timestamp", by=(), one_sided: bool = False,
                      order=None) -> DataFrame:
    """Per (group, metric): current, baseline, degradation_pct, is_degraded, degradation_detected.

    ``as_of`` defaults to the newest timestamp. Without a ``ts`` column the last
    ``window_days * 100`` rows in ``order`` count (all rows without an order). A baseline with the ``by`` columns
    holds one value for each group.
    """
    by = list(by)
    if ts in df.columns:
        cur = recent(df, ts, as_of, window_days)
    else:
        cur = recent_rows(df, order, window_days) if order else df
    m = cur.groupBy(*by).agg(*metric_exprs(actual, predicted))
    long = m.unpivot(by + ["n"], list(METRICS), "metric", "current").withColumnRenamed("n", "sample_size")
    j = null_safe_join(long, baseline, [b for b in by if b in baseline.columns] + ["metric"])
    pct = F.when(F.col("baseline") != 0, (F.col("current") - F.col("baseline")) / F.abs(F.col("baseline")) * 100) \
        .otherwise(F.lit(0.0))
    degraded = (pct > DEGRADATION_PCT) if one_sided else (F.abs(pct) > DEGRADATION_PCT)
    out = j.withColumn("degradation_pct", pct).withColumn("is_degraded", degraded)
    w = Window.partitionBy(*by)  # a handful of metric rows per group
    flag = F.bool_or(F.col("is_degraded") & F.col("metric").isin(*FLAG_METRICS)).over(w)
    return out.withColumn("degradation_detected", flag)


# PM2 --------------------------------------------------------------------------------------------
def performance_trend(df: DataFrame, actual: str, predicted: str, order, window_size: int = 100,
                      ts: str | None = "timestamp", by=()) -> DataFrame:
    """M6 over hopping row windows (size n, step n // 2), labelled by last timestamp and end index."""
    by = list(by)
    h = W.hopping_windows(df, order, window_size, by=by)
    aggs = metric_exprs(actual, predicted)
    if ts:
        aggs.append(F.max_by(F.col(ts), F.col("row_idx")).alias("timestamp"))
    return h.groupBy(*by, "window_id", F.col("window_end").alias("row_index")).agg(*aggs)


# PM3 --------------------------------------------------------------------------------------------
def retrain_decision(perf: DataFrame, drift: DataFrame | None = None, by=()) -> DataFrame:
    """should_retrain, reasons[], priority from a performance report and a drift report."""
    by = list(by)
    p = perf.groupBy(*by).agg(F.bool_or("degradation_detected").alias("degradation_detected"))
    if drift is not None:
        p = null_safe_join(p, drift.select(*by, "has_drift", "drift_percentage"), by, "left") if by else \
            attach(p, drift.select("has_drift", "drift_percentage"))
    else:
        p = p.withColumn("has_drift", F.lit(False)).withColumn("drift_percentage", F.lit(0.0))
    reasons = F.array_compact(F.array(
        F.when(F.col("degradation_detected"), F.lit("performance_degradation")),
        F.when(F.coalesce(F.col("has_drift"), F.lit(False)) & (F.col("drift_percentage") > RETRAIN_DRIFT_PCT),
               F.lit("significant_data_drift"))))
    return p.withColumn("reasons", reasons).withColumn("should_retrain", F.size("reasons") > 0) \
        .withColumn("priority", F.when(F.col("should_retrain"), F.lit("HIGH")).otherwise(F.lit("LOW")))


# PM4 --------------------------------------------------------------------------------------------
def generate_alerts(drift_report: DataFrame, psi_scores: DataFrame, perf: DataFrame, ts: Column, by=()) -> DataFrame:
    """DATA_DRIFT, HIGH_PSI (one per feature) and PERFORMANCE_DEGRADATION alert rows, for each ``by`` group."""
    # the messages are fixed values of the alert format
    dd = drift_report.where(F.col("has_drift")).select(
        *by, F.lit("DATA_DRIFT").alias("alert_type"),
        F.when(F.col("drift_percentage") > DRIFT_HIGH_PCT, F.lit("HIGH")).otherwise(F.lit("MEDIUM")).alias("severity"),
        F.concat(F.lit("Data drift detected in "), F.col("drift_count").cast("string"), F.lit(" features"))
        .alias("message"), F.col("drifted_features").alias("subject"))
    hp = psi_scores.where(F.col("psi") > PSI_ALERT).select(
        *by, F.lit("HIGH_PSI").alias("alert_type"),
        F.when(F.col("psi") > PSI_HIGH, F.lit("HIGH")).otherwise(F.lit("MEDIUM")).alias("severity"),
        F.concat(F.lit("High PSI score for "), F.col("feature"), F.lit(": "), F.format_number("psi", 4))
        .alias("message"), F.col("feature").alias("subject"))
    degraded = perf.groupBy(*by).agg(F.bool_or("degradation_detected").alias("degradation_detected"))
    pd_ = degraded.where(F.col("degradation_detected")).select(
        *by, F.lit("PERFORMANCE_DEGRADATION").alias("alert_type"), F.lit("HIGH").alias("severity"),
        F.lit("Model performance has degraded").alias("message"), F.lit(None).cast("string").alias("subject"))
    return dd.unionByName(hp).unionByName(pd_).withColumn("timestamp", ts).withColumn("resolved", F.lit(False))


# PM5 --------------------------------------------------------------------------------------------
SEVERITY_RANK = {"critical": 3, "warning": 2, "info": 1, "HIGH": 3, "MEDIUM": 2, "LOW": 1}


def open_alerts(alerts: DataFrame, n: int = 10, by_rank: bool = False, by=()) -> DataFrame:
    """Unresolved alerts, severity desc (as text, like the reference; or by rank), newest first; ``n`` in all or for each ``by`` group."""
    sev = F.col("severity")
    if by_rank:
        m = F.create_map(*[x for k, v in SEVERITY_RANK.items() for x in (F.lit(k), F.lit(v))])
        sev = F.element_at(m, F.col("severity"))
    order = [sev.desc(), F.col("timestamp").desc(), F.col("alert_id").desc()]
    rows = alerts.where(~F.col("resolved"))
    if not by:
        return rows.orderBy(*order).limit(n)
    w = Window.partitionBy(*by).orderBy(*order)  # at most n rows of a group leave a task (WindowGroupLimit)
    return rows.withColumn("_sf_rn", F.row_number().over(w)).where(F.col("_sf_rn") <= n).drop("_sf_rn")


# PM6 --------------------------------------------------------------------------------------------
def retrain_gate(decision: DataFrame, last_training: Column, now: Column, cooldown_hours: float = COOLDOWN_HOURS) -> DataFrame:
    """Proceed if retraining is requested and (>= ``cooldown_hours`` since last training, or HIGH priority)."""
    hours = F.timestamp_diff("SECOND", last_training, now) / 3600.0
    cooled = last_training.isNull() | (hours >= cooldown_hours) | (F.col("priority") == "HIGH")
    return decision.withColumn("hours_since_training", hours).withColumn(
        "proceed", F.col("should_retrain") & cooled)


# PM7 --------------------------------------------------------------------------------------------
def monitoring_summary(ts: Column, drift_report: DataFrame, perf: DataFrame, alerts: DataFrame,
                       current_metrics: DataFrame, by=()) -> DataFrame:
    """One row (for each ``by`` group): timestamp, drift summary, degradation flag, alert count, current metrics.

    Without groups every input is a one-row report, attached as scalar subqueries;
    with groups they are joined on the group, a group without alerts counting none.
    """
    by = list(by)
    if by:
        flag = perf.groupBy(*by).agg(F.coalesce(F.bool_or("degradation_detected"), F.lit(False)).alias("degradation_detected"))
        count = alerts.groupBy(*by).agg(F.count(F.lit(1)).alias("alert_count"))
        cur = current_metrics.select(*by, *[F.col(m).alias(f"current_{m}") for m in METRICS])
        out = drift_report.select(*by, "has_drift", "drift_percentage", "drifted_features")
        for part in (flag, count, cur):
            out = null_safe_join(out, part, by, "left")
        return out.withColumn("alert_count", F.coalesce("alert_count", F.lit(0).cast("long"))).withColumn("timestamp", ts)
    flag = perf.agg(F.coalesce(F.bool_or("degradation_detected"), F.lit(False)).alias("degradation_detected"))
    cur = current_metrics.select(*[F.col(m).alias(f"current_{m}") for m in METRICS])
    ac = alerts.agg(F.count(F.lit(1)).alias("alert_count"))
    d = drift_report.select("has_drift", "drift_percentage", "drifted_features")
    out = d
    for part in (flag, ac, cur):
        out = attach(out, part)
    return out.withColumn("timestamp", ts)
