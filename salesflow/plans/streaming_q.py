"""Registered streaming queries (ST1-ST6): each equals its batch twin on the same input."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.plans.common import rounded, rsql, sig, sig_sql
from salesflow.plans.models_q import metric_sql
from salesflow.plans.registry import register
from salesflow.session import scratch_path
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import PREDICTIONS_SQL, with_views
from salesflow.streaming import jobs as J
from salesflow.streaming import stateful as ST

PRED = {"predictions": PREDICTIONS_SQL}


def _events_stream(spark, sf_dir, name, tie=None):
    src = J.stage_source(fx.table(spark, sf_dir, "events"), name, tie=tie)
    return J.read_stream(spark, src, files_per_trigger=J.files_for(spark, src))


@register("st1_ingest_gate", with_views("""
SELECT accepted, reasons, count(*) AS n_rows FROM (
  SELECT coalesce(CAST(actual_sales AS INTEGER) > 0, false) AND coalesce(predicted_sales > 0, false) AS accepted,
    CASE WHEN coalesce(CAST(actual_sales AS INTEGER) > 0, false) AND coalesce(predicted_sales > 0, false) THEN NULL
    ELSE array_to_string(list_filter([CASE WHEN coalesce(predicted_sales > 0, false) THEN NULL ELSE 'price must be > 0' END,
      CASE WHEN coalesce(CAST(actual_sales AS INTEGER) > 0, false) THEN NULL ELSE 'quantity must be > 0' END],
      lambda x: x IS NOT NULL), ';') END AS reasons
  FROM predictions) GROUP BY accepted, reasons""", **PRED), ("ST1", "Q18"))
def ingest_gate(spark, sf_dir):
    s = J.as_predictions(_events_stream(spark, sf_dir, "st1")).select(
        "prediction_id", F.to_date("timestamp").alias("date"), "region",
        F.col("product").cast("string").alias("product"), F.col("predicted_sales").alias("price"),
        F.col("actual_sales").cast("int").alias("quantity"))
    good, bad = scratch_path(spark, "st1-good"), scratch_path(spark, "st1-bad")
    J.ingest_with_gate(s, good, bad, scratch_path(spark, "st1-ckpt"))
    g = spark.read.parquet(good).select(F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reasons"))
    b = spark.read.parquet(bad).select(F.lit(False).alias("accepted"), "reasons")
    return g.unionByName(b).groupBy("accepted", "reasons").agg(F.count(F.lit(1)).alias("n_rows"))


@register("st2_daily_windows", with_views(f"""
SELECT time_bucket(INTERVAL 1 DAY, "timestamp") AS window_start,
  time_bucket(INTERVAL 1 DAY, "timestamp") + INTERVAL 1 DAY AS window_end, count(*) AS count,
  {rsql('sum(predicted_sales)', 2)} AS total, min(predicted_sales) AS min_value, max(predicted_sales) AS max_value
FROM predictions GROUP BY 1, 2
HAVING time_bucket(INTERVAL 1 DAY, "timestamp") + INTERVAL 1 DAY <= (SELECT max("timestamp") FROM predictions) - INTERVAL 1 HOUR""",
                                          **PRED), ("ST2", "A19"))
def daily_windows(spark, sf_dir):
    s = J.as_predictions(_events_stream(spark, sf_dir, "st2"))
    out = scratch_path(spark, "st2-out")
    J.windowed_counts(s, out, scratch_path(spark, "st2-ckpt"))
    return rounded(spark.read.parquet(out), money=("total",))


@register("st3_sliding_metrics", with_views(f"""
WITH w AS (SELECT p.*, time_bucket(INTERVAL 1 DAY, "timestamp") - k * INTERVAL 1 DAY AS window_start
           FROM predictions p, (SELECT unnest([0, 1]) AS k))
SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, count(*) AS n,
  {rsql('sqrt(avg((actual_sales - predicted_sales) * (actual_sales - predicted_sales)))')} AS rmse,
  {rsql('avg(abs(actual_sales - predicted_sales))')} AS mae,
  {sig_sql('avg(abs(actual_sales - predicted_sales) / greatest(abs(actual_sales), 2.220446049250313e-16)) * 100', 9)} AS mape,
  {rsql('1 - sum((actual_sales - predicted_sales) * (actual_sales - predicted_sales)) / (count(*) * var_pop(actual_sales))')} AS r2
FROM w GROUP BY window_start
HAVING window_start + INTERVAL 2 DAY <= (SELECT max("timestamp") FROM predictions) - INTERVAL 1 HOUR""", **PRED),
          ("ST3", "PM2"))
def sliding_metrics(spark, sf_dir):
    s = J.as_predictions(_events_stream(spark, sf_dir, "st3"))
    out = scratch_path(spark, "st3-out")
    J.sliding_error_metrics(s, out, scratch_path(spark, "st3-ckpt"))
    r = spark.read.parquet(out)
    return rounded(r, cols=["rmse", "mae", "r2"]).withColumn("mape", sig("mape", 9))


@register("st3_row_windows", with_views(f"""
WITH i AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp", prediction_id) - 1 AS idx FROM predictions),
n AS (SELECT region, count(*) AS n FROM predictions GROUP BY region),
k AS (SELECT region, unnest(range(0, greatest((n - 1 - 100) // 50 + 1, 0))) AS window_id FROM n WHERE n > 100),
w AS (SELECT k.window_id, i.* FROM k JOIN i ON i.region = k.region AND i.idx >= k.window_id * 50 AND i.idx < 100 + k.window_id * 50)
SELECT region, window_id, 100 + window_id * 50 AS row_index, {metric_sql('actual_sales', 'predicted_sales')},
  arg_max("timestamp", idx) AS "timestamp" FROM w GROUP BY region, window_id""", **PRED), ("ST3", "PM2"))
def row_windows(spark, sf_dir):
    """The hopping row windows of PM2 for each region, from a stream."""
    s = J.as_predictions(_events_stream(spark, sf_dir, "st3-rows", tie="event_id"))
    out = scratch_path(spark, "st3-rows-out")
    ST.row_windows(s, "region", 100, out, scratch_path(spark, "st3-rows-ckpt"))
    return rounded(spark.read.parquet(out), cols=["rmse", "mae", "r2"]).withColumn("mape", sig("mape", 9))


@register("st4_dedupe_keys", with_views("SELECT DISTINCT region, product FROM predictions", **PRED), ("ST4", "U2"))
def dedupe_keys(spark, sf_dir):
    s = J.as_predictions(_events_stream(spark, sf_dir, "st4"))
    out = scratch_path(spark, "st4-out")
    J.dedupe_within_watermark(s, ["region", "product"], out, scratch_path(spark, "st4-ckpt"))
    return spark.read.parquet(out).select("region", "product")


@register("st5_stream_scoring", with_views(f"""
SELECT prediction_id, {rsql('(SELECT regr_intercept(actual_sales, predicted_sales) FROM predictions) + (SELECT regr_slope(actual_sales, predicted_sales) FROM predictions) * predicted_sales', 4)} AS predicted
FROM predictions""", **PRED), ("ST5", "M11"))
def stream_scoring(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from salesflow.operators.models import make_estimator
    batch = fx.predictions(spark, sf_dir).withColumn("label", F.col("actual_sales"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["predicted_sales"], outputCol="features"),
                            make_estimator("linear")])
    model_path = scratch_path(spark, "st5-model")
    pipe.fit(batch).write().overwrite().save(model_path)
    s = J.as_predictions(_events_stream(spark, sf_dir, "st5"))
    out = scratch_path(spark, "st5-out")
    J.score_stream(s, model_path, out, scratch_path(spark, "st5-ckpt"), "prediction_id")
    return rounded(spark.read.parquet(out), 4)


@register("st5_versioned_scoring", with_views(f"""
WITH e AS (SELECT min(prediction_id) AS lo, max(prediction_id) AS hi FROM predictions),
c AS (SELECT regr_slope(actual_sales, predicted_sales) AS b, regr_intercept(actual_sales, predicted_sales) AS a FROM predictions)
SELECT prediction_id, CASE WHEN prediction_id * 2 <= lo + hi THEN 1 ELSE 2 END AS model_version,
  {rsql('CASE WHEN prediction_id * 2 <= lo + hi THEN (SELECT a + b * predicted_sales FROM c) ELSE (SELECT avg(actual_sales) FROM predictions) END', 4)} AS predicted
FROM predictions, e""", **PRED), ("ST5", "M10"))
def versioned_scoring(spark, sf_dir):
    """The first half of the ids is scored before version 2 is promoted, the other half after it."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    from salesflow.operators import models as M
    batch = fx.predictions(spark, sf_dir).withColumn("label", F.col("actual_sales"))
    models = scratch_path(spark, "st5v-models")
    line = Pipeline(stages=[VectorAssembler(inputCols=["predicted_sales"], outputCol="features"), M.make_estimator("linear")])
    line.fit(batch).write().overwrite().save(f"{models}/sales/1")
    mean = Pipeline(stages=[SQLTransformer(statement="SELECT *, 0.0 AS zero FROM __THIS__"), VectorAssembler(inputCols=["zero"], outputCol="features"),
                            M.make_estimator("linear")])
    mean.fit(batch).write().overwrite().save(f"{models}/sales/2")
    versions = spark.createDataFrame([("sales", 1, "Production"), ("sales", 2, "Staging")], "name string, version int, stage string")
    table, out, ckpt = (scratch_path(spark, f"st5v-{n}") for n in ("versions", "out", "ckpt"))
    versions.write.parquet(table)
    lo, hi = batch.agg(F.min("prediction_id"), F.max("prediction_id")).first()
    early = F.col("event_id") * 2 <= lo + hi
    events = fx.table(spark, sf_dir, "events")
    src = J.stage_source(events.where(early), "st5v")
    run = lambda: J.score_following_versions(J.as_predictions(J.read_stream(spark, src)), table, models, "sales", out, ckpt, "prediction_id")
    run()
    M.transition(versions, "sales", 2, "Production", archive_existing=True).write.mode("overwrite").parquet(table)
    events.where(~early).write.mode("append").parquet(src)
    run()
    return rounded(spark.read.parquet(out).select("prediction_id", "model_version", "predicted"), 4)


@register("st6_latest_status", with_views(f"""
SELECT feature_name, "timestamp", {rsql('drift_score')} AS drift_score, drift_detected FROM (
  SELECT event_type AS feature_name, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp", value / 500.0 AS drift_score,
         value > 250 AS drift_detected, event_id FROM events)
QUALIFY row_number() OVER (PARTITION BY feature_name ORDER BY "timestamp" DESC, event_id DESC) = 1"""),
          ("ST6", "P10", "A20"))
def latest_status(spark, sf_dir):
    s = _events_stream(spark, sf_dir, "st6").select(
        F.col("event_id").alias("metric_id"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_type").alias("feature_name"), (F.col("value") / 500.0).alias("drift_score"),
        (F.col("value") > 250).alias("drift_detected"))
    out = scratch_path(spark, "st6-out")
    J.latest_status(s, "feature_name", "timestamp", "metric_id", out, scratch_path(spark, "st6-ckpt"))
    return rounded(J.read_latest(spark, out))


@register("st6_status_updates", with_views(f"""
SELECT feature_name, "timestamp", {rsql('drift_score')} AS drift_score, drift_detected FROM (
  SELECT event_type AS feature_name, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp", value / 500.0 AS drift_score,
         value > 250 AS drift_detected, event_id FROM events)
QUALIFY row_number() OVER (PARTITION BY feature_name ORDER BY "timestamp" DESC, event_id DESC) = 1"""), ("ST6", "P10"))
def status_updates(spark, sf_dir):
    """The current status kept in update mode, changed keys merged into the table."""
    s = _events_stream(spark, sf_dir, "st6-updates").select(
        F.col("event_id").alias("metric_id"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_type").alias("feature_name"), (F.col("value") / 500.0).alias("drift_score"),
        (F.col("value") > 250).alias("drift_detected"))
    out = scratch_path(spark, "st6-updates-out")
    ST.current_status(s, "feature_name", "timestamp", "metric_id", out, scratch_path(spark, "st6-updates-ckpt"))
    return rounded(ST.read_status(spark, out))
