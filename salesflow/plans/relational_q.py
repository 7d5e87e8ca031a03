"""Registered projection / filter / top-N / join / union queries (P*, J*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.functions.exprs import SEASONS
from salesflow.operators import relational as R
from salesflow.plans.common import max_literal, max_scalar, rounded, rsql, sales
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import ALERTS_SQL, PREDICTIONS_SQL, sales_sql, with_views

SALES = {"sales": sales_sql()}
PRED = {"predictions": PREDICTIONS_SQL}
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)


@register("p1_features_target", with_views(f"""
SELECT {KEY_SQL}, {', '.join(c for c in fx.FEATURE_COLS)}, sales AS target FROM sales""", **SALES), ("P1",))
def features_target(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + list(fx.FEATURE_COLS) + ["sales", "date"])
    return R.split_features_target(s, "sales", key=KEY, drop=("date",))


@register("p2_diagonal_range", with_views("""
SELECT least(min(sales), min(predicted)) AS range_min, greatest(max(sales), max(predicted)) AS range_max,
       count(*) AS n_points FROM sales""", **SALES), ("P2",))
def diagonal_range(spark, sf_dir):
    return R.diagonal_range(sales(spark, sf_dir, ["sales", "predicted"]), "sales", "predicted")


@register("p3_recent_7d", with_views("""
SELECT * FROM predictions WHERE "timestamp" >= (SELECT max("timestamp") FROM predictions) - INTERVAL 7 DAY""",
                                     **PRED), ("P3",))
def recent_7d(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    return R.recent(p, "timestamp", max_literal(p, "timestamp"), 7)


@register("p4_latest_1000", with_views("""
SELECT * FROM predictions ORDER BY "timestamp" DESC, prediction_id LIMIT 1000""", **PRED), ("P4",))
def latest_1000(spark, sf_dir):
    return R.top_n(fx.predictions(spark, sf_dir), "timestamp", 1000, tiebreak=("prediction_id",))


@register("p5_period_split", with_views(f"""
SELECT CASE WHEN date >= (SELECT max(date) FROM sales) - INTERVAL 30 DAY THEN 'current' ELSE 'reference' END
         AS period, count(*) AS n_rows, {rsql('sum(sales)', 2)} AS total
FROM sales GROUP BY 1""", **SALES), ("P5",))
def period_split(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "sales"])
    lab = R.label_period(s, "date", max_scalar(s, "date"), 30)
    return rounded(lab.groupBy("period").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("total")),
                   money=("total",))


@register("p6_top_categories", with_views(f"""
SELECT category, {rsql('sum(sales)', 2)} AS total FROM sales GROUP BY category
ORDER BY sum(sales) DESC, category LIMIT 10""", **SALES), ("P6",))
def top_categories(spark, sf_dir):
    t = sales(spark, sf_dir, ["category", "sales"]).groupBy("category").agg(F.sum("sales").alias("total"))
    return rounded(R.top_n(t, "total", 10, tiebreak=("category",)), money=("total",))


@register("p7_largest_lines", with_views(f"""
SELECT {KEY_SQL}, sales FROM sales ORDER BY sales DESC, {KEY_SQL} LIMIT 20""", **SALES), ("P7",))
def largest_lines(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["sales"])
    return R.top_n(s, "sales", 20, tiebreak=KEY)


@register("p8_history_page", with_views("""
SELECT * FROM predictions ORDER BY "timestamp" DESC, prediction_id DESC LIMIT 50 OFFSET 100""", **PRED), ("P8",))
def history_page(spark, sf_dir):
    return R.page(fx.predictions(spark, sf_dir), "timestamp", "prediction_id", limit=50, offset=100)


@register("p9_latest_record", with_views("""
SELECT * FROM predictions ORDER BY "timestamp" DESC, prediction_id DESC LIMIT 1""", **PRED), ("P9",))
def latest_record(spark, sf_dir):
    return R.latest_record(fx.predictions(spark, sf_dir), "timestamp", "prediction_id")


@register("p11_unresolved_alerts", with_views("SELECT * FROM alerts WHERE NOT resolved", alerts=ALERTS_SQL),
          ("P11",))
def unresolved_alerts(spark, sf_dir):
    return fx.alerts(spark, sf_dir).where(~F.col("resolved"))


@register("p12_error_columns", with_views(f"""
SELECT prediction_id, {rsql('abs(actual_sales - predicted_sales)', 6)} AS absolute_error,
  {rsql('CASE WHEN actual_sales = 0 THEN NULL ELSE abs(actual_sales - predicted_sales) / abs(actual_sales) * 100 END', 6)}
    AS percentage_error,
  {rsql('actual_sales - predicted_sales', 6)} AS residual FROM predictions""", **PRED), ("P12", "P13"))
def error_columns(spark, sf_dir):
    p = fx.predictions(spark, sf_dir).select("prediction_id", "actual_sales", "predicted_sales")
    out = R.error_columns(p, "actual_sales", "predicted_sales")
    return rounded(out.select("prediction_id", "absolute_error", "percentage_error", "residual"))


@register("j1_attach_order_metadata", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity * p.p_retailprice AS predicted,
       o.o_orderdate, o.o_orderpriority
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""",
          ("J1",))
def attach_order_metadata(spark, sf_dir):
    preds = sales(spark, sf_dir, KEY + ["predicted"])
    meta = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    return R.attach_by_key(preds, meta, "l_orderkey", "left")


_MONTH_TO_SEASON = {m: SEASONS[(m % 12) // 3] for m in range(1, 13)}


@register("j2_season_lookup", with_views(f"""
SELECT CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Spring'
            WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
       count(*) AS n_rows, {rsql('sum(sales)', 2)} AS total FROM sales GROUP BY 1""", **SALES), ("J2", "S3"))
def season_lookup(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "sales"])
    s = s.withColumn("season", R.map_lookup(F.month("date"), _MONTH_TO_SEASON))
    return rounded(s.groupBy("season").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("total")),
                   money=("total",))


_ALLOWED = ("AMERICA", "ASIA", "EUROPE")


@register("j4_region_membership", with_views(f"""
SELECT region, count(*) AS n_rows, region IN {_ALLOWED} AS allowed FROM sales GROUP BY region""", **SALES),
          ("J4", "Q15"))
def region_membership(spark, sf_dir):
    s = sales(spark, sf_dir, ["region"])
    ok = R.members(s, "region", _ALLOWED, keep=True).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("allowed", F.lit(True))
    bad = R.members(s, "region", _ALLOWED, keep=False).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("allowed", F.lit(False))
    return ok.unionByName(bad)


@register("u1_append_increments", """
WITH a AS (SELECT l_orderkey, l_extendedprice, NULL::DOUBLE AS l_discount FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
b AS (SELECT l_orderkey, l_extendedprice, l_discount FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT count(*) AS n_rows, count(l_discount) AS n_with_discount, round(sum(l_extendedprice), 2) + 0.0 AS total FROM u""",
          ("U1",))
def append_increments(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    a = li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select("l_orderkey", "l_extendedprice")
    b = li.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_extendedprice", "l_discount")
    u = R.append(a, b)
    return rounded(u.agg(F.count(F.lit(1)).alias("n_rows"), F.count("l_discount").alias("n_with_discount"),
                         F.sum("l_extendedprice").alias("total")), money=("total",))


@register("u2_distinct_region_product", with_views("SELECT DISTINCT region, product FROM sales", **SALES), ("U2",))
def distinct_region_product(spark, sf_dir):
    return sales(spark, sf_dir, ["region", "product"]).distinct()


@register("s5_s8_scalar_functions", with_views(f"""
SELECT prediction_id, coalesce(CASE WHEN actual_sales = 0 THEN NULL ELSE predicted_sales / actual_sales END, 0.0) AS ratio,
  strftime("timestamp", '%Y-%m-%d %H:%M') AS ts_text, upper(trim('  ' || region || '  ')) AS region_trim,
  array_to_string(string_split(region || ',' || CAST(product AS VARCHAR), ','), '|') AS joined,
  least(greatest(predicted_sales, 10.0), 100.0) AS clipped, floor(predicted_sales) AS floored,
  {rsql('sqrt(predicted_sales)')} AS root, {rsql('ln(predicted_sales + 1)')} AS log1,
  round(predicted_sales, 1) AS rounded1, datediff('day', DATE '2024-01-01', CAST("timestamp" AS DATE)) AS days_in,
  CAST(floor((epoch_us((SELECT max("timestamp") FROM predictions)) - epoch_us("timestamp")) / 3600000000) AS BIGINT)
    AS hours_before_end
FROM predictions""", **PRED), ("S5", "S6", "S7", "S8"))
def scalar_functions(spark, sf_dir):
    from salesflow.functions import exprs as X
    p = fx.predictions(spark, sf_dir)
    end = max_scalar(p, "timestamp")
    out = p.select(
        "prediction_id", X.safe_div("predicted_sales", "actual_sales", 0.0).alias("ratio"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("ts_text"),
        F.upper(F.trim(F.concat(F.lit("  "), "region", F.lit("  ")))).alias("region_trim"),
        X.join_list(X.split_list(F.concat_ws(",", "region", F.col("product").cast("string"))), "|").alias("joined"),
        X.clip("predicted_sales", 10.0, 100.0).alias("clipped"), F.floor("predicted_sales").cast("double").alias("floored"),
        F.sqrt("predicted_sales").alias("root"), F.log1p("predicted_sales").alias("log1"),
        F.round("predicted_sales", 1).alias("rounded1"),
        X.days_between(F.to_date("timestamp"), F.lit("2024-01-01").cast("date")).cast("bigint").alias("days_in"),
        X.hours_since("timestamp", end).cast("bigint").alias("hours_before_end"))
    return rounded(out, cols=["root", "log1"])


@register("p2_points", with_views(f"SELECT {KEY_SQL}, sales, predicted FROM sales WHERE sales IS NOT NULL", **SALES), ("P2",))
def points(spark, sf_dir):
    """Every (actual, predicted) point of a scatter plot."""
    s = sales(spark, sf_dir, KEY + ["sales", "predicted"])
    return R.scatter_points(s, KEY, "sales", "predicted")
