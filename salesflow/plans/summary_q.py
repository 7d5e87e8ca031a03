"""Registered summary queries (A1-A21) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import summary as S
from salesflow.operators import windows as W
from salesflow.operators.blocks import pair_moments, pearson
from salesflow.plans.common import max_literal, max_scalar, null_every, null_every_sql, rounded, rsql, sales
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import (ALERTS_SQL, DRIFT_METRICS_SQL, PREDICTIONS_SQL, sales_sql,
                                        with_views)

SALES = {"sales": sales_sql()}
PRED = {"predictions": PREDICTIONS_SQL}
DRIFT = {"drift_metrics": DRIFT_METRICS_SQL}
_ = ALERTS_SQL


# A2 + W3: the flagship query ------------------------------------------------------------------
def daily_revenue_ma(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "sales"])
    daily = S.daily_totals(s, "date", "sales")
    out = W.moving_averages(daily, "date", "daily_sales", (7, 30, 90), full=True)
    return rounded(out, 4, money=("daily_sales",))


register("a2_daily_revenue_ma", with_views(f"""
SELECT date, {rsql('daily_sales', 2)} AS daily_sales, n_rows,
  {rsql('CASE WHEN count(*) OVER w7 = 7 THEN avg(daily_sales) OVER w7 END', 4)} AS ma_7,
  {rsql('CASE WHEN count(*) OVER w30 = 30 THEN avg(daily_sales) OVER w30 END', 4)} AS ma_30,
  {rsql('CASE WHEN count(*) OVER w90 = 90 THEN avg(daily_sales) OVER w90 END', 4)} AS ma_90
FROM (SELECT date, sum(sales) AS daily_sales, count(*) AS n_rows FROM sales GROUP BY date)
WINDOW w7 AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
       w90 AS (ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)""", **SALES),
         ("A2", "W3"))(daily_revenue_ma)


@register("a2_revenue_overview", with_views(f"""
SELECT {rsql('sum(d)', 2)} AS total_revenue, count(*) AS n_days, {rsql('avg(d)', 4)} AS avg_daily_revenue
FROM (SELECT date, sum(sales) AS d FROM sales GROUP BY date)""", **SALES), ("A2",))
def revenue_overview(spark, sf_dir):
    out = S.revenue_overview(sales(spark, sf_dir, ["date", "sales"]))
    return rounded(out, 4, money=("total_revenue",))


# A1 -------------------------------------------------------------------------------------------
_A1_KEYS = {  # key -> (oracle expression, Spark expression builder); no Column at import time
    "month": ("month(date)", lambda: F.month("date")),
    "day_of_week": ("isodow(date) - 1", lambda: F.weekday("date")),
    "region": ("region", lambda: F.col("region")),
    "product": ("product", lambda: F.col("product")),
}


def _a1(key):
    sql_key, make_col = _A1_KEYS[key]

    def build(spark, sf_dir):
        col = make_col()
        s = sales(spark, sf_dir, ["date", "region", "product", "sales"]).withColumn(
            key, col.cast("bigint") if key in ("month", "day_of_week") else col)
        return rounded(S.group_totals(s, key, "sales"), 4, money=("total",))

    cast = f"CAST({sql_key} AS BIGINT)" if key in ("month", "day_of_week") else sql_key
    sql = with_views(f"""
SELECT {cast} AS {key}, {rsql('sum(sales)', 2)} AS total, {rsql('avg(sales)', 4)} AS mean,
       count(sales) AS count
FROM sales GROUP BY 1""", **SALES)
    register(f"a1_sales_by_{key}", sql, ("A1",))(build)


for _k in _A1_KEYS:
    _a1(_k)


# A3 -------------------------------------------------------------------------------------------
@register("a3_weekend_boost", with_views(f"""
SELECT region, {rsql('weekend_total', 2)} AS weekend_total, {rsql('weekday_total', 2)} AS weekday_total,
  {rsql('weekend_mean', 4)} AS weekend_mean, {rsql('weekday_mean', 4)} AS weekday_mean,
  {rsql('(weekend_mean - weekday_mean) / weekday_mean * 100', 4)} AS boost_pct
FROM (SELECT region,
        sum(CASE WHEN isodow(date) >= 6 THEN sales END) AS weekend_total,
        sum(CASE WHEN isodow(date) < 6 THEN sales END) AS weekday_total,
        avg(CASE WHEN isodow(date) >= 6 THEN sales END) AS weekend_mean,
        avg(CASE WHEN isodow(date) < 6 THEN sales END) AS weekday_mean
      FROM sales GROUP BY region)""", **SALES), ("A3",))
def weekend_boost(spark, sf_dir):
    out = S.weekend_boost(sales(spark, sf_dir, ["date", "region", "sales"]), by=["region"])
    return rounded(out, 4, money=("weekend_total", "weekday_total"))


# A4 -------------------------------------------------------------------------------------------
@register("a4_peak_month", with_views(f"""
SELECT peak_month, {rsql('peak_total', 2)} AS peak_total FROM (
  SELECT CAST(month(date) AS BIGINT) AS peak_month, sum(sales) AS peak_total FROM sales GROUP BY 1
  ORDER BY peak_total DESC, peak_month ASC LIMIT 1)""", **SALES), ("A4",))
def peak_month(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "sales"]).withColumn("month", F.month("date").cast("bigint"))
    return rounded(S.peak_period(s, "month", "sales"), money=("peak_total",))


# A5 -------------------------------------------------------------------------------------------
_A5_COLS = ("region", "product", "category")


@register("a5_value_counts", with_views(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count,
       {rsql('count(*) * 100.0 / sum(count(*)) OVER ()', 6)} AS pct FROM sales GROUP BY {c}"""
                                                             for c in _A5_COLS), **SALES), ("A5",))
def value_counts(spark, sf_dir):
    return rounded(S.value_counts(sales(spark, sf_dir, _A5_COLS), _A5_COLS))


# A6 -------------------------------------------------------------------------------------------
_A6_COLS = ("price", "quantity", "sales")


def _describe_sql(cols, view, src_sql, missing=False):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        extra = (f", count(*) - count({x}) AS missing, "
                 f"{rsql(f'(count(*) - count({x})) * 100.0 / count(*)', 6)} AS missing_pct") if missing else ""
        parts.append(f"""
SELECT '{c}' AS "column", count({x}) AS count, {rsql(f'avg({x})', 4)} AS mean,
  {rsql(f'stddev_samp({x})', 4)} AS std, {rsql(f'min({x})', 4)} AS min,
  {rsql(f'quantile_cont({x}, 0.25)', 4)} AS p25, {rsql(f'quantile_cont({x}, 0.5)', 4)} AS p50,
  {rsql(f'quantile_cont({x}, 0.75)', 4)} AS p75, {rsql(f'max({x})', 4)} AS max{extra} FROM {view}""")
    return with_views(" UNION ALL ".join(parts), **{view: src_sql})


register("a6_numeric_summary", _describe_sql(_A6_COLS, "sales", sales_sql()), ("A6",))(
    lambda spark, sf_dir: rounded(S.numeric_summary(sales(spark, sf_dir, _A6_COLS), _A6_COLS), 4))


# Feature summary with missing values injected on fixed key remainders ----------------------
_A7_COLS = ("price", "l_discount", "c_acctbal")


def _a7_frame(spark, sf_dir):
    s = sales(spark, sf_dir, ["price", "l_discount", "c_acctbal", "l_orderkey", "l_linenumber"])
    return s.select(null_every("price", "l_orderkey", 17).alias("price"),
                    null_every("l_discount", "l_linenumber", 5).alias("l_discount"), "c_acctbal")


_A7_SRC = f"""SELECT {null_every_sql('price', 'l_orderkey', 17)} AS price,
  {null_every_sql('l_discount', 'l_linenumber', 5)} AS l_discount, c_acctbal FROM ({sales_sql()})"""

register("a7_feature_summary", _describe_sql(_A7_COLS, "feat", _A7_SRC, missing=True), ("A7",))(
    lambda spark, sf_dir: rounded(rounded(S.numeric_summary(_a7_frame(spark, sf_dir), _A7_COLS, with_missing=True),
                                          6, cols=["missing_pct"]), 4,
                                  cols=["mean", "std", "min", "p25", "p50", "p75", "max"]))


# A8 -------------------------------------------------------------------------------------------
register("a8_missing_report", with_views(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
       {rsql(f'(count(*) - count({c})) * 100.0 / count(*)', 6)} AS missing_pct FROM feat"""
                                                              for c in _A7_COLS), feat=_A7_SRC), ("A8",))(
    lambda spark, sf_dir: rounded(S.missing_report(_a7_frame(spark, sf_dir), _A7_COLS)))


# A9 / A10 -------------------------------------------------------------------------------------
_CORR_COLS = ("quantity", "price", "sales", "l_discount", "l_tax", "p_retailprice")


@register("a9_correlation_matrix", with_views(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {rsql(f'corr({a}, {b})', 6)} AS corr FROM sales"
    for a in _CORR_COLS for b in _CORR_COLS), **SALES), ("A9",))
def correlation_matrix(spark, sf_dir):
    m = pair_moments(sales(spark, sf_dir, _CORR_COLS), _CORR_COLS)
    c = m.select("a", "b", pearson("cov", "var_a", "var_b").alias("corr"))
    full = c.unionByName(c.where(F.col("a") != F.col("b")).select(
        F.col("b").alias("a"), F.col("a").alias("b"), "corr"))
    return rounded(full.select(F.col("a").alias("feature_a"), F.col("b").alias("feature_b"), "corr"))


@register("a10_target_correlation", with_views(" UNION ALL ".join(
    f"SELECT '{a}' AS feature, {rsql(f'corr({a}, sales)', 6)} AS corr, "
    f"{rsql(f'abs(corr({a}, sales))', 6)} AS abs_corr FROM sales"
    for a in _CORR_COLS if a != "sales"), **SALES), ("A10",))
def target_correlation(spark, sf_dir):
    feats = [c for c in _CORR_COLS if c != "sales"]
    m = pair_moments(sales(spark, sf_dir, _CORR_COLS), _CORR_COLS, pairs=[(a, "sales") for a in feats])
    out = m.select(F.col("a").alias("feature"), pearson("cov", "var_a", "var_b").alias("corr"))
    return rounded(out.withColumn("abs_corr", F.abs("corr")).orderBy(F.desc("abs_corr")))


# A11 ------------------------------------------------------------------------------------------
@register("a11_distinct_values", with_views(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
       array_to_string(list_sort(list(DISTINCT {c})), ',') AS "values" FROM sales"""
                                                                for c in _A5_COLS), **SALES), ("A11", "U2"))
def distinct_values(spark, sf_dir):
    out = S.distinct_values(sales(spark, sf_dir, _A5_COLS), _A5_COLS, with_values=True)
    return out.withColumn("values", F.array_join("values", ","))


@register("a11_domain", with_views(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", {c} AS value, count(*) AS n_rows FROM sales WHERE {c} IS NOT NULL GROUP BY {c}""" for c in _A5_COLS), **SALES), ("A11",))
def domain(spark, sf_dir):
    return S.domain(sales(spark, sf_dir, _A5_COLS), _A5_COLS)


# A12 ------------------------------------------------------------------------------------------
@register("a12_price_histogram", with_views(f"""
WITH r AS (SELECT min(price) AS mn, max(price) AS mx FROM sales),
c AS (SELECT CAST(CASE WHEN (mx - mn) / 30 > 0 THEN least(floor((price - mn) / ((mx - mn) / 30)), 29)
                  ELSE 0 END AS INTEGER) AS bin, count(*) AS count FROM sales, r GROUP BY 1),
g AS (SELECT CAST(unnest(range(0, 30)) AS INTEGER) AS bin)
SELECT g.bin, {rsql('mn + g.bin * ((mx - mn) / 30)', 4)} AS lo, {rsql('mn + (g.bin + 1) * ((mx - mn) / 30)', 4)} AS hi,
       coalesce(c.count, 0) AS count
FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin""", **SALES), ("A12",))
def price_histogram(spark, sf_dir):
    return rounded(S.histogram(sales(spark, sf_dir, ["price"]), "price", bins=30), 4)


# A13 ------------------------------------------------------------------------------------------
@register("a13_box_stats", with_views(f"""
WITH q AS (SELECT region, quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.5) AS median,
                  quantile_cont(sales, 0.75) AS q3 FROM sales GROUP BY region)
SELECT s.region, {rsql('q1', 4)} AS q1, {rsql('median', 4)} AS median, {rsql('q3', 4)} AS q3,
  {rsql('q3 - q1', 4)} AS iqr,
  {rsql('min(CASE WHEN sales >= q1 - 1.5 * (q3 - q1) AND sales <= q3 + 1.5 * (q3 - q1) THEN sales END)', 4)} AS whisker_lo,
  {rsql('max(CASE WHEN sales >= q1 - 1.5 * (q3 - q1) AND sales <= q3 + 1.5 * (q3 - q1) THEN sales END)', 4)} AS whisker_hi,
  count(*) FILTER (WHERE NOT (sales >= q1 - 1.5 * (q3 - q1) AND sales <= q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM sales s JOIN q ON s.region = q.region GROUP BY s.region, q1, median, q3""", **SALES), ("A13",))
def box_stats(spark, sf_dir):
    return rounded(S.box_stats(sales(spark, sf_dir, ["region", "sales"]), "sales", by=["region"]), 4)


# A14 ------------------------------------------------------------------------------------------
@register("a14_share_by_region", with_views(f"""
SELECT region, {rsql('sum(sales)', 2)} AS total, {rsql('sum(sales) * 100.0 / sum(sum(sales)) OVER ()', 6)} AS share_pct
FROM sales GROUP BY region""", **SALES), ("A14",))
def share_by_region(spark, sf_dir):
    return rounded(S.share_of_total(sales(spark, sf_dir, ["region", "sales"]), "region", "sales"),
                   money=("total",))


# A15 ------------------------------------------------------------------------------------------
_A15_COLS = ("date", "region", "product", "category", "price", "quantity", "sales")


@register("a15_dataset_overview", with_views(f"""
SELECT count(*) AS n_rows, {len(_A15_COLS)} AS n_columns,
  ({' + '.join(f'(count(*) - count({c}))' for c in _A15_COLS)}) AS n_missing,
  min(date) AS date_min, max(date) AS date_max, CAST(max(date) - min(date) AS INTEGER) AS n_days,
  count(DISTINCT region) AS n_region, count(DISTINCT product) AS n_product FROM sales""", **SALES), ("A15",))
def dataset_overview(spark, sf_dir):
    out = S.dataset_overview(sales(spark, sf_dir, _A15_COLS))
    return out.withColumn("n_columns", F.col("n_columns").cast("int"))


# A16-A19 on predictions ---------------------------------------------------------------------------
@register("a16_prediction_stats_24h", with_views(f"""
SELECT count(*) AS total_predictions, {rsql('avg(predicted_sales)', 4)} AS avg_prediction,
  {rsql('min(predicted_sales)', 4)} AS min_prediction, {rsql('max(predicted_sales)', 4)} AS max_prediction
FROM predictions WHERE "timestamp" >= (SELECT max("timestamp") FROM predictions) - INTERVAL 24 HOUR""",
                                                             **PRED), ("A16", "P3"))
def prediction_stats(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    return rounded(S.prediction_stats(p, max_literal(p, "timestamp"), hours=24), 4)


@register("a17_prediction_headline", with_views(f"""
SELECT count(*) AS total_predictions, {rsql('avg(predicted_sales)', 4)} AS avg_prediction,
  {rsql('avg(absolute_error)', 4)} AS mean_error, count(DISTINCT region) AS n_regions FROM predictions""",
                                                           **PRED), ("A17",))
def prediction_headline(spark, sf_dir):
    return rounded(S.prediction_headline(fx.predictions(spark, sf_dir)), 4)


@register("a18_predictions_by_region", with_views(f"""
SELECT region, count(*) AS count, {rsql('avg(predicted_sales)', 4)} AS mean,
       {rsql('sum(predicted_sales)', 2)} AS total FROM predictions GROUP BY region""", **PRED), ("A18",))
def predictions_by_region(spark, sf_dir):
    return rounded(S.predictions_by(fx.predictions(spark, sf_dir)), 4, money=("total",))


@register("a19_daily_counts_7d", with_views("""
SELECT CAST("timestamp" AS DATE) AS date, count(*) AS count FROM predictions
WHERE "timestamp" >= (SELECT max("timestamp") FROM predictions) - INTERVAL 7 DAY GROUP BY 1""",
                                                      **PRED), ("A19",))
def daily_counts(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    return S.daily_counts(p, max_literal(p, "timestamp"), days=7).orderBy(F.desc("date"))


# A20 / A21 on drift history -----------------------------------------------------------------------
@register("a20_drift_alert_summary", with_views("""
SELECT feature_name, count(*) AS alert_count, max("timestamp") AS last_alert,
       round(avg(drift_score), 4) + 0.0 AS avg_score
FROM drift_metrics WHERE drift_detected GROUP BY feature_name""", **DRIFT), ("A20",))
def drift_alert_summary(spark, sf_dir):
    out = S.drift_alert_summary(fx.drift_metrics(spark, sf_dir))
    return out.orderBy(F.desc("alert_count"))


@register("a21_drift_headline", with_views(f"""
SELECT max("timestamp") AS "timestamp", bool_or(drift_detected) AS has_drift,
  count(DISTINCT CASE WHEN drift_detected THEN feature_name END) AS n_drifted,
  count(DISTINCT feature_name) AS n_features, {rsql('max(drift_score)', 6)} AS max_score
FROM drift_metrics WHERE "timestamp" = (SELECT max("timestamp") FROM drift_metrics)""", **DRIFT),
          ("A21", "P10"))
def drift_headline(spark, sf_dir):
    return rounded(S.drift_headline(fx.drift_metrics(spark, sf_dir)))


# A12, two overlaid series: reference vs current period, each with its own 30 bins -------------
_PERIOD_SQL = ("SELECT *, CASE WHEN date >= (SELECT max(date) FROM sales) - INTERVAL 30 DAY THEN 'current' "
               "ELSE 'reference' END AS period FROM sales")


@register("a12_histogram_by_period", with_views(f"""
WITH r AS (SELECT period, min(price) AS mn, max(price) AS mx FROM lab GROUP BY period),
c AS (SELECT l.period, CAST(CASE WHEN (mx - mn) / 30 > 0 THEN least(floor((price - mn) / ((mx - mn) / 30)), 29)
                  ELSE 0 END AS INTEGER) AS bin, count(*) AS count FROM lab l JOIN r ON l.period = r.period GROUP BY 1, 2),
g AS (SELECT period, mn, mx, CAST(unnest(range(0, 30)) AS INTEGER) AS bin FROM r)
SELECT g.period, g.bin, {rsql('mn + g.bin * ((mx - mn) / 30)', 4)} AS lo, {rsql('mn + (g.bin + 1) * ((mx - mn) / 30)', 4)} AS hi,
       coalesce(c.count, 0) AS count
FROM g LEFT JOIN c ON g.period = c.period AND g.bin = c.bin""", sales=sales_sql(), lab=_PERIOD_SQL), ("A12", "P5"))
def histogram_by_period(spark, sf_dir):
    from salesflow.operators.relational import label_period
    s = sales(spark, sf_dir, ["date", "price"])
    lab = label_period(s, "date", max_scalar(s, "date"), 30)
    return rounded(S.histogram(lab, "price", bins=30, by=["period"]), 4)
