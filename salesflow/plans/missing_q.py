"""Registered variants on rows with NULL, NaN, zero divisors and groups without current rows.

The holes are put into whole tables by a rule on the key (FIXTURES.md); every row is read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import drift as D
from salesflow.operators import features as FE
from salesflow.operators import models as M
from salesflow.operators import monitor as PM
from salesflow.operators import preprocess as P
from salesflow.operators import selection as FS
from salesflow.operators import summary as S
from salesflow.operators.relational import label_period
from salesflow.plans.common import max_literal, null_every, null_every_sql, rounded, rsql, sales, spool
from salesflow.plans.drift_q import FEATURES, _long_sql, _psi_sql
from salesflow.plans.models_q import metric_sql
from salesflow.plans.monitor_q import BASE, _perf_sql
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import sales_sql, with_views

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)


def _nan_every(col: str, key: str, modulus: int):
    return F.when(F.pmod(F.col(key), F.lit(modulus)) == 0, F.lit(float("nan"))).otherwise(F.col(col).cast("double"))


# the oracle reads NaN as missing
_NAN_SQL = f"""SELECT {KEY_SQL}, region, {null_every_sql('price', 'l_orderkey', 17)} AS price,
  {null_every_sql('sales', 'l_linenumber', 5)} AS sales, predicted FROM ({sales_sql()})"""


def _nan(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["region", "price", "sales", "predicted"])
    return s.select(*KEY, "region", _nan_every("price", "l_orderkey", 17).alias("price"),
                    _nan_every("sales", "l_linenumber", 5).alias("sales"), "predicted")


@register("fs3_spearman_nulls", with_views(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, {rsql('corr(rx, ry)')} AS corr, count(*) AS n FROM (
  SELECT rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY sales) + (count(*) OVER (PARTITION BY sales) - 1) / 2.0 AS ry
  FROM h WHERE {c} IS NOT NULL AND sales IS NOT NULL)""" for c in ("price", "predicted")), h=_NAN_SQL), ("FS3",))
def spearman_nulls(spark, sf_dir):
    # null counts, value counts and the joins of the ranks read one copy of the three columns
    x = spool(_nan(spark, sf_dir).select("price", "predicted", "sales"), "fs3-columns")
    out = FS.correlations(x, ["price", "predicted"], "sales", "spearman")
    return rounded(out.select("feature", "corr", "n"), cols=["corr"])


# one region has no current rows: it has no PSI
_GAP = _long_sql(("region",))
_GAP_LAB = (f"SELECT * REPLACE (CASE WHEN region = 'ASIA' THEN 'reference' ELSE period END AS period) FROM ({_GAP['lab']})")


@register("d4_psi_by_region", with_views(f"WITH {_psi_sql(('region',))} SELECT region, feature, {rsql('psi')} AS psi FROM ps WHERE psi IS NOT NULL AND region <> 'ASIA'",
                                         lab=_GAP_LAB, long=_GAP["long"]), ("D4",))
def psi_by_region(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "region", *FEATURES])
    lab = label_period(s, "date", max_literal(s, "date"), 30)
    lab = lab.withColumn("period", F.when(F.col("region") == "ASIA", F.lit("reference")).otherwise(F.col("period")))
    return rounded(D.psi(lab, FEATURES, "period", by=["region"]))


@register("f7_zero_quantity", with_views(f"""
SELECT {KEY_SQL}, price, quantity, coalesce(price / nullif(quantity, 0), 0) AS price_div_quantity,
  price * quantity AS price_x_quantity FROM z""",
    z=f"SELECT {KEY_SQL}, price, CASE WHEN l_linenumber = 1 THEN 0 ELSE quantity END AS quantity FROM ({sales_sql()})"), ("F7", "F3"))
def zero_quantity(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["price", "quantity"])
    s = s.withColumn("quantity", F.when(F.col("l_linenumber") == 1, F.lit(0)).otherwise(F.col("quantity")))
    out = FE.serving_features(s, ["price", "quantity", "price_x_quantity", "price_div_quantity"], plan=[("price", "quantity", True)])
    return out.select(*KEY, "price", "quantity", "price_div_quantity", "price_x_quantity")


@register("t3_scaler_nan", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rsql(f'avg({c})')} AS mean, {rsql(f'stddev_pop({c})')} AS std FROM h" for c in ("price", "sales")),
    h=_NAN_SQL), ("T3",))
def scaler_nan(spark, sf_dir):
    return rounded(P.fit_scaler(_nan(spark, sf_dir), ["price", "sales"]).to_df(spark))


@register("t6_impute_nan", with_views(f"""
SELECT {KEY_SQL}, coalesce(price, (SELECT round(avg(price), 6) FROM h)) AS price,
  coalesce(sales, (SELECT round(avg(sales), 6) FROM h)) AS sales FROM h""", h=_NAN_SQL), ("T6",))
def impute_nan(spark, sf_dir):
    h = _nan(spark, sf_dir).select(*KEY, "price", "sales")
    imp = P.fit_imputer(h, "mean", cols=["price", "sales"])
    return P.Imputer(imp.strategy, {c: round(v, 6) for c, v in imp.values.items()}).transform(h)


def _fence_query(name, method, lo, hi, inclusive, k, ids):
    ge, le = (">=", "<=") if inclusive else (">", "<")

    @register(name, with_views(f"""SELECT count(*) AS n_rows, {rsql('sum(price)', 2)} AS total
FROM h, (SELECT {lo} AS lo, {hi} AS hi FROM h) WHERE price {ge} lo AND price {le} hi""", h=_NAN_SQL), ids)
    def build(spark, sf_dir):
        kept = P.remove_outliers(_nan(spark, sf_dir).select("price"), ["price"], method, k)
        return rounded(kept.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("price").alias("total")), money=("total",))


_Q = "quantile_cont(price, 0.25)", "quantile_cont(price, 0.75)"
_fence_query("t8_iqr_nan", "iqr", f"{_Q[0]} - 1.5 * ({_Q[1]} - {_Q[0]})", f"{_Q[1]} + 1.5 * ({_Q[1]} - {_Q[0]})", True, 1.5, ("T8",))
_fence_query("t9_zscore_nan", "zscore", "avg(price) - 2.0 * stddev_pop(price)", "avg(price) + 2.0 * stddev_pop(price)", False, 2.0, ("T9",))


@register("m6_metrics_nan", with_views(f"SELECT {metric_sql('sales', 'predicted')} FROM h WHERE sales IS NOT NULL AND predicted IS NOT NULL",
                                       h=_NAN_SQL), ("M6",))
def metrics_nan(spark, sf_dir):
    from salesflow.plans.common import sig
    m = M.regression_metrics(_nan(spark, sf_dir), "sales", "predicted")
    return rounded(m, cols=["rmse", "mae", "r2"]).withColumn("mape", sig("mape", 9))


@register("p5_null_dates", with_views(f"""
SELECT CASE WHEN d >= (SELECT max(d) FROM n) - INTERVAL 30 DAY THEN 'current' WHEN d IS NOT NULL THEN 'reference' END AS period,
  count(*) AS n_rows FROM n GROUP BY 1""", n=f"SELECT {null_every_sql('date', 'l_orderkey', 7)} AS d FROM ({sales_sql()})"), ("P5",))
def null_dates(spark, sf_dir):
    s = sales(spark, sf_dir, ["l_orderkey", "date"]).select(null_every("date", "l_orderkey", 7).alias("date"))
    return label_period(s, "date", max_literal(s, "date"), 30).groupBy("period").agg(F.count(F.lit(1)).alias("n_rows"))


@register("pm1_default_window", _perf_sql(), ("PM1", "P3"))
def default_window(spark, sf_dir):
    out = PM.check_performance(fx.predictions(spark, sf_dir), PM.baseline_frame(spark, BASE), "actual_sales", "predicted_sales")
    return rounded(out, cols=["current", "degradation_pct"])


@register("a13_box_null_group", with_views(f"""
WITH q AS (SELECT g, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM n GROUP BY g)
SELECT n.g, {rsql('any_value(q1)')} AS q1, {rsql('any_value(median)')} AS median, {rsql('any_value(q3)')} AS q3,
  count(*) FILTER (WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM n JOIN q ON n.g IS NOT DISTINCT FROM q.g GROUP BY n.g""",
    n=f"SELECT {null_every_sql('region', 'l_partkey', 11)} AS g, price FROM ({sales_sql()})"), ("A13",))
def box_null_group(spark, sf_dir):
    s = sales(spark, sf_dir, ["l_partkey", "region", "price"]).select(null_every("region", "l_partkey", 11).alias("g"), "price")
    return rounded(S.box_stats(s, "price", ["g"]).select("g", "q1", "median", "q3", "n_outliers"))


@register("a12_histogram_null_group", with_views("""
WITH r AS (SELECT g, min(price) AS lo, max(price) AS hi FROM n GROUP BY g),
b AS (SELECT n.g, CAST(CASE WHEN hi > lo THEN least(floor((price - lo) / ((hi - lo) / 10)), 9) ELSE 0 END AS INTEGER) AS bin
      FROM n JOIN r ON n.g IS NOT DISTINCT FROM r.g)
SELECT r.g, CAST(k.bin AS INTEGER) AS bin, (SELECT count(*) FROM b WHERE b.g IS NOT DISTINCT FROM r.g AND b.bin = k.bin) AS count
FROM r, (SELECT unnest(range(0, 10)) AS bin) k""",
    n=f"SELECT {null_every_sql('region', 'l_partkey', 11)} AS g, price FROM ({sales_sql()})"), ("A12",))
def histogram_null_group(spark, sf_dir):
    s = sales(spark, sf_dir, ["l_partkey", "region", "price"]).select(null_every("region", "l_partkey", 11).alias("g"), "price")
    return S.histogram(s, "price", 10, ["g"]).select("g", "bin", "count")


@register("pm2_trend_by_region", with_views(f"""
WITH i AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp", prediction_id) - 1 AS idx,
             count(*) OVER (PARTITION BY region) AS n FROM predictions),
k AS (SELECT region, unnest(range(0, CAST((max(n) - 1 - 20) // 10 + 1 AS BIGINT))) AS window_id FROM i GROUP BY region HAVING max(n) > 20),
w AS (SELECT k.window_id, i.* FROM k JOIN i ON i.region = k.region AND i.idx >= k.window_id * 10 AND i.idx < 20 + k.window_id * 10)
SELECT region, window_id, 20 + window_id * 10 AS row_index, {metric_sql('actual_sales', 'predicted_sales')} FROM w GROUP BY region, window_id""",
    predictions=fx.PREDICTIONS_SQL), ("PM2",))
def trend_by_region(spark, sf_dir):
    from salesflow.plans.common import sig
    p = fx.predictions(spark, sf_dir)
    t = PM.performance_trend(p, "actual_sales", "predicted_sales", ["timestamp", "prediction_id"], 20, ts=None, by=["region"])
    return rounded(t, cols=["rmse", "mae", "r2"]).withColumn("mape", sig("mape", 9))
