"""Registered window / sequence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import windows as W
from salesflow.plans.common import rounded, rsql, sales
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import PREDICTIONS_SQL, sales_sql, with_views

SALES = {"sales": sales_sql()}
PRED = {"predictions": PREDICTIONS_SQL}
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)
ORDER_SQL = "date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
WIN = f"PARTITION BY region, product ORDER BY {ORDER_SQL}"


def _base(spark, sf_dir):
    return sales(spark, sf_dir, KEY + ["l_extendedprice", "date", "region", "product", "sales"])


@register("w1_lags", with_views(f"""
SELECT {KEY_SQL}, region, product, sales,
  lag(sales, 1) OVER ({WIN}) AS sales_lag_1, lag(sales, 7) OVER ({WIN}) AS sales_lag_7,
  lag(sales, 30) OVER ({WIN}) AS sales_lag_30 FROM sales""", **SALES), ("W1",))
def lags(spark, sf_dir):
    out = W.add_lags(_base(spark, sf_dir), "sales", ["region", "product"], fx.SALES_ORDER)
    return out.drop("l_extendedprice", "date")


@register("w2_rolling_halo", with_views(f"""
SELECT {KEY_SQL}, region, product, sales, {', '.join(
    f"{rsql(f'{fn}(sales) OVER ({WIN} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)', 6)} AS sales_rolling_{n}_{a}"
    for n in (7, 30) for a, fn in (('mean', 'avg'), ('std', 'stddev_samp'), ('min', 'min'), ('max', 'max')))}
FROM sales""", **SALES), ("W2",))
def rolling(spark, sf_dir):
    # chunked path: each (region, product) group is split into 500-row chunks plus a 29-row halo
    out = W.add_rolling(_base(spark, sf_dir), "sales", ["region", "product"], fx.SALES_ORDER, chunk_rows=500)
    # windows of <= 30 rows over 2-dp values cannot land on a 6-dp rounding tie
    return rounded(out.drop("l_extendedprice", "date"), 6)


@register("w5_hopping_windows", with_views("""
WITH i AS (SELECT *, row_number() OVER (ORDER BY "timestamp", prediction_id) - 1 AS idx FROM predictions),
n AS (SELECT count(*) AS n FROM predictions),
k AS (SELECT unnest(range(0, (SELECT (n - 1 - 100) // 50 + 1 FROM n))) AS window_id)
SELECT k.window_id, 100 + k.window_id * 50 AS window_end, count(*) AS n_rows, min(i.idx) AS first_idx,
       max(i.idx) AS last_idx, max(i."timestamp") AS last_timestamp
FROM k JOIN i ON i.idx >= k.window_id * 50 AND i.idx < 100 + k.window_id * 50
GROUP BY k.window_id""", **PRED), ("W5",))
def hopping(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    h = W.hopping_windows(p, ["timestamp", "prediction_id"], 100)
    return h.groupBy("window_id", "window_end").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("row_idx").alias("first_idx"),
        F.max("row_idx").alias("last_idx"), F.max("timestamp").alias("last_timestamp"))


@register("w6_global_row_index", with_views(f"""
SELECT {KEY_SQL}, date, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS row_idx FROM sales""", **SALES), ("W6",))
def global_index(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["l_extendedprice", "date"])
    return W.global_row_index(s, fx.SALES_ORDER).drop("l_extendedprice")


@register("w7_average_ranks", with_views(f"""
SELECT {KEY_SQL}, quantity, price,
  rank() OVER (ORDER BY quantity) + (count(*) OVER (PARTITION BY quantity) - 1) / 2.0 AS quantity_rank,
  rank() OVER (ORDER BY price) + (count(*) OVER (PARTITION BY price) - 1) / 2.0 AS price_rank
FROM sales""", **SALES), ("W7",))
def average_ranks(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["quantity", "price"])
    return W.average_ranks(s, ["quantity", "price"], KEY)


@register("w8_latest_per_region", with_views("""
SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY region ORDER BY "timestamp" DESC,
  prediction_id DESC) <= 3""", **PRED), ("W8",))
def latest_per_region(spark, sf_dir):
    return W.latest_per_key(fx.predictions(spark, sf_dir), ["region"], ["timestamp", "prediction_id"], n=3)
