"""Registered feature queries (S1-S4 via F1, F3-F7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import features as FE
from salesflow.plans.common import rounded, rsql, sales, spool
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import sales_sql, with_views

SALES = {"sales": sales_sql()}
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)
ORDER_SQL = "date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

TIME_SQL = f"""
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, CAST(day(date) = 1 AS INTEGER) AS is_month_start,
  CAST(date = last_day(date) AS INTEGER) AS is_month_end,
  CAST(date = CAST(date_trunc('quarter', date) AS DATE) AS INTEGER) AS is_quarter_start,
  CAST(date = CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS INTEGER) AS is_quarter_end,
  CASE (month(date) % 12) // 3 WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' ELSE 'Fall' END AS season,
  {rsql('sin(2 * pi() * month(date) / 12.0)')} AS month_sin, {rsql('cos(2 * pi() * month(date) / 12.0)')} AS month_cos,
  {rsql('sin(2 * pi() * (isodow(date) - 1) / 7.0)')} AS day_of_week_sin,
  {rsql('cos(2 * pi() * (isodow(date) - 1) / 7.0)')} AS day_of_week_cos"""


@register("f1_time_features", with_views(f"SELECT {KEY_SQL}, date, {TIME_SQL} FROM sales", **SALES),
          ("F1", "S1", "S2", "S3", "S4"))
def time_features(spark, sf_dir):
    return rounded(FE.add_time_features(sales(spark, sf_dir, KEY + ["date"])))


_F3 = ("price", "quantity", "l_discount")


@register("f3_interactions", with_views(f"""
SELECT {KEY_SQL}, price, quantity, l_discount,
  price * quantity AS price_x_quantity, price / quantity AS price_div_quantity,
  price * l_discount AS price_x_l_discount, quantity * l_discount AS quantity_x_l_discount
FROM sales""", **SALES), ("F3",))
def interactions(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + list(_F3))
    # row-wise IEEE arithmetic is bit-identical across engines: no rounding needed
    return FE.add_interactions(s, _F3)


@register("f4_group_stats", with_views(f"""
SELECT {KEY_SQL}, region, product, sales,
  {', '.join(f"{rsql(f'{fn}(sales) OVER (PARTITION BY {k})', 4)} AS sales_{k}_{a}"
             for k in ('region', 'product')
             for a, fn in (('mean', 'avg'), ('sum', 'sum'), ('std', 'stddev_samp'), ('min', 'min'), ('max', 'max')))},
  count(sales) OVER (PARTITION BY region) AS sales_region_count, count(sales) OVER (PARTITION BY product) AS sales_product_count
FROM sales""", **SALES), ("F4", "J3", "W4"))
def group_stats(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["region", "product", "sales"])
    return rounded(FE.add_group_stats(s, "sales", ["region", "product"]), 4)


def _hist_sql(lags=(1, 7, 30), windows=(7, 30)):
    w = f"PARTITION BY region, product ORDER BY {ORDER_SQL}"
    cols = [f"lag(sales, {n}) OVER ({w}) AS sales_lag_{n}" for n in lags]
    for size in windows:
        fr = f"{w} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW"
        for a, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            cols.append(f"{rsql(f'{fn}(sales) OVER ({fr})', 6)} AS sales_rolling_{size}_{a}")
    return ", ".join(cols)


@register("f5_all_features", with_views(f"""
SELECT {KEY_SQL}, date, region, product, price, quantity, sales, {TIME_SQL}, {_hist_sql()},
  price * quantity AS price_x_quantity, price / quantity AS price_div_quantity
FROM sales""", **SALES), ("F5", "F2"))
def all_features(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["l_extendedprice", "date", "region", "product", "price", "quantity", "sales"])
    s = spool(s, "f5-sales")  # counted, looked at for zeros, sampled and dealt: the joins run once
    out = FE.add_all_features(s, fx.SALES_ORDER, "sales", ("region", "product"))
    out = out.drop("l_extendedprice")
    out = rounded(out, 6, cols=["month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos"])
    return rounded(out, 6, cols=[c for c in out.columns if c.startswith("sales_rolling")])


@register("f6_demand_index", with_views(f"""
WITH b AS (SELECT product, avg(quantity) AS base FROM sales GROUP BY product),
s0 AS (SELECT min(date) AS start FROM sales),
e AS (SELECT s.product, CAST(month(s.date) AS INTEGER) AS month, s.quantity,
        b.base * [0.8, 0.85, 0.95, 1.0, 1.05, 1.1, 1.15, 1.1, 1.0, 1.05, 1.2, 1.4][month(s.date)]
        * CASE WHEN isodow(s.date) >= 6 THEN 1.0 ELSE [0.95, 1.0, 1.0, 1.05, 1.1][isodow(s.date)] END
        * (1.0 + 0.15 * (s.date - s0.start) / 365.25) AS expected
      FROM sales s JOIN b ON s.product = b.product CROSS JOIN s0)
SELECT product, month, count(*) AS n_rows, {rsql('CAST(sum(quantity) AS DOUBLE)', 2)} AS actual, {rsql('sum(expected)', 4)} AS expected,
       {rsql('sum(quantity) / sum(expected)', 6)} AS demand_ratio
FROM e GROUP BY product, month""", **SALES), ("F6",))
def demand_index(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "product", "quantity"])
    d = FE.demand_index(s, "date", "region", "product", "quantity")
    out = d.groupBy("product", F.month("date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").cast("double").alias("actual"),
        F.sum("expected").alias("expected"))
    out = out.withColumn("demand_ratio", F.col("actual") / F.col("expected"))
    return rounded(rounded(out, 6, cols=["demand_ratio"]), 4, cols=["expected"]).withColumn(
        "actual", F.round("actual", 2))


@register("f7_serving_features", with_views(f"""
SELECT {KEY_SQL}, coalesce(price, 0) AS price, coalesce(quantity, 0) AS quantity, {TIME_SQL},
  coalesce(price * quantity, 0) AS price_x_quantity, coalesce(price / quantity, 0) AS price_div_quantity
FROM sales""", **SALES), ("F7",))
def serving(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["date", "region", "product", "price", "quantity"])
    feats = ["price", "quantity", *FE.TIME_FEATURES, "price_x_quantity", "price_div_quantity"]
    out = FE.serving_features(s, feats, plan=[("price", "quantity", True)])
    return rounded(out, 6, cols=["month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos"])
