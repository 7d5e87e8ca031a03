"""Registered preprocessing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import preprocess as P
from salesflow.plans.common import null_every, null_every_sql, rounded, rsql, sales
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import sales_sql, with_views

SALES = {"sales": sales_sql()}
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)
ORDER_SQL = "date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@register("t1_chrono_split", with_views(f"""
SELECT {KEY_SQL}, date, CASE WHEN row_number() OVER (ORDER BY {ORDER_SQL}) - 1
  >= count(*) OVER () - ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM sales""", **SALES),
          ("T1",))
def chrono_split(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["l_extendedprice", "date"])
    return P.split(s, fx.SALES_ORDER, 0.2).drop("l_extendedprice")


@register("t2_shuffled_split_sizes", with_views("""
SELECT 'test' AS split, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n_rows FROM sales
UNION ALL SELECT 'train', CAST(count(*) - ceil(count(*) * 0.2) AS BIGINT) FROM sales""", **SALES), ("T2",))
def shuffled_split(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["l_extendedprice", "date"])
    out = P.split(s, fx.SALES_ORDER, 0.2, shuffle=True, seed=42, key=KEY + ["l_extendedprice"])
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("t2_shuffled_split", with_views(f"""
SELECT {KEY_SQL}, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws(':', 42, {KEY_SQL})), {KEY_SQL}, l_extendedprice) - 1
  >= count(*) OVER () - ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM sales""", **SALES), ("T2",))
def shuffled_split_rows(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["l_extendedprice"])
    draw = F.md5(F.concat_ws(":", F.lit("42"), *[F.col(k).cast("string") for k in KEY]).cast("binary"))
    return P.split(s, fx.SALES_ORDER, 0.2, shuffle=True, key=KEY + ["l_extendedprice"], draw=draw).drop("l_extendedprice")


_SCALE = ("price", "quantity", "sales")


@register("t3_standard_scale", with_views(f"""
WITH m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALE)} FROM sales)
SELECT {KEY_SQL}, {', '.join(rsql(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END', 6) + f' AS {c}'
                            for c in _SCALE)} FROM sales, m""", **SALES), ("T3",))
def standard_scale(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + list(_SCALE)).withColumn("quantity", F.col("quantity").cast("double"))
    return rounded(P.fit_scaler(s, _SCALE).transform(s))


_ONE_HOT_SQL = ", ".join(f"CAST(region = '{r}' AS INTEGER) AS \"region_{r}\""
                         for r in ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))


@register("t4_one_hot_region", with_views(f"SELECT {KEY_SQL}, {_ONE_HOT_SQL} FROM sales", **SALES), ("T4",))
def one_hot(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["region"])
    return P.fit_encoder(s, ["region"], "onehot").transform(s)


@register("t5_label_encode_product", with_views(f"""
SELECT {KEY_SQL}, CAST(dense_rank() OVER (ORDER BY product) - 1 AS INTEGER) AS product FROM sales""", **SALES),
          ("T5",))
def label_encode(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["product"])
    return P.fit_encoder(s, ["product"], "label").transform(s)


# T6 / T7 on a frame with deterministic holes ------------------------------------------------------
def _holes(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["price", "l_discount", "category"])
    return s.select(*KEY, null_every("price", "l_orderkey", 17).alias("price"),
                    null_every("l_discount", "l_linenumber", 5).alias("l_discount"),
                    null_every("category", "l_partkey", 11).alias("category"))


_HOLES_SQL = f"""SELECT {KEY_SQL}, {null_every_sql('price', 'l_orderkey', 17)} AS price,
  {null_every_sql('l_discount', 'l_linenumber', 5)} AS l_discount,
  {null_every_sql('category', 'l_partkey', 11)} AS category FROM ({sales_sql()})"""


def _rounded_fill(imp):
    # stored row values pass through untouched; only the fitted fill value is rounded
    return P.Imputer(imp.strategy, {c: round(v, 6) for c, v in imp.values.items()})


@register("t6_impute_mean", with_views(f"""
SELECT {KEY_SQL}, coalesce(price, (SELECT round(avg(price), 6) FROM h)) AS price,
  coalesce(l_discount, (SELECT round(avg(l_discount), 6) FROM h)) AS l_discount, category FROM h""", h=_HOLES_SQL),
          ("T6",))
def impute_mean(spark, sf_dir):
    h = _holes(spark, sf_dir)
    return _rounded_fill(P.fit_imputer(h, "mean", cols=["price", "l_discount"])).transform(h)


@register("t6_impute_median", with_views(f"""
SELECT {KEY_SQL}, coalesce(price, (SELECT round(quantile_cont(price, 0.5), 6) FROM h)) AS price,
  coalesce(l_discount, (SELECT round(quantile_cont(l_discount, 0.5), 6) FROM h)) AS l_discount, category FROM h""",
                                          h=_HOLES_SQL), ("T6",))
def impute_median(spark, sf_dir):
    h = _holes(spark, sf_dir)
    return _rounded_fill(P.fit_imputer(h, "median", cols=["price", "l_discount"])).transform(h)


@register("t6_impute_mode", with_views(f"""
SELECT {KEY_SQL}, price, l_discount,
  coalesce(category, (SELECT category FROM h WHERE category IS NOT NULL GROUP BY category
                      ORDER BY count(*) DESC, category LIMIT 1)) AS category FROM h""", h=_HOLES_SQL), ("T6",))
def impute_mode(spark, sf_dir):
    h = _holes(spark, sf_dir)
    return P.fit_imputer(h, "mode", cols=["category"]).transform(h)


@register("t6_impute_constant", with_views(f"""
SELECT {KEY_SQL}, coalesce(price, 0.0) AS price, coalesce(l_discount, 0.0) AS l_discount, category FROM h""",
                                            h=_HOLES_SQL), ("T6",))
def impute_constant(spark, sf_dir):
    h = _holes(spark, sf_dir)
    return P.fit_imputer(h, "constant", fill_value=0.0, cols=["price", "l_discount"]).transform(h)


@register("t7_drop_missing", with_views(f"""
SELECT * FROM h WHERE price IS NOT NULL AND l_discount IS NOT NULL""", h=_HOLES_SQL), ("T7", "T6"))
def drop_missing(spark, sf_dir):
    return P.drop_missing(_holes(spark, sf_dir), ["price", "l_discount"])


# T8 / T9 --------------------------------------------------------------------------------------
def _seq_fence_sql(cols, method, k):
    ctes, prev = [], "src"
    for i, c in enumerate(cols):
        if method == "iqr":
            ctes.append(f"f{i} AS (SELECT quantile_cont({c}, 0.25) - {k} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, "
                        f"quantile_cont({c}, 0.75) + {k} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM {prev})")
            cond = f"{c} >= lo AND {c} <= hi"
        else:
            ctes.append(f"f{i} AS (SELECT avg({c}) - {k} * stddev_pop({c}) AS lo, avg({c}) + {k} * stddev_pop({c}) AS hi FROM {prev})")
            cond = f"{c} > lo AND {c} < hi"
        ctes.append(f"s{i} AS (SELECT {prev}.* FROM {prev}, f{i} WHERE {cond})")
        prev = f"s{i}"
    return ctes, prev


def _outlier_query(name, method, k, ids):
    cols = ("price", "sales")
    ctes, last = _seq_fence_sql(cols, method, k)
    sql = with_views(f"""WITH src AS (SELECT price, sales, date FROM sales), {', '.join(ctes)}
SELECT count(*) AS n_rows, {rsql('sum(sales)', 2)} AS total, min(price) AS min_price, max(price) AS max_price
FROM {last}""", **SALES)

    def build(spark, sf_dir):
        s = sales(spark, sf_dir, ["price", "sales", "date"])
        kept = P.remove_outliers(s, cols, method, k, mode="sequential")
        return rounded(kept.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("total"),
                                F.min("price").alias("min_price"), F.max("price").alias("max_price")),
                       money=("total",))

    register(name, sql, ids)(build)


_outlier_query("t8_iqr_outliers", "iqr", 1.5, ("T8", "Q9"))
_outlier_query("t9_zscore_outliers", "zscore", 2.0, ("T9",))


# T10 --------------------------------------------------------------------------------------------
_T10_NUM = ("price", "l_discount")


@register("t10_preprocess", with_views(f"""
WITH d AS (SELECT * FROM h WHERE price IS NOT NULL AND l_discount IS NOT NULL AND category IS NOT NULL),
e AS (SELECT d.*, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS category_code,
        CASE WHEN row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1
             >= count(*) OVER () - ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM d),
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _T10_NUM)} FROM e WHERE split = 'train')
SELECT {KEY_SQL}, category_code AS category, split,
  {', '.join(rsql(f'({c} - m_{c}) / s_{c}', 6) + f' AS {c}' for c in _T10_NUM)} FROM e, m""", h=_HOLES_SQL),
          ("T10",))
def full_preprocess(spark, sf_dir):
    h = _holes(spark, sf_dir)
    _, out = P.preprocess(h, KEY, "sales", categorical=["category"], numeric=list(_T10_NUM),
                          missing="drop", encode="label")
    return rounded(out)
