"""Registered model queries (M1, M4-M13, J5, X1, X2, FS6/FS7 via training)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from salesflow.functions.exprs import rnd
from salesflow.operators import gram as G
from salesflow.operators import models as M
from salesflow.operators import relational as R
from salesflow.operators import udf as U
from salesflow.operators.relational import label_period
from salesflow.plans.common import max_scalar, rounded, rsql, sales, sig, sig_sql, spool
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import sales_sql, with_views

SALES = {"sales": sales_sql()}
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)


def metric_sql(y: str, p: str, cond: str | None = None, prefix: str = "") -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    e = f"(({y}) - ({p}))"
    sse, sst = f"sum({e} * {e}){f}", f"(count({y}){f} * var_pop({y}){f})"
    return ", ".join([
        f"count({e}){f} AS {prefix}n",
        f"{rsql(f'sqrt(avg({e} * {e}){f})', 6)} AS {prefix}rmse",
        f"{rsql(f'avg(abs({e})){f}', 6)} AS {prefix}mae",
        f"{rsql(f'CASE WHEN {sst} = 0 THEN (CASE WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - {sse} / {sst} END', 6)} AS {prefix}r2",
        f"{sig_sql(f'avg(abs({e}) / greatest(abs({y}), 2.220446049250313e-16)){f} * 100', 9)} AS {prefix}mape"])


def _round_metrics(df, prefix=""):
    out = rounded(df, 6, cols=[f"{prefix}{m}" for m in ("rmse", "mae", "r2")])
    return out.withColumn(f"{prefix}mape", sig(f"{prefix}mape", 9))


@register("m6_regression_metrics", with_views(f"SELECT {metric_sql('sales', 'predicted')} FROM sales", **SALES),
          ("M6",))
def regression_metrics(spark, sf_dir):
    return _round_metrics(M.regression_metrics(sales(spark, sf_dir, ["sales", "predicted"]), "sales", "predicted"))


@register("m6_metrics_by_region", with_views(
    f"SELECT region, {metric_sql('sales', 'predicted')} FROM sales GROUP BY region", **SALES), ("M6",))
def metrics_by_region(spark, sf_dir):
    s = sales(spark, sf_dir, ["region", "sales", "predicted"])
    return _round_metrics(M.regression_metrics(s, "sales", "predicted", by=["region"]))


# runs: one "model" per category; train = rows before the last 365 days, test = the last 365 days
def _runs(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "category", "sales", "predicted"])
    lab = label_period(s, "date", max_scalar(s, "date"), 365)
    test = F.col("period") == "current"
    runs = lab.groupBy(F.col("category").alias("run_id")).agg(
        *M.metric_exprs("sales", "predicted", where=~test), *M.metric_exprs("sales", "predicted", "test_", test),
        F.max("date").cast("timestamp").alias("start_time"))
    runs = runs.withColumn("status", F.when(F.col("test_n") > 0, F.lit("FINISHED")).otherwise(F.lit("FAILED")))
    return _round_metrics(_round_metrics(runs), "test_")


_RUNS_SQL = with_views(f"""
SELECT category AS run_id, {metric_sql('sales', 'predicted', 'NOT is_test')},
  {metric_sql('sales', 'predicted', 'is_test', 'test_')}, CAST(max(date) AS TIMESTAMP) AS start_time,
  CASE WHEN count(*) FILTER (WHERE is_test) > 0 THEN 'FINISHED' ELSE 'FAILED' END AS status
FROM (SELECT *, date >= (SELECT max(date) FROM sales) - INTERVAL 365 DAY AS is_test FROM sales) GROUP BY category""",
                       **SALES)


@register("m4_runs_table", _RUNS_SQL, ("M4", "M6"))
def runs_table(spark, sf_dir):
    return _runs(spark, sf_dir)


@register("m7_compare_models", f"""
SELECT *, rmse = min(rmse) OVER () AS best_rmse, mae = min(mae) OVER () AS best_mae,
  r2 = max(r2) OVER () AS best_r2, mape = min(mape) OVER () AS best_mape FROM ({_RUNS_SQL})""", ("M7",))
def compare_models(spark, sf_dir):
    return M.compare_models(_runs(spark, sf_dir), "rmse")


@register("m5_best_run", f"""
SELECT * FROM ({_RUNS_SQL}) WHERE status <> 'FAILED' AND test_rmse IS NOT NULL
ORDER BY test_rmse, run_id LIMIT 1""", ("M5",))
def best_run(spark, sf_dir):
    return M.best_run(_runs(spark, sf_dir), "test_rmse")


# runs of a model for each category within a region: the same tables, compared within the region
_GROUP_RUNS_SQL = with_views(f"""
SELECT region, category AS run_id, {metric_sql('sales', 'predicted', 'NOT is_test')},
  {metric_sql('sales', 'predicted', 'is_test', 'test_')}
FROM (SELECT *, date >= (SELECT max(date) FROM sales) - INTERVAL 365 DAY AS is_test FROM sales) GROUP BY region, category""", **SALES)


def _group_runs(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "region", "category", "sales", "predicted"])
    lab = label_period(s, "date", max_scalar(s, "date"), 365)
    test = F.col("period") == "current"
    runs = lab.groupBy("region", F.col("category").alias("run_id")).agg(
        *M.metric_exprs("sales", "predicted", where=~test), *M.metric_exprs("sales", "predicted", "test_", test))
    return _round_metrics(_round_metrics(runs), "test_")


@register("m7_compare_models_by_region", f"""
SELECT *, rmse = min(rmse) OVER g AS best_rmse, mae = min(mae) OVER g AS best_mae, r2 = max(r2) OVER g AS best_r2,
  mape = min(mape) OVER g AS best_mape FROM ({_GROUP_RUNS_SQL}) WINDOW g AS (PARTITION BY region)""", ("M7",))
def compare_models_by_region(spark, sf_dir):
    return M.compare_models(_group_runs(spark, sf_dir), "rmse", by=["region"])


@register("m5_best_run_by_region", f"""
SELECT * FROM ({_GROUP_RUNS_SQL}) WHERE test_rmse IS NOT NULL QUALIFY row_number() OVER (PARTITION BY region ORDER BY test_rmse, run_id) = 1""", ("M5",))
def best_run_by_region(spark, sf_dir):
    return M.best_run(_group_runs(spark, sf_dir), "test_rmse", by=["region"])


@register("m8_top_runs_by_region", f"""
SELECT * FROM ({_GROUP_RUNS_SQL}) QUALIFY row_number() OVER (PARTITION BY region ORDER BY r2 DESC, run_id) <= 3""", ("M8",))
def top_runs_by_region(spark, sf_dir):
    return M.search_runs(_group_runs(spark, sf_dir), "r2", False, 3, by=["region"])


@register("m8_run_search", f"SELECT * FROM ({_RUNS_SQL}) ORDER BY rmse, run_id LIMIT 10", ("M8",))
def run_search(spark, sf_dir):
    return M.search_runs(_runs(spark, sf_dir), "rmse", True, 10)


@register("m8_recent_runs", f"SELECT * FROM ({_RUNS_SQL}) ORDER BY start_time DESC, run_id LIMIT 10", ("M8",))
def recent_runs(spark, sf_dir):
    return M.search_runs(_runs(spark, sf_dir), "start_time", False, 10)


@register("m9_improvement_gate", f"""
SELECT run_id, test_rmse AS current, CAST(2000.0 AS DOUBLE) AS baseline, {rsql('(2000.0 - test_rmse) / 2000.0 * 100', 6)}
  AS improvement_pct, test_rmse < 2000.0 AS register FROM ({_RUNS_SQL})""", ("M9",))
def improvement_gate(spark, sf_dir):
    return rounded(M.improvement_gate(_runs(spark, sf_dir), 2000.0), cols=["improvement_pct"])


# model_versions: one version per (category, ship year); stage by a fixed rule on the version number
_STAGES = ("Production", "Staging", "None")


def _versions(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "category", "sales", "predicted"])
    v = s.groupBy(F.col("category").alias("name"), F.year("date").alias("year")).agg(
        *M.metric_exprs("sales", "predicted"), F.max("date").cast("timestamp").alias("created_at"))
    v = v.withColumn("version", (F.col("year") - F.lit(1994)).cast("int"))
    v = v.withColumn("stage", F.element_at(F.array(*[F.lit(x) for x in _STAGES]),
                                           (F.pmod("version", F.lit(3)) + 1).cast("int")))
    return rounded(v.select("name", "version", "stage", "created_at", "rmse"), 6)


_VERSIONS_SQL = with_views(f"""
SELECT name, version, CASE version % 3 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging' ELSE 'None' END AS stage,
  created_at, rmse FROM (
  SELECT category AS name, CAST(year(date) - 1994 AS INTEGER) AS version, CAST(max(date) AS TIMESTAMP) AS created_at,
         {rsql('sqrt(avg((sales - predicted) * (sales - predicted)))', 6)} AS rmse FROM sales GROUP BY category, year(date))""",
                           **SALES)


@register("m10_latest_per_stage", f"""
SELECT * FROM ({_VERSIONS_SQL}) QUALIFY row_number() OVER (PARTITION BY name, stage ORDER BY version DESC) = 1""",
          ("M10", "W8"))
def latest_per_stage(spark, sf_dir):
    return M.latest_per_stage(_versions(spark, sf_dir))


@register("m10_archive_old", f"""
SELECT *, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY version DESC) > 3
  AND stage NOT IN ('Production', 'Staging') THEN 'Archived' ELSE stage END AS new_stage FROM ({_VERSIONS_SQL})""",
          ("M10",))
def archive_old(spark, sf_dir):
    return M.archive_old(_versions(spark, sf_dir), keep=3)


# a life cycle: register the next version of every second model, promote it, look up what serves
_LIFE = "SELECT name FROM (SELECT name, row_number() OVER (ORDER BY name) AS i FROM (SELECT DISTINCT name FROM v)) WHERE i = 2"


@register("m10_lifecycle", with_views(f"""
WITH m AS ({_LIFE}), n AS (SELECT name, version, stage FROM v UNION ALL
  SELECT name, CAST(max(version) + 1 AS INTEGER), 'None' FROM v WHERE name = (SELECT name FROM m) GROUP BY name),
t AS (SELECT name, version, CASE WHEN name = (SELECT name FROM m) AND version = (SELECT max(version) FROM n WHERE name = (SELECT name FROM m))
        THEN 'Production' WHEN name = (SELECT name FROM m) AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage FROM n)
SELECT name, version, stage, name = (SELECT name FROM m) AND stage = 'Production' AS serves FROM t""", v=_VERSIONS_SQL), ("M10",))
def lifecycle(spark, sf_dir):
    v = _versions(spark, sf_dir)
    model = v.select("name").distinct().orderBy("name").offset(1).first()["name"]
    new = M.register_model(v, model)
    newest = new.where(F.col("name") == model).agg(F.max("version")).first()[0]
    moved = M.transition(new, model, newest, "Production", archive_existing=True)
    live = M.production_version(moved, model).select("name", "version", F.lit(True).alias("serves"))
    out = moved.select("name", "version", "stage").join(live, ["name", "version"], "left")
    return out.withColumn("serves", F.coalesce("serves", F.lit(False)))


@register("m10_next_version", f"SELECT name, max(version) + 1 AS next_version FROM ({_VERSIONS_SQL}) GROUP BY name",
          ("M10",))
def next_version(spark, sf_dir):
    return M.next_version(_versions(spark, sf_dir))


@register("j5_stage_comparison", f"""
WITH l AS (SELECT * FROM ({_VERSIONS_SQL}) QUALIFY row_number() OVER (PARTITION BY name, stage ORDER BY version DESC) = 1)
SELECT n.name, p.version AS production_version, p.rmse AS production_rmse, s.version AS staging_version,
  s.rmse AS staging_rmse, s.rmse - p.rmse AS rmse_delta
FROM (SELECT DISTINCT name FROM l) n LEFT JOIN l p ON p.name = n.name AND p.stage = 'Production'
LEFT JOIN l s ON s.name = n.name AND s.stage = 'Staging'""", ("J5",))
def stage_comparison(spark, sf_dir):
    return R.compare_stages(_versions(spark, sf_dir), "name", "stage", "version", "rmse")


# MLlib linear regression, one feature, checked against regr_slope --------------------
def _lr_one_feature(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["quantity", "sales"]).withColumn("quantity", F.col("quantity").cast("double"))
    data = M.assemble(s, ["quantity"], "sales")
    model = M.make_estimator("linear").fit(data)
    return s, data, model


@register("m1_linear_regression", with_views(f"""
SELECT {rsql('regr_slope(sales, quantity)', 6)} AS slope, {rsql('regr_intercept(sales, quantity)', 4)} AS intercept
FROM sales""", **SALES), ("M1",))
def linear_regression(spark, sf_dir):
    _, _, model = _lr_one_feature(spark, sf_dir)
    row = [(float(model.coefficients[0]), float(model.intercept))]
    out = spark.createDataFrame(row, "slope double, intercept double")
    return rounded(rounded(out, 6, cols=["slope"]), 4, cols=["intercept"])


@register("m11_batch_scoring", with_views(f"""
SELECT {KEY_SQL}, {rsql('(SELECT regr_intercept(sales, quantity) FROM sales) + (SELECT regr_slope(sales, quantity) FROM sales) * quantity', 4)}
  AS predicted_sales, 'lr_quantity' AS model_name, '1' AS model_version FROM sales""", **SALES), ("M11", "M12"))
def batch_scoring(spark, sf_dir):
    s, data, model = _lr_one_feature(spark, sf_dir)
    scored = M.score(data.select(*KEY, "features"), model, KEY, "lr_quantity", 1, ts="2024-01-01 00:00:00")
    return rounded(scored.select(*KEY, "predicted_sales", "model_name", "model_version"), 4)


@register("m4_train_models", None, ("M2", "M3", "M4", "FS6", "FS7"))
def train_models(spark, sf_dir):
    """LR + random forest + boosted trees on the feature matrix; a runs table (rows-only check)."""
    from salesflow.operators.preprocess import split
    # the joins of the view run once, not at every pass of the split
    s = spool(sales(spark, sf_dir, KEY + ["l_extendedprice", "date", *fx.FEATURE_COLS, "sales"]), "m4-columns")
    data = split(s.withColumn("quantity", F.col("quantity").cast("double")), fx.SALES_ORDER, 0.2)
    _, runs = M.train_many(data, list(fx.FEATURE_COLS), "sales")
    return runs.select("run_id", "status", "rmse", "test_rmse", "r2", "test_r2")


# M1 for each group, M13: moment matrices, checked against closed forms for two features -----------------
_REGS = (0.0, 0.1, 1.0)
_TWO = "quantity AS x, price AS z, sales AS y"


def _fit_sql(reg: str = "0") -> str:
    """Coefficients bx, bz and the intercept a from population covariances, ``reg`` on standardised coefficients."""
    vx, vz = f"(var_pop(x) * (1 + {reg}))", f"(var_pop(z) * (1 + {reg}))"
    det = f"({vx} * {vz} - covar_pop(x, z) * covar_pop(x, z))"
    bx = f"(covar_pop(x, y) * {vz} - covar_pop(z, y) * covar_pop(x, z)) / {det}"
    bz = f"(covar_pop(z, y) * {vx} - covar_pop(x, y) * covar_pop(x, z)) / {det}"
    return f"{bx} AS bx, {bz} AS bz, avg(y) - ({bx}) * avg(x) - ({bz}) * avg(z) AS a"


@register("m1_grouped_regression", with_views(f"""
WITH s AS (SELECT region, category, {_TWO} FROM sales), f AS (SELECT region, category, {_fit_sql()} FROM s GROUP BY region, category)
SELECT region, category, count(*) AS n, {rsql('any_value(a)', 3)} AS intercept, {rsql('any_value(bx)', 4)} AS b_quantity, {rsql('any_value(bz)', 5)} AS b_price,
  {rsql('sqrt(avg((y - a - bx * x - bz * z) * (y - a - bx * x - bz * z)))', 3)} AS rmse,
  {rsql('1 - sum((y - a - bx * x - bz * z) * (y - a - bx * x - bz * z)) / (count(*) * var_pop(y))', 6)} AS r2
FROM s JOIN f USING (region, category) GROUP BY region, category""", **SALES), ("M1", "M6"))
def grouped_regression(spark, sf_dir):
    s = sales(spark, sf_dir, ["region", "category", "quantity", "price", "sales"])
    out = G.grouped_regression(s, ["quantity", "price"], "sales", by=["region", "category"])
    return out.select("region", "category", "n", rnd("intercept", 3).alias("intercept"), rnd(F.col("coefficients")[0], 4).alias("b_quantity"),
                      rnd(F.col("coefficients")[1], 5).alias("b_price"), rnd("rmse", 3).alias("rmse"), rnd("r2", 6).alias("r2"))


def _folds_sql(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    on = f"s.{by} = f.{by} AND " if by else ""
    own = f"s.{by}, " if by else ""
    return with_views(f"""
WITH s AS (SELECT {lead}{_TWO}, l_orderkey % 5 AS fold FROM sales), regs AS (SELECT unnest([{', '.join(map(str, _REGS))}]) AS reg),
k AS (SELECT DISTINCT {lead}fold AS k FROM s),
f AS (SELECT {own}k.k AS fold, reg, count(*) AS n_train, {_fit_sql('reg')} FROM s JOIN k ON {f's.{by} = k.{by} AND ' if by else ''}s.fold <> k.k, regs
      GROUP BY {own}k.k, reg)
SELECT {own}reg, CAST(f.fold AS INTEGER) AS fold, any_value(n_train) AS n_train, count(*) AS n_test, {rsql('any_value(a)', 3)} AS intercept,
  {rsql('any_value(bx)', 4)} AS b_quantity, {rsql('any_value(bz)', 5)} AS b_price,
  {rsql('sqrt(avg((y - a - bx * x - bz * z) * (y - a - bx * x - bz * z)))', 3)} AS rmse
FROM s JOIN f ON {on}s.fold = f.fold GROUP BY {own}reg, f.fold""", **SALES)


def _folds(spark, sf_dir, by=()):
    s = sales(spark, sf_dir, ["l_orderkey", "quantity", "price", "sales", *by])
    return G.cross_validate(s, ["quantity", "price"], "sales", F.col("l_orderkey") % 5, _REGS, by)


@register("m13_grouped_folds", _folds_sql("region"), ("M13", "M1"))
def grouped_folds(spark, sf_dir):
    out = _folds(spark, sf_dir, ["region"])
    return out.select("region", "reg", "fold", "n_train", "n_test", rnd("intercept", 3).alias("intercept"), rnd(F.col("coefficients")[0], 4).alias("b_quantity"),
                      rnd(F.col("coefficients")[1], 5).alias("b_price"), rnd("rmse", 3).alias("rmse"))


@register("m13_cross_validation", f"""
WITH folds AS ({_folds_sql()}), m AS (SELECT reg, avg(rmse) AS avg_rmse FROM folds GROUP BY reg)
SELECT CAST(row_number() OVER (ORDER BY reg) - 1 AS INTEGER) AS param_map, CAST(reg AS DOUBLE) AS reg, round(avg_rmse, 2) AS avg_rmse,
  reg = (SELECT reg FROM m ORDER BY avg_rmse, reg LIMIT 1) AS best FROM m""", ("M13",))
def cross_validation(spark, sf_dir):
    s = sales(spark, sf_dir, ["l_orderkey", "quantity", "price", "sales"])
    _, scores = M.cross_validate(s, ["quantity", "price"], "sales", "linear", folds=5, fold=F.col("l_orderkey") % 5, grid={"regParam": list(_REGS)})
    least = min(m for _, m in scores)
    rows = [(i, p["regParam"], round(m, 2), m == least) for i, (p, m) in enumerate(scores)]
    return spark.createDataFrame(rows, "param_map int, reg double, avg_rmse double, best boolean")


# A foreign (pandas) model applied in Arrow batches ---------------------------------------------------
def _foreign_predict(x: pd.DataFrame):
    return x["price"] * x["quantity"] * (1.0 - x["l_discount"])


@register("x1_python_model_scoring", with_views(f"""
SELECT {KEY_SQL}, price, quantity, l_discount, price * quantity * (1.0 - l_discount) AS prediction FROM sales""",
                                                **SALES), ("X1",))
def python_model_scoring(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["price", "quantity", "l_discount"])
    return M.score_with_python(s, _foreign_predict, ["price", "quantity", "l_discount"])


# Per-group pandas function on bounded (group, chunk + halo) pieces -------------------------------------
def _pandas_rolling_mean(pdf: pd.DataFrame) -> pd.Series:
    return pdf["sales"].rolling(7, min_periods=1).mean()


@register("x2_group_apply", with_views(f"""
SELECT {KEY_SQL}, region, product, {rsql('avg(sales) OVER (PARTITION BY region, product ORDER BY date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 6)} AS value
FROM sales""", **SALES), ("X2",))
def group_apply(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + ["l_extendedprice", "date", "region", "product", "sales"])
    out = U.apply_in_groups(s, _pandas_rolling_mean, ["region", "product"], list(fx.SALES_ORDER),
                            halo=6, chunk_rows=1000)
    return rounded(out.select(*KEY, "region", "product", "value"), 6)
