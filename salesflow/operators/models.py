"""Model training, scoring, evaluation and run / version tables.

Regression metrics are one aggregation (partial sums per task, O(1) state).
Training uses MLlib's linear regression and the trees of ``operators/forest.py`` on
one cached frame. Run and version
tables are ordinary small DataFrames; every operation on them is a query.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions.exprs import nan_to_null
from salesflow.operators.blocks import attach

EPS = 2.220446049250313e-16  # float64 machine epsilon (MAPE denominator guard)
LOWER_IS_BETTER = {"rmse": True, "mae": True, "mape": True, "r2": False}


# M6 ---------------------------------------------------------------------------------------------
def metric_exprs(actual: str, predicted: str, prefix: str = "", where: Column | None = None) -> list[Column]:
    """Aggregate expressions for n, rmse, mae, r2, mape; ``where`` restricts the rows (conditional agg)."""
    y = nan_to_null(F.col(actual).cast("double"))
    p = nan_to_null(F.col(predicted).cast("double"))
    y, p = F.when(p.isNotNull(), y), F.when(y.isNotNull(), p)  # complete pairs only
    if where is not None:
        y, p = F.when(where, y), F.when(where, p)
    e = y - p
    sse = F.sum(e * e)
    sst = F.count(y) * F.var_pop(y)
    r2 = F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - sse / sst)
    return [F.count(e).alias(f"{prefix}n"),
            F.sqrt(F.avg(e * e)).alias(f"{prefix}rmse"),
            F.avg(F.abs(e)).alias(f"{prefix}mae"),
            r2.alias(f"{prefix}r2"),
            (F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPS))) * 100).alias(f"{prefix}mape")]


def regression_metrics(df: DataFrame, actual: str, predicted: str, by=()) -> DataFrame:
    """n, rmse, mae, r2, mape (x100, denominator max(|y|, eps)) per group."""
    return df.groupBy(*by).agg(*metric_exprs(actual, predicted))


# M7 ---------------------------------------------------------------------------------------------
def compare_models(runs: DataFrame, metric: str = "rmse", metrics=("rmse", "mae", "r2", "mape"), by=()) -> DataFrame:
    """Sort by ``metric`` and flag the best value per metric (min, or max for r2), within each ``by`` group.

    The best values are one aggregate (a row for each group), attached to the runs.
    """
    by = list(by)
    best = runs.groupBy(*by).agg(*[(F.min if LOWER_IS_BETTER.get(m, True) else F.max)(m).alias(f"_b_{m}") for m in metrics])
    out = attach(runs, best, by)
    out = out.select(*runs.columns, *[(F.col(m) == F.col(f"_b_{m}")).alias(f"best_{m}") for m in metrics])
    asc = LOWER_IS_BETTER.get(metric, True)
    return out.orderBy(*by, F.col(metric).asc() if asc else F.col(metric).desc())


# M5 ---------------------------------------------------------------------------------------------
def best_run(runs: DataFrame, metric: str = "test_rmse", ascending: bool = True,
             status: str = "status", by=()) -> DataFrame:
    """The best run that did not fail (for each ``by`` group); ties go to the smaller ``run_id``."""
    ok = runs.where(F.col(status) != "FAILED") if status in runs.columns else runs
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    ok = ok.where(F.col(metric).isNotNull())
    return _first_per_group(ok, by, [order, F.col("run_id")], 1) if by else ok.orderBy(order, F.col("run_id")).limit(1)


def _first_per_group(df: DataFrame, by, order, n: int) -> DataFrame:
    """The first ``n`` rows of each group: ``row_number() <= n`` is cut before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_sf_rn", F.row_number().over(w)).where(F.col("_sf_rn") <= n).drop("_sf_rn")


# M8 ---------------------------------------------------------------------------------------------
def search_runs(runs: DataFrame, order_by: str = "rmse", ascending: bool = True, limit: int | None = None,
                where: Column | None = None, by=()) -> DataFrame:
    """Runs in order (``limit`` of them), or with ``by`` the first ``limit`` of each group."""
    out = runs.where(where) if where is not None else runs
    if by and limit:
        out = _first_per_group(out, by, [F.col(order_by).asc() if ascending else F.col(order_by).desc(), F.col("run_id")], limit)
    out = out.orderBy(F.col(order_by).asc() if ascending else F.col(order_by).desc(), F.col("run_id"))
    return out.limit(limit) if limit and not by else out


# M9 ---------------------------------------------------------------------------------------------
def improvement_gate(candidate: DataFrame, baseline, metric: str = "test_rmse") -> DataFrame:
    """register = current < baseline; improvement_pct = (baseline - current) / baseline * 100."""
    b = baseline if isinstance(baseline, Column) else F.lit(float(baseline))
    return candidate.select("run_id", F.col(metric).alias("current"), b.alias("baseline"),
                            (F.try_divide(b - F.col(metric), b) * 100).alias("improvement_pct"),
                            (F.col(metric) < b).alias("register"))


# M10 --------------------------------------------------------------------------------------------
PROTECTED_STAGES = ("Production", "Staging")


def next_version(versions: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    return versions.groupBy(name).agg((F.max(version) + 1).alias("next_version"))


def register_model(versions: DataFrame, model: str, name: str = "name", stage: str = "stage", version: str = "version",
                   **values) -> DataFrame:
    """The version table with the model's next version appended (1 for a new model), in stage None."""
    types = {f.name: f.dataType for f in versions.schema.fields}
    nxt = versions.where(F.col(name) == model).agg((F.coalesce(F.max(version), F.lit(0)) + 1).alias("_v"))
    given = {name: F.lit(model), stage: F.lit("None"), version: F.col("_v")} | {k: F.lit(v) for k, v in values.items()}
    row = nxt.select(*[given.get(c, F.lit(None)).cast(types[c]).alias(c) for c in versions.columns])
    return versions.unionByName(row)


def production_version(versions: DataFrame, model: str, name: str = "name", stage: str = "stage", version: str = "version") -> DataFrame:
    """The newest Production version of a model (no row without one)."""
    live = versions.where((F.col(name) == model) & (F.col(stage) == "Production"))
    return live.orderBy(F.col(version).desc()).limit(1)


def latest_per_stage(versions: DataFrame, name: str = "name", stage: str = "stage",
                     version: str = "version") -> DataFrame:
    return versions.groupBy(name, stage).agg(
        F.max_by(F.struct(*[F.col(c) for c in versions.columns]), F.col(version)).alias("_v")).select("_v.*")


def archive_old(versions: DataFrame, keep: int = 3, name: str = "name", stage: str = "stage",
                version: str = "version") -> DataFrame:
    """All but the newest ``keep`` versions per model move to Archived, unless Production/Staging."""
    w = Window.partitionBy(name).orderBy(F.col(version).desc())
    rn = F.row_number().over(w)
    new = F.when((rn > keep) & ~F.col(stage).isin(*PROTECTED_STAGES), F.lit("Archived")).otherwise(F.col(stage))
    return versions.withColumn("new_stage", new)


def transition(versions: DataFrame, model: str, ver: int, to_stage: str, name: str = "name",
               stage: str = "stage", version: str = "version", archive_existing: bool = False) -> DataFrame:
    hit = (F.col(name) == model) & (F.col(version) == ver)
    out = versions.withColumn(stage, F.when(hit, F.lit(to_stage)).otherwise(F.col(stage)))
    if archive_existing:
        out = out.withColumn(stage, F.when((F.col(name) == model) & ~hit & (F.col(stage) == to_stage),
                                           F.lit("Archived")).otherwise(F.col(stage)))
    return out


# M1-M4 (MLlib) ---------------------------------------------------------------------------------
# The default hyperparameters of the three model kinds.
DEFAULT_PARAMS = {
    "linear": {},
    "random_forest": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 10, "seed": 42},
    "gbt": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.8", "seed": 42, "minInstancesPerNode": 3},
}


def make_estimator(kind: str, features_col: str = "features", label: str = "label", params=None):
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    p = dict(DEFAULT_PARAMS.get(kind, {}))
    p.update(params or {})
    if kind == "linear":
        return LinearRegression(featuresCol=features_col, labelCol=label, regParam=0.0, solver="normal",
                                fitIntercept=p.pop("fitIntercept", True), **p)
    if kind == "random_forest":
        return RandomForestRegressor(featuresCol=features_col, labelCol=label, **p)
    if kind == "gbt":
        return GBTRegressor(featuresCol=features_col, labelCol=label, **p)
    raise ValueError(f"unknown model kind {kind}")


def assemble(df: DataFrame, features, target: str | None = None, out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")
    res = va.transform(df)
    return res.withColumn("label", F.col(target).cast("double")) if target else res


def train(df: DataFrame, features, target: str, kind: str, params=None, split_col: str = "split"):
    """Fit one model on the train rows; metrics for train and test rows -> (model, runs row).

    Trees are grown by ``operators/forest.py`` (a ``forest.Trees``); linear models, and trees with other parameters
    than it knows, are MLlib pipelines.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from salesflow.operators import forest
    p = {**DEFAULT_PARAMS.get(kind, {}), **(params or {})}
    data = df.withColumn("label", F.col(target).cast("double"))
    train_df = data.where(F.col(split_col) == "train") if split_col in df.columns else data
    t0 = time.time()
    if forest.knows(p, kind):
        model = forest.fit(train_df, list(features), "label", kind, **p)
    else:
        va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
        model = Pipeline(stages=[va, make_estimator(kind, params=params)]).fit(train_df)
    secs = time.time() - t0
    scored = model.transform(data)
    by = [split_col] if split_col in df.columns else []
    m = regression_metrics(scored, "label", "prediction", by=by).collect()
    row = {"run_id": kind, "model": kind, "status": "FINISHED", "training_seconds": secs}
    for r in m:
        pre = "test_" if by and r[split_col] == "test" else ""
        for k in ("rmse", "mae", "r2", "mape"):
            row[pre + k] = float(r[k]) if r[k] is not None else None
    return model, row


RUN_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("run_id", T.StringType()), ("model", T.StringType()), ("status", T.StringType()), ("error", T.StringType()),
    ("training_seconds", T.DoubleType()), ("rmse", T.DoubleType()), ("mae", T.DoubleType()),
    ("r2", T.DoubleType()), ("mape", T.DoubleType()), ("test_rmse", T.DoubleType()),
    ("test_mae", T.DoubleType()), ("test_r2", T.DoubleType()), ("test_mape", T.DoubleType()))])


def train_many(df: DataFrame, features, target: str, kinds=("linear", "random_forest", "gbt"),
               params: dict | None = None, split_col: str = "split"):
    """M4: train each kind on one cached frame; a failing kind yields a FAILED run row."""
    spark = df.sparkSession
    cached = df.select(*features, target, *([split_col] if split_col in df.columns else [])).persist()
    models, rows = {}, []
    try:
        for k in kinds:
            try:
                m, row = train(cached, features, target, k, (params or {}).get(k), split_col)
                models[k] = m
            except Exception as exc:  # noqa: BLE001 - a failed model is a run row, not a crash
                row = {"run_id": k, "model": k, "status": "FAILED", "error": f"{type(exc).__name__}: {exc}"}
            rows.append(tuple(row.get(f.name) for f in RUN_SCHEMA.fields))
    finally:
        cached.unpersist()
    return models, spark.createDataFrame(rows, RUN_SCHEMA)


def feature_importances(model, features) -> list[tuple[str, float]]:
    """FS6/FS7: tree importances, or |coefficient| for linear models."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(stage, "featureImportances"):
        vals = stage.featureImportances.toArray().tolist()
    else:
        vals = [abs(x) for x in stage.coefficients.toArray().tolist()]
    return sorted(zip(features, vals), key=lambda t: (-t[1], t[0]))


# M11 / M12 -------------------------------------------------------------------------------------
def score(df: DataFrame, model, key, model_name: str, version, ts=None,
          prediction: str = "predicted_sales") -> DataFrame:
    """Batch scoring: model.transform on the executors + model name / version / timestamp."""
    keys = [key] if isinstance(key, str) else list(key)
    out = model.transform(df)
    stamp = F.lit(ts).cast("timestamp") if ts is not None else F.current_timestamp()
    keep = [c for c in df.columns]
    return out.select(*keep, F.col("prediction").alias(prediction), F.lit(model_name).alias("model_name"),
                      F.lit(str(version)).alias("model_version"), stamp.alias("prediction_timestamp"))[
        keys + [c for c in keep if c not in keys] + [prediction, "model_name", "model_version", "prediction_timestamp"]]


# X1 ---------------------------------------------------------------------------------------------
def score_with_python(df: DataFrame, model, features, prediction: str = "prediction") -> DataFrame:
    """Foreign model applied in Arrow batches via ``mapInPandas``.

    ``model`` is an object with ``.predict(pandas.DataFrame)`` (scikit-learn
    style) or a plain function of the feature batch. Objects are shipped once
    as a broadcast variable and deserialised once per Python worker, not with
    every task.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(prediction, T.DoubleType())])
    feats = list(features)
    if hasattr(model, "predict"):
        bc = df.sparkSession.sparkContext.broadcast(model)

        def predict(x):
            return bc.value.predict(x)
    else:
        predict = model

    def run(batches):
        for pdf in batches:
            out = pdf.copy()
            out[prediction] = pd.Series(predict(pdf[feats]), index=pdf.index).astype("float64")
            yield out

    return df.mapInPandas(run, schema)


# M13 --------------------------------------------------------------------------------------------
def fold_column(keys, folds: int = 5) -> Column:
    """A deterministic fold for each row: the same at every run, whatever the partitioning."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(folds)).cast("int")


def cross_validate(df: DataFrame, features, target: str, kind: str = "linear", folds: int = 5,
                   key=None, params=None, grid: dict | None = None, fold: Column | None = None):
    """K-fold cross-validation with a fixed fold column -> (best model or None, [(parameters, average rmse)]).

    ``grid`` maps parameter names to the values to try. Linear models come from moment matrices
    (``operators/gram.py``): one pass whatever the folds and values, ``regParam`` being the parameter.
    Other kinds are refitted by MLlib on one persisted frame.
    """
    fold = fold if fold is not None else fold_column(list(key or features), folds)
    if kind == "linear":
        from salesflow.operators import gram
        regs = (grid or {}).get("regParam", [0.0])
        scores = gram.best_regularisation(gram.cross_validate(df, features, target, fold, regs)).collect()
        by = {r["reg"]: r["avg_rmse"] for r in scores}
        return None, [({"regParam": r}, by[r]) for r in regs if r in by]
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    data = assemble(df.withColumn("fold", fold), features, target).select("features", "label", "fold").persist()
    est = make_estimator(kind, params=params)
    maps = ParamGridBuilder()
    for name, values in (grid or {}).items():
        maps = maps.addGrid(est.getParam(name), values)
    maps = maps.build()
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")
    try:
        model = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, numFolds=folds, foldCol="fold", seed=42).fit(data)
    finally:
        data.unpersist()
    return model, [({p.name: v for p, v in m.items()}, float(x)) for m, x in zip(maps, model.avgMetrics, strict=True)]


def _nan_to_none(x):
    return None if x is None or (isinstance(x, float) and math.isnan(x)) else x
