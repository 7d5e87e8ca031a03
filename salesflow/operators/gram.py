"""Linear regression from moment matrices: grouped fits (M1) and cross-validation (M13) without refits.

One aggregation gives, for every (group, fold), the moments of a row's features and target: counts, sums
and sums of products. They add up, so a fold's training moments are the group's total less that fold, and
its held-out error follows from its own moments: no row is read a second time, whatever the
number of folds, groups and regularisation values. Each group's few moment rows are solved in one task;
thousands of groups are solved side by side.

Columns are shifted and scaled by their overall mean and deviation first, so that sums of products do
not lose their digits. Rows with a missing (NULL or NaN) feature or target count nowhere. Regularisation is
on standardised coefficients: ``sum((y - a - xb)^2) / 2n + reg / 2 * sum(var(x) * b^2)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions.exprs import nan_to_null
from salesflow.operators.blocks import attach


def _complete(df: DataFrame, columns: list[str], keep: list) -> DataFrame:
    rows = df.select(*keep, *[nan_to_null(F.col(c).cast("double")).alias(f"_z{i}") for i, c in enumerate(columns)])
    return rows.dropna(subset=[f"_z{i}" for i in range(len(columns))])


def moments(df: DataFrame, features, target: str, by=(), fold: Column | None = None):
    """(by..., fold, n, m): ``m`` is the lower triangle of the moment matrix of (1, features, target), and (shift, scale) of the columns."""
    by, columns = list(by), [*features, target]
    d = len(columns)
    rows = _complete(df, columns, [*by, (fold if fold is not None else F.lit(0)).cast("int").alias("fold")])
    stats = rows.agg(*[F.avg(f"_z{i}") for i in range(d)], *[F.stddev_pop(f"_z{i}") for i in range(d)]).first()
    shift = np.array([x or 0.0 for x in stats[:d]])
    scale = np.array([x or 1.0 for x in stats[d:]])
    z = [F.lit(1.0), *[(F.col(f"_z{i}") - F.lit(float(shift[i]))) / F.lit(float(scale[i])) for i in range(d)]]
    sums = [F.sum(z[i] * z[j]) for i in range(d + 1) for j in range(i + 1)]
    out = rows.groupBy(*by, "fold").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("m"))
    return out, shift, scale


def _matrix(m, d: int) -> np.ndarray:
    out = np.zeros((d + 1, d + 1))
    out[np.tril_indices(d + 1)] = m
    return out + np.tril(out, -1).T


def solve(g: np.ndarray, reg: float) -> np.ndarray:
    """Intercept and coefficients from the moment matrix of (1, features, target); dependent columns share by least norm."""
    n = g[0, 0]
    mean = g[0] / n
    cov = g / n - np.outer(mean, mean)
    x = slice(1, len(g) - 1)
    a = cov[x, x] + reg * np.diag(np.diag(cov)[x])
    b = np.linalg.lstsq(a, cov[x, -1], rcond=1e-12)[0]
    return np.r_[mean[-1] - mean[x] @ b, b]


def squared_error(g: np.ndarray, beta: np.ndarray) -> float:
    """Sum of squared errors of a fit over the rows of a moment matrix."""
    v = np.r_[-beta, 1.0]
    return max(float(v @ g @ v), 0.0)


def _unscaled(beta: np.ndarray, shift: np.ndarray, scale: np.ndarray) -> np.ndarray:
    b = beta[1:] * scale[-1] / scale[:-1]
    return np.r_[shift[-1] + beta[0] * scale[-1] - b @ shift[:-1], b]


def _per_group(df: DataFrame, features, target: str, by, fold, each, fields: list) -> DataFrame:
    """``each(moment matrix by fold)`` -> rows of (field values), for every group, where its moments lie."""
    by, d = list(by), len(list(features)) + 1
    table, shift, scale = moments(df, features, target, by, fold)
    # as many rows for each group as folds
    groups = table.groupBy(*by).agg(F.collect_list(F.struct("fold", "m")).alias("folds")) if by else \
        table.agg(F.collect_list(F.struct("fold", "m")).alias("folds"))
    schema = T.StructType([*[df.schema[c] for c in by], *fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                grams = {int(f["fold"]): _matrix(f["m"], d) for f in row[-1]}
                out += [(*row[:-1], *r) for r in each(grams, lambda b: _unscaled(b, shift, scale), float(scale[-1]))]
            yield pd.DataFrame(out, columns=schema.names).astype(object)

    return groups.select(*by, "folds").mapInPandas(run, schema)


def grouped_regression(df: DataFrame, features, target: str, by=(), reg: float = 0.0) -> DataFrame:
    """One model for each group: by..., n, intercept, coefficients (in order of ``features``), rmse, r2."""
    def each(grams, unscaled, unit):
        g = sum(grams.values()) if grams else None
        if g is None:
            return
        beta, n = solve(g, reg), g[0, 0]
        sse, sst = squared_error(g, beta), g[-1, -1] - g[0, -1] ** 2 / n
        fit = unscaled(beta)
        r2 = 1 - sse / sst if sst > 1e-12 * n else float(sse <= 1e-12 * n)
        yield int(round(n)), float(fit[0]), [float(b) for b in fit[1:]], float(np.sqrt(sse / n) * unit), float(r2)

    fields = [T.StructField("n", T.LongType()), T.StructField("intercept", T.DoubleType()), T.StructField("coefficients", T.ArrayType(T.DoubleType())),
              T.StructField("rmse", T.DoubleType()), T.StructField("r2", T.DoubleType())]
    return _per_group(df, features, target, by, None, each, fields)


def cross_validate(df: DataFrame, features, target: str, fold: Column, regs=(0.0,), by=()) -> DataFrame:
    """by..., reg, fold, n_train, n_test, intercept, coefficients, rmse (of the held-out fold), one row for each fold and value.

    A fold without training rows (all rows in one fold) has no model and no row.
    """
    def each(grams, unscaled, unit):
        total = sum(grams.values()) if grams else None
        for f, g in sorted(grams.items()):
            train = total - g
            if train[0, 0] < 0.5:
                continue
            for reg in regs:
                beta = solve(train, reg)
                fit = unscaled(beta)
                yield (float(reg), f, int(round(train[0, 0])), int(round(g[0, 0])), float(fit[0]), [float(b) for b in fit[1:]],
                       float(np.sqrt(squared_error(g, beta) / g[0, 0]) * unit))

    fields = [T.StructField("reg", T.DoubleType()), T.StructField("fold", T.IntegerType()), T.StructField("n_train", T.LongType()),
              T.StructField("n_test", T.LongType()), T.StructField("intercept", T.DoubleType()),
              T.StructField("coefficients", T.ArrayType(T.DoubleType())), T.StructField("rmse", T.DoubleType())]
    return _per_group(df, features, target, by, fold, each, fields)


def best_regularisation(folds: DataFrame, by=()) -> DataFrame:
    """by..., reg, avg_rmse of every value, ``best``: the least average (the smaller value on ties)."""
    by = list(by)
    scores = folds.groupBy(*by, "reg").agg(F.avg("rmse").alias("avg_rmse"))
    least = scores.groupBy(*by).agg(F.min(F.struct("avg_rmse", "reg")).alias("_least")) if by else \
        scores.agg(F.min(F.struct("avg_rmse", "reg")).alias("_least"))
    scores = attach(scores, least, by)
    return scores.select(*by, "reg", "avg_rmse", (F.col("reg") == F.col("_least.reg")).alias("best"))
