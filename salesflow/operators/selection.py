"""Feature selection (FS1-FS10).

Every scorer is one aggregation over the data (moments, value counts or a
binned contingency table) followed by work on a table with one row per
feature. Outputs share the shape (feature, score, rank, selected).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.functions.exprs import nan_to_null
from salesflow.operators.blocks import attach, exact_quantiles, pair_moments, pearson
from salesflow.operators.windows import rank_table


def _ranked(scores: DataFrame, score: str = "score", desc: bool = True) -> DataFrame:
    # one row per feature: a global window over d rows
    order = F.col(score).desc_nulls_last() if desc else F.col(score).asc_nulls_last()
    return scores.withColumn("rank", F.row_number().over(Window.orderBy(order, F.col("feature"))))


# FS1 --------------------------------------------------------------------------------------------
def by_variance(df: DataFrame, cols, threshold: float = 0.01) -> DataFrame:
    """Population variance > threshold (strict)."""
    cols = list(cols)
    row = df.agg(*[F.var_pop(nan_to_null(F.col(c).cast("double"))).alias(c) for c in cols])
    long = row.unpivot([], cols, "feature", "score")
    return _ranked(long).withColumn("selected", F.coalesce(F.col("score") > threshold, F.lit(False)))


# FS2 / FS3 -------------------------------------------------------------------------------------
def correlations(df: DataFrame, cols, target: str, method: str = "pearson", key=None) -> DataFrame:
    """(feature, corr) with the target; spearman = pearson on average-tie ranks."""
    cols = list(cols)
    if method == "spearman":
        return _spearman(df, cols, target)
    if method != "pearson":
        raise ValueError(f"unknown method {method}")
    m = pair_moments(df, cols + [target], pairs=[(c, target) for c in cols])
    return m.select(F.col("a").alias("feature"), pearson("cov", "var_a", "var_b").alias("corr"), "n")


def _spearman(df: DataFrame, cols, target: str) -> DataFrame:
    """Pearson on average-tie ranks of the rows where both the feature and the target are present.

    Features without missing values share one ranking of the target, joined to the
    rows once; a feature with missing values ranks its own complete pairs.
    """
    df = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in [*cols, target]])
    df = df.where(F.col(target).isNotNull())
    n = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()  # d numbers
    whole = [c for c in cols if not n[c]]
    parts = [_rank_moments(df, whole, target)] if whole else []
    parts += [_rank_moments(df.where(F.col(c).isNotNull()), [c], target) for c in cols if n[c]]
    m = parts[0]
    for p in parts[1:]:
        m = m.unionByName(p)
    return m.select("feature", pearson("cov", "var_a", "var_b").alias("corr"), "n")


def _rank_moments(df: DataFrame, cols, target: str) -> DataFrame:
    """Moments of the ranks of complete columns and the target's rank, by feature."""
    ranks = rank_table(df, cols + [target])
    ry = ranks.where(F.col("column") == target).select(F.col("value").alias(target), F.col("rank").alias("ry"))
    long = df.select(target, *cols).join(ry, target).unpivot(["ry"], cols, "feature", "_x")
    rx = ranks.where(F.col("column") != target).select(
        F.col("column").alias("feature"), F.col("value").alias("_x"), F.col("rank").alias("rx"))
    return long.join(rx, ["feature", "_x"]).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("rx", "ry").alias("cov"),
        F.var_pop("rx").alias("var_a"), F.var_pop("ry").alias("var_b"))


def by_correlation(df: DataFrame, cols, target: str, threshold: float = 0.1, method: str = "pearson") -> DataFrame:
    c = correlations(df, cols, target, method)
    s = c.select("feature", "corr", F.abs("corr").alias("score"))
    return _ranked(s).withColumn("selected", F.coalesce(F.col("score") >= threshold, F.lit(False)))


# FS4 --------------------------------------------------------------------------------------------
def by_f_test(df: DataFrame, cols, target: str, k: int = 20) -> DataFrame:
    """Univariate F = r^2 / (1 - r^2) (n - 2) (f_regression); top k."""
    c = correlations(df, cols, target)
    r2 = F.col("corr") * F.col("corr")
    f = F.when(r2 >= 1, F.lit(float("inf"))).otherwise(F.try_divide(r2, 1 - r2) * (F.col("n") - 2))
    s = c.select("feature", f.alias("score"))
    return _ranked(s).withColumn("selected", F.col("rank") <= k)


# FS5 --------------------------------------------------------------------------------------------
def by_mutual_info(df: DataFrame, cols, target: str, k: int = 20, bins: int = 10) -> DataFrame:
    """Quantile-binned mutual information (re-aimed from the k-NN estimator); top k.

    Each column is cut at its own exact deciles (deduplicated); bin = number
    of inner edges <= value. MI = sum p_xy ln(p_xy / (p_x p_y)) over the
    (feature, bx, by) contingency table, rows with a NULL on either side dropped.
    """
    cols = list(cols)
    allc = cols + [target]
    df = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in allc])
    long = df.unpivot([], allc, "column", "value").where(F.col("value").isNotNull())
    probs = [i / bins for i in range(bins + 1)]
    q = exact_quantiles(long, ["column"], "value", probs)
    edges = q.groupBy("column").agg(F.array_sort(F.array_distinct(F.collect_list("q"))).alias("edges"))
    e = {r["column"]: r["edges"] for r in edges.collect()}  # d x (bins + 1) numbers: fit state
    binned = df.select(*[_bin(F.col(c).cast("double"), e[c]).alias(c) for c in allc])
    pairs = binned.unpivot([target], cols, "feature", "bx").where(
        F.col("bx").isNotNull() & F.col(target).isNotNull())
    joint = pairs.groupBy("feature", "bx", F.col(target).alias("ybin")).agg(F.count(F.lit(1)).alias("n_xy"))
    w = Window.partitionBy("feature")  # <= bins^2 rows per feature
    j = (joint.withColumn("n", F.sum("n_xy").over(w))
         .withColumn("n_x", F.sum("n_xy").over(Window.partitionBy("feature", "bx")))
         .withColumn("n_y", F.sum("n_xy").over(Window.partitionBy("feature", "ybin"))))
    term = (F.col("n_xy") / F.col("n")) * F.log(F.col("n_xy") * F.col("n") / (F.col("n_x") * F.col("n_y")))
    s = j.groupBy("feature").agg(F.sum(term).alias("score"))
    return _ranked(s).withColumn("selected", F.col("rank") <= k)


def _bin(x, edges):
    inner = edges[1:-1] if len(edges) > 1 else []
    out = F.lit(0)
    for v in inner:
        out = out + F.when(x >= F.lit(float(v)), 1).otherwise(0)
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


# FS6 / FS7 -------------------------------------------------------------------------------------
def by_importance(df: DataFrame, cols, target: str, k: int = 20, kind: str = "random_forest",
                  params=None) -> DataFrame:
    """Tree importances (or |coef| for a linear model); top k.

    Forests of bootstrapped trees and boosted trees are grown by ``operators/forest.py``, which reads ``df`` three times;
    other models, and trees with other parameters than it knows, are MLlib fits.
    """
    from salesflow.operators import forest
    from salesflow.operators.models import DEFAULT_PARAMS, assemble, feature_importances, make_estimator
    p = {**DEFAULT_PARAMS.get(kind, {}), **(params or {})}
    if forest.knows(p, kind):
        imp = forest.importances(df, cols, target, kind=kind, **p)
    else:
        model = make_estimator(kind, params=params).fit(assemble(df, cols, target))
        imp = feature_importances(model, list(cols))
    s = df.sparkSession.createDataFrame([(f, float(v)) for f, v in imp], "feature string, score double")
    return _ranked(s).withColumn("selected", F.col("rank") <= k)


# FS8 --------------------------------------------------------------------------------------------
def by_rfe(df: DataFrame, cols, target: str, n_features: int = 20) -> DataFrame:
    """Recursive elimination with a linear model, one feature per step.

    One moments pass builds the (d+1) x (d+1) covariance matrix; each step
    solves the normal equations of the remaining features on the driver (tiny)
    and drops the smallest |coefficient|. rank 1 = kept; later ranks were
    removed earlier.
    """
    cols = list(cols)
    allc = cols + [target]
    m = pair_moments(df.na.drop(subset=allc), allc).collect()
    idx = {c: i for i, c in enumerate(allc)}
    cov = np.zeros((len(allc), len(allc)))
    for r in m:
        i, j = idx[r["a"]], idx[r["b"]]
        cov[i, j] = cov[j, i] = r["cov"] or 0.0
    remaining = list(range(len(cols)))
    ranking = {}
    step = len(cols) - n_features + 1
    while len(remaining) > n_features:
        sxx = cov[np.ix_(remaining, remaining)]
        sxy = cov[remaining, len(cols)]
        beta = np.linalg.lstsq(sxx, sxy, rcond=None)[0]
        drop = remaining[int(np.argmin(np.abs(beta)))]
        ranking[cols[drop]] = step
        step -= 1
        remaining.remove(drop)
    for i in remaining:
        ranking[cols[i]] = 1
    rows = [(c, float(ranking[c]), int(ranking[c]), ranking[c] == 1) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, score double, rank int, selected boolean")


# FS9 --------------------------------------------------------------------------------------------
def drop_correlated(df: DataFrame, cols, threshold: float = 0.95) -> DataFrame:
    """(feature, position, max_abs_corr_with_earlier, keep): drop b if |r(a, b)| > t for an earlier a.

    Dropped columns still count as earlier columns (upper-triangle rule).
    """
    cols = list(cols)
    pos = {c: i for i, c in enumerate(cols)}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([(c, pos[c], None, True) for c in cols],
                                               "feature string, position int, max_abs_corr double, keep boolean")
    m = pair_moments(df, cols, pairs=pairs)
    c = m.select(F.col("b").alias("feature"), F.abs(pearson("cov", "var_a", "var_b")).alias("r"))
    worst = c.groupBy("feature").agg(F.max("r").alias("max_abs_corr"))
    allf = df.sparkSession.createDataFrame([(c, pos[c]) for c in cols], "feature string, position int")
    out = allf.join(worst, "feature", "left")
    return out.withColumn("keep", ~F.coalesce(F.col("max_abs_corr") > threshold, F.lit(False)))


# FS10 -------------------------------------------------------------------------------------------
def consensus(selections: dict, k: int = 20) -> DataFrame:
    """Votes across methods: features with >= max(2, n_methods // 2) votes; fewer than k -> top k
    by votes. Ties: votes desc, name asc. ``selections`` maps method -> DataFrame(feature)."""
    frames = [f.select("feature").withColumn("method", F.lit(m)) for m, f in selections.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    votes = u.groupBy("feature").agg(F.count(F.lit(1)).alias("votes"))
    min_votes = max(2, len(selections) // 2)
    ranked = votes.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("votes"), F.asc("feature"))))
    n_ok = ranked.agg(F.count_if(F.col("votes") >= min_votes).alias("_ok"))
    j = attach(ranked, n_ok)
    sel = F.when(F.col("_ok") < k, F.col("rank") <= k).otherwise((F.col("votes") >= min_votes) & (F.col("rank") <= k))
    return j.withColumn("selected", sel).drop("_ok")
