"""Registered feature-selection queries (FS1-FS10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import selection as FS
from salesflow.plans.common import materialize, rounded, rsql, sales, sig, sig_sql, spool
from salesflow.plans.models_q import _fit_sql
from salesflow.plans.registry import register
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import sales_sql, with_views

FEATS = list(fx.FEATURE_COLS)
TARGET = "sales"
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
X = {"x": f"SELECT {', '.join(KEY)}, {', '.join(FEATS)}, {TARGET} FROM ({sales_sql()})"}


def _frame(spark, sf_dir):
    s = sales(spark, sf_dir, KEY + FEATS + [TARGET])
    return s.withColumn("quantity", F.col("quantity").cast("double"))


def _ranked_sql(inner: str, selected: str, extra: str = "") -> str:
    return f"""SELECT feature, {sig_sql('score', 10)} AS score{extra},
  CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS INTEGER) AS rank, {selected} AS selected
FROM ({inner})"""


def _out(df):
    # scores span many magnitudes (variances ~1e10, MI ~1e-3): significant digits
    return rounded(df, cols=["corr"]).withColumn("score", sig("score", 10))


@register("fs1_variance", with_views(_ranked_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_pop(CAST({c} AS DOUBLE)) AS score FROM x" for c in FEATS),
    "coalesce(score > 0.01, false)"), **X), ("FS1",))
def variance(spark, sf_dir):
    return _out(FS.by_variance(_frame(spark, sf_dir), FEATS, 0.01))


_CORR_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, {TARGET}) AS corr FROM x" for c in FEATS)


@register("fs2_correlation_pearson", with_views(_ranked_sql(
    f"SELECT feature, corr, abs(corr) AS score FROM ({_CORR_SQL})", "coalesce(score >= 0.1, false)",
    f", {rsql('corr')} AS corr"), **X), ("FS2",))
def correlation_pearson(spark, sf_dir):
    return _out(FS.by_correlation(_frame(spark, sf_dir), FEATS, TARGET, 0.1, "pearson"))


_RANKS = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
                   for c in FEATS + [TARGET])
_SPEARMAN_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, {TARGET}) AS corr FROM r" for c in FEATS)


@register("fs3_correlation_spearman", with_views(_ranked_sql(
    f"SELECT feature, corr, abs(corr) AS score FROM ({_SPEARMAN_SQL})", "coalesce(score >= 0.1, false)",
    f", {rsql('corr')} AS corr"), **X, r=f"SELECT {_RANKS} FROM x"), ("FS3", "W7"))
def correlation_spearman(spark, sf_dir):
    # null counts, value counts and the join of the ranks read one copy of the nine columns
    return _out(FS.by_correlation(materialize(_frame(spark, sf_dir).select(*FEATS, TARGET)), FEATS, TARGET, 0.1, "spearman"))


_F_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, {TARGET}) * corr({c}, {TARGET}) / (1 - corr({c}, {TARGET}) * corr({c}, {TARGET}))"
    f" * (count(*) - 2) AS score FROM x" for c in FEATS)


@register("fs4_f_test", with_views(_ranked_sql(_F_SQL, "rank <= 5"), **X).replace(
    "rank <= 5 AS selected", "row_number() OVER (ORDER BY score DESC NULLS LAST, feature) <= 5 AS selected"), ("FS4",))
def f_test(spark, sf_dir):
    return _out(FS.by_f_test(_frame(spark, sf_dir), FEATS, TARGET, 5))


def _mi_sql(bins: int = 10) -> str:
    probs = ", ".join(str(i / bins) for i in range(bins + 1))
    allc = FEATS + [TARGET]
    edges = ", ".join(
        f"list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{probs}]))) AS e_{c}" for c in allc)

    def b(c):
        return f"len(list_filter(e_{c}[2:len(e_{c}) - 1], lambda v: v <= CAST({c} AS DOUBLE)))"

    binned = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE {b(c)} END AS {c}" for c in allc)
    pairs = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS bx, {TARGET} AS ybin FROM bn" for c in FEATS)
    return f"""WITH e AS (SELECT {edges} FROM x), bn AS (SELECT {binned} FROM x, e),
j AS (SELECT feature, bx, ybin, count(*) AS n_xy FROM ({pairs}) GROUP BY feature, bx, ybin),
jj AS (SELECT *, sum(n_xy) OVER (PARTITION BY feature) AS n, sum(n_xy) OVER (PARTITION BY feature, bx) AS n_x,
       sum(n_xy) OVER (PARTITION BY feature, ybin) AS n_y FROM j)
SELECT feature, sum(n_xy / n * ln(n_xy * n / (n_x * n_y))) AS score FROM jj GROUP BY feature"""


@register("fs5_mutual_info", with_views(_ranked_sql(_mi_sql(), "rank <= 5"), **X).replace(
    "rank <= 5 AS selected", "row_number() OVER (ORDER BY score DESC NULLS LAST, feature) <= 5 AS selected"), ("FS5",))
def mutual_info(spark, sf_dir):
    return _out(FS.by_mutual_info(_frame(spark, sf_dir), FEATS, TARGET, 5))


@register("fs6_importance", None, ("FS6", "FS7"))
def importance(spark, sf_dir):
    # label checks, thresholds and bins: three passes over one copy of the nine columns
    x = spool(_frame(spark, sf_dir).select(*FEATS, TARGET), "fs6-columns")
    return _out(FS.by_importance(x, FEATS, TARGET, 5, "random_forest"))


@register("fs6_importance_gbt", None, ("FS6",))
def importance_gbt(spark, sf_dir):
    """Boosted trees; twenty rounds, as every round is a pass over the rows."""
    x = spool(_frame(spark, sf_dir).select(*FEATS, TARGET), "fs6-gbt-columns")
    return _out(FS.by_importance(x, FEATS, TARGET, 5, "gbt", {"maxIter": 20}))


# |coefficient| of a linear model, two features in closed form
_FS7 = with_views(f"""WITH f AS (SELECT {_fit_sql()} FROM (SELECT quantity AS x, price AS z, sales AS y FROM sales))
SELECT 'quantity' AS feature, abs(bx) AS score FROM f UNION ALL SELECT 'price', abs(bz) FROM f""", sales=sales_sql())


@register("fs7_linear_importance", _ranked_sql(_FS7, "row_number() OVER (ORDER BY score DESC NULLS LAST, feature) <= 1").replace(
    sig_sql("score", 10), sig_sql("score", 6)), ("FS7",))
def linear_importance(spark, sf_dir):
    out = FS.by_importance(_frame(spark, sf_dir), ["quantity", "price"], TARGET, 1, "linear")
    return out.withColumn("score", sig("score", 6))


@register("fs8_rfe", None, ("FS8",))
def rfe(spark, sf_dir):
    return FS.by_rfe(_frame(spark, sf_dir), FEATS, TARGET, 4)


_FS9_COLS = ["quantity", "price", "p_retailprice", "o_totalprice", "predicted", "c_acctbal"]


@register("fs9_drop_correlated", with_views("SELECT feature, position, " + rsql("max_abs_corr") + """ AS max_abs_corr,
  NOT coalesce(max_abs_corr > 0.8, false) AS keep FROM (""" + " UNION ALL ".join(
    f"SELECT '{b}' AS feature, {j} AS position, "
    + (f"greatest({', '.join(f'abs(corr({a}, {b}))' for a in _FS9_COLS[:j])}) AS max_abs_corr FROM y" if j
       else "CAST(NULL AS DOUBLE) AS max_abs_corr") for j, b in enumerate(_FS9_COLS)) + ")",
    y=f"SELECT {', '.join(_FS9_COLS)} FROM ({sales_sql()})"), ("FS9",))
def drop_correlated(spark, sf_dir):
    s = sales(spark, sf_dir, _FS9_COLS).withColumn("quantity", F.col("quantity").cast("double"))
    return rounded(FS.drop_correlated(s, _FS9_COLS, 0.8), cols=["max_abs_corr"])


def _consensus_sql(k: int = 4) -> str:
    corr = f"SELECT feature FROM ({_CORR_SQL}) WHERE abs(corr) >= 0.05 ORDER BY abs(corr) DESC, feature LIMIT {k}"
    ftest = f"SELECT feature FROM ({_F_SQL}) ORDER BY score DESC, feature LIMIT {k}"
    mi = f"SELECT feature FROM ({_mi_sql()}) ORDER BY score DESC, feature LIMIT {k}"
    return with_views(f"""
WITH v AS (SELECT feature, count(*) AS votes FROM (({corr}) UNION ALL ({ftest}) UNION ALL ({mi})) GROUP BY feature),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY votes DESC, feature) AS INTEGER) AS rank FROM v),
ok AS (SELECT count(*) FILTER (WHERE votes >= 2) AS n_ok FROM v)
SELECT feature, votes, rank, CASE WHEN n_ok < {k} THEN rank <= {k} ELSE votes >= 2 AND rank <= {k} END AS selected
FROM r, ok""", **X)


@register("fs10_consensus", _consensus_sql(4), ("FS10", "U3"))
def consensus(spark, sf_dir):
    # seven passes: two for each of the moments, three for the deciles and the bins
    x = spool(_frame(spark, sf_dir).select(*FEATS, TARGET), "fs10-columns")
    k = 4
    corr = FS.by_correlation(x, FEATS, TARGET, 0.05).where(F.col("selected") & (F.col("rank") <= k))
    ft = FS.by_f_test(x, FEATS, TARGET, k).where(F.col("selected"))
    mi = FS.by_mutual_info(x, FEATS, TARGET, k).where(F.col("selected"))
    return FS.consensus({"correlation": corr, "statistical": ft, "mutual_info": mi}, k)


@register("fs10_consensus_importance", None, ("FS10", "U3"))
def consensus_importance(spark, sf_dir):
    """The reference's default votes; ``fs10_consensus`` has mutual information for the forest, which SQL cannot fit."""
    # seven passes: three for the forest, two for each of the moments
    return consensus_by_default(spool(_frame(spark, sf_dir).select(*FEATS, TARGET), "fs10-columns"), 4)


def consensus_by_default(x, k: int, cols=FEATS, target: str = TARGET):
    imp = FS.by_importance(x, cols, target, k, "random_forest").where(F.col("selected"))
    corr = FS.by_correlation(x, cols, target, 0.05).where(F.col("selected") & (F.col("rank") <= k))
    ft = FS.by_f_test(x, cols, target, k).where(F.col("selected"))
    return FS.consensus({"importance": imp, "correlation": corr, "statistical": ft}, k)
