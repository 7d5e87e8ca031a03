"""Registered drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import drift as D
from salesflow.operators import sketched as SK
from salesflow.operators.relational import label_period
from salesflow.plans.common import max_scalar, rounded, rsql, sales, sig
from salesflow.plans.models_q import metric_sql
from salesflow.plans.registry import register
from salesflow.session import scratch_path
from salesflow.sources import fixtures as fx
from salesflow.sources.fixtures import DRIFT_METRICS_SQL, sales_sql, with_views

FEATURES = ("price", "quantity", "sales")


def _labelled(spark, sf_dir, extra=()):
    s = sales(spark, sf_dir, ["date", *FEATURES, *extra])
    return label_period(s, "date", max_scalar(s, "date"), 30)


def _long_sql(by=()):
    keys = "".join(f"{b}, " for b in by)
    lab = (f"SELECT *, CASE WHEN date >= (SELECT max(date) FROM ({sales_sql()})) - INTERVAL 30 DAY "
           f"THEN 'current' ELSE 'reference' END AS period FROM ({sales_sql()})")
    long = " UNION ALL ".join(f"SELECT {keys}period, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lab"
                              for c in FEATURES)
    return {"lab": lab, "long": f"SELECT * FROM ({long}) WHERE value IS NOT NULL"}


def _ks_sql(by=()):
    g = ", ".join(list(by) + ["feature"])
    return f"""c AS (SELECT {g}, value, count(*) FILTER (WHERE period = 'reference') AS c_ref,
                count(*) FILTER (WHERE period = 'current') AS c_cur FROM long GROUP BY {g}, value),
p AS (SELECT {g}, value,
        sum(c_ref) OVER (PARTITION BY {g} ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr,
        sum(c_cur) OVER (PARTITION BY {g} ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc,
        sum(c_ref) OVER (PARTITION BY {g}) AS n_ref, sum(c_cur) OVER (PARTITION BY {g}) AS n_cur FROM c),
ks AS (SELECT {g}, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
         max(abs(cr / n_ref - cc / n_cur)) AS ks_statistic FROM p WHERE n_ref > 0 AND n_cur > 0
       GROUP BY {g}, n_ref, n_cur),
kl AS (SELECT *, ks_statistic * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS lam FROM ks),
kp AS (SELECT {g}, n_ref, n_cur, ks_statistic, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
         list_sum(list_transform(range(1, 101), lambda k: 2.0 * pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)))))
         END AS p_value FROM kl)"""


def _psi_sql(by=(), bins=10):
    g = ", ".join(list(by) + ["feature"])
    probs = ", ".join(str(i / bins) for i in range(bins + 1))
    return f"""e AS (SELECT {g}, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS edges
       FROM long WHERE period = 'reference' GROUP BY {g}),
sl AS (SELECT l.*, len(list_filter(e.edges[1:len(e.edges) - 1], lambda x: x <= l.value)) AS slot
       FROM long l JOIN e USING ({g})),
cnt AS (SELECT {g}, slot, count(*) FILTER (WHERE period = 'reference') AS c_ref,
          count(*) FILTER (WHERE period = 'current') AS c_cur FROM sl GROUP BY {g}, slot),
tot AS (SELECT {g}, count(*) FILTER (WHERE period = 'reference') AS n_ref,
          count(*) FILTER (WHERE period = 'current') AS n_cur FROM long GROUP BY {g}),
grid AS (SELECT {g}, unnest(range(0, len(edges))) AS slot FROM e),
ps AS (SELECT {g}, sum(((coalesce(c_cur, 0) / n_cur + 1e-10) - (coalesce(c_ref, 0) / n_ref + 1e-10))
          * ln((coalesce(c_cur, 0) / n_cur + 1e-10) / (coalesce(c_ref, 0) / n_ref + 1e-10))) AS psi
       FROM grid LEFT JOIN cnt USING ({g}, slot) JOIN tot USING ({g}) GROUP BY {g})"""


def _with(sql_tail, by=(), parts=("ks",)):
    views = _long_sql(by)
    ctes = [f"{k} AS ({v})" for k, v in views.items()]
    if "ks" in parts:
        ctes.append(_ks_sql(by))
    if "psi" in parts:
        ctes.append(_psi_sql(by))
    return "WITH " + ",\n".join(ctes) + "\n" + sql_tail


@register("d1_ks_statistic", _with(f"SELECT feature, n_ref, n_cur, {rsql('ks_statistic')} AS ks_statistic FROM ks"),
          ("D1", "P5"))
def ks_statistic(spark, sf_dir):
    return rounded(D.ks_statistics(_labelled(spark, sf_dir), FEATURES, "period"))


@register("d1_ks_by_region", _with(
    f"SELECT region, feature, n_ref, n_cur, {rsql('ks_statistic')} AS ks_statistic FROM ks", by=("region",)),
          ("D1",))
def ks_by_region(spark, sf_dir):
    return rounded(D.ks_statistics(_labelled(spark, sf_dir, ("region",)), FEATURES, "period", by=["region"]))


@register("d2_ks_test", _with(f"""SELECT feature, n_ref, n_cur, {rsql('ks_statistic')} AS ks_statistic,
  {rsql('p_value')} AS p_value, p_value < 0.05 AS drift_detected FROM kp"""), ("D2",))
def ks_test(spark, sf_dir):
    return rounded(D.ks_test(_labelled(spark, sf_dir), FEATURES, "period"))


# small samples: customers of each nation, even keys against odd ones; the lattice-path recursion as a list carried along
_ACCOUNTS = """SELECT c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN 'current' ELSE 'reference' END AS period,
  'balance' AS feature, CAST(c_acctbal AS DOUBLE) AS value FROM customer """


@register("d2_ks_exact", f"""
WITH RECURSIVE long AS ({_ACCOUNTS}), {_ks_sql(("c_nationkey",))},
b AS (SELECT c_nationkey, feature, n_ref AS n, n_cur AS m, ks_statistic, CAST(round(ks_statistic * n_ref * n_cur) AS BIGINT) AS reach FROM ks),
r AS (SELECT *, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS low, [CAST(1 AS DOUBLE)] AS p FROM b UNION ALL
  SELECT c_nationkey, feature, n, m, ks_statistic, reach, k + 1, lo2, list_transform(range(lo2, hi2 + 1), lambda i:
    (coalesce(p[i - low], 0) * i + coalesce(p[i - low + 1], 0) * (k + 1 - i)) / (k + 1))
  FROM (SELECT *, CAST(greatest(floor(((k + 1) * n - reach) / (n + m)) + 1, k + 1 - m, 0) AS BIGINT) AS lo2,
          CAST(least(ceil(((k + 1) * n + reach) / (n + m)) - 1, k + 1, n) AS BIGINT) AS hi2 FROM r WHERE k < n + m))
SELECT c_nationkey, feature, n AS n_ref, m AS n_cur, {rsql('ks_statistic')} AS ks_statistic,
  {rsql('least(1.0, greatest(0.0, 1.0 - coalesce(p[n - low + 1], 0)))')} AS p_value,
  least(1.0, greatest(0.0, 1.0 - coalesce(p[n - low + 1], 0))) < 0.05 AS drift_detected FROM r WHERE k = n + m""", ("D2",))
def ks_exact(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    c = c.select("c_nationkey", F.when(F.col("c_custkey") % 3 == 0, "current").otherwise("reference").alias("period"), F.col("c_acctbal").alias("balance"))
    return rounded(D.ks_test(c, ["balance"], "period", by=["c_nationkey"], exact_rows=D.EXACT_ROWS))


@register("d3_drift_report", _with(f"""SELECT count(*) FILTER (WHERE p_value < 0.05) > 0 AS has_drift,
  coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE p_value < 0.05)), ','), '') AS drifted_features,
  count(*) FILTER (WHERE p_value < 0.05) AS drift_count, {len(FEATURES)} AS total_features,
  {rsql(f'count(*) FILTER (WHERE p_value < 0.05) * 100.0 / {len(FEATURES)}')} AS drift_percentage,
  CAST(0.05 AS DOUBLE) AS threshold FROM kp"""), ("D3",))
def drift_report(spark, sf_dir):
    rep = D.drift_report(D.ks_test(_labelled(spark, sf_dir), FEATURES, "period"), FEATURES)
    return rounded(rep)


@register("d4_psi", _with(f"SELECT feature, {rsql('psi')} AS psi FROM ps", parts=("psi",)), ("D4",))
def psi(spark, sf_dir):
    return rounded(D.psi(_labelled(spark, sf_dir), FEATURES, "period"))


@register("d5_psi_bands", _with(f"""SELECT feature, {rsql('psi')} AS psi,
  CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.2 THEN 'moderate' ELSE 'significant' END AS band,
  CAST(row_number() OVER (ORDER BY psi DESC, feature) AS INTEGER) AS rank FROM ps""", parts=("psi",)), ("D5",))
def psi_bands(spark, sf_dir):
    return rounded(D.psi_bands(D.psi(_labelled(spark, sf_dir), FEATURES, "period")))


@register("d6_drift_history", with_views(f"""
SELECT "timestamp", feature_name, {rsql('drift_score')} AS drift_score, drift_score > 0.5 AS above_threshold
FROM drift_metrics WHERE feature_name IN ('click', 'purchase')""", drift_metrics=DRIFT_METRICS_SQL), ("D6",))
def drift_history(spark, sf_dir):
    return rounded(D.drift_history(fx.drift_metrics(spark, sf_dir), 0.5, ["click", "purchase"]))


@register("d7_monitoring_run", _with(f"""SELECT CAST((SELECT max(date) FROM lab) AS DATE) AS as_of,
  kp.feature AS feature_name, {rsql('ks_statistic')} AS drift_score, p_value < 0.05 AS drift_detected,
  {rsql('ks_statistic')} AS ks_statistic, {rsql('p_value')} AS ks_pvalue, {rsql('psi')} AS psi_score
FROM kp JOIN ps USING (feature)""", parts=("ks", "psi")), ("D7",))
def monitoring_run(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", *FEATURES])
    return rounded(D.monitoring_run(s, FEATURES, "date"))


def _run_sql(before: str) -> str:
    """The monitoring run on rows up to a day: the D7 statement over a view cut there."""
    cut = f"(SELECT * FROM ({sales_sql()}) WHERE date <= {before})"
    inner = _with(f"""SELECT CAST((SELECT max(date) FROM lab) AS DATE) AS as_of,
  kp.feature AS feature_name, {rsql('ks_statistic')} AS drift_score, p_value < 0.05 AS drift_detected,
  {rsql('ks_statistic')} AS ks_statistic, {rsql('p_value')} AS ks_pvalue, {rsql('psi')} AS psi_score
FROM kp JOIN ps USING (feature)""", parts=("ks", "psi"))
    return inner.replace(f"({sales_sql()})", cut)


@register("d7_appended_history", f"""
SELECT * FROM ({_run_sql("(SELECT max(l_shipdate) - INTERVAL 45 DAY FROM lineitem)")}) UNION ALL SELECT * FROM ({_run_sql("(SELECT max(l_shipdate) FROM lineitem)")})""", ("D7", "IO8"))
def appended_history(spark, sf_dir):
    """Two runs appended to ``drift_metrics``, the second one twice: each day's rows stand there once."""
    s = sales(spark, sf_dir, ["date", *FEATURES])
    path = scratch_path(spark, "d7-drift-metrics")
    newest = s.agg(F.max("date")).first()[0]
    for back in (45, 0, 0):
        upto = s.where(F.col("date") <= F.date_sub(F.lit(newest), back))
        D.append_drift_metrics(D.monitoring_run(upto, FEATURES, "date"), path)
    return rounded(D.read_drift_metrics(spark, path))


@register("d7_sketched_decisions", _with("""SELECT CAST((SELECT max(date) FROM lab) AS DATE) AS as_of, kp.feature AS feature_name,
  p_value < 0.05 AS drift_detected, psi > 0.2 AS psi_significant FROM kp JOIN ps USING (feature)""", parts=("ks", "psi")), ("D7", "PM7"))
def sketched_decisions(spark, sf_dir):
    """The run's decisions from stored daily sketches; the second update reads the newest days only."""
    s = sales(spark, sf_dir, ["date", *FEATURES])
    path = scratch_path(spark, "d7-summaries")
    newest = s.agg(F.max("date")).first()[0]
    summarise = lambda df: SK.daily_summaries(df, FEATURES)
    SK.update(s.where(F.col("date") <= F.date_sub(F.lit(newest), 20)), path, summarise)
    SK.update(s, path, summarise)
    run = SK.monitoring_run(s, SK.stored(spark, path), FEATURES, newest)
    return run.select("as_of", "feature_name", "drift_detected", "psi_significant")


@register("pm7_stored_errors", with_views(f"""
SELECT region, {metric_sql('sales', 'predicted')} FROM sales WHERE date > (SELECT max(date) FROM sales) - INTERVAL 90 DAY GROUP BY region""",
                                          sales=sales_sql()), ("PM7", "PM1"))
def stored_errors(spark, sf_dir):
    """Error metrics of the last 90 days from daily sums."""
    s = sales(spark, sf_dir, ["date", "region", "sales", "predicted"])
    path = scratch_path(spark, "pm7-errors")
    SK.update(s, path, lambda df: SK.daily_errors(df, "sales", "predicted", by=["region"]))
    errors = SK.stored(spark, path)
    newest = errors.agg(F.max("day")).first()[0]
    out = SK.metrics_of(errors.where(F.col("day") > F.date_sub(F.lit(newest), 90)), ["region"])
    return rounded(out, 6, cols=["rmse", "mae", "r2"]).withColumn("mape", sig("mape", 9))
