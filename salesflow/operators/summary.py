"""Aggregations and summaries.

All are single ``groupBy``/``agg`` plans: partial aggregation on the map side,
one shuffle on the (small) group key. Quantiles go through the prefix-sum
block, never through a per-group value map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.exprs import nan_to_null
from salesflow.operators.blocks import attach, exact_quantiles, null_safe_join, quantiles_from_counts, unpivot_numeric
from salesflow.operators.blocks import value_counts as value_counts_table


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A1 ---------------------------------------------------------------------------------------------
def group_totals(df: DataFrame, key, value: str) -> DataFrame:
    """Sum / mean / count of ``value`` by one key; NaN counts as missing."""
    v = nan_to_null(value) if dict(df.dtypes).get(value) in ("double", "float") else F.col(value)
    return df.groupBy(key).agg(
        F.sum(v).alias("total"), F.avg(v).alias("mean"), F.count(v).alias("count"))


# A2 ---------------------------------------------------------------------------------------------
def daily_totals(df: DataFrame, date: str = "date", value: str = "sales") -> DataFrame:
    return df.groupBy(date).agg(F.sum(value).alias("daily_sales"), F.count(F.lit(1)).alias("n_rows"))


def revenue_overview(df: DataFrame, date: str = "date", value: str = "sales") -> DataFrame:
    """Total revenue, number of days and average daily revenue (one row)."""
    daily = daily_totals(df, date, value)
    return daily.agg(F.sum("daily_sales").alias("total_revenue"),
                     F.count(F.lit(1)).alias("n_days"),
                     F.avg("daily_sales").alias("avg_daily_revenue"))


# A3 ---------------------------------------------------------------------------------------------
def weekend_boost(df: DataFrame, date: str = "date", value: str = "sales", by=()) -> DataFrame:
    """Weekend vs weekday totals, means and the weekend boost in %."""
    wk = F.weekday(date) >= 5
    out = df.groupBy(*by).agg(
        F.sum(F.when(wk, F.col(value))).alias("weekend_total"),
        F.sum(F.when(~wk, F.col(value))).alias("weekday_total"),
        F.avg(F.when(wk, F.col(value))).alias("weekend_mean"),
        F.avg(F.when(~wk, F.col(value))).alias("weekday_mean"))
    return out.withColumn("boost_pct", F.try_divide(F.col("weekend_mean") - F.col("weekday_mean"),
                                                    F.col("weekday_mean")) * 100)


# A4 ---------------------------------------------------------------------------------------------
def peak_period(df: DataFrame, key: str, value: str) -> DataFrame:
    """Key with the largest total (ties: lowest key), plus that total."""
    totals = df.groupBy(key).agg(F.sum(value).alias("total"))
    best = F.min_by(F.struct(F.col(key).alias("k"), F.col("total").alias("t")),
                    F.struct((-F.col("total")).alias("nt"), F.col(key).alias("k")))
    return totals.agg(best.alias("b")).select(F.col("b.k").alias(f"peak_{key}"),
                                              F.col("b.t").alias("peak_total"))


# A5 ---------------------------------------------------------------------------------------------
def value_counts(df: DataFrame, cols) -> DataFrame:
    """(column, value, count, pct) for categorical columns; NULL counted as its own value."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    # per-column totals as a small aggregate joined back (a high-cardinality column
    # must not land in one window partition)
    totals = counts.groupBy("column").agg(F.sum("count").alias("_total"))
    return attach(counts, totals, ["column"]).select(
        "column", "value", "count", (F.col("count") * 100.0 / F.col("_total")).alias("pct"))


# A6 / A7 ------------------------------------------------------------------------------------------
DEFAULT_PERCENTILES = (0.25, 0.5, 0.75)


def numeric_summary(df: DataFrame, cols, percentiles=DEFAULT_PERCENTILES,
                    with_missing: bool = False, approx: bool = False, method: str = "bracket") -> DataFrame:
    """describe(): count, mean, std, min, quantiles, max per column (+ missing count / %).

    ``method="bracket"`` (default): moments and missing counts in one streaming
    aggregate, exact quantiles by bracket-and-select (two more scans, no
    shuffle of the distinct values). ``method="counts"``: everything from one
    materialised (column, value, count) table - one scan, but the table holds
    every distinct value. ``approx=True``: one aggregate with ``percentile_approx``.
    """
    long = unpivot_numeric(df, cols)
    names = [f"p{int(round(p * 100))}" for p in percentiles]
    if approx:
        base = long.groupBy("column").agg(
            F.count("value").alias("count"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
            F.max("value").alias("max"), F.count(F.lit(1)).alias("_rows"),
            F.percentile_approx("value", list(percentiles), 10000).alias("_pq"))
        out = base.select("*", *[F.col("_pq")[i].alias(n) for i, n in enumerate(names)]).drop("_pq")
    elif method == "bracket":
        # moments in one streaming aggregate; exact quantiles by bracket-and-select
        base = long.groupBy("column").agg(
            F.count("value").alias("count"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
            F.max("value").alias("max"), F.count(F.lit(1)).alias("_rows"))
        q = exact_quantiles(long, ["column"], "value", percentiles)
        qw = q.groupBy("column").agg(
            *[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(n) for p, n in zip(percentiles, names)])
        out = base.join(qw, "column", "left")
    else:
        counts = value_counts_table(long, ["column"], "value", drop_nulls=False)
        present = F.col("value").isNotNull()
        m1 = counts.groupBy("column").agg(
            F.sum("_n").alias("_rows"), F.sum(F.when(present, F.col("_n"))).alias("count"),
            (F.sum(F.col("value") * F.col("_n")) / F.sum(F.when(present, F.col("_n")))).alias("mean"),
            F.min("value").alias("min"), F.max("value").alias("max"))
        ss = attach(counts, m1.select("column", F.col("mean").alias("_m")), ["column"]).groupBy("column").agg(
            F.sum(F.col("_n") * (F.col("value") - F.col("_m")) * (F.col("value") - F.col("_m"))).alias("_ss"))
        base = m1.join(ss, "column").withColumn(
            "std", F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1)))).drop("_ss")
        q = quantiles_from_counts(counts, ["column"], "value", percentiles, n_groups=len(list(cols)))
        qw = q.groupBy("column").agg(
            *[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(n) for p, n in zip(percentiles, names)])
        out = base.join(qw, "column", "left")
        out = out.withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long"))
    if with_missing:
        out = (out.withColumn("missing", F.col("_rows") - F.col("count"))
               .withColumn("missing_pct", F.col("missing") * 100.0 / F.col("_rows")))
    return out.select("column", "count", "mean", "std", "min", *names, "max",
                      *(["missing", "missing_pct"] if with_missing else []))


# A8 ---------------------------------------------------------------------------------------------
def missing_report(df: DataFrame, cols=None) -> DataFrame:
    """(column, missing, missing_pct) in one pass; NaN counts as missing."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)

    def miss(c):
        x = F.col(c)
        if types[c] in ("double", "float"):
            return x.isNull() | F.isnan(x)
        return x.isNull()

    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(miss(c)).alias(c) for c in cols])
    long = row.unpivot(["_n"], cols, "column", "missing")
    return long.select("column", "missing",
                       F.try_divide(F.col("missing") * 100.0, F.col("_n")).alias("missing_pct"))


#: largest domain that is listed in one row
MAX_LISTED = 100_000


# A11 --------------------------------------------------------------------------------------------
def distinct_values(df: DataFrame, cols, approx: bool = False, with_values: bool = False) -> DataFrame:
    """(column, n_distinct[, values]) per column.

    ``with_values`` lists a domain of at most ``MAX_LISTED`` values in one row (a larger one
    raises an error: ``domain`` has it as rows, at any size); counts alone scale to any cardinality.
    """
    cols = list(cols)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    if approx:
        return long.groupBy("column").agg(F.approx_count_distinct("value").alias("n_distinct"))
    # de-duplicate with a shuffle on (column, value) first; the final list is per column
    d = long.where(F.col("value").isNotNull()).distinct()
    aggs = [F.count(F.lit(1)).alias("n_distinct")]
    if not with_values:
        return d.groupBy("column").agg(*aggs)
    sizes = d.groupBy("column").agg(*aggs).agg(F.max("n_distinct")).first()[0] or 0
    if sizes > MAX_LISTED:
        raise ValueError(f"a domain of {sizes} values is not listed in one row; use domain()")
    return d.groupBy("column").agg(*aggs, F.array_sort(F.collect_list("value")).alias("values"))


def domain(df: DataFrame, cols) -> DataFrame:
    """Distinct (column, value, n_rows) rows: a domain of any size, spread over the tasks."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))


# A12 --------------------------------------------------------------------------------------------
def histogram(df: DataFrame, value: str, bins: int = 50, by=()) -> DataFrame:
    """Equal-width histogram, zero-filled: (by..., bin, lo, hi, count). Max goes into the last bin."""
    by = list(by)
    v = nan_to_null(F.col(value).cast("double"))
    base = df.select(*by, v.alias("_v")).where(F.col("_v").isNotNull())
    rng = base.groupBy(*by).agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    width = (F.col("_max") - F.col("_min")) / bins
    idx = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_min")) / width), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    # rng has one row per group: joined back by key (broadcast chosen by AQE on measured size)
    counts = attach(base, rng, by).select(*by, idx.alias("bin")).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*by, "_min", "_max", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("_max") - F.col("_min")) / bins
    out = null_safe_join(grid, counts, by + ["bin"], "left")
    return out.select(*by, "bin", (F.col("_min") + F.col("bin") * w).alias("lo"),
                      (F.col("_min") + (F.col("bin") + 1) * w).alias("hi"),
                      F.coalesce("count", F.lit(0)).cast("long").alias("count"))


# A13 --------------------------------------------------------------------------------------------
def box_stats(df: DataFrame, value: str, by=(), k: float = 1.5) -> DataFrame:
    """Quartiles, IQR whiskers (most extreme values inside the fences) and outlier count.

    Exact quartiles by bracket-and-select, then one aggregate over the rows
    with the per-group fences attached.
    """
    by = list(by)
    v = nan_to_null(F.col(value).cast("double"))
    base = df.select(*by, v.alias("value"))
    q = exact_quantiles(base, by, "value", (0.25, 0.5, 0.75))
    qw = q.groupBy(*by).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
                              for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - k * F.col("iqr")
    hi = F.col("q3") + k * F.col("iqr")
    j = attach(base.where(F.col("value").isNotNull()), qw, by)
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    return j.groupBy(*by, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))


# A14 --------------------------------------------------------------------------------------------
def share_of_total(df: DataFrame, key, value: str) -> DataFrame:
    """(key, total, share_pct); the grand total is a one-row aggregate attached as a scalar."""
    t = df.groupBy(key).agg(F.sum(value).alias("total"))
    grand = t.agg(F.sum("total").alias("_grand"))  # one row -> scalar subquery
    return attach(t, grand).select(*([key] if isinstance(key, str) else key), "total",
                                   F.try_divide(F.col("total") * 100.0, F.col("_grand")).alias("share_pct"))


# A15 --------------------------------------------------------------------------------------------
def dataset_overview(df: DataFrame, date: str = "date", dims=("region", "product")) -> DataFrame:
    """Rows, columns, missing cells, date range, days, distinct values of the dims (one row)."""
    cols = df.columns
    types = dict(df.dtypes)
    miss = sum((F.count_if(F.col(c).isNull() | F.isnan(F.col(c))) if types[c] in ("double", "float")
                else F.count_if(F.col(c).isNull())) for c in cols)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(cols)).alias("n_columns"),
        miss.alias("n_missing"), F.min(date).alias("date_min"), F.max(date).alias("date_max"),
        F.datediff(F.max(date), F.min(date)).alias("n_days"),
        *[F.countDistinct(d).alias(f"n_{d}") for d in dims])


# A16 --------------------------------------------------------------------------------------------
def prediction_stats(df: DataFrame, as_of, hours: int = 24, ts: str = "timestamp",
                     value: str = "predicted_sales", confidence: str | None = None) -> DataFrame:
    """Count, avg/min/max prediction in the last ``hours`` before ``as_of`` (one row, also when empty)."""
    recent = df.where(F.col(ts) >= _c(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS"))
    aggs = [F.count(F.lit(1)).alias("total_predictions"), F.avg(value).alias("avg_prediction"),
            F.min(value).alias("min_prediction"), F.max(value).alias("max_prediction")]
    if confidence:
        aggs.append(F.avg(confidence).alias("avg_confidence"))
    return recent.agg(*aggs)


# A17 --------------------------------------------------------------------------------------------
def prediction_headline(df: DataFrame, value: str = "predicted_sales", error: str = "absolute_error",
                        region: str = "region") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_predictions"), F.avg(value).alias("avg_prediction"),
                  F.avg(error).alias("mean_error"), F.countDistinct(region).alias("n_regions"))


# A18 --------------------------------------------------------------------------------------------
def predictions_by(df: DataFrame, key: str = "region", value: str = "predicted_sales") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"), F.avg(value).alias("mean"),
                               F.sum(value).alias("total"))


# A19 --------------------------------------------------------------------------------------------
def daily_counts(df: DataFrame, as_of, days: int = 7, ts: str = "timestamp") -> DataFrame:
    recent = df.where(F.col(ts) >= _c(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))
    return recent.groupBy(F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("count"))


# A20 --------------------------------------------------------------------------------------------
def drift_alert_summary(dm: DataFrame) -> DataFrame:
    """Per feature: flagged count, last flagged timestamp, mean score (4 dp)."""
    return (dm.where(F.col("drift_detected"))
            .groupBy("feature_name").agg(F.count(F.lit(1)).alias("alert_count"),
                                         F.max("timestamp").alias("last_alert"),
                                         F.round(F.avg("drift_score"), 4).alias("avg_score")))


# A21 --------------------------------------------------------------------------------------------
def drift_headline(dm: DataFrame) -> DataFrame:
    """At the latest timestamp: any drift, drifted / total features, max score."""
    latest = dm.agg(F.max("timestamp").alias("_latest"))
    snap = dm.join(F.broadcast(latest), F.col("timestamp") == F.col("_latest"))  # one-row side
    return snap.agg(F.max("_latest").alias("timestamp"), F.bool_or("drift_detected").alias("has_drift"),
                    F.countDistinct(F.when(F.col("drift_detected"), F.col("feature_name"))).alias("n_drifted"),
                    F.countDistinct("feature_name").alias("n_features"),
                    F.max("drift_score").alias("max_score"))
