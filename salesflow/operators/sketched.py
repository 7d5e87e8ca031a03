"""Incremental monitoring from a stored table of daily summaries (D7, PM7).

A day is read once: for each (day, group, feature) a KLL sketch of the values and their count, and for each
(day, group) the sums behind the error metrics. Sketches and sums merge, so a monitoring run over any window reads
that small table, and a second run reads one more day of data.

A sketch's ranks are off by at most ``rank_error(k)`` (three times the error that KLL keeps with 99 %).
With it the KS statistic and the PSI lie between bounds. A feature whose bounds fall on one side of its limits is decided
by them; only features whose bounds straddle a limit are counted exactly, from the rows of the two periods.
The sums of the error metrics are exact.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.exprs import nan_to_null
from salesflow.operators import drift as D
from salesflow.operators.blocks import null_safe_join
from salesflow.operators.models import EPS
from salesflow.operators.relational import label_period

SKETCH_K = 2000


def rank_error(k: int = SKETCH_K) -> float:
    """Three times KLL's published normalised rank error (2.296 / k^0.9)."""
    return 3 * 2.296 / k ** 0.9


def daily_summaries(df: DataFrame, features, date: str = "date", by=(), k: int = SKETCH_K) -> DataFrame:
    """(day, by..., feature, n, sketch): one aggregation, pre-merged in each task.

    The features are aggregated side by side and made rows of afterwards: a row of ``df`` stays one row.
    """
    by, features = list(by), list(features)
    cast = df.select(F.to_date(date).alias("day"), *by, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in features])
    daily = cast.groupBy("day", *by).agg(*[a for i, c in enumerate(features) for a in (
        F.count(c).alias(f"_n{i}"), F.kll_sketch_agg_double(c, k).alias(f"_s{i}"))])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(features)]
    return daily.select("day", *by, F.inline(F.array(*rows))).where("n > 0")


def daily_errors(df: DataFrame, actual: str, predicted: str, date: str = "date", by=()) -> DataFrame:
    """(day, by..., n, sums): what the metrics of M6 are made of, for complete pairs."""
    y, p = (nan_to_null(F.col(c).cast("double")) for c in (actual, predicted))
    rows = df.select(F.to_date(date).alias("day"), *by, y.alias("y"), p.alias("p")).dropna(subset=["y", "p"])
    e = F.col("y") - F.col("p")
    sums = {"e2": e * e, "ae": F.abs(e), "ape": F.abs(e) / F.greatest(F.abs("y"), F.lit(EPS)), "sy": F.col("y"), "syy": F.col("y") * F.col("y")}
    return rows.groupBy("day", *by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(c) for c, v in sums.items()])


def metrics_of(errors: DataFrame, by=()) -> DataFrame:
    """(by..., n, rmse, mae, r2, mape) of all days in ``errors``."""
    s = errors.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n", "e2", "ae", "ape", "sy", "syy")])
    sst = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    r2 = F.when(sst <= 0, F.when(F.col("e2") == 0, 1.0).otherwise(0.0)).otherwise(1 - F.col("e2") / sst)
    return s.select(*by, "n", F.sqrt(F.col("e2") / F.col("n")).alias("rmse"), (F.col("ae") / F.col("n")).alias("mae"), r2.alias("r2"),
                    (F.col("ape") / F.col("n") * 100).alias("mape"))


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # a table that is not there yet is the only reason to begin one
            raise
        return None


def update(df: DataFrame, path: str, summarise, date: str = "date") -> int:
    """Append the days of ``df`` after the newest stored one; returns how many.

    ``summarise`` makes the summaries of a frame. The bound is a literal, so it prunes the scan. Every update is a
    partition, named by the newest day before it: one that is started again replaces itself.
    """
    spark = df.sparkSession
    old = stored(spark, path)
    newest = old.agg(F.max("day")).first()[0] if old is not None else None
    fresh = df if newest is None else df.where(F.to_date(date) > F.lit(newest))
    days = fresh.select(F.to_date(date).alias("day")).distinct().count()
    if days:
        (summarise(fresh).withColumn("after", F.lit(str(newest))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("after").parquet(path))
    return days


def _windows(summaries: DataFrame, as_of, days: int, by, k: int) -> DataFrame:
    """(by..., feature, n_ref, n_cur, ref, cur): merged sketches of both periods, where both have rows."""
    g = [*by, "feature"]
    day = F.col("day")
    cut = F.date_sub(F.lit(as_of).cast("date"), days)
    rows = summaries.where(day <= F.lit(as_of)).withColumn("cur", day >= cut)
    merged = rows.groupBy(*g, "cur").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    # two rows for each group and feature
    side = lambda cur, name: merged.where(F.col("cur") == cur).select(*g, F.col("n").alias(f"n_{name}"), F.col("sketch").alias(name))
    return null_safe_join(side(False, "ref"), side(True, "cur"), g)


def _rank(quantiles: Column, x: Column, grid: int, strict: bool = False) -> Column:
    """The share of values up to (``strict``: under) ``x``, to 1 / ``grid`` and the sketch's error, from quantiles at 0, 1 / grid, ... 1."""
    return F.greatest(F.size(F.filter(quantiles, lambda q: q < x if strict else q <= x)) - 1, F.lit(0)) / F.lit(float(grid))


def bounds(windows: DataFrame, error: float, bins: int = 10, grid: int = 1000) -> DataFrame:
    """With ``ks``, ``ks_low``, ``ks_high``, ``psi_low``, ``psi_high`` from the sketches.

    Both distributions are known at the sketches' quantiles, up to the rank error and a step of the grid. KS: the
    largest gap there; between two neighbours neither rises by more than a step. PSI: each bin's shares lie in
    intervals, and the sum of its terms between their least and largest values.
    """
    probs = F.array(*[F.lit(i / grid) for i in range(grid + 1)])
    out = windows.withColumn("_r", F.kll_sketch_get_quantile_double(F.col("ref"), probs)).withColumn(
        "_c", F.kll_sketch_get_quantile_double(F.col("cur"), probs))
    gaps = F.transform(F.concat("_r", "_c"), lambda x: F.abs(_rank(F.col("_r"), x, grid) - _rank(F.col("_c"), x, grid)))
    error += 1.0 / grid
    out = out.withColumn("ks", F.array_max(gaps))
    out = out.withColumn("ks_low", F.greatest(F.lit(0.0), F.col("ks") - 2 * error)).withColumn("ks_high", F.least(F.lit(1.0), F.col("ks") + 2 * error + 1.0 / grid))
    # the exact reference decile i lies between two of the sketch's quantiles, so what lies below it in either period does too
    at = lambda i: F.round(i * F.lit(grid / bins)).cast("int")
    edges = F.filter(F.sequence(F.lit(1), F.lit(bins - 1)), lambda i: (i == 1) | (F.get("_r", at(i)) != F.get("_r", at(i - 1))))
    reach = int(error * grid) + 1
    below = F.transform(edges, lambda i: F.get("_r", F.greatest(at(i) - reach, F.lit(0))))
    above = F.transform(edges, lambda i: F.get("_r", F.least(at(i) + reach, F.lit(grid))))

    def cumulated(quantiles: str) -> tuple[Column, Column]:
        least = F.transform(below, lambda x: F.greatest(_rank(F.col(quantiles), x, grid, strict=True) - error, F.lit(0.0)))
        most = F.transform(above, lambda x: F.least(_rank(F.col(quantiles), x, grid) + error, F.lit(1.0)))
        return tuple(F.concat(F.array(F.lit(0.0)), c, F.array(F.lit(1.0))) for c in (least, most))

    for name, quantiles in (("r", "_r"), ("c", "_c")):
        least, most = cumulated(quantiles)
        steps = F.sequence(F.lit(1), F.size(least) - 1)
        out = out.withColumn(f"_{name}_low", F.transform(steps, lambda i: F.greatest(F.get(least, i) - F.get(most, i - 1), F.lit(0.0)))) \
            .withColumn(f"_{name}_high", F.transform(steps, lambda i: F.get(most, i) - F.get(least, i - 1)))  # noqa: B023

    def term(r: Column, c: Column) -> Column:
        r, c = r + F.lit(D.PSI_EPS), c + F.lit(D.PSI_EPS)
        return (c - r) * F.log(c / r)

    bin_ = F.arrays_zip("_r_low", "_r_high", "_c_low", "_c_high")
    smallest = F.transform(bin_, lambda x: F.when(x["_r_low"] > x["_c_high"], term(x["_r_low"], x["_c_high"]))
                           .when(x["_c_low"] > x["_r_high"], term(x["_r_high"], x["_c_low"])).otherwise(F.lit(0.0)))
    largest = F.transform(bin_, lambda x: F.greatest(term(x["_r_low"], x["_c_high"]), term(x["_r_high"], x["_c_low"])))
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    return out.withColumn("psi_low", add(smallest)).withColumn("psi_high", add(largest)).drop("_r", "_c", "_r_low", "_r_high", "_c_low", "_c_high")


def monitoring_run(df: DataFrame, summaries: DataFrame, features, as_of, date: str = "date", days: int = 30, threshold: float = D.DEFAULT_THRESHOLD,
                   bins: int = 10, by=(), k: int = SKETCH_K) -> DataFrame:
    """(by..., as_of, feature_name, drift_detected, psi_significant, ks_low, ks_high, psi_low, psi_high, exact).

    The decisions are those of the exact run (``drift.monitoring_run``): p-value under ``threshold``, PSI over 0.2. ``df`` is read
    for the features only that the sketches leave open in some group; their bounds are the exact values.
    """
    by = list(by)
    g = [*by, "feature"]
    b = bounds(_windows(summaries, as_of, days, by, k), rank_error(k), bins).checkpoint(eager=True)  # a row for each group and feature
    p = lambda d: D.kolmogorov_pvalue(F.col(d), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    b = b.withColumn("_ks", F.when(p("ks_low") < threshold, F.lit(True)).when(p("ks_high") >= threshold, F.lit(False))) \
        .withColumn("_psi", F.when(F.col("psi_low") > D.PSI_SIGNIFICANT, F.lit(True)).when(F.col("psi_high") <= D.PSI_SIGNIFICANT, F.lit(False)))
    unsure = F.col("_ks").isNull() | F.col("_psi").isNull()
    left = sorted(r["feature"] for r in b.where(unsure).select("feature").distinct().collect())
    known = [f for f in features if f in left]
    keep = [*by, F.lit(as_of).cast("date").alias("as_of"), F.col("feature").alias("feature_name")]
    settled = b.where(~unsure).select(*keep, F.col("_ks").alias("drift_detected"), F.col("_psi").alias("psi_significant"),
                                      "ks_low", "ks_high", "psi_low", "psi_high", F.lit(False).alias("exact"))
    if not known:
        return settled
    rows = df.where(F.to_date(date) <= F.lit(as_of)).select(*by, date, *known)
    lab = label_period(rows, date, F.lit(as_of), days)
    counts = D.period_counts(lab, known, "period", by)
    exact = null_safe_join(D.ks_test(lab, known, "period", threshold, by, counts=counts), D.psi(lab, known, "period", bins, by, counts=counts), g, "left")
    exact = null_safe_join(exact, b.where(unsure).select(*g), g)
    return settled.unionByName(exact.select(
        *keep, "drift_detected", (F.col("psi") > D.PSI_SIGNIFICANT).alias("psi_significant"), F.col("ks_statistic").alias("ks_low"),
        F.col("ks_statistic").alias("ks_high"), F.col("psi").alias("psi_low"), F.col("psi").alias("psi_high"), F.lit(True).alias("exact")))
