"""Feature operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions import exprs as X
from salesflow.operators import windows as W
from salesflow.operators.blocks import attach

TIME_FEATURES = ("year", "month", "day", "day_of_week", "day_of_year", "week_of_year", "quarter",
                 "is_weekend", "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end",
                 "season", "month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos")


# F1 ---------------------------------------------------------------------------------------------
def add_time_features(df: DataFrame, date: str = "date") -> DataFrame:
    """17 calendar columns in one projection; unchanged when ``date`` is absent."""
    if date not in df.columns:
        return df
    d = F.to_date(F.col(date))
    parts = X.time_parts(d)
    flags = X.calendar_flags(d)
    ms, mc = X.cyclic(parts["month"], 12)
    ds, dc = X.cyclic(parts["day_of_week"], 7)
    cols = [parts[k].alias(k) for k in parts] + [flags[k].alias(k) for k in flags] + [
        X.season(parts["month"]).alias("season"), ms.alias("month_sin"), mc.alias("month_cos"),
        ds.alias("day_of_week_sin"), dc.alias("day_of_week_cos")]
    keep = [c for c in df.columns if c not in TIME_FEATURES]
    return df.select(*keep, *cols)


# F3 ---------------------------------------------------------------------------------------------
def interaction_plan(df: DataFrame, cols) -> list[tuple[str, str, bool]]:
    """Fit: for each pair (a, b), whether b is non-zero in every row (one aggregate pass).

    NULL divisors count as non-zero, as in pandas where ``NaN != 0`` is true.
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    divisors = sorted({b for _, b in pairs})
    if not divisors:
        return []
    row = df.agg(*[F.coalesce(F.bool_and(F.coalesce(F.col(b) != 0, F.lit(True))), F.lit(True)).alias(b)
                   for b in divisors]).collect()[0]
    return [(a, b, bool(row[b])) for a, b in pairs]


def add_interactions(df: DataFrame, cols, plan=None) -> DataFrame:
    """``a_x_b`` for each pair; ``a_div_b`` only where b is never zero."""
    cols = list(cols)
    if len(cols) < 2:
        return df
    plan = plan if plan is not None else interaction_plan(df, cols)
    new = []
    for a, b, can_div in plan:
        new.append((F.col(a) * F.col(b)).alias(f"{a}_x_{b}"))
        if can_div:
            # the plan may come from other rows (serving): a zero there gives NULL, not an error
            new.append(F.try_divide(F.col(a), F.col(b)).alias(f"{a}_div_{b}"))
    return df.select("*", *new)


# F4 ---------------------------------------------------------------------------------------------
GROUP_AGGS = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp, "min": F.min, "max": F.max,
              "count": F.count}


def add_group_stats(df: DataFrame, target: str, keys, aggs=("mean", "sum", "std", "min", "max", "count")) -> DataFrame:
    """``{t}_{key}_{agg}`` per key, one key at a time; NULL-key rows get NULL.

    One partially-aggregated groupBy per key, materialised and counted before it is joined back
    (``blocks.attach``): rows are never shuffled by a key of a few values.
    """
    out = df
    t = F.col(target)
    if dict(df.dtypes).get(target) in ("double", "float"):
        t = F.when(F.isnan(target), None).otherwise(t)  # NaN is missing, as in pandas
    for k in keys:
        stats = df.groupBy(k).agg(*[F.when(F.col(k).isNotNull(), GROUP_AGGS[a](t)).alias(f"{target}_{k}_{a}") for a in aggs])
        out = attach(out, stats, [k])
    return out


# F5 ---------------------------------------------------------------------------------------------
def add_all_features(df: DataFrame, order, target: str = "sales", group=("region", "product"),
                     lags=(1, 7, 30), windows=(7, 30), interaction_cols=("price", "quantity"),
                     chunk_rows: int = W.CHUNK_ROWS) -> DataFrame:
    """F1 -> W1 -> W2 -> F3 in one plan; one shared window for lags and rolling stats.

    ``order`` must be total within a group (end it with a unique key). Groups are
    always cut into halo chunks of ``chunk_rows`` rows, so no group is one task.
    """
    out = rows = add_time_features(df)
    if target in out.columns:
        out = W.add_history(out, target, group, order, lags=lags, windows=windows, chunk_rows=chunk_rows)
    present = [c for c in interaction_cols if c in out.columns]
    # the history keeps every row as it is, so the divisors are looked at before it where they are there
    plan = interaction_plan(rows, present) if len(present) > 1 and set(present) <= set(rows.columns) - {target} else None
    return add_interactions(out, present, plan)


def feature_names(df: DataFrame, target: str = "sales", exclude=("date",)) -> list[str]:
    return [c for c in df.columns if c != target and c not in exclude]


# F6 ---------------------------------------------------------------------------------------------
# Month multipliers (1..12) and weekday multipliers (Mon..Fri) of the
# reference demand model; weekend days use a per-product boost (default 1.0).
MONTH_MULTIPLIERS = (0.8, 0.85, 0.95, 1.0, 1.05, 1.1, 1.15, 1.1, 1.0, 1.05, 1.2, 1.4)
WEEKDAY_MULTIPLIERS = (0.95, 1.0, 1.0, 1.05, 1.1)
ANNUAL_GROWTH = 0.15


def demand_index(df: DataFrame, date: str, region: str, product: str, actual: str,
                 preferences: DataFrame | None = None, weekend_boost: DataFrame | None = None,
                 start=None) -> DataFrame:
    """expected = base(product) x month x weekday x preference(region, product) x trend.

    base = mean ``actual`` per product; trend = 1 + 15 % x years since ``start``
    (default: the first date). Adds ``expected`` and ``demand_ratio``.
    """
    base = df.groupBy(product).agg(F.when(F.col(product).isNotNull(), F.avg(actual)).alias("_base"))
    out = attach(df, base, [product])
    if preferences is not None:  # (region, product, preference) - a small user table
        out = out.join(preferences, [region, product], "left")
    else:
        out = out.withColumn("preference", F.lit(None).cast("double"))
    if weekend_boost is not None:  # (product, weekend_boost)
        out = out.join(weekend_boost, product, "left")
    else:
        out = out.withColumn("weekend_boost", F.lit(None).cast("double"))
    month_m = F.element_at(F.array(*[F.lit(x) for x in MONTH_MULTIPLIERS]), F.month(date))
    dow = F.weekday(date)
    dow_m = F.when(dow >= 5, F.coalesce(F.col("weekend_boost"), F.lit(1.0))).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_MULTIPLIERS]), dow + 1))
    if start is None:
        first = df.agg(F.min(date).alias("_start"))
        out = attach(out, first)
    else:
        out = out.withColumn("_start", F.lit(start).cast("date"))
    trend = 1.0 + ANNUAL_GROWTH * F.datediff(F.col(date), F.col("_start")) / 365.25
    expected = F.col("_base") * month_m * dow_m * F.coalesce(F.col("preference"), F.lit(1.0)) * trend
    return (out.withColumn("expected", expected)
            .withColumn("demand_ratio", F.try_divide(F.col(actual), F.col("expected")))
            .drop("_base", "_start", "preference", "weekend_boost"))


# F7 ---------------------------------------------------------------------------------------------
def serving_features(df: DataFrame, feature_cols, date: str = "date",
                     interaction_cols=("price", "quantity"), plan=None,
                     drop=("region", "product", "date")) -> DataFrame:
    """Scoring-time features: F1 + F3, NULL -> 0, identifiers dropped, fixed training column list."""
    out = add_time_features(df, date)
    present = [c for c in interaction_cols if c in out.columns]
    out = add_interactions(out, present, plan)
    cols = [c for c in feature_cols if c not in drop]
    missing = [c for c in cols if c not in out.columns]
    out = out.select(*[c for c in out.columns if c not in drop or c in ("prediction_key",)],
                     *[F.lit(0.0).alias(c) for c in missing])
    num = [c for c, t in out.dtypes if t in ("double", "float", "int", "bigint", "smallint")]
    return out.fillna(0, subset=num)
