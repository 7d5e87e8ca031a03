"""Projection, filter, top-N, joins and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.operators.blocks import attach


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 ---------------------------------------------------------------------------------------------
def split_features_target(df: DataFrame, target: str, key=(), drop=("date",), exclude=()) -> DataFrame:
    """Features + target in one keyed frame (never two positionally aligned frames)."""
    gone = set(drop) | set(exclude)
    feats = [c for c in df.columns if c not in gone and c != target and c not in key]
    return df.select(*key, *feats, F.col(target).alias("target"))


# P2 ---------------------------------------------------------------------------------------------
def diagonal_range(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.least(F.min(actual), F.min(predicted)).alias("range_min"),
                  F.greatest(F.max(actual), F.max(predicted)).alias("range_max"),
                  F.count(F.lit(1)).alias("n_points"))


def scatter_points(df: DataFrame, key, actual: str, predicted: str) -> DataFrame:
    """Every (actual, predicted) point of the rows that have an actual."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.where(F.col(actual).isNotNull()).select(*keys, actual, predicted)


# P3 / P5 ----------------------------------------------------------------------------------------
def recent(df: DataFrame, ts: str, as_of=None, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` before ``as_of`` (default: the newest ``ts``)."""
    end = df.select(F.max(ts)).scalar() if as_of is None else _c(as_of)
    return df.where(F.col(ts) >= end - F.make_interval(days=F.lit(days)))


def recent_rows(df: DataFrame, order, days: int = 7, rows_per_day: int = 100) -> DataFrame:
    """Without a time column: the last ``days * rows_per_day`` rows in the given (total) order."""
    return top_n(df, order, days * rows_per_day)


def label_period(df: DataFrame, date: str, as_of, days: int = 30, name: str = "period") -> DataFrame:
    """reference (< cutoff) / current (>= cutoff), cutoff = as_of - days; NULL dates are in neither (NULL)."""
    cutoff = F.date_sub(_c(as_of), days)
    return df.withColumn(name, F.when(F.col(date) >= cutoff, F.lit("current"))
                         .when(F.col(date) < cutoff, F.lit("reference")))


# P4 / P6 / P7 -------------------------------------------------------------------------------------
def top_n(df: DataFrame, order, n: int, desc: bool = True, tiebreak=()) -> DataFrame:
    """orderBy + limit -> TakeOrderedAndProject (per-task top-n, then a merge of n x tasks rows)."""
    cols = [F.col(c).desc() if desc else F.col(c).asc() for c in ([order] if isinstance(order, str) else order)]
    return df.orderBy(*cols, *[F.col(t).asc() for t in tiebreak]).limit(n)


# P8 ---------------------------------------------------------------------------------------------
def page(df: DataFrame, ts: str, key: str, limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(F.col(ts).desc(), F.col(key).desc()).offset(offset).limit(limit)


def page_after(df: DataFrame, ts: str, key: str, limit: int, after_ts=None, after_key=None) -> DataFrame:
    """Keyset paging: rows strictly after the last (ts, key) seen; cost independent of depth."""
    if after_ts is not None:
        t, k = F.lit(after_ts), F.lit(after_key)
        df = df.where((F.col(ts) < t) | ((F.col(ts) == t) & (F.col(key) < k)))
    return df.orderBy(F.col(ts).desc(), F.col(key).desc()).limit(limit)


# P9 ---------------------------------------------------------------------------------------------
def latest_record(df: DataFrame, ts: str, key: str) -> DataFrame:
    """The newest row as one aggregate (max_by over a struct; partial aggregation, no sort)."""
    cols = df.columns
    best = F.max_by(F.struct(*cols), F.struct(F.col(ts), F.col(key)))
    return df.agg(best.alias("_r")).select("_r.*")


# P10 --------------------------------------------------------------------------------------------
def latest_snapshot(df: DataFrame, ts: str) -> DataFrame:
    latest = df.agg(F.max(ts).alias("_latest"))
    return attach(df, latest).where(F.col(ts) == F.col("_latest")).drop("_latest")


# P12 / P13 ---------------------------------------------------------------------------------------
def error_columns(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """absolute_error, percentage_error (NULL when actual = 0), residual."""
    e = F.col(actual) - F.col(predicted)
    return df.select("*", F.abs(e).alias("absolute_error"),
                     (F.try_divide(F.abs(e), F.abs(F.col(actual))) * 100).alias("percentage_error"),
                     e.alias("residual"))


# J1 ---------------------------------------------------------------------------------------------
def attach_by_key(left: DataFrame, right: DataFrame, key, how: str = "left") -> DataFrame:
    """Keyed alignment of two frames (replaces positional concat)."""
    return left.join(right, key, how)


# J2 ---------------------------------------------------------------------------------------------
def lookup(df: DataFrame, dim: DataFrame, key, how: str = "left") -> DataFrame:
    """Dimension lookup; Spark broadcasts the dimension only if its measured bytes allow it."""
    return df.join(dim, key, how)


def map_lookup(col, mapping: dict, default=None) -> Column:
    """Literal map lookup for tiny fixed dictionaries (no join at all)."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    v = F.element_at(m, _c(col)) if default is None else F.coalesce(m[_c(col)], F.lit(default))
    return v


# J4 ---------------------------------------------------------------------------------------------
def members(df: DataFrame, col: str, allowed, keep: bool = True) -> DataFrame:
    """Rows whose value is (keep=True) / is not (keep=False) in a literal domain."""
    dom = df.sparkSession.createDataFrame([(v,) for v in allowed], [col])
    # the domain is a literal list given by the caller: bounded by construction
    return df.join(F.broadcast(dom), col, "left_semi" if keep else "left_anti")


# J5 ---------------------------------------------------------------------------------------------
def compare_stages(versions: DataFrame, name: str, stage: str, version: str, metric: str,
                   stages=("Production", "Staging")) -> DataFrame:
    """Latest version per (model, stage), side by side for the given stages."""
    latest = versions.groupBy(name, stage).agg(
        F.max_by(F.struct(F.col(version).alias("v"), F.col(metric).alias("m")), F.col(version)).alias("_l"))
    wide = latest.groupBy(name).pivot(stage, list(stages)).agg(F.first("_l"))
    cols = [F.col(name)]
    for s in stages:
        k = s.lower()
        cols += [F.col(f"`{s}`.v").alias(f"{k}_version"), F.col(f"`{s}`.m").alias(f"{k}_{metric}")]
    out = wide.select(*cols)
    a, b = [s.lower() for s in stages[:2]]
    return out.withColumn(f"{metric}_delta", F.col(f"{b}_{metric}") - F.col(f"{a}_{metric}"))


# U1 ---------------------------------------------------------------------------------------------
def append(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# U3 ---------------------------------------------------------------------------------------------
def stack_votes(*frames: DataFrame, item: str = "feature") -> DataFrame:
    """Union partial selections and count votes per item."""
    return append(*[f.select(item) for f in frames]).groupBy(item).agg(F.count(F.lit(1)).alias("votes"))
