"""Window and sequence operators.

Per-group history (lags, rolling stats) uses one shared ``Window`` spec so
Spark sorts once. A group can hold a third of all rows; with ``chunk_rows`` set
the group is cut into fixed-size chunks of its ordered row index and every
chunk also receives the ``halo`` rows before it, so the window runs in many
balanced tasks and stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.operators.blocks import attach, prefix_sums_by_value, row_index, tasks_for, unpivot_numeric, value_counts

AGG_FUNCS = {
    "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum,
    "count": F.count, "median": F.median,
}


def _keys_present(group) -> Column:
    cond = F.lit(True)
    for g in group:
        cond = cond & F.col(g).isNotNull()
    return cond


def _chunked(df: DataFrame, group, order, halo: int, chunk_rows: int):
    """Rows tagged with (_chunk, _halo); halo copies carry the previous chunk's tail.

    The rows are counted first: a large table is sorted, and then dealt by (group, chunk), in as
    many tasks as keep each within ``blocks.ROWS_PER_TASK``.
    """
    if halo > chunk_rows:
        raise ValueError("halo larger than chunk_rows")
    tasks = tasks_for(df, df.count())
    idx = row_index(df, order, group, name="_ri", num_partitions=tasks)
    chunk = F.floor(F.col("_ri") / chunk_rows).cast("long")
    tail = F.pmod(F.col("_ri"), F.lit(chunk_rows)) >= chunk_rows - halo
    ids = F.when(tail & F.lit(halo > 0), F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    out = idx.withColumn("_home", chunk).withColumn("_chunk", F.explode(ids))
    out = out.withColumn("_halo", F.col("_chunk") != F.col("_home")).drop("_home")
    return out.repartition(tasks, *group, "_chunk") if tasks > tasks_for(df, 0) else out


#: rows of a group that one task windows over
CHUNK_ROWS = 100_000


def add_history(df: DataFrame, target: str, group, order, lags=(1, 7, 30), windows=(7, 30),
                aggs=("mean", "std", "min", "max"), min_periods: int = 1,
                include_current: bool = True, chunk_rows: int | None = CHUNK_ROWS) -> DataFrame:
    """W1 + W2: ``{t}_lag_{n}`` and ``{t}_rolling_{w}_{agg}`` per group, by rows.

    Groups are cut into chunks of ``chunk_rows`` (at least the halo) rows, each
    with the rows before it that its windows reach; None windows whole groups.
    """
    group, order = list(group), list(order)
    lags, windows = list(lags or []), list(windows or [])
    halo = max([0] + lags + [w - 1 + (0 if include_current else 1) for w in windows])
    if chunk_rows:
        chunk_rows = max(chunk_rows, halo)
        base = _chunked(df, group, order, halo, chunk_rows)
        part, ordr = group + ["_chunk"], ["_ri"]
    else:
        base, part, ordr = df, group, order
    w = Window.partitionBy(*part).orderBy(*ordr) if part else Window.orderBy(*ordr)
    present = _keys_present(group)
    # pandas skips NaN in rolling statistics; Spark would propagate it
    if dict(base.dtypes).get(target) in ("double", "float"):
        base = base.withColumn(target, F.when(F.isnan(target), None).otherwise(F.col(target)))
    cols = []
    for n in lags:
        cols.append(F.when(present, F.lag(target, n).over(w)).alias(f"{target}_lag_{n}"))
    for size in windows:
        hi = 0 if include_current else -1
        frame = w.rowsBetween(-(size - 1) + hi, hi)
        cnt = F.count(target).over(frame)
        for a in aggs:
            val = AGG_FUNCS[a](target).over(frame)
            cols.append(F.when(present & (cnt >= min_periods), val).alias(f"{target}_rolling_{size}_{a}"))
    out = base.select("*", *cols)
    if chunk_rows:
        out = out.where(~F.col("_halo")).drop("_chunk", "_halo", "_ri")
    return out


def add_lags(df, target, group, order, lags=(1, 7, 30), chunk_rows=CHUNK_ROWS):
    return add_history(df, target, group, order, lags=lags, windows=(), chunk_rows=chunk_rows)


def add_rolling(df, target, group, order, windows=(7, 30), aggs=("mean", "std", "min", "max"),
                min_periods=1, include_current=True, chunk_rows=CHUNK_ROWS):
    return add_history(df, target, group, order, lags=(), windows=windows, aggs=aggs,
                       min_periods=min_periods, include_current=include_current,
                       chunk_rows=chunk_rows)


# W3 ---------------------------------------------------------------------------------------------
def moving_averages(daily: DataFrame, order: str, value: str, windows=(7, 30, 90),
                    full: bool = True) -> DataFrame:
    """Moving averages over an already-aggregated series (one row per period).

    The input is bounded by the number of calendar periods (days), not by the
    data volume, so one ordered window over it is cheap at any scale.
    """
    w = Window.orderBy(order)
    cols = []
    for n in windows:
        frame = w.rowsBetween(-(n - 1), 0)
        avg = F.avg(value).over(frame)
        if full:
            avg = F.when(F.count(F.lit(1)).over(frame) == n, avg)
        cols.append(avg.alias(f"ma_{n}"))
    return daily.select("*", *cols)


# W5 ---------------------------------------------------------------------------------------------
def hopping_windows(df: DataFrame, order, size: int, idx_col: str = "row_idx", by=()) -> DataFrame:
    """Assign rows to hopping row windows: ends range(size, n, size // 2), rows [end-size, end).

    Adds ``window_id`` (k) and ``window_end`` (exclusive end row index); each row
    appears in at most ceil(size / step) windows. Window ends equal to n are
    not produced (same as the reference loop). With ``by`` each group has windows of its own.
    """
    if size < 2:
        raise ValueError("window size must be >= 2 (step = size // 2 must be positive)")
    step = size // 2
    by = list(by)
    idx = row_index(df, order, by, name=idx_col) if idx_col not in df.columns else df
    n = idx.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    j = attach(idx, n, by)
    i = F.col(idx_col)
    k_lo = F.greatest(F.lit(0), F.floor((i - size) / step) + 1)
    k_hi = F.floor(i / step)
    k_max = F.floor((F.col("_n") - 1 - size) / step)  # last k with size + k*step <= n - 1
    ks = F.sequence(k_lo.cast("long"), F.least(k_hi, k_max).cast("long"))
    out = j.where(F.least(k_hi, k_max) >= k_lo).withColumn("window_id", F.explode(ks))
    return out.withColumn("window_end", F.lit(size) + F.col("window_id") * step).drop("_n")


# W6 ---------------------------------------------------------------------------------------------
def global_row_index(df: DataFrame, order, name: str = "row_idx") -> DataFrame:
    return row_index(df, order, name=name)


# W7 ---------------------------------------------------------------------------------------------
def rank_table(df: DataFrame, cols) -> DataFrame:
    """(column, value, rank): average-tie rank of every distinct value of each column."""
    cols = list(cols)
    long = unpivot_numeric(df, cols).where(F.col("value").isNotNull())
    counts = value_counts(long, ["column"], "value")
    pre = prefix_sums_by_value(counts, ["column"], "value", ["_n"])
    return pre.select("column", "value", (F.col("cum__n") - (F.col("_n") - 1) / 2.0).alias("rank"))


def average_ranks(df: DataFrame, cols, key_cols=None) -> DataFrame:
    """Average-tie ranks (1-based, pandas ``rank()``) of each column as ``{c}_rank``; NULL stays NULL.

    One value-count table for all columns -> one grouped prefix sum over the
    distinct values (skew-safe block) -> rank of a value = cum - (count - 1) / 2
    -> joined back per column on the value.
    """
    cols = list(cols)
    ranks = rank_table(df, cols)
    out = df
    for c in cols:
        r = ranks.where(F.col("column") == c).select(F.col("value").alias("_rk"), F.col("rank").alias(f"{c}_rank"))
        out = out.join(r, F.col(c).cast("double") == F.col("_rk"), "left").drop("_rk")
    return out


# W8 ---------------------------------------------------------------------------------------------
def latest_per_key(df: DataFrame, keys, order_desc, n: int = 1) -> DataFrame:
    """Keep the newest ``n`` rows per key.

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before the
    shuffle, so a hot key ships at most n rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_desc])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
