"""Shared physical building blocks.

* ``prefix_sums_by_value`` - running sums per group in the order of a numeric
  key (value-count tables): per-group approximate-quantile buckets, a window
  inside each (group, bucket), a carry-in from a groups x buckets table. JVM
  only, deterministic, no single-partition window.
* ``row_index`` - dense index in a composite order: range partitioning on the
  full key (a hot group is split), ``monotonically_increasing_id`` after a
  within-partition sort, checkpoint to fix the sampled bounds, carry-in from a
  (partition, group) table. JVM only.
* ``prefix_sums`` - general running sums in a composite order (range partition
  + per-partition running sums in Arrow batches + carry-in).
* ``value_counts`` / ``exact_quantiles`` / ``quantiles_from_counts`` -
  linear-interpolated quantiles (pandas / DuckDB ``quantile_cont`` / Spark
  ``percentile``) from a materialised value-count table; no task ever holds a
  whole group's distinct values.
* ``pair_moments`` - one pass of shifted sums for n, means and covariances of
  column pairs (pairwise complete), the input of correlation, variance and
  regression statistics.
* ``attach`` / ``maybe_broadcast`` - one-row statistics as scalar subqueries,
  broadcasts only below a proven row bound.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.session import checkpoint_dir

_PID = "_sf_pid"
# Largest side (cells: rows x columns, arrays counted by their longest) that gets a
# broadcast hint: about 32 MB of numbers. Larger sides are joined as Spark plans them,
# with the same result.
MAX_BROADCAST_CELLS = 2_000_000


def maybe_broadcast(df: DataFrame, rows_upper_bound: int) -> DataFrame:
    """Broadcast hint only when the caller has proven the row bound; else leave it to AQE."""
    return F.broadcast(df) if rows_upper_bound * len(df.columns) <= MAX_BROADCAST_CELLS else df


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the key columns come out once, from the left."""
    keys = list(keys)
    r = right.withColumnsRenamed({k: f"_sf_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_sf_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_sf_r_{k}" for k in keys])


def group_count(df: DataFrame, group_cols) -> int:
    """Number of groups, counted on an (already materialised) reduced table."""
    return df.select(*group_cols).distinct().count() if group_cols else 1


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


#: rows that one task sorts: a larger table gets more tasks than ``spark.sql.shuffle.partitions``
ROWS_PER_TASK = 500_000


def tasks_for(df: DataFrame, rows: int) -> int:
    """Tasks for ``rows`` rows: the configured number, or as many as keep a task within ``ROWS_PER_TASK``."""
    return max(_num_partitions(df, None), -(-rows // ROWS_PER_TASK))


def _local_running_sums(group_cols, value_cols, out_cols):
    """Per-partition running sums of value_cols within contiguous groups."""

    def run(batches):
        carry_key = None
        carry = None
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(**{o: pd.Series([], dtype="float64") for o in out_cols})
                continue
            vals = pdf[list(value_cols)].astype("float64").fillna(0.0)
            if group_cols:
                keys = pdf[list(group_cols)]
                cs = vals.groupby([keys[g] for g in group_cols], sort=False, dropna=False).cumsum()
                first = tuple(keys.iloc[0].tolist())
                if carry_key is not None and _same_key(first, carry_key):
                    same = np.ones(len(pdf), dtype=bool)
                    for g, v in zip(group_cols, first):
                        col = keys[g]
                        same &= (col.isna().to_numpy() if _isnull(v) else (col == v).to_numpy())
                    cs.loc[same] = cs.loc[same] + carry
                last = tuple(keys.iloc[-1].tolist())
            else:
                cs = vals.cumsum()
                if carry is not None:
                    cs = cs + carry
                last = ()
            carry_key = last
            carry = cs.iloc[-1].to_numpy()
            out = pdf.copy()
            for v, o in zip(value_cols, out_cols):
                out[o] = cs[v].to_numpy()
            yield out

    return run


def _isnull(v) -> bool:
    return v is None or (isinstance(v, float) and np.isnan(v))


def _same_key(a, b) -> bool:
    return all((_isnull(x) and _isnull(y)) or x == y for x, y in zip(a, b))


def prefix_sums(df: DataFrame, group_cols, order_cols, value_cols, prefix: str = "cum_",
                num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums ``prefix+v`` of ``value_cols`` per group, in ``order_cols`` order.

    The order must be total within a group (add a unique tie-break) for a
    deterministic result.
    """
    group_cols, order_cols, value_cols = list(group_cols), list(order_cols), list(value_cols)
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = _num_partitions(df, num_partitions)
    out_cols = [f"{prefix}{v}" for v in value_cols]
    keys = group_cols + order_cols
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn(_PID, F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField(o, T.DoubleType()) for o in out_cols])
    local = ranged.mapInPandas(_local_running_sums(group_cols, value_cols, out_cols), schema)
    # fix the sampled range bounds: everything below reads one materialised copy
    local = local.checkpoint(eager=True)
    totals = local.groupBy(_PID, *group_cols).agg(
        *[F.sum(F.coalesce(F.col(v).cast("double"), F.lit(0.0))).alias(f"_t_{v}") for v in value_cols])
    w = (Window.partitionBy(*group_cols).orderBy(_PID)
         .rowsBetween(Window.unboundedPreceding, -1)) if group_cols else (
        Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        F.col(_PID).alias("_o_pid"), *[F.col(g).alias(f"_o_{g}") for g in group_cols],
        *[F.coalesce(F.sum(f"_t_{v}").over(w), F.lit(0.0)).alias(f"_off_{v}") for v in value_cols])
    cond = [local[_PID] == offsets["_o_pid"]] + [
        local[g].eqNullSafe(offsets[f"_o_{g}"]) for g in group_cols]
    joined = local.join(offsets, cond, "left")
    out = joined.select(
        *[local[c] for c in df.columns],
        *[(local[o] + F.coalesce(offsets[f"_off_{v}"], F.lit(0.0))).alias(o)
          for v, o in zip(value_cols, out_cols)])
    return out


def bucket_index(value, bounds, size: int, inclusive: bool = False):
    """Number of elements of the sorted array ``bounds`` (at most ``size`` long) that are < (``inclusive``: <=) ``value``.

    A binary search written as nested CASE expressions: each row evaluates
    log2(size) comparisons, whatever the number of buckets (a higher-order
    ``filter`` over the array would cost ``size`` comparisons per row).
    Positions past the end of a shorter array read NULL and count as +inf.
    """
    v = F.col(value) if isinstance(value, str) else value
    b = F.col(bounds) if isinstance(bounds, str) else bounds

    def search(lo: int, hi: int):
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        bound = F.try_element_at(b, F.lit(mid + 1))
        return F.when(bound <= v if inclusive else bound < v, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, size)


def prefix_sums_by_value(df: DataFrame, group_cols, value_col: str, sum_cols, prefix: str = "cum_",
                         buckets: int | None = None, n_groups: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` per group in ascending ``value_col`` order.

    For a numeric order key that is unique within a group (a value-count
    table). Deterministic and JVM-only: per-group approximate-quantile
    boundaries cut each group into ``buckets`` ranges of similar size, a
    window runs inside each (group, bucket), and a carry-in from the bucket
    totals (at most groups x buckets rows, broadcast) finishes the sum. A group
    with billions of distinct values is therefore spread over many tasks: as many
    as keep each within ``ROWS_PER_TASK``. ``df`` is read several times: materialise it.
    """
    group_cols, sum_cols = list(group_cols), list(sum_cols)
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_rows"))
    groups, rows, most = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0))).first()
    n = buckets or tasks_for(df, most)
    probs = [i / n for i in range(1, n)]
    v = F.col(value_col).cast("double")
    # boundaries only balance the buckets; their precision does not affect the result. They are put in
    # order here, once for each group: after the join it would be done for every row
    bounds = df.groupBy(*group_cols).agg(F.array_sort(F.array_distinct(F.percentile_approx(v, probs, max(1000, 4 * n)))).alias("_bounds"))
    ng = n_groups if n_groups is not None else groups
    # bounds: one row per group (n - 1 numbers each); offsets: groups x buckets rows
    j = null_safe_join(df, maybe_broadcast(bounds, ng * n), group_cols) if group_cols else \
        attach(df, bounds)
    j = j.withColumn("_bkt", bucket_index(v, "_bounds", len(probs))).drop("_bounds")
    tasks = tasks_for(df, rows)
    if tasks > _num_partitions(df, None):
        j = j.repartition(tasks, *group_cols, "_bkt")  # as the window below needs them
    w = Window.partitionBy(*group_cols, "_bkt").orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)
    local = j.select("*", *[F.sum(c).over(w).alias(f"_l_{c}") for c in sum_cols])
    tot = j.groupBy(*group_cols, "_bkt").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    wo = (Window.partitionBy(*group_cols).orderBy("_bkt") if group_cols else Window.orderBy("_bkt")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*group_cols, "_bkt", *[F.coalesce(F.sum(f"_t_{c}").over(wo), F.lit(0)).alias(f"_o_{c}")
                                            for c in sum_cols])
    out = null_safe_join(local, maybe_broadcast(off, ng * n), group_cols + ["_bkt"])
    return out.select(*df.columns, *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).cast("double").alias(f"{prefix}{c}")
                                     for c in sum_cols])


def attach(df: DataFrame, stats: DataFrame, by=(), width: int = 1) -> DataFrame:
    """Join per-group statistics back onto rows (a NULL group keeps its own statistics).

    With keys ``stats`` is materialised in the shared folder, so its rows can be
    counted (``width``: longest array in it): a table of a few groups is broadcast
    and the rows are not shuffled by a key of few values; a large one is joined as
    Spark plans it. Without keys ``stats`` is a global aggregate with exactly one
    row: it becomes a scalar subquery (run once, then a literal) - no join.
    """
    by = list(by)
    if by:
        checkpoint_dir(df.sparkSession)
        stats = stats.checkpoint(eager=True)
        return null_safe_join(df, maybe_broadcast(stats, stats.count() * width), by)
    cols = stats.columns
    s = stats.select(F.struct(*[F.col(c) for c in cols]).alias("_sf_s")).scalar()
    return df.withColumn("_sf_s", s).select(
        *[F.col(c) for c in df.columns], *[F.col("_sf_s").getField(c).alias(c) for c in cols])


def row_index(df: DataFrame, order_cols, group_cols=(), name: str = "row_idx",
              num_partitions: int | None = None) -> DataFrame:
    """0-based dense index in ``order_cols`` order (within ``group_cols`` if given). JVM only.

    Range-partition on (group, order) - a hot group is split across tasks -
    and sort within partitions; ``monotonically_increasing_id`` then encodes
    (partition, position). The partitioned copy is checkpointed so the sampled
    range bounds (and thus the ids) are fixed. A table with one row per
    (partition, group) gives each group's carry-in count and first position.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    checkpoint_dir(df.sparkSession)
    n = _num_partitions(df, num_partitions)
    keys = group_cols + order_cols
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_sf_mid", F.monotonically_increasing_id())).checkpoint(eager=True)
    pid = F.shiftright(F.col("_sf_mid"), 33)
    r = ranged.withColumn(_PID, pid).withColumn("_sf_pos", F.col("_sf_mid") - F.shiftleft(pid, 33))
    stats = r.groupBy(_PID, *group_cols).agg(F.min("_sf_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()).orderBy(_PID) \
        .rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(F.col(_PID).alias("_s_pid"), *[F.col(g).alias(f"_s_{g}") for g in group_cols],
                         "_first", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    # at most (partitions + groups) rows; counted before deciding on a broadcast
    stats = maybe_broadcast(stats, stats.count()) if group_cols else F.broadcast(stats)
    cond = [F.col(_PID) == F.col("_s_pid")] + [F.col(g).eqNullSafe(F.col(f"_s_{g}")) for g in group_cols]
    j = r.join(stats, cond, "inner")
    idx = (F.col("_off") + F.col("_sf_pos") - F.col("_first")).cast("long")
    return j.select(*[F.col(c) for c in df.columns], idx.alias(name))


#: rows that are ordered in one task to find a row of a given rank; above that the range is narrowed first
MAX_ORDERED_ROWS = 100_000


def row_at_rank(df: DataFrame, order_cols, rank: int, n: int, sample: int = 20_000):
    """The order columns' values of the row with 0-based ``rank`` among ``n`` rows, without sorting them.

    A small sample of the order columns gives a bracket around the rank, one aggregation counts the
    rows below and inside it, and only those inside are looked at again, until they are few enough to be
    ordered in one task: about 20 000-fold fewer rows with every round. A bracket that misses the rank is put right by
    its counts. Nothing is shuffled but sampled values and the last few rows.
    """
    cols = list(order_cols)
    key = F.struct(*[F.col(c) for c in cols])
    rows = df.select(*cols)
    below = 0  # rows before all those in ``rows``
    while n > MAX_ORDERED_ROWS:
        at = (rank - below) / n
        drawn = rows.sample(min(1.0, 1.2 * sample / n), seed=n % 1_000_003).select(*cols).orderBy(*cols).limit(2 * sample).collect()
        margin = max(3.0 * (len(drawn) * at * (1 - at)) ** 0.5, 3.0)
        low, high = int(at * len(drawn) - margin), int(at * len(drawn) + margin) + 1
        low_key = _literal_key(rows, cols, drawn[low]) if 0 <= low < len(drawn) else None
        high_key = _literal_key(rows, cols, drawn[high]) if 0 <= high < len(drawn) else None
        before = (key < low_key) if low_key is not None else F.lit(False)
        after = (key > high_key) if high_key is not None else F.lit(False)
        n_before, n_after = rows.agg(F.count_if(before), F.count_if(after)).first()
        if below + n_before > rank:
            kept, left, skip = rows.where(before), n_before, 0
        elif below + n - n_after <= rank:
            kept, left, skip = rows.where(after), n_after, n - n_after
        else:
            kept, left, skip = rows.where(~before & ~after), n - n_before - n_after, n_before
        if left == n:
            # nothing falls off: all rows between the ends of the bracket are alike, or nearly so
            ends = rows.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
            if ends["low"] == ends["high"]:
                return ends["low"]
            first = rows.where(key == _literal_key(rows, cols, ends["low"])).count()
            if below + first > rank:
                return ends["low"]
            kept, left, skip = rows.where(key > _literal_key(rows, cols, ends["low"])), n - first, first
        rows, n, below = kept, left, below + skip
    return rows.orderBy(*cols).offset(rank - below).limit(1).first()


def _literal_key(df: DataFrame, cols, row):
    """The struct of a collected row's values as a typed literal."""
    return F.struct(*[F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in cols])


def label_from_rank(df: DataFrame, order_cols, rank: int, n: int, name: str, before: str, after: str) -> DataFrame:
    """Adds ``name``: ``before`` for the first ``rank`` rows in the order, ``after`` for the others.

    Rows are compared with the one at that rank, a literal. Rows alike in all order columns are told
    apart by a hash of the whole row, and numbered where the rank falls between them: those rows alone are ordered.
    """
    cols = list(order_cols)
    if rank <= 0 or rank >= n:
        return df.withColumn(name, F.lit(after if rank <= 0 else before))
    cut = row_at_rank(df, cols, rank, n)
    key, at = F.struct(*[F.col(c) for c in cols]), _literal_key(df, cols, cut)
    n_before, n_same = df.select(*cols).agg(F.count_if(key < at), F.count_if(key == at)).first()
    out = df.withColumn(name, F.when(key < at, F.lit(before)).otherwise(F.lit(after)))
    if n_before == rank:
        return out
    same = row_index(df.where(key == at).withColumn("_sf_tie", F.xxhash64(*df.columns)), ["_sf_tie"], name="_sf_idx")
    same = same.withColumn(name, F.when(F.col("_sf_idx") < F.lit(rank - n_before), F.lit(before)).otherwise(F.lit(after)))
    return out.where(key != at).unionByName(same.drop("_sf_tie", "_sf_idx"))


def value_counts(df: DataFrame, group_cols, value_col: str, count_cols=None, drop_nulls: bool = True) -> DataFrame:
    """(group..., value, counts) with NULL values dropped, materialised once.

    The reduced table feeds several branches (bucket bounds, prefix sums,
    totals); a reliable checkpoint in the shared folder computes it once and
    cuts the lineage (it survives executor loss, unlike a local checkpoint).
    ``count_cols`` maps output name -> condition for conditional counts.
    """
    checkpoint_dir(df.sparkSession)
    aggs = ([F.count_if(cond).alias(name) for name, cond in count_cols.items()] if count_cols
            else [F.count(F.lit(1)).alias("_n")])
    src = df.where(F.col(value_col).isNotNull()) if drop_nulls else df
    counts = src.groupBy(*group_cols, value_col).agg(*aggs)
    return counts.checkpoint(eager=True)


def exact_quantiles(df: DataFrame, group_cols, value_col: str, probs,
                    num_partitions: int | None = None, method: str = "bracket") -> DataFrame:
    """Rows (group..., p, q): quantile_cont of ``value_col`` per group (NULLs ignored).

    ``bracket`` (default) never shuffles the full set of distinct values (see
    ``bracket_quantiles``); ``counts`` sorts the whole value-count table.
    """
    if method == "bracket":
        return bracket_quantiles(df, group_cols, value_col, probs, num_partitions=num_partitions)
    counts = value_counts(df, list(group_cols), value_col)
    return quantiles_from_counts(counts, group_cols, value_col, probs, "_n", num_partitions)


BRACKET_ACCURACY = 10_000


def bracket_quantiles(df: DataFrame, group_cols, value_col: str, probs, accuracy: int = BRACKET_ACCURACY,
                      num_partitions: int | None = None, spread: float = 3.0) -> DataFrame:
    """Exact linear-interpolated quantiles by bracket-and-select.

    Pass 1 (one aggregate): per group n, min, max and approximate quantiles
    (GK sketch, rank error <= n / accuracy) just below and above each target
    -> a bracket [L, U] for each p. Pass 2 (one aggregate): every row stays one
    row; it gets its place between the sorted bracket ends of its group, and keeps
    its value only inside a bracket (about 6 n / accuracy rows for each p), so the
    count table has one row for each gap and for each value in a bracket. The
    running count over that table gives the values at the target ranks. A rank
    that falls into a gap (the sketch's bound excludes it) is tried again with
    brackets ten times wider, which end as the whole range.
    """
    g = list(group_cols)
    spark = df.sparkSession
    checkpoint_dir(spark)
    probs = [float(p) for p in probs]
    eps = spread / accuracy
    lows = [max(0.0, p - eps) for p in probs]
    highs = [min(1.0, p + eps) for p in probs]
    grid = sorted(set(lows + highs))
    v = F.col(value_col).cast("double")
    base = df.select(*g, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    s1 = base.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
                              F.percentile_approx("_v", grid, accuracy).alias("_aq"))
    lower = [F.col("_min") if q == 0.0 else F.col("_aq")[grid.index(q)] for q in lows]
    upper = [F.col("_max") if q == 1.0 else F.col("_aq")[grid.index(q)] for q in highs]
    s1 = s1.where("_n > 0").select(
        *g, "_n", F.array(*[F.struct(a.alias("L"), b.alias("U")) for a, b in zip(lower, upper)]).alias("_br"),
        F.array_sort(F.array_distinct(F.array(*lower, *upper))).alias("_ends"))
    s1 = s1.checkpoint(eager=True)  # one row for each group, read three times below
    ng = s1.count()
    # a value between two ends that follow each other is inside a bracket if one spans both: told once for each group
    spans = F.transform("_ends", lambda e, i: F.exists("_br", lambda x: (x["L"] <= F.get("_ends", i - 1)) & (e <= x["U"])))
    ends = s1.select(*g, "_ends", spans.alias("_spans"))
    j = null_safe_join(base, maybe_broadcast(ends, ng * 4 * len(probs)), g) if g else attach(base, ends)
    place = bucket_index("_v", "_ends", 2 * len(probs))
    above = F.try_element_at("_ends", F.col("_at") + 1)
    inside = F.coalesce((above == F.col("_v")) | F.try_element_at("_spans", F.col("_at") + 1), F.lit(False))
    # a gap stands between two bracket ends: any number between them keeps the order
    below = F.try_element_at("_ends", F.col("_at"))
    step = lambda x: F.greatest(F.lit(1.0), F.abs(x) / 1e9)
    gap = F.when(F.col("_at") == 0, above - step(above)).otherwise(F.coalesce(below / 2 + above / 2, below + step(below)))
    band = (j.withColumn("_at", place.cast("int")).withColumn("_in", inside)
            .select(*g, "_in", F.when(F.col("_in"), F.col("_v")).otherwise(gap).alias("_bv"))
            .groupBy(*g, "_in", "_bv").agg(F.count(F.lit(1)).alias("_c")))
    band = band.checkpoint(eager=True)  # small: a row for each gap and for each value in a bracket
    pre = prefix_sums_by_value(band, g, "_bv", ["_c"], buckets=num_partitions, n_groups=ng)
    targets = (s1.select(*g, "_n", F.explode(F.array(*[F.lit(p) for p in probs])).alias("p"))
               .withColumn("_pos", (F.col("_n") - 1) * F.col("p"))
               .withColumn("_lo", F.floor("_pos").cast("long")).withColumn("_hi", F.ceil("_pos").cast("long")))
    ranks = targets.select(*[F.col(x).alias(f"_k_{x}") for x in g], "p", "_pos", "_lo", "_hi",
                           F.explode(F.array("_lo", "_hi")).alias("_r")).distinct()
    ranks = maybe_broadcast(ranks, ng * len(probs) * 2)
    cond = [F.col(x).eqNullSafe(F.col(f"_k_{x}")) for x in g] + [
        F.col("cum__c") - F.col("_c") <= F.col("_r"), F.col("_r") < F.col("cum__c")]
    hit = pre.join(ranks, cond).select(*[F.col(f"_k_{x}").alias(x) for x in g], "p", "_pos", "_lo", "_hi", "_r",
                                       "_in", F.col("_bv").alias("_v"))
    res = hit.groupBy(*g, "p", "_pos", "_lo", "_hi").agg(
        F.bool_and("_in").alias("_ok"), F.max(F.when(F.col("_r") == F.col("_lo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_r") == F.col("_hi"), F.col("_v"))).alias("_vhi"))
    res = res.checkpoint(eager=True)  # groups x probs rows
    if res.where(~F.col("_ok")).head(1):
        return bracket_quantiles(df, group_cols, value_col, probs, accuracy, num_partitions, spread * 10)
    q = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_pos") - F.col("_lo"))
    return res.select(*g, "p", F.when(F.col("_lo") == F.col("_hi"), F.col("_vlo")).otherwise(q).alias("q"))


def quantiles_from_counts(counts: DataFrame, group_cols, value_col: str, probs, count_col: str = "_n",
                          num_partitions: int | None = None, n_groups: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles from a (group..., value, count) table.

    The value at 0-based rank r is the value whose cumulative count interval
    [cum - count, cum) contains r; q = v(floor(pos)) + frac * (v(ceil(pos)) - v(floor(pos))),
    pos = (n - 1) p. Rows with a zero count are ignored.
    """
    group_cols = list(group_cols)
    counts = counts.where((F.col(count_col) > 0) & F.col(value_col).isNotNull()).select(
        *group_cols, value_col, F.col(count_col).alias("_n"))
    if not group_cols:
        return _global_quantiles(counts, value_col, probs, num_partitions)
    # the caller may know the group count (e.g. one group per unpivoted column)
    ng = n_groups if n_groups is not None else group_count(counts, group_cols)
    pre = prefix_sums_by_value(counts, group_cols, value_col, ["_n"], buckets=num_partitions, n_groups=ng)
    totals = counts.groupBy(*group_cols).agg(F.sum("_n").alias("_total"))
    targets = (totals.select(*group_cols, "_total",
                             F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
               .withColumn("_pos", (F.col("_total") - 1) * F.col("p"))
               .withColumn("_lo", F.floor("_pos").cast("long"))
               .withColumn("_hi", F.ceil("_pos").cast("long")))
    ranks = targets.select(*[F.col(g).alias(f"_k_{g}") for g in group_cols], "p", "_pos", "_lo", "_hi",
                           F.explode(F.array(F.col("_lo"), F.col("_hi"))).alias("_r")).distinct()
    # the target list has at most groups x 2 x len(probs) rows
    ranks = maybe_broadcast(ranks, ng * 2 * len(list(probs)))
    cond = [F.col(g).eqNullSafe(F.col(f"_k_{g}")) for g in group_cols] + [
        (F.col("cum__n") - F.col("_n") <= F.col("_r")), (F.col("_r") < F.col("cum__n"))]
    hit = pre.join(ranks, cond).select(
        *[F.col(f"_k_{g}").alias(g) for g in group_cols], "p", "_pos", "_lo", "_hi",
        "_r", F.col(value_col).cast("double").alias("_v"))
    res = hit.groupBy(*group_cols, "p", "_pos", "_lo", "_hi").agg(
        F.max(F.when(F.col("_r") == F.col("_lo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_r") == F.col("_hi"), F.col("_v"))).alias("_vhi"))
    q = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_pos") - F.col("_lo"))
    return res.select(*group_cols, "p", F.when(F.col("_lo") == F.col("_hi"), F.col("_vlo"))
                      .otherwise(q).alias("q"))


def _global_quantiles(counts: DataFrame, value_col: str, probs, num_partitions=None) -> DataFrame:
    """No groups: the total is one number, so the target ranks are literals and the
    rank lookup is a filter + one aggregate (no join)."""
    import math
    total = counts.agg(F.sum("_n")).collect()[0][0] or 0
    spark = counts.sparkSession
    if total == 0:
        return spark.createDataFrame([(float(p), None) for p in probs], "p double, q double")
    pre = prefix_sums_by_value(counts, [], value_col, ["_n"], buckets=num_partitions)
    plan = []
    for p in probs:
        pos = (total - 1) * float(p)
        plan.append((float(p), pos, math.floor(pos), math.ceil(pos)))
    ranks = sorted({r for _, _, lo, hi in plan for r in (lo, hi)})
    lo_edge = F.col("cum__n") - F.col("_n")

    def holds(r):
        return (lo_edge <= F.lit(r)) & (F.lit(r) < F.col("cum__n"))

    any_rank = F.lit(False)
    for r in ranks:
        any_rank = any_rank | holds(r)
    v = F.col(value_col).cast("double")
    row = pre.where(any_rank).agg(*[F.max(F.when(holds(r), v)).alias(f"r{r}") for r in ranks])
    items = []
    for p, pos, lo, hi in plan:
        vlo, vhi = F.col(f"r{lo}"), F.col(f"r{hi}")
        q = vlo if lo == hi else vlo + (vhi - vlo) * F.lit(pos - lo)
        items.append(F.struct(F.lit(p).alias("p"), q.alias("q")))
    return row.select(F.inline(F.array(*items)))


def quantile_columns(df: DataFrame, cols, probs, names=None) -> DataFrame:
    """One row per column: (column, q_<name>...) using ``exact_quantiles`` on the unpivoted frame."""
    long = unpivot_numeric(df, cols)
    qs = exact_quantiles(long, ["column"], "value", probs)
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    aggs = [F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(nm) for p, nm in zip(probs, names)]
    return qs.groupBy("column").agg(*aggs)


def unpivot_numeric(df: DataFrame, cols, name: str = "column", value: str = "value", by=()) -> DataFrame:
    """Long (by..., column, value double) form of numeric columns, NaN normalised to NULL."""
    cols, by = list(cols), list(by)
    casted = df.select(*by, *[F.when(F.isnan(F.col(c).cast("double")), None)
                              .otherwise(F.col(c).cast("double")).alias(c) for c in cols])
    return casted.unpivot(by, cols, name, value)


def pair_moments(df: DataFrame, cols, pairs=None) -> DataFrame:
    """Long frame (a, b, n, mean_a, mean_b, cov, var_a, var_b), population moments.

    Pass 1 (d counts and means, collected: 2d scalars) gives each column's
    shift. Pass 2 is one aggregation of plain sums of shifted values, so no
    sum-of-squares cancellation and the aggregate stays in generated code.
    Columns without NULLs share their sums across pairs; a pair with a column
    that has NULLs uses sums masked to rows where both are present (pandas
    pairwise-complete).
    """
    cols = list(cols)
    if pairs is None:
        pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    used = sorted({c for p in pairs for c in p}, key=lambda c: cols.index(c) if c in cols else 0)
    x = {c: F.when(F.isnan(F.col(c).cast("double")), None).otherwise(F.col(c).cast("double")) for c in used}
    first = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(x[c]).alias(f"n_{c}") for c in used],
                   *[F.avg(x[c]).alias(f"m_{c}") for c in used]).collect()[0]
    total = first["_n"]
    complete = {c: first[f"n_{c}"] == total for c in used}
    mu = {c: first[f"m_{c}"] if first[f"m_{c}"] is not None else 0.0 for c in used}
    d = {c: x[c] - F.lit(mu[c]) for c in used}
    exprs, names = {}, {}

    def add(key, expr):
        if key not in exprs:
            names[key] = f"s{len(exprs)}"
            exprs[key] = expr.alias(names[key])
        return names[key]

    spec = []
    for a, b in pairs:
        if complete[a] and complete[b]:
            n = F.lit(total)
            ka, kb = add(("s", a), F.sum(d[a])), add(("s", b), F.sum(d[b]))
            kaa, kbb = add(("ss", a), F.sum(d[a] * d[a])), add(("ss", b), F.sum(d[b] * d[b]))
            kab = add(("x", a, b), F.sum(d[a] * d[b]))
            spec.append((a, b, None, ka, kb, kaa, kbb, kab))
        else:
            both = x[a].isNotNull() & x[b].isNotNull()
            kn = add(("n", a, b), F.count(F.when(both, 1)))
            ka = add(("ms", a, b), F.sum(F.when(both, d[a])))
            kb = add(("ms", b, a), F.sum(F.when(both, d[b])))
            kaa = add(("mss", a, b), F.sum(F.when(both, d[a] * d[a])))
            kbb = add(("mss", b, a), F.sum(F.when(both, d[b] * d[b])))
            kab = add(("x", a, b), F.sum(F.when(both, d[a] * d[b])))
            spec.append((a, b, kn, ka, kb, kaa, kbb, kab))
    row = df.agg(*exprs.values())
    structs = []
    for a, b, kn, ka, kb, kaa, kbb, kab in spec:
        n = F.col(kn) if kn else F.lit(total).cast("long")
        ma, mb = F.col(ka) / n, F.col(kb) / n
        structs.append(F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"), n.alias("n"),
            (F.lit(mu[a]) + ma).alias("mean_a"), (F.lit(mu[b]) + mb).alias("mean_b"),
            (F.col(kab) / n - ma * mb).alias("cov"), (F.col(kaa) / n - ma * ma).alias("var_a"),
            (F.col(kbb) / n - mb * mb).alias("var_b")))
    return row.select(F.inline(F.array(*structs)))


def pearson(cov, var_a, var_b):
    """ANSI-safe correlation from population moments (NULL when a side is constant)."""
    den = F.sqrt(F.col(var_a) * F.col(var_b)) if isinstance(var_a, str) else F.sqrt(var_a * var_b)
    num = F.col(cov) if isinstance(cov, str) else cov
    return F.when(den > 0, num / den)


def moments_matrix(df: DataFrame, cols) -> dict:
    """Driver-side d x d covariance / means (a fit step: O(d^2) scalars)."""
    rows = pair_moments(df, cols).collect()
    return {(r["a"], r["b"]): r.asDict() for r in rows}
