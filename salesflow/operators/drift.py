"""Drift statistics (D1-D7): two-sample KS, p-value, PSI, bands, reports.

Both tests reduce the data to value counts per (group, feature, value) with
map-side combining, then work on that reduced table. The ECDFs for KS come
from the range-partitioned prefix-sum block, so a feature with billions of
distinct values is still spread over many tasks.
Large monitoring runs count cells of values instead (``period_cells``) and look
only into the cells that can decide KS or a decile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.operators.blocks import (attach, bucket_index, exact_quantiles, maybe_broadcast, null_safe_join, prefix_sums_by_value,
                                       quantiles_from_counts, row_index, value_counts)
from salesflow.session import checkpoint_dir

REF, CUR = "reference", "current"
PSI_EPS = 1e-10
# PSI bands (stable < 0.1 <= moderate <= 0.2 < significant) and the
# default KS p-value threshold.
PSI_MODERATE, PSI_SIGNIFICANT = 0.1, 0.2
DEFAULT_THRESHOLD = 0.05
#: values (rows x features) up to which a monitoring run counts every distinct one
COUNTED_VALUES = 5_000_000


def _long(df: DataFrame, features, period: str, by=()) -> DataFrame:
    by = list(by)
    cast = df.select(*by, period, *[F.when(F.isnan(F.col(c).cast("double")), None)
                                    .otherwise(F.col(c).cast("double")).alias(c) for c in features])
    long = cast.unpivot(by + [period], list(features), "feature", "value")
    return long.where(F.col("value").isNotNull())


def period_counts(df: DataFrame, features, period: str = "period", by=()) -> DataFrame:
    """(by..., feature, value, c_ref, c_cur), materialised once; KS and PSI both read it."""
    g = list(by) + ["feature"]
    long = _long(df, features, period, by)
    return value_counts(long, g, "value", {"c_ref": F.col(period) == REF, "c_cur": F.col(period) == CUR})


def ks_from_counts(counts: DataFrame, by=(), num_partitions=None, n_features: int | None = None) -> DataFrame:
    g = list(by) + ["feature"]
    ng = n_features if (n_features is not None and not by) else None
    pre = prefix_sums_by_value(counts, g, "value", ["c_ref", "c_cur"], buckets=num_partitions, n_groups=ng)
    totals = counts.groupBy(*g).agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
    j = attach(pre, totals, g)
    gap = F.abs(F.col("cum_c_ref") / F.col("n_ref") - F.col("cum_c_cur") / F.col("n_cur"))
    return j.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0)).groupBy(*g, "n_ref", "n_cur").agg(
        F.max(gap).alias("ks_statistic"))


def ks_statistics(df: DataFrame, features, period: str = "period", by=(), num_partitions=None,
                  method: str = "counts") -> DataFrame:
    """(by..., feature, n_ref, n_cur, ks_statistic) - sup |F_ref - F_cur| over all observed values.

    ``counts``: one materialised value-count table + bucketed prefix sums (all
    distinct values are sorted, distributed). ``pruned``: counts of
    cells of values in rounds, only cells that can hold the supremum are swept - few
    rows shuffled for huge continuous features, more passes.
    """
    if method == "pruned":
        return ks_pruned(df, features, period, by)
    return ks_from_counts(period_counts(df, features, period, by), by, num_partitions, len(list(features)))


#: cells of a group in a round (fewer where there are many groups), and of all groups together
KS_BUCKETS, KS_CELLS = 16_384, 2_000_000
#: values that are ordered at the end; while more could matter, their cells are divided again
SWEPT_VALUES = 1_000_000
#: rounds after which what is left is ordered, whatever its size
KS_ROUNDS = 6

_ENDS = ("_min", "_max", "_low", "_high", "_n")
_GROUP = ("_g", "n_ref", "n_cur")


@dataclass(frozen=True)
class PeriodCells:
    """Counts of both periods in cells of values, and the rows to divide cells further.

    ``groups``: (by..., feature, _g, n_ref, n_cur), a row for each group with rows in both periods. ``rows``: (_cell, value, _r, _c),
    ``_cell`` being the group's number. ``first``: the cells of the first round, ``inside`` the rows in them.
    """

    groups: DataFrame
    n_groups: int
    rows: DataFrame
    first: DataFrame
    inside: DataFrame
    buckets: int


def _by_magnitude(x: Column) -> Column:
    """Keeps the order of values and spreads those of many magnitudes."""
    return F.signum(x) * F.log1p(F.abs(x))


def _ends() -> list[Column]:
    finite = F.when(F.abs("value") < float("inf"), F.col("value"))
    return [F.min("value").alias("_min"), F.max("value").alias("_max"), F.min(finite).alias("_low"), F.max(finite).alias("_high"),
            F.count(F.lit(1)).alias("_n")]


def _divide(rows: DataFrame, open_: DataFrame, n_open: int, n_groups: int, buckets: int, scale=lambda x: x):
    """A round: the rows of the open cells in finer ones (numbered in the order of groups and values), and those cells' counts.

    A cell's finite range is divided evenly on ``scale``, in more cells the more rows it has. Rounding moves ends, not the order: of two
    values in a cell the larger one is in the same finer cell or a later one.
    """
    low, high = scale(F.col("_low")), scale(F.col("_high"))
    share = F.col("_n") / F.sum("_n").over(Window.partitionBy("_g"))
    opened = open_.withColumn("_width", (F.ceil(share * max(2, min(buckets, KS_CELLS // max(1, n_groups)))) + 1).cast("long")).select(
        F.col("_cell").alias("_up"), low.alias("_low"), F.when(high > low, F.col("_width") / (high - low)).otherwise(float("inf")).alias("_scale"), "_width",
        # one task, of a row for each open cell
        (F.sum("_width").over(Window.orderBy("_cell")) - F.col("_width")).alias("_base"), "_r0", "_c0", *_GROUP).checkpoint(eager=True)
    place = opened.select(F.col("_up").alias("_cell"), "_low", "_scale", "_width", "_base")
    x = scale(F.col("value"))
    at = F.when(x <= F.col("_low"), 0.0).otherwise(F.least((x - F.col("_low")) * F.col("_scale"), F.col("_width") - 1.0))
    rows = rows.join(maybe_broadcast(place, n_open), "_cell").select(
        F.col("_cell").alias("_up"), (F.col("_base") + F.coalesce(at, F.lit(0.0)).cast("long")).alias("_cell"), "value", "_r", "_c")
    counts = rows.groupBy("_up", "_cell").agg(F.sum("_r").alias("_dr"), F.sum("_c").alias("_dc"), *_ends())
    w = Window.partitionBy("_up").orderBy("_cell")  # the cells of one opened cell
    cells = (counts.join(maybe_broadcast(opened.select("_up", "_r0", "_c0", *_GROUP), n_open), "_up")
             .withColumn("_re", F.col("_r0") + F.sum("_dr").over(w)).withColumn("_ce", F.col("_c0") + F.sum("_dc").over(w))
             .withColumn("_r0", F.col("_re") - F.col("_dr")).withColumn("_c0", F.col("_ce") - F.col("_dc")))
    return rows.drop("_up"), cells.drop("_up").checkpoint(eager=True)


def period_cells(df: DataFrame, features, period: str = "period", by=(), buckets: int = KS_BUCKETS) -> PeriodCells:
    """The first round over all values, for KS and PSI. ``df`` is read in every round, a round shuffles a row for each cell and task."""
    by, features = list(by), list(features)
    checkpoint_dir(df.sparkSession)
    x = [F.col(c).cast("double") for c in features]
    side = df.select(*by, (F.col(period) == REF).cast("long").alias("_r"), (F.col(period) == CUR).cast("long").alias("_c"),
                     F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("_f"), F.when(~F.isnan(v), v).alias("value")) for i, v in enumerate(x)])).alias("_x"))
    rows = side.select(*by, "_r", "_c", "_x.*").where(F.col("value").isNotNull())
    counts = rows.groupBy(*by, "_f").agg(F.sum("_r").alias("n_ref"), F.sum("_c").alias("n_cur"), *_ends()) \
        .where((F.col("n_ref") > 0) & (F.col("n_cur") > 0)).checkpoint(eager=True)
    n_groups = counts.count()
    if by:
        groups = row_index(counts, [*by, "_f"], name="_g").checkpoint(eager=True)
        rows = null_safe_join(rows, maybe_broadcast(groups.select(*by, "_f", "_g"), n_groups), [*by, "_f"])
    else:
        groups, rows = counts.withColumn("_g", F.col("_f")), rows.withColumn("_g", F.col("_f"))
    name = F.element_at(F.array(*[F.lit(c) for c in features]), (F.col("_f") + 1).cast("int"))
    rows = rows.select(F.col("_g").alias("_cell"), "value", "_r", "_c")
    none = F.lit(0).cast("long")
    root = groups.select(*_GROUP, F.col("_g").alias("_cell"), *_ENDS, none.alias("_r0"), none.alias("_c0"))
    inside, first = _divide(rows, root, n_groups, n_groups, buckets, _by_magnitude)
    return PeriodCells(groups.select(*by, name.alias("feature"), *_GROUP), n_groups, rows, first, inside, buckets)


def _narrowed(cells: PeriodCells, wanted):
    """Rounds until few values are in the cells that ``wanted`` picks from those of a round: (rows, those cells, their number)."""
    rows, found = cells.inside, cells.first
    for i in range(KS_ROUNDS):
        open_ = wanted(found).checkpoint(eager=True)
        n_open, left = open_.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
        if left <= SWEPT_VALUES or i == KS_ROUNDS - 1:
            break
        rows, found = _divide(rows, open_, n_open, cells.n_groups, cells.buckets)
    return rows, open_, n_open


def _swept(rows: DataFrame, open_: DataFrame, n_open: int) -> DataFrame:
    """The values of the open cells with both ECDFs' counts up to each, ``cum_c_ref`` and ``cum_c_cur``."""
    inside = rows.join(maybe_broadcast(open_.select("_cell"), n_open), "_cell", "left_semi")
    vc = inside.groupBy("_cell", "value").agg(F.sum("_r").alias("c_ref"), F.sum("_c").alias("c_cur")).checkpoint(eager=True)
    pre = prefix_sums_by_value(vc, ["_cell"], "value", ["c_ref", "c_cur"], n_groups=n_open)
    at = open_.select(F.col("_cell"), "_r0", "_c0", *_GROUP)
    return null_safe_join(pre, maybe_broadcast(at, n_open), ["_cell"]) \
        .withColumns({"cum_c_ref": F.col("_r0") + F.col("cum_c_ref"), "cum_c_cur": F.col("_c0") + F.col("cum_c_cur")})


def ks_pruned(df: DataFrame, features, period: str = "period", by=(), buckets: int = KS_BUCKETS, cells: PeriodCells | None = None) -> DataFrame:
    """Exact two-sample KS statistic without sorting or shuffling every distinct value.

    1. The range of each group is divided into cells, and one aggregate counts both periods in every cell. That gives
       the exact ECDF gap at every cell's end: LB = max of those is attained. Inside a cell both ECDFs only rise by
       the cell's mass, so the gap there is at most UB = max(|R_end - C_start|, |R_start - C_end|).
    2. Only cells of several values with UB > LB can hold the supremum. While more than ``SWEPT_VALUES`` rows are in
       such cells these are divided again, by their rows, and counted in the same way.
    3. The values that are left are counted and swept exactly (bucketed prefix sums). D = max(LB, sweep).
    """
    g = [*by, "feature"]
    cells = cells or period_cells(df, features, period, by, buckets)
    best = None

    def wanted(found):
        nonlocal best
        rs, re_ = F.col("_r0") / F.col("n_ref"), F.col("_re") / F.col("n_ref")
        cs, ce = F.col("_c0") / F.col("n_cur"), F.col("_ce") / F.col("n_cur")
        seen = found.select("_g", F.abs(re_ - ce).alias("_lb"))
        best = (seen if best is None else best.unionByName(seen)).groupBy("_g").agg(F.max("_lb").alias("_lb")).checkpoint(eager=True)
        ub = F.greatest(F.abs(re_ - cs), F.abs(rs - ce))
        return found.join(maybe_broadcast(best, cells.n_groups), "_g").where((F.col("_min") != F.col("_max")) & (ub > F.col("_lb"))).drop("_lb")

    rows, open_, n_open = _narrowed(cells, wanted)
    if n_open:
        gap = F.abs(F.col("cum_c_ref") / F.col("n_ref") - F.col("cum_c_cur") / F.col("n_cur"))
        best = best.unionByName(_swept(rows, open_, n_open).select("_g", gap.alias("_lb"))).groupBy("_g").agg(F.max("_lb").alias("_lb"))
    return cells.groups.join(best, "_g").select(*g, "n_ref", "n_cur", F.col("_lb").alias("ks_statistic"))


def _cell_quantiles(cells: PeriodCells, probs) -> DataFrame:
    """(_g, p, q): ``quantile_cont`` of the reference, ordering the values of the cells that hold the target ranks only."""
    pos = (F.col("n_ref") - 1) * F.col("p")
    targets = cells.groups.select(*_GROUP, F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")) \
        .select("_g", "p", pos.alias("_pos"), F.floor(pos).cast("long").alias("_lo"), F.ceil(pos).cast("long").alias("_hi"))
    ranks = targets.select("_g", F.explode(F.array("_lo", "_hi")).alias("_rank")).distinct().checkpoint(eager=True)
    n_ranks = 2 * len(probs) * cells.n_groups
    held = (F.col("_r0") <= F.col("_rank")) & (F.col("_rank") < F.col("_re"))
    settled = []

    def wanted(found):
        hit = found.join(maybe_broadcast(ranks, n_ranks), "_g").where(held)
        settled.append(hit.where("_min = _max").select("_g", "_rank", F.col("_min").alias("value")))
        return hit.where("_min != _max").drop("_rank").distinct()

    rows, open_, n_open = _narrowed(cells, wanted)
    found = settled[0]
    for x in settled[1:]:
        found = found.unionByName(x)
    if n_open:
        swept = _swept(rows, open_, n_open).select("_g", "value", (F.col("cum_c_ref") - F.col("c_ref")).alias("_r0"), F.col("cum_c_ref").alias("_re"))
        found = found.unionByName(swept.join(maybe_broadcast(ranks, n_ranks), "_g").where(held).select("_g", "_rank", "value"))
    found = found.checkpoint(eager=True)
    at = lambda end: found.select("_g", F.col("_rank").alias(f"_{end}"), F.col("value").alias(f"_v{end}"))
    q = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_pos") - F.col("_lo"))
    return targets.join(at("lo"), ["_g", "_lo"]).join(at("hi"), ["_g", "_hi"]) \
        .select("_g", "p", F.when(F.col("_lo") == F.col("_hi"), F.col("_vlo")).otherwise(q).alias("q"))


def kolmogorov_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value Q(lambda), lambda = D sqrt(nm / (n + m)).

    Q = 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lambda^2); lambda < 0.2 -> 1 (the
    series does not settle there). Differs from the exact small-sample value.
    """
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.lit(2.0) * F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


#: largest side for which the exact distribution is computed (the reference's limit)
EXACT_ROWS = 10_000


def exact_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Exact two-sided p-value P(D >= d) of samples of ``n`` and ``m`` rows without ties.

    A random merge of the samples is a lattice path from (0, 0) to (n, m); D < d if it stays
    where |i/n - j/m| < d. The probability of being at (i, k - i) after k steps, never having left that
    band, follows from the step before: i/k of it came with an i-step, (k - i)/k with a j-step. One array of the
    band's probabilities is carried along the n + m steps, so the work is about 2 d n m.
    """
    n, m = n.cast("bigint"), m.cast("bigint")
    reach = F.round(d * n * m).cast("bigint")  # |i m - j n| stays below it: both are whole numbers

    def step(acc: Column, k: Column) -> Column:
        low = F.greatest(F.floor((k * n - reach) / (n + m)) + 1, k - m, F.lit(0)).cast("bigint")
        high = F.least(F.ceil((k * n + reach) / (n + m)) - 1, k, n).cast("bigint")
        here = F.transform(F.sequence(low, F.greatest(low, high)), lambda i: (
            F.coalesce(F.get(acc["p"], (i - 1 - acc["low"]).cast("int")), F.lit(0.0)) * i
            + F.coalesce(F.get(acc["p"], (i - acc["low"]).cast("int")), F.lit(0.0)) * (k - i)) / k)
        return F.struct(low.alias("low"), F.when(high >= low, here).otherwise(F.array(F.lit(0.0))).alias("p"))

    start = F.struct(F.lit(0).cast("bigint").alias("low"), F.array(F.lit(1.0)).alias("p"))
    inside = F.aggregate(F.sequence(F.lit(1).cast("bigint"), n + m), start, step, lambda acc: F.get(acc["p"], (n - acc["low"]).cast("int")))
    return F.when(reach <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 - F.coalesce(inside, F.lit(0.0)))))


def ks_pvalue(d: Column, n: Column, m: Column, exact_rows: int = EXACT_ROWS) -> Column:
    """Exact up to ``exact_rows`` rows on the larger side, above that the asymptotic series."""
    series = kolmogorov_pvalue(d, n.cast("double"), m.cast("double"))
    return F.when(F.greatest(n, m) <= exact_rows, exact_pvalue(d, n, m)).otherwise(series) if exact_rows else series


def ks_test(df: DataFrame, features, period: str = "period", threshold: float = DEFAULT_THRESHOLD,
            by=(), num_partitions=None, counts: DataFrame | None = None, exact_rows: int = 0, cells: PeriodCells | None = None) -> DataFrame:
    """D1 + D2: (by..., feature, n_ref, n_cur, ks_statistic, p_value, drift_detected).

    The p-value is the asymptotic one; ``exact_rows`` (say ``EXACT_ROWS``) asks for the exact
    one where neither side has more rows.
    """
    if cells is not None:
        ks = ks_pruned(df, features, period, by, cells=cells)
    else:
        counts = counts if counts is not None else period_counts(df, features, period, by)
        ks = ks_from_counts(counts, by, num_partitions, len(list(features)))
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"), exact_rows)
    return ks.withColumn("p_value", p).withColumn("drift_detected", F.col("p_value") < threshold)


def drift_report(ks: DataFrame, features, threshold: float = DEFAULT_THRESHOLD, by=()) -> DataFrame:
    """D3: has_drift, drifted features (sorted, comma-joined), count, total, percentage, threshold."""
    by = list(by)
    total = len(list(features))
    agg = ks.groupBy(*by).agg(
        F.count_if(F.col("drift_detected")).alias("drift_count"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))), ",")
        .alias("drifted_features"))
    return agg.select(*by, (F.col("drift_count") > 0).alias("has_drift"), "drifted_features", "drift_count",
                      F.lit(total).alias("total_features"),
                      (F.col("drift_count") * 100.0 / total).alias("drift_percentage"),
                      F.lit(float(threshold)).alias("threshold"))


def psi(df: DataFrame, features, period: str = "period", bins: int = 10, by=(),
        counts: DataFrame | None = None, cells: PeriodCells | None = None) -> DataFrame:
    """PSI per feature with bins from reference percentiles (see SURVEY §8-D).

    edges = unique(percentiles 0..100 step 100/bins) of the reference rows;
    slot = number of edges[:-1] <= x (slot 0 is below the reference minimum);
    proportions + 1e-10 on both sides, PSI = sum (c - r) ln(c / r).
    Standalone: bracket-and-select deciles and one counting pass; with a
    shared per-period value-count table (D7), everything comes from that table; with
    shared ``cells`` the deciles do, and one pass counts the rows per slot.
    """
    g = list(by) + ["feature"]
    probs = [i / bins for i in range(bins + 1)]
    if cells is not None:
        q = _cell_quantiles(cells, probs)
        edges = q.groupBy("_g").agg(F.array_sort(F.array_distinct(F.collect_list("q"))).alias("edges")).checkpoint(eager=True)
        rows = cells.rows.join(maybe_broadcast(edges.select(F.col("_g").alias("_cell"), "edges"), cells.n_groups * (bins + 1)), "_cell")
        rows = rows.select(F.col("_cell").alias("_g"), "edges", "value", F.col("_r").alias("c_ref"), F.col("_c").alias("c_cur"))
        groups, g = cells.groups.select(*g, "_g"), ["_g"]
    elif counts is None:
        # standalone: exact reference deciles by bracket-and-select, then one pass counting rows per slot
        long = _long(df, features, period, by)
        q = exact_quantiles(long.where(F.col(period) == REF), g, "value", probs)
        edges = q.groupBy(*g).agg(F.array_sort(F.array_distinct(F.collect_list("q"))).alias("edges"))
        rows = attach(long, edges, g, width=bins + 1).select(*g, "edges", "value", (F.col(period) == REF).cast("int").alias("c_ref"),
                                             (F.col(period) == CUR).cast("int").alias("c_cur"))
    else:
        q = quantiles_from_counts(counts, g, "value", probs, count_col="c_ref",
                                  n_groups=None if by else len(list(features)))
        edges = q.groupBy(*g).agg(F.array_sort(F.array_distinct(F.collect_list("q"))).alias("edges"))
        rows = attach(counts, edges, g, width=bins + 1)
    # the edges up to the value, without the last one
    slot = F.least(bucket_index("value", "edges", bins + 1, inclusive=True), F.size("edges") - 1)
    per_slot = rows.groupBy(*g, slot.alias("slot")).agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))
    if cells is not None:
        per_slot = per_slot.checkpoint(eager=True)  # read twice below
    # a group with rows in one period only has no PSI (as it has no KS)
    totals = (per_slot.groupBy(*g).agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
              .where("n_ref > 0 and n_cur > 0"))
    grid = edges.select(*g, F.explode(F.sequence(F.lit(0), F.size("edges") - 1)).alias("slot"))
    full = null_safe_join(null_safe_join(grid, per_slot, g + ["slot"], "left"), totals, g)
    r = F.coalesce(F.col("c_ref"), F.lit(0)) / F.col("n_ref") + PSI_EPS
    c = F.coalesce(F.col("c_cur"), F.lit(0)) / F.col("n_cur") + PSI_EPS
    out = full.groupBy(*g).agg(F.sum((c - r) * F.log(c / r)).alias("psi"))
    return out if cells is None else out.join(groups, "_g").select(*by, "feature", "psi")


def psi_bands(p: DataFrame, col: str = "psi", by=()) -> DataFrame:
    """Stable / moderate / significant, ranked by PSI (1 = largest) within each ``by`` group."""
    band = F.when(F.col(col) < PSI_MODERATE, F.lit("stable")).when(
        F.col(col) <= PSI_SIGNIFICANT, F.lit("moderate")).otherwise(F.lit("significant"))
    # one row per feature (and group): a group's ranking is a tiny sort
    w = Window.partitionBy(*by).orderBy(F.desc(col), F.asc("feature"))
    return p.withColumn("band", band).withColumn("rank", F.row_number().over(w))


def drift_history(dm: DataFrame, threshold: float = 0.5, features=None) -> DataFrame:
    """Drift score history per feature with a threshold flag."""
    out = dm if not features else dm.where(F.col("feature_name").isin(list(features)))
    return out.select("timestamp", "feature_name", "drift_score",
                      (F.col("drift_score") > threshold).alias("above_threshold"))


def monitoring_run(df: DataFrame, features, date: str = "date", as_of=None, days: int = 30,
                   threshold: float = DEFAULT_THRESHOLD, bins: int = 10, by=()) -> DataFrame:
    """Split at as_of - days, KS + PSI per feature -> ``drift_metrics`` rows.

    Up to ``COUNTED_VALUES`` values both tests read one table of value counts. More are not sorted: both begin with the counts of
    cells of values and look into those that matter, with the same results; ``df`` is read for each round.
    """
    from salesflow.operators.relational import label_period
    features = list(features)
    n, newest = df.agg(F.count(F.lit(1)), F.max(date).cast("date")).first()
    as_of = as_of if as_of is not None else F.lit(newest).cast("date")
    lab = label_period(df, date, as_of, days)
    if n * len(features) <= COUNTED_VALUES:
        both = {"counts": period_counts(lab, features, "period", by)}  # one pass over the data for both tests
    else:
        both = {"cells": period_cells(lab, features, "period", by)}
    ks = ks_test(lab, features, "period", threshold, by, **both)
    p = psi(lab, features, "period", bins, by, **both)
    g = list(by) + ["feature"]
    out = null_safe_join(ks, p, g, "left")  # both exist for the same groups: those with rows in both periods
    return out.select(*by, F.lit(as_of).cast("date").alias("as_of"), F.col("feature").alias("feature_name"),
                      F.col("ks_statistic").alias("drift_score"), "drift_detected", "ks_statistic",
                      F.col("p_value").alias("ks_pvalue"), F.col("psi").alias("psi_score"))


def append_drift_metrics(run: DataFrame, path: str) -> None:
    """Add a run's rows to the ``drift_metrics`` table, a partition for each day.

    A run for a day that the table has already replaces that day only (dynamic
    partition overwrite), so a job that is started again leaves no row twice.
    """
    (run.withColumn("day", F.col("as_of")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def read_drift_metrics(spark, path: str, features=None, since=None) -> DataFrame:
    """Appended rows; ``since`` prunes the day partitions."""
    out = spark.read.parquet(path)
    if since is not None:
        out = out.where(F.col("day") >= F.lit(since).cast("date"))
    return (out if not features else out.where(F.col("feature_name").isin(list(features)))).drop("day")
