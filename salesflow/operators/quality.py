"""Data quality checks (Q1-Q18) as one long report frame.

Report rows: (check, column, status in {passed, failed, warning}, observed).
All scalar measures (null counts, range violations, date bounds, infinities,
all-zero columns, the business rule) come from ONE aggregation pass; exact
duplicates are counted by 128-bit row hashes, and only rows whose hash repeats are compared whole; IQR outliers use
bracket-and-select quartiles. Every group is aggregated map-side first, so a hot key costs nothing
extra. With ``by`` every check and the verdict come once for each group (a NULL group is one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.operators.blocks import attach, exact_quantiles, maybe_broadcast, null_safe_join, unpivot_numeric
from salesflow.functions.exprs import non_blank
from salesflow.session import checkpoint_dir

REQUIRED = ("date", "region", "product", "price", "quantity", "sales")
CRITICAL = ("date", "sales")
NUMERIC_REQUIRED = ("price", "quantity", "sales")
KEYS = ("date", "region", "product")
NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")

PASSED, FAILED, WARNING = "passed", "failed", "warning"


def _row(check: str, column, observed: Column, status: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                    status.alias("status"), observed.cast("double").alias("observed"))


def _status(bad: Column, level: str) -> Column:
    return F.when(bad, F.lit(level)).otherwise(F.lit(PASSED))


def _is_numeric(t: str) -> bool:
    return t in NUMERIC_TYPES or t.startswith("decimal")


def scalar_checks(df: DataFrame, required=REQUIRED, critical=CRITICAL, as_of=None,
                  null_warn_pct: float = 10.0, min_span_days: int = 30, by=()) -> DataFrame:
    """Q1-Q6, Q11, Q12, Q14 from one aggregation pass (one row of checks for each ``by`` group)."""
    by = list(by)
    types = dict(df.dtypes)
    cols = [c for c in df.columns if c not in by]
    required, critical = ([c for c in names if c not in by] for names in (required, critical))
    aggs = {"n": F.count(F.lit(1))}
    for c in cols:
        miss = F.col(c).isNull() | (F.isnan(F.col(c)) if types[c] in ("double", "float") else F.lit(False))
        aggs[f"null_{c}"] = F.count_if(miss)
    rng = {"price": F.col("price") <= 0, "quantity": F.col("quantity") <= 0, "sales": F.col("sales") < 0}
    for c, cond in rng.items():
        if c in cols and _is_numeric(types[c]):
            aggs[f"range_{c}"] = F.count_if(cond)
    for c in NUMERIC_REQUIRED:
        if c in cols and types[c] == "string":
            aggs[f"cast_{c}"] = F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` as double)").isNull())
    if "date" in cols:
        d = F.col("date") if types["date"] in ("date", "timestamp", "timestamp_ntz") else F.expr(
            "try_to_timestamp(`date`)")
        if types["date"] == "string":
            aggs["date_unparsable"] = F.count_if(F.col("date").isNotNull() & d.isNull())
        if as_of is not None:
            aggs["date_future"] = F.count_if(d > as_of)
        aggs["date_span"] = F.datediff(F.max(d), F.min(d))
    if all(c in cols and _is_numeric(types[c]) for c in ("price", "quantity", "sales")):
        aggs["business_rule"] = F.max(F.abs(F.col("price") * F.col("quantity") - F.col("sales")))
    one = df.groupBy(*by).agg(*[v.alias(k) for k, v in aggs.items()])
    n = F.col("n")
    rows = [_row("not_empty", None, n, _status(n == 0, FAILED))]
    for c in required:
        rows.append(_row("schema", c, F.lit(1 if c in cols else 0), F.lit(PASSED if c in cols else FAILED)))
    for c in critical:
        if c in cols:
            rows.append(_row("critical_completeness", c, F.col(f"null_{c}"), _status(F.col(f"null_{c}") > 0, FAILED)))
    for c in cols:
        pct = F.round(F.try_divide(F.col(f"null_{c}") * 100.0, n), 2)
        rows.append(_row("completeness", c, pct, _status(F.coalesce(pct > null_warn_pct, F.lit(False)), WARNING)))
    for c in NUMERIC_REQUIRED:
        if c in cols:
            if f"cast_{c}" in aggs:
                rows.append(_row("data_types", c, F.col(f"cast_{c}"), _status(F.col(f"cast_{c}") > 0, FAILED)))
            else:
                ok = _is_numeric(types[c])
                rows.append(_row("data_types", c, F.lit(0 if ok else 1), F.lit(PASSED if ok else FAILED)))
    for c in rng:
        if f"range_{c}" in aggs:
            rows.append(_row("value_ranges", c, F.col(f"range_{c}"), _status(F.col(f"range_{c}") > 0, FAILED)))
    if "date_unparsable" in aggs:
        rows.append(_row("date_parsing", "date", F.col("date_unparsable"), _status(F.col("date_unparsable") > 0, FAILED)))
    if "date_future" in aggs:
        rows.append(_row("date_validity", "date", F.col("date_future"), _status(F.col("date_future") > 0, WARNING)))
    if "date_span" in aggs:
        rows.append(_row("date_range", "date", F.col("date_span"),
                         _status(F.coalesce(F.col("date_span") < min_span_days, F.lit(False)), WARNING)))
    if "business_rule" in aggs:
        rows.append(_row("business_rule", "sales", F.col("business_rule"),
                         _status(~F.coalesce(F.col("business_rule") < 0.01, F.lit(True)), FAILED)))
    return one.select(*by, F.inline(F.array(*rows)))


def _row_hash(df: DataFrame) -> list[Column]:
    """128 bits of a row; equal rows (as grouping sees them: NULL = NULL, -0.0 = 0.0) have equal hashes."""
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    cols = [F.col(c) + F.lit(0.0) if c in floats else F.col(c) for c in df.columns]
    return [F.xxhash64(*cols).alias("_h1"), F.xxhash64(F.lit(20_261_203), *reversed(cols)).alias("_h2")]


def exact_duplicates(df: DataFrame, by=()) -> DataFrame:
    """(by..., dup): rows that repeat an earlier one in all columns.

    Hashes are counted first: 16 bytes a row are shuffled, pre-aggregated. Rows whose hash
    occurs once are unique and stay where they are; only the others are grouped whole, so the
    count is exact whatever the hash does. The repeated hashes are broadcast when their counted
    number allows it, otherwise joined as Spark plans it.
    """
    by = list(by)
    checkpoint_dir(df.sparkSession)
    hashed = df.select("*", *_row_hash(df))
    again = hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_h1", "_h2").checkpoint(eager=True)
    rows = hashed.join(maybe_broadcast(again, again.count()), ["_h1", "_h2"], "left_semi")
    full = rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return full.groupBy(*by).agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("dup"))


def duplicate_checks(df: DataFrame, keys=KEYS, by=()) -> DataFrame:
    """Q7 exact duplicates (warning, observed = count) and Q8 key duplicates (failed); NULLs compare equal (pandas ``duplicated``)."""
    by = list(by)

    def rows(dup: DataFrame, check: str, column, level: str) -> DataFrame:
        return dup.select(*by, F.inline(F.array(_row(check, column, F.col("dup"), _status(F.col("dup") > 0, level)))))

    exact = exact_duplicates(df, by)
    if by:  # groups without a repeated row
        exact = null_safe_join(df.select(*by).distinct(), exact, by, "left").withColumn("dup", F.coalesce("dup", F.lit(0)))
    out = rows(exact, "duplicates", None, WARNING)
    if all(k in df.columns for k in keys):
        groups = df.groupBy(*dict.fromkeys([*by, *keys])).agg(F.count(F.lit(1)).alias("_c"))
        dup = groups.groupBy(*by).agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("dup"))
        out = out.unionByName(rows(dup, "key_duplicates", ",".join(keys), FAILED))
    return out


def outlier_check(df: DataFrame, cols=NUMERIC_REQUIRED, k: float = 3.0, max_pct: float = 5.0, by=()) -> DataFrame:
    """Q9: share of rows outside the k x IQR fences per column; warning above ``max_pct``.

    Exact quartiles by bracket-and-select, then one aggregate over the rows
    with the per-column fences attached (NULL values count in the denominator,
    never as outliers).
    """
    by = list(by)
    cols = [c for c in cols if c in df.columns]
    long = unpivot_numeric(df, cols, by=by)
    q = exact_quantiles(long, [*by, "column"], "value", (0.25, 0.75))
    f = q.groupBy(*by, "column").agg(F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
                                     F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    out_cond = (F.col("value") < F.col("q1") - k * iqr) | (F.col("value") > F.col("q3") + k * iqr)
    if by:  # a column without values in a group has no fences there
        f = null_safe_join(long.select(*by, "column").distinct(), f, [*by, "column"], "left")
        fenced = attach(long, f, [*by, "column"])
    else:  # the fence table has one row per column: broadcast by construction
        fenced = long.join(F.broadcast(f), "column", "left")
    per = fenced.groupBy(*by, "column").agg(
        F.count_if(F.coalesce(out_cond, F.lit(False))).alias("_o"), F.count(F.lit(1)).alias("_n_rows"))
    pct = F.round(F.col("_o") * 100.0 / F.col("_n_rows"), 2)
    return per.select(*by, F.lit("statistical_outliers").alias("check"), "column",
                      _status(pct > max_pct, WARNING).alias("status"), pct.cast("double").alias("observed"))


def validate(df: DataFrame, required=REQUIRED, keys=KEYS, as_of=None, outliers: bool = True, by=()) -> DataFrame:
    """Q1-Q9 report (long form), for each ``by`` group."""
    out = scalar_checks(df, required, as_of=as_of, by=by).unionByName(duplicate_checks(df, keys, by))
    if outliers:
        out = out.unionByName(outlier_check(df, by=by))
    return out


def verdict(report: DataFrame, strict: bool = False, by=()) -> DataFrame:
    """Q13: one row (for each ``by`` group) - valid, counts of passed / failed / warnings."""
    agg = report.groupBy(*by).agg(F.count_if(F.col("status") == PASSED).alias("n_passed"),
                                  F.count_if(F.col("status") == FAILED).alias("n_failed"),
                                  F.count_if(F.col("status") == WARNING).alias("n_warnings"))
    valid = F.col("n_failed") == 0
    if strict:
        valid = valid & (F.col("n_warnings") == 0)
    return agg.withColumn("is_valid", valid)


# limits of the checks: what ``observed`` is compared with
THRESHOLDS = {"not_empty": 1.0, "schema": 1.0, "critical_completeness": 0.0, "completeness": 10.0, "data_types": 0.0, "value_ranges": 0.0,
              "date_parsing": 0.0, "date_validity": 0.0, "date_range": 30.0, "business_rule": 0.01, "duplicates": 0.0, "key_duplicates": 0.0,
              "statistical_outliers": 5.0, "expected_features": 1.0, "unexpected_features": 0.0, "infinite_values": 0.0, "zero_columns": 0.0,
              "duplicate_columns": 0.0, "mostly_null": 50.0}


def with_messages(report: DataFrame) -> DataFrame:
    """The report with the ``threshold`` of each check and a ``message``."""
    limits = F.create_map(*[x for k, v in THRESHOLDS.items() for x in (F.lit(k), F.lit(v))])
    where = F.when(F.col("column").isNull(), F.lit("")).otherwise(F.concat(F.lit(" of "), "column"))
    out = report.withColumn("threshold", F.try_element_at(limits, F.col("check")))
    return out.withColumn("message", F.concat(
        F.col("check"), where, F.lit(": "), F.col("status"), F.lit(" (observed "), F.coalesce(F.format_string("%.2f", "observed"), F.lit("nothing")),
        F.lit(", limit "), F.format_string("%.2f", "threshold"), F.lit(")")))


def report_text(report: DataFrame) -> str:
    """The report as text: the verdict, then a line for each check that did not pass (one report row each)."""
    v = verdict(report).first()
    lines = [f"{'VALID' if v['is_valid'] else 'INVALID'}: {v['n_passed']} passed, {v['n_failed']} failed, {v['n_warnings']} warnings"]
    rest = with_messages(report).where(F.col("status") != PASSED).orderBy("status", "check", "column")
    return "\n".join(lines + [f"- {r['message']}" for r in rest.collect()])


# Q10 / Q11 / Q12 -----------------------------------------------------------------------------
def validate_features(df: DataFrame, expected=None) -> DataFrame:
    """Missing expected features (failed), unexpected extras (warning), +/-inf (failed),
    all-zero columns (warning; a NULL makes a column not all-zero)."""
    types = dict(df.dtypes)
    num = [c for c in df.columns if _is_numeric(types[c])]
    rows = []
    if expected is not None:
        for c in expected:
            rows.append(_row("expected_features", c, F.lit(1 if c in df.columns else 0),
                             F.lit(PASSED if c in df.columns else FAILED)))
        for c in df.columns:
            if c not in expected:
                rows.append(_row("unexpected_features", c, F.lit(1), F.lit(WARNING)))
    aggs = []
    for c in num:
        x = F.col(c).cast("double")
        aggs += [F.count_if(F.abs(x) == float("inf")).alias(f"inf_{c}"),
                 F.coalesce(F.bool_and(F.coalesce(x == 0, F.lit(False))), F.lit(False)).alias(f"zero_{c}")]
    for c in num:
        rows.append(_row("infinite_values", c, F.col(f"inf_{c}"), _status(F.col(f"inf_{c}") > 0, FAILED)))
        rows.append(_row("zero_columns", c, F.col(f"zero_{c}").cast("int"), _status(F.col(f"zero_{c}"), WARNING)))
    one = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("_n"))
    return one.select(F.inline(F.array(*rows)))


# Q16 --------------------------------------------------------------------------------------------
class QualityGateError(ValueError):
    pass


def gate_report(df: DataFrame, required=REQUIRED, min_rows: int = 1) -> DataFrame:
    """Q16: total missing = 0, rows >= min_rows, no all-NULL column, required columns present."""
    cols = df.columns
    missing_req = [c for c in required if c not in cols]
    nulls = sum(F.count_if(F.col(c).isNull()) for c in cols)
    all_null = sum(F.when(F.count(F.col(c)) == 0, 1).otherwise(0) for c in cols)
    r = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("n_missing"), all_null.alias("n_all_null_columns"))
    ok = (F.col("n_missing") == 0) & (F.col("n_rows") >= min_rows) & (F.col("n_all_null_columns") == 0) & F.lit(
        not missing_req)
    return r.withColumn("n_missing_required", F.lit(len(missing_req))).withColumn("passed", ok)


def gate(df: DataFrame, required=REQUIRED, min_rows: int = 1) -> DataFrame:
    """Raise ``QualityGateError`` on violation, else return ``df`` unchanged."""
    row = gate_report(df, required, min_rows).collect()[0]
    if not row["passed"]:
        raise QualityGateError(f"quality gate failed: {row.asDict()}")
    return df


# Q17 --------------------------------------------------------------------------------------------
def load_checks(df: DataFrame, max_null_pct: float = 50.0) -> DataFrame:
    """Q17: empty (failed), duplicate column names (failed), columns > 50 % NULL (warning)."""
    cols = df.columns
    dup_names = len(cols) - len({c.lower() for c in cols})
    uniq = list(dict.fromkeys(cols))
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}")
                                              for i, c in enumerate(uniq)] if dup_names == 0 else [
        F.count(F.lit(1)).alias("_n")]
    one = df.agg(*aggs)
    rows = [_row("not_empty", None, F.col("_n"), _status(F.col("_n") == 0, FAILED)),
            _row("duplicate_columns", None, F.lit(dup_names), F.lit(FAILED if dup_names else PASSED))]
    if dup_names == 0:
        for i, c in enumerate(uniq):
            pct = F.round(F.try_divide(F.col(f"nulls_{i}") * 100.0, F.col("_n")), 2)
            rows.append(_row("mostly_null", c, pct, _status(F.coalesce(pct > max_null_pct, F.lit(False)), WARNING)))
    return one.select(F.inline(F.array(*rows)))


# Q18 --------------------------------------------------------------------------------------------
def validate_records(df: DataFrame) -> DataFrame:
    """Adds ``reasons`` (array) and ``accepted``; split with ``accepted`` / ``~accepted``."""
    reasons = F.array_compact(F.array(
        F.when(~non_blank(F.col("region")), F.lit("region is blank")),
        F.when(~non_blank(F.col("product")), F.lit("product is blank")),
        F.when(~F.coalesce(F.col("price") > 0, F.lit(False)), F.lit("price must be > 0")),
        F.when(~F.coalesce(F.col("quantity") > 0, F.lit(False)), F.lit("quantity must be > 0")),
        F.when(F.col("date").isNull(), F.lit("date is missing"))))
    return df.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)
