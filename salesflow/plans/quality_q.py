"""Registered data-quality queries (Q1-Q18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators import quality as Q
from salesflow.plans.common import materialize, max_literal, null_every, null_every_sql, rounded, sales
from salesflow.plans.registry import register
from salesflow.sources.fixtures import sales_sql, with_views

COLS = ("date", "region", "product", "category", "price", "quantity", "sales")
SRC_SQL = f"SELECT {', '.join(COLS)} FROM ({sales_sql()})"
VIEW = {"s": SRC_SQL}


def _frame(spark, sf_dir):
    return sales(spark, sf_dir, COLS)


def _as_of(spark, sf_dir):
    """The newest date: one column of one table, without the joins of the view."""
    return max_literal(sales(spark, sf_dir, ["date"]), "date")


def _st(bad: str, level: str) -> str:
    return f"CASE WHEN {bad} THEN '{level}' ELSE 'passed' END"


def _scalar_sql(by: str = "") -> str:
    """The scalar checks of the whole table, or with ``by`` of each of its groups."""
    sel, key, group = [], f"{by}, " if by else "", f" GROUP BY {by}" if by else ""
    sel.append(f"SELECT {key}'not_empty' AS \"check\", NULL::VARCHAR AS \"column\", {_st('n = 0', 'failed')} AS status, "
               f"CAST(n AS DOUBLE) AS observed FROM m")
    for c in [c for c in Q.REQUIRED if c != by]:
        sel.append(f"SELECT {key}'schema', '{c}', 'passed', 1.0 FROM m")
    for c in Q.CRITICAL:
        sel.append(f"SELECT {key}'critical_completeness', '{c}', {_st(f'null_{c} > 0', 'failed')}, "
                   f"CAST(null_{c} AS DOUBLE) FROM m")
    for c in [c for c in COLS if c != by]:
        sel.append(f"SELECT {key}'completeness', '{c}', {_st(f'round(null_{c} * 100.0 / n, 2) > 10.0', 'warning')}, "
                   f"round(null_{c} * 100.0 / n, 2) FROM m")
    for c in Q.NUMERIC_REQUIRED:
        sel.append(f"SELECT {key}'data_types', '{c}', 'passed', 0.0 FROM m")
    for c, _ in (("price", ""), ("quantity", ""), ("sales", "")):
        sel.append(f"SELECT {key}'value_ranges', '{c}', {_st(f'range_{c} > 0', 'failed')}, CAST(range_{c} AS DOUBLE) FROM m")
    sel.append(f"SELECT {key}'date_validity', 'date', {_st('date_future > 0', 'warning')}, CAST(date_future AS DOUBLE) FROM m")
    sel.append(f"SELECT {key}'date_range', 'date', {_st('date_span < 30', 'warning')}, CAST(date_span AS DOUBLE) FROM m")
    sel.append(f"SELECT {key}'business_rule', 'sales', {_st('NOT coalesce(business_rule < 0.01, true)', 'failed')}, "
               f"business_rule FROM m")
    measures = ", ".join(
        ["count(*) AS n"] + [f"count(*) - count({c}) AS null_{c}" for c in COLS] +
        ["count(*) FILTER (WHERE price <= 0) AS range_price", "count(*) FILTER (WHERE quantity <= 0) AS range_quantity",
         "count(*) FILTER (WHERE sales < 0) AS range_sales",
         "count(*) FILTER (WHERE date > (SELECT max(date) FROM s)) AS date_future",
         "CAST(max(date) - min(date) AS BIGINT) AS date_span",
         "max(abs(price * quantity - sales)) AS business_rule"])
    return with_views(f"WITH m AS (SELECT {key}{measures} FROM s{group})\n" + "\nUNION ALL ".join(sel), **VIEW)


@register("q1_q6_scalar_checks", _scalar_sql(), ("Q1", "Q2", "Q3", "Q4", "Q5", "Q6", "Q14"))
def scalar_checks(spark, sf_dir):
    return rounded(Q.scalar_checks(_frame(spark, sf_dir), as_of=_as_of(spark, sf_dir)))


def _dup_sql(cols) -> str:
    return with_views(f"""
SELECT 'duplicates' AS "check", NULL::VARCHAR AS "column",
       CASE WHEN d > 0 THEN 'warning' ELSE 'passed' END AS status, CAST(d AS DOUBLE) AS observed
FROM (SELECT coalesce(sum(c - 1), 0) AS d FROM (SELECT count(*) AS c FROM s GROUP BY {', '.join(cols)}))
UNION ALL
SELECT 'key_duplicates', 'date,region,product', CASE WHEN d > 0 THEN 'failed' ELSE 'passed' END, CAST(d AS DOUBLE)
FROM (SELECT coalesce(sum(c - 1), 0) AS d FROM (SELECT count(*) AS c FROM s GROUP BY date, region, product))""",
                      s=f"SELECT {', '.join(cols)} FROM ({sales_sql()})")


_DUP_SQL = _dup_sql(COLS)


@register("q7_q8_duplicates", _DUP_SQL, ("Q7", "Q8"))
def duplicates(spark, sf_dir):
    return Q.duplicate_checks(_frame(spark, sf_dir))


_OUTLIER_SQL = with_views(" UNION ALL ".join(f"""
SELECT 'statistical_outliers' AS "check", '{c}' AS "column",
  CASE WHEN round(o * 100.0 / n, 2) > 5 THEN 'warning' ELSE 'passed' END AS status, round(o * 100.0 / n, 2) AS observed
FROM (SELECT count(*) FILTER (WHERE {c} < q1 - 3 * (q3 - q1) OR {c} > q3 + 3 * (q3 - q1)) AS o, count(*) AS n
      FROM s, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM s))"""
                                              for c in Q.NUMERIC_REQUIRED), **VIEW)


@register("q9_statistical_outliers", _OUTLIER_SQL, ("Q9",))
def outliers(spark, sf_dir):
    return Q.outlier_check(_frame(spark, sf_dir))


@register("q13_verdict", f"""
SELECT CAST(count(*) FILTER (WHERE status = 'passed') AS INTEGER) AS n_passed,
       CAST(count(*) FILTER (WHERE status = 'failed') AS INTEGER) AS n_failed,
       CAST(count(*) FILTER (WHERE status = 'warning') AS INTEGER) AS n_warnings,
       count(*) FILTER (WHERE status = 'failed') = 0 AS is_valid
FROM (({_scalar_sql()}) UNION ALL ({_dup_sql(COLS)}) UNION ALL ({_OUTLIER_SQL}))""", ("Q13",))
def verdict(spark, sf_dir):
    # one run of the view's joins for all checks
    rep = Q.validate(materialize(_frame(spark, sf_dir)), as_of=_as_of(spark, sf_dir))
    return Q.verdict(rep).select(F.col("n_passed").cast("int"), F.col("n_failed").cast("int"),
                                 F.col("n_warnings").cast("int"), "is_valid")


def _by_region_sql() -> str:
    dup = lambda cols: f"SELECT region, sum(c - 1) AS d FROM (SELECT region, count(*) AS c FROM s GROUP BY {', '.join(cols)}) GROUP BY region"
    return f"""{_scalar_sql('region')} UNION ALL
SELECT region, 'duplicates', NULL, {_st('d > 0', 'warning')}, CAST(d AS DOUBLE) FROM ({dup(COLS)}) UNION ALL
SELECT region, 'key_duplicates', 'date,region,product', {_st('d > 0', 'failed')}, CAST(d AS DOUBLE) FROM ({dup(('date', 'region', 'product'))})
UNION ALL {' UNION ALL '.join(f"""SELECT region, 'statistical_outliers', '{c}', {_st('round(o * 100.0 / n, 2) > 5', 'warning')}, round(o * 100.0 / n, 2)
  FROM (SELECT region, count(*) FILTER (WHERE {c} < q1 - 3 * (q3 - q1) OR {c} > q3 + 3 * (q3 - q1)) AS o, count(*) AS n FROM s JOIN
    (SELECT region, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM s GROUP BY region) USING (region) GROUP BY region)"""
                            for c in Q.NUMERIC_REQUIRED)}"""


@register("q13_verdict_by_region", f"""
SELECT region, count(*) FILTER (WHERE status = 'passed') AS n_passed, count(*) FILTER (WHERE status = 'failed') AS n_failed,
  count(*) FILTER (WHERE status = 'warning') AS n_warnings, count(*) FILTER (WHERE status = 'failed') = 0 AS is_valid
FROM ({_by_region_sql()}) GROUP BY region""", ("Q13",))
def verdict_by_region(spark, sf_dir):
    s = materialize(_frame(spark, sf_dir))  # the joins of the view once, for all checks
    return Q.verdict(Q.validate(s, as_of=_as_of(spark, sf_dir), by=["region"]), by=["region"])


@register("q13_report_by_region", f"SELECT * FROM ({_by_region_sql()})", ("Q13",))
def report_by_region(spark, sf_dir):
    s = materialize(_frame(spark, sf_dir))
    return rounded(Q.validate(s, as_of=_as_of(spark, sf_dir), by=["region"]))


_LIMITS = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in Q.THRESHOLDS.items())


@register("q13_report", f"""
SELECT "check", "column", status, observed, threshold,
  "check" || coalesce(' of ' || "column", '') || ': ' || status || ' (observed ' || coalesce(printf('%.2f', observed), 'nothing')
    || ', limit ' || printf('%.2f', threshold) || ')' AS message
FROM (SELECT *, CASE "check" {_LIMITS} END AS threshold FROM (({_scalar_sql()}) UNION ALL ({_dup_sql(COLS)})))""", ("Q13",))
def report(spark, sf_dir):
    rep = Q.validate(_frame(spark, sf_dir), as_of=_as_of(spark, sf_dir), outliers=False)
    return rounded(Q.with_messages(rep))


_FEAT = ("quantity", "price", "l_discount", "l_tax")
_EXPECTED = ("quantity", "price", "l_discount", "p_size")


@register("q10_q12_feature_checks", with_views(" UNION ALL ".join(
    [f"SELECT 'expected_features' AS \"check\", '{c}' AS \"column\", "
     f"'{'passed' if c in _FEAT else 'failed'}' AS status, {1.0 if c in _FEAT else 0.0} AS observed"
     for c in _EXPECTED] +
    [f"SELECT 'unexpected_features', '{c}', 'warning', 1.0" for c in _FEAT if c not in _EXPECTED] +
    [f"""SELECT 'infinite_values', '{c}', CASE WHEN count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) > 0
          THEN 'failed' ELSE 'passed' END, CAST(count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) AS DOUBLE) FROM f
       UNION ALL SELECT 'zero_columns', '{c}', CASE WHEN coalesce(bool_and(coalesce({c} = 0, false)), false)
          THEN 'warning' ELSE 'passed' END, CAST(coalesce(bool_and(coalesce({c} = 0, false)), false) AS INTEGER) FROM f"""
     for c in _FEAT]),
    f=f"SELECT {', '.join(_FEAT)} FROM ({sales_sql()})"), ("Q10", "Q11", "Q12"))
def feature_checks(spark, sf_dir):
    f = sales(spark, sf_dir, _FEAT)
    return rounded(Q.validate_features(f, expected=_EXPECTED))


_GATE_SRC = f"""SELECT date, region, product, {null_every_sql('price', 'l_orderkey', 17)} AS price, quantity, sales
FROM ({sales_sql()})"""


@register("q16_gate_report", with_views("""
SELECT count(*) AS n_rows, (count(*) - count(date)) + (count(*) - count(region)) + (count(*) - count(product))
  + (count(*) - count(price)) + (count(*) - count(quantity)) + (count(*) - count(sales)) AS n_missing,
  CAST((count(date) = 0)::INT + (count(region) = 0)::INT + (count(product) = 0)::INT + (count(price) = 0)::INT
  + (count(quantity) = 0)::INT + (count(sales) = 0)::INT AS INTEGER) AS n_all_null_columns,
  0 AS n_missing_required,
  (count(*) - count(price)) = 0 AND count(*) >= 1 AS passed FROM g""", g=_GATE_SRC), ("Q16",))
def gate_report(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "region", "product", "price", "quantity", "sales", "l_orderkey"])
    g = s.withColumn("price", null_every("price", "l_orderkey", 17)).drop("l_orderkey")
    return Q.gate_report(g).select("n_rows", "n_missing", F.col("n_all_null_columns").cast("int"),
                                   F.col("n_missing_required").cast("int"), "passed")


@register("q17_load_checks", with_views(
    "SELECT 'not_empty' AS \"check\", NULL::VARCHAR AS \"column\", CASE WHEN count(*) = 0 THEN 'failed' ELSE 'passed' END "
    "AS status, CAST(count(*) AS DOUBLE) AS observed FROM g UNION ALL SELECT 'duplicate_columns', NULL, 'passed', 0.0 "
    + " ".join(f"UNION ALL SELECT 'mostly_null', '{c}', CASE WHEN round((count(*) - count({c})) * 100.0 / count(*), 2) > 50 "
               f"THEN 'warning' ELSE 'passed' END, round((count(*) - count({c})) * 100.0 / count(*), 2) FROM g"
               for c in ("date", "region", "product", "price", "quantity", "sales")), g=_GATE_SRC), ("Q17",))
def load_checks(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "region", "product", "price", "quantity", "sales", "l_orderkey"])
    g = s.withColumn("price", null_every("price", "l_orderkey", 17)).drop("l_orderkey")
    return Q.load_checks(g)


_REC_SRC = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date,
  CASE WHEN l_orderkey % 13 = 0 THEN '  ' ELSE region END AS region, product,
  {null_every_sql('price', 'l_orderkey', 17)} AS price, quantity FROM ({sales_sql()})"""


@register("q18_record_validation", with_views("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  array_to_string(list_filter([CASE WHEN coalesce(length(trim(region)) > 0, false) THEN NULL ELSE 'region is blank' END,
    CASE WHEN coalesce(length(trim(product)) > 0, false) THEN NULL ELSE 'product is blank' END,
    CASE WHEN coalesce(price > 0, false) THEN NULL ELSE 'price must be > 0' END,
    CASE WHEN coalesce(quantity > 0, false) THEN NULL ELSE 'quantity must be > 0' END,
    CASE WHEN date IS NULL THEN 'date is missing' END], lambda x: x IS NOT NULL), ';') AS reasons,
  coalesce(length(trim(region)) > 0, false) AND coalesce(length(trim(product)) > 0, false)
    AND coalesce(price > 0, false) AND coalesce(quantity > 0, false) AND date IS NOT NULL AS accepted
FROM r""", r=_REC_SRC), ("Q18",))
def record_validation(spark, sf_dir):
    s = sales(spark, sf_dir, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "date", "region",
                              "product", "price", "quantity"])
    r = (s.withColumn("region", F.when(F.pmod("l_orderkey", F.lit(13)) == 0, F.lit("  ")).otherwise(F.col("region")))
         .withColumn("price", null_every("price", "l_orderkey", 17)))
    v = Q.validate_records(r)
    return v.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.array_join("reasons", ";").alias("reasons"), "accepted")
