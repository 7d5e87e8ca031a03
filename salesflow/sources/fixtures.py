"""Logical tables over the driver's TPC-H-like parquet files.

Each view exists twice: as a Spark DataFrame builder and as a DuckDB SQL
common-table expression used by the oracle queries. Both must stay in step.

``sales`` joins lineitem to its order, customer, nation, region and part.
Every foreign key matches, so a dimension join that contributes no requested
column is skipped (``columns=``): at 100 TB each skipped join is a full
shuffle of the fact table saved. All dimension joins are left to the planner
and AQE, which broadcast a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (nation and region always are) and
otherwise run a sort-merge join on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# unique row order inside a (date, region, product) cell
SALES_TIEBREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
SALES_ORDER = ("date",) + SALES_TIEBREAK

# numeric feature matrix columns (FIXTURES.md §2) and the modelling target
FEATURE_COLS = ("quantity", "price", "l_discount", "l_tax", "p_size", "p_retailprice",
                "o_totalprice", "c_acctbal")
TARGET = "sales"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# column -> dimension it comes from
_SALES_SOURCES = {
    "date": "l", "price": "l", "quantity": "l", "sales": "l", "l_orderkey": "l",
    "l_linenumber": "l", "l_partkey": "l", "l_suppkey": "l", "l_extendedprice": "l",
    "l_discount": "l", "l_tax": "l", "l_shipdate": "l", "l_returnflag": "l", "l_linestatus": "l",
    "product": "p", "category": "p", "p_size": "p", "p_retailprice": "p", "predicted": "p",
    "o_totalprice": "o", "o_orderdate": "o", "o_orderpriority": "o",
    "c_acctbal": "c", "c_mktsegment": "c", "region": "r", "nation": "r",
}
SALES_COLUMNS = tuple(_SALES_SOURCES)


def sales(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """The ``sales`` view (FIXTURES.md §2): one row per line item."""
    cols = list(columns) if columns else list(SALES_COLUMNS)
    need = {_SALES_SOURCES[c] for c in cols}
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").cast("date").alias("date"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("sales"),
        F.col("l_quantity").alias("_qty"),
    )
    df = li
    if "p" in need:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"),
            F.col("p_brand").alias("category"), "p_size", "p_retailprice")
        df = df.join(part, "l_partkey").withColumn("predicted", F.col("_qty") * F.col("p_retailprice"))
    if "o" in need or "c" in need or "r" in need:
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice",
            "o_orderdate", "o_orderpriority")
        if "c" in need or "r" in need:
            cust = table(spark, sf_dir, "customer").select(
                F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment")
            if "r" in need:
                nation = table(spark, sf_dir, "nation").select(
                    F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"),
                    "n_regionkey")
                region = table(spark, sf_dir, "region").select(
                    F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
                # nation / region are tiny: the planner broadcasts them on their measured
                # size (autoBroadcastJoinThreshold), no unconditional hint
                geo = nation.join(region, "n_regionkey")
                cust = cust.join(geo, "c_nationkey")
            orders = orders.join(cust, "o_custkey")
        df = df.join(orders, "l_orderkey")
    return df.select(*cols)


def sales_sql(columns=None) -> str:
    """DuckDB body of the ``sales`` view (full join; the oracle does not prune)."""
    return """
    SELECT CAST(l.l_shipdate AS DATE) AS date, r.r_name AS region, n.n_name AS nation,
           p.p_type AS product, p.p_brand AS category,
           l.l_extendedprice / l.l_quantity AS price, CAST(l.l_quantity AS INTEGER) AS quantity,
           l.l_extendedprice AS sales, l.l_quantity * p.p_retailprice AS predicted,
           l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
           l.l_discount, l.l_tax, l.l_shipdate, l.l_returnflag, l.l_linestatus,
           p.p_size, p.p_retailprice, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
           c.c_acctbal, c.c_mktsegment
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    JOIN part p ON l.l_partkey = p.p_partkey"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored predictions with actuals, built from ``events``."""
    ev = table(spark, sf_dir, "events")
    actual = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        F.col("event_id").alias("prediction_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("region"),
        F.col("user_id").alias("product"),
        F.col("value").alias("predicted_sales"),
        actual.alias("actual_sales"),
        F.abs(actual - F.col("value")).alias("absolute_error"),
    )


PREDICTIONS_SQL = """
    SELECT event_id AS prediction_id, ts AS "timestamp", event_type AS region, user_id AS product,
           value AS predicted_sales, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS actual_sales,
           abs(CAST(json_extract_string(props, '$.k') AS DOUBLE) - value) AS absolute_error
    FROM events"""


SEVERITY_BY_REMAINDER = ("critical", "warning", "info")  # user_id % 3 -> severity (fixed fixture rule)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert log built from ``events`` (FIXTURES.md §2)."""
    ev = table(spark, sf_dir, "events")
    sev = F.element_at(F.array(*[F.lit(s) for s in SEVERITY_BY_REMAINDER]),
                       (F.pmod("user_id", F.lit(3)) + 1).cast("int"))
    return ev.select(
        F.col("event_id").alias("alert_id"),
        F.col("event_type").alias("alert_type"),
        sev.alias("severity"),
        F.concat(F.upper("event_type"), F.lit(" alert")).alias("title"),
        F.col("ts").alias("timestamp"),
        (F.pmod("event_id", F.lit(4)) != 0).alias("resolved"),
    )


ALERTS_SQL = """
    SELECT event_id AS alert_id, event_type AS alert_type,
           CASE user_id % 3 WHEN 0 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'info' END AS severity,
           upper(event_type) || ' alert' AS title, ts AS "timestamp", (event_id % 4 <> 0) AS resolved
    FROM events"""


def drift_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift history for report queries, built from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("metric_id"),
        F.date_trunc("hour", "ts").alias("timestamp"),
        F.col("event_type").alias("feature_name"),
        (F.col("value") / 500.0).alias("drift_score"),
        (F.col("value") > 250).alias("drift_detected"),
    )


DRIFT_METRICS_SQL = """
    SELECT event_id AS metric_id, date_trunc('hour', ts) AS "timestamp", event_type AS feature_name,
           value / 500.0 AS drift_score, (value > 250) AS drift_detected
    FROM events"""


def with_views(sql: str, **views: str) -> str:
    """Prefix an oracle query with the named fixture CTEs."""
    if not views:
        return sql
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in views.items())
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"
