"""Registered source / sink queries (IO1-IO11).

Each writes data derived from the driver tables to a fresh folder below the
shared checkpoint location, reads it back through the library reader and
aggregates, so the oracle can compare with the same aggregate on the source.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salesflow.operators.preprocess import split
from salesflow.plans.common import rounded, rsql, sales
from salesflow.plans.registry import register
from salesflow.session import scratch_path
from salesflow.sources import fixtures as fx
from salesflow.sources import io as IO
from salesflow.sources.fixtures import PREDICTIONS_SQL, sales_sql, with_views

SALES = {"sales": sales_sql()}
PRED = {"predictions": PREDICTIONS_SQL}
COLS = ["date", "region", "product", "category", "price", "quantity", "sales"]
QUOTED = ', "quoted"'  # embedded comma and doubled quotes in every category value


@register("io1_csv_roundtrip", with_views(f"""
SELECT region, count(*) AS n_rows, {rsql('sum(sales)', 2)} AS total, count(DISTINCT category || '{QUOTED}') AS n_category,
  min(category || '{QUOTED}') AS first_category FROM sales GROUP BY region""", **SALES), ("IO1",))
def csv_roundtrip(spark, sf_dir):
    s = sales(spark, sf_dir, COLS).withColumn("category", F.concat("category", F.lit(QUOTED)))
    path = scratch_path(spark, "io1-csv")
    IO.write_table(s, path, format="csv")
    back = IO.read_csv(spark, path, IO.SALES_CSV_SCHEMA, validate=True)
    out = back.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("total"),
                                     F.countDistinct("category").alias("n_category"),
                                     F.min("category").alias("first_category"))
    return rounded(out, money=("total",))


@register("io2_type_coercion", """
SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE l_orderkey % 97 = 0 OR l_linenumber = 7) AS n_bad_rows,
  count(*) FILTER (WHERE l_orderkey % 97 = 0) AS n_bad_dates,
  round(sum(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END), 2) + 0.0 AS total
FROM lineitem""", ("IO2", "Q4", "Q6"))
def type_coercion(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    raw = li.select(
        F.when(F.pmod("l_orderkey", F.lit(97)) == 0, F.lit("not-a-date"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string"))
        .alias("price"))
    path = scratch_path(spark, "io2-csv")
    IO.write_table(raw, path, format="csv")
    back = IO.read_csv(spark, path, "date string, price string")
    typed = IO.coerce(back, dates=["date"], numbers=["price"])
    return rounded(typed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("_bad_row").alias("n_bad_rows"),
                             F.count_if(F.col("date").isNull()).alias("n_bad_dates"), F.sum("price").alias("total")),
                   money=("total",))


_AGG_SQL = with_views(f"""
SELECT region, count(*) AS n_rows, {rsql('sum(sales)', 2)} AS total, max(date) AS last_date FROM sales
GROUP BY region""", **SALES)


def _agg(df):
    return rounded(df.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("total"),
                                            F.max("date").alias("last_date")), money=("total",))


@register("io3_parquet_roundtrip", _AGG_SQL, ("IO3",))
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "io3-parquet")
    IO.write_table(sales(spark, sf_dir, COLS), path, "parquet")
    return _agg(IO.read_table(spark, path))


@register("io4_csv_gzip_roundtrip", _AGG_SQL, ("IO4",))
def csv_gzip_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "io4-csv-gz")
    IO.write_table(sales(spark, sf_dir, COLS), path, "csv", compress="gzip")
    return _agg(IO.read_csv(spark, path, IO.SALES_CSV_SCHEMA))


@register("io5_named_dataset", _AGG_SQL, ("IO5",))
def named_dataset(spark, sf_dir):
    base = scratch_path(spark, "io5-base")
    IO.save_processed(sales(spark, sf_dir, COLS), base, "sales_features_v1")
    return _agg(IO.load_processed(spark, base, "sales_features_v1"))


@register("io6_split_bundle", with_views("""
SELECT split, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date FROM (
  SELECT date, CASE WHEN row_number() OVER (ORDER BY date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1
    >= count(*) OVER () - ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM sales) GROUP BY split""",
                                         **SALES), ("IO6", "T1"))
def split_bundle(spark, sf_dir):
    s = sales(spark, sf_dir, ["date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                              "price", "sales"])
    path = scratch_path(spark, "io6-splits")
    IO.save_splits(split(s, fx.SALES_ORDER, 0.2), path)
    back = IO.load_splits(spark, path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"),
                                     F.max("date").alias("last_date"))


@register("io7_latest_snapshot", with_views(f"""
SELECT 2 AS batch_id, count(*) AS n_rows, {rsql('sum(predicted_sales)', 2)} AS total FROM predictions
WHERE "timestamp" >= TIMESTAMP '2024-01-15 00:00:00'""", **PRED), ("IO7",))
def latest_snapshot(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    path = scratch_path(spark, "io7-snapshots")
    IO.append_snapshot(p.where(F.col("timestamp") < cut), path, 1)
    IO.append_snapshot(p.where(F.col("timestamp") >= cut), path, 2)
    latest = IO.latest_snapshot(spark, path)
    return rounded(latest.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.sum("predicted_sales").alias("total")), money=("total",))


@register("io8_append_sink", with_views(f"""
SELECT CAST("timestamp" AS DATE) AS day, count(*) AS n_rows, {rsql('sum(predicted_sales)', 2)} AS total
FROM predictions GROUP BY 1""", **PRED), ("IO8",))
def append_sink(spark, sf_dir):
    p = fx.predictions(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    path = scratch_path(spark, "io8-append")
    half = F.col("prediction_id") % 2 == 0
    IO.write_table(p.where(half), path, mode="append", partition_by="day")
    IO.write_table(p.where(~half), path, mode="append", partition_by="day")
    back = IO.read_table(spark, path)
    return rounded(back.groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.sum("predicted_sales").alias("total")), money=("total",))


@register("io9_table_query", with_views("""
SELECT prediction_id, "timestamp", region, predicted_sales FROM predictions WHERE region = 'purchase'
ORDER BY "timestamp" DESC, prediction_id DESC LIMIT 20 OFFSET 5""", **PRED), ("IO9", "P8"))
def table_query(spark, sf_dir):
    path = scratch_path(spark, "io9-table")
    IO.write_table(fx.predictions(spark, sf_dir), path)
    t = IO.read_table(spark, path).where(F.col("region") == "purchase")  # pushed into the parquet scan
    return t.orderBy(F.desc("timestamp"), F.desc("prediction_id")).offset(5).limit(20).select(
        "prediction_id", "timestamp", "region", "predicted_sales")


@register("io10_dataset_info", """
SELECT count(*) AS n_rows, 11 AS n_columns, 1 AS n_files, true AS has_bytes,
  'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate'
    AS columns FROM lineitem""", ("IO10",))
def dataset_info(spark, sf_dir):
    info = IO.dataset_info(fx.table(spark, sf_dir, "lineitem"))
    return info.select("n_rows", F.col("n_columns").cast("int"), F.col("n_files").cast("int"),
                       (F.col("size_bytes") > 0).alias("has_bytes"), "columns")


_IO11 = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
_IO11_SQL = "CAST(('0x' || substr(md5(" + " || '|' || ".join(f"coalesce('=' || CAST({'CAST(l_shipdate AS DATE)' if c == 'l_shipdate' else c} AS VARCHAR), '-')" for c in _IO11) + "), 1, 15)) AS BIGINT)"


@register("io11_partition_status", f"""
SELECT l_returnflag, l_linestatus, count(*) + count(*) FILTER (WHERE again) AS n_rows,
  CAST(sum({_IO11_SQL}) + coalesce(sum({_IO11_SQL}) FILTER (WHERE again), 0) AS VARCHAR) AS digest,
  CASE WHEN count(*) FILTER (WHERE again) > 0 THEN 'changed' ELSE 'unchanged' END AS status, 1 AS files_read
FROM (SELECT *, l_returnflag = 'N' AND l_linestatus = 'O' AND l_orderkey % 32 = 1 AS again FROM lineitem) GROUP BY ALL""", ("IO11",))
def partition_status(spark, sf_dir):
    """Rows appended to one partition: the status names it, and its new file alone is read again."""
    li = fx.table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    path, parts = scratch_path(spark, "io11-table"), ["l_returnflag", "l_linestatus"]
    li.select(*_IO11, *parts).write.partitionBy(*parts).parquet(path)
    old = IO.fingerprint_tree(spark.read.parquet(path), parts, _IO11)
    trees = scratch_path(spark, "io11-trees")
    IO.write_table(old, trees)
    old = IO.read_table(spark, trees)
    more = li.where("l_returnflag = 'N' AND l_linestatus = 'O' AND l_orderkey % 32 = 1").select(*_IO11, *parts)
    # one file; a shuffle, so that every task filters its share of the table and only the rows found meet in one
    more.repartition(1).write.mode("append").partitionBy(*parts).parquet(path)
    new, read = IO.refresh_tree(spark, path, old, parts, _IO11)
    return IO.tree_status(old, new, parts).withColumn("digest", F.col("digest").cast("string")).withColumn("files_read", F.lit(read))


@register("io11_fingerprint", None, ("IO11",))
def fingerprint(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "io11-versions")
    fp = IO.fingerprint(li, "lineitem")
    IO.record_version(fp, path)
    again = IO.version_status(IO.fingerprint(li.orderBy(F.rand(7)), "lineitem"), path, spark)
    return again.select("dataset", "n_rows", "fingerprint", "status")
