import os

import duckdb
import pytest
from pyspark.sql import functions as F

from salesflow.session import scratch_path
from salesflow.sources import io as IO

from .conftest import SF_SMALL


def test_csv_quoting_roundtrip(spark):
    df = spark.createDataFrame([(1, 'a, "quoted" value'), (2, "plain")], "id int, s string")
    p = scratch_path(spark, "t-csv")
    IO.write_table(df, p, "csv")
    back = IO.read_csv(spark, p, "id int, s string").orderBy("id").collect()
    assert back[0].s == 'a, "quoted" value'


def test_missing_path_raises(spark):
    with pytest.raises(Exception):
        IO.read_csv(spark, "/nonexistent/path/x.csv", "a int").collect()


def test_mixed_types_coerced_with_flag(spark):
    df = spark.createDataFrame([("100",), ("abc",), ("300",)], "value string")
    out = IO.coerce(df, numbers=["value"]).collect()
    assert [r.value for r in out] == [100.0, None, 300.0] and [r._bad_row for r in out] == [False, True, False]


def test_split_bundle_requires_both_splits(spark):
    df = spark.createDataFrame([(1, "train")], "x int, split string")
    p = scratch_path(spark, "t-splits")
    IO.save_splits(df, p)
    with pytest.raises(FileNotFoundError):
        IO.load_splits(spark, p)


def test_fingerprint_is_order_insensitive(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 3)
    a = IO.fingerprint(df, "t").first().fingerprint
    b = IO.fingerprint(df.orderBy(F.desc("id")), "t").first().fingerprint
    c = IO.fingerprint(df.where("id > 0"), "t").first().fingerprint
    assert a == b and a != c


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "ma_7" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


@pytest.mark.parametrize("name", ["a2_daily_revenue_ma", "w2_rolling_halo", "d2_ks_test", "q1_q6_scalar_checks",
                                  "st1_ingest_gate", "st2_daily_windows", "st3_sliding_metrics", "st4_dedupe_keys",
                                  "st5_stream_scoring", "st6_latest_status",
                                  "fs5_mutual_info", "pm2_performance_trend", "a6_numeric_summary", "t8_iqr_outliers",
                                  "io6_split_bundle", "p3_recent_7d"])
def test_queries_match_duckdb_on_small_scale(spark, name):
    import __spark_entry__ as E
    from tools.check import compare

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    ok, msg = compare(got, exp)
    assert ok, msg


def test_duplicate_header_names_rejected(spark):
    # header + one row written as text into a single file
    p2 = scratch_path(spark, "t-dupcsv")
    spark.createDataFrame([("date,region,region,sales",), ("2024-01-01,north,north,100",)], "value string") \
        .coalesce(1).write.text(p2)
    with pytest.raises(ValueError):
        IO.read_csv(spark, p2, validate=True)


def test_empty_csv_rejected(spark):
    p = scratch_path(spark, "t-emptycsv")
    spark.createDataFrame([("date,region",)], "value string").coalesce(1).write.text(p)
    with pytest.raises(ValueError):
        IO.read_csv(spark, p, "date string, region string", validate=True)


def test_gate_batch_replay_is_idempotent(spark):
    import datetime as dt

    from salesflow.streaming.jobs import gate_batch_writer

    rows = [(dt.date(2024, 1, 1), "r", "p", 1.0, 1), (dt.date(2024, 1, 1), "r", "p", 0.0, 1)]
    df = spark.createDataFrame(rows, "date date, region string, product string, price double, quantity int")
    good, bad = scratch_path(spark, "t-good"), scratch_path(spark, "t-bad")
    batch = gate_batch_writer(good, bad)
    batch(df, 0)
    batch(df, 0)  # replay of the same epoch after a failure
    batch(df, 1)
    assert spark.read.parquet(good).count() == 2 and spark.read.parquet(bad).count() == 2


def test_version_status_new_unchanged_changed(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 7)
    path = scratch_path(spark, "t-versions")
    assert IO.version_status(IO.fingerprint(df, "t"), path, spark).first().status == "new"
    IO.record_version(IO.fingerprint(df, "t"), path)
    assert IO.version_status(IO.fingerprint(df.orderBy(F.desc("id")), "t"), path, spark).first().status == "unchanged"
    changed = df.withColumn("v", F.when(F.col("id") == 3, 99).otherwise(F.col("v")))
    assert IO.version_status(IO.fingerprint(changed, "t"), path, spark).first().status == "changed"


def test_oracle_sql_needs_no_spark_session():
    # the driver may ask for the oracle SQL before (or without) creating a session
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as E; "
            "o = E.oracle_sql(); q = E.queries(); print(len(o), len(q))" % repo)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    n_sql, n_q = map(int, out.stdout.split()[-2:])
    assert n_sql >= 100 and n_q >= n_sql
