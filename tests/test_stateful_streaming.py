import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.operators import monitor as PM
from salesflow.session import scratch_path
from salesflow.streaming import jobs as J
from salesflow.streaming import stateful as ST

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("k", T.StringType()),
                       T.StructField("y", T.DoubleType()), T.StructField("p", T.DoubleType())])


def feed(spark, n, files):
    r = random.Random(n)
    rows = [(i, i // 3 * 60 + 1_700_000_000, r.choice(["a", "a", "b"]), r.gauss(10, 3) if i % 17 else None, r.gauss(10, 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, s long, k string, y double, p double").select("id", F.timestamp_seconds("s").alias("ts"), "k", "y", "p")
    return df, J.read_stream(spark, J.stage_source(df, "stateful", files, tie="id"), SCHEMA)


def test_row_windows_equal_the_batch(spark):
    df, stream = feed(spark, 500, 5)
    out = scratch_path(spark, "rw-out")
    ST.row_windows(stream, "k", 20, out, scratch_path(spark, "rw-ckpt"), "ts", "id", "y", "p")
    cols = ["k", "window_id", "row_index", "n", "rmse", "mae", "r2", "mape"]
    got = {(r["k"], r["window_id"]): r for r in spark.read.parquet(out).collect()}
    want = PM.performance_trend(df, "y", "p", ["ts", "id"], 20, "ts", by=["k"]).collect()
    assert len(got) == len(want) > 20
    for w in want:
        g = got[w["k"], w["window_id"]]
        assert all(g[c] == w[c] or abs(g[c] - w[c]) < 1e-9 * max(1, abs(w[c])) for c in cols[2:]) and g["row_index"] == w["row_index"]


def test_status_keeps_the_newest_and_forgets_the_silent(spark):
    rows = [(1, 0, "a", 1.0), (2, 50, "b", 2.0), (3, 60, "a", 3.0), (4, 60, "a", 4.0), (5, 4000, "c", 5.0), (6, 90_000, "c", 6.0), (7, 95_000, "c", 7.0)]
    df = spark.createDataFrame(rows, "id long, s long, k string, y double").select("id", F.timestamp_seconds("s").alias("ts"), "k", "y", F.lit(0.0).alias("p"))
    for expire, want in (("3650 days", {"a": 4.0, "b": 2.0, "c": 7.0}), ("2 hours", {"c": 7.0})):
        stream = J.read_stream(spark, J.stage_source(df, "status", 4), SCHEMA)
        out = scratch_path(spark, "status")
        ST.current_status(stream, "k", "ts", "id", out, scratch_path(spark, "status-ckpt"), ("y",), expire, "1 minute")
        assert {r["k"]: r["y"] for r in ST.read_status(spark, out).collect()} == want


def test_a_replayed_batch_changes_nothing(spark):
    out = scratch_path(spark, "merge")
    schema = "k string, ts long, tiebreak long, y double, expired boolean"
    first = spark.createDataFrame([("a", 1, 1, 1.0, False), ("b", 1, 2, 2.0, False)], schema)
    second = spark.createDataFrame([("b", 3, 3, 3.0, False), ("a", 1, 1, 1.0, True), ("c", 4, 4, 4.0, False)], schema)
    for epoch, batch in ((0, first), (1, second), (1, second)):
        ST.merge_by_key(spark, out, "k", batch, epoch)
        now = {r["k"]: r["y"] for r in ST.read_status(spark, out).collect()}
    assert now == {"b": 3.0, "c": 4.0} and ST.versions(spark, out) == [0, 1]


def test_scoring_follows_the_version_table_and_replays_alike(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from salesflow.operators import models as M
    base = scratch_path(spark, "follow")
    for version, slope in ((1, 2.0), (2, 5.0)):
        train = spark.createDataFrame([(float(x), slope * x) for x in range(5)], "p double, label double")
        Pipeline(stages=[VectorAssembler(inputCols=["p"], outputCol="features"), M.make_estimator("linear")]).fit(train).write().save(f"{base}/models/m/{version}")
    versions = spark.createDataFrame([("m", 1, "Production"), ("m", 2, "Staging")], "name string, version int, stage string")
    versions.write.parquet(f"{base}/versions")
    df = spark.createDataFrame([(i, i, "k", 0.0, float(i)) for i in range(6)], "id long, s long, k string, y double, p double").select(
        "id", F.timestamp_seconds("s").alias("ts"), "k", "y", "p")
    src = J.stage_source(df.where("id < 3"), "follow", 1)
    run = lambda: J.score_following_versions(J.read_stream(spark, src, SCHEMA), f"{base}/versions", f"{base}/models", "m", f"{base}/out", f"{base}/ckpt", "id")
    run()
    M.transition(versions, "m", 2, "Production", archive_existing=True).write.mode("overwrite").parquet(f"{base}/versions")
    df.where("id >= 3").coalesce(1).write.mode("append").parquet(src)
    run()  # a restart from the checkpoint
    want = {i: (1, 2.0 * i) if i < 3 else (2, 5.0 * i) for i in range(6)}
    read = lambda: {r["id"]: (r["model_version"], round(r["predicted"], 6)) for r in spark.read.parquet(f"{base}/out").collect()}
    assert read() == want
    # the first batch once more, after the promotion: the version it had
    again = J.version_scorer(spark, f"{base}/versions", f"{base}/models", "m", f"{base}/out", f"{base}/ckpt-decisions", "id")
    again(df.where("id < 3"), 0)
    assert read() == want
