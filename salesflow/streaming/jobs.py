"""Structured Streaming twins of the batch operators (ST1-ST6).

Each job reads a file source with an explicit schema, runs with
``trigger(availableNow=True)`` (process what is there, then stop - the same
code runs continuously with a processing-time trigger), keeps its state and
offsets in a checkpoint folder under the shared checkpoint location, and
writes to a file sink (or ``foreachBatch`` for multi-output / complete-mode
tables). The driver never collects stream data.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.operators.models import metric_exprs
from salesflow.operators.quality import validate_records
from salesflow.session import scratch_path

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def stage_source(df: DataFrame, name: str, files: int | None = None, order: str = "ts", rows_per_file: int = 1_000_000,
                 tie: str | None = None) -> str:
    """Stage a batch frame as a file-stream source whose arrival order follows ``order``.

    One range-partitioned write, a range for every ``rows_per_file`` rows (four at least); rows without
    event time come first, spread over as many ranges as they fill by ``tie`` (an id) or a hash of the row. The file
    source hands out files by modification time, which is then set
    to the order of the ranges. Each micro-batch sees later
    events than the one before, as a live feed would. Test/fixture helper: a
    production stream arrives from upstream.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"src-{name}")
    files = files or max(4, -(-df.count() // rows_per_file))
    df.repartitionByRange(files, F.col(order).asc_nulls_first(), F.col(tie) if tie else F.xxhash64(*df.columns)).write.parquet(path)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    first = 1_000_000_000_000  # any past time
    for i, part in enumerate(parts):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(folder, part), first + 60_000 * i, -1)
    return path


def files_for(spark: SparkSession, path: str, batches: int = 4) -> int:
    """Files for each trigger such that what is staged makes about ``batches`` micro-batches, whatever its size."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = sum(s.getPath().getName().startswith("part-") for s in fs.listStatus(folder))
    return max(1, -(-n // batches))


def read_stream(spark: SparkSession, path: str, schema: T.StructType = EVENTS_SCHEMA,
                files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path))


def _run(writer, checkpoint: str):
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def as_predictions(stream: DataFrame) -> DataFrame:
    """events -> prediction records (same mapping as the batch fixture), event time as TIMESTAMP."""
    actual = F.get_json_object("props", "$.k").cast("double")
    return stream.select(
        F.col("event_id").alias("prediction_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("region"), F.col("user_id").alias("product"),
        F.col("value").alias("predicted_sales"), actual.alias("actual_sales"))


# ST1 --------------------------------------------------------------------------------------------
def gate_batch_writer(good_path: str, bad_path: str):
    """foreachBatch function of ST1: validate, then write each epoch to its own partition.

    Idempotent per micro-batch: each epoch overwrites its own ``epoch=``
    partition (dynamic partition overwrite), so a batch replayed after a
    failure replaces its output instead of appending it twice.
    """

    def write(df: DataFrame, path: str):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch").parquet(path))

    def batch(df: DataFrame, epoch_id: int):
        v = validate_records(df).withColumn("epoch", F.lit(epoch_id)).persist()
        write(v.where(F.col("accepted")).drop("reasons"), good_path)
        write(v.where(~F.col("accepted")).withColumn("reasons", F.array_join("reasons", ";")), bad_path)
        v.unpersist()

    return batch


def ingest_with_gate(stream: DataFrame, good_path: str, bad_path: str, checkpoint: str) -> None:
    """Good rows appended to ``good_path``, rejected rows (with reasons) to ``bad_path``."""
    _run(stream.writeStream.foreachBatch(gate_batch_writer(good_path, bad_path)), checkpoint)


# ST2 --------------------------------------------------------------------------------------------
def windowed_counts(stream: DataFrame, out_path: str, checkpoint: str, ts: str = "timestamp",
                    size: str = "1 day", watermark: str = "1 hour", value: str = "predicted_sales") -> None:
    """Tumbling-window statistics; rows later than the watermark are dropped; append mode."""
    agg = (stream.withWatermark(ts, watermark).groupBy(F.window(ts, size).alias("w"))
           .agg(F.count(F.lit(1)).alias("count"), F.sum(value).alias("total"),
                F.min(value).alias("min_value"), F.max(value).alias("max_value")))
    out = agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     "count", "total", "min_value", "max_value")
    _run(out.writeStream.outputMode("append").format("parquet").option("path", out_path), checkpoint)


# ST3 --------------------------------------------------------------------------------------------
def sliding_error_metrics(stream: DataFrame, out_path: str, checkpoint: str, ts: str = "timestamp",
                          size: str = "2 days", slide: str = "1 day", watermark: str = "1 hour",
                          actual: str = "actual_sales", predicted: str = "predicted_sales") -> None:
    """Sliding windows (size, size/2) of error sums -> rmse, mae, mape, r2 (as in batch M6) per closed window."""
    agg = (stream.withWatermark(ts, watermark).groupBy(F.window(ts, size, slide).alias("w"))
           .agg(*metric_exprs(actual, predicted)))
    out = agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "rmse", "mae", "mape", "r2")
    _run(out.writeStream.outputMode("append").format("parquet").option("path", out_path), checkpoint)


# ST4 --------------------------------------------------------------------------------------------
def dedupe_within_watermark(stream: DataFrame, keys, out_path: str, checkpoint: str, ts: str = "timestamp",
                            watermark: str = "60 days") -> None:
    """Keep the first row per key while the key is inside the watermark."""
    out = stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))
    _run(out.writeStream.outputMode("append").format("parquet").option("path", out_path), checkpoint)


# ST5 --------------------------------------------------------------------------------------------
def score_stream(stream: DataFrame, model_path: str, out_path: str, checkpoint: str, key: str) -> None:
    """Load a saved PipelineModel once and apply it to each micro-batch on the executors."""
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(model_path)
    scored = model.transform(stream)
    out = scored.select(key, F.col("prediction").alias("predicted"))
    _run(out.writeStream.outputMode("append").format("parquet").option("path", out_path), checkpoint)


# ST6 --------------------------------------------------------------------------------------------
def latest_status(stream: DataFrame, key: str, ts: str, tiebreak: str, out_path: str, checkpoint: str,
                  cols=("drift_score", "drift_detected")) -> None:
    """Current state per key (complete mode, one row per key).

    Every batch writes a whole version of the small table beside the earlier ones
    (``version=<epoch>``); ``read_latest`` takes the newest complete one, so a reader
    never meets a half-written table and a failed batch loses nothing.
    """
    latest = stream.groupBy(key).agg(
        F.max_by(F.struct(F.col(ts).alias("timestamp"), *[F.col(c) for c in cols]),
                 F.struct(F.col(ts), F.col(tiebreak))).alias("s"))
    out = latest.select(key, "s.*")

    def batch(df: DataFrame, epoch_id: int):
        df.write.mode("overwrite").parquet(f"{out_path}/version={epoch_id}")

    _run(out.writeStream.outputMode("complete").foreachBatch(batch), checkpoint)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version that ``latest_status`` completed (its folder holds the commit marker)."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [s.getPath().getName() for s in fs.listStatus(folder)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    newest = max(int(n.partition("=")[2]) for n in done)
    return spark.read.parquet(f"{path}/version={newest}")


# ST5 with the version table --------------------------------------------------------------------
def version_scorer(spark: SparkSession, versions_path: str, models_path: str, model: str, out_path: str, decisions_path: str, key: str):
    """foreachBatch function: each micro-batch is scored with the Production version at its own start.

    The version is recorded for the batch before anything is scored; a batch that is replayed finds that
    record and takes the same version again, whatever has been promoted since. Output and record are
    partitions of the epoch, so a replay replaces them. A batch without a Production version fails.
    """
    from pyspark.ml import PipelineModel

    from salesflow.operators.models import production_version
    loaded: dict[int, PipelineModel] = {}

    def decided(epoch: int) -> int:
        try:
            row = spark.read.parquet(decisions_path).where(F.col("epoch") == epoch).select("version").first()
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no decision yet
                raise
            row = None
        if row is None:
            row = production_version(spark.read.parquet(versions_path), model).select("version").first()
            if row is None:
                raise RuntimeError(f"model {model} has no Production version")
            spark.createDataFrame([(int(row["version"]), epoch)], "version int, epoch long").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(decisions_path)
        return int(row["version"])

    def batch(df: DataFrame, epoch: int) -> None:
        version = decided(epoch)
        if version not in loaded:
            loaded[version] = PipelineModel.load(f"{models_path}/{model}/{version}")
        out = loaded[version].transform(df).select(
            key, F.col("prediction").alias("predicted"), F.lit(model).alias("model_name"), F.lit(version).alias("model_version"), F.lit(epoch).alias("epoch"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_path)

    return batch


def score_following_versions(stream: DataFrame, versions_path: str, models_path: str, model: str, out_path: str, checkpoint: str, key: str) -> None:
    """ST5 that follows M10's version table; ``{checkpoint}-decisions`` holds the version of each micro-batch."""
    _run(stream.writeStream.foreachBatch(version_scorer(stream.sparkSession, versions_path, models_path, model, out_path, f"{checkpoint}-decisions", key)),
         checkpoint)
