"""Keyed streaming state with timers (ST3, ST6): ``transformWithStateInPandas`` on the RocksDB state store.

* ``row_windows`` - the hopping row windows of PM2 on a stream: a key's state is its row count and its last
  ``size`` rows, whatever the number of rows it has seen; a window is emitted once the row after it has come.
* ``current_status`` - the newest status of each key in update mode: only keys that changed are emitted, a timer
  reports and forgets a key that was silent for ``expire_after``, and every batch is merged by key
  into the next version of the small status table, which a replayed batch writes again as it was.

Rows of one key are taken in event order within a batch; batches must not go back in event time (a row older than its
key's newest one counts where it arrives).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from salesflow.operators.models import EPS
from salesflow.streaming.jobs import _run

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State that may outgrow the heap lives in RocksDB; a session setting, needed by these jobs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def window_metrics(y: np.ndarray, p: np.ndarray) -> tuple:
    """n, rmse, mae, r2, mape of complete pairs, as M6 has them."""
    whole = ~(np.isnan(y) | np.isnan(p))
    y, e = y[whole], (y - p)[whole]
    if not len(y):
        return 0, None, None, None, None
    sse, sst = float((e * e).sum()), float(((y - y.mean()) ** 2).sum())
    r2 = 1 - sse / sst if sst else float(sse == 0)
    return len(y), float(np.sqrt(np.mean(e * e))), float(np.abs(e).mean()), r2, float((np.abs(e) / np.maximum(np.abs(y), EPS)).mean() * 100)


class _RowWindows(StatefulProcessor):
    """State of a key: rows seen so far and the last ``size`` of them."""

    def __init__(self, key: str, size: int):
        self.key, self.size = key, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("rows", T.LongType())]))
        self.tail = handle.getValueState("tail", T.StructType([T.StructField(c, T.ArrayType(t)) for c, t in (
            ("ts", T.LongType()), ("actual", T.DoubleType()), ("predicted", T.DoubleType()))]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        size, step = self.size, self.size // 2
        new = pd.concat(list(rows)).sort_values(["ts", "id"])
        before = self.seen.get()[0] if self.seen.exists() else 0
        kept = self.tail.get() if self.tail.exists() else ([], [], [])
        ts = np.r_[np.array(kept[0], np.int64), new["ts"].to_numpy(np.int64)]
        y = np.r_[np.array([np.nan if v is None else v for v in kept[1]], float), new["actual"].to_numpy(float)]
        p = np.r_[np.array([np.nan if v is None else v for v in kept[2]], float), new["predicted"].to_numpy(float)]
        seen, first = before + len(new), before - len(kept[0])
        out = []
        # ends e = size + k * step that have become known: before <= e < seen, as the row e closes its window
        for k in range(max(0, -(-(before - size) // step)), (seen - 1 - size) // step + 1 if seen > size else 0):
            low, high = k * step - first, k * step + size - first
            out.append((key[0], k, k * step + size, *window_metrics(y[low:high], p[low:high]), int(ts[high - 1])))
        self.seen.update((seen,))
        self.tail.update(([int(v) for v in ts[-size:]], [None if np.isnan(v) else float(v) for v in y[-size:]],
                          [None if np.isnan(v) else float(v) for v in p[-size:]]))
        yield pd.DataFrame(out, columns=[self.key, "window_id", "row_index", "n", "rmse", "mae", "r2", "mape", "ts"])

    def close(self) -> None:
        pass


def row_windows(stream: DataFrame, key: str, size: int, out_path: str, checkpoint: str, ts: str = "timestamp", row_id: str = "prediction_id",
                actual: str = "actual_sales", predicted: str = "predicted_sales") -> None:
    """PM2 on a stream: metrics of hopping row windows (``size`` rows, half of them new) of each key, appended to ``out_path``."""
    if size < 2:
        raise ValueError("window size must be >= 2 (step = size // 2 must be positive)")
    use_rocksdb(stream.sparkSession)
    rows = stream.select(key, F.unix_micros(ts).alias("ts"), F.col(row_id).cast("long").alias("id"), F.col(actual).cast("double").alias("actual"),
                         F.col(predicted).cast("double").alias("predicted"))
    schema = T.StructType([rows.schema[key], *[T.StructField(n, T.LongType()) for n in ("window_id", "row_index", "n")],
                           *[T.StructField(n, T.DoubleType()) for n in ("rmse", "mae", "r2", "mape")], T.StructField("ts", T.LongType())])
    out = rows.groupBy(key).transformWithStateInPandas(_RowWindows(key, size), schema, "Append", "None")
    out = out.withColumn("timestamp", F.timestamp_micros("ts").cast("timestamp_ntz")).drop("ts")
    _run(out.writeStream.outputMode("append").format("parquet").option("path", out_path), checkpoint)


class _Status(StatefulProcessor):
    """State of a key: its newest row; a timer ends it after a silence."""

    def __init__(self, key: str, state: T.StructType, silence_ms: int):
        self.key, self.schema, self.silence_ms = key, state, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.schema)

    def _row(self, key, values, expired: bool) -> pd.DataFrame:
        row = pd.DataFrame([(key[0], *values, expired)], columns=[self.key, *self.schema.names, "expired"])
        row["expired"] = row["expired"].astype(bool)
        return row

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.names
        best = tuple(self.newest.get()) if self.newest.exists() else None
        start = best
        for pdf in rows:
            top = pdf.sort_values(names[:2]).iloc[-1]
            top = tuple(v.item() if hasattr(v, "item") else v for v in (top[n] for n in names))
            if best is None or top[:2] > best[:2]:
                best = top
        if best != start:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(best[0] // 1000 + self.silence_ms)
            self.newest.update(best)
            yield self._row(key, best, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = tuple(self.newest.get())
        self.newest.clear()
        yield self._row(key, best, True)

    def close(self) -> None:
        pass


def merge_by_key(spark: SparkSession, out_path: str, key: str, batch: DataFrame, epoch: int) -> None:
    """Version ``epoch`` of the table: the version before it, with the batch's keys replaced (expired ones taken out).

    It depends on the version before and the batch alone, so writing it again changes nothing.
    """
    changed = batch.groupBy(key).agg(F.max_by(F.struct(*[c for c in batch.columns if c != key]), F.struct("ts", "tiebreak", "expired")).alias("s")) \
        .select(key, "s.*")
    earlier = [v for v in versions(spark, out_path) if v < epoch]
    out = changed
    if earlier:
        old = spark.read.parquet(f"{out_path}/version={max(earlier)}")
        out = old.join(changed.select(key), key, "left_anti").unionByName(changed)
    out.where(~F.col("expired")).write.mode("overwrite").parquet(f"{out_path}/version={epoch}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose folder holds the commit marker."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(folder)
                  if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))


def current_status(stream: DataFrame, key: str, ts: str, tiebreak: str, out_path: str, checkpoint: str, cols=("drift_score", "drift_detected"),
                   expire_after: str = "3650 days", watermark: str = "1 hour") -> None:
    """Newest status of each key, in update mode; ``read_status`` reads the table."""
    spark = stream.sparkSession
    use_rocksdb(spark)
    silence = int(pd.Timedelta(expire_after) / pd.Timedelta("1ms"))
    rows = stream.withWatermark(ts, watermark).select(
        key, F.col(ts).alias("event_time"), F.unix_micros(ts).alias("ts"), F.col(tiebreak).cast("long").alias("tiebreak"), *cols)
    state = T.StructType([T.StructField("ts", T.LongType()), T.StructField("tiebreak", T.LongType()), *[rows.schema[c] for c in cols]])
    schema = T.StructType([rows.schema[key], *state.fields, T.StructField("expired", T.BooleanType())])
    out = rows.groupBy(key).transformWithStateInPandas(_Status(key, state, silence), schema, "Update", "EventTime")

    def batch(df: DataFrame, epoch: int) -> None:
        merge_by_key(df.sparkSession, out_path, key, df, epoch)

    _run(out.writeStream.outputMode("update").foreachBatch(batch), checkpoint)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version."""
    out = spark.read.parquet(f"{path}/version={max(versions(spark, path))}")
    return out.withColumn("timestamp", F.timestamp_micros("ts")).drop("ts", "tiebreak", "expired")
