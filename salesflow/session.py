"""Session construction and the shared scratch / checkpoint location.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by the
cluster operator). Only when nothing is configured (unit tests, a laptop) do we
create a private folder, so lineage cuts never land on a machine-local path in
production.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Engine settings every job relies on: UTC for timestamp parity with the
# oracle, AQE for runtime re-planning (coalesce, skew-join split, broadcast
# conversion by measured size), Arrow for the few pandas-backed steps.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files go when the frame that wrote them is garbage
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "salesflow", extra_conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    # runtime-settable SQL confs also apply to a session created elsewhere
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, DEFAULT_CONF[k])
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``salesflow`` importable on the Python workers (``--py-files`` equivalent).

    Python UDF / mapInPandas / applyInPandas tasks unpickle functions that
    reference this package; executors do not share the driver's sys.path, so
    the package is zipped once on the driver and distributed with
    ``addPyFile`` (served by the driver, cached by every executor).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="salesflow-pyfiles-"), "salesflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only when none is configured and Spark runs in this process."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="salesflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint location."""
    base = checkpoint_dir(spark)
    path = base.rstrip("/") + f"/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_SCRATCH: dict[str, list[str]] = {}


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this application made; returns their number.

    Call it once the results that read them are written: a DataFrame over a scratch
    table is lazy.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        folder = jvm.org.apache.hadoop.fs.Path(p)
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)
