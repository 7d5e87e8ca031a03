"""Sources and sinks (IO1-IO11).

Readers take an explicit schema (no inference pass over 100 TB of CSV);
writers are ordinary DataFrame writers, partitioned where later reads prune
on the partition column (day, split, batch_id).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.operators.blocks import attach
from salesflow.operators.quality import load_checks

# Schema of the raw sales file of the reference pipeline (IO1).
SALES_CSV_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("region", T.StringType()),
    T.StructField("product", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()), T.StructField("quantity", T.IntegerType()),
    T.StructField("sales", T.DoubleType())])


# IO1 --------------------------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, validate: bool = False, malformed: str | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV with a declared schema; quoted commas and doubled quotes handled (escape '"').

    ``malformed`` names a column that receives the text of rows that do not fit the
    schema (else NULL). ``multi_line`` reads line ends inside quoted fields (a file is
    then one task). ``validate`` compares every file's header with the schema, rejects
    duplicate names in any header, runs the load-time checks (Q17) and raises on an
    empty input. A missing path raises (Spark's PATH_NOT_FOUND).
    """
    reader = spark.read.option("header", header).option("escape", '"').option("mode", "PERMISSIVE").option("multiLine", multi_line)
    if schema is not None:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if malformed:
            reader = reader.option("columnNameOfCorruptRecord", malformed)
            fields = T.StructType([*fields.fields, T.StructField(malformed, T.StringType())])
        df = reader.schema(fields).csv(path)
    else:
        df = reader.option("inferSchema", False).csv(path)
    if validate and header:
        # Spark renames duplicate header names (region0, region2): look at each file's first line
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        heads = (lines.where("start = 0").withColumn("at", F.monotonically_increasing_id())
                 .groupBy("file").agg(F.min_by("value", "at").alias("head")).select("head").distinct())
        for (head,) in heads.collect():  # distinct header lines
            names = [c.strip().strip('"') for c in head.split(",")]
            dups = sorted({c for c in names if names.count(c) > 1})
            if dups:
                raise ValueError(f"duplicate column names in {path}: {dups}")
            if schema is not None and names != [f.name for f in fields if f.name != malformed]:
                raise ValueError(f"header {names} in {path} differs from the schema")
    if validate:
        rep = load_checks(df).where(F.col("status") == "failed").collect()
        if rep:
            raise ValueError(f"load checks failed: {[r.asDict() for r in rep]}")
    return df


# IO2 --------------------------------------------------------------------------------------------
def coerce(df: DataFrame, dates=(), numbers=(), integers=(), booleans=(), flag: str = "_bad_row") -> DataFrame:
    """Typed columns from strings in one projection; unparsable values become NULL and set ``flag``."""
    typed = {c: F.try_to_timestamp(F.col(c).cast("string")).cast("date") for c in dates}
    for cols, t in ((numbers, "double"), (integers, "int"), (booleans, "boolean")):
        typed.update({c: F.expr(f"try_cast(`{c}` as {t})") for c in cols})
    bad = F.lit(False)
    for c, v in typed.items():
        bad = bad | (F.col(c).isNotNull() & v.isNull())
    return df.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns], bad.alias(flag))


# IO3 / IO4 / IO8 -------------------------------------------------------------------------------
def write_table(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite",
                partition_by=None, compress: str | None = None, options: dict | None = None) -> None:
    """Parquet (snappy default), CSV (header, optional gzip), or JDBC via ``options``."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    opts = dict(options or {})
    if format == "csv":
        opts.setdefault("header", "true")
        opts.setdefault("escape", '"')
    if compress:
        opts["compression"] = compress
    elif format == "parquet":
        opts.setdefault("compression", "snappy")
    for k, v in opts.items():
        w = w.option(k, v)
    if format == "jdbc":
        w.format("jdbc").save()
    else:
        w.format(format).save(path)


# IO9 --------------------------------------------------------------------------------------------
def read_table(spark: SparkSession, path: str | None = None, format: str = "parquet",
               schema=None, options: dict | None = None) -> DataFrame:
    """Table reader; filters / projections on the result are pushed into the scan."""
    r = spark.read.format(format)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()


# IO5 --------------------------------------------------------------------------------------------
def processed_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/processed/{name}"


def save_processed(df: DataFrame, base: str, name: str) -> str:
    p = processed_path(base, name)
    write_table(df, p)
    return p


def load_processed(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(processed_path(base, name))


# IO6 --------------------------------------------------------------------------------------------
SPLITS = ("train", "test")


def save_splits(df: DataFrame, path: str, split_col: str = "split", prefix: str | None = None) -> str:
    """Features and target stay in one keyed row; one dataset partitioned by split."""
    p = f"{path.rstrip('/')}/{prefix + '_' if prefix else ''}splits"
    write_table(df, p, partition_by=split_col)
    return p


def load_splits(spark: SparkSession, path: str, split_col: str = "split", prefix: str | None = None) -> DataFrame:
    p = f"{path.rstrip('/')}/{prefix + '_' if prefix else ''}splits"
    df = spark.read.parquet(p)
    present = {r[0] for r in df.select(split_col).distinct().collect()}  # partition values only
    missing = [s for s in SPLITS if s not in present]
    if missing:
        raise FileNotFoundError(f"missing split(s) {missing} under {p}")
    return df


# IO7 --------------------------------------------------------------------------------------------
def append_snapshot(df: DataFrame, path: str, batch_id: int) -> None:
    write_table(df.withColumn("batch_id", F.lit(int(batch_id))), path, mode="append", partition_by="batch_id")


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest batch: the max is over partition values, the filter prunes partitions."""
    df = spark.read.parquet(path)
    latest = df.select(F.max("batch_id")).scalar()
    return df.where(F.col("batch_id") == latest)


# IO10 -------------------------------------------------------------------------------------------
def dataset_info(df: DataFrame) -> DataFrame:
    """rows, columns, files, bytes - bytes from file metadata, not from reading the data."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    fi = files.agg(F.count(F.lit(1)).alias("n_files"), F.sum("s").alias("size_bytes"))
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    out = attach(n, fi)
    return out.withColumn("n_columns", F.lit(len(df.columns))).withColumn(
        "columns", F.lit(",".join(df.columns)))


# IO11 -------------------------------------------------------------------------------------------
def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Order-insensitive content hash: sum of 64-bit row hashes (as decimal, no overflow) + row count."""
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows"),
                  F.sum(h).cast("string").alias("fingerprint"))


def version_status(current: DataFrame, versions_path: str | None, spark: SparkSession) -> DataFrame:
    """Compare a one-row fingerprint with the last recorded version: new / unchanged / changed."""
    if versions_path is None:
        return current.withColumn("status", F.lit("new"))
    try:
        prev = spark.read.parquet(versions_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # no history yet is the only reason to call it new
            raise
        return current.withColumn("status", F.lit("new"))
    name = current.select("dataset").first()["dataset"]
    last = prev.where(F.col("dataset") == name).agg(
        F.max_by(F.struct(F.col("fingerprint").alias("last_fp"), F.col("n_rows").alias("last_rows")),
                 F.col("recorded_at")).alias("l")).select("l.*")
    j = attach(current, last)
    st = F.when(F.col("last_fp").isNull(), F.lit("new")).when(
        (F.col("last_fp") == F.col("fingerprint")) & (F.col("last_rows") == F.col("n_rows")),
        F.lit("unchanged")).otherwise(F.lit("changed"))
    return j.withColumn("status", st).drop("last_fp", "last_rows")


def record_version(fp: DataFrame, versions_path: str) -> None:
    write_table(fp.withColumn("recorded_at", F.current_timestamp()), versions_path, mode="append")


def row_digest(df: DataFrame, columns=None):
    """A number below 2^60 for each row: 15 hex digits of the md5 of its values as text, NULL apart from any text."""
    text = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (columns or df.columns)]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint_tree(df: DataFrame, partitions, columns=None) -> DataFrame:
    """The leaves: (partition..., file, bytes, modified, n_rows, digest) for every file that ``df`` reads.

    ``digest`` is the sum of the row digests, so it depends on neither the order nor the layout of the rows, and a
    parent's digest is the sum of its children's (``roll_up``). One aggregation, pre-summed in each task.
    """
    partitions = list(partitions)
    columns = list(columns or [c for c in df.columns if c not in partitions])
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("modified")]
    rows = df.select(*partitions, *meta, row_digest(df, columns).alias("_d"))
    return rows.groupBy(*partitions, "file", "bytes", "modified").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_d").alias("digest"))


def roll_up(leaves: DataFrame, level) -> DataFrame:
    """(level..., files, bytes, n_rows, digest): children summed to their parent; no columns: the whole data set."""
    return leaves.groupBy(*level).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"),
                                      F.sum("digest").alias("digest"))


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, bytes, modified) of the data files below ``path``, from the file system, without opening one."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                        F.col("_metadata.file_modification_time").alias("modified"))


def refresh_tree(spark: SparkSession, path: str, old: DataFrame, partitions, columns=None) -> tuple[DataFrame, int]:
    """The tree of the files as they are now, and how many of them were read: those that are new or differ in size or time.

    Only their names come to the driver, to be read.
    """
    now = file_listing(spark, path)
    same = now.join(old, ["file", "bytes", "modified"], "left_semi").select("file")
    fresh = [r["path"] for r in now.join(same, "file", "left_anti").select("path").collect()]
    kept = old.join(same, "file", "left_semi")
    if not fresh:
        return kept, 0
    read = fingerprint_tree(spark.read.option("basePath", path).parquet(*fresh), partitions, columns)
    return kept.unionByName(read), len(fresh)


def tree_status(old: DataFrame, new: DataFrame, partitions) -> DataFrame:
    """(partition..., n_rows, digest, status): new, changed, unchanged or removed, by content, not by files."""
    partitions = list(partitions)
    before = roll_up(old, partitions).select(*partitions, F.col("n_rows").alias("_rows"), F.col("digest").alias("_digest"), F.lit(True).alias("_old"))
    after = roll_up(new, partitions).select(*partitions, "n_rows", "digest", F.lit(True).alias("_new"))
    keys = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in partitions]
    on = None
    for c in partitions:
        same = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        on = same if on is None else on & same
    both = after.alias("a").join(before.alias("b"), on, "full_outer")
    status = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "removed").when(
        (F.col("n_rows") == F.col("_rows")) & (F.col("digest") == F.col("_digest")), "unchanged").otherwise("changed")
    return both.select(*keys, F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"), F.coalesce("digest", F.lit(0).cast("decimal(38,0)")).alias("digest"),
                       status.alias("status"))
