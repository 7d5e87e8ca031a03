"""Preprocessing fit / transform operators.

Fit steps run one aggregation job and keep only small state on the driver
(a mean and a std per column, a sorted category domain, two fences); that
state can be saved as a one-row-per-entry parquet table and reloaded.
Transforms are lazy column expressions.
"""

from __future__ import annotations

import datetime
import decimal
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.exprs import nan_to_null
from salesflow.operators.blocks import exact_quantiles, label_from_rank, maybe_broadcast, quantile_columns, row_index

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [c for c, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and c not in exclude]


# T1 / T2 -------------------------------------------------------------------------------------
def split(df: DataFrame, order_by, test_size: float = 0.2, shuffle: bool = False, seed: int = 42,
          key=None, name: str = "split", draw: Column | None = None) -> DataFrame:
    """Adds ``split`` in {train, test}: the last ceil(n * test_size) rows are test.

    Chronological: order by ``order_by`` (must be total). Shuffled: order by ``draw``, by default
    a seeded hash of ``key`` (exact sizes, deterministic, not the same draw as
    scikit-learn). ``test_size`` 0 or None means the default 0.2.

    The first test row is found by distributed selection (``blocks.row_at_rank``) and the rows are
    labelled by comparing them with it: they are neither sorted nor shuffled nor copied.
    """
    test_size = test_size or 0.2
    order = list(order_by)
    base = df
    if shuffle:
        keys = list(key or order)
        base = df.withColumn("_sf_h", draw if draw is not None else F.xxhash64(F.lit(seed), *keys))
        order = ["_sf_h"] + keys
    n = df.count()
    n_test = math.ceil(n * float(test_size))
    return label_from_rank(base, order, n - n_test, n, name, "train", "test").drop("_sf_h")


# T3 ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Scaler:
    columns: tuple
    means: tuple
    stds: tuple

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {c: ((F.col(c) - F.lit(m)) / F.lit(s)).alias(c)
                 for c, m, s in zip(self.columns, self.means, self.stds)}
        return df.select(*[exprs.get(c, F.col(c)) for c in df.columns])

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(zip(self.columns, self.means, self.stds)),
                                     "column string, mean double, std double")

    @staticmethod
    def from_df(df: DataFrame) -> Scaler:
        rows = df.orderBy("column").collect()
        return Scaler(tuple(r["column"] for r in rows), tuple(r["mean"] for r in rows),
                      tuple(r["std"] for r in rows))


def fit_scaler(df: DataFrame, cols=None) -> Scaler:
    """Population std (scikit-learn StandardScaler); std 0 or undefined -> 1; NaN counts as missing."""
    cols = list(cols or numeric_columns(df))
    x = {c: nan_to_null(F.col(c).cast("double")) for c in cols}
    row = df.agg(*[F.avg(x[c]).alias(f"m_{c}") for c in cols],
                 *[F.stddev_pop(x[c]).alias(f"s_{c}") for c in cols]).collect()[0]
    stds = tuple(1.0 if not row[f"s_{c}"] else float(row[f"s_{c}"]) for c in cols)
    means = tuple(float(row[f"m_{c}"]) if row[f"m_{c}"] is not None else 0.0 for c in cols)
    return Scaler(tuple(cols), means, stds)


# T4 / T5 ------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Encoder:
    """Fitted domains. One-hot keeps each column's levels (they are the output columns);
    label codes are a (value, code) table for each column, joined on the value."""

    method: str
    classes: dict = field(default_factory=dict)  # one-hot: column -> sorted tuple of values
    unseen: str = "error"
    tables: dict = field(default_factory=dict)  # label: column -> DataFrame(value, code)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, values in self.classes.items():
            # drop the first level; NULL and unseen values -> all zeros
            new = [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
                   for v in values[1:]]
            keep = [x for x in out.columns if x != c]
            out = out.select(*keep, *new)
        for c, table in self.tables.items():
            t = table.select(F.col("value").alias("_sf_v"), F.col("code").alias("_sf_code"))
            j = out.join(maybe_broadcast(t, t.count()), F.col(c).cast("string") == F.col("_sf_v"), "left")
            out = j.withColumn(c, self._check(c, F.col("_sf_code")).cast("int")).drop("_sf_v", "_sf_code")
        return out

    def _check(self, c, code):
        if self.unseen != "error":
            return code
        return F.when(F.col(c).isNull() | code.isNotNull(), code).otherwise(
            F.raise_error(F.concat(F.lit(f"unseen label in {c}: "), F.col(c).cast("string"))))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """(method, unseen, column, value, code) rows; ``from_df`` reads them back."""
        rows = [(c, v, i) for c, vs in self.classes.items() for i, v in enumerate(vs)]
        out = spark.createDataFrame(rows, "column string, value string, code int")
        for c, t in self.tables.items():
            out = out.unionByName(t.select(F.lit(c).alias("column"), "value", F.col("code").cast("int")))
        return out.select(F.lit(self.method).alias("method"), F.lit(self.unseen).alias("unseen"), "column", "value", "code")

    @staticmethod
    def from_df(df: DataFrame) -> Encoder:
        heads = df.select("method", "unseen", "column").distinct().collect()  # one row for each column
        if not heads:
            return Encoder("label")
        method, unseen = heads[0]["method"], heads[0]["unseen"]
        cols = sorted(r["column"] for r in heads)
        if method == "onehot":
            rows = df.orderBy("column", "code").collect()
            return Encoder(method, {c: tuple(r["value"] for r in rows if r["column"] == c) for c in cols}, unseen)
        return Encoder(method, {}, unseen, {c: df.where(F.col("column") == c).select("value", "code") for c in cols})


def categorical_columns(df: DataFrame, exclude=()) -> list[str]:
    return [c for c, t in df.dtypes if t == "string" and c not in exclude]


def fit_encoder(df: DataFrame, cols=None, method: str = "onehot", unseen: str = "error") -> Encoder:
    """Sorted distinct domain per categorical column (default: every string column).

    Label codes stay a distributed (value, code) table at every size, numbered by the
    row-index block. A one-hot encoder has an output column for each level but the
    first, so its levels are column names of the plan and are read by the driver.
    """
    cols = list(cols if cols is not None else categorical_columns(df))
    if method == "onehot":
        long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
        dom = long.where(F.col("value").isNotNull()).distinct().collect()
        return Encoder(method, {c: tuple(sorted(r["value"] for r in dom if r["column"] == c)) for c in cols}, unseen)
    tables = {}
    for c in cols:
        distinct = df.select(F.col(c).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
        tables[c] = row_index(distinct, ["value"], name="code").checkpoint(eager=True)
    return Encoder(method, {}, unseen, tables)


# T6 / T7 ------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Imputer:
    strategy: str
    values: dict

    def transform(self, df: DataFrame) -> DataFrame:
        if self.strategy == "drop":
            return df.dropna()
        if not self.values:
            return df
        return df.fillna(self.values)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """(strategy, column, type, value) rows; ``from_df`` reads them back."""
        rows = [(self.strategy, c, type(v).__name__, str(v)) for c, v in self.values.items()] or [(self.strategy, None, None, None)]
        return spark.createDataFrame(rows, "strategy string, column string, type string, value string")

    @staticmethod
    def from_df(df: DataFrame) -> Imputer:
        read = {"int": int, "float": float, "bool": lambda v: v == "True", "str": str,
                "date": datetime.date.fromisoformat, "datetime": datetime.datetime.fromisoformat, "Decimal": decimal.Decimal}
        rows = df.collect()  # one row for each column
        return Imputer(rows[0]["strategy"], {r["column"]: read[r["type"]](r["value"]) for r in rows if r["column"] is not None})


def fit_imputer(df: DataFrame, strategy: str = "drop", fill_value=None, cols=None) -> Imputer:
    if strategy == "drop":
        return Imputer("drop", {})
    if strategy == "constant":
        if fill_value is None:
            raise ValueError("strategy 'constant' needs a fill_value")
        return Imputer("constant", {c: fill_value for c in (cols or df.columns)})
    if strategy in ("mean", "median"):
        cols = list(cols or numeric_columns(df))
        if strategy == "mean":
            row = df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in cols]).collect()[0].asDict()
        else:
            qs = quantile_columns(df, cols, [0.5], ["median"]).collect()
            row = {r["column"]: r["median"] for r in qs}
        return Imputer(strategy, {c: _cast_like(df, c, v) for c, v in row.items() if v is not None})
    if strategy == "mode":
        cols = list(cols or df.columns)
        vals = {}
        for c in cols:
            present = F.col(c).isNotNull() & ~F.isnan(c) if dict(df.dtypes)[c] in ("double", "float") else F.col(c).isNotNull()
            counts = df.where(present).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
            best = counts.agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias("m")).collect()[0]["m"]
            if best is not None:
                vals[c] = best
        return Imputer("mode", vals)
    raise ValueError(f"Unknown strategy: {strategy}")


def _cast_like(df, c, v):
    t = dict(df.dtypes)[c]
    return int(round(v)) if t in ("int", "bigint", "smallint", "tinyint") else float(v)


def drop_missing(df: DataFrame, subset=None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


# T8 / T9 ------------------------------------------------------------------------------------------
def outlier_fences(df: DataFrame, cols, method: str = "iqr", threshold: float = 3.0,
                   mode: str = "sequential") -> list[tuple[str, float, float, bool]]:
    """Fit fences per column: (column, lo, hi, inclusive).

    sequential: column k's statistics are computed on the rows that survived
    columns 1..k-1 (the reference semantics). Each pass is one lazy scan with
    the previous fences as pushed-down predicates, so nothing is cached.
    joint: all statistics from the unfiltered input in one pass.
    """
    fences = []
    cur = df
    for c in cols:
        src = cur if mode == "sequential" else df
        if method == "iqr":
            q = exact_quantiles(src.select(nan_to_null(F.col(c).cast("double")).alias("v")), [], "v", (0.25, 0.75)).collect()
            qd = {r["p"]: r["q"] for r in q}
            if 0.25 not in qd:
                lo = hi = float("nan")
            else:
                iqr = qd[0.75] - qd[0.25]
                lo, hi = qd[0.25] - threshold * iqr, qd[0.75] + threshold * iqr
            fences.append((c, lo, hi, True))
        elif method == "zscore":
            x = nan_to_null(F.col(c).cast("double"))
            r = src.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).collect()[0]
            m, s = r["m"], r["s"]
            if m is None or not s:
                lo = hi = float("nan")
            else:
                lo, hi = m - threshold * s, m + threshold * s
            fences.append((c, lo, hi, False))
        else:
            raise ValueError(f"unknown method {method}")
        cur = apply_fences(cur, [fences[-1]])
    return fences


def apply_fences(df: DataFrame, fences) -> DataFrame:
    """Keep rows inside every fence; NULL / NaN values are dropped (comparisons are false)."""
    out = df
    for c, lo, hi, inclusive in fences:
        if math.isnan(lo) or math.isnan(hi):
            out = out.where(F.lit(False))
            continue
        x = F.col(c).cast("double")
        cond = (x >= lo) & (x <= hi) if inclusive else (x > lo) & (x < hi)
        out = out.where(cond & ~F.isnan(x))
    return out


def remove_outliers(df: DataFrame, cols, method: str = "iqr", threshold: float = 3.0,
                    mode: str = "sequential") -> DataFrame:
    return apply_fences(df, outlier_fences(df, cols, method, threshold, mode))


# T10 --------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Preprocessor:
    imputer: Imputer
    encoder: Encoder | None
    scaler: Scaler

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.imputer.transform(df)
        if self.encoder is not None:
            out = self.encoder.transform(out)
        return self.scaler.transform(out)

    def save(self, spark: SparkSession, path: str) -> None:
        """One parquet table for each fitted part, in ``path``."""
        self.imputer.to_df(spark).write.mode("overwrite").parquet(f"{path}/imputer")
        self.scaler.to_df(spark).write.mode("overwrite").parquet(f"{path}/scaler")
        (self.encoder or Encoder("label")).to_df(spark).write.mode("overwrite").parquet(f"{path}/encoder")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preprocessor:
        encoder = Encoder.from_df(spark.read.parquet(f"{path}/encoder"))
        return Preprocessor(Imputer.from_df(spark.read.parquet(f"{path}/imputer")),
                            encoder if encoder.classes or encoder.tables else None, Scaler.from_df(spark.read.parquet(f"{path}/scaler")))


def preprocess(df: DataFrame, order_by, target: str, categorical=(), numeric=None,
               missing: str = "drop", encode: str = "label", test_size: float = 0.2,
               outliers: tuple | None = None):
    """missing -> encode -> split -> scale (fit on train rows only) [-> outliers on train].

    Returns (Preprocessor, DataFrame with ``split``)."""
    imp = fit_imputer(df, missing)
    clean = imp.transform(df)
    enc = fit_encoder(clean, categorical, encode) if categorical else None
    encoded = enc.transform(clean) if enc else clean
    with_split = split(encoded, order_by, test_size)
    num = list(numeric or [c for c in numeric_columns(encoded) if c != target])
    scaler = fit_scaler(with_split.where(F.col("split") == "train"), num)
    out = scaler.transform(with_split)
    if outliers:
        method, thr = outliers
        fences = outlier_fences(out.where(F.col("split") == "train"), num, method, thr)
        out = out.where((F.col("split") != "train")).unionByName(
            apply_fences(out.where(F.col("split") == "train"), fences))
    return Preprocessor(imp, enc, scaler), out
