"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.exprs import rnd
from salesflow.sources import fixtures as fx


def rounded(df: DataFrame, digits: int = 6, cols=None, money=()) -> DataFrame:
    """Round double columns (``money`` columns to 2 dp) and clear -0.0 for stable hashes."""
    types = dict(df.dtypes)
    cols = [c for c in (cols or df.columns) if types.get(c) in ("double", "float")]
    return df.select(*[rnd(c, 2 if c in money else digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def rsql(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


def sales(spark, sf_dir, columns=None) -> DataFrame:
    return fx.sales(spark, sf_dir, columns)


def sales_sql() -> str:
    return fx.sales_sql()


def max_scalar(df: DataFrame, col: str):
    """max(col) as a scalar subquery (evaluated once, then a literal for the outer plan)."""
    return df.select(F.max(col)).scalar()


def max_literal(df: DataFrame, col: str):
    """max(col) resolved first (a one-column aggregate) and returned as a typed literal.

    Used for time-window filters: a literal bound is pushed into the parquet
    scan (row-group skipping on min/max statistics), a subquery bound is not.
    """
    dtype = dict(df.dtypes)[col]
    value = df.agg(F.max(col)).collect()[0][0]
    return F.lit(value).cast(dtype)


def null_every(col: str, key: str, modulus: int):
    """Deterministic missing values: NULL where key % modulus = 0 (FIXTURES.md §2)."""
    return F.when(F.pmod(F.col(key), F.lit(modulus)) == 0, F.lit(None)).otherwise(F.col(col))


def null_every_sql(col: str, key: str, modulus: int) -> str:
    return f"CASE WHEN {key} % {modulus} = 0 THEN NULL ELSE {col} END"


def sig(col, digits: int = 9):
    """Round to ``digits`` significant digits (for values that span many magnitudes, e.g. MAPE
    with zero actuals, where fixed decimals would keep summation-order noise)."""
    x = F.col(col) if isinstance(col, str) else col
    e = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
    return F.when((x == 0) | x.isNull(), x).otherwise(F.round(x / e, digits - 1) * e) + F.lit(0.0)


def sig_sql(expr: str, digits: int = 9) -> str:
    e = f"pow(10.0, floor(log10(abs({expr}))))"
    return f"(CASE WHEN ({expr}) = 0 OR ({expr}) IS NULL THEN ({expr}) ELSE round(({expr}) / {e}, {digits - 1}) * {e} END + 0.0)"


def spool(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several passes read some columns of to the scratch folder as parquet.

    The joins of the view run once, and every pass reads the columns it needs only.
    """
    from salesflow.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame that several passes will read to the shared checkpoint folder.

    Used by multi-pass reports over the joined ``sales`` view: the joins run
    once instead of once per pass, and the lineage is cut (a reliable
    checkpoint survives executor loss).
    """
    from salesflow.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
