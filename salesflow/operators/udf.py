"""User-function hooks (X1 lives in models.score_with_python; X2 here).

A per-group pandas function must never receive a whole group: a group can
hold a third of the data. ``apply_in_groups`` hands it ordered pieces of at
most ``chunk_rows + halo`` rows - a chunk of the group's ordered row index plus
the ``halo`` rows before it - so functions whose look-back is at most ``halo``
rows (rolling statistics, lags, differences) give exactly the whole-group
result while the work spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.operators.windows import _chunked


def apply_in_groups(df: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], group, order, halo: int,
                    chunk_rows: int = 1_000_000, out_col: str = "value",
                    out_type: T.DataType = T.DoubleType()) -> DataFrame:
    """Adds ``out_col`` = fn(rows of the group in order), computed on bounded pieces."""
    group, order = list(group), list(order)
    base = _chunked(df, group, order, halo, chunk_rows)
    schema = T.StructType(base.schema.fields + [T.StructField(out_col, out_type)])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_ri", kind="stable").reset_index(drop=True)
        pdf[out_col] = pd.Series(fn(pdf)).to_numpy()
        return pdf

    out = base.groupBy(*group, "_chunk").applyInPandas(run, schema)
    return out.where(~F.col("_halo")).drop("_chunk", "_halo", "_ri")
