"""Scalar column expressions (S1-S8). All JVM-side, all codegen-able."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Meteorological season names indexed by (month % 12) // 3.
SEASONS = ("Winter", "Spring", "Summer", "Fall")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- S1 calendar parts -------------------------------------------------------------
def time_parts(date) -> dict[str, Column]:
    """year, month, day, day_of_week (Mon=0), day_of_year, week_of_year (ISO), quarter."""
    d = _c(date)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "quarter": F.quarter(d),
    }


# ---- S2 calendar flags as 0/1 ---------------------------------------------------------
def calendar_flags(date) -> dict[str, Column]:
    d = F.to_date(_c(date))
    q_start = F.trunc(d, "quarter")
    return {
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
        "is_quarter_start": (d == q_start).cast("int"),
        "is_quarter_end": (d == F.date_sub(F.add_months(q_start, 3), 1)).cast("int"),
    }


# ---- S3 season ------------------------------------------------------------------------------
def season(month) -> Column:
    idx = (F.pmod(_c(month), F.lit(12)) / 3).cast("int") + 1
    return F.element_at(F.array(*[F.lit(s) for s in SEASONS]), idx)


# ---- S4 cyclic encodings ----------------------------------------------------------------------
def cyclic(value, period: int) -> tuple[Column, Column]:
    ang = F.lit(2 * math.pi) * _c(value) / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


# ---- S5 safe division ----------------------------------------------------------------------
def safe_div(a, b, default=0.0) -> Column:
    return F.coalesce(F.try_divide(_c(a), _c(b)), F.lit(default))


# ---- S6 differences --------------------------------------------------------------------
def days_between(end, start) -> Column:
    return F.datediff(_c(end), _c(start))


def hours_since(ts, as_of) -> Column:
    return F.timestamp_diff("HOUR", _c(ts), _c(as_of))


# ---- S7 strings / lists ----------------------------------------------------------------------
def non_blank(s) -> Column:
    return F.coalesce(F.length(F.trim(_c(s))) > 0, F.lit(False))


def join_list(arr, sep: str = ",") -> Column:
    return F.array_join(_c(arr), sep)


def split_list(s, sep: str = ",") -> Column:
    return F.when(_c(s).isNull() | (_c(s) == ""), F.array().cast("array<string>")).otherwise(
        F.split(_c(s), sep))


# ---- S8 numeric helpers -------------------------------------------------------------------
def clip(x, lo=None, hi=None) -> Column:
    out = _c(x)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def nan_to_null(x) -> Column:
    """pandas treats NaN as missing; Spark does not. Normalise on entry."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def rnd(x, digits: int = 6) -> Column:
    """Round and clear negative zero so hashes agree with the oracle."""
    return F.round(_c(x), digits) + F.lit(0.0)
