"""Calendar functions F1-F8 and the night-time predicate P5."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import NIGHT_EDA, NIGHT_GENERATOR

__all__ = ["col_of", "hour", "month", "day_of_week", "is_weekend", "day_name", "date_of", "hhmm",
           "hour_sin", "hour_cos", "is_peak", "parse_timestamp", "minute_of_day", "nighttime",
           "NIGHT_PRESETS", "one_hot"]

NIGHT_PRESETS = {"eda": NIGHT_EDA, "generator": NIGHT_GENERATOR}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour(ts="timestamp") -> Column:
    return F.hour(col_of(ts)).cast("long")


def month(ts="timestamp") -> Column:
    return F.month(col_of(ts)).cast("long")


def day_of_week(ts="timestamp") -> Column:
    """Monday = 0 ... Sunday = 6 (pandas ``dayofweek``)."""
    return F.weekday(col_of(ts)).cast("long")


def is_weekend(ts="timestamp") -> Column:
    return F.weekday(col_of(ts)).isin(5, 6)


def day_name(ts="timestamp") -> Column:
    return F.date_format(col_of(ts), "EEEE")


def date_of(ts="timestamp") -> Column:
    return F.to_date(col_of(ts))


def hhmm(ts="timestamp") -> Column:
    return F.date_format(col_of(ts), "HH:mm")


def hour_sin(ts="timestamp") -> Column:
    return F.sin(F.lit(2 * math.pi) * F.hour(col_of(ts)) / 24)


def hour_cos(ts="timestamp") -> Column:
    return F.cos(F.lit(2 * math.pi) * F.hour(col_of(ts)) / 24)


def is_peak(ts="timestamp") -> Column:
    """Peak hours 7-9 or 19-21, both ends inclusive, as 0/1."""
    h = F.hour(col_of(ts))
    return (h.between(7, 9) | h.between(19, 21)).cast("long")


def parse_timestamp(c, fmt: str | None = None) -> Column:
    return F.to_timestamp_ntz(col_of(c), F.lit(fmt)) if fmt else F.to_timestamp_ntz(col_of(c))


def minute_of_day(ts="timestamp") -> Column:
    t = col_of(ts)
    return F.hour(t) * 60 + F.minute(t)


def nighttime(ts="timestamp", preset: str | tuple[int, int] = "eda") -> Column:
    """P5: wrap-around time-of-day window, start inclusive, end exclusive
    (minutes of day).  ``eda``: 22:00-04:00; ``generator``: hours 23..5."""
    start, end = NIGHT_PRESETS[preset] if isinstance(preset, str) else preset
    m = minute_of_day(ts)
    if start <= end:
        return (m >= start) & (m < end)
    return (m >= start) | (m < end)


def one_hot(df: DataFrame, col: str = "type", categories: Sequence[str] | None = None,
            dummy_na: bool = True, prefix: str | None = None, max_categories: int = 1000) -> DataFrame:
    """F8: ``get_dummies(dummy_na=True)`` with a fixed category list (no extra job).
    When ``categories`` is None they are taken from the data (one distinct job); more than
    ``max_categories`` raise an error, because each becomes a column."""
    prefix = prefix or col
    if col not in df.columns:
        return df
    if categories is None:
        found = df.select(col).distinct().where(F.col(col).isNotNull()).limit(max_categories + 1).collect()
        if len(found) > max_categories:
            raise ValueError(f"{col} has more than {max_categories} categories")
        categories = sorted(r[0] for r in found)
    out = {f"{prefix}_{v}": (F.col(col) == F.lit(v)) & F.col(col).isNotNull() for v in categories}
    out = {k: F.coalesce(v, F.lit(False)) for k, v in out.items()}
    if dummy_na:
        out[f"{prefix}_nan"] = F.col(col).isNull()
    return df.withColumns(out)
