"""Composite feature tables X2 (labeler feature matrix) and X3 (exogenous features)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import (day_of_week, hour, hour_cos, hour_sin, is_peak, is_weekend, month,
                                  one_hot)
from ..functions.numeric import temperature_ratios
from ..schema import DEFAULT_SERIES, FEATURE_VALUE_COLS, Series, has
from .scaling import time_gap_features
from .timeseries import ffill_then_zero, rate_exprs, rolling_time_exprs
from .windows import DEFAULT_LAYOUT, Layout, by_length, checkpoint, range_over, rows_over, with_position

ID_COLS = ("timestamp", "type", "ID")


def feature_matrix(df: DataFrame, type_categories=("domestic",), hours=(1, 6, 24),
                   s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT,
                   gap_stats_by=(), materialize: bool = True, keep=()) -> DataFrame:
    """Base columns, calendar, type dummies, time-range rolling mean/std, weighted
    change, gap features, per-minute rates, temperature ratios, then forward fill
    and zero.  Keeps ``timestamp, type, ID`` and the columns in ``keep`` for row identity; ``feature_columns``
    lists the model inputs.

    Physical shape: the input is checkpointed (reliable storage, the session's checkpoint
    folder), because series lengths, gap statistics (exact median: a few aggregate passes) and the
    windows all read it.  Series of up to ``layout.block_rows`` rows (``by_length``) run all windows in
    one task each: one shuffle by series for rolling, lag-based and filled columns, no halo copies.
    Longer ones take the blocked layout: positions, one range-window stage, one row-window
    stage, whose table is checkpointed too, because the forward fill reads it twice (in-block
    fill and per-block carries).
    """
    vals = [c for c in FEATURE_VALUE_COLS if c in df.columns]
    gap = "time_diff_min" if "time_diff_min" in df.columns else None
    # rows without a time have no place in a series (see by_length); they count in no statistic either
    whole = df if layout.strategy == "series" else df.where(F.col(s.ts).isNotNull())
    if materialize:
        whole = checkpoint(whole)

    def build(d: DataFrame, lay: Layout) -> DataFrame:
        d = d.withColumns({"hour": hour(), "day_of_week": day_of_week(), "month": month(),
                           "is_weekend": is_weekend()})
        d = one_hot(d, "type", list(type_categories), dummy_na=True)
        blocked = lay.strategy != "series"
        if blocked:
            d = with_position(d, s, lay)
        d = time_gap_features(d, "time_diff_min", gap_stats_by, reference=whole)
        d = range_over(d, rolling_time_exprs(vals, hours), max(hours) * 3_600_000_000, s, lay)
        lag_exprs = rate_exprs(vals, gap, "weighted_change")
        if gap:
            lag_exprs.update(rate_exprs(vals, gap, "rate_per_min"))
        d = rows_over(d, lag_exprs, 1, s, lay)
        if has(d, "avg", "min_v", "max_v"):
            d = d.withColumns(temperature_ratios())
        cols = feature_columns(d, vals, hours)
        ids = [c for c in ID_COLS if c in d.columns]
        if blocked and materialize:
            d = checkpoint(d.select(*ids, *cols, *keep, *[c for c in d.columns if c.startswith(("_sk_", "_pos_"))]))
        return ffill_then_zero(d, cols, s, lay).select(*ids, *cols, *keep)

    return by_length(whole, build, s, layout)


def feature_columns(d: DataFrame, vals=None, hours=(1, 6, 24)) -> list[str]:
    """Model input columns of X2, in the reference's order."""
    vals = vals or [c for c in FEATURE_VALUE_COLS if c in d.columns]
    base = [c for c in ("avg", "min_v", "max_v", "nighttime", "time_diff_min", "T_diff") if c in d.columns]
    cal = ["hour", "day_of_week", "month", "is_weekend"]
    dummies = [c for c in d.columns if c.startswith("type_")]
    roll = []
    for c in vals:
        for h in hours:
            roll += [f"{c}_rolling_mean_{h}h", f"{c}_rolling_std_{h}h"]
        roll.append(f"{c}_weighted_change")
    gap = [c for c in ("time_diff_normalized", "time_diff_deviation", "time_diff_z_score") if c in d.columns]
    rate = [f"{c}_rate_per_min" for c in vals if f"{c}_rate_per_min" in d.columns]
    ratio = [c for c in ("avg_to_max_ratio", "avg_to_min_ratio", "range_to_avg_ratio",
                         "temp_range_normalized", "temp_stability") if c in d.columns]
    return [c for c in base + cal + dummies + roll + gap + rate + ratio if c in d.columns]


def exog_features(df: DataFrame, s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """hour_sin, hour_cos, is_weekend, is_night, is_peak, temp_lag_24h,
    temp_ma_24h (24-row mean, min_periods=1), forward filled then 0."""
    d = df.withColumns({
        "hour_sin": hour_sin(), "hour_cos": hour_cos(),
        "is_weekend": is_weekend().cast("long"),
        "is_night": F.col("nighttime").cast("long") if "nighttime" in df.columns else F.lit(0).cast("long"),
        "is_peak": is_peak(),
    })
    d = rows_over(d, {"temp_lag_24h": lambda w: F.lag("avg", 24).over(w),
                      "temp_ma_24h": lambda w: F.avg("avg").over(w.rowsBetween(-23, 0))}, 24, s, layout)
    cols = ["hour_sin", "hour_cos", "is_weekend", "is_night", "is_peak", "temp_lag_24h", "temp_ma_24h"]
    d = ffill_then_zero(d, cols, s, layout)
    return d.select(*[c for c in ID_COLS if c in d.columns], *cols)
