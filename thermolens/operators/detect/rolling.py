"""D1 rolling-sigma detector and D2, the domestic anomaly-period query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import DEFAULT_SERIES, Series, flag
from ..clean import filter_type
from ..timeseries import anomaly_periods, rolling_rows
from ..windows import DEFAULT_LAYOUT, Layout, checkpoint


def rolling_sigma(df: DataFrame, col: str = "avg", window: int = 24, k: float = 2.0,
                  out: str = "anomaly", s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT,
                  keep_stats: bool = False) -> DataFrame:
    """``|x - rolling_mean| > k * rolling_std`` over the trailing ``window`` rows
    (current row included, min_periods=1).  NULL std (first row) -> not flagged.
    Also emits ``<out>_ratio`` = ``|x - mean| / std``, usable as a score."""
    d = rolling_rows(df, col, window, ("mean", "std"), s, layout, prefix="_roll")
    dev = F.abs(F.col(col) - F.col("_roll_mean"))
    d = d.withColumns({
        out: flag(dev > F.lit(k) * F.col("_roll_std")),
        f"{out}_ratio": F.try_divide(dev, F.col("_roll_std")),
    })
    if keep_stats:
        return d.withColumnsRenamed({"_roll_mean": f"{col}_rolling_mean", "_roll_std": f"{col}_rolling_std"})
    return d.drop("_roll_mean", "_roll_std")


def find_anomaly_domestic(df: DataFrame, system_type: str | None = "domestic", window: int = 24, k: float = 2.0,
                          s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """D2 (flagship): type filter -> rolling sigma -> anomaly periods per series.

    Key, time and value go to the checkpoint folder first, because positions (chunk counts) and
    windows both read them: ``df`` is run once."""
    s = s.present(df)
    d = filter_type(df, system_type)
    d = checkpoint(d.select(*dict.fromkeys([*s.key, *s.order, "avg"])))
    d = rolling_sigma(d, "avg", window, k, "anomaly", s, layout)
    return anomaly_periods(d, "anomaly", s, layout).select(
        *[c for c in s.key if c in df.columns], "period_no", "start_ts", "end_ts", "n_rows",
        "start_weekday", "start_time", "end_weekday", "end_time")
