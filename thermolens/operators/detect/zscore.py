"""D3: z-score detector over several columns (any column beyond the threshold)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import FEATURE_VALUE_COLS, flag
from ..scaling import zscores


def zscore_any(df: DataFrame, cols: Sequence[str] = FEATURE_VALUE_COLS, threshold: float = 3.0,
               by: Sequence[str] = (), out: str = "statistical_anomaly", keep_z: bool = False,
               approx: bool = False) -> DataFrame:
    """Median-fill each column, |z| with population std over the frame (or per
    ``by`` group), flag when any |z| > threshold.  Zero std never flags."""
    cols = [c for c in cols if c in df.columns]
    d = zscores(df, cols, by, approx=approx)
    any_flag = F.lit(False)
    for c in cols:
        any_flag = any_flag | flag(F.col(f"{c}_z") > threshold)
    d = d.withColumn(out, any_flag)
    return d if keep_z else d.drop(*[f"{c}_z" for c in cols])
