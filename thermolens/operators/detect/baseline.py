"""Statistical baseline detector (z-score + IQR fence) fitted on normal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import flag
from ..clean import normal_only
from ..joins import attach_params
from ..scaling import quantile_table, with_quantiles


def baseline_fit(df: DataFrame, col: str = "avg", label: str | None = None, by: Sequence[str] = (),
                 z_threshold: float = 3.0, iqr_multiplier: float = 1.5, approx: bool = False) -> DataFrame:
    """Mean, population std, q1, q3, iqr of ``col`` on rows with label 0 (all
    rows without a label), plus the two thresholds: a params table, one row per
    group."""
    d = normal_only(df, label)
    p = with_quantiles(d.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std")),
                       quantile_table(d, [col], [0.25, 0.75], by, {(col, 0.25): "q1", (col, 0.75): "q3"}, approx), by)
    return p.withColumns({"iqr": F.col("q3") - F.col("q1"),
                          "z_threshold": F.lit(float(z_threshold)),
                          "iqr_multiplier": F.lit(float(iqr_multiplier))})


PARAM_COLS = ("mean", "std", "q1", "q3", "iqr", "z_threshold", "iqr_multiplier")


def _with_params(df, params, by):
    return attach_params(df, params.select(*by, *[F.col(c).alias(f"_b_{c}") for c in PARAM_COLS]), by)


def _z(col):
    return F.abs(F.try_divide(F.col(col) - F.col("_b_mean"), F.col("_b_std")))


def _iqr_out(col):
    lo = F.col("_b_q1") - F.col("_b_iqr_multiplier") * F.col("_b_iqr")
    hi = F.col("_b_q3") + F.col("_b_iqr_multiplier") * F.col("_b_iqr")
    return flag((F.col(col) < lo) | (F.col(col) > hi))


def baseline_score(df: DataFrame, params: DataFrame, col: str = "avg", by: Sequence[str] = (),
                   out: str = "statistical_score") -> DataFrame:
    """``|z| / z_threshold + (IQR outlier ? 1 : 0)``."""
    d = _with_params(df, params, by)
    d = d.withColumn(out, _z(col) / F.col("_b_z_threshold") + _iqr_out(col).cast("double"))
    return d.drop(*[f"_b_{c}" for c in PARAM_COLS])


def baseline_predict(df: DataFrame, params: DataFrame, col: str = "avg", by: Sequence[str] = (),
                     out: str = "statistical", score_out: str | None = None) -> DataFrame:
    """``|z| > z_threshold OR outside the IQR fence`` (strict), as 0/1."""
    d = _with_params(df, params, by)
    d = d.withColumn(out, (flag(_z(col) > F.col("_b_z_threshold")) | _iqr_out(col)).cast("int"))
    if score_out:
        d = d.withColumn(score_out, _z(col) / F.col("_b_z_threshold") + _iqr_out(col).cast("double"))
    return d.drop(*[f"_b_{c}" for c in PARAM_COLS])
