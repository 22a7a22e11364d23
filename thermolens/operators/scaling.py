"""Aggregate-then-attach scalers F10-F14 and the shared quantile helper.

Every statistic is one aggregate (a partial, map-side combined job) whose one row
per group is attached back with ``attach_params``.  ddof is explicit in the name:
``std_samp`` (ddof 1) or ``std_pop`` (ddof 0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import EPS
from .joins import attach_params, join_null_safe


def quantile(col: str | Column, p, accuracy: int = 100_000) -> Column:
    """Approximate quantile aggregate (bounded sketch) for use inside ``agg``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.percentile_approx(c, p, accuracy)


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                   names: dict | None = None, approx: bool = False) -> DataFrame:
    """One row per group with a column per (column, probability), named
    ``names[(col, p)]`` (default ``{col}__q{per-mille}``, e.g. ``avg__q250``).  Exact by default (linear
    interpolation, = NumPy / DuckDB ``quantile_cont``) without buffering a group
    in one task (``quantiles.exact_quantiles``); ``approx`` uses the sketch."""
    by = list(by)
    names = names or {}
    nm = lambda c, p: names.get((c, p), f"{c}__q{round(p * 1000):03d}")
    if approx:
        return df.groupBy(*by).agg(*[quantile(c, p).alias(nm(c, p)) for c in cols for p in probs])
    from .quantiles import exact_quantiles
    u = df.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v"))
                                            for c in cols])).alias("_u")).select(*by, "_u._col", "_u._v")
    qn = [f"_q{i}" for i in range(len(probs))]
    q = exact_quantiles(u, "_v", probs, [*by, "_col"], qn)
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("_col") == c, F.col(qn[i]))).alias(nm(c, p))
                                for c in cols for i, p in enumerate(probs)])


def with_quantiles(aggs: DataFrame, qt: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Combine a grouped aggregate with its quantile table."""
    return join_null_safe(aggs, qt, by) if by else aggs.crossJoin(qt)


def time_gap_features(df: DataFrame, col: str = "time_diff_min", by: Sequence[str] = (),
                      approx: bool = False, reference: DataFrame | None = None) -> DataFrame:
    """gap / median, |gap - median|, |(gap - mean) / (std_samp + 1e-8)|; the statistics are those of
    ``reference`` (default ``df``)."""
    if col not in df.columns:
        return df
    ref = reference if reference is not None else df
    p = with_quantiles(ref.groupBy(*by).agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_std")),
                       quantile_table(ref, [col], [0.5], by, {(col, 0.5): "_med"}, approx), by)
    d = attach_params(df, p, by)
    g = F.col(col)
    return d.withColumns({
        "time_diff_normalized": F.try_divide(g, F.col("_med")),
        "time_diff_deviation": F.abs(g - F.col("_med")),
        "time_diff_z_score": F.abs(F.try_divide(g - F.col("_mean"), F.col("_std") + F.lit(EPS))),
    }).drop("_med", "_mean", "_std")


def fill_median(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """NULL -> median of the column."""
    cols = [c for c in cols if c in df.columns]
    p = quantile_table(df, cols, [0.5], by, {(c, 0.5): f"_med_{c}" for c in cols}, approx)
    d = attach_params(df, p, by)
    return d.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}")) for c in cols}) \
            .drop(*[f"_med_{c}" for c in cols])


def zscores(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), suffix: str = "_z",
            approx: bool = False) -> DataFrame:
    """|z| with population std on median-filled values; zero std -> NULL.

    Mean and variance of the filled column follow from the column's own moments, its
    median and its number of NULLs, so the filled column is not aggregated again."""
    cols = [c for c in cols if c in df.columns]
    med = quantile_table(df, cols, [0.5], by, {(c, 0.5): f"_med_{c}" for c in cols}, approx)
    moments = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[x for c in cols for x in (
        F.count(c).alias(f"_c_{c}"), F.avg(c).alias(f"_a_{c}"), F.var_pop(c).alias(f"_v_{c}"))])
    p = with_quantiles(moments, med, by)
    for c in cols:
        k, n, mid = F.col("_n") - F.col(f"_c_{c}"), F.col("_n"), F.col(f"_med_{c}")
        own, var = F.coalesce(F.col(f"_a_{c}"), mid), F.coalesce(F.col(f"_v_{c}"), F.lit(0.0))
        mean = F.when(k == 0, own).otherwise((F.col(f"_c_{c}") * own + k * mid) / n)
        p = p.withColumn(f"_m_{c}", mean)
        m = F.col(f"_m_{c}")
        filled = (F.col(f"_c_{c}") * (var + (own - m) * (own - m)) + k * (mid - m) * (mid - m)) / n
        p = p.withColumn(f"_s_{c}", F.sqrt(F.when(k == 0, var).otherwise(filled)))
    d = attach_params(df, p.select(*by, *[f"_{x}_{c}" for c in cols for x in ("med", "m", "s")]), by)
    out = {f"{c}{suffix}": F.abs(F.try_divide(F.coalesce(F.col(c), F.col(f"_med_{c}")) - F.col(f"_m_{c}"),
                                              F.col(f"_s_{c}"))) for c in cols}
    return d.withColumns(out).drop(*[f"_{k}_{c}" for c in cols for k in ("med", "m", "s")])


def standardize_fit(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """F13 fit: mean and population std per column; a constant column gets scale 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__sd")]
    p = df.groupBy(*by).agg(*aggs)
    return p.withColumns({f"{c}__scale": F.when(F.coalesce(F.col(f"{c}__sd"), F.lit(0.0)) == 0, F.lit(1.0))
                          .otherwise(F.col(f"{c}__sd")) for c in cols}).drop(*[f"{c}__sd" for c in cols])


def standardize(df: DataFrame, cols: Sequence[str], params: DataFrame | None = None,
                by: Sequence[str] = (), inverse: bool = False) -> DataFrame:
    """F13 transform (or inverse transform) with fitted or freshly fitted params."""
    cols = [c for c in cols if c in df.columns]
    params = params if params is not None else standardize_fit(df, cols, by)
    d = attach_params(df, params, by)
    if inverse:
        out = {c: F.col(c) * F.col(f"{c}__scale") + F.col(f"{c}__mean") for c in cols}
    else:
        out = {c: (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__scale") for c in cols}
    return d.withColumns(out).drop(*[f"{c}__{k}" for c in cols for k in ("mean", "scale")])


def minmax_fit(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[x for c in cols for x in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))])


def minmax_normalize(df: DataFrame, cols: Sequence[str], params: DataFrame | None = None,
                     by: Sequence[str] = (), suffix: str = "_norm") -> DataFrame:
    """(x - min) / (max - min) over the batch (or frozen ``params``);
    a constant column maps to 0."""
    params = params if params is not None else minmax_fit(df, cols, by)
    d = attach_params(df, params, by)
    out = {}
    for c in cols:
        lo, hi = F.col(f"{c}__min"), F.col(f"{c}__max")
        out[f"{c}{suffix}"] = F.when(hi == lo, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo))
    return d.withColumns(out).drop(*[f"{c}__{k}" for c in cols for k in ("min", "max")])
