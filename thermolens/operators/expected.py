"""R2: expected-value residual detector ("compare expected values with actual
values"): per series, ``avg`` is regressed on its lag-1 value and four calendar
regressors (hour_sin, hour_cos, is_weekend, is_night) by least squares.

* fit: the normal equations are sums of cross products -- one partial aggregate
  per series (map-side combined, so a hot series costs no more than a cold one).
  Values and regressors are taken to six decimals and summed as decimals, so the
  sums are exact and do not depend on the order of rows;
* solve: the symmetric 6 x 6 system of each series by elimination in column
  expressions, on a table of **one row per series**.  A regressor whose pivot has
  fallen below ``PIVOT`` of its own sum of squares adds nothing to those before it
  (a constant night flag, say) and gets coefficient 0;
* score: expected value, residual, residual sigma per series (aggregate) and
  ``|residual| > k * sigma``.
Differencing and the moving-average term of the reference's simulator are not
modelled (stated deviation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import hour_cos, hour_sin, is_weekend
from ..schema import DEFAULT_SERIES, Series, flag
from .joins import attach_params
from .timeseries import lag_rows
from .windows import DEFAULT_LAYOUT, Layout

PIVOT = 1e-9
REGRESSORS = ("one", "lag1", "hour_sin", "hour_cos", "is_weekend", "is_night")


def design(df: DataFrame, s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    d = lag_rows(df, "avg", 1, "lag1", s, layout)
    return d.withColumns({
        "one": F.lit(1.0), "hour_sin": hour_sin(), "hour_cos": hour_cos(),
        "is_weekend": is_weekend().cast("double"),
        "is_night": F.col("nighttime").cast("double") if "nighttime" in df.columns else F.lit(0.0)})


def _exact(c: str) -> Column:
    """A value in millionths, rounded."""
    return F.round(F.col(c) * F.lit(1_000_000.0), 0).cast("decimal(18,0)")


def _product_sum(a: str, b: str) -> Column:
    return F.sum(_exact(a) * _exact(b)).cast("double") / F.lit(1e12)


def solved(equations: DataFrame, k: int) -> DataFrame:
    """``equations`` (one symmetric system per row: ``xx_i_j`` for i <= j, ``xy_i``) plus the solution ``x_0`` .. ``x_k-1``.

    One projection per elimination step; Spark keeps them apart because each value is used several times.
    """
    d = equations.withColumns({f"_s_{i}": F.col(f"xx_{i}_{i}") for i in range(k)})
    for p in range(k):
        pivot = F.col(f"xx_{p}_{p}")
        d = d.withColumn(f"_use_{p}", (pivot > F.lit(PIVOT) * F.col(f"_s_{p}")) & (pivot > 0))
        d = d.withColumns({f"_f_{i}": F.when(F.col(f"_use_{p}"), F.col(f"xx_{p}_{i}") / pivot).otherwise(F.lit(0.0))
                           for i in range(p + 1, k)})
        d = d.withColumns({
            **{f"xx_{i}_{j}": F.col(f"xx_{i}_{j}") - F.col(f"_f_{i}") * F.col(f"xx_{p}_{j}")
               for i in range(p + 1, k) for j in range(i, k)},
            **{f"xy_{i}": F.col(f"xy_{i}") - F.col(f"_f_{i}") * F.col(f"xy_{p}") for i in range(p + 1, k)}})
    for p in range(k - 1, -1, -1):
        rest = F.col(f"xy_{p}")
        for j in range(p + 1, k):
            rest = rest - F.col(f"xx_{p}_{j}") * F.col(f"x_{j}")
        d = d.withColumn(f"x_{p}", F.when(F.col(f"_use_{p}"), rest / F.col(f"xx_{p}_{p}")).otherwise(F.lit(0.0)))
    return d.drop(*[f"{c}_{i}" for c in ("_s", "_use", "_f") for i in range(k)])


def fit_expected(df: DataFrame, s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Coefficients ``b_<regressor>`` per series (rows with a lag and a value)."""
    s = s.present(df)
    d = design(df, s, layout).where(F.col("lag1").isNotNull() & F.col("avg").isNotNull())
    k = len(REGRESSORS)
    aggs = [_product_sum(REGRESSORS[i], REGRESSORS[j]).alias(f"xx_{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs += [_product_sum(REGRESSORS[i], "avg").alias(f"xy_{i}") for i in range(k)]
    d = solved(d.groupBy(*s.key).agg(*aggs), k)
    return d.select(*s.key, *[F.col(f"x_{i}").alias(f"b_{r}") for i, r in enumerate(REGRESSORS)])


def expected_residual(df: DataFrame, coef: DataFrame, k: float = 3.0, s: Series = DEFAULT_SERIES,
                      layout: Layout = DEFAULT_LAYOUT, out: str = "expected_anomaly") -> DataFrame:
    """Expected value, residual and ``|residual| > k * sigma`` (sigma = residual
    std of the series over the scored rows)."""
    s = s.present(df)
    d = attach_params(design(df, s, layout), coef, list(s.key))
    pred = sum((F.col(f"b_{r}") * F.col(r) for r in REGRESSORS), F.lit(0.0))
    d = d.withColumn("expected", F.when(F.col("lag1").isNotNull(), pred)).withColumn("residual", F.col("avg") - F.col("expected"))
    sig = d.groupBy(*s.key).agg(F.stddev_samp("residual").alias("_sig"))
    d = attach_params(d, sig, list(s.key))
    d = d.withColumn(out, flag(F.abs(F.col("residual")) > F.lit(k) * F.col("_sig")))
    return d.drop("_sig", "one", "lag1", "hour_sin", "hour_cos", "is_weekend", "is_night", *[f"b_{r}" for r in REGRESSORS])
