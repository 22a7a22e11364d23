"""Math helpers: safe division, temperature ratios (F9), rounding (F15), T_diff."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["EPS", "safe_div", "t_diff", "temperature_ratios", "round_to", "round_columns"]

# Fixed value: the reference's guard added to every denominator.
EPS = 1e-8


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL (not an ANSI error) on a zero denominator."""
    return F.try_divide(num, den)


def t_diff(max_v="max_v", min_v="min_v") -> Column:
    return F.col(max_v) - F.col(min_v)


def temperature_ratios() -> dict[str, Column]:
    """the five temperature ratio features."""
    avg, mn, mx, td = (F.col(c) for c in ("avg", "min_v", "max_v", "T_diff"))
    e = F.lit(EPS)
    return {
        "avg_to_max_ratio": safe_div(avg, mx + e),
        "avg_to_min_ratio": safe_div(avg, mn + e),
        "range_to_avg_ratio": safe_div(td, avg + e),
        "temp_range_normalized": safe_div(td, mx + e),
        "temp_stability": safe_div(F.lit(1.0), td + e),
    }


def round_to(c, digits: int = 3, half_even: bool = False) -> Column:
    """Round to ``digits`` decimals, deterministically across engines.

    A first rounding to 9 decimals removes last-bit noise from summation order;
    the second is ``round(x * 10^d) / 10^d`` on the binary value (half away from
    zero, or half to even like NumPy / pandas ``round`` when ``half_even``)."""
    c = F.col(c) if isinstance(c, str) else c
    m = float(10 ** digits)
    r9 = F.round(c, 9)
    r = F.bround(r9 * F.lit(m), 0) if half_even else F.round(r9 * F.lit(m), 0)
    exact = r / F.lit(m)
    # Spark rounds a double by way of its decimal text.  Away from a tie the first rounding (at most 5e-10) and the last bits of
    # c * m (below 2.5e-4 under 1e12) cannot change the nearest whole number, so plain arithmetic gives the same double.
    y = c * F.lit(m)
    k = F.rint(y)
    clear = (F.abs(y) < F.lit(1e12)) & (F.abs(F.abs(y - k) - F.lit(0.5)) > F.lit(max(2e-9 * m, 1e-3)))
    return F.when(clear, (k + F.lit(0.0)) / F.lit(m)).otherwise(exact)


# Columns from which round_columns goes by an array.
WIDE = 10


def round_columns(df: DataFrame, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """``round_to`` on several columns.  Many of them are rounded as elements of one array: written out per column, the
    generated code of a wide table is one method too long for the JVM's compiler, which then runs it uncompiled."""
    cols = list(cols)
    if len(cols) <= WIDE:
        return df.withColumns({c: round_to(c, digits) for c in cols})
    d = df.withColumn("_rounded", F.transform(F.array(*cols), lambda x: round_to(x, digits)))
    return d.withColumns({c: F.col("_rounded")[i] for i, c in enumerate(cols)}).drop("_rounded")
