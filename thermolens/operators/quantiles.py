"""Exact quantiles without buffering a group in one task.

Spark's exact ``percentile`` aggregate keeps every distinct value of a group in
one buffer, so a global (or hot-group) quantile at scale lands in one task.
Here the exact linear-interpolated quantile (NumPy default, DuckDB
``quantile_cont``) is computed in bounded pieces:

1. one aggregate per group: the row count and a ``percentile_approx`` sketch
   (bounded memory, rank error <= n / accuracy) read at ``p -/+ 3 / accuracy``:
   two values that bracket the target ranks;
2. in one more pass rows inside the bracket are collapsed to (value, count) -- a hot
   value is one row -- and the rows below and above it to one row each;
3. a running count over those rows (about ``6 n / accuracy`` distinct values per group
   at most) finds the values at ranks ``floor(h)`` and ``floor(h) + 1``,
   ``h = p (n - 1)``, which are interpolated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe

ACCURACY = 1_000_000


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: ``by`` columns + one column per probability."""
    by = list(by)
    names = list(names or [f"q_{p}" for p in probs])
    eps = 3.0 / accuracy
    x = F.col(col).cast("double")
    d = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    lo_p = [max(0.0, p - eps) for p in probs]
    hi_p = [min(1.0, p + eps) for p in probs]
    stats = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"),
                               F.percentile_approx("_x", lo_p + hi_p, accuracy).alias("_ap"))
    k = len(probs)
    # per group and probability: bracket [lo, hi] and the two target ranks (0-based)
    br = stats.select(*by, "_n", F.explode(F.arrays_zip(
        F.array(*[F.lit(i) for i in range(k)]).alias("i"),
        F.slice("_ap", 1, k).alias("lo"), F.slice("_ap", k + 1, k).alias("hi"),
        F.array(*[F.lit(float(p)) for p in probs]).alias("p"))).alias("_b"))
    br = br.select(*by, "_n", F.col("_b.i").alias("_i"), F.col("_b.lo").alias("_lo"),
                   F.col("_b.hi").alias("_hi"), (F.col("_b.p") * (F.col("_n") - 1)).alias("_h"))
    # one row per group and probability: at most ``groups * len(probs)`` rows; AQE decides broadcast
    j = join_null_safe(d, br, by) if by else d.crossJoin(F.broadcast(br))
    x_ = F.col("_x")
    # one pass: each value inside the bracket with its count; everything below it, and
    # everything above, as one row with the value nearest to the bracket (the sketch
    # returns actual elements, so for small groups a target rank can sit one element outside)
    side = F.when(x_ < F.col("_lo"), -1).when(x_ > F.col("_hi"), 1).otherwise(0)
    g = j.groupBy(*by, "_i", "_h", side.alias("_side"), F.when(side == 0, x_).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"), F.max("_x").alias("_mx"), F.min("_x").alias("_mn"))
    w = Window.partitionBy(*by, "_i").orderBy("_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumns({
        "_cum": F.sum("_c").over(w),
        "_e": F.when(F.col("_side") < 0, F.col("_mx")).when(F.col("_side") > 0, F.col("_mn")).otherwise(F.col("_v"))})
    # value at 0-based rank r: that of the first row whose running count exceeds r
    r0 = F.floor(F.col("_h"))
    at = lambda r: F.min_by("_e", F.when(F.col("_cum") > r, F.col("_cum")))
    v = g.groupBy(*by, "_i", "_h").agg(at(r0).alias("_v0"), at(r0 + 1).alias("_v1"))
    frac = F.col("_h") - F.floor(F.col("_h"))
    v = v.withColumn("_q", F.when(frac == 0, F.col("_v0"))
                     .otherwise(F.col("_v0") + (F.coalesce(F.col("_v1"), F.col("_v0")) - F.col("_v0")) * frac))
    out = v.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])
    if not by:
        return out
    # groups whose column is all NULL still get a row (quantiles NULL), like the aggregate
    return join_null_safe(df.select(*by).distinct(), out, by, "left")
