"""Deterministic fault injection into an existing readings table.

Every random draw is a uniform derived from ``md5(seed:series:epoch_us:salt)``, so
the result is independent of partitioning and re-execution, and reproducible in
any engine with md5.  The exact count ``floor(n * rate)`` is selected by rank of a
uniform hash without a global sort: hash buckets (uniform, hence balanced) ->
bucket counts (small table) -> the one boundary bucket is ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DEFAULT_SERIES, Series
from .windows import checkpoint, epoch_micros

# Fixed anomaly kinds and their perturbation ranges (reference values).
KINDS = ("overheat", "underheat", "sensor_error")
OVERHEAT = (15.0, 25.0)      # added to avg
UNDERHEAT = (10.0, 20.0)     # subtracted from avg
SENSOR_FACTOR = (0.5, 1.5)   # multiplies avg
MIN_BELOW = (3.0, 8.0)       # min_v = avg - U
MAX_ABOVE = (3.0, 10.0)      # max_v = avg + U

N_BUCKETS = 1 << 16


def uniform(seed: int, key: Column, us: Column, salt: str) -> Column:
    """U[0,1) from the first 32 bits of md5(seed:key:us:salt)."""
    s = F.concat_ws(":", F.lit(str(seed)), key, us.cast("string"), F.lit(salt))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def series_label(df: DataFrame, s: Series) -> Column:
    keys = [c for c in s.key if c in df.columns]
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]) if keys else F.lit("")


def _mark_smallest(d: DataFrame, rate: float) -> DataFrame:
    """``is_anomaly`` on exactly the ``floor(n * rate)`` rows with the smallest (_h, _k, _us).

    Counts per hash bucket (at most ``N_BUCKETS`` rows), then per hash value inside the
    one boundary bucket (as many again), name the boundary value; every other row is a
    comparison, and only rows that share that value are ranked."""
    d = d.withColumn("_b", F.floor(F.col("_h") * N_BUCKETS))

    def boundary(counts: DataFrame, key: str, k: int):
        run = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        c = counts.withColumn("_before", F.coalesce(F.sum("_n").over(run), F.lit(0)))
        return c.where((F.col("_before") <= k) & (F.lit(k) < F.col("_before") + F.col("_n"))).first()

    buckets = checkpoint(d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")))
    n = buckets.agg(F.sum("_n")).first()[0] or 0
    k = int(n * rate)
    at = boundary(buckets, "_b", k)
    if at is None:  # all rows, or none at all
        return d.withColumn("is_anomaly", F.lit(n > 0 and k >= n)).drop("_b")
    inside = d.where(F.col("_b") == at["_b"]).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    edge = boundary(inside, "_h", k - at["_before"])
    rest = k - at["_before"] - edge["_before"]
    d = d.drop("_b")
    below = d.withColumn("is_anomaly", F.col("_h") < F.lit(edge["_h"]))
    if rest == 0:
        return below
    rank = F.row_number().over(Window.partitionBy("_h").orderBy("_k", "_us"))
    ties = d.where(F.col("_h") == F.lit(edge["_h"])).withColumn("is_anomaly", rank <= rest)
    return below.where(F.col("_h") != F.lit(edge["_h"])).unionByName(ties)


def inject_faults(df: DataFrame, rate: float = 0.05, seed: int = 42, s: Series = DEFAULT_SERIES,
                  exact: bool = True) -> DataFrame:
    """Perturb ``floor(n * rate)`` rows (or each row with probability ``rate`` when
    ``exact=False``): kind uniform over overheat / underheat / sensor_error;
    min_v, max_v and T_diff re-derived; ``is_anomaly`` and ``anomaly_type`` set."""
    us = epoch_micros(df, s.ts)
    key = series_label(df, s)
    d = df.withColumns({"_k": key, "_us": us})
    u = lambda salt: uniform(seed, F.col("_k"), F.col("_us"), salt)
    d = d.withColumn("_h", u("pick"))
    if exact:
        d = _mark_smallest(d, rate)
    else:
        d = d.withColumn("is_anomaly", F.col("_h") < F.lit(rate))
    kind = F.floor(u("kind") * 3)
    a = F.col("avg")
    u3 = u("size")
    new_avg = (F.when(kind == 0, a + F.lit(OVERHEAT[0]) + u3 * (OVERHEAT[1] - OVERHEAT[0]))
                .when(kind == 1, a - (F.lit(UNDERHEAT[0]) + u3 * (UNDERHEAT[1] - UNDERHEAT[0])))
                .otherwise(a * (F.lit(SENSOR_FACTOR[0]) + u3 * (SENSOR_FACTOR[1] - SENSOR_FACTOR[0]))))
    hit = F.col("is_anomaly")
    d = d.withColumn("avg", F.when(hit, new_avg).otherwise(a))
    d = d.withColumns({
        "min_v": F.when(hit, F.col("avg") - (F.lit(MIN_BELOW[0]) + u("min") * (MIN_BELOW[1] - MIN_BELOW[0]))).otherwise(F.col("min_v")),
        "max_v": F.when(hit, F.col("avg") + (F.lit(MAX_ABOVE[0]) + u("max") * (MAX_ABOVE[1] - MAX_ABOVE[0]))).otherwise(F.col("max_v")),
        "anomaly_type": F.when(hit, F.element_at(F.array(*[F.lit(k) for k in KINDS]), (kind + 1).cast("int")))
                         .otherwise(F.lit("normal")),
    })
    d = d.withColumn("T_diff", F.when(hit, F.col("max_v") - F.col("min_v")).otherwise(
        F.col("T_diff") if "T_diff" in df.columns else F.col("max_v") - F.col("min_v")))
    return d.drop("_k", "_us", "_h")


def rate_within_tolerance(df: DataFrame, target: float = 0.05, tol: float = 0.02,
                          label: str = "is_anomaly") -> DataFrame:
    """Is the labelled share within ``tol`` of ``target``?"""
    r = df.agg(F.avg(F.col(label).cast("double")).alias("anomaly_rate"))
    return r.withColumns({"target_rate": F.lit(float(target)),
                          "within_tolerance": F.abs(F.col("anomaly_rate") - F.lit(target)) <= F.lit(tol)})
