"""Checks the reference describes in prose but never coded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DEFAULT_SERIES, Series, flag
from .timeseries import gap_mode, time_diff_min
from .windows import DEFAULT_LAYOUT, Layout, checkpoint, series_key, sk_col


def gap_warning(df: DataFrame, s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT,
                out: str = "gap_warning") -> DataFrame:
    """The gap to the previous reading is longer than the series' usual
    (most frequent) gap -- a hint of defective hardware or software."""
    s = s.present(df)
    d = time_diff_min(df, s, layout, out="_gap", fill_mode=False)
    d = series_key(d, s)
    d = d.join(gap_mode(d, "_gap", [sk_col(s)]), sk_col(s), "left")
    return d.withColumn(out, flag(F.col("_gap") > F.col("_mode"))).drop("_gap", "_mode")


def sensor_fault(df: DataFrame, col: str = "avg", out: str = "sensor_fault") -> DataFrame:
    """A sensor fault shows as a missing, zero or negative reading."""
    c = F.col(col)
    return df.withColumn(out, c.isNull() | flag(c <= 0))


def interval_swing(df: DataFrame, spread: float = 10.0, min_gap_minutes: int = 15,
                   out: str = "interval_swing") -> DataFrame:
    """A large min-max spread inside a long measurement interval."""
    return df.withColumn(out, flag((F.col("T_diff") > spread) & (F.col("time_diff_min") > min_gap_minutes)))


def circuit_drops(readings: DataFrame, drop: float = 10.0, bucket: str = "hour", col: str = "avg",
                  ts: str = "timestamp", within: str = "type", circuit: str = "ID") -> DataFrame:
    """(within, circuit, bucket, mean, drop): one row per circuit and time bucket; drop: its mean lies
    more than ``drop`` below the circuit's own mean.  Written to the checkpoint folder."""
    per = readings.groupBy(within, circuit, F.date_trunc(bucket, ts).alias("bucket")).agg(
        F.avg(col).alias("mean"), F.sum(col).alias("_s"), F.count(col).alias("_n"))
    own = Window.partitionBy(within, circuit)
    low = flag(F.sum("_s").over(own) / F.sum("_n").over(own) - F.col("mean") > drop)
    return checkpoint(per.select(within, circuit, "bucket", "mean", low.alias("drop")))


def cross_circuit_counts(drops: DataFrame, within: str = "type") -> DataFrame:
    """N4 over all pairs of circuits that share a ``within``, counted and not listed: per
    bucket the circuits measured and dropped, and the pairs in which both, one or none dropped.
    A partial aggregate: a bucket's rows are combined before the shuffle."""
    g = drops.groupBy(within, "bucket").agg(F.count(F.lit(1)).alias("n_measured"), F.count_if("drop").alias("n_dropped"))
    left = F.col("n_measured") - F.col("n_dropped")
    pairs = lambda n: (n * (n - 1) / 2).cast("long")
    return g.withColumns({"pairs_both": pairs(F.col("n_dropped")), "pairs_one": F.col("n_dropped") * left,
                          "pairs_none": pairs(left)})


def cross_circuit_pairs(drops: DataFrame, within: str = "type", circuit: str = "ID") -> DataFrame:
    """N4 for every pair of circuits that share a ``within`` and were measured in the same bucket, each pair once (smaller
    ``circuit`` first, null before all): both means, both drops, and whether both, one or none dropped.  An
    equi-join of the drops table with itself on (within, bucket): as many rows as there are pairs."""
    a, b = (drops.select(F.col(within).alias(f"_{x}"), F.col("bucket").alias(f"_{x}_bucket"), F.col(circuit).alias(f"{x}_{circuit}"),
                         F.col("mean").alias(f"{x}_mean"), F.col("drop").alias(f"{x}_drop")) for x in ("a", "b"))
    j = a.join(b, F.col("_a").eqNullSafe(F.col("_b")) & (F.col("_a_bucket") == F.col("_b_bucket"))
               & (F.struct(F.col(f"a_{circuit}").alias("c")) < F.struct(F.col(f"b_{circuit}").alias("c"))))
    return j.select(
        F.col("_a").alias(within), f"a_{circuit}", f"b_{circuit}", F.col("_a_bucket").alias("bucket"), "a_mean", "a_drop",
        "b_mean", "b_drop", F.when(F.col("a_drop") & F.col("b_drop"), "both").when(F.col("a_drop"), "only_a")
        .when(F.col("b_drop"), "only_b").otherwise("none").alias("diagnosis"))


def cross_circuit_check(drops: DataFrame, within: str = "type", circuit: str = "ID") -> DataFrame:
    """N4 per drop: did other circuits of the same ``within`` drop in the same bucket?  'shared'
    points at a common cause (heat source), 'own' at that circuit (pump, valve), 'single' has no other
    circuit to compare with.

    Only drops are looked up, each in its bucket's counts, so the output is linear in drops, however many
    circuits a bucket has.  AQE broadcasts the counts where they are small and splits a bucket with many drops
    otherwise."""
    counts = cross_circuit_counts(drops, within).select(
        F.struct(within, "bucket").alias("_at"), "n_measured", "n_dropped")
    d = drops.where("drop").withColumn("_at", F.struct(within, "bucket")).join(counts, "_at")
    also, rest = F.col("n_dropped") - 1, F.col("n_measured") - F.col("n_dropped")
    return d.select(within, circuit, "bucket", "mean", also.alias("n_also_dropped"), rest.alias("n_not_dropped"),
                    F.when(also > 0, "shared").when(rest > 0, "own").otherwise("single").alias("diagnosis"))
