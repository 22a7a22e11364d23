"""Aggregations A1-A16 (descriptive statistics and label reports)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import day_name, hour
from ..functions.numeric import round_to
from .joins import join_null_safe
from .scaling import quantile_table, with_quantiles


def _i(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("int"), F.lit(0))


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """A1: count, mean, std (sample), min, 25/50/75 %, max per column: one aggregate
    for all columns, then unpivoted to one row per (group, column)."""
    cols = [c for c in cols if c in df.columns]
    probs = [0.25, 0.5, 0.75]
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
                 F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    g = with_quantiles(df.groupBy(*by).agg(*aggs), quantile_table(df, cols, probs, by, approx=approx), by)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"), F.col(f"{c}__mean").alias("mean"),
                     F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min"),
                     F.col(f"{c}__q250").alias("q25"), F.col(f"{c}__q500").alias("q50"),
                     F.col(f"{c}__q750").alias("q75"), F.col(f"{c}__max").alias("max")) for c in cols]
    return g.select(*by, F.explode(F.array(*rows)).alias("_s")).select(*by, "_s.*")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A2."""
    return df.select(col).distinct()


def table_overview(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """A3: rows, columns (from the schema, no job), time range."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")) \
             .withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A4 (presentation order: ``.orderBy(desc('n'), col)``)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def anomaly_summary(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """A5: total, anomalies, rate, normal count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(_i(label)).cast("long").alias("n_anomalies"),
                  F.avg(_i(label)).alias("anomaly_rate")) \
             .withColumn("n_normal", F.col("n_rows") - F.col("n_anomalies"))


def anomaly_by_group(df: DataFrame, by: str = "type", label: str = "is_anomaly", digits: int = 3) -> DataFrame:
    """Sum, count, mean (rounded) per group."""
    return df.groupBy(by).agg(F.sum(_i(label)).cast("long").alias("n_anomalies"), F.count(F.lit(1)).alias("n_rows"),
                              round_to(F.avg(_i(label)), digits, half_even=True).alias("anomaly_rate"))


def detector_rates(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Count and rate per flag column; one aggregate, unpivoted to rows with a
    readable label."""
    flags = [f for f in flags if f in df.columns]
    g = df.agg(*[F.struct(F.lit(f).alias("detector"), F.sum(_i(f)).cast("long").alias("n_flagged"),
                          F.avg(_i(f)).alias("rate")).alias(f) for f in flags])
    e = g.select(F.explode(F.array(*flags)).alias("_s")).select("_s.*")
    return e.withColumn("label", F.initcap(F.regexp_replace("detector", "_", " ")))


def hourly_profile(df: DataFrame, label: str = "is_anomaly", ts: str = "timestamp", digits: int = 3) -> DataFrame:
    """Anomalies and rate per hour of day (rate rounded)."""
    return df.groupBy(hour(ts).alias("hour")).agg(F.sum(_i(label)).cast("long").alias("n_anomalies"),
                                                 round_to(F.avg(_i(label)), digits, half_even=True).alias("anomaly_rate"))


def weekday_profile(df: DataFrame, label: str = "is_anomaly", ts: str = "timestamp", digits: int = 3) -> DataFrame:
    """Same by weekday name."""
    return df.groupBy(day_name(ts).alias("day_of_week")).agg(
        F.sum(_i(label)).cast("long").alias("n_anomalies"), round_to(F.avg(_i(label)), digits, half_even=True).alias("anomaly_rate"))


def profile_argmax(profile: DataFrame, key: str) -> DataFrame:
    """A8/A9 (Q15): key with most anomalies and key with the highest (rounded)
    rate; ties go to the smallest key.  ``max_by`` over a struct: an aggregate,
    not a sort."""
    return profile.agg(
        F.min_by(key, F.struct(-F.col("n_anomalies"), F.col(key))).alias(f"{key}_most"),
        F.max(F.col("n_anomalies")).alias("most_anomalies"),
        F.min_by(key, F.struct(-F.col("anomaly_rate"), F.col(key))).alias(f"{key}_highest_rate"),
        F.max(F.col("anomaly_rate")).alias("highest_rate"))


def daily_rate(df: DataFrame, label: str = "is_anomaly", ts: str = "timestamp") -> DataFrame:
    """A10."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.avg(_i(label)).alias("anomaly_rate"))


def temperature_by_label(df: DataFrame, label: str = "is_anomaly", col: str = "avg") -> DataFrame:
    """Mean / min / max temperature of normal vs anomalous rows."""
    return df.groupBy(F.coalesce(F.col(label).cast("boolean"), F.lit(False)).alias(label)).agg(
        F.avg(col).alias("mean_temp"), F.min(col).alias("min_temp"), F.max(col).alias("max_temp"),
        F.count(F.lit(1)).alias("n_rows"))


def night_day_rates(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """A12."""
    return df.groupBy(F.coalesce(F.col("nighttime"), F.lit(False)).alias("nighttime")).agg(
        F.sum(_i(label)).cast("long").alias("n_anomalies"), F.avg(_i(label)).alias("anomaly_rate"))


def overlap_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows flagged by more than one detector and by exactly one."""
    n = sum((_i(f) for f in flags), F.lit(0))
    return df.agg(F.count_if(n > 1).alias("multiple_detectors"), F.count_if(n == 1).alias("single_detector"))


def exclusive_overlap(df: DataFrame, flags: Sequence[str] = ("isolation_forest_anomaly", "statistical_anomaly",
                                                              "domain_anomaly")) -> DataFrame:
    """Counts of the 7 disjoint flag combinations (absent ones are 0).  One
    grouped aggregate on the 3 booleans, then the 7 cells are read off it."""
    b = [F.coalesce(F.col(f).cast("boolean"), F.lit(False)) for f in flags]
    g = df.groupBy(*[x.alias(f"_f{i}") for i, x in enumerate(b)]).agg(F.count(F.lit(1)).alias("_n"))
    names = [f.split("_")[0] for f in flags]
    cells = []
    for mask in range(1, 8):
        on = [bool(mask >> (2 - i) & 1) for i in range(3)]
        label = " + ".join(n for n, o in zip(names, on) if o) if sum(on) < 3 else "all three"
        if sum(on) == 1:
            label = f"only {label}"
        cond = F.lit(True)
        for i, o in enumerate(on):
            cond = cond & (F.col(f"_f{i}") if o else ~F.col(f"_f{i}"))
        cells.append(F.struct(F.lit(label).alias("combination"),
                              F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("long").alias("n")))
    return g.agg(F.array(*cells).alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")


def histogram(df: DataFrame, col: str, bins: int = 50, by: Sequence[str] = (), density: bool = False,
              common_range: bool = True) -> DataFrame:
    """Equal-width histogram; range from min/max (shared by all groups when
    ``common_range``), last bin closed; zero width -> one bin.  ``density`` =
    n / (N * width)."""
    rng = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")) if common_range or not by \
        else df.groupBy(*by).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    d = df.where(F.col(col).isNotNull())
    d = d.crossJoin(F.broadcast(rng)) if common_range or not by else join_null_safe(d, rng, by)
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col(col) - F.col("_lo")) / width), F.lit(bins - 1)))
    g = d.groupBy(*by, b.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"),
                                                       F.first("_hi").alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    g = g.withColumns({"bin_start": F.col("_lo") + F.col("bin") * w, "bin_end": F.col("_lo") + (F.col("bin") + 1) * w})
    if density:
        tot = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_N"))
        g = (join_null_safe(g, tot, by) if by else g.crossJoin(F.broadcast(tot)))
        g = g.withColumn("density", F.try_divide(F.col("n"), F.col("_N") * w)).drop("_N")
    return g.drop("_lo", "_hi")


def hourly_mean_profile(df: DataFrame, col: str = "avg", ts: str = "timestamp") -> DataFrame:
    """A16."""
    return df.groupBy(hour(ts).alias("hour")).agg(F.avg(col).alias("mean"))
