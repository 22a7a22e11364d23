"""Joins J1-J3.  The reference has none; these replace its scalar broadcasts and
positional array alignment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on key columns in which NULL equals NULL, like a group key.  The
    result has the key columns once (the left side's) -- planned as a hash or
    sort-merge join, as ``<=>`` is an equi-join condition."""
    on = list(on)
    hidden = {c: f"_right_{c}" for c in on}
    r = right.select(*[F.col(c).alias(hidden[c]) for c in on], *[c for c in right.columns if c not in on])
    cond = reduce(and_, [F.col(c).eqNullSafe(F.col(hidden[c])) for c in on])
    return left.join(r, cond, how).drop(*hidden.values())


def attach_params(df: DataFrame, params: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Attach fitted parameters to every row.

    * global parameters (``on`` empty) are a one-row aggregate: the size bound is
      proven, so they are broadcast (planned as a broadcast nested-loop join);
    * per-series parameters (one row per key) join on the key; their size grows
      with the number of series, so the choice is left to AQE's runtime size check
      (broadcast under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else a
      shuffled join).
    """
    if not on:
        return df.crossJoin(F.broadcast(params))
    return join_null_safe(df, params, on, "left")


def compare_profiles(real: DataFrame, synth: DataFrame, col: str = "avg", ts: str = "timestamp") -> DataFrame:
    """Hourly mean profile of two tables side by side (full outer on hour)."""
    a = real.groupBy(F.hour(ts).cast("long").alias("hour")).agg(F.avg(col).alias("real_mean"))
    b = synth.groupBy(F.hour(ts).cast("long").alias("hour")).agg(F.avg(col).alias("synthetic_mean"))
    return a.join(b, "hour", "full_outer").withColumn("difference", F.col("synthetic_mean") - F.col("real_mean"))


def join_labels(pred: DataFrame, truth: DataFrame, on: Sequence[str] = ("type", "ID", "timestamp"),
                how: str = "inner") -> DataFrame:
    """Predictions and labels kept in separate tables meet on the row key
    (never by position); a NULL key part matches NULL.  A shuffled equi-join; AQE
    splits skewed keys."""
    return join_null_safe(pred, truth, on, how)
