"""Projections, filters, cleaning (P1-P10), the per-source preparation X1 and set
operations U1-U2."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import nighttime as night_expr
from ..functions.numeric import t_diff as t_diff_expr
from ..schema import DEFAULT_SERIES, PRODUCTION_COLS, VALUE_COLS, Series, clean_doubles
from .joins import join_null_safe
from .timeseries import time_diff_min
from .windows import DEFAULT_LAYOUT, Layout, by_length


def drop_stddev(df: DataFrame) -> DataFrame:
    """Keep the value columns; the interval std column is always empty."""
    return df.drop("stddev_v")


def to_production(df: DataFrame, allow: Sequence[str] = PRODUCTION_COLS) -> DataFrame:
    """The allowed columns that exist, in the fixed order; strips labels."""
    return df.select(*[c for c in allow if c in df.columns])


def filter_type(df: DataFrame, system_type: str | None = None) -> DataFrame:
    """Rows of one system type; no-op without a type or a ``type`` column."""
    if not system_type or "type" not in df.columns:
        return df
    return df.where(F.col("type") == F.lit(system_type))


def split_day_night(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(night rows, day rows)."""
    n = F.coalesce(F.col("nighttime"), F.lit(False))
    return df.where(n), df.where(~n)


def with_nighttime(df: DataFrame, preset="eda", ts: str = "timestamp") -> DataFrame:
    """P5 as a column."""
    return df.withColumn("nighttime", night_expr(ts, preset))


def with_t_diff(df: DataFrame) -> DataFrame:
    """P6."""
    return df.withColumn("T_diff", t_diff_expr())


def tag_series(df: DataFrame, system_type: str | None = None, sensor_id: str | None = None) -> DataFrame:
    """Constant type / ID tags (existing columns kept when not given)."""
    out = {}
    if system_type is not None:
        out["type"] = F.lit(system_type)
    if sensor_id is not None:
        out["ID"] = F.lit(sensor_id)
    return df.withColumns(out) if out else df


def tag_by_source(df: DataFrame, sources: DataFrame, source: str = "source") -> DataFrame:
    """P7 for many sources at once: ``type`` and ``ID`` of the rows' source from a table (source, type, ID).
    A source that the table lacks has null tags; a null source matches a null one."""
    tags = sources.select(F.col(source).alias("_source"), "type", "ID").distinct()
    d = df.drop("type", "ID").join(tags, F.col(source).eqNullSafe(F.col("_source")), "left")
    return d.drop("_source", source)


def source_of_path(path: str = "_metadata.file_path", depth: int = 1) -> Column:
    """The name of the folder ``depth`` levels above a file: P7's source where every circuit
    has its own folder."""
    return F.url_decode(F.element_at(F.split(F.col(path), "/"), -1 - depth))


def normal_only(df: DataFrame, label: str | None = "is_anomaly") -> DataFrame:
    """Training rows with label 0; all rows when there is no label."""
    if not label or label not in df.columns:
        return df
    return df.where(F.coalesce(F.col(label).cast("int"), F.lit(0)) == 0)


def ground_truth(df: DataFrame, label: str = "is_anomaly", kind: str = "anomaly_type") -> DataFrame:
    """P9 (row part): ``y_true`` as 0/1 (missing -> 0) and ``true_type`` (missing -> 'unknown')."""
    y = F.coalesce(F.col(label).cast("int"), F.lit(0)) if label in df.columns else F.lit(0)
    k = F.col(kind) if kind in df.columns else F.lit("unknown")
    return df.withColumns({"y_true": y.cast("int"), "true_type": k})


def ground_truth_summary(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """P9 (summary): total anomalies and rate, one row."""
    y = ground_truth(df, label).select("y_true")
    return y.agg(F.sum("y_true").cast("long").alias("total_anomalies"),
                 F.avg("y_true").alias("anomaly_rate"),
                 F.count(F.lit(1)).alias("n_rows"))


def true_anomalies(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """P10: rows whose label is true."""
    return df.where(F.coalesce(F.col(label).cast("boolean"), F.lit(False)))


def prepare_readings(df: DataFrame, system_type: str | None = None, sensor_id: str | None = None,
                     night="eda", s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Raw readings -> ``readings``: drop std, night flag, minute gap with mode
    fill, T_diff, tags.  One window by series (``by_length``); the rest is row-local."""
    d = clean_doubles(drop_stddev(df), [c for c in VALUE_COLS if c in df.columns])
    d = tag_series(d, system_type, sensor_id)
    d = with_nighttime(d, night, s.ts)
    names = list(dict.fromkeys([*d.columns, "time_diff_min"]))
    d = by_length(d, lambda rows, lay: time_diff_min(rows, s, lay).select(*names), s, layout, once=True)
    d = with_t_diff(d)
    cols = ["timestamp", "avg", "min_v", "max_v", "nighttime", "time_diff_min", "T_diff", "type", "ID"]
    return d.select(*[c for c in cols if c in d.columns])


def combine(dfs: Sequence[DataFrame]) -> DataFrame:
    """Concatenate readings of several sources (missing columns -> NULL).
    Time order is applied only at output (W1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def intersect_rows(a: DataFrame, b: DataFrame, on: Sequence[str] = ("type", "ID", "timestamp")) -> DataFrame:
    """Rows of ``a`` whose key is also in ``b`` (semi join)."""
    return join_null_safe(a, b.select(*on), on, "left_semi")


def except_rows(a: DataFrame, b: DataFrame, on: Sequence[str] = ("type", "ID", "timestamp")) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b`` (anti join)."""
    return join_null_safe(a, b.select(*on), on, "left_anti")
