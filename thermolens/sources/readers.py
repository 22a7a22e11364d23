"""Sources and sinks: S1-S7."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schema import READINGS_RAW, clean_doubles
from ..operators.windows import DEFAULT_LAYOUT, Layout, with_position


def read_readings(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv",
                  schema=READINGS_RAW, timestamp_format: str | None = None) -> DataFrame:
    """Read a readings file with a declared schema; NaN -> NULL on doubles.

    CSV is read without inference (the schema is declared); parquet keeps its own
    schema unless one is given.
    """
    r = spark.read
    if fmt == "csv":
        r = r.schema(schema).option("header", True)
        if timestamp_format:
            r = r.option("timestampNTZFormat", timestamp_format)
        df = r.csv(path)
    else:
        df = r.format(fmt).load(path)
        if schema is not None and fmt != "parquet":
            df = spark.read.schema(schema).format(fmt).load(path)
    return clean_doubles(df)


def read_first_available(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet",
                         reader: Callable[..., DataFrame] | None = None) -> DataFrame:
    """The first path that exists (e.g. cleaned, else original).  The check is
    the analyzer's path resolution; no data is read on the driver."""
    reader = reader or (lambda p: read_readings(spark, p, fmt=fmt))
    errors = []
    for p in paths:
        try:
            return reader(p)
        except AnalysisException as e:  # PATH_NOT_FOUND and friends
            errors.append(f"{p}: {e.getErrorClass() if hasattr(e, 'getErrorClass') else e}")
    raise FileNotFoundError("no readable input among: " + "; ".join(errors))


def write_readings(df: DataFrame, path: str, fmt: str = "parquet",
                   partition_by: Sequence[str] | None = ("type",), mode: str = "overwrite") -> None:
    """S3: write combined / labeled / synthetic tables, partitioned by system type
    so type filters prune files."""
    w = df.write.mode(mode).format(fmt)
    cols = [c for c in (partition_by or []) if c in df.columns]
    if cols:
        w = w.partitionBy(*cols)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def slice_rows(df: DataFrame, start: int, end: int | None = None, per_series: bool = False,
               series=None, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Positional slice ``[start, end)`` in time order (``head(n)``, ``iloc``).

    * per series: a filter on the exact distributed position (no series in one task);
    * whole table: comparisons with the boundary times, found by counting ever finer
      time chunks; only rows at a boundary micro-second are ranked.
    Ties in time are broken by the series key, then ``series.tiebreak``.
    """
    from ..operators.windows import first_rows, pos_col, sk_col
    from ..schema import DEFAULT_SERIES, Series
    s = series or DEFAULT_SERIES
    if not per_series:
        s = Series(key=(), ts=s.ts, tiebreak=tuple(c for c in s.key if c in df.columns) + tuple(s.tiebreak)).present(df)
        d = df if end is None else first_rows(df, s, end, "_in").where("_in").drop("_in")
        return d if start <= 0 else first_rows(d, s, start, "_out").where("not _out").drop("_out")
    s = s.present(df)
    d = with_position(df, s, layout)
    p = F.col(pos_col(s))
    cond = p >= start
    if end is not None:
        cond = cond & (p < end)
    return d.where(cond).drop(sk_col(s), pos_col(s))


def rollup_readings(events: DataFrame, width: str = "1 hour", key: Sequence[str] = ("event_type",),
                    ts: str = "ts", value: str = "value", digits: int | None = None) -> DataFrame:
    """Raw samples -> interval readings ``avg, min_v, max_v, stddev_v`` per key
    and tumbling interval.  A partial (map-side) aggregate: skewed keys are
    combined before the shuffle."""
    v = F.nanvl(F.col(value), F.lit(None).cast("double"))
    g = events.groupBy(*key, F.window(ts, width).start.alias("timestamp")).agg(
        F.avg(v).alias("avg"), F.min(v).alias("min_v"), F.max(v).alias("max_v"),
        F.stddev_samp(v).alias("stddev_v"))
    if digits is not None:
        from ..functions.numeric import round_to
        g = g.withColumns({c: round_to(c, digits) for c in ("avg", "stddev_v")})
    return g


def save_params(params: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist a fitted parameter table (baseline, weights, forest) as Parquet."""
    params.write.mode(mode).parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fit_or_load(spark: SparkSession, path: str, fit: Callable[[], DataFrame],
                force_retrain: bool = False) -> DataFrame:
    """Reuse saved parameters unless ``force_retrain``; otherwise fit and save."""
    if not force_retrain:
        try:
            return load_params(spark, path)
        except AnalysisException:
            pass
    save_params(fit(), path)
    return load_params(spark, path)


def write_report(metrics: DataFrame, path: str, run: str | None = None) -> None:
    """One timestamped row per run in a Parquet report table.

    With ``run`` the rows go to that run's own partition and replace what an earlier attempt of the run
    left there, so a replayed run is reported once.  Without it they are appended."""
    d = metrics.withColumn("run_ts", F.current_timestamp())
    if run is None:
        d.write.mode("append").parquet(path)
    else:
        d.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={quote(run, safe='')}")
