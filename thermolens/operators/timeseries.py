"""Time-series window operators W1-W16.

All take the ``Series`` (key, time order) and ``Layout``; with the default
blocked layout no operator places a whole series in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_SERIES, Series
from .windows import (DEFAULT_LAYOUT, Layout, checkpoint, epoch_micros, parse_span, pos_col, range_over, rows_over,
                      running, series_key, sk_col, with_position)

MINUTE_US = 60_000_000


def sort_by_time(df: DataFrame, s: Series = DEFAULT_SERIES) -> DataFrame:
    """Final presentation order only (a global range-partitioned sort)."""
    s = s.present(df)
    return df.orderBy(*s.key, *s.order)


def lag_columns(df: DataFrame, cols: dict[str, tuple[str, int]], s: Series = DEFAULT_SERIES,
                layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Generic ``lag``: ``{out: (col, n)}``."""
    reach = max(n for _, n in cols.values())
    return rows_over(df, {o: (lambda w, c=c, n=n: F.lag(c, n).over(w)) for o, (c, n) in cols.items()},
                     reach, s, layout)


def gap_mode(gaps: DataFrame, gap_col: str, key: Sequence[str]) -> DataFrame:
    """Most frequent gap per series, smallest on ties (pandas ``mode()[0]``).
    Two partial aggregates; never buffers a series."""
    counts = gaps.where(F.col(gap_col).isNotNull()).groupBy(*key, gap_col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*key).agg(F.max_by(gap_col, F.struct(F.col("_n"), -F.col(gap_col))).alias("_mode"))


def time_diff_min(df: DataFrame, s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT,
                  out: str = "time_diff_min", fill_mode: bool = True) -> DataFrame:
    """Whole minutes (floor) since the previous reading of the series; the
    first row gets the series' most frequent gap."""
    s = s.present(df)
    d = df.withColumn("_us", epoch_micros(df, s.ts))
    d = rows_over(d, {"_prev_us": lambda w: F.lag("_us").over(w)}, 1, s, layout)
    d = d.withColumn(out, F.floor((F.col("_us") - F.col("_prev_us")) / MINUTE_US).cast("long"))
    d = d.drop("_us", "_prev_us")
    if not fill_mode:
        return d
    d = series_key(d, s)
    mode = gap_mode(d, out, [sk_col(s)])
    d = d.join(mode, sk_col(s), "left")
    return d.withColumn(out, F.coalesce(F.col(out), F.col("_mode"))).drop("_mode")


def interval_histogram(df: DataFrame, s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Counts of exact gaps between consecutive readings (seconds), per series."""
    s = s.present(df)
    d = df.withColumn("_us", epoch_micros(df, s.ts))
    d = rows_over(d, {"_prev_us": lambda w: F.lag("_us").over(w)}, 1, s, layout)
    d = d.where(F.col("_prev_us").isNotNull()).select(
        *s.key, ((F.col("_us") - F.col("_prev_us")) / F.lit(1e6)).alias("gap_seconds"))
    return d.groupBy(*s.key, "gap_seconds").agg(F.count(F.lit(1)).alias("n"))


def rolling_rows(df: DataFrame, col: str = "avg", window: int = 24, stats: Sequence[str] = ("mean", "std"),
                 s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT, prefix: str | None = None) -> DataFrame:
    """Trailing ``window``-row mean and sample std (min_periods=1; std of a
    single row is NULL)."""
    prefix = prefix or f"{col}_rolling"
    frame = lambda w: w.rowsBetween(-(window - 1), 0)
    fns = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}
    exprs = {f"{prefix}_{st}": (lambda w, f=fns[st]: f(col).over(frame(w))) for st in stats}
    return rows_over(df, exprs, window - 1, s, layout)


def rolling_time_exprs(cols: Sequence[str], hours: Sequence[int]) -> dict:
    """W6/W7 expressions: ``[t - h, t]`` both ends inclusive, peers included;
    std is sample std and 0 for a single-row frame."""
    exprs = {}
    for c in cols:
        for h in hours:
            us = h * 3_600_000_000
            exprs[f"{c}_rolling_mean_{h}h"] = lambda w, c=c, us=us: F.avg(c).over(w.rangeBetween(-us, 0))
            exprs[f"{c}_rolling_std_{h}h"] = lambda w, c=c, us=us: F.when(
                F.count(F.lit(1)).over(w.rangeBetween(-us, 0)) > 1,
                F.stddev_samp(c).over(w.rangeBetween(-us, 0))).otherwise(F.lit(0.0))
    return exprs


def rolling_time(df: DataFrame, cols: Sequence[str] = ("avg",), hours: Sequence[int] = (1, 6, 24),
                 s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Time-based rolling mean / std for every (column, hours)."""
    cols = [c for c in cols if c in df.columns]
    return range_over(df, rolling_time_exprs(cols, hours), max(hours) * 3_600_000_000, s, layout)


def rate_exprs(cols: Sequence[str], gap: str | None, suffix: str) -> dict:
    """Change per minute to the previous row; first row 0; non-positive gap 0."""
    g = F.col(gap) if gap else F.lit(1)
    exprs = {}
    for c in cols:
        exprs[f"{c}_{suffix}"] = lambda w, c=c: F.when(F.lag(c).over(w).isNull() & F.lag(F.lit(1)).over(w).isNull(), F.lit(0.0)) \
            .when(g > 0, (F.col(c) - F.lag(c).over(w)) / g).otherwise(F.lit(0.0))
    return exprs


def weighted_change(df: DataFrame, cols: Sequence[str] = ("avg", "min_v", "max_v", "T_diff"),
                    s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """``Δvalue / time_diff_min`` (gap 1 when the column is absent)."""
    cols = [c for c in cols if c in df.columns]
    gap = "time_diff_min" if "time_diff_min" in df.columns else None
    return rows_over(df, rate_exprs(cols, gap, "weighted_change"), 1, s, layout)


def rate_per_min(df: DataFrame, cols: Sequence[str] = ("avg", "min_v", "max_v", "T_diff"),
                 s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Same expression as W8, only defined when ``time_diff_min`` exists."""
    if "time_diff_min" not in df.columns:
        return df
    cols = [c for c in cols if c in df.columns]
    return rows_over(df, rate_exprs(cols, "time_diff_min", "rate_per_min"), 1, s, layout)


def lag_rows(df: DataFrame, col: str = "avg", n: int = 24, out: str | None = None,
             s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Value ``n`` rows back in the series."""
    return lag_columns(df, {out or f"{col}_lag_{n}": (col, n)}, s, layout)


def ffill_then_zero(df: DataFrame, cols: Sequence[str], s: Series = DEFAULT_SERIES,
                    layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Forward fill in time order, then 0 for leading NULLs."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    outs = {f"_ff_{i}": ("last", F.col(c)) for i, c in enumerate(cols)}
    d = running(df, outs, s, layout)
    fills = {}
    for i, c in enumerate(cols):
        zero = F.lit(False) if dict(df.dtypes)[c] == "boolean" else F.lit(0)
        fills[c] = F.coalesce(F.col(f"_ff_{i}"), zero).cast(dict(df.dtypes)[c])
    return d.withColumns(fills).drop(*outs)


def anomaly_periods(df: DataFrame, flag_col: str = "anomaly", s: Series = DEFAULT_SERIES,
                    layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Maximal runs of consecutive flagged rows per series.

    A run starts at a flagged row whose predecessor is not flagged and ends at
    its last flagged row; a run open at the end of the data is closed there.
    Periods are numbered from 1 per series in time order.

    One window stage looks one row back and one ahead; only the first and last row of each run
    leave it, with their positions, so a run's length is a difference.  These few rows are written to the checkpoint
    folder and numbered there; ``df`` is neither run nor read again.
    """
    s = s.present(df)
    f = F.coalesce(F.col(flag_col), F.lit(False))
    hidden = [c for c in (sk_col(s), pos_col(s)) if c in df.columns]
    names = list(dict.fromkeys([*s.key, *s.order, *hidden]))
    d = with_position(df.select(*names, f.alias("_f")), s, layout)
    d = rows_over(d, {"_pf": lambda w: F.lag("_f").over(w), "_nf": lambda w: F.lead("_f").over(w)}, 1, s, layout, following=1)
    first, last = (F.col("_f") & ~F.coalesce(F.col(c), F.lit(False)) for c in ("_pf", "_nf"))
    POS = pos_col(s)
    edges = checkpoint(d.where(first | last).select(*dict.fromkeys([*names, sk_col(s), POS]), first.cast("long").alias("_start")))
    edges = running(edges, {"period_no": ("sum", F.col("_start"))}, s, layout)
    runs = edges.groupBy(*s.key, "period_no").agg(
        F.min(s.ts).alias("start_ts"), F.max(s.ts).alias("end_ts"), (F.max(POS) - F.min(POS) + 1).cast("long").alias("n_rows"))
    return render_periods(runs)


def render_periods(runs: DataFrame) -> DataFrame:
    """Weekday + HH:MM text of period bounds (the reference's output contract)."""
    return runs.withColumns({
        "period_no": F.col("period_no").cast("long"),
        "start_weekday": F.date_format("start_ts", "EEEE"),
        "start_time": F.date_format("start_ts", "HH:mm"),
        "end_weekday": F.date_format("end_ts", "EEEE"),
        "end_time": F.date_format("end_ts", "HH:mm"),
    })


def periods_entries(periods: DataFrame) -> DataFrame:
    """The reference's ``{"Period n": [weekday, HH:MM, weekday, HH:MM]}`` shape, one
    entry per row (a driver may build the dict from a bounded result)."""
    return periods.select(
        *[c for c in periods.columns if c in ("type", "ID")],
        F.concat(F.lit("Period "), F.col("period_no").cast("string")).alias("label"),
        F.array("start_weekday", "start_time", "end_weekday", "end_time").alias("entry"))


def deviation_from_mean(df: DataFrame, col: str = "avg", reference: DataFrame | None = None,
                        out: str | None = None) -> DataFrame:
    """Value minus the mean of the **full** data (``reference``, default ``df``),
    even when ``df`` is a filtered subset.  One-row aggregate, broadcast."""
    ref = reference if reference is not None else df
    mean = ref.agg(F.avg(col).alias("_m"))
    return df.crossJoin(F.broadcast(mean)).withColumn(out or f"{col}_deviation", F.col(col) - F.col("_m")).drop("_m")


def sequences(df: DataFrame, col: str = "avg", length: int = 24, out: str = "sequence",
              s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT, full_only: bool = True) -> DataFrame:
    """Overlapping windows of ``length`` values, as an array on the window's
    last row (n - length + 1 of them per series)."""
    # structs, because collect_list leaves out NULLs and every position counts
    d = rows_over(df, {out: lambda w: F.transform(F.collect_list(F.struct(F.col(col).alias("v"))).over(
                           w.rowsBetween(-(length - 1), 0)), lambda x: x["v"]),
                       "_seq_n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-(length - 1), 0))},
                  length - 1, s, layout)
    if full_only:
        d = d.where(F.col("_seq_n") == length)
    return d.drop("_seq_n")


def align_sequence_scores(df: DataFrame, score: str, length: int = 24, s: Series = DEFAULT_SERIES,
                          layout: Layout = DEFAULT_LAYOUT, out: str | None = None) -> DataFrame:
    """A sequence's score sits on its last row; rows before the first full
    sequence take the series' last score.  ``score`` is NULL on those head rows
    in the input.  A series shorter than ``length`` has no score at all: every
    row gets ``+inf`` so that a threshold flags it throughout."""
    s = s.present(df)
    out = out or score
    d = with_position(df, s, layout)
    SK, POS = sk_col(s), pos_col(s)
    last = d.groupBy(SK).agg(F.max_by(score, F.when(F.col(score).isNotNull(), F.col(POS))).alias("_last"))
    d = d.join(last, SK, "left")
    filled = F.when(F.col(POS) >= length - 1, F.col(score)).otherwise(F.col("_last"))
    return d.withColumn(out, F.coalesce(filled, F.lit(float("inf")))).drop("_last")


GRID_CHUNK = 4096


def _interval_us(us: Column) -> Column:
    return F.make_dt_interval(secs=(us.cast("decimal(28,6)") / F.lit(1_000_000)).cast("decimal(18,6)"))


def floor_time(df: DataFrame, ts: str, step: str) -> Column:
    """The timestamp floored to a multiple of ``step`` since 1970-01-01 (same type)."""
    return F.col(ts) - _interval_us(F.pmod(epoch_micros(df, ts), F.lit(parse_span(step))))


def time_grid(df: DataFrame, step: str = "1 hour", s: Series = DEFAULT_SERIES) -> DataFrame:
    """Regular timeline per series from its first to its last reading, in steps
    from the first one.  A series' slots are exploded in chunks of ``GRID_CHUNK``, so
    no row ever holds a whole timeline."""
    s = s.present(df)
    step_us = parse_span(step)
    bounds = df.groupBy(*s.key).agg(F.min(s.ts).alias("_lo"), F.max(s.ts).alias("_hi"))
    last = F.floor((epoch_micros(bounds, "_hi") - epoch_micros(bounds, "_lo")) / F.lit(step_us))
    d = bounds.withColumn("_last", last.cast("long")).where("_last is not null")
    d = d.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_last") / GRID_CHUNK))))
    d = d.withColumn("_j", F.explode(F.sequence(F.col("_i") * GRID_CHUNK, F.least(
        F.col("_last"), F.col("_i") * GRID_CHUNK + (GRID_CHUNK - 1)))))
    return d.select(*s.key, (F.col("_lo") + _interval_us(F.col("_j") * F.lit(step_us))).alias(s.ts))


def missing_slots(df: DataFrame, step: str = "1 hour", s: Series = DEFAULT_SERIES) -> DataFrame:
    """W16 use: slots with no reading, from the runs of missing slots; no grid, no join."""
    return expand_outages(outages(df, step, s), step, s.present(df))


def outages(df: DataFrame, step: str = "1 hour", s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """W16 without the grid: one row per run of missing slots of a series: its first and last slot and
    their number, however long the outage.  Readings are floored to ``step``; ``expand_outages`` lists the slots."""
    s = s.present(df)
    step_us = parse_span(step)
    d = df.where(F.col(s.ts).isNotNull()).select(*s.key, floor_time(df, s.ts, step).alias(s.ts)).distinct()
    own = Series(key=s.key, ts=s.ts)
    d = rows_over(d, {"_prev": lambda w: F.lag(s.ts).over(w)}, 1, own, layout)
    n = (F.timestamp_diff("MICROSECOND", F.col("_prev"), F.col(s.ts)) / F.lit(step_us)).cast("long") - 1
    one = _interval_us(F.lit(step_us))
    return d.withColumn("n_slots", n).where("n_slots > 0").select(
        *s.key, (F.col("_prev") + one).alias("first_slot"), (F.col(s.ts) - one).alias("last_slot"), "n_slots")


def expand_outages(runs: DataFrame, step: str = "1 hour", s: Series = DEFAULT_SERIES) -> DataFrame:
    """The missing slots of ``outages``, in chunks of ``GRID_CHUNK``, so that no row holds a whole outage."""
    step_us = parse_span(step)
    keys = [c for c in s.key if c in runs.columns]
    d = runs.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / GRID_CHUNK))))
    d = d.withColumn("_j", F.explode(F.sequence(F.col("_i") * GRID_CHUNK, F.least(
        F.col("n_slots") - 1, F.col("_i") * GRID_CHUNK + (GRID_CHUNK - 1)))))
    return d.select(*keys, (F.col("first_slot") + _interval_us(F.col("_j") * F.lit(step_us))).alias(s.ts))
