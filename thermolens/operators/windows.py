"""Ordered-window machinery for per-series time-series operators.

Two layouts compute the same, exact results:

* ``series``  -- the textbook ``Window.partitionBy(key).orderBy(ts)``.  One task per
  series, so it is only right when there are many series of modest length.
* ``blocked`` (default) -- never puts a whole series in one task:

  1. *position*: every row gets its exact 0-based position in its series.  Rows are
     bucketed into time chunks; per (series, chunk) counts are a partial aggregate (written to the
     checkpoint folder: the input's rows are then read once more, not twice), a chunk of more than
     ``chunk_rows`` rows is split at times of its own (``split_chunks``), running offsets are a window over that small
     count table, and the row number inside a chunk is a window of bounded size.
  2. *row frames* (``rows_over``): positions are cut into blocks of ``block_rows``;
     the last ``preceding`` rows of each block are copied into the next block (halo),
     so a frame of up to ``preceding`` rows back is complete for every owned row.
  3. *time-range frames* (``range_over``): time chunks, and a row is copied into the
     later chunks its ``[t, t + span]`` reaches (time halo).  Exact for RANGE frames.
  4. *unbounded scans* (``running``): in-block running aggregate, plus a carry from
     per-block totals (a small table) joined back.

``by_length`` joins them: whole series of up to ``block_rows`` rows, which any task can hold, take the plain windows (no halo copies,
no positions, one shuffle for windows of one key), only longer ones the blocks.

The hidden series key ``_sk`` is ``struct(key...)``: never NULL itself, and struct
equality matches NULL key parts, so joins and partitioning on it are null-safe.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DEFAULT_SERIES, Series

MICROS_PER = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}

SK = "_sk"
POS = "_pos"


def sk_col(s: Series) -> str:
    """Hidden series-key column of a Series (named after its key)."""
    return "_sk_" + ("_".join(s.key) if s.key else "all")


def pos_col(s: Series) -> str:
    """Hidden position column of a Series (named after key and order)."""
    return "_pos_" + ("_".join(s.key) if s.key else "all") + "__" + "_".join(s.order)


def parse_span(span: str | int) -> int:
    """'24 hours' / '1 day' / micro-seconds -> micro-seconds."""
    if isinstance(span, int):
        return span
    n, unit = span.split()
    unit = unit.rstrip("s").lower()
    return int(float(n) * MICROS_PER[unit])


@dataclass(frozen=True)
class Layout:
    """Physical layout of per-series windows (results do not depend on it)."""

    strategy: str = "blocked"   # "blocked" or "series"
    chunk: str = "1 day"        # time chunk for positions and time-range frames
    chunk_rows: int = 1_000_000  # rows of a series' chunk above which it is split for positions
    block_rows: int = 65536     # rows per positional block for row frames

    @property
    def chunk_us(self) -> int:
        return parse_span(self.chunk)


DEFAULT_LAYOUT = Layout()
SERIES_LAYOUT = Layout(strategy="series")


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Micro-seconds since 1970-01-01 of a timestamp column, independent of the
    session time zone for TIMESTAMP_NTZ."""
    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(ts))
    return F.unix_micros(F.col(ts))


def series_key(df: DataFrame, s: Series) -> DataFrame:
    """Add the null-safe single-column series key (``sk_col(s)``)."""
    s = s.present(df)
    if sk_col(s) in df.columns:
        return df
    sk = F.struct(*[F.col(c) for c in s.key]) if s.key else F.struct(F.lit(0).alias("all"))
    return df.withColumn(sk_col(s), sk)


def plain_window(s: Series) -> WindowSpec:
    return Window.partitionBy(*s.key).orderBy(*s.order)


def by_length(df: DataFrame, build: Callable[[DataFrame, Layout], DataFrame], s: Series = DEFAULT_SERIES,
              layout: Layout = DEFAULT_LAYOUT, once: bool = False) -> DataFrame:
    """The union of ``build(rows, layout)`` over short and long series: a series of up to ``block_rows`` rows, the bound of a
    positional block, is laid out as ``series``, a longer one as ``layout`` says.  ``build`` returns named columns only (no hidden ones).
    Rows without a time are left out, as the blocked layout does.

    The lengths are one aggregate over key and time.  Where there are long series, ``df`` is read for each part;
    with ``once`` it is written to the checkpoint folder before (for a ``df`` that is dear to compute)."""
    if layout.strategy == "series":
        return build(df, layout)
    s = s.present(df)
    SK = sk_col(s)
    d = df.where(F.col(s.ts).isNotNull())
    lengths = series_key(d, s).groupBy(SK).agg(F.count(F.lit(1)).alias("_n"))
    long = checkpoint(lengths.where(F.col("_n") > layout.block_rows).select(F.col(SK).alias("_long")))
    if long.isEmpty():
        return build(d, SERIES_LAYOUT)
    d = series_key(checkpoint(d) if once else d, s)
    short_rows, long_rows = (d.join(F.broadcast(long), F.col(SK) == F.col("_long"), how) for how in ("left_anti", "left_semi"))
    return build(short_rows, SERIES_LAYOUT).unionByName(build(long_rows, layout))


def with_position(df: DataFrame, s: Series = DEFAULT_SERIES,
                  layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Add ``pos_col(s)``: exact 0-based position of the row in its series' time
    order (plus the series key column).  Idempotent for the same Series, so a
    chain of operators computes positions once."""
    s = s.present(df)
    SK, POS = sk_col(s), pos_col(s)
    d = series_key(df, s)
    if POS in d.columns:
        return d
    if layout.strategy == "series":
        w = Window.partitionBy(SK).orderBy(*s.order)
        return d.withColumn(POS, F.row_number().over(w) - 1)
    d = d.withColumn("_chunk", F.floor(epoch_micros(d, s.ts) / F.lit(layout.chunk_us)))
    counts = checkpoint(d.groupBy(SK, "_chunk").agg(F.count(F.lit(1)).alias("_n")))
    chunk = ["_chunk"]
    if not (hot := counts.where(F.col("_n") > layout.chunk_rows)).isEmpty():
        d = split_chunks(d, hot, epoch_micros(d, s.ts), SK)
        chunk = ["_chunk", "_sub"]
        counts = checkpoint(d.groupBy(SK, *chunk).agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(SK).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(SK, *chunk, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    d = d.join(offsets, [SK, *chunk])
    rn = F.row_number().over(Window.partitionBy(SK, *chunk).orderBy(*s.order))
    return d.withColumn(POS, F.col("_off") + rn - 1).drop("_off", "_sub", "_chunk")


SPLITS = 256


def split_chunks(d: DataFrame, hot: DataFrame, us: Column, sk: str) -> DataFrame:
    """Add ``_sub``: the part of its time chunk that a row is in.  The chunks of ``hot`` (series key, ``_chunk``) are cut at up to
    ``SPLITS - 1`` times that a mergeable sketch of their rows' times gives, so a part holds about
    1/``SPLITS`` of them (more only where that many rows have one time); all others are one part."""
    keys = hot.select(F.col(sk).alias("_hk"), F.col("_chunk").alias("_hc"))
    on = (F.col(sk) == F.col("_hk")) & (F.col("_chunk") == F.col("_hc"))
    cuts = d.withColumn("_at", us).join(keys, on, "left_semi").groupBy(F.col(sk).alias("_hk"), F.col("_chunk").alias("_hc")).agg(
        F.percentile_approx("_at", [i / SPLITS for i in range(1, SPLITS)], 10_000).alias("_cuts"))
    cuts = checkpoint(cuts.withColumn("_cuts", F.array_distinct("_cuts")))
    below = F.size(F.filter("_cuts", lambda c: c < us))
    d = d.join(cuts, on, "left").withColumn("_sub", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(below))
    return d.drop("_cuts", "_hk", "_hc")


# Widths of the refinement of a position in the global time order.
_REFINE = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)


def time_of_position(df: DataFrame, us: str, k: int) -> tuple[int, int, int] | None:
    """(micro-second, rows before it, rows at it) of the row at 0-based position ``k``
    in time order; None past the end.  Rows are counted per day, then only the
    boundary day's per hour, and so on down to one micro-second: no sort, and each
    pass brings back one row per chunk of the boundary."""
    lo, before, part = None, 0, df.select(us).where(F.col(us).isNotNull())
    n = 0
    for width in _REFINE:
        inside = part if lo is None else part.where((F.col(us) >= lo) & (F.col(us) < lo + span))
        chunk = F.floor(F.col(us) / F.lit(width)).cast("long")
        counts = sorted((r["c"], r["n"]) for r in inside.groupBy(chunk.alias("c")).agg(
            F.count(F.lit(1)).alias("n")).collect())
        for c, n in counts:
            if before + n > k:
                break
            before += n
        else:
            return None
        lo, span = c * width, width
    return lo, before, n


def first_rows(df: DataFrame, s: Series, k: int, out: str) -> DataFrame:
    """Add ``out``: whether a row is among the first ``k`` of the whole table in time
    order.  Rows are compared with the boundary micro-second; only rows at it are ranked (by the
    remaining order columns).  Rows without a time come last."""
    d = df.withColumn("_us", epoch_micros(df, s.ts))
    at = time_of_position(d, "_us", k) if k > 0 else None
    if k <= 0:
        return d.withColumn(out, F.lit(False)).drop("_us")
    if at is None:
        dated = d.where(F.col("_us").isNotNull()).count()
        rest, tie = k - dated, F.col("_us").isNull()
    else:
        rest, tie = k - at[1], F.col("_us").eqNullSafe(F.lit(at[0]))
    before = F.lit(True) if at is None else F.coalesce(F.col("_us") < F.lit(at[0]), F.lit(False))
    if rest <= 0:
        return d.withColumn(out, before & ~tie).drop("_us")
    ties = d.where(tie)
    by = [c for c in s.order if c != s.ts]
    if by:
        # many rows may share the boundary time (or have none): count them per value of the other order
        # columns, and rank only those of the boundary value
        total = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        counts = ties.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).withColumn("_to", F.sum("_n").over(total))
        counts = checkpoint(counts.select(F.struct(*by).alias("_at"), "_n", "_to"))
        ties = ties.withColumn("_at", F.struct(*by)).join(counts, "_at")
        inside = ties.where((F.col("_to") > rest) & (F.col("_to") - F.col("_n") < rest))
        rank = F.row_number().over(Window.partitionBy("_at").orderBy(*by))
        inside = inside.withColumn(out, rank <= F.lit(rest) - (F.col("_to") - F.col("_n")))
        ties = ties.where((F.col("_to") <= rest) | (F.col("_to") - F.col("_n") >= rest)).withColumn(out, F.col("_to") <= rest)
        ties = ties.unionByName(inside).drop("_at", "_n", "_to")
    else:
        rank = F.row_number().over(Window.partitionBy("_us").orderBy(*s.order))
        ties = ties.withColumn(out, rank <= rest)
    return d.where(~tie).withColumn(out, before).unionByName(ties).drop("_us")


WindowExprs = Mapping[str, Callable[[WindowSpec], Column]]


def rows_over(df: DataFrame, exprs: WindowExprs, preceding: int,
              s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT, following: int = 0) -> DataFrame:
    """Evaluate window expressions whose frames reach at most ``preceding`` rows
    back (``lag(n<=preceding)``, ``rowsBetween(-preceding, 0)``) and ``following`` rows
    ahead.  Each callable receives a spec already partitioned by series and ordered by time."""
    s = s.present(df)
    if layout.strategy == "series":
        w = plain_window(s)
        return df.withColumns({k: f(w) for k, f in exprs.items()})
    b = layout.block_rows
    d = with_position(df, s, layout)
    SK, POS = sk_col(s), pos_col(s)
    own = F.floor(F.col(POS) / b)
    # a row is also needed by every later block its position + frame reaches (halo)
    reach = F.floor((F.col(POS) + preceding) / b)
    first = F.floor(F.greatest(F.col(POS) - following, F.lit(0)) / b) if following else own
    d = d.withColumn("_blk", F.explode(F.sequence(first, reach)))
    w = Window.partitionBy(SK, "_blk").orderBy(POS)
    d = d.withColumns({k: f(w) for k, f in exprs.items()})
    return d.where(F.col("_blk") == own).drop("_blk")


def range_over(df: DataFrame, exprs: WindowExprs, span: str | int,
               s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT,
               order_col: str = "_us") -> DataFrame:
    """Evaluate time-RANGE window expressions reaching ``span`` back.  Callables get
    a spec ordered by ``_us`` (epoch micro-seconds) so ``rangeBetween(-us, 0)``
    works; peers (equal timestamps) are in the frame, as in the reference."""
    s = s.present(df)
    span_us = parse_span(span)
    d = df.withColumn(order_col, epoch_micros(df, s.ts))
    if layout.strategy == "series":
        w = Window.partitionBy(*s.key).orderBy(order_col)
        return d.withColumns({k: f(w) for k, f in exprs.items()}).drop(order_col)
    cu = layout.chunk_us
    d = series_key(d, s)
    SK = sk_col(s)
    own = F.floor(F.col(order_col) / cu)
    reach = F.floor((F.col(order_col) + span_us) / cu)
    d = d.withColumn("_rc", F.explode(F.sequence(own, reach)))
    w = Window.partitionBy(SK, "_rc").orderBy(order_col)
    d = d.withColumns({k: f(w) for k, f in exprs.items()})
    return d.where(F.col("_rc") == own).drop("_rc", order_col)


def running(df: DataFrame, outputs: Mapping[str, tuple[str, Column]],
            s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Unbounded running aggregates in time order (first row .. current row).

    ``outputs`` maps output name -> (op, value column) with op in
    ``sum`` (running total), ``max`` (running maximum), ``last`` (last non-NULL value).
    """
    s = s.present(df)
    if layout.strategy == "series":
        w = plain_window(s).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({k: _running_expr(op, v, w) for k, (op, v) in outputs.items()})
    b = layout.block_rows
    SK, POS = sk_col(s), pos_col(s)
    d = with_position(df, s, layout).withColumn("_blk", F.floor(F.col(POS) / b))
    for k, (_, v) in outputs.items():
        d = d.withColumn(f"_v_{k}", v)
    # in-block running value
    w = Window.partitionBy(SK, "_blk").orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"_in_{k}": _running_expr(op, F.col(f"_v_{k}"), w) for k, (op, _) in outputs.items()})
    # per-block totals -> carry from all earlier blocks (small table: one row per block)
    tot = d.groupBy(SK, "_blk").agg(*[_block_total(op, k, POS) for k, (op, _) in outputs.items()])
    before = Window.partitionBy(SK).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(SK, "_blk", *[
        _running_expr(op, F.col(f"_t_{k}"), before).alias(f"_c_{k}") for k, (op, _) in outputs.items()])
    d = d.join(carry, [SK, "_blk"])
    out = {}
    for k, (op, _) in outputs.items():
        i, c = F.col(f"_in_{k}"), F.col(f"_c_{k}")
        if op == "sum":
            out[k] = F.coalesce(c, F.lit(0)) + F.coalesce(i, F.lit(0))
        elif op == "max":
            out[k] = F.greatest(i, c)
        else:
            out[k] = F.coalesce(i, c)
    drop = ["_blk"] + [f"_{p}_{k}" for k in outputs for p in ("v", "in", "c")]
    return d.withColumns(out).drop(*drop)


def _running_expr(op: str, v: Column | str, w: WindowSpec) -> Column:
    v = F.col(v) if isinstance(v, str) else v
    if op == "sum":
        return F.sum(v).over(w)
    if op == "max":
        return F.max(v).over(w)
    if op == "last":
        return F.last(v, ignorenulls=True).over(w)
    raise ValueError(op)


def _block_total(op: str, k: str, POS: str) -> Column:
    v = F.col(f"_v_{k}")
    if op == "sum":
        return F.sum(v).alias(f"_t_{k}")
    if op == "max":
        return F.max(v).alias(f"_t_{k}")
    # last non-NULL value of the block, by position
    return F.max_by(v, F.when(v.isNotNull(), F.col(POS))).alias(f"_t_{k}")


def drop_internal(df: DataFrame) -> DataFrame:
    """Drop every hidden series-key / position column."""
    return df.drop(*[c for c in df.columns if c.startswith(("_sk_", "_pos_"))])


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the session's checkpoint folder (``spark.checkpoint.dir``,
    a shared folder on a cluster) and cut its lineage.  Used where a composite
    operator reads one intermediate twice."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
