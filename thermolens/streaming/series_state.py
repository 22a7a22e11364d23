"""T5-T7 on ``transformWithStateInPandas``: per-series state of a readings stream.

State of a series, in the RocksDB store (on disk, keyed):

* ``buffer``: a list of (time, value) of readings that the watermark has not passed.  New readings are
  appended; nothing is read back for that.
* ``series``: one typed value: the last released reading, the last ``window - 1`` values, the open
  anomaly run, the number of runs.

An event-time timer stands at the end of the oldest time bucket that has buffered readings: one timer per series and
micro-batch, however many buckets the readings reach over.  When the watermark passes it, all readings before the bucket
the watermark has reached are released in time order and the rest, no more than the delay and a bucket, is
put back with a timer of its own.  Buckets are as wide as the delay, so a reading is read back about twice, however small
micro-batches are.

Released readings are measured a whole array at a time (``measured``): gap and per-minute rate
(T5), rolling mean, deviation and flag (T6), period numbers and closed periods (T7).  They leave Python as a few arrays
(``PACKED``), one row for up to ``ROLL_ROWS`` readings, and become rows in built-in functions (``unpacked``): a data frame of all
columns per series would cost more than the measuring.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.windows import parse_span
from ..schema import SERIES_KEY

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SERIES_OUT = T.StructType([
    T.StructField("record", T.StringType()),             # 'reading', 'period' or 'late'
    T.StructField("type", T.StringType()), T.StructField("ID", T.StringType()),
    T.StructField("timestamp", T.TimestampType()), T.StructField("avg", T.DoubleType()),
    T.StructField("time_diff_min", T.LongType()), T.StructField("avg_rate_per_min", T.DoubleType()),
    T.StructField("avg_rolling_mean", T.DoubleType()), T.StructField("avg_rolling_std", T.DoubleType()),
    T.StructField("anomaly", T.BooleanType()), T.StructField("period_no", T.LongType()),
    T.StructField("start_ts", T.TimestampType()), T.StructField("end_ts", T.TimestampType()),
    T.StructField("n_rows", T.LongType()),
])
BUFFER = T.StructType([T.StructField("us", T.LongType()), T.StructField("avg", T.DoubleType())])
SERIES = T.StructType([
    T.StructField("until", T.LongType()),                # everything before it has been released
    T.StructField("last_us", T.LongType()), T.StructField("last_avg", T.DoubleType()),
    T.StructField("win", T.ArrayType(T.DoubleType())),
    T.StructField("run_start", T.LongType()), T.StructField("run_end", T.LongType()), T.StructField("run_rows", T.LongType()),
    T.StructField("runs", T.LongType()),
])
PACKED = T.StructType([                                  # n readings and m closed periods of one series
    T.StructField("type", T.StringType()), T.StructField("ID", T.StringType()),
    T.StructField("longs", T.ArrayType(T.LongType())),      # n times, n gaps, n period numbers (0: not flagged)
    T.StructField("doubles", T.ArrayType(T.DoubleType())),  # n values, n rates, n means, n deviations
    T.StructField("periods", T.ArrayType(T.LongType())),    # m times number, first and last time, readings
])
NO_GAP = -(1 << 62)
HELD = np.dtype([("us", np.int64), ("avg", np.float64)])
NEW_SERIES = (None, None, None, [], None, None, None, 0)


def _nan(v) -> float:
    return np.nan if v is None else v


ROLL_ROWS = 65_536


def rolled(line: np.ndarray, n: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of the last ``n`` frames of ``window`` values of ``line``, NaN left out; at most ``ROLL_ROWS``
    frames are laid out at once."""
    mean, std = np.empty(n), np.empty(n)
    every = np.lib.stride_tricks.sliding_window_view(line, window)[-n:] if n else np.empty((0, window))
    for lo in range(0, n, ROLL_ROWS):
        frames = every[lo:lo + ROLL_ROWS]
        have = ~np.isnan(frames)
        count = have.sum(axis=1)
        with np.errstate(invalid="ignore", divide="ignore"):
            m = np.where(have, frames, 0.0).sum(axis=1) / count
            off = np.where(have, frames - m[:, None], 0.0)
            std[lo:lo + ROLL_ROWS] = np.where(count > 1, np.sqrt((off * off).sum(axis=1) / (count - 1)), np.nan)
        mean[lo:lo + ROLL_ROWS] = m
    return mean, std


def measured(key: Sequence, us: np.ndarray, avg: np.ndarray, state: tuple, window: int, k: float,
             until: int | None = None, close: bool = False) -> tuple[pd.DataFrame, tuple]:
    """(output records, new state) of readings that are released; avg: NaN for a missing value.
    ``close``: no more readings can come, so the open run ends."""
    part, new = measured_part(us, avg, state, window, k, until, close)
    return records([(key, part)]), new


def measured_part(us: np.ndarray, avg: np.ndarray, state: tuple, window: int, k: float,
                  until: int | None = None, close: bool = False) -> tuple[tuple, tuple]:
    """``measured`` without a data frame: ((columns of the readings, closed periods), new state)."""
    _, last_us, last_avg, win, run_start, run_end, run_rows, runs = state
    order = np.lexsort((avg, np.isnan(avg) == 0, us))  # missing values first within a time
    us, avg = us[order], avg[order]
    n = len(us)
    before_us = np.r_[np.nan if last_us is None else last_us, us[:-1].astype(np.float64)][:n]
    gap = np.floor((us - before_us) / 60_000_000)
    before = np.r_[_nan(last_avg), avg[:-1]][:n]
    with np.errstate(invalid="ignore", divide="ignore"):
        rate = np.where(gap > 0, (avg - before) / gap, 0.0)
    past = np.array([_nan(v) for v in win], dtype=np.float64)
    line = np.r_[np.full(window - 1 - len(past), np.nan), past, avg]
    mean, std = rolled(line, n, window)
    with np.errstate(invalid="ignore"):
        flag = np.abs(avg - mean) > k * std  # NaN compares false

    # runs of flagged readings; the first may go on from before
    open_before = run_start is not None
    start = flag & ~np.r_[open_before, flag[:-1]][:n]
    number = runs + np.cumsum(start)
    ends = np.flatnonzero(~flag & np.r_[open_before, flag[:-1]][:n])  # the reading after a run's last
    first = us[start].tolist()
    size = np.diff(np.r_[0, np.cumsum(flag)[ends]]).tolist()
    if open_before:
        first.insert(0, run_start)
    last = [int(us[e - 1]) if e else run_end for e in ends.tolist()]
    if size and open_before:
        size[0] += run_rows
    numbers = (runs + np.arange(len(first)) + (0 if open_before else 1)).tolist()
    periods = list(zip(numbers, first, last, size))
    runs += int(start.sum())
    run = (None, None, None)
    if len(first) > len(ends):
        held = int(flag[ends[-1]:].sum()) if len(ends) else int(flag.sum()) + (run_rows if open_before else 0)
        run = (int(first[-1]), int(us[-1]) if n and flag[-1] else run_end, held)
    if close and run[0] is not None:
        periods.append((numbers[-1], *run))
        run = (None, None, None)

    kept = line[len(line) - (window - 1):] if window > 1 else line[:0]
    tail = [None if np.isnan(v) else float(v) for v in kept][-(len(past) + n):] if len(past) + n else []
    new = (until, int(us[-1]) if n else last_us, (None if np.isnan(avg[-1]) else float(avg[-1])) if n else last_avg,
           tail, *run, runs)
    return ((us, avg, gap, rate, mean, std, flag, number), periods), new


def records(parts: Sequence[tuple]) -> pd.DataFrame:
    """``SERIES_OUT`` rows of (key, part) pairs: the readings of all, then the closed periods of all."""
    sizes = [len(part[0][0]) for _, part in parts]
    closed = [(key, p) for key, (_, periods) in parts for p in periods]
    n, m = sum(sizes), len(closed)
    us, avg, gap, rate, mean, std, flag, number = (
        (np.concatenate(cols) if len(cols) > 1 else cols[0]) if cols else np.empty(0)
        for cols in (zip(*[part[0] for _, part in parts]) if parts else [()] * 8))
    names = [key for (key, _), size in zip(parts, sizes) for _ in range(size)] + [key for key, _ in closed]
    no, first, last, rows = np.array([p for _, p in closed], dtype=np.int64).reshape(m, 4).T
    flag = flag.astype(bool)
    is_period = np.r_[np.zeros(n, bool), np.ones(m, bool)]

    def text(i):
        return np.array([key[i] for key in names], dtype=object)

    def real(v):
        return np.r_[v.astype(np.float64), np.full(m, np.nan)]

    def whole(of_readings, missing, of_periods=None):
        v = np.r_[np.where(missing, 0, of_readings).astype(np.int64), np.zeros(m, np.int64) if of_periods is None else of_periods]
        return pd.arrays.IntegerArray(v, np.r_[missing, np.full(m, of_periods is None)])

    def time(of_readings, of_periods):
        none = np.iinfo(np.int64).min
        return np.r_[np.full(n, none) if of_readings is None else of_readings.astype(np.int64),
                     np.full(m, none) if of_periods is None else of_periods].astype("datetime64[us]")

    every = np.ones(n, bool)
    return pd.DataFrame({
        "record": np.where(is_period, "period", "reading").astype(object), "type": text(0), "ID": text(1),
        "timestamp": time(us, None), "avg": real(avg), "time_diff_min": whole(gap, np.isnan(gap.astype(np.float64))),
        "avg_rate_per_min": real(rate), "avg_rolling_mean": real(mean), "avg_rolling_std": real(std),
        "anomaly": pd.arrays.BooleanArray(np.r_[flag, np.zeros(m, bool)], is_period),
        "period_no": whole(number, ~flag, no), "start_ts": time(None, first), "end_ts": time(None, last),
        "n_rows": whole(np.zeros(n), every, rows)})


def packed(key: Sequence, part: tuple) -> Iterator[pd.DataFrame]:
    """``PACKED`` rows of a part, one for up to ``ROLL_ROWS`` readings."""
    (us, avg, gap, rate, mean, std, flag, number), periods = part
    gap = np.where(np.isnan(gap), NO_GAP, gap).astype(np.int64)
    number = np.where(flag, number, 0).astype(np.int64)
    for lo in range(0, max(1, len(us)), ROLL_ROWS):
        at = slice(lo, lo + ROLL_ROWS)
        closed = np.array(periods if lo == 0 else [], dtype=np.int64).ravel()
        if len(us) or len(closed):
            yield pd.DataFrame({
                "type": [key[0]], "ID": [key[1]], "longs": [np.concatenate([us[at], gap[at], number[at]])],
                "doubles": [np.concatenate([avg[at], rate[at], mean[at], std[at]])], "periods": [closed]})


def unpacked(d: DataFrame) -> DataFrame:
    """The ``SERIES_OUT`` rows of ``PACKED`` rows."""
    n, m = F.size("longs") / 3, F.size("periods") / 4
    d = d.withColumns({"_n": n.cast("int"), "_i": F.explode(F.sequence(F.lit(0), (n + m - 1).cast("int")))})
    n, i = F.col("_n"), F.col("_i")
    real = lambda j: F.nanvl(F.get("doubles", n * j + i), F.lit(None).cast("double"))
    long = lambda j: F.get("longs", n * j + i)
    mine = lambda c: F.when(i < n, c)
    closed = lambda j: F.when(i >= n, F.get("periods", (i - n) * 4 + j))
    return d.select(
        F.when(i < n, "reading").otherwise("period").alias("record"), "type", "ID",
        mine(F.timestamp_micros(long(0))).alias("timestamp"), mine(real(0)).alias("avg"),
        mine(F.nullif(long(1), F.lit(NO_GAP))).alias("time_diff_min"), mine(real(1)).alias("avg_rate_per_min"),
        mine(real(2)).alias("avg_rolling_mean"), mine(real(3)).alias("avg_rolling_std"), mine(long(2) > 0).alias("anomaly"),
        F.when(i < n, F.nullif(long(2), F.lit(0).cast("long"))).otherwise(closed(0)).alias("period_no"),
        F.timestamp_micros(closed(1)).alias("start_ts"), F.timestamp_micros(closed(2)).alias("end_ts"), closed(3).alias("n_rows"))


class SeriesProcessor(StatefulProcessor):
    """Buffers the readings of a series and releases them behind the watermark."""

    def __init__(self, window: int, k: float, bucket_ms: int):
        self.window, self.k, self.bucket_ms = window, k, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", BUFFER)
        self.series = handle.getValueState("series", SERIES)

    def wake(self, us: int) -> None:
        """A timer at the end of the bucket that ``us``, the oldest of some buffered readings, is in."""
        self.handle.registerTimer((us // 1000 // self.bucket_ms + 1) * self.bucket_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        oldest = None
        for pdf in rows:
            us = pdf["timestamp"].to_numpy().astype("datetime64[us]").astype(np.int64)
            avg = pdf["avg"].to_numpy(dtype=np.float64, na_value=np.nan)
            self.buffer.appendList([(u, None if a != a else a) for u, a in zip(us.tolist(), avg.tolist())])
            oldest = int(us.min()) if oldest is None else min(oldest, int(us.min()))
        if oldest is not None:
            self.wake(oldest)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.series.get()  # None for a new series
        state = NEW_SERIES if state is None else tuple(state)
        end = expiredTimerInfo.getExpiryTimeInMs()
        if state[0] is not None and end * 1000 <= state[0]:
            return  # released with an earlier timer of this micro-batch
        until = max(end, timerValues.getCurrentWatermarkInMs() // self.bucket_ms * self.bucket_ms) * 1000
        held = np.fromiter(((u, _nan(a)) for u, a in self.buffer.get()), dtype=HELD)
        ready = held["us"] < until
        rest = held[~ready]
        if len(rest):
            self.buffer.put([(u, None if a != a else a) for u, a in rest.tolist()])
            self.wake(int(rest["us"].min()))
        else:
            self.buffer.clear()
        part, state = measured_part(held["us"][ready], held["avg"][ready], state, self.window, self.k, until)
        self.series.update(state)
        yield from packed(key, part)

    def close(self) -> None:
        pass


def stream_series_state(readings: DataFrame, watermark: str = "1 hour", window: int = 24, k: float = 2.0,
                        key: Sequence[str] = SERIES_KEY) -> DataFrame:
    """T5-T7 on a readings stream (``timestamp`` TIMESTAMP, ``avg``, two key columns).
    ``record = 'reading'`` rows carry gap / rate / rolling statistics / flag /
    period number; ``record = 'period'`` rows are closed anomaly periods.  Readings without a time
    are left out: they have no place in time order."""
    from ..session import ship_package
    spark = readings.sparkSession
    ship_package(spark)
    bucket_ms = max(60_000, parse_span(watermark) // 1000)
    d = readings.select(*key, "timestamp", F.nanvl("avg", F.lit(None).cast("double")).alias("avg"))
    d = d.where(F.col("timestamp").isNotNull()).withWatermark("timestamp", watermark)
    return unpacked(d.groupBy(*key).transformWithStateInPandas(
        statefulProcessor=SeriesProcessor(window, k, bucket_ms), outputStructType=PACKED, outputMode="append",
        timeMode="eventTime"))


REST_ROWS = 20_000


def released_rest(spark, checkpoint: str, window: int, k: float, key: Sequence[str] = SERIES_KEY) -> DataFrame:
    """What a finished stream's state still holds, released as if the watermark had passed it: buffered
    readings and open runs, from the state data source.  Series with neither are left out; the others are dealt
    into groups of about ``REST_ROWS`` rows, so that a series of a few readings is not a group of its own."""
    def state(name):
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    own = [F.col(f"key.{c}").alias(c) for c in key]
    buffer = state("buffer").select(F.struct(*own).alias("_key"), F.col("list_element").alias("_held"))
    series = state("series").select(F.struct(*own).alias("_key"), F.col("value").alias("_value"))
    waiting = buffer.select("_key").distinct().withColumn("_waits", F.lit(True))
    series = series.join(waiting, "_key", "left").where(F.col("_waits") | F.col("_value.run_start").isNotNull()).drop("_waits")
    groups = max(1, -(-(buffer.count() + series.count()) // REST_ROWS))
    dealt = F.pmod(F.xxhash64("_key"), F.lit(groups)).alias("_group")
    buffer = buffer.select(dealt, *[F.col(f"_key.{c}").alias(f"k{i}") for i, c in enumerate(key)], "_held.us", "_held.avg")
    series = series.select(dealt, *[F.col(f"_key.{c}").alias(f"k{i}") for i, c in enumerate(key)], "_value.*")
    names = [f"k{i}" for i in range(len(key))]

    def keys(pdf):
        return zip(*[[None if pd.isna(v) else v for v in pdf[c]] for c in names])

    def rest(group, held: pd.DataFrame, value: pd.DataFrame) -> pd.DataFrame:
        now = {}
        for one, row in zip(keys(value), value[SERIES.fieldNames()].itertuples(index=False)):
            row = [None if x is None or (np.ndim(x) == 0 and pd.isna(x)) else x for x in row]
            now[one] = (*row[:3], [None if pd.isna(v) else float(v) for v in row[3]],
                        *[None if v is None else int(v) for v in row[4:]])
        at: dict = {}
        for i, one in enumerate(keys(held)):
            at.setdefault(one, []).append(i)
        us, avg = held["us"].to_numpy(np.int64), held["avg"].to_numpy(np.float64, na_value=np.nan)
        parts = []
        for one in {**now, **at}:
            rows = at.get(one, [])
            parts.append((one, measured_part(us[rows], avg[rows], now.get(one, NEW_SERIES), window, k, close=True)[0]))
        return records(parts)

    return buffer.groupBy("_group").cogroup(series.groupBy("_group")).applyInPandas(rest, SERIES_OUT)
