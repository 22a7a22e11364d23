"""Structured Streaming versions of the row-local and bounded-state operators
(T1-T9).

* T1 ``stream_rollup``: watermark + tumbling window aggregate, append mode; a
  window is emitted once the watermark passes its end (the tail stays open).
* T2 ``stream_domain_rules`` / T3 ``stream_score`` / T4 ``stream_ensemble``:
  stateless; parameters are frozen batch tables joined stream-static (broadcast).
* T5-T7 ``stream_series_state`` (``series_state``): typed per-series state and event-time
  timers; rows are released in event-time order once the watermark has passed, so
  micro-batch boundaries and arrival order do not change results.
* T8 ``monitor``: ``foreachBatch`` validation report appended per micro-batch.
* T9 ``stream_dedup``: ``dropDuplicatesWithinWatermark`` on (series, timestamp).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.detect.baseline import baseline_predict
from ..operators.detect.ensemble import ensemble_predict
from ..operators.detect.rules import domain_rules
from ..operators.windows import parse_span
from ..schema import SERIES_KEY
from ..sources.readers import rollup_readings
from .series_state import SERIES_OUT, STATE_STORE, released_rest, stream_series_state
from .time_order import SLICE_ROWS, file_stream, sources_in_order

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"


def events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """The Parquet files of an ``events`` table as a stream; ``ts`` cast to TIMESTAMP because a
    watermark needs it (the session zone is UTC, so instants are unchanged)."""
    s = file_stream(spark, path, EVENTS_SCHEMA, max_files_per_trigger)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def readings_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1) -> DataFrame:
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    return s.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def stream_rollup(events: DataFrame, width: str = "1 hour", watermark: str = "1 hour",
                  key: Sequence[str] = ("event_type",), ts: str = "ts", value: str = "value") -> DataFrame:
    """Tumbling-window readings from raw samples; late rows past the watermark dropped."""
    v = F.nanvl(F.col(value), F.lit(None).cast("double"))
    return (events.withWatermark(ts, watermark)
            .groupBy(*key, F.window(ts, width).alias("w"))
            .agg(F.avg(v).alias("avg"), F.min(v).alias("min_v"), F.max(v).alias("max_v"),
                 F.stddev_samp(v).alias("stddev_v"))
            .select(*key, F.col("w.start").alias("timestamp"), "avg", "min_v", "max_v", "stddev_v"))


def stream_domain_rules(readings: DataFrame) -> DataFrame:
    """Stateless rules."""
    return domain_rules(readings, keep_rules=True)


def stream_score(readings: DataFrame, frozen_baseline: DataFrame, col: str = "avg") -> DataFrame:
    """Statistical detector with frozen (batch-fitted) parameters; the one-row
    parameter table is broadcast into the stream."""
    return baseline_predict(readings, frozen_baseline, col, out="statistical", score_out="statistical_score")


def stream_ensemble(scored: DataFrame, weights: Mapping[str, float], frozen_minmax: DataFrame,
                    threshold: float = 0.5) -> DataFrame:
    """T4: ensemble vote with min/max frozen from training (batch-relative
    normalisation cannot exist on an unbounded stream)."""
    return ensemble_predict(scored, weights, threshold, frozen_minmax=frozen_minmax)


def stream_dedup(readings: DataFrame, key: Sequence[str] = SERIES_KEY, ts: str = "timestamp",
                 watermark: str = "1 hour") -> DataFrame:
    """At-least-once guard: duplicates of (series, timestamp) within the watermark."""
    return readings.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([*key, ts])


def monitor(scored_stream: DataFrame, report_path: str, checkpoint: str, y: str = "is_anomaly",
            yhat: str = "ensemble", trigger: dict | None = None, name: str = "monitor"):
    """Per micro-batch validation row (V9) in a report table (S6).  A micro-batch that is run
    again replaces its row; ``name`` tells apart streams with checkpoints of their own."""
    from ..operators.validate import validation_report
    from ..sources.readers import write_report

    def per_batch(bdf: DataFrame, epoch: int) -> None:
        row = validation_report(bdf, y, yhat).withColumn("batch_id", F.lit(epoch).cast("long"))
        write_report(row, report_path, f"{name}-{epoch}")

    w = scored_stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


@dataclass
class StreamRun:
    """A finished run: the sink table, the query's checkpoint, its last watermark, and
    how many rows its stateful operator dropped as late."""

    table: DataFrame
    checkpoint: str
    watermark: str | None
    late: int


def run_stream(streams: DataFrame | Sequence[DataFrame], name: str) -> StreamRun:
    """Run a stream over everything available (``availableNow``) into a Parquet sink
    under the shared checkpoint folder; no row passes through the driver.  Several streams are the same
    query on sources that follow each other; they are run one after the other with one checkpoint."""
    streams = [streams] if isinstance(streams, DataFrame) else list(streams)
    spark = streams[0].sparkSession
    base = checkpoint_location(spark, name)
    late, watermark = 0, None
    store, own = "spark.sql.streaming.stateStore.providerClass", STATE_STORE
    before = spark.conf.get(store, None)
    spark.conf.set(store, own)  # typed state needs it; a query takes it over when it starts
    try:
        for stream in streams:
            q = (stream.writeStream.format("parquet").queryName(f"{name}_{uuid.uuid4().hex[:6]}").outputMode("append")
                 .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
                 .trigger(availableNow=True).start())
            dropped: dict[int, int] = {}
            done = False
            while not done:         # Spark keeps the last 100 reports only
                done = q.awaitTermination(1)
                for p in q.recentProgress:
                    n = sum(o.get("numRowsDroppedByWatermark", 0) for o in p["stateOperators"])
                    dropped[p["batchId"]] = max(n, dropped.get(p["batchId"], 0))
            late += sum(dropped.values())
            times = [p["eventTime"].get("watermark") for p in q.recentProgress if p["eventTime"]]
            watermark = times[-1] if times and times[-1] else watermark
    finally:
        spark.conf.unset(store) if before is None else spark.conf.set(store, before)
    table = spark.read.schema(streams[0].schema).parquet(f"{base}/out")
    return StreamRun(table, f"{base}/checkpoint", watermark, late)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """``run_stream``'s table: a stateless or append-mode stream as a batch DataFrame."""
    return run_stream(stream, name).table


def streams_in_order(spark: SparkSession, path: str, delay: str = "1 hour", slice_rows: int = SLICE_ROWS) -> list[DataFrame]:
    """The ``events`` files at ``path`` as streams that, run one after the other, bring no row late
    under ``delay``."""
    paths = sources_in_order(spark, path, "ts", delay, slice_rows)
    if paths == [path]:
        return [events_stream(spark, path)]
    return [events_stream(spark, p, None) for p in paths]


def run_rollup(events: DataFrame | Sequence[DataFrame], batch_events: DataFrame, name: str,
               then: Callable[[DataFrame], DataFrame], width: str = "1 hour", watermark: str = "1 hour",
               key: Sequence[str] = ("event_type",), ts: str = "ts", value: str = "value") -> DataFrame:
    """T1 and what follows it (``then``) over a finite stream, all windows included:
    the windows that the last watermark left open are rolled up from the end of the
    same input, now that no more rows can come.  If rows were late, which ``streams_in_order``
    rules out, all windows are rolled up from that input."""
    events = [events] if isinstance(events, DataFrame) else list(events)
    run = run_stream([then(stream_rollup(e, width, watermark, key, ts, value)) for e in events], name)
    rest = batch_events
    if run.watermark and not run.late:
        end = F.to_timestamp(F.lit(run.watermark)).cast(batch_events.schema[ts].dataType)
        span = F.make_interval(secs=F.lit(parse_span(width) / 1_000_000))
        rest = rest.where(F.col(ts) >= end - span).where(F.window(ts, width).end > end)  # the first one reaches the scan
    rest = rollup_readings(rest.withColumn(ts, F.col(ts).cast("timestamp")), width, key, ts, value)
    rest = rest.select(*key, "timestamp", "avg", "min_v", "max_v", "stddev_v")
    return then(rest) if run.late else run.table.unionByName(then(rest))


def run_series_state(readings: DataFrame | Sequence[DataFrame], name: str, watermark: str = "1 hour", window: int = 24,
                     k: float = 2.0, key: Sequence[str] = SERIES_KEY) -> DataFrame:
    """T5-T7 over a finite stream, its end included: what is still buffered, and runs
    still open, are read from the query's state and released as if the watermark had passed.
    One 'late' record without a key counts readings that Spark dropped behind the watermark;
    ``streams_in_order`` rules them out."""
    readings = [readings] if isinstance(readings, DataFrame) else list(readings)
    run = run_stream([stream_series_state(r, watermark, window, k, key) for r in readings], name)
    spark = readings[0].sparkSession
    out = run.table.unionByName(released_rest(spark, run.checkpoint, window, k, key))
    if run.late:
        row = tuple({"record": "late", "n_rows": run.late}.get(f.name) for f in SERIES_OUT.fields)
        out = out.unionByName(spark.createDataFrame([row], SERIES_OUT))
    return out
