"""Canonical readings tables derived from the driver's ``events`` table.

The test data hold no sensor table, so the readings are rolled up from events:

* ``readings_hourly``: per (event_type, hour) avg/min/max/stddev of ``value``;
  ``ID = event_type``; ``type`` is ``domestic`` for click and view, else ``forward``.
  The hourly mean is rounded to 6 digits so that summation order cannot move
  a comparison downstream.
* ``readings_per_event``: one reading per event; ``ID = user_id``,
  ``avg = value``, ``min_v``/``max_v`` = min/max over the preceding hour of the
  same user (a time-range window).  Many series, fully parallel by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import DEFAULT_LAYOUT, Layout, by_length, range_over
from ..schema import Series, clean_doubles
from .readers import rollup_readings

# Fixed mapping of event types to system types.
DOMESTIC_EVENT_TYPES = ("click", "view")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("ts", "event_type", "value")
    r = rollup_readings(ev, "1 hour", key=("event_type",), digits=6)
    return r.select(
        "timestamp", "avg", "min_v", "max_v", "stddev_v",
        F.when(F.col("event_type").isin(*DOMESTIC_EVENT_TYPES), F.lit("domestic"))
         .otherwise(F.lit("forward")).alias("type"),
        F.col("event_type").alias("ID"),
    )


def readings_per_event(spark: SparkSession, sf_dir: str, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    ev = events(spark, sf_dir).select(
        F.col("ts").alias("timestamp"), F.col("value").alias("avg"),
        F.lit("domestic").alias("type"), F.col("user_id").cast("string").alias("ID"))
    ev = clean_doubles(ev, ["avg"])
    hour = 3_600_000_000
    exprs = {
        "min_v": lambda w: F.min("avg").over(w.rangeBetween(-hour, 0)),
        "max_v": lambda w: F.max("avg").over(w.rangeBetween(-hour, 0)),
    }
    return by_length(ev, lambda rows, lay: range_over(rows, exprs, hour, Series(), lay).select(
        "timestamp", "avg", "min_v", "max_v", "type", "ID"), Series(), layout)
