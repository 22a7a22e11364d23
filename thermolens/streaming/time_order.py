"""Feeding a finite folder of Parquet files to a stream in event-time order.

A file stream reads files by modification time.  Where that is also their time order (up to the
watermark's delay), the folder is read as it is.  Otherwise its rows are written once to
time slices of nearly equal row counts (quantiles of the time column, from a mergeable sketch), each slice a
folder of its own, and the stream is started on one slice after the other with one checkpoint: every slice
is one micro-batch, no row is late under the fixed delay, and the state holds no more than a slice and
the delay.
"""

from __future__ import annotations

import uuid
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import parse_span

SLICE_ROWS = 20_000_000
MAX_SLICES = 1_000


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def disorder(files: list[tuple[int, int, int]]) -> int:
    """Micro-seconds by which a row can lie behind an earlier file's newest row, for files (modification
    time, oldest row, newest row); files with one modification time may come in any order."""
    lag, before = 0, None
    for _, same in groupby(sorted(files), key=lambda r: r[0]):
        same = sorted(same, key=lambda r: r[2])
        for r in same:
            other = same[-1] if r is not same[-1] else same[-2] if len(same) > 1 else None
            ahead = [x for x in (before, other and other[2]) if x is not None]
            lag = max([lag, *[x - r[1] for x in ahead]])
        before = max(x for x in (before, same[-1][2]) if x is not None)
    return lag


def input_disorder(spark: SparkSession, path: str, ts: str = "ts") -> int:
    """``disorder`` of the Parquet files at ``path``; reads the time column only, and brings one row per file
    to the driver, which lists the same files for the stream."""
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("m"), _micros(ts).alias("t"))
    rows = rows.groupBy("f", "m").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo is not null").collect()
    return disorder([(r["m"], r["lo"], r["hi"]) for r in rows])


def sliced(spark: SparkSession, path: str, ts: str = "ts", slice_rows: int = SLICE_ROWS) -> list[str]:
    """Folders under ``spark.checkpoint.dir`` that hold the rows of ``path``, in time order; rows without a
    time are in the first one."""
    from ..session import ensure_checkpoint_dir
    d = spark.read.parquet(path)
    n = d.count()
    slices = max(2, min(MAX_SLICES, -(-n // slice_rows)))
    cuts = d.agg(F.percentile_approx(_micros(ts), [i / slices for i in range(1, slices)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    at = F.lit(0)
    for i, c in enumerate(cuts):
        at = F.when(_micros(ts) > F.lit(c), F.lit(i + 1)).otherwise(at)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/slices/{uuid.uuid4().hex}"
    d.withColumn("_slice", at).hint("rebalance", F.col("_slice")).write.partitionBy("_slice").parquet(base)
    made = sorted(r["_slice"] for r in spark.read.parquet(base).select("_slice").distinct().collect())
    return [f"{base}/_slice={i}" for i in made]


def sources_in_order(spark: SparkSession, path: str, ts: str = "ts", delay: str = "1 hour",
                     slice_rows: int = SLICE_ROWS) -> list[str]:
    """Paths to feed one after the other so that no row is late under ``delay``."""
    if input_disorder(spark, path, ts) < parse_span(delay):
        return [path]
    return sliced(spark, path, ts, slice_rows)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = 1) -> DataFrame:
    """The Parquet files at ``path`` as a stream; a path of one file is given as a pattern, which a
    stream needs."""
    name = path.rstrip("/")
    if name.endswith(".parquet"):  # one file or a folder of that name
        name = f"{name[:-1]}[{name[-1]}]"
    s = spark.readStream.schema(schema)
    if max_files_per_trigger:
        s = s.option("maxFilesPerTrigger", max_files_per_trigger)
    return s.parquet(name)
