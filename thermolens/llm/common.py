"""Shared helpers: words, checkpoints, worker code, distributed gapless numbering."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

# ASCII white space that separates words (fixed by the query contracts).
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(c: str | Column = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def words_of(text: Column) -> Column:
    """``[^\\x20\\x09-\\x0D]+`` words of a text, in order (built-in functions only)."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to ``spark.checkpoint.dir`` (shared by all executors), lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with the computed columns ``names`` finished: a filter on them stays above.

    A filter is otherwise pushed through the projections that compute its columns and inlined
    there; inside a lambda that means once per array element.  Nothing is pushed
    through a generator's output, so the columns pass through one.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    one = F.array(F.struct(*[F.col(f"`{c}`") for c in names]))
    d = df.select(*rest, F.explode_outer(one).alias("_done"))
    return d.select(*rest, *[F.col(f"_done.`{c}`").alias(c) for c in names])


def texts_of(column, rows: int = 256):
    """The strings of an Arrow column, a few hundred at a time: a whole batch of long
    texts as Python strings would double a worker's memory."""
    for a in range(0, len(column), rows):
        yield from column.slice(a, rows).to_pylist()


def give_back() -> None:
    """Hand freed memory back to the system: a worker outlives its task, and the next one may be another's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not on every platform
        pass


def with_workers(spark: SparkSession) -> None:
    """Make this package importable in Python workers."""
    ship_package(spark)


def gapless_positions(df: DataFrame, keys: list[str], spread: Column, order: list[Column | str],
                      name: str, total_rows: int, chunk_rows: int = 50_000) -> DataFrame:
    """Add ``name``: positions 0, 1, 2, ... without gaps within ``keys``.

    A key may hold any share of the rows: its rows are dealt by ``spread`` (a long)
    into chunks of about ``chunk_rows`` rows, counted per (key, chunk) with a partial
    aggregate, and numbered inside each chunk; running offsets over the small count
    table make the numbers gapless.  Rows equal in ``order`` are interchangeable.
    """
    n_chunks = max(1, -(-int(total_rows) // chunk_rows))
    d = df.withColumn("_chunk", F.pmod(spread, F.lit(n_chunks)).cast("int"))
    k = [F.struct(*[F.col(c) for c in keys]).alias("_key"), "_chunk"]
    counts = d.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_key", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    d = d.withColumn("_key", k[0])
    rn = F.row_number().over(Window.partitionBy("_key", "_chunk").orderBy(*order))
    d = d.withColumn("_rn", rn).join(offsets, ["_key", "_chunk"])
    return d.withColumn(name, (F.col("_off") + F.col("_rn") - 1).cast("long")).drop("_key", "_chunk", "_off", "_rn")
