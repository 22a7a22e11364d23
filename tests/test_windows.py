"""The blocked layout (positions, row blocks with halo, time chunks with halo,
block carries) gives exactly the plain per-series window results."""

import random

from pyspark.sql import functions as F

from helpers import rows_of, same_rows, ts
from thermolens.operators import timeseries as tsop
from thermolens.operators.windows import Layout, SERIES_LAYOUT, range_over, rows_over, running, with_position, pos_col
from thermolens.schema import Series

TINY = Layout(strategy="blocked", chunk="3 hours", block_rows=7)


def _data(spark, n=200, seed=1):
    rnd = random.Random(seed)
    rows = []
    for sid, typ in [("a", "domestic"), ("b", "domestic"), ("c", "forward"), (None, "forward")]:
        t = 0
        for _ in range(n):
            t += rnd.choice([15, 30, 60, 60, 60, 120, 600])
            v = None if rnd.random() < 0.05 else rnd.uniform(0, 100)
            rows.append((ts(1) + __import__("datetime").timedelta(minutes=t), v, typ, sid))
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, avg double, type string, ID string")


def test_positions_are_exact(spark):
    df = _data(spark)
    a = with_position(df, Series(), TINY)
    b = with_position(df, Series(), SERIES_LAYOUT)
    p = pos_col(Series())
    assert rows_of(a, ["type", "ID", "timestamp", p]) == rows_of(b, ["type", "ID", "timestamp", p])


def test_rows_frames_match(spark):
    df = _data(spark)
    exprs = {"m": lambda w: F.avg("avg").over(w.rowsBetween(-5, 0)),
             "s": lambda w: F.stddev_samp("avg").over(w.rowsBetween(-5, 0)),
             "l": lambda w: F.lag("avg", 6).over(w)}
    a = rows_over(df, exprs, 6, Series(), TINY)
    b = rows_over(df, exprs, 6, Series(), SERIES_LAYOUT)
    cols = ["type", "ID", "timestamp", "m", "s", "l"]
    assert same_rows(rows_of(a, cols), rows_of(b, cols))


def test_range_frames_match(spark):
    df = _data(spark)
    us = 5 * 3_600_000_000
    exprs = {"m": lambda w: F.avg("avg").over(w.rangeBetween(-us, 0)),
             "n": lambda w: F.count(F.lit(1)).over(w.rangeBetween(-us, 0))}
    a = range_over(df, exprs, us, Series(), TINY)
    b = range_over(df, exprs, us, Series(), SERIES_LAYOUT)
    cols = ["type", "ID", "timestamp", "m", "n"]
    assert same_rows(rows_of(a, cols), rows_of(b, cols))


def test_running_carries_match(spark):
    df = _data(spark).withColumn("one", F.lit(1))
    outs = {"cnt": ("sum", F.col("one")), "mx": ("max", F.col("avg")), "ff": ("last", F.col("avg"))}
    a = running(df, outs, Series(), TINY)
    b = running(df, outs, Series(), SERIES_LAYOUT)
    cols = ["type", "ID", "timestamp", "cnt", "mx", "ff"]
    assert same_rows(rows_of(a, cols), rows_of(b, cols))


def test_feature_operators_layout_invariant(spark):
    df = _data(spark).withColumns({"min_v": F.col("avg") - 1, "max_v": F.col("avg") + 1})
    from thermolens.operators.clean import prepare_readings
    from thermolens.operators.detect.rolling import find_anomaly_domestic
    for L in (TINY, SERIES_LAYOUT):
        r = prepare_readings(df, layout=L)
        out = find_anomaly_domestic(r, "domestic", 24, 1.0, layout=L)
        if L is TINY:
            first = (rows_of(r), rows_of(out))
        else:
            assert same_rows(first[0], rows_of(r)) and first[1] == rows_of(out)


def test_null_key_part_is_its_own_series(spark):
    df = _data(spark, n=30)
    a = rows_over(df, {"l": lambda w: F.lag("timestamp").over(w)}, 1, Series(), TINY)
    firsts = a.where(F.col("l").isNull()).count()
    assert firsts == 4   # one first row per series, including ID = NULL


def test_a_crowded_chunk_is_split(spark):
    """A third of all rows in one chunk of one series, many at one time: same positions, no part above a set size."""
    import datetime as dt

    from thermolens.operators.windows import split_chunks
    rnd = random.Random(4)
    rows = [(ts(1) + dt.timedelta(seconds=rnd.randrange(3600)), float(i), "domestic", "hot") for i in range(2000)]
    rows += [(ts(1, 2), float(i), "domestic", "hot") for i in range(40)]
    rows += [(ts(1 + i % 20) + dt.timedelta(seconds=rnd.randrange(80_000)), float(i), "domestic", str(i % 7)) for i in range(1500)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, avg double, type string, ID string").repartition(5)
    s = Series(tiebreak=("avg",))
    a = with_position(df, s, Layout(chunk="1 day", chunk_rows=300))
    b = with_position(df, s, SERIES_LAYOUT)
    cols = ["type", "ID", "timestamp", "avg", pos_col(s)]
    assert rows_of(a, cols) == rows_of(b, cols)
    d = df.where("ID = 'hot'").select(F.struct("type", "ID").alias("k"), F.lit(0).alias("_chunk"), F.unix_micros(
        F.col("timestamp").cast("timestamp")).alias("us"))
    parts = split_chunks(d, d.select("k", "_chunk").distinct(), F.col("us"), "k").groupBy("_sub").agg(
        F.count("*").alias("n"), F.countDistinct("us").alias("times")).collect()
    assert len(parts) > 150 and all(p["n"] <= 40 + 24 for p in parts)


def test_frames_that_look_ahead_match(spark):
    df = _data(spark)
    exprs = {"next": lambda w: F.lead("avg", 2).over(w), "m": lambda w: F.avg("avg").over(w.rowsBetween(-3, 2))}
    a = rows_over(df, exprs, 3, Series(), TINY, following=2)
    b = rows_over(df, exprs, 3, Series(), SERIES_LAYOUT, following=2)
    cols = ["type", "ID", "timestamp", "next", "m"]
    assert same_rows(rows_of(a, cols), rows_of(b, cols))


def test_periods_read_their_input_once(spark):
    """What is left of the plan after the two writes has no scan of the input."""
    df = _data(spark).withColumn("anomaly", F.coalesce(F.col("avg") > 70, F.lit(False)))
    a = rows_of(tsop.anomaly_periods(df, "anomaly", Series(), TINY))
    b = rows_of(tsop.anomaly_periods(df, "anomaly", Series(), SERIES_LAYOUT))
    assert a == b and len(a) > 20
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("ts").alias("timestamp"), F.lit("domestic").alias("type"), F.col("user_id").cast("string").alias("ID"),
        (F.col("value") > 50).alias("anomaly"))
    plan = tsop.anomaly_periods(events)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()
