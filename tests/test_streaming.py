"""Streams equal batch on closed windows / released rows, with shuffled
micro-batches."""

import random

import pandas as pd

from pyspark.sql import functions as F

from thermolens.operators.detect.rolling import rolling_sigma
from thermolens.operators.timeseries import time_diff_min
from thermolens.streaming.queries import readings_stream, run_to_table, stream_series_state

SF = "/root/testdata/sf0.001"


def test_series_state_matches_batch_with_shuffled_batches(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet").where(F.col("user_id") < 6)
    rd = ev.select(F.col("ts").alias("timestamp"), F.col("value").alias("avg"), F.lit("domestic").alias("type"),
                   F.col("user_id").cast("string").alias("ID"))
    pdf = rd.toPandas().sort_values("timestamp").reset_index(drop=True)
    chunks = [pdf.iloc[i:i + 15] for i in range(0, len(pdf), 15)]
    rnd = random.Random(3)
    for i, c in enumerate(chunks):        # rows inside a micro-batch arrive in random order
        spark.createDataFrame(c.sample(frac=1.0, random_state=rnd.randint(0, 999)), rd.schema) \
             .coalesce(1).write.mode("overwrite").parquet(f"{tmp_dir}/src/part={i:04d}")
    src = readings_stream(spark, f"{tmp_dir}/src", rd.schema, max_files_per_trigger=1)
    out = run_to_table(stream_series_state(src, "1 hour", 24, 2.0), "stream_test_series")
    got = {(r["ID"], r["timestamp"].replace(tzinfo=None)): r for r in out.where("record = 'reading'").collect()}
    assert len(got) > 0.8 * len(pdf)
    batch = rolling_sigma(time_diff_min(rd, fill_mode=False), keep_stats=True).collect()
    checked = 0
    for b in batch:
        g = got.get((b["ID"], b["timestamp"]))
        if g is None:
            continue
        checked += 1
        assert g["time_diff_min"] == b["time_diff_min"]
        assert g["anomaly"] == b["anomaly"]
        assert abs(g["avg_rolling_mean"] - b["avg_rolling_mean"]) < 1e-9
    assert checked == len(got)


def test_monitor_appends_reports(spark, tmp_dir):
    from thermolens.streaming.queries import checkpoint_location, monitor
    df = spark.createDataFrame([(True, 1), (False, 0)], "is_anomaly boolean, ensemble int")
    df.write.parquet(f"{tmp_dir}/scored")
    s = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/scored")
    q = monitor(s, f"{tmp_dir}/report", checkpoint_location(spark, "monitor"))
    q.awaitTermination()
    rep = spark.read.parquet(f"{tmp_dir}/report").collect()
    assert len(rep) == 1 and rep[0]["recall"] == 1.0 and rep[0]["batch_size"] == 2


def test_a_replayed_batch_is_reported_once(spark, tmp_dir):
    from thermolens.operators.validate import validation_report
    from thermolens.sources.readers import write_report
    df = spark.createDataFrame([(True, 1), (False, 0)], "is_anomaly boolean, ensemble int")
    for run in ("monitor-0", "monitor-1", "monitor-0", "other/0"):
        write_report(validation_report(df), f"{tmp_dir}/report", run)
    runs = [r["run"] for r in spark.read.parquet(f"{tmp_dir}/report").collect()]
    assert len(runs) == 3 and len(set(runs)) == 3
    write_report(validation_report(df), f"{tmp_dir}/appended")
    write_report(validation_report(df), f"{tmp_dir}/appended")
    assert spark.read.parquet(f"{tmp_dir}/appended").count() == 2


def test_monitor_run_again_over_its_first_batch(spark, tmp_dir):
    """The checkpoint is lost after the report was written: the batch comes again, its row does not."""
    from thermolens.streaming.queries import checkpoint_location, monitor
    df = spark.createDataFrame([(True, 1), (False, 0)], "is_anomaly boolean, ensemble int")
    df.write.parquet(f"{tmp_dir}/scored")
    s = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/scored")
    for _ in range(2):
        monitor(s, f"{tmp_dir}/report", checkpoint_location(spark, "monitor")).awaitTermination()
    assert [r["batch_id"] for r in spark.read.parquet(f"{tmp_dir}/report").collect()] == [0]


def test_streams_over_part_files_that_are_not_in_time_order(spark, tmp_dir):
    import os

    from thermolens.plans import catalog
    from thermolens.streaming import time_order
    from thermolens.streaming.queries import events_stream, run_rollup, run_series_state
    ev = spark.read.parquet(f"{SF}/events.parquet")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cut = ev.select(F.percentile(at, F.array(F.lit(0.33), F.lit(0.66)))).collect()[0][0]
    for sf, order in (("whole", None), ("parts", [2, 0, 1])):
        os.makedirs(f"{tmp_dir}/{sf}/events.parquet")
        third = F.when(at < cut[0], 0).when(at < cut[1], 1).otherwise(2)
        for i, k in enumerate(order or [None]):
            d = ev if k is None else ev.where(third == k)
            file = f"{tmp_dir}/{sf}/events.parquet/part-{i}.parquet"
            d.toPandas().to_parquet(file, coerce_timestamps="us")
            os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    whole, parts = f"{tmp_dir}/whole", f"{tmp_dir}/parts"
    assert time_order.sources_in_order(spark, f"{whole}/events.parquet") == [f"{whole}/events.parquet"]
    folders = time_order.sources_in_order(spark, f"{parts}/events.parquet", slice_rows=300)
    assert len(folders) == -(-ev.count() // 300)
    spans = [spark.read.parquet(f).agg(F.min("ts"), F.max("ts"), F.count("*")).first() for f in folders]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and sum(x[2] for x in spans) == ev.count()
    for query in (catalog.t1_stream_rollup, catalog.t5t6_stream_gap_rate_sigma, catalog.t7_stream_periods):
        want, got = (sorted(map(repr, query(spark, sf).collect())) for sf in (whole, parts))
        assert want and got == want, query.__name__
    assert catalog.t5t6_stream_gap_rate_sigma(spark, parts).count() == ev.count()

    # too short a delay: nothing is lost silently
    src = events_stream(spark, f"{parts}/events.parquet")
    rd = src.select(F.col("ts").alias("timestamp"), F.col("value").alias("avg"), F.lit("domestic").alias("type"),
                    F.col("user_id").cast("string").alias("ID"))
    n = {r["record"]: r["n"] for r in run_series_state(rd, "late_series").groupBy("record").agg(
        F.sum(F.coalesce("n_rows", F.lit(1))).alias("n")).collect()}
    assert n["late"] > 0 and n["reading"] + n["late"] == ev.count()
    rolled = run_rollup(src, spark.read.parquet(f"{parts}/events.parquet"), "late_rollup", lambda d: d)
    assert rolled.count() == catalog.t1_stream_rollup(spark, whole).count()


def plain_series(rows, window=24, k=2.0):
    """T5-T7 of one series, reading by reading."""
    import math
    out, periods, vals, last, run, runs = [], [], [], None, None, 0
    for us, a in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0.0)):
        gap = None if last is None else (us - last[0]) // 60_000_000
        rate = 0.0 if not gap or gap < 0 else None if a is None or last[1] is None else (a - last[1]) / gap
        vals = (vals + [a])[-window:]
        have = [v for v in vals if v is not None]
        mean = sum(have) / len(have) if have else None
        std = math.sqrt(sum((v - mean) ** 2 for v in have) / (len(have) - 1)) if len(have) > 1 else None
        flag = a is not None and std is not None and abs(a - mean) > k * std
        if flag and run is None:
            runs, run = runs + 1, [us, us, 0]
        if flag:
            run[1:] = [us, run[2] + 1]
        elif run is not None:
            periods.append((runs, *run))
            run = None
        out.append((us, a, gap, rate, mean, std, flag, runs if flag else None))
        last = (us, a)
    return out, periods + ([(runs, *run)] if run else [])


def test_measured_equals_row_by_row_however_it_is_cut():
    import numpy as np
    import pytest

    from thermolens.streaming.series_state import NEW_SERIES, measured
    rnd = random.Random(9)
    for case in range(60):
        n = rnd.choice([0, 1, 2, 5, 60, 200])
        rows = [(rnd.randrange(0, 4 * n + 1) * 30_000_000, None if rnd.random() < 0.1 else
                 rnd.choice([20.0, 20.5, 21.0, 90.0, 95.0, -3.0])) for _ in range(n)]
        rows = [r for r, us in zip(rows, [x[0] for x in rows])]
        window, k = rnd.choice([(24, 2.0), (3, 0.5), (1, 2.0), (5, 0.0)])
        want, periods = plain_series(rows, window, k)
        cuts = sorted({0, 10 ** 15, *[rnd.randrange(0, 4 * n + 1) * 30_000_000 for _ in range(rnd.randrange(0, 6))]})
        state, got, closed = NEW_SERIES, [], []
        for lo, hi in zip(cuts, cuts[1:]):
            part = [r for r in rows if lo <= r[0] < hi]
            rnd.shuffle(part)
            us = np.array([r[0] for r in part], dtype=np.int64)
            avg = np.array([np.nan if r[1] is None else r[1] for r in part], dtype=float)
            out, state = measured(("domestic", "1"), us, avg, state, window, k, hi, close=hi == cuts[-1])
            r = out[out["record"] == "reading"]
            got += list(zip(r["timestamp"].astype("datetime64[us]").astype("int64"), r["avg"], r["time_diff_min"],
                            r["avg_rate_per_min"], r["avg_rolling_mean"], r["avg_rolling_std"], r["anomaly"], r["period_no"]))
            p = out[out["record"] == "period"]
            closed += list(zip(p["period_no"].astype(int), p["start_ts"].astype("datetime64[us]").astype("int64"),
                               p["end_ts"].astype("datetime64[us]").astype("int64"), p["n_rows"].astype(int)))
        assert len(got) == len(want) and closed == periods, case
        for g, w in zip(got, want):
            for x, y in zip(g, w):
                if y is None:
                    assert pd.isna(x)
                else:
                    assert x == pytest.approx(y, rel=1e-9, abs=1e-9), (case, g, w)


def test_disorder_of_files():
    from thermolens.streaming.time_order import disorder
    assert disorder([]) == 0
    assert disorder([(1, 0, 10), (2, 11, 20), (3, 21, 30)]) == 0
    assert disorder([(1, 0, 10), (2, 8, 20)]) == 2
    assert disorder([(1, 11, 20), (2, 0, 10)]) == 20
    assert disorder([(1, 0, 10), (1, 5, 20)]) == 20     # either file may come first
    assert disorder([(1, 0, 50), (2, 51, 60), (3, 20, 70)]) == 40


def test_series_state_is_appended_and_typed(spark, tmp_dir):
    """Many micro-batches inside the delay: the buffer grows by appends, nothing is released early."""
    from thermolens.streaming.queries import run_series_state, run_stream
    rows = [(f"2024-01-01 00:{m:02d}:00", 20.0 + m % 7, "domestic", "a" if m % 2 else None) for m in range(40)]
    rd = spark.createDataFrame(rows, "timestamp string, avg double, type string, ID string").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))
    for i in range(8):
        rd.where(F.minute("timestamp") % 8 == i).coalesce(1).write.parquet(f"{tmp_dir}/src/part={i}")
    src = readings_stream(spark, f"{tmp_dir}/src", rd.schema, 1)
    run = run_stream(stream_series_state(src, "1 hour"), "appended")
    assert run.table.count() == 0 and run.late == 0
    held = spark.read.format("statestore").option("stateVarName", "buffer").load(run.checkpoint)
    assert held.count() == 40 and held.select("key.ID").distinct().count() == 2
    out = run_series_state(src, "appended_whole").where("record = 'reading'").collect()
    assert len(out) == 40 and sum(r["time_diff_min"] is None for r in out) == 2


class FakeState:
    """List and value state, and a handle that notes timers, of one series."""

    def __init__(self):
        self.rows, self.value, self.timers = [], None, []

    def appendList(self, rows):
        self.rows += rows

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []

    def get(self):
        return self

    def __iter__(self):
        return iter(self.rows)

    def registerTimer(self, ms):
        self.timers.append(ms)


class FakeValue(FakeState):
    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value


def test_one_timer_per_series_and_micro_batch(spark):
    """t7, t5t6: not one timer per hour that has readings; what is put back has a timer of its own."""
    from types import SimpleNamespace

    from thermolens.streaming import series_state as S
    hour = 3_600_000
    p = S.SeriesProcessor(24, 2.0, hour)
    p.buffer, p.series, p.handle = FakeState(), FakeValue(), FakeState()
    times = [h * hour * 1000 + 5 for h in range(50)]
    rows = pd.DataFrame({"timestamp": pd.to_datetime(times[::-1], unit="us"), "avg": [None if t == times[3] else 1.0 for t in times[::-1]]})
    assert list(p.handleInputRows(("d", "1"), iter([rows[:20], rows[20:]]), None)) == []
    assert p.handle.timers == [hour]
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: 48 * hour + 7)
    out = list(p.handleExpiredTimer(("d", "1"), now, SimpleNamespace(getExpiryTimeInMs=lambda: hour)))
    assert [len(d) for d in out] == [1] and len(p.buffer.rows) == 2 and p.handle.timers == [hour, 49 * hour]
    assert list(p.handleExpiredTimer(("d", "1"), now, SimpleNamespace(getExpiryTimeInMs=lambda: 48 * hour))) == []
    got = S.unpacked(spark.createDataFrame([tuple(None if v is None else v.tolist() if hasattr(v, "tolist") else v for v in r)
                                            for r in out[0].itertuples(index=False)], S.PACKED)).orderBy("timestamp").collect()
    assert len(got) == 48 and [r["avg"] for r in got].index(None) == 3


def test_packed_readings_equal_their_records(spark, monkeypatch):
    """t7, t5t6: rows made of arrays equal the data frame of ``measured``, also where a part is cut."""
    import numpy as np

    from thermolens.streaming import series_state as S
    rnd = random.Random(4)
    us = np.array([i * 7_000_000_000 // 3 for i in range(120)], dtype=np.int64)
    avg = np.array([np.nan if rnd.random() < 0.1 else rnd.choice([20.0, 21.0, 90.0]) for _ in us])
    part, _ = S.measured_part(us, avg, S.NEW_SERIES, 24, 1.0, close=True)
    assert len(part[1]) > 1
    want = spark.createDataFrame(S.records([(("d", None), part)]).astype({"anomaly": object}).replace({np.nan: None}), S.SERIES_OUT)
    for size in (S.ROLL_ROWS, 50):
        monkeypatch.setattr(S, "ROLL_ROWS", size)
        rows = [tuple(v.tolist() if hasattr(v, "tolist") else v for v in r)
                for d in S.packed(("d", None), part) for r in d.itertuples(index=False)]
        assert len(rows) == -(-120 // size)
        assert sorted(map(repr, S.unpacked(spark.createDataFrame(rows, S.PACKED)).collect())) == sorted(map(repr, want.collect()))
    monkeypatch.setattr(S, "ROLL_ROWS", 7)
    for got, whole in zip(S.rolled(avg, 60, 24), part[0][4:6]):
        assert np.allclose(got, whole[-60:], equal_nan=True)
