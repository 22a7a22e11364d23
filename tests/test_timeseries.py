"""Edge cases of the window operators (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from helpers import ts
from thermolens.operators import timeseries as tsop
from thermolens.operators.clean import prepare_readings
from thermolens.operators.detect.rolling import find_anomaly_domestic, rolling_sigma

SCHEMA = "timestamp timestamp_ntz, avg double, min_v double, max_v double, type string, ID string"


def test_single_row_series(spark):
    df = spark.createDataFrame([(ts(1, 5), 10.0, 9.0, 11.0, "domestic", "S1")], SCHEMA)
    r = prepare_readings(df).collect()[0]
    assert r["time_diff_min"] is None          # no gap, no mode
    f = rolling_sigma(df).collect()[0]
    assert f["anomaly"] is False
    w7 = tsop.rolling_time(df, ["avg"], [1]).collect()[0]
    assert w7["avg_rolling_std_1h"] == 0.0


def test_equal_timestamps_are_peers(spark):
    df = spark.createDataFrame([(ts(1, 5), 10.0, 1.0, 1.0, "d", "S1"), (ts(1, 5), 20.0, 1.0, 1.0, "d", "S1"),
                                (ts(1, 4), 30.0, 1.0, 1.0, "d", "S1")], SCHEMA)
    out = tsop.rolling_time(df, ["avg"], [1]).where(F.col("timestamp") == ts(1, 5)).collect()
    assert all(r["avg_rolling_mean_1h"] == 20.0 for r in out)   # both peers + 04:00 (inclusive bound)


def test_gap_mode_tie_takes_smallest(spark):
    rows = [(ts(1, 0), 1.0), (ts(1, 1), 1.0), (ts(1, 3), 1.0), (ts(1, 4), 1.0), (ts(1, 6), 1.0)]
    df = spark.createDataFrame([(t, v, v, v, "d", "S") for t, v in rows], SCHEMA)
    r = prepare_readings(df).orderBy("timestamp").collect()
    assert r[0]["time_diff_min"] == 60           # gaps 60,120,60,120 -> tie -> 60


def _periods(spark, flags):
    rows = [(ts(1, i), float(i), 0.0, 0.0, "d", "S", f) for i, f in enumerate(flags)]
    df = spark.createDataFrame(rows, SCHEMA + ", anomaly boolean")
    return tsop.anomaly_periods(df, "anomaly").orderBy("period_no").collect()


def test_periods_edge_cases(spark):
    p = _periods(spark, [False, True, True, False, True])
    assert [(r["period_no"], r["n_rows"]) for r in p] == [(1, 2), (2, 1)]
    assert p[1]["start_ts"] == p[1]["end_ts"]                       # single-row run, closed at the end
    assert len(_periods(spark, [True] * 5)) == 1
    assert _periods(spark, [False] * 5) == []
    assert p[0]["start_weekday"] == "Monday" and p[0]["start_time"] == "01:00" and p[0]["end_time"] == "02:00"


def test_first_five_rows_cannot_flag(spark):
    vals = [1.0, 1.0, 1.0, 1.0, 1000.0] + [1.0] * 20
    df = spark.createDataFrame([(ts(1, i % 24) if i < 24 else ts(2, i - 24), v, v, v, "domestic", "S1")
                                for i, v in enumerate(vals)], SCHEMA)
    flags = rolling_sigma(df).orderBy("timestamp").collect()
    assert not any(r["anomaly"] for r in flags[:5])
    assert find_anomaly_domestic(df).count() == 0


def test_nan_never_flagged(spark):
    vals = [1.0, 2.0, 1.5, float("nan"), 2.5, None, 1.0]
    df = spark.createDataFrame([(ts(1, i), v, v, v, "domestic", "S1") for i, v in enumerate(vals)], SCHEMA)
    from thermolens.schema import clean_doubles
    out = rolling_sigma(clean_doubles(df), k=0.0).collect()
    assert all(r["anomaly"] is False for r in out if r["avg"] is None)


def test_ffill_then_zero(spark):
    rows = [(ts(1, 0), None), (ts(1, 1), 5.0), (ts(1, 2), None), (ts(1, 3), 7.0)]
    df = spark.createDataFrame([(t, v, 0.0, 0.0, "d", "S") for t, v in rows], SCHEMA)
    out = [r["avg"] for r in tsop.ffill_then_zero(df, ["avg"]).orderBy("timestamp").collect()]
    assert out == [0.0, 5.0, 5.0, 7.0]


def test_sequences_and_alignment(spark):
    df = spark.createDataFrame([(ts(1, i), float(i), 0.0, 0.0, "d", "S") for i in range(6)], SCHEMA)
    seq = tsop.sequences(df, "avg", 3).orderBy("timestamp").collect()
    assert [r["sequence"] for r in seq] == [[0.0, 1.0, 2.0], [1.0, 2.0, 3.0], [2.0, 3.0, 4.0], [3.0, 4.0, 5.0]]
    scored = df.join(tsop.sequences(df, "avg", 3).select("timestamp", F.col("avg").alias("score")), "timestamp", "left")
    al = tsop.align_sequence_scores(scored, "score", 3).orderBy("timestamp").collect()
    assert [r["score"] for r in al] == [5.0, 5.0, 2.0, 3.0, 4.0, 5.0]


def test_time_grid_and_missing(spark):
    df = spark.createDataFrame([(ts(1, h), 1.0, 1.0, 1.0, "d", "S") for h in (0, 1, 4)], SCHEMA)
    assert tsop.time_grid(df).count() == 5
    assert sorted(r["timestamp"].hour for r in tsop.missing_slots(df).collect()) == [2, 3]
