"""Edge cases that the oracle tables do not hold: NULL keys and values, ties, repeated
keys, small forests, reloading, a table stored as a folder."""

import datetime as dt

import pytest
from helpers import frame
from pyspark.sql import functions as F

from thermolens.operators.clean import except_rows, intersect_rows
from thermolens.operators.detect.baseline import baseline_fit, baseline_predict
from thermolens.operators.detect.ensemble import Ensemble, StatisticalDetector
from thermolens.operators.detect.iforest import IsolationForestDetector, grow_1d, sample_trees
from thermolens.operators.detect.iforest_nd import fit_forest_nd, label_readings
from thermolens.operators.joins import join_labels
from thermolens.operators.stats import describe
from thermolens.operators.timeseries import missing_slots, sequences, time_grid


def t(minute, day=1):
    return dt.datetime(2024, 1, day) + dt.timedelta(minutes=minute)


def readings(spark, n=40, ids=("a", None)):
    rows = [(t(30 * i), float(i % 7 + (50 if i == 20 else 0)), 0.0, 10.0, "domestic", s) for s in ids for i in range(n)]
    return frame(spark, rows)


def test_sequences_keep_null_positions(spark):
    d = frame(spark, [(t(i), v, None, None, "d", "a") for i, v in enumerate([None, 0.0, 1.0, None])])
    got = sorted((r["timestamp"], list(r["sequence"])) for r in sequences(d, "avg", 3).collect())
    assert [x for _, x in got] == [[None, 0.0, 1.0], [0.0, 1.0, None]]


def test_null_keys_stay_in_statistics_and_joins(spark):
    d = readings(spark)
    assert {r["ID"] for r in describe(d, ["avg"], ["ID"]).collect()} == {"a", None}
    params = baseline_fit(d, "avg", by=("ID",))
    assert params.where("q1 is not null").count() == 2
    assert baseline_predict(d, params, "avg", ("ID",)).where("statistical = 1").count() == 2
    pred, truth = d.select("type", "ID", "timestamp", F.lit(1).alias("p")), d.select("type", "ID", "timestamp", "avg")
    assert join_labels(pred, truth).count() == d.count()
    assert except_rows(d, d).count() == 0 and intersect_rows(d, d).count() == d.count()


def test_grid_with_half_hours_and_null_key(spark):
    rows = [(t(m), 1.0, None, None, "d", s) for s in ("a", None) for m in (97, 127, 190)]
    got = sorted((str(r["ID"]), r["timestamp"]) for r in missing_slots(frame(spark, rows), "30 minutes").collect())
    assert got == [("None", t(150)), ("a", t(150))]
    hourly = frame(spark, [(t(5), 1.0, None, None, "d", "a"), (t(60 * 9000), 1.0, None, None, "d", "a")])
    assert time_grid(hourly, "1 hour").count() == 9000
    assert missing_slots(hourly, "1 hour").count() == 8999


def test_labeler_keeps_repeated_and_null_keys(spark):
    d = readings(spark, 60, ("a", None)).withColumns({
        "nighttime": F.lit(False), "time_diff_min": F.lit(30).cast("long"), "T_diff": F.lit(10.0)})
    d = d.unionByName(d.limit(3))
    got = label_readings(d, "domestic", trees=10)
    assert got.count() == 123
    assert got.where("isolation_forest_anomaly is null").count() == 0


@pytest.mark.parametrize("n, depth", [(20, 5), (300, 8)])
def test_small_forests_stop_at_their_own_depth(spark, n, depth):
    d = frame(spark, [(t(i), float(i * i % 101), None, None, "d", "a") for i in range(n)])
    leaves = grow_1d(sample_trees(d, "avg", 10, 256), 256)
    assert leaves.agg(F.max("depth")).first()[0] <= depth
    assert sample_trees(d, "avg", 10, 256).groupBy("tree").count().where(f"count <> {min(n, 256)}").count() == 0
    nodes = fit_forest_nd(d, ["avg"], 5, 256)
    assert nodes.groupBy("tree").count().agg(F.max("count")).first()[0] <= 2 ** (depth + 1)


def test_ensemble_saves_and_reloads(spark, tmp_dir):
    d = readings(spark, 100, ("a", "b"))

    def new():
        e = Ensemble(threshold=0.4).add_detector(IsolationForestDetector(trees=10), 2.0)
        return e.add_detector(StatisticalDetector(z_threshold=2.0), 1.0)

    direct = new().fit(d).predict(d)
    new().fit(d, store=f"{tmp_dir}/m")
    again = Ensemble.load(spark, f"{tmp_dir}/m")
    assert (again.threshold, again.weights) == (0.4, {"Isolation_Forest": 2.0, "Statistical": 1.0})
    assert again.detectors["Statistical"].z_threshold == 2.0 and again.is_fitted
    cols = ["ID", "timestamp", "ensemble_score", "ensemble"]
    want = sorted(map(tuple, direct.select(*cols).collect()))
    assert sorted(map(tuple, again.predict(d).select(*cols).collect())) == want
    second = new().fit(d, store=f"{tmp_dir}/m")
    assert sorted(map(tuple, second.predict(d).select(*cols).collect())) == want
    shifted = d.withColumn("avg", F.col("avg") * 3)
    kept = new().fit(shifted, store=f"{tmp_dir}/m").params["Statistical"].first()["mean"]
    fresh = new().fit(shifted, store=f"{tmp_dir}/m", force_retrain=True).params["Statistical"].first()["mean"]
    assert fresh == pytest.approx(3 * kept)


def test_stream_reads_a_table_stored_as_a_folder(spark, tmp_dir):
    from thermolens.plans.catalog import t1_stream_rollup, t7_stream_periods
    src = "/root/testdata/sf0.001"
    ev = spark.read.parquet(f"{src}/events.parquet")
    ev.repartition(5).write.parquet(f"{tmp_dir}/events.parquet")
    # part files in any order: late rows of the one-file run do not occur here only if nothing is dropped
    key = ["event_type", "timestamp", "min_v", "max_v"]
    whole = sorted(map(tuple, t1_stream_rollup(spark, src).select(*key).collect()))
    hours = ev.groupBy("event_type", F.date_trunc("hour", "ts")).count().count()
    assert len(whole) == hours
    ev.orderBy("ts").coalesce(1).write.parquet(f"{tmp_dir}/sorted/events.parquet")
    assert sorted(map(tuple, t1_stream_rollup(spark, f"{tmp_dir}/sorted").select(*key).collect())) == whole
    cols = ["ID", "period_no", "start_ts", "end_ts", "n_rows"]
    want = sorted(map(tuple, t7_stream_periods(spark, src).select(*cols).collect()))
    assert sorted(map(tuple, t7_stream_periods(spark, f"{tmp_dir}/sorted").select(*cols).collect())) == want


def test_checkpoint_folder_is_required_on_a_cluster():
    from thermolens.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
