"""Validation metrics, including the single-class case the reference crashes on."""

from thermolens.operators import stats, validate


def _df(spark, pairs):
    return spark.createDataFrame([(bool(y), int(p), "overheat" if y else "normal") for y, p in pairs],
                                 "is_anomaly boolean, ensemble int, anomaly_type string")


def test_report_counts_add_up(spark):
    df = _df(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)])
    r = validate.validation_report(df).collect()[0]
    assert (r["true_positives"], r["false_positives"], r["false_negatives"], r["true_negatives"]) == (1, 1, 1, 2)
    assert r["batch_size"] == 5 and r["precision"] == 0.5 and r["recall"] == 0.5
    assert r["correct_detections"] + r["missed_anomalies"] == r["injected_anomalies"]
    assert r["validation_passed"] is False


def test_single_class(spark):
    r = validate.validation_report(_df(spark, [(0, 0), (0, 0)])).collect()[0]
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1_score"] == 0.0 and r["true_negatives"] == 2


def test_by_detector_and_status(spark):
    df = _df(spark, [(1, 1), (1, 0), (0, 1)])
    by = {r["detector"]: r for r in validate.prf_by_detector(df, ["ensemble"]).collect()}
    assert by["ensemble"]["detected"] == 2 and by["ensemble"]["correct"] == 1
    st = sorted(r["s"] for r in df.select(validate.detection_status().alias("s")).collect())
    assert st == [1, 3, 4]


def test_exclusive_overlap_cells_sum(spark):
    rows = [(True, False, False), (True, True, False), (True, True, True), (False, False, False), (False, True, True)]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean")
    cells = {r["combination"]: r["n"] for r in stats.exclusive_overlap(df, ["a", "b", "c"]).collect()}
    assert len(cells) == 7 and sum(cells.values()) + 1 == df.count()
    assert cells["all three"] == 1 and cells["only a"] == 1 and cells["a + b"] == 1 and cells["b + c"] == 1


def test_histogram_zero_width(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    h = stats.histogram(df, "v", 10).collect()
    assert len(h) == 1 and h[0]["n"] == 2
