"""Detectors, scalers and the ensemble on hand-made frames."""

from pyspark.sql import functions as F

from helpers import ts
from thermolens.functions import calendar as cal
from thermolens.operators import scaling
from thermolens.operators.detect.baseline import baseline_fit, baseline_predict, baseline_score
from thermolens.operators.detect.ensemble import (Ensemble, StatisticalDetector, chronological_split,
                                                  ensemble_predict, quantile_threshold, quantile_threshold_fit)
from thermolens.operators.detect.rules import domain_rules
from thermolens.operators.detect.zscore import zscore_any

SCHEMA = "timestamp timestamp_ntz, avg double, min_v double, max_v double, T_diff double, type string, ID string"


def test_domain_rules(spark):
    rows = [(ts(1, 0), -5.0, 1.0, 2.0, 1.0), (ts(1, 1), -15.0, 1.0, 2.0, 1.0), (ts(1, 2), 50.0, 3.0, 2.0, 1.0),
            (ts(1, 3), 50.0, 1.0, 2.0, -1.0), (ts(1, 4), 50.0, 1.0, 2.0, 51.0), (ts(1, 5), None, None, None, None),
            (ts(1, 6), 101.0, 1.0, 2.0, 1.0)]
    df = spark.createDataFrame([r + ("d", "S") for r in rows], SCHEMA)
    out = [r["domain_anomaly"] for r in domain_rules(df).orderBy("timestamp").collect()]
    assert out == [False, True, True, True, True, False, True]


def test_zscore_constant_and_null(spark):
    rows = [(ts(1, i), 5.0, 5.0, 5.0, 0.0, "d", "S") for i in range(10)] + [(ts(1, 11), None, None, None, None, "d", "S")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert zscore_any(df).where("statistical_anomaly").count() == 0


def test_zscore_flags_outlier(spark):
    rows = [(ts(1, i), 10.0 + (i % 3), 9.0, 12.0, 3.0, "d", "S") for i in range(20)] + [(ts(2, 0), 500.0, 9.0, 12.0, 3.0, "d", "S")]
    df = spark.createDataFrame(rows, SCHEMA)
    flagged = zscore_any(df).where("statistical_anomaly").collect()
    assert [r["avg"] for r in flagged] == [500.0]


def test_baseline_fit_predict(spark):
    rows = [(ts(1, i % 24), float(v), 0.0, 0.0, 0.0, "d", "S") for i, v in enumerate([10, 11, 12, 13, 14, 15, 100])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("is_anomaly", F.col("avg") > 50)
    p = baseline_fit(df, label="is_anomaly").collect()[0]
    assert p["mean"] == 12.5 and abs(p["q1"] - 11.25) < 1e-12 and abs(p["q3"] - 13.75) < 1e-12
    out = baseline_predict(df, baseline_fit(df, label="is_anomaly"), score_out="sc").orderBy("avg").collect()
    assert [r["statistical"] for r in out] == [0, 0, 0, 0, 0, 0, 1]
    assert out[-1]["sc"] > 1.0


def test_minmax_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "s double")
    assert [r["s_norm"] for r in scaling.minmax_normalize(df, ["s"]).collect()] == [0.0, 0.0]
    e = ensemble_predict(df, {"s": 1.0}).collect()
    assert all(r["ensemble"] == 0 and r["ensemble_score"] == 0.0 for r in e)


def test_standardize_roundtrip(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (5.0, 5.0)], "a double, b double")
    p = scaling.standardize_fit(df, ["a", "b"])
    z = scaling.standardize(df, ["a", "b"], p)
    back = scaling.standardize(z, ["a", "b"], p, inverse=True)
    assert all(abs(x - y) < 1e-12 for x, y in zip(sorted(r["a"] for r in back.collect()), [1.0, 3.0, 5.0]))
    assert all(r["b"] == 0.0 for r in z.collect())   # constant column -> scale 1


def test_chronological_split_exact(spark):
    df = spark.createDataFrame([(ts(1, i), float(i), 0.0, 0.0, 0.0, "d", "S") for i in range(10)], SCHEMA)
    out = chronological_split(df, 0.8).orderBy("timestamp").collect()
    assert [r["is_train"] for r in out] == [True] * 8 + [False] * 2


def test_quantile_threshold(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "s double")
    p = quantile_threshold_fit(df, "s", 0.95)
    assert quantile_threshold(df, "s", p).where("s_flag").count() == 5


def test_ensemble_protocol_and_info(spark):
    rows = [(ts(1, i % 24), 10.0 + (i % 5), 0.0, 0.0, 0.0, "d", "S") for i in range(30)] + [(ts(3, 0), 90.0, 0.0, 0.0, 0.0, "d", "S")]
    df = spark.createDataFrame(rows, SCHEMA)
    ens = Ensemble().add_detector(StatisticalDetector(2.5, 1.5), 1.0)
    pred = ens.fit(df).predict(df)
    assert pred.where("ensemble = 1").select("avg").collect()[0][0] == 90.0
    info = ens.info(spark).collect()[0]
    assert info["detector"] == "Statistical" and info["is_fitted"] and info["ensemble_threshold"] == 0.5


def test_night_presets(spark):
    df = spark.createDataFrame([(ts(1, 21, 59),), (ts(1, 22, 0),), (ts(1, 3, 59),), (ts(1, 4, 0),),
                                (ts(1, 23, 0),), (ts(1, 5, 59),), (ts(1, 6, 0),)], "timestamp timestamp_ntz")
    out = df.select(cal.nighttime(preset="eda").alias("e"), cal.nighttime(preset="generator").alias("g")).collect()
    assert [r["e"] for r in out] == [False, True, True, False, True, False, False]
    assert [r["g"] for r in out] == [False, False, True, True, True, True, False]


def test_calendar(spark):
    df = spark.createDataFrame([(ts(1, 8),), (ts(6, 20),), (ts(7, 12),)], "timestamp timestamp_ntz")
    out = df.select(cal.day_of_week().alias("d"), cal.is_weekend().alias("w"), cal.day_name().alias("n"),
                    cal.is_peak().alias("p")).collect()
    assert [(r["d"], r["w"], r["n"], r["p"]) for r in out] == [(0, False, "Monday", 1), (5, True, "Saturday", 1),
                                                               (6, True, "Sunday", 0)]


def test_expected_residual_matches_lstsq(spark):
    import datetime as dt
    import random
    import numpy as np
    from thermolens.operators.expected import REGRESSORS, design, fit_expected
    rnd = random.Random(5)
    rows, v = [], 20.0
    for i in range(200):
        v = 5 + 0.7 * v + rnd.gauss(0, 1)
        rows.append((dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), v, i % 24 >= 22, "d", "S"))
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, avg double, nighttime boolean, type string, ID string")
    c = fit_expected(df).collect()[0]
    pdf = design(df).where("lag1 is not null").toPandas()
    b = np.linalg.lstsq(pdf[list(REGRESSORS)].to_numpy(float), pdf["avg"].to_numpy(), rcond=None)[0]
    assert np.allclose(b, [c[f"b_{r}"] for r in REGRESSORS], atol=1e-8)
    assert abs(c["b_lag1"] - 0.7) < 0.15


def test_exact_quantiles_brute_force(spark):
    import numpy as np
    from thermolens.operators.quantiles import exact_quantiles
    rnd = np.random.default_rng(4)
    rows = []
    for g, n in enumerate([1, 2, 3, 5, 8, 13, 50, 101, 713]):
        vals = np.round(rnd.exponential(40, n), 2)
        vals[: n // 4] = vals[0]          # ties
        rows += [(g, float(v)) for v in vals]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]
    for acc in (100, 1_000_000):
        got = {r["g"]: r for r in exact_quantiles(df, "v", probs, ["g"], [f"p{i}" for i in range(len(probs))],
                                                   accuracy=acc).collect()}
        for g in got:
            vals = np.array([v for gg, v in rows if gg == g])
            want = np.percentile(vals, [p * 100 for p in probs])
            assert np.allclose([got[g][f"p{i}"] for i in range(len(probs))], want, rtol=0, atol=1e-9), (g, acc)
