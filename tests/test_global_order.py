import datetime as dt

import pytest
from helpers import frame
from pyspark.sql import functions as F

from thermolens.operators.detect.ensemble import chronological_split
from thermolens.operators.faults import inject_faults
from thermolens.sources import slice_rows


def hot(spark, n=300):
    """90 % of the rows in one minute, a third at one instant, some keys equal."""
    t0 = dt.datetime(2024, 1, 1, 12)
    rows = []
    for i in range(n):
        t = t0 if i % 3 == 0 else t0 + dt.timedelta(microseconds=i * 1000) if i % 10 else t0 + dt.timedelta(hours=i)
        rows.append((t, float(i), 0.0, 1.0, "d", f"s{i % 7}" if i % 5 else None))
    return frame(spark, rows).repartition(4)


def position_key(r):
    return (r["timestamp"], r["type"], r["ID"] is not None, r["ID"] or "")


@pytest.mark.parametrize("f", [0.0, 0.2, 0.5, 0.8, 1.0])
def test_global_split_counts_and_order(spark, f):
    d = chronological_split(hot(spark), f)
    rows = d.collect()
    train, test = [r for r in rows if r["is_train"]], [r for r in rows if not r["is_train"]]
    assert len(train) == int(300 * f) and len(rows) == 300
    if train and test:
        assert max(map(position_key, train)) <= min(map(position_key, test))


def test_slices_equal_a_sorted_list(spark):
    d = hot(spark).where("ID is not null")
    want = sorted((position_key(r) for r in d.collect()))
    for a, b in ((0, 10), (95, 130), (200, None), (0, 10_000), (239, 240)):
        got = sorted(position_key(r) for r in slice_rows(d, a, b).collect())
        assert got == want[a:b]
    plan = slice_rows(d, 5, 100)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("rate", [0.0, 0.05, 0.31, 1.0])
def test_faults_hit_an_exact_number_of_rows(spark, rate):
    d = inject_faults(hot(spark).withColumn("T_diff", F.lit(1.0)), rate, 7)
    assert d.count() == 300 and d.where("is_anomaly").count() == int(300 * rate)


def test_faults_on_an_empty_table(spark):
    assert inject_faults(hot(spark).limit(0)).count() == 0


def test_a_boundary_among_rows_without_a_time(spark):
    rows = [(None, float(i), 0.0, 1.0, "d", f"s{i % 3}") for i in range(90)] + [(dt.datetime(2024, 1, 1, i), 1.0, 0.0, 1.0, "d", "x") for i in range(10)]
    d = frame(spark, rows).repartition(4)
    for k in (5, 10, 25, 55, 100):
        got = slice_rows(d, 0, k).collect()
        assert len(got) == k and sum(r["timestamp"] is not None for r in got) == min(k, 10)
        ids = sorted(r["ID"] for r in got if r["timestamp"] is None)
        assert ids == sorted(["s0"] * 30 + ["s1"] * 30 + ["s2"] * 30)[:max(0, k - 10)]
    assert slice_rows(d, 20, 70).count() == 50


def test_one_hot_of_too_many_categories(spark):
    from thermolens.functions.calendar import one_hot
    d = spark.range(30).select(F.col("id").cast("string").alias("type"))
    assert len(one_hot(d, "type").columns) == 32
    with pytest.raises(ValueError):
        one_hot(d, "type", max_categories=29)
