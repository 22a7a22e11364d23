"""Sources and sinks S1-S6."""

from pyspark.sql import functions as F

from thermolens.sources import (fit_or_load, read_first_available, read_readings, slice_rows, write_readings,
                                write_report)


def test_csv_nan_to_null_and_first_available(spark, tmp_dir):
    p = f"{tmp_dir}/raw.csv"
    with open(p, "w") as f:
        f.write("timestamp,avg,min_v,max_v,stddev_v\n2024-01-01 00:15:00,NaN,1,2,\n2024-01-01 00:00:00,5.5,5,6,\n")
    df = read_readings(spark, p)
    assert df.where(F.col("avg").isNull()).count() == 1
    assert read_first_available(spark, [f"{tmp_dir}/missing", p], fmt="csv").count() == 2


def test_write_partitioned_and_params(spark, tmp_dir):
    df = spark.createDataFrame([(1.0, "domestic"), (2.0, "forward")], "avg double, type string")
    write_readings(df, f"{tmp_dir}/out")
    back = spark.read.parquet(f"{tmp_dir}/out").where("type = 'forward'")
    assert back.count() == 1
    calls = []

    def fit():
        calls.append(1)
        return df.agg(F.avg("avg").alias("mean"))
    fit_or_load(spark, f"{tmp_dir}/params", fit)
    fit_or_load(spark, f"{tmp_dir}/params", fit)
    assert len(calls) == 1
    write_report(df.agg(F.count("*").alias("n")), f"{tmp_dir}/rep")
    write_report(df.agg(F.count("*").alias("n")), f"{tmp_dir}/rep")
    assert spark.read.parquet(f"{tmp_dir}/rep").count() == 2


def test_slice_rows(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), "d", s) for h in range(5) for s in ("a", "b")],
                               "timestamp timestamp_ntz, type string, ID string")
    got = slice_rows(df, 0, 3).collect()
    assert sorted((r["timestamp"].hour, r["ID"]) for r in got) == [(0, "a"), (0, "b"), (1, "a")]
    assert slice_rows(df, 1, 2, per_series=True).count() == 2
