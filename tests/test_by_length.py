"""Short series take plain windows, long ones the blocks: same rows, and no copies of rows where no series is long."""

import math
import random

from pyspark.sql import functions as F

from helpers import rows_of, same_rows, ts
from thermolens.functions.numeric import round_columns, round_to
from thermolens.operators.clean import prepare_readings
from thermolens.operators.features import feature_matrix
from thermolens.operators.windows import Layout, SERIES_LAYOUT


def _readings(spark):
    import datetime as dt
    rnd = random.Random(5)
    rows = []
    for sid, n in (("a", 90), ("b", 4), ("c", 1), (None, 30)):
        t = ts(1)
        for _ in range(n):
            t += dt.timedelta(minutes=rnd.choice([1, 15, 60, 400]))
            v = None if rnd.random() < 0.2 else rnd.uniform(1, 90)
            rows.append((t, v, None if v is None else v - rnd.random(), None if v is None else v + 1, "domestic", sid))
    rows.append((None, 50.0, 49.0, 51.0, "domestic", "b"))
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, avg double, min_v double, max_v double, type string, ID string")


def test_short_and_long_series_give_the_same_matrix(spark):
    df = _readings(spark)
    timed = df.where(F.col("timestamp").isNotNull())
    want = rows_of(feature_matrix(prepare_readings(timed, layout=SERIES_LAYOUT), layout=SERIES_LAYOUT))
    for rows in (3, 20, 65536):   # most series long, two long, none long
        lay = Layout(block_rows=rows)
        got = rows_of(feature_matrix(prepare_readings(df, layout=lay), layout=lay))
        assert len(got) == 125 and same_rows(got, want), rows


def test_matrix_of_short_series_is_one_shuffle_without_copies(spark):
    plan = feature_matrix(prepare_readings(_readings(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(sequence(" not in plan
    assert plan.count("Exchange hashpartitioning(type#") == 1 and "Exchange hashpartitioning(_sk" not in plan


def test_rounding_is_that_of_the_decimal_text(spark):
    vals = [0.0, -0.0, -5e-10, 0.5, 1e8, 99999999.99999999, 123456.1234565, 1e15, 9.2e18, 1e300, math.inf, -math.inf, None,
            1.0000005, 1.00000049999, 1.000000499999999, 2.5e-7, 1 / 3200, -1 / 3200, 6e5 + 0.0000005, -4e-7, 999999.9999995]
    rnd = random.Random(2)
    vals += [rnd.choice([rnd.uniform(-200, 200), rnd.randrange(-10**7, 10**7) / 2 ** rnd.randrange(7) / 10 ** rnd.randrange(8)])
             for _ in range(3000)]
    d = spark.createDataFrame([(v,) for v in vals], "x double")
    for digits in (0, 3, 6):
        m = F.lit(float(10 ** digits))
        text = F.round(F.round("x", 9) * m, 0) / m
        bad = d.where(~round_to("x", digits).cast("string").eqNullSafe(text.cast("string")))
        assert bad.count() == 0, bad.limit(3).collect()
    names = [f"c{i}" for i in range(12)]
    wide = round_columns(d.select("x", *[F.col("x").alias(c) for c in names]), names, 6)
    assert wide.columns == ["x", *names]
    assert wide.where(~F.col("c11").eqNullSafe(round_to("x", 6))).count() == 0
