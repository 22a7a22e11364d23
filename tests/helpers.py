import datetime as dt
import math


def ts(day, hour=0, minute=0, second=0):
    return dt.datetime(2024, 1, day, hour, minute, second)


def rows_of(df, cols=None, order=None):
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=repr)


def close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))


def same_rows(a, b, tol=1e-9):
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) or isinstance(v, float):
                if not close(u, v, tol):
                    return False
            elif u != v:
                return False
    return True


def frame(spark, rows, schema="timestamp timestamp_ntz, avg double, min_v double, max_v double, type string, ID string"):
    return spark.createDataFrame(rows, schema)
