"""Physical-plan properties: column pruning reaches the parquet scan, and no
registered flagship plan contains a Cartesian product."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_flagship_reads_only_needed_columns(spark):
    """D2 writes key, time and value first: that write reads three columns, the rest reads the input no more."""
    from thermolens.operators.clean import filter_type
    from thermolens.sources.fixtures import readings_hourly
    p = _plan(filter_type(readings_hourly(spark, SF), "domestic").select("type", "ID", "timestamp", "avg"))
    schemas = _read_schemas(p)
    assert schemas, p[:500]
    for s in schemas:
        cols = {c.split(":")[0] for c in s.split(",")}
        assert cols <= {"ts", "event_type", "value"}, cols
    p = _plan(E.queries()["d2_domestic_periods"](spark, SF))
    assert not _read_schemas(p) and "CartesianProduct" not in p


def test_per_event_reads_only_needed_columns(spark):
    from thermolens.sources.fixtures import readings_per_event
    p = _plan(readings_per_event(spark, SF).select("type", "ID", "timestamp", "avg"))
    assert _read_schemas(p)
    for s in _read_schemas(p):
        cols = {c.split(":")[0] for c in s.split(",")}
        assert cols <= {"ts", "user_id", "value"}, cols
    p = _plan(E.queries()["d2_periods_per_event"](spark, SF))
    assert not _read_schemas(p) and "CartesianProduct" not in p
