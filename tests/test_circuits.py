"""Cross-circuit drops and tags by source, against plain loops."""

import datetime as dt

from helpers import frame, ts

from thermolens.operators import prose
from thermolens.operators.clean import tag_by_source

ROWS = [(ts(1, h), v, v, v, t, i) for h, values in enumerate([
    {("domestic", "a"): 50.0, ("domestic", "b"): 50.0, ("domestic", "c"): 50.0, (None, None): 50.0, ("forward", "x"): 50.0},
    {("domestic", "a"): 20.0, ("domestic", "b"): 20.0, ("domestic", "c"): 50.0, (None, None): 20.0, ("forward", "x"): 20.0},
    {("domestic", "a"): 20.0, ("domestic", "b"): 50.0, ("domestic", "c"): 50.0, (None, None): 50.0},
    {("domestic", "a"): 50.0, ("domestic", "b"): 60.0, ("domestic", "c"): 50.0, ("forward", "x"): 50.0},
    {("domestic", "a"): 60.0, ("domestic", "b"): 60.0}]) for (t, i), v in values.items()]


def test_drops_and_counts(spark):
    drops = prose.circuit_drops(frame(spark, ROWS).repartition(4), 10.0)
    got = {(r["type"], r["ID"], r["bucket"].hour): (r["n_also_dropped"], r["n_not_dropped"], r["diagnosis"])
           for r in prose.cross_circuit_check(drops).collect()}
    assert got == {("domestic", "a", 1): (1, 1, "shared"), ("domestic", "b", 1): (1, 1, "shared"),
                   ("domestic", "a", 2): (0, 2, "own"), (None, None, 1): (0, 0, "single"), ("forward", "x", 1): (0, 0, "single")}
    counts = {(r["type"], r["bucket"].hour): tuple(r[c] for c in ("n_measured", "n_dropped", "pairs_both", "pairs_one", "pairs_none"))
              for r in prose.cross_circuit_counts(drops).collect()}
    assert counts["domestic", 0] == (3, 0, 0, 0, 3) and counts["domestic", 1] == (3, 2, 1, 2, 0)
    assert counts["domestic", 2] == (3, 1, 0, 2, 1) and counts[None, 1] == (1, 1, 0, 0, 0)


def test_every_pair_is_listed(spark):
    drops = prose.circuit_drops(frame(spark, ROWS).repartition(4), 10.0)
    got = {(r["type"], r["a_ID"], r["b_ID"], r["bucket"].hour): (r["a_mean"], r["a_drop"], r["b_mean"], r["b_drop"], r["diagnosis"])
           for r in prose.cross_circuit_pairs(drops).collect()}
    assert got["domestic", "a", "b", 1] == (20.0, True, 20.0, True, "both")
    assert got["domestic", "a", "c", 2] == (20.0, True, 50.0, False, "only_a")
    at = {(r["type"], r["bucket"].hour): r for r in prose.cross_circuit_counts(drops).collect()}
    assert len(got) == sum(r["n_measured"] * (r["n_measured"] - 1) // 2 for r in at.values()) == 13
    nulls = spark.createDataFrame([("t", i, dt.datetime(2024, 1, 1), 1.0, False) for i in (None, "a", "b")],
                                  "type string, ID string, bucket timestamp_ntz, mean double, drop boolean")
    assert {(r["a_ID"], r["b_ID"]) for r in prose.cross_circuit_pairs(nulls).collect()} == {(None, "a"), (None, "b"), ("a", "b")}


def test_the_pairs_query_lists_what_it_counts(spark):
    import __spark_entry__ as E
    rows = E.queries()["n4_cross_circuit_pairs"](spark, "/root/testdata/sf0.001").collect()
    pairs = [r["diagnosis"] for r in rows if r["record"] == "pair"]
    total = lambda c: sum(r[c] for r in rows)
    assert len(pairs) > 0 and pairs.count("both") == total("pairs_both") and pairs.count("none") == total("pairs_none")
    assert pairs.count("only_a") + pairs.count("only_b") == total("pairs_one")


def test_a_bucket_with_most_drops_stays_linear(spark):
    rows = [(dt.datetime(2024, 1, 1, h), 50.0 if h else 10.0, 0.0, 0.0, "domestic", str(i)) for i in range(300) for h in range(3)]
    d = prose.cross_circuit_check(prose.circuit_drops(frame(spark, rows), 10.0))
    assert d.count() == 300 and {r["n_also_dropped"] for r in d.collect()} == {299}


def test_tags_by_source(spark):
    rows = spark.createDataFrame([("s1", 1.0), ("s2", 2.0), (None, 3.0), ("s9", 4.0)], "source string, avg double")
    table = spark.createDataFrame([("s1", "domestic", "a"), ("s2", "forward", None), (None, None, "n"), ("s1", "domestic", "a")],
                                  "source string, type string, ID string")
    d = tag_by_source(rows, table)
    assert d.columns == ["avg", "type", "ID"]
    assert sorted(map(tuple, d.collect())) == [(1.0, "domestic", "a"), (2.0, "forward", None), (3.0, None, "n"), (4.0, None, None)]
