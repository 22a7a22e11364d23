"""Isolation forest: determinism, contamination share, planted outliers,
repartition invariance, and the breakpoint scorer against a brute-force walk of
every tree."""

import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import ts
from thermolens.operators.detect import iforest as IF

SCHEMA = "timestamp timestamp_ntz, avg double, type string, ID string"


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    import datetime as dt
    rows = [(ts(1) + dt.timedelta(hours=i), rnd.gauss(50, 5), "domestic", "S1") for i in range(400)]
    rows += [(ts(1) + dt.timedelta(hours=400 + i), v, "domestic", "S1") for i, v in enumerate([150.0, -60.0, 170.0])]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def model(data):
    return IF.isolation_forest_fit(data, "avg", trees=30, psi=256, contamination=0.1, seed=3)


def test_share_and_outliers(data, model):
    out = IF.isolation_forest_predict(data, model)
    share = out.agg(F.avg("Isolation_Forest")).collect()[0][0]
    assert 0.08 <= share <= 0.12
    sc = {r["avg"]: r["if_score"] for r in out.collect()}
    outl = [sc[v] for v in (-60.0, 150.0, 170.0)]
    assert min(outl) > max(v for k, v in sc.items() if k not in (-60.0, 150.0, 170.0))


def test_deterministic_and_partition_invariant(data, model):
    again = IF.isolation_forest_fit(data.repartition(7).orderBy(F.rand(1)), "avg", 30, 256, 0.1, 3)
    a = sorted(tuple(r) for r in model.steps.collect())
    b = sorted(tuple(r) for r in again.steps.collect())
    assert a == b


def test_breakpoints_equal_tree_walk(spark, data):
    sample = IF.sample_trees(data, "avg", 10, 32, 5)
    leaves = IF.grow_1d(sample, 32, 5).collect()
    steps = IF.breakpoints(spark.createDataFrame(leaves), 10)
    cells, grid = IF.lookup_cells(steps, 16)
    cut = spark.createDataFrame([(32, IF.c_factor(32), None)], "psi int, c_psi double, cut double")
    model = IF.Forest1D(steps, cells, grid, cut, "avg")
    xs = [-100.0, 0.0, 40.0, 45.5, 50.0, 55.25, 60.0, 150.0, 1e6]
    got = {r["avg"]: r["if_score"] for r in IF.forest_score(spark.createDataFrame([(x,) for x in xs], "avg double"), model).collect()}
    by_tree = {}
    for lf in leaves:
        by_tree.setdefault(lf["tree"], []).append(lf)
    for x in xs:
        hs = []
        for t, lfs in by_tree.items():
            hit = [lf for lf in lfs if lf["lo"] <= x < lf["hi"]]
            assert len(hit) == 1            # leaves tile the line
            hs.append(hit[0]["h"])
        expect = 2 ** (-(sum(hs) / len(hs)) / IF.c_factor(32))
        assert math.isclose(got[x], expect, rel_tol=1e-9)


def test_nd_forest_share(spark):
    from thermolens.operators.detect.iforest_nd import isolation_forest_nd
    import datetime as dt
    rnd = random.Random(11)
    rows = [(ts(1) + dt.timedelta(hours=i), rnd.gauss(0, 1), rnd.gauss(0, 1), "d", "S") for i in range(300)]
    rows.append((ts(1) + dt.timedelta(hours=301), 9.0, -9.0, "d", "S"))
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, a double, b double, type string, ID string")
    out = isolation_forest_nd(df, ["a", "b"], trees=30, psi=64, contamination=0.05, seed=1, approx_cut=False)
    share = out.agg(F.avg(F.col("isolation_forest_anomaly").cast("int"))).collect()[0][0]
    assert 0.03 <= share <= 0.07
    assert out.orderBy("anomaly_score").first()["a"] == 9.0


def test_nd_scores_equal_a_walk_of_every_tree(spark):
    import datetime as dt

    from thermolens.operators.detect import iforest_nd as N
    rnd = random.Random(12)
    rows = [(ts(1) + dt.timedelta(hours=i), rnd.gauss(0, 1), float(rnd.randrange(3)), 5.0, None if i % 9 == 0 else rnd.random(), "d", "S")
            for i in range(150)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, a double, b double, c double, e double, type string, ID string")
    feats = ["a", "b", "c", "e"]
    nodes = N.fit_forest_nd(df, feats, trees=7, psi=32, seed=4)
    table = {(r["tree"], r["node"]): r for r in nodes.collect()}
    assert {t for t, _ in table} == set(range(7)) and all(r["feature"] != 2 for r in table.values())  # c has no range
    # every inner node has both children, every tree holds its whole sample
    for (t, n), r in table.items():
        kids = [(t, 2 * n) in table, (t, 2 * n + 1) in table]
        assert all(kids) if r["feature"] is not None else not any(kids)
    model = N.ForestND(nodes, feats, 32, 7)
    got = {r["timestamp"]: r["s"] for r in N.score_forest_nd(df, model, "s").collect()}
    for t, a, b, c, e, *_ in rows:
        x = [round(a, 6), b, c, round(e or 0.0, 6)]
        total = 0.0
        for tree in range(7):
            n = 1
            while table[tree, n]["feature"] is not None:
                n = 2 * n + (x[table[tree, n]["feature"]] >= table[tree, n]["threshold"])
            total += table[tree, n]["leaf_h"]
        assert math.isclose(got[t], 2 ** (-(total / 7) / IF.c_factor(32)), abs_tol=1e-8)
    again = {tuple(r) for r in N.fit_forest_nd(df.repartition(5), feats, trees=7, psi=32, seed=4).collect()}
    assert again == {tuple(r) for r in nodes.collect()}


def test_scoring_runs_no_python(spark, data):
    from thermolens.operators.detect import iforest_nd as N
    model = N.ForestND(N.fit_forest_nd(data, ["avg"], trees=3, psi=16, seed=1), ["avg"], 16, 3)
    plan = N.score_forest_nd(data, model, "s")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_a_large_table_puts_a_row_into_one_pool(spark):
    rows = spark.range(60_000).select(F.lit("k").alias("_k"), F.col("id").alias("_us"))
    for trees, psi in ((10, 64), (4, 16)):
        d = IF.tree_samples(rows, trees, psi, 42).cache()
        n = {r["tree"]: r["count"] for r in d.groupBy("tree").count().collect()}
        assert n == {t: psi for t in range(trees)}
        assert d.select("_us").distinct().count() == trees * psi     # no row in two trees


def test_without_pools_every_tree_draws_from_the_whole_table(spark):
    import hashlib
    n, trees, psi, seed = 6_000, 10, 64, 42
    rows = spark.range(n).select(F.lit("k").alias("_k"), F.col("id").alias("_us"))
    got = {}
    for r in IF.complete_samples(rows, trees, psi, seed, pools=False).collect():
        got.setdefault(r["tree"], set()).add(r["_us"])
    b = [int(hashlib.md5(f"{seed}:k:{i}".encode()).hexdigest()[:8], 16) for i in range(n)]
    for t in range(trees):
        a = ((t + 1) * 1103515245 + seed * 12345) % 2 ** 31
        rank = sorted(range(n), key=lambda i: ((b[i] * (a - a % 2 + 1) + t * 69069) % 2 ** 32, i))
        assert got[t] == set(rank[:psi])
