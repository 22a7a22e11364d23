import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from thermolens.llm import hard_negatives as H
from thermolens.llm.queries import mining_rows, op11_hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, score string, anchor string, id string, slot string"


def brute(rows, every=100, k=5, m=5):
    """Rows (vec_id, label, vector) -> the contract's result; repeated ids allowed."""
    ok = [(i, lb, v) for i, lb, v in rows if i is not None and lb is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    dims = max((len(v) for _, _, v in ok), default=0)
    most = H.limit(dims)
    ok = [(i, lb, [max(-most, min(most, math.floor(256.0 * float(np.float32(x))))) for x in v]) for i, lb, v in ok]
    asked = {}
    for i, lb, v in ok:
        if i % every == 0:
            asked[i] = min(asked.get(i, (lb, v)), (lb, v))
    out = []
    for a, (label, vec) in asked.items():
        s = sorted((-sum(x * y for x, y in zip(vec, v)), i, lb) for i, lb, v in ok if i != a)
        for p in [x for x in s if x[2] == label][:k]:
            fits = [x for x in s if x[2] != label and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]][:m]
            out += [(a, p[1], r + 1, x[1], -p[0], -x[0]) for r, x in enumerate(fits)]
    return sorted(out)


def run(spark, rows, **kw):
    d = spark.createDataFrame([(*r, "s", "a", "i", "x") for r in rows], SCHEMA).repartition(3)
    got = H.mined(d, F.col("vec_id") % 100 == 0, **kw)
    return sorted(tuple(r) for r in got.collect())


def small_vectors(n, seed, dims=3, values=(-0.5, -0.1, 0.0, 0.1, 0.5, 0.9)):
    rnd = random.Random(seed)
    return [(i, rnd.randrange(3), [rnd.choice(values) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_in_many_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(H, "ROW_BLOCK", 150)
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 2)
    rows = small_vectors(700, seed)
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 20


def test_nulls_repeats_and_odd_components(spark):
    rows = small_vectors(320, 3, dims=2)
    rows += [(None, 1, [0.5, 0.5]), (401, None, [0.5, 0.5]), (402, 1, None), (403, 1, [0.5, None]),
             (404, 1, [float("nan"), 0.1]), (405, 2, [float("inf"), 0.1]), (406, 1, [float("-inf"), 0.1]),
             (407, 0, []), (500, 1, []), (408, 2, [0.9]), (600, 2, [0.9, 0.1, 0.3])]
    rows += rows[100:140] + [(100, 2, [0.9, 0.9]), (200, 0, [0.1, 0.1])]
    assert run(spark, rows) == brute(rows)


def test_one_vector_a_third_of_all(spark):
    rows = small_vectors(600, 4)
    rows = [(i, lb, [0.5, 0.5, 0.5] if i % 3 == 0 else v) for i, lb, v in rows]
    assert run(spark, rows) == brute(rows)


def test_huge_components(spark):
    rows = [(i, i % 2, [x * 10.0 ** (i % 25), 0.3]) for i, (_, _, (x, *_)) in enumerate(small_vectors(220, 5))]
    assert run(spark, rows) == brute(rows)


def test_empty_and_one_label(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, 1, [0.1]), (1, 1, [0.2])]) == []
    assert run(spark, [(0, 1, [0.1]), (1, 2, [0.2])]) == []


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in mining_rows(spark, sf).select("vec_id", "label", "embedding").collect()]
    d = op11_hard_negatives(spark, sf)
    assert d.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                        ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert sorted(tuple(r) for r in d.collect()) == brute(rows)


def test_slots_keep_the_best_per_slot():
    best = H.Best(2, 2)
    best.add(np.array([0, 0, 0, 1]), np.array([5, 5, 7, 1]), np.array([9, 3, 4, 8]))
    best.add(np.array([0, 1]), np.array([5, 2]), np.array([1, 8]))
    c, s, i = best.rows()
    assert list(zip(c.tolist(), s.tolist(), i.tolist())) == [(0, 7, 4), (0, 5, 1), (1, 2, 8), (1, 1, 8)]
    assert H._lower(np.array([10, 11, -10, 0, 99]), 80).tolist() == [8, 9, -8, 0, 80]


def test_scores_are_exact_beyond_doubles():
    a = np.array([[2 ** 28, 3]], dtype=np.int64)
    assert H.scores(a, np.array([[2 ** 28, 1]], dtype=np.int64)).tolist() == [[2 ** 56 + 3]]
    assert H.whole(pa.array([[0.5], [1.0, -0.001]], pa.list_(pa.float32())), 2).tolist() == [[128, 0], [256, -1]]
