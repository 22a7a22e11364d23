import math
import random
import zlib

import numpy as np
import pytest

from thermolens.llm import toxicity as T
from thermolens.llm.queries import op12_toxicity

SF = "/root/testdata/sf0.01"


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def one_way(rows, u):
    """States of one direction, step by step."""
    h, out, k = np.zeros(u.shape[0]), [], u.shape[0]
    for x in rows:
        g = h @ u
        r, z = sigmoid(x[:k] + g[:k]), sigmoid(x[k:2 * k] + g[k:2 * k])
        n = np.tanh(x[2 * k:] + r * g[2 * k:])
        h = (1 - z) * n + z * h
        out.append(h)
    return out


def two_ways(rows, w, b, u):
    sums = [(x @ w + b).reshape(2, -1) for x in rows]
    ahead = one_way([s[0] for s in sums], u[0])
    back = one_way([s[1] for s in sums[::-1]], u[1])[::-1]
    return [np.concatenate(x) for x in zip(ahead, back)]


def attended(h, a, v):
    e = np.array([np.tanh(x @ a) @ v for x in h])
    w = np.exp(e - e.max())
    return (w / w.sum()) @ np.array(h)


def plain_logit(p, window):
    """The network on one window, word by word, character by character."""
    rows = []
    for word in window:
        codes = [0, 0, *map(ord, word.lower())]
        mixed = [sum(c * int(m) for c, m in zip((codes[i], codes[i - 1], codes[i - 2]), T._MIX)) % 2 ** 64 >> 40
                 for i in range(2, len(codes))]
        h = two_ways([p["chars"][m % T.CHAR_BUCKETS].astype(float) for m in mixed], p["char_in"], p["char_b"], p["char_u"])
        key = word.lower().strip(T._EDGES) or word.lower()
        rows.append(np.concatenate([p["words"][zlib.crc32(key.encode()) % T.WORD_BUCKETS],
                                    attended(h, p["char_a"], p["char_v"])]))
    h = two_ways(rows, p["word_in"], p["word_b"], p["word_u"])
    return attended(h, p["word_a"], p["word_v"]) @ p["out"] + p["out_b"][0]


def plain_statistics(p, text):
    words = [x for w in (text or "").split() for x in T.pieces(w)]
    if not words:
        return 0, None, 0.0
    last = max(0, len(words) - T.WINDOW)
    starts = sorted({min(a, last) for a in range(0, last + T.STRIDE, T.STRIDE)})
    logits = [plain_logit(p, words[a:a + T.WINDOW]) for a in starts]
    return len(starts), max(logits), sum(sigmoid(x) for x in logits)


@pytest.fixture(scope="module")
def network():
    return T.new_network(3)


def test_windows_cover_every_word():
    for n in (*range(0, 3 * T.WINDOW), 1000, 10007):
        starts = T.window_starts(n).tolist()
        held = {i for a in starts for i in range(a, min(a + T.WINDOW, n))}
        assert held == set(range(n)) and len(set(starts)) == len(starts)
        assert all(b - a <= T.STRIDE for a, b in zip(starts, starts[1:]))


def test_scores_equal_the_plain_network(spark, edge, empty, network):
    rnd = random.Random(5)
    words = ["bad", "Good!", "réeuxan", "x" * 40, "中文中文", "a,b", "İİİİİİİİİİİİİİİİ", "\U0001F600", "..."]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate((0, 1, 3, 63, 64, 65, 130, 200))]
    docs += [(None, "no id"), (3, "repeated id"), (50, None), (51, " \n\t"), (52, "y" * 300)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = sorted(map(tuple, T.window_statistics(d, network).collect()), key=repr)
    want = sorted(((i, *plain_statistics(network, t)) for i, t in docs), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert w[2] is None or g[2] == pytest.approx(w[2], abs=1e-3)
        assert g[3] == pytest.approx(w[3], abs=1e-3)
    assert T.window_statistics(edge, network).count() == edge.count()
    assert T.window_statistics(empty, network).count() == 0


def test_cache_is_bounded_and_does_not_matter(network, monkeypatch):
    monkeypatch.setattr(T, "_CACHE_WORDS", 20)
    texts = [" ".join(f"w{i * 7 + j}" for j in range(30)) for i in range(20)]
    small = T.Scorer(network)
    a = np.concatenate([small.statistics([t]) for t in texts])
    assert small.used <= 20 + 30
    np.testing.assert_allclose(a, T.Scorer(network).statistics(texts), atol=1e-4)


def test_gradients_equal_differences():
    p = {k: v.astype(np.float32) for k, v in T.new_network(1).items()}
    bags = [[["hello", "wor.", "a"], ["bb", "a"]], [["x"]], [["longerword", "hello", "hello", "z"]]]
    y, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])
    _, g = T.gradients(p, bags, y, None, weight)
    for k, v in p.items():
        for i in np.argsort(-np.abs(g[k]).ravel())[:3]:
            at = np.unravel_index(i, v.shape)
            old, near = v[at], []
            for e in (1e-2, -1e-2):
                v[at] = old + np.float32(e)
                near.append(T.gradients(p, bags, y, None, weight)[0])
            v[at] = old
            assert (near[0] - near[1]) / 2e-2 == pytest.approx(float(g[k][at]), rel=2e-2, abs=2e-4), k


def toy(n, seed):
    """Documents with a few marked words in the toxic ones."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(rnd.randrange(5, 300))]
        y = i % 3 == 0
        if y:
            for at in range(0, len(words), 40):
                words[rnd.randrange(at, min(at + 40, len(words)))] = "zzq" + rnd.choice("abc")
        rows.append((i, " ".join(words), int(y)))
    return rows


def test_learns_and_is_stable(spark):
    rows = toy(420, 1)
    docs = spark.createDataFrame([(i, t, "n") for i, t, _ in rows], "doc_id long, text string, score string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (10 ** 6, 1)],
                                   "doc_id long, toxic int")
    model = T.fit(docs, labels, min_steps=160)
    got = {r["doc_id"]: r["score"] for r in T.scored(docs, model).collect()}
    out = [(got[i] >= 0.7) == bool(y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(out) > 100 and np.mean(out) > 0.9
    again = T.fit(docs.repartition(7), labels.repartition(3), min_steps=160)
    assert all(np.array_equal(model["network"][k], again["network"][k]) for k in model["network"])
    assert np.allclose(model["document"], again["document"])


def test_held_out_labels_have_no_effect(spark):
    rows = toy(60, 2)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    flip = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in rows]
    a, b = (T.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int"), rounds=1, min_steps=1)
            for x in ([(i, y) for i, _, y in rows], flip))
    assert all(np.array_equal(a["network"][k], b["network"][k]) for k in a["network"])
    assert a["constant"] == b["constant"]


def test_one_class_and_no_labels(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(4, 1), (5, 1), (6, 1), (7, 1)], "doc_id long, toxic int")
    for labels in (none, one):
        model = T.fit(edge, labels)
        got = T.scored(edge, model).collect()
        assert len(got) == edge.count() and len({r["score"] for r in got}) == 1 and 0 < got[0]["score"] < 1
    assert T.scored(empty, T.fit(empty, none)).count() == 0


def test_query_on_whole_table(spark):
    d = op12_toxicity(spark, SF)
    assert d.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = d.collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    y = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic is not null").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) and math.isfinite(r["score"])
    out = [(r["predicted"], y[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in y]
    assert np.mean([a == b for a, b in out]) > 0.8
