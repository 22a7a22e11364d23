"""Quality classifier: Naive Bayes support vectors over hashed n-gram indicators.

Features of a text are indicators in ``BUCKETS`` hash buckets: its words, word pairs, the shapes of words
(letter, digit and mark runs) and runs of up to three shapes, and how often its most
repeated pair occurs (in powers of two).  Nothing but the text is read.

Fitting.  Spark counts, over all labelled training documents, in how many of each class a
bucket is set; r = log of the ratio of the smoothed, normalised class counts.  A
document's vector has r in its buckets, scaled to length 1.  A linear hinge-loss model is fitted by dual coordinate
descent on a hash-chosen sample of about ``MAX_TRAIN`` training documents (documented
bound; everything else covers all rows).  A sigmoid over the margins of a held-back
part of that sample turns a margin into the chance of label 1.

Scoring is one pass over all documents with two vectors of ``BUCKETS`` floats.

Defined cases: null text = empty text (no features, margin of the bias); null labels and labels
without a document are ignored; a document labelled twice counts with the rounded mean
label; without both classes every score is the smoothed share of label 1; null ids are never
held out nor labelled; repeated rows are rows of their own; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, with_workers

BUCKETS = 1 << 18
MAX_TRAIN = 8_000
# Ids (about 70 bytes each, so 17 MB) up to which they are broadcast.
BROADCAST_IDS = 250_000
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 12
CALIBRATION_PART = 4
_CACHE_WORDS = 300_000
_RUNS = re.compile(r"[A-ZÀ-ÖØ-Þ]+|[^\W\d_A-ZÀ-ÖØ-Þ]+|\d+|[\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _shape(word: str) -> str:
    """Runs of a word by kind: upper A, lower a, digits 0, marks as they are (a run as one)."""
    out = []
    for run in _RUNS.findall(word):
        c = run[0]
        out.append("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else
                   "".join(sorted(set(run))))
    return "".join(out)


class WordHashes(dict):
    """Word -> (hash, hash of its shape); a bounded cache."""

    def __missing__(self, word: str) -> tuple[int, int]:
        h = (xxhash.xxh64_intdigest(word, 1), xxhash.xxh64_intdigest(_shape(word), 2))
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = h
        return h


_HASHES = WordHashes()


def _mixed(*parts: np.ndarray) -> np.ndarray:
    out = parts[0].copy()
    for p in parts[1:]:
        out = (out ^ (out >> np.uint64(29))) * _ODD + p
    return out ^ (out >> np.uint64(32))


def features(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Sorted distinct bucket numbers of a text."""
    words = (text or "").split()
    if not words:
        return np.empty(0, dtype=np.int32)
    h = np.array(list(map(_HASHES.__getitem__, words)), dtype=np.uint64)
    w, s = h[:, 0], h[:, 1]
    every = [w, s]
    if len(words) > 1:
        pairs = _mixed(w[:-1], w[1:])
        every += [pairs, _mixed(s[:-1], s[1:])]
        most = int(np.unique(pairs, return_counts=True)[1].max())
        share = most * 32 // len(pairs)
        every.append(np.array([most.bit_length(), 64 + share.bit_length()], dtype=np.uint64) * _ODD)
    if len(words) > 2:
        every.append(_mixed(s[:-2], s[1:-1], s[2:]))
    return np.unique((np.concatenate(every) >> np.uint64(7)) % np.uint64(buckets)).astype(np.int32)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, y, h) of the labelled documents that are not held out; h: a hash of the id."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.round(F.avg("quality")).cast("int").alias("y"))
    known = checkpointed(known.where(~held_out(F.col("doc_id"))))
    if known.count() <= BROADCAST_IDS:
        known = F.broadcast(known)  # more ids than that meet the texts in a shuffled join
    d = docs.select("doc_id", "text").join(known, "doc_id")
    return d.select("text", "y", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("h"))


def class_counts(train: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n0, n1): documents of each class in which a bucket is set; bucket -1
    counts the documents.  A partition adds up in two fixed arrays."""
    def run(batches):
        n = np.zeros((2, buckets + 1), dtype=np.int64)
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                n[y, features(text, buckets)] += 1
                n[y, buckets] += 1
        at = np.flatnonzero(n.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(at == buckets, -1, at).astype(np.int32)), pa.array(n[0, at]), pa.array(n[1, at])],
            ["bucket", "n0", "n1"])

    part = train.where("y in (0, 1)").select("text", "y").mapInArrow(run, "bucket int, n0 long, n1 long")
    return part.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def log_ratios(counts, buckets: int = BUCKETS) -> tuple[np.ndarray, int, int]:
    """(r, documents of class 0, of class 1) from the class counts (at most buckets + 1 rows)."""
    n = np.zeros((2, buckets), dtype=np.float64)
    docs = [0, 0]
    for b, a0, a1 in zip(counts["bucket"], counts["n0"], counts["n1"], strict=True):
        if b < 0:
            docs = [int(a0), int(a1)]
        else:
            n[0, b], n[1, b] = a0, a1
    p = n + SMOOTHING
    # unseen buckets say nothing
    r = np.where(n.sum(axis=0) > 0, np.log(p[1] / p[1].sum()) - np.log(p[0] / p[0].sum()), 0.0)
    return r, docs[0], docs[1]


def _unit(idx: np.ndarray, r: np.ndarray) -> np.ndarray:
    x = r[idx]
    n = np.sqrt(x @ x)
    return x / n if n > 0 else x


def fit_hinge(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, cost: float = COST,
              rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model, by dual coordinate descent; classes
    weigh alike.  The order of the documents in each round comes from a fixed seed."""
    w, bias = np.zeros(len(r)), 0.0
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.array([(y == 0).mean(), (y == 1).mean()])
    upper = cost * 0.5 / share[y]
    alpha = np.zeros(len(rows))
    xs = [_unit(i, r) for i in rows]
    q = np.array([x @ x + 1.0 for x in xs])
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            idx, x, s = rows[i], xs[i], sign[i]
            g = s * (w[idx] @ x + bias) - 1.0
            a = min(max(alpha[i] - g / q[i], 0.0), upper[i])
            step = (a - alpha[i]) * s
            if step:
                alpha[i] = a
                w[idx] += step * x
                bias += step
    return w, bias


def fit_sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a * margin + b))), by Newton steps on the smoothed likelihood."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - t) * margin).sum(), (p - t).sum()])
        v = p * (1 - p) + 1e-9
        hess = np.array([[(v * margin * margin).sum() + 1e-6, (v * margin).sum()],
                         [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a, 1e-6)), float(b)


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_train: int = MAX_TRAIN) -> dict:
    """The fitted model: weights per bucket (already times r), r, bias, and the sigmoid."""
    with_workers(docs.sparkSession)
    train = training_rows(docs, labels)
    r, n0, n1 = log_ratios(class_counts(train, buckets).toPandas(), buckets)
    if not n0 or not n1:
        return {"constant": (n1 + 1) / (n0 + n1 + 2)}
    # about max_train rows, chosen by hash: the same rows in every run
    chosen = train.where(F.col("h") < F.lit(int(min(1.0, max_train / (n0 + n1)) * (1 << 30))))

    def run(batches):
        for b in batches:
            lists = [features(t, buckets) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), b.column(1), b.column(2)],
                                             ["x", "y", "h"])

    table = chosen.where("y in (0, 1)").select("text", "y", "h").mapInArrow(
        run, "x array<int>, y int, h long").toArrow().sort_by([("h", "ascending")])
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in table["x"]])])
    flat = np.concatenate([c.flatten().to_numpy() for c in table["x"].chunks]) if offsets[-1] else np.empty(0, np.int32)
    rows = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    y = table["y"].to_numpy()
    back = np.arange(len(y)) % CALIBRATION_PART == 0
    if len(set(y[~back])) < 2 or len(set(y[back])) < 2:
        back = np.zeros(len(y), dtype=bool)
    if len(set(y[~back])) < 2:
        return {"constant": (n1 + 1) / (n0 + n1 + 2)}
    own = np.flatnonzero(~back)
    w, bias = fit_hinge([rows[i] for i in own], y[own], r)
    on = np.flatnonzero(back) if back.any() else own
    margins = np.array([w[rows[i]] @ _unit(rows[i], r) + bias for i in on])
    a, b = fit_sigmoid(margins, y[on])
    return {"w": w.astype(np.float32), "r": r.astype(np.float32), "bias": bias, "a": a, "b": b}


def score_text(text: str | None, model: dict, buckets: int = BUCKETS) -> float:
    if "constant" in model:
        return model["constant"]
    idx = features(text, buckets)
    m = float(model["w"][idx] @ _unit(idx, model["r"])) + model["bias"]
    return float(1 / (1 + np.exp(-np.clip(model["a"] * m + model["b"], -30, 30))))


def scored(docs: DataFrame, model: dict, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    with_workers(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            s = [score_text(t, sent.value, buckets) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")
