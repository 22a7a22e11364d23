"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs.  A text is cut at white space into words; a word longer than ``WORD_CHARS`` characters is several inputs.
Character level: a bidirectional GRU over a word's characters, pooled by attention, gives the word's spelling
vector.  Word level: the spelling vector beside a hashed word embedding goes
through a second bidirectional GRU over the words of a window, pooled by attention, to one logit.

Windows.  Every text is covered by overlapping windows of ``WINDOW`` inputs, ``STRIDE`` apart, the last one ending with
the text; all are scored, with no bound on their number.  A document's score is a logistic function of its largest
window logit, the mean of its window probabilities and the logarithm of its number of windows.

Fitting.  Labelled documents that aren't held out are chosen by a hash of their id, up to ``MAX_TRAIN`` of each class, and of
each up to ``TRAIN_WINDOWS`` windows (documented bounds of the fit; scoring has none).  A label holds for a document, not for
each of its windows, so the loss is that of the document's noisy-or over its windows.  A fourth of the
chosen documents is held back: Spark scores all of their windows, and the document's logistic function is fitted on the results.

Spelling vectors do not depend on a word's neighbours; a worker computes them once per
word and keeps them, already multiplied by the input weights, in a bounded cache.

Defined cases: null text = empty text; a text without words gets the smoothed share of label 1; null labels, null ids and labels
without a document are ignored; a document labelled twice counts with the rounded mean label; of rows that repeat a
chosen id one is trained on; without both classes every score is the smoothed share of label 1; repeated rows are rows of their
own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, texts_of, with_workers

WINDOW = 64
STRIDE = 48
WORD_CHARS = 16
MAX_TRAIN = 2_500
TRAIN_WINDOWS = 4
CALIBRATION_PART = 4
ROUNDS = 4
# A small training set goes round more often, up to so many steps.
MIN_STEPS = 400
# Share of a window's inputs, and of word embeddings, that a training step leaves out: no document is learned by heart.
INPUT_DROP, WORD_DROP = 0.3, 0.4
CHAR_BUCKETS = 1 << 13
WORD_BUCKETS = 1 << 14
CHAR_DIM, CHAR_HIDDEN, WORD_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8, 8
_CACHE_WORDS = 200_000
# Words of a group of texts, and windows of a batch, that a worker scores at a time.
_GROUP_WORDS = 60_000
_BATCH_WINDOWS = 1_024
# Odd multipliers of a character and the two before it.
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_EDGES = "\"'.,;:!?()[]{}<>*_-"


# ---- the network

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def gru(x: np.ndarray, u: np.ndarray, mask: np.ndarray | None, trace: list | None = None) -> np.ndarray:
    """States (T, 2, B, H) of a bidirectional GRU; x (T, 2, B, 3H): input sums (reset, update, new) of both
    directions, each in its own order of steps; u (2, H, 3H); mask (T, 2, B, 1): 1 where there is an input."""
    hidden = u.shape[1]
    h = np.zeros((2, x.shape[2], hidden), np.float32)
    out = np.empty((len(x), *h.shape), np.float32)
    for t, step in enumerate(x):
        g = h @ u
        rz = _sigmoid(step[..., :2 * hidden] + g[..., :2 * hidden])
        r, z, gn = rz[..., :hidden], rz[..., hidden:], g[..., 2 * hidden:]
        n = np.tanh(step[..., 2 * hidden:] + r * gn)
        new = n + z * (h - n)
        if mask is not None:
            new = h + mask[t] * (new - h)
        if trace is not None:
            trace.append((h, r, z, n, gn))
        h = out[t] = new
    return out


def gru_back(d: np.ndarray, u: np.ndarray, mask: np.ndarray | None, trace: list) -> tuple[np.ndarray, np.ndarray]:
    """(gradient of x, of u) from that of the states."""
    dx, du, ahead = np.empty((*d.shape[:3], 3 * d.shape[3]), np.float32), np.zeros_like(u), np.zeros_like(d[0])
    for t in range(len(d) - 1, -1, -1):
        h, r, z, n, gn = trace[t]
        dh = d[t] + ahead
        new = dh if mask is None else mask[t] * dh
        dn = new * (1 - z) * (1 - n * n)
        dz = new * (h - n) * z * (1 - z)
        dr = dn * gn * r * (1 - r)
        dg = np.concatenate([dr, dz, dn * r], axis=-1)
        dx[t] = np.concatenate([dr, dz, dn], axis=-1)
        du += h.transpose(0, 2, 1) @ dg
        ahead = new * z + dg @ u.transpose(0, 2, 1) + (0 if mask is None else dh - new)
    return dx, du


def both_ways(x: np.ndarray) -> np.ndarray:
    """(T, B, 2, K) in text order to (T, 2, B, K) in each direction's order."""
    return np.ascontiguousarray(np.stack([x[:, :, 0], x[::-1, :, 1]], axis=1))


def _in_order(h: np.ndarray) -> np.ndarray:
    """(T, 2, B, H) in each direction's order to (T, B, 2H) in text order."""
    return np.concatenate([h[:, 0], h[::-1, 1]], axis=-1)


def pool(h: np.ndarray, live: np.ndarray, a: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Attention pooling of (T, B, K) over T where ``live`` (T, B): (pooled (B, K), trace)."""
    s = np.tanh(h @ a)
    e = np.where(live, s @ v, np.float32(-1e9))
    w = np.exp(e - e.max(axis=0))
    w *= live
    w /= np.maximum(w.sum(axis=0), np.float32(1e-20))
    return np.einsum("tb,tbk->bk", w, h), (s, w)


def pool_back(d: np.ndarray, h: np.ndarray, a: np.ndarray, v: np.ndarray, trace: tuple):
    """(gradient of h, a, v) from that of the pooled vectors."""
    s, w = trace
    own = np.einsum("bk,tbk->tb", d, h)
    de = w * (own - (w * own).sum(axis=0))
    ds = de[..., None] * v * (1 - s * s)
    da = np.einsum("tbk,tbj->kj", h, ds)
    return w[..., None] * d + ds @ a.T, da, np.einsum("tb,tbj->j", de, s)


def new_network(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def of(*shape, scale=None):
        scale = scale or 1 / np.sqrt(shape[-2] if len(shape) > 1 else shape[0])
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    word_in, deep = WORD_DIM + 2 * CHAR_HIDDEN, 2 * HIDDEN
    return {
        "chars": of(CHAR_BUCKETS, CHAR_DIM, scale=0.5), "words": of(WORD_BUCKETS, WORD_DIM, scale=0.1),
        "char_in": of(CHAR_DIM, 2 * 3 * CHAR_HIDDEN), "char_b": np.zeros(2 * 3 * CHAR_HIDDEN, np.float32),
        "char_u": of(2, CHAR_HIDDEN, 3 * CHAR_HIDDEN), "char_a": of(2 * CHAR_HIDDEN, ATTENTION), "char_v": of(ATTENTION),
        "word_in": of(word_in, 2 * 3 * HIDDEN), "word_b": np.zeros(2 * 3 * HIDDEN, np.float32),
        "word_u": of(2, HIDDEN, 3 * HIDDEN), "word_a": of(deep, ATTENTION), "word_v": of(ATTENTION),
        "out": of(deep), "out_b": np.full(1, -2.0, np.float32),
    }


# ---- words

def pieces(word: str) -> list[str]:
    """A word as inputs of at most ``WORD_CHARS`` characters."""
    return [word[i:i + WORD_CHARS] for i in range(0, len(word), WORD_CHARS)]


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of each character with the two before it (T, W), lengths, word buckets) of inputs."""
    plain = [w.lower() for w in words]  # may be longer than the word
    n = np.fromiter(map(len, plain), np.int64, len(words))
    code = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32)
    padded = np.zeros((int(n.max(initial=1)) + 2, len(words)), np.uint64)
    at = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n)
    padded[at + 2, np.repeat(np.arange(len(words)), n)] = code
    mixed = (padded[2:] * _MIX[0] + padded[1:-1] * _MIX[1] + padded[:-2] * _MIX[2]) >> np.uint64(40)
    bucket = [zlib.crc32((w.strip(_EDGES) or w).encode("utf-8", "surrogatepass")) for w in plain]
    return (mixed % np.uint64(CHAR_BUCKETS)).astype(np.int64), n, np.array(bucket, np.int64) % WORD_BUCKETS


def spelling(p: dict, chars: np.ndarray, n: np.ndarray, trace: dict | None = None) -> np.ndarray:
    """Spelling vectors (W, 2 * CHAR_HIDDEN)."""
    table = (p["chars"] @ p["char_in"] + p["char_b"]).reshape(CHAR_BUCKETS, 2, -1)
    live = np.arange(len(chars))[:, None] < n
    mask = both_ways(np.repeat(live[..., None, None], 2, axis=2).astype(np.float32))
    steps: list | None = None if trace is None else []
    h = _in_order(gru(both_ways(table[chars]), p["char_u"], mask, steps))
    out, own = pool(h, live, p["char_a"], p["char_v"])
    if trace is not None:
        trace.update(mask=mask, steps=steps, h=h, own=own, chars=chars, live=live)
    return out


def inputs(p: dict, words: list[str]) -> np.ndarray:
    """(W, 2 * 3 * HIDDEN): the words' share of the word level's sums."""
    chars, n, bucket = spelled(words)
    order = np.argsort(n, kind="stable")  # short words need few steps
    v = np.empty((len(words), 2 * CHAR_HIDDEN), np.float32)
    for lo in range(0, len(order), 4096):
        own = order[lo:lo + 4096]
        v[own] = spelling(p, chars[:n[own].max(initial=1), own], n[own])
    return np.concatenate([p["words"][bucket], v], axis=1) @ p["word_in"] + p["word_b"]


def window_logits(p: dict, table: np.ndarray, at: np.ndarray, n: np.ndarray, trace: dict | None = None) -> np.ndarray:
    """Logits of windows: at (T, B) rows of ``table`` (W, 2 * 3 * HIDDEN), n their lengths."""
    live = np.arange(len(at))[:, None] < n
    mask = None
    if not live.all():
        mask = both_ways(np.repeat(live[..., None, None], 2, axis=2).astype(np.float32))
    steps: list | None = None if trace is None else []
    h = _in_order(gru(both_ways(table.reshape(len(table), 2, -1)[at]), p["word_u"], mask, steps))
    c, own = pool(h, live, p["word_a"], p["word_v"])
    if trace is not None:
        trace.update(mask=mask, steps=steps, h=h, own=own, c=c)
    return c @ p["out"] + p["out_b"]


def window_starts(n: int) -> np.ndarray:
    """First inputs of the windows over ``n`` inputs."""
    last = max(0, n - WINDOW)
    return np.minimum(np.arange(0, last + STRIDE, STRIDE), last) if n else np.empty(0, np.int64)


# ---- training

def gradients(p: dict, bags: list[list[list[str]]], y: np.ndarray, drop: np.random.Generator | None,
              weight: np.ndarray | None = None) -> tuple[float, dict]:
    """(mean loss, gradients) of documents, each a list of windows, each a list of inputs."""
    windows = [w for bag in bags for w in bag]
    if drop is not None:
        windows = [[x for x, u in zip(w, drop.random(len(w)), strict=True) if u > INPUT_DROP] or w for w in windows]
    bag_of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    flat = [w for win in windows for w in win]
    words = list(dict.fromkeys(flat))
    row = {w: i for i, w in enumerate(words)}
    n = np.array([len(w) for w in windows])
    at = np.zeros((n.max(), len(windows)), np.int64)
    live = np.arange(len(at))[:, None] < n
    at.T[live.T] = [row[w] for w in flat]

    chars, length, bucket = spelled(words)
    low: dict = {}
    v = spelling(p, chars, length, low)
    # some words are known by their spelling alone, so that it is learned for rare words too
    seen = np.ones((len(words), 1), np.float32) if drop is None else (drop.random((len(words), 1)) > WORD_DROP).astype(np.float32)
    x = np.concatenate([p["words"][bucket] * seen, v], axis=1)
    table = x @ p["word_in"] + p["word_b"]
    high: dict = {}
    logit = window_logits(p, table, at, n, high)

    # noisy-or of a document's windows, in logarithms
    q = _sigmoid(logit.astype(np.float64))
    log_none = np.bincount(bag_of, -np.logaddexp(0, logit), len(bags))
    none = np.exp(log_none)
    weight = np.ones(len(bags)) if weight is None else weight
    loss = np.where(y > 0, -np.log(np.maximum(1 - none, 1e-12)), -log_none) * weight
    factor = np.where(y > 0, -none / np.maximum(1 - none, 1e-12), 1.0) * weight
    d = (factor[bag_of] * q / len(bags)).astype(np.float32)

    g = {"out": high["c"].T @ d, "out_b": d.sum(keepdims=True)}
    dh, g["word_a"], g["word_v"] = pool_back(d[:, None] * p["out"], high["h"], p["word_a"], p["word_v"], high["own"])
    dx, g["word_u"] = gru_back(both_ways(dh.reshape(*dh.shape[:2], 2, -1)), p["word_u"], high["mask"], high["steps"])
    dx = np.stack([dx[:, 0], dx[::-1, 1]], axis=2).reshape(*at.shape, -1)
    dtable = np.zeros_like(table)
    np.add.at(dtable, at[live], dx[live])
    g["word_b"] = dtable.sum(axis=0)
    g["word_in"] = x.T @ dtable
    dv = dtable @ p["word_in"].T
    g["words"] = np.zeros_like(p["words"])
    np.add.at(g["words"], bucket, dv[:, :WORD_DIM] * seen)

    dh, g["char_a"], g["char_v"] = pool_back(dv[:, WORD_DIM:], low["h"], p["char_a"], p["char_v"], low["own"])
    dx, g["char_u"] = gru_back(both_ways(dh.reshape(*dh.shape[:2], 2, -1)), p["char_u"], low["mask"], low["steps"])
    dx = np.stack([dx[:, 0], dx[::-1, 1]], axis=2).reshape(*chars.shape, -1)
    dchars = np.zeros((CHAR_BUCKETS, dx.shape[-1]), np.float32)
    np.add.at(dchars, chars[low["live"]], dx[low["live"]])
    g["char_b"] = dchars.sum(axis=0)
    g["char_in"] = p["chars"].T @ dchars
    g["chars"] = dchars @ p["char_in"].T
    return float(loss.mean()), g


def train(bags: list[list[list[str]]], y: np.ndarray, rounds: int = ROUNDS, batch: int = 32, rate: float = 0.01,
          seed: int = 0, min_steps: int = MIN_STEPS) -> dict[str, np.ndarray]:
    """The network fitted to documents (lists of windows of inputs) by Adam; classes weigh alike, the
    order comes from a fixed seed."""
    p, rng = new_network(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    share = np.array([(y == 0).mean(), (y == 1).mean()])
    weight = 0.5 / share[y]
    each = -(-len(bags) // batch)
    rounds = max(rounds, -(-min_steps // each))
    step, steps = 0, rounds * each
    for _ in range(rounds):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            own = order[lo:lo + batch]
            _, g = gradients(p, [bags[i] for i in own], y[own], rng, weight[own])
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            step += 1
            now = rate * min(1.0, 1.5 * (1 - step / (steps + 1)))
            for k, x in g.items():
                x = x * min(1.0, 5.0 / (norm + 1e-9))
                first[k] += 0.1 * (x - first[k])
                second[k] += 0.01 * (x * x - second[k])
                p[k] -= now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
            p["words"] *= 1 - 0.05 * now
    return p


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic function of x (with a last column of ones), by damped Newton steps."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    loss = lambda v: np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ v)).sum() + (keep * v * v).sum() / 2
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(keep + 1e-9), x.T @ (q - y) + keep * w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


# ---- scoring

class Scorer:
    """Window statistics of texts under one network, with a bounded cache of words."""

    def __init__(self, p: dict):
        self.p = p
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}
        self.long: list[np.ndarray] = []
        self.table = np.empty((0, 2 * 3 * HIDDEN), np.float32)
        self.used = 0

    def _learn(self, words: set[str]) -> None:
        """Add words to the cache; a word of several inputs has the number of its list, below zero."""
        split = {w: pieces(w) for w in words if len(w) > WORD_CHARS}
        new = sorted({x for v in split.values() for x in v if x not in self.row} | (words - split.keys()))
        if new:
            fresh = inputs(self.p, new)
            if self.used + len(new) > len(self.table):
                room = np.empty((max(2 * len(self.table), self.used + len(new)), fresh.shape[1]), np.float32)
                room[:self.used] = self.table[:self.used]
                self.table = room
            self.table[self.used:self.used + len(new)] = fresh
            self.row.update(zip(new, range(self.used, self.used + len(new)), strict=True))
            self.used += len(new)
        for w, v in split.items():
            self.row[w] = -1 - len(self.long)
            self.long.append(np.array([self.row[x] for x in v]))

    def rows(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
        if len(at) and at.min() < 0:
            at = np.concatenate([self.long[-1 - i] if i < 0 else [i] for i in at.tolist()])
        return at

    def statistics(self, texts: list[str | None]) -> np.ndarray:
        """Rows (windows, largest logit, sum of probabilities), one per text."""
        if self.used > _CACHE_WORDS:
            self.forget()
        cut = [(t or "").split() for t in texts]
        new = set().union(*cut) - self.row.keys()
        if new:
            self._learn(new)
        own = [self.rows(w) for w in cut]
        starts = [window_starts(len(a)) for a in own]
        count = np.array([len(s) for s in starts], np.int64)
        out = np.zeros((len(texts), 3))
        if not count.sum():
            return out
        flat = np.concatenate(own)
        base = np.cumsum([len(a) for a in own]) - [len(a) for a in own]
        first = np.concatenate([s + b for s, b in zip(starts, base, strict=True)])
        size = np.repeat([min(len(a), WINDOW) for a in own], count)
        logit = np.empty(len(first))
        order = np.argsort(size, kind="stable")
        for lo in range(0, len(order), _BATCH_WINDOWS):
            w = order[lo:lo + _BATCH_WINDOWS]
            at = first[w] + np.minimum(np.arange(size[w].max())[:, None], size[w] - 1)
            logit[w] = window_logits(self.p, self.table[:self.used], flat[at], size[w])
        has = count > 0
        edge = (np.cumsum(count) - count)[has]
        out[:, 0] = count
        out[has, 1] = np.maximum.reduceat(logit, edge)
        out[has, 2] = np.add.reduceat(1 / (1 + np.exp(-logit)), edge)
        return out


def in_groups(texts, words: int = _GROUP_WORDS):
    """Lists of texts of about ``words`` words together (a longer text is a list of its own)."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or "") // 6 + 1
        if size >= words:
            yield group
            group, size = [], 0
    if group:
        yield group


def columns(stats: np.ndarray) -> np.ndarray:
    """Inputs of a document's logistic function from its window statistics."""
    n = np.maximum(stats[:, 0], 1)
    mean = np.clip(stats[:, 2] / n, 1e-6, 1 - 1e-6)
    return np.stack([stats[:, 1], np.log(mean / (1 - mean)), np.log(n), np.ones(len(n))], axis=1)


def document_scores(stats: np.ndarray, model: dict) -> np.ndarray:
    s = 1 / (1 + np.exp(-np.clip(columns(stats) @ model["document"], -30, 30)))
    return np.where(stats[:, 0] > 0, s, model["constant"])


def window_statistics(docs: DataFrame, p: dict) -> DataFrame:
    """(doc_id, windows, largest, total) of every row of ``docs``: statistics of its window scores."""
    with_workers(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(p)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scorer = Scorer(sent.value)
        for b in batches:
            found = np.concatenate([scorer.statistics(g) for g in in_groups(texts_of(b.column(1)))]) \
                if b.num_rows else np.empty((0, 3))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(found[:, 0].astype(np.int64)), pa.array(found[:, 1]), pa.array(found[:, 2])],
                ["doc_id", "windows", "largest", "total"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, windows long, largest double, total double")


# ---- fitting on Spark

def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def chosen_labels(labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[DataFrame, dict[int, int]]:
    """((doc_id, y, h) of about ``max_train`` documents of each class at most, documents of each class)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.round(F.avg("toxic")).cast("int").alias("y")).where("y in (0, 1)").where(~held_out(F.col("doc_id")))
    known = checkpointed(known.withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 30))))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = [int(min(1.0, max_train / max(n.get(y, 0), 1)) * (1 << 30)) for y in (0, 1)]
    return checkpointed(known.where(F.col("h") < F.when(F.col("y") == 1, bound[1]).otherwise(bound[0]))), n


def training_windows(docs: DataFrame, chosen: DataFrame, windows: int = TRAIN_WINDOWS) -> DataFrame:
    """(doc_id, y, h, bag array of windows): up to ``windows`` windows of each chosen document, spread over it."""
    with_workers(docs.sparkSession)
    d = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # a bounded choice

    def run(batches):
        for b in batches:
            bags = []
            for text in texts_of(b.column(3)):
                words = [x for w in (text or "").split() for x in pieces(w)]
                starts = window_starts(len(words))
                some = starts[np.unique(np.linspace(0, len(starts) - 1, windows).astype(int))] if len(starts) else []
                bags.append([" ".join(words[a:a + WINDOW]) for a in some])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(bags, pa.list_(pa.string()))],
                ["doc_id", "y", "h", "bag"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = d.select("doc_id", "y", "h", "text").mapInArrow(run, f"doc_id {id_type}, y int, h long, bag array<string>")
    return out.groupBy("doc_id").agg(F.min(F.struct("y", "h", "bag")).alias("r")).select("doc_id", "r.*")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, rounds: int = ROUNDS,
        min_steps: int = MIN_STEPS) -> dict:
    """The fitted model: network, weights of a document's logistic function, smoothed share of label 1."""
    chosen, n = chosen_labels(labels, max_train)
    constant = (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)
    none = {"network": None, "document": None, "constant": constant}
    if not n.get(0) or not n.get(1):
        return none
    back = F.pmod(F.xxhash64("h"), F.lit(CALIBRATION_PART)) == 0
    # at most 2 * max_train rows of a few windows; sorted: the same order in every run
    rows = training_windows(docs, chosen.where(~back)).where("size(bag) > 0").select("h", "doc_id", "y", "bag").toArrow()
    rows = rows.sort_by([("h", "ascending"), ("doc_id", "ascending")])
    y = rows["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return none
    p = train([[w.split(" ") for w in bag] for bag in rows["bag"].to_pylist()], y, rounds, min_steps=min_steps)
    held = docs.select("doc_id", "text").join(F.broadcast(chosen.where(back).select("doc_id")), "doc_id")
    stats = window_statistics(held, p).groupBy("doc_id").agg(
        F.min(F.struct("windows", "largest", "total")).alias("s")).select("doc_id", "s.*")
    stats = stats.join(F.broadcast(chosen.select("doc_id", "y", "h")), "doc_id").where("windows > 0").toArrow()
    stats = stats.sort_by([("h", "ascending"), ("doc_id", "ascending")])
    y = stats["y"].to_numpy()
    document = np.array([1.0, 0.0, 0.0, 0.0])
    if len(set(y.tolist())) == 2:
        x = columns(np.stack([stats[c].to_numpy().astype(float) for c in ("windows", "largest", "total")], axis=1))
        document = fit_logistic(x, y)
    return {"network": p, "document": document, "constant": constant}


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, windows, largest) of every row of ``docs``; largest: the logit of its most toxic window."""
    if model["network"] is None:
        return docs.select("doc_id", F.lit(float(model["constant"])).alias("score"), F.lit(0).cast("long").alias("windows"),
                           F.lit(None).cast("double").alias("largest"))
    d = window_statistics(docs, model["network"])
    # the same columns as ``columns``
    n = F.greatest("windows", F.lit(1))
    mean = F.least(F.greatest(F.col("total") / n, F.lit(1e-6)), F.lit(1 - 1e-6))
    w = [F.lit(float(x)) for x in model["document"]]
    x = w[0] * F.col("largest") + w[1] * F.log(mean / (1 - mean)) + w[2] * F.log(n) + w[3]
    score = F.when(F.col("windows") > 0, 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-30.0)), F.lit(30.0)))))
    return d.select("doc_id", F.coalesce(score, F.lit(float(model["constant"]))).alias("score"), "windows",
                    F.when(F.col("windows") > 0, F.col("largest")).alias("largest"))
