"""Hard-negative mining by slot-decomposed selection.

A row's score with an anchor is the inner product of their whole-number vectors
(``floor(scale * x)`` of each component).  An anchor's positives are its ``positives``
best other rows of the same label.  A positive with score s allows the negatives (rows of
another label) with ``floor_pct * s <= 100 * score <= 100 * s``; of those the best
``negatives`` are wanted.  The windows of one anchor overlap.

Slots.  The distinct scores of an anchor's positives, highest first, u1 > u2 > ..., cut the
scores into disjoint slots (u2, u1], (u3, u2], ..., (-inf, um].  A negative falls into
one slot.  Every block of rows keeps the best ``negatives`` per anchor and slot, the same
selection over the blocks' survivors gives the best of the table, and a window's answer is read off the merge of its
own slot and all lower ones: the merged list in descending order, from the window's upper limit
down to its lower one.  Each negative is looked at once, however many windows hold it.

Blocks.  Anchors are a stated query set.  Rows and anchors are dealt by hash into blocks of
bounded size; each pair of blocks is one group of two bounded tables, scored by matrix products.
No label, score or vector decides where a row goes, so none can fill a task.

Exactness.  Products are exact: in doubles while every sum stays below 2**53, in 64-bit
integers beyond.  A component beyond ``limit(dimensions)`` (about 2**28 for 64 dimensions) counts as
that limit, so that a score always fits in a long.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no
part; shorter vectors count as padded with zeros; ties go to the smaller id; rows that repeat an
id are rows of their own as positives and negatives, but never those of an anchor with that id, and of such
anchors only the one with the smallest (label, vector) is asked; an anchor without positives, or a positive without
negatives, gives no row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, with_workers

POSITIVES = 5
NEGATIVES = 5
FLOOR_PCT = 80
SCALE = 256.0
# Rows and anchors that one group brings together, at most (besides hash variation).
ROW_BLOCK = 32_768
ANCHOR_BLOCK = 8_192
# Rows and anchors of one matrix product.
_TILE_ROWS = 2_048
_TILE_ANCHORS = 256
_EXACT = 1 << 53


def usable(rows: DataFrame) -> DataFrame:
    """(id, label, vec) of the rows that take part; from columns vec_id, label and embedding."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    d = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    return d.where(~odd).select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))


def limit(dims: int) -> int:
    """The largest component whose squares, ``dims`` times, stay within a long."""
    return int(np.floor(np.sqrt((2.0 ** 63 - 1025) / max(dims, 1))))


def whole(column: pa.ChunkedArray | pa.Array, dims: int, scale: float = SCALE) -> np.ndarray:
    """floor(scale * x) of a column of vectors as an int64 matrix, shorter vectors padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), dims))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(column)), size), at] = flat
    most = limit(dims)
    return np.clip(np.floor(out * scale), -most, most).astype(np.int64)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two int64 matrices."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Best:
    """The best ``k`` (score, id) per cell, a running selection; cells are 0 .. n-1."""

    def __init__(self, cells: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.score = np.full((cells, k), np.iinfo(np.int64).min)
        self.id = np.full((cells, k), np.iinfo(np.int64).max)
        self.n = np.zeros(cells, dtype=np.int64)
        self.floor = np.full(cells, np.iinfo(np.int64).min) if floor is None else floor

    def wanted(self, cell: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether (score, id) can still enter its cell."""
        full = self.n[cell] == self.k
        last, last_id = self.score[cell, -1], self.id[cell, -1]
        return (score >= self.floor[cell]) & (~full | (score > last) | ((score == last) & (ids < last_id)))

    def add(self, cell: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(cell):
            return
        cells = np.unique(cell)
        kept = np.arange(self.k) < self.n[cells][:, None]
        cell = np.concatenate([np.repeat(cells, self.n[cells]), cell])
        score = np.concatenate([self.score[cells][kept], score])
        ids = np.concatenate([self.id[cells][kept], ids])
        order = np.lexsort((ids, ~score, cell))  # ~score: descending, without overflow
        cell, score, ids = cell[order], score[order], ids[order]
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        rank = np.arange(len(cell)) - np.repeat(start, np.diff(np.r_[start, len(cell)]))
        top = rank < self.k
        self.score[cell[top], rank[top]] = score[top]
        self.id[cell[top], rank[top]] = ids[top]
        self.n[cells] = np.minimum(np.diff(np.r_[start, len(cell)]), self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(self.k) < self.n[:, None]
        return np.repeat(np.arange(len(self.n)), self.n), self.score[at], self.id[at]


def _tiles(anchors: pa.Table, rows: pa.Table, scale: float):
    """(anchor slice, row ids, row labels, scores) tile by tile; rows go in id order."""
    dims = max((int(np.max(c.value_lengths().to_numpy(zero_copy_only=False), initial=0))
                for t in (anchors, rows) for c in t["vec"].chunks), default=0)
    a = whole(anchors["vec"], dims, scale)
    ids = rows["id"].to_numpy().astype(np.int64)
    order = np.argsort(ids, kind="stable")
    label = rows["label"].to_numpy()
    for lo in range(0, len(order), _TILE_ROWS):
        part = order[lo:lo + _TILE_ROWS]
        b = whole(rows["vec"].take(pa.array(part)), dims, scale)
        for x in range(0, len(a), _TILE_ANCHORS):
            yield slice(x, min(x + _TILE_ANCHORS, len(a))), ids[part], label[part], scores(a[x:x + _TILE_ANCHORS], b)


def block_positives(anchors: pa.Table, rows: pa.Table, k: int, scale: float = SCALE) -> pa.Table:
    """(anchor, id, score) of the best ``k`` same-label rows of every anchor in one block of rows."""
    own, own_label = anchors["id"].to_numpy().astype(np.int64), anchors["label"].to_numpy()
    best = Best(len(own), k)
    for at, ids, label, s in _tiles(anchors, rows, scale):
        fits = (own_label[at][:, None] == label) & (own[at][:, None] != ids)
        i, j = np.nonzero(fits)
        cell, score, rid = i + at.start, s[i, j], ids[j]
        ok = best.wanted(cell, score, rid)
        best.add(cell[ok], score[ok], rid[ok])
    c, score, rid = best.rows()
    return pa.table({"anchor": pa.array(own[c]), "id": pa.array(rid), "score": pa.array(score)})


def _lower(upper: np.ndarray, floor_pct: int) -> np.ndarray:
    """The least whole score with floor_pct * upper <= 100 * score."""
    hundreds, rest = np.divmod(upper, 100)  # in two parts: floor_pct * upper may not fit in 64 bits
    return hundreds * floor_pct - (-(rest * floor_pct) // 100)


def block_negatives(anchors: pa.Table, rows: pa.Table, k: int, floor_pct: int = FLOOR_PCT,
                    scale: float = SCALE) -> pa.Table:
    """(anchor, id, score) of the best ``k`` other-label rows of every anchor and slot in one
    block of rows; ``anchors`` has a column ``limits``: the slots' upper limits, highest first."""
    own, own_label = anchors["id"].to_numpy().astype(np.int64), anchors["label"].to_numpy()
    limits = anchors["limits"].combine_chunks()
    size = limits.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    m = int(size.max(initial=1))
    upper = np.full((len(own), m), np.iinfo(np.int64).min)
    upper[np.arange(m) < size[:, None]] = limits.flatten().to_numpy(zero_copy_only=False)
    # a slot serves its own window and those above it; its own reaches lowest
    best = Best(len(own) * m, k, _lower(upper, floor_pct).ravel())
    real = np.arange(m) < size[:, None]
    for at, ids, label, s in _tiles(anchors, rows, scale):
        slot = np.full(s.shape, -1)
        for j in range(m):
            slot += (s <= upper[at][:, j][:, None]) & real[at][:, j][:, None]
        fits = (slot >= 0) & (own_label[at][:, None] != label) & (own[at][:, None] != ids)
        i, j = np.nonzero(fits)
        cell, score, rid = (i + at.start) * m + slot[i, j], s[i, j], ids[j]
        ok = best.wanted(cell, score, rid)
        best.add(cell[ok], score[ok], rid[ok])
    c, score, rid = best.rows()
    return pa.table({"anchor": pa.array(own[c // m]), "slot": pa.array(c % m, pa.int32()),
                     "id": pa.array(rid), "score": pa.array(score)})


def _by_blocks(rows: DataFrame, anchors: DataFrame, run, schema: str, blocks: tuple[int, int]) -> DataFrame:
    """``run(anchors, rows)`` for every pair of a block of rows and a block of anchors."""
    r, a = blocks
    each_r, each_a = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (r, a))
    d = rows.withColumn("rb", F.pmod(F.xxhash64("id", "label"), F.lit(r)).cast("int")).withColumn("ab", each_a)
    q = anchors.withColumn("ab", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(a)).cast("int")).withColumn("rb", each_r)

    def both(own: pa.Table, asked: pa.Table) -> pa.Table:
        return run(asked, own)

    return d.groupBy("rb", "ab").cogroup(q.groupBy("rb", "ab")).applyInArrow(both, schema)


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` rows per key; Spark limits each task's rows of a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mined(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
          floor_pct: int = FLOOR_PCT, scale: float = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    rows: vec_id (whole number), label, embedding; ``is_anchor``: a condition on vec_id.
    """
    with_workers(rows.sparkSession)
    d = checkpointed(usable(rows))
    asked = d.withColumnRenamed("id", "vec_id").where(is_anchor).groupBy("vec_id").agg(
        F.min(F.struct("label", "vec")).alias("a")).select(F.col("vec_id").alias("id"), "a.label", "a.vec")
    asked = checkpointed(asked)
    n = d.count()
    # enough blocks to spread a small table, never more than ROW_BLOCK rows in one
    blocks = (max(1, -(-n // min(ROW_BLOCK, max(1_024, n // 64)))), max(1, -(-asked.count() // ANCHOR_BLOCK)))

    near = _by_blocks(d, asked, lambda q, own: block_positives(q, own, positives, scale),
                      "anchor long, id long, score long", blocks)
    near = checkpointed(_first(near, ["anchor"], positives).select("anchor", "id", "score"))
    # at most ``positives`` limits each
    limits = near.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    slotted = checkpointed(asked.join(limits, F.col("id") == F.col("anchor")).drop("anchor"))
    far = _by_blocks(d, slotted, lambda q, own: block_negatives(q, own, negatives, floor_pct, scale),
                     "anchor long, slot int, id long, score long", blocks)
    far = _first(far, ["anchor", "slot"], negatives)
    # at most positives * negatives entries each, in descending order
    merged = far.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "id"))).alias("all"))
    # 100 * score may not fit in a long
    wide = lambda c, times: c.cast("decimal(38,0)") * F.lit(times)
    low = wide(F.col("score"), floor_pct)
    window = F.slice(F.filter("all", lambda x: (-x["down"] <= F.col("score")) & (wide(-x["down"], 100) >= low)),
                     1, negatives)
    out = near.join(merged, "anchor").select(
        F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.posexplode(window).alias("pos", "x"))
    return out.select("anchor_id", "positive_id", (F.col("pos") + 1).alias("rank"), F.col("x.id").alias("negative_id"),
                      "positive_score", (-F.col("x.down")).alias("negative_score"))
