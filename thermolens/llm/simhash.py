"""SimHash near-duplicates: pigeonhole blocks, Hamming check, linked components.

Fingerprints.  A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles are
``shingle`` consecutive words joined by a space, repeats included (a shorter text is
one shingle, a text without words has fingerprint zero).  A bit is 1 if it is set in
more than half of the shingles' XXH64 values (UTF-8, seed 42).

Links.  Two fingerprints link when at most ``max_bits`` bits differ.  The 64 bits
are cut into blocks and a close pair must agree on all blocks but ``max_bits`` of them, so
every fingerprint is filed once under each choice of ``blocks - max_bits`` blocks.
Fingerprints filed together are compared exactly:

* a drawer of up to ``drawer_max`` distinct fingerprints is one bounded group;
* a larger drawer is filed again, by the same rule, on the bits it does not fix yet.
  After that 48 bits are fixed, so a drawer has at most 2**16 fingerprints however
  large the input is.  Nothing is dropped.

Inside a drawer only a spanning forest of the links is kept (one edge per newly
reached member), so output is linear in the members while components stay exact.
Copies collapse to one fingerprint before any of this.

Defined cases: null text = empty text; rows without words share fingerprint zero and
link like others; a null ``doc_id`` takes part but is never the smallest id (a group of
only null ids has a null component id); repeated rows are the same document; other
columns, whatever their names, are not touched.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, give_back, texts_of, with_workers

SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of one text (unsigned)."""
    # bytes.lower and bytes.split work on ASCII only: exactly A-Z and \x20 \x09-\x0D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, _CHUNK):
        m = min(n, a + _CHUNK) - a
        part = words[a:a + m + shingle - 1]
        cols = [part[i:] for i in range(shingle)] if n > 1 or len(words) >= shingle else None
        grams = map(b" ".join, zip(*cols, strict=False)) if cols else [b" ".join(words)]
        h = np.fromiter((digest(g, SEED) for g in grams), dtype=np.uint64, count=m)
        ones += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp long): one row per row of ``docs``; the long's 64 bits are the fingerprint."""
    with_workers(docs.sparkSession)

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in texts_of(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
        give_back()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, fp long")


def _cuts(bits: list[int], n: int) -> list[list[int]]:
    """Cut a list of bit numbers into ``n`` blocks of nearly equal width."""
    edge = [round(i * len(bits) / n) for i in range(n + 1)]
    return [bits[edge[i]:edge[i + 1]] for i in range(n)]


def drawer_masks(free: list[int], max_bits: int) -> list[int]:
    """Masks of the bits that each filing fixes: all choices of ``n - max_bits`` out of
    n blocks, n chosen so that about half of the free bits are fixed."""
    n = min(2 * max_bits, len(free)) or 1
    if n <= max_bits:
        return [0]
    blocks = [sum(1 << b for b in blk) for blk in _cuts(free, n)]
    return [sum(c) for c in combinations(blocks, n - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _filed(fps: DataFrame, level_masks: list[int]) -> DataFrame:
    """(fixed, fp) -> one row per mask: the drawer is (bits fixed so far, their values)."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in level_masks])
    d = fps.withColumn("mask", F.explode(masks))
    return d.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (child, parent) of the links among distinct fingerprints."""
    left, child, parent = fps, [], []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                child.append(found)
                parent.append(np.full(len(found), x, dtype=np.uint64))
                frontier.extend(found)
                left = left[~near]
    if not child:
        e = np.empty(0, dtype=np.uint64)
        return e, e
    return np.concatenate(child), np.concatenate(parent)


def _drawer_links(drawers: DataFrame, max_bits: int) -> DataFrame:
    """Links of bounded drawers: rows (drawer, fp) -> (a, b).

    Drawers are dealt by key and sorted, so one pass over a partition meets each
    drawer as one run; a run is at most ``drawer_max`` (or 2**16) longs.
    """
    cols = ["mask", "value"]

    def run(batches):
        rest: list[np.ndarray] | None = None
        for b in batches:
            new = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            cur = new if rest is None else [np.concatenate([r, x]) for r, x in zip(rest, new, strict=True)]
            if not len(cur[0]):
                continue
            edge = np.flatnonzero((cur[0][1:] != cur[0][:-1]) | (cur[1][1:] != cur[1][:-1])) + 1
            last = int(edge[-1]) if len(edge) else 0
            yield from _runs([x[:last] for x in cur], edge[:-1] if len(edge) else edge)
            rest = [x[last:] for x in cur]
        if rest is not None:
            yield from _runs(rest, np.empty(0, dtype=np.int64))

    def _runs(cols3, edges):
        fp = cols3[2].view(np.uint64)
        out_a, out_b = [], []
        for run_fp in np.split(fp, edges):
            a, b = forest(run_fp, max_bits)
            if len(a):
                out_a.append(a)
                out_b.append(b)
        if out_a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (out_a, out_b)], ["a", "b"])

    dealt = drawers.select(*cols, "fp").repartition(*[F.col(c) for c in cols]).sortWithinPartitions(*cols)
    return dealt.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, max_bits: int = 3, drawer_max: int = 4096) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints ``fp``; components of these
    links equal the components of all pairs at most ``max_bits`` apart."""
    if max_bits >= 16:
        raise ValueError("pigeonhole blocks need max_bits < 16")
    if max_bits == 0:
        return fps.sparkSession.createDataFrame([], "a long, b long")
    every = list(range(64))
    filed = _filed(fps, drawer_masks(every, max_bits))
    size = filed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = checkpointed(filed.join(size, ["mask", "value"]))
    out = _drawer_links(shared.where(F.col("n") <= drawer_max), max_bits)
    # Large drawers are filed again on the bits their mask leaves free.  Which masks
    # have large drawers is known only now; there are at most C(2k, k) masks.
    large = shared.where(F.col("n") > drawer_max)
    for row in large.select("mask").distinct().collect():
        mask = row["mask"] & ((1 << 64) - 1)
        free = [b for b in every if not mask >> b & 1]
        finer = [mask | m for m in drawer_masks(free, max_bits)]
        again = _filed(large.where(F.col("mask") == F.lit(row["mask"])).select("fp"), finer)
        own = Window.partitionBy("mask", "value")
        again = again.withColumn("n", F.count(F.lit(1)).over(own)).where("n > 1")
        out = out.unionByName(_drawer_links(again, max_bits))
    return out


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint of each linked fingerprint's component.

    Alternating large-star and small-star steps; every step is a map-side minimum per
    node and a join, and the edge count never grows.  Each round is checkpointed.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        side = both if large else both.where("v < u")
        low = side.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = side.join(low, "u")
        if large:
            moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    def summary(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = checkpointed(e)
    seen = summary(e)
    while True:
        e = checkpointed(star(star(e, True), False))
        now = summary(e)
        if now == seen:
            break
        seen = now
    stars = e.groupBy("a").agg(F.min("b").alias("root"))
    roots = e.select(F.col("b").alias("fp")).distinct().withColumn("root", F.col("fp"))
    return stars.select(F.col("a").alias("fp"), "root").unionByName(roots)


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, drawer_max: int = 4096) -> DataFrame:
    """(doc_id, fp long, component_id): every row of ``docs`` with its fingerprint and
    the smallest ``doc_id`` reachable over links."""
    fps = checkpointed(fingerprints(docs, shingle))
    distinct = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    comp = components(links(distinct.select("fp"), max_bits, drawer_max))
    rooted = distinct.join(comp, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = rooted.join(ids, "root").select("fp", "component_id")
    return fps.join(label, "fp").select("doc_id", "fp", "component_id")


def keep_representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One document of each component: the one with the smallest id.

    Rows that repeat an id are one document, of which one row stays; rows without an
    id stay only where no member of their component has one (then one row stays).
    """
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")
    found = near_duplicates(d, shingle, max_bits)
    named = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = d.join(named, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("_row.*")
    lost = d.where("doc_id is null")
    if lost.select("doc_id").isEmpty():
        return kept
    nameless = checkpointed(found.where("component_id is null").select("fp").distinct())
    comp = components(links(nameless, max_bits))
    stay = _tagged(lost, shingle).join(nameless, F.col("_fp") == F.col("fp"), "left_semi")
    stay = stay.join(comp, F.col("_fp") == F.col("fp"), "left").withColumn("_root", F.coalesce("root", "_fp"))
    return kept.unionByName(stay.dropDuplicates(["_root"]).select("_row.*"))


def _tagged(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs`` with a column ``_fp``."""
    with_workers(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(t: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, shingle) for x in t], dtype=np.uint64).view(np.int64))

    return docs.withColumn("_fp", fp(F.col("text")))
