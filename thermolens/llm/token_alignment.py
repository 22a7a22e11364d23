"""Cross-tokenizer alignment: token links of two tokenizers, counted by inverted pair bitmaps.

Alignment.  Tokenizer A (byte-level BPE) encodes a space and the text; tokenizer B (BPE with
byte fallback) encodes the text and puts the space before it itself.  Both token sequences are laid over
the bytes of space+text.  Where a token of A and one of B end together, they are
linked, and the text is cut into groups.

Units.  Neither tokenizer has a token that goes from a non-space into a space, so a text is cut
before every single space between two other characters.  Each unit is encoded once per worker and
cached; a text whose units do not all spell their own bytes is encoded whole.  Units of
characters whose class does not depend on the version of Unicode are encoded by another encoder of A's vocabulary, which is faster.

Inverted pair bitmaps.  A task numbers its documents in chunks of at most 2**16.  For every (A id, B id) pair
it keeps the set of the chunk's documents that hold the pair as a compressed bitmap: two bytes per document, or one bit
per document of the chunk where that is smaller.  Plane 0 is that set; planes 1, 2, 3, ...
are the documents in which bit 0, 1, 2, ... of (links of the pair - 1) is set.  Batches of a chunk
are OR-ed into one bitmap; chunks have different documents, so the OR over chunks is their
concatenation and popcounts add up: those of plane 0 to the number of documents, those of
plane p, times 2**(p-1), to the remaining links.

Scores.  The bitmaps are the pairs' postings: joined with the pairs' counts and
dealt back by chunk, every posting adds its pair's count to its documents.  What meets in a task is one row per pair
and plane of a chunk, whatever the share of documents that hold the pair.

Defined cases: a text that is null, empty, or not spelled byte for byte by both tokenizers has no tokens; repeated rows
and null ids are rows of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, texts_of, with_workers
from .packing import _byte_letters, tokenizer_path

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
CHUNK_DOCS = 1 << 16
# Postings (14 bytes each) of a chunk that a task holds before it writes them.
CHUNK_POSTINGS = 4_000_000
# Units, and characters of units, after which a worker's cache is emptied.
_CACHE_UNITS = 250_000
_CACHE_CHARS = 8_000_000
# Characters of the texts that are aligned together.
_GROUP_CHARS = 500_000
# A single space between a non-space (or nothing) and a character that no tokenizer calls white space.
_CUT = re.compile(r"(?<! ) (?=\S)")
_B_BITS = 32
# Fixed value: how tokenizer A cuts a text before it merges.
_A_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters that every version of Unicode puts in the same class.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7E\u00A1-\u024F]*")


class Aligner(dict):
    """Unit (a text without its leading space) -> (groups, links, counts) as bytes; a bounded cache.

    New units are encoded and aligned together, laid end to end like one text.
    """

    def __init__(self, a_path: str, b_path: str):
        super().__init__()
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {c: b for b, c in _byte_letters().items()}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        vocabulary = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(byte_of[c] for c in t) if t not in special else t.encode()
                        for t in (vocabulary.get(i, "") for i in range(max(vocabulary) + 1))]
        self.b_bytes = [self._b_piece(i) for i in range(self.b.get_piece_size())]
        # the same vocabulary in a faster encoder; ids are merge ranks
        self.plain = tiktoken.Encoding("a", pat_str=_A_PATTERN, special_tokens={}, mergeable_ranks={
            self.a_bytes[i]: i for i, t in vocabulary.items() if t not in special})
        self.sizes = [np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes)]
        # an id as text with what follows it: inside a group, at the end of its half
        self.shown = [[np.array([f"{i}{end}" for i in range(len(v))], object) for end in (",", last)]
                      for v, last in ((self.a_bytes, "|"), (self.b_bytes, ";"))]
        self.chars = 0

    def _b_piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def a_ids(self, text: str) -> list[int]:
        """A's ids of ``text``."""
        return self.plain.encode_ordinary(text) if _PLAIN.fullmatch(text) else \
            self.a.encode(text, add_special_tokens=False).ids

    def aligned(self, units: list[str]) -> list[tuple[bytes, bytes, bytes] | None]:
        """(groups as text, links as long pairs, (A tokens, B tokens) as two longs) per unit; None where the tokens'
        bytes are not the unit's."""
        a, b = [self.a_ids(f" {u}") for u in units], self.b.encode(units, num_threads=1)
        want = [f" {u}".encode() for u in units]
        spelled = [b"".join([self.a_bytes[i] for i in x]) == w and b"".join([self.b_bytes[i] for i in y]) == w
                   for x, y, w in zip(a, b, want, strict=True)]
        if not all(spelled):
            found = iter(self.aligned([u for u, ok in zip(units, spelled, strict=True) if ok]))
            return [next(found) if ok else None for ok in spelled]
        if not units:
            return []
        ids, ends, n = [], [], []
        for x, size in zip((a, b), self.sizes, strict=True):
            n.append(np.fromiter(map(len, x), np.int64, len(x)))
            ids.append(np.fromiter((i for v in x for i in v), np.int64, int(n[-1].sum())))
            ends.append(np.cumsum(size[ids[-1]]))
        at = np.searchsorted(ends[1], ends[0])  # B reaches as far as A: every unit is spelled
        cut_a = ends[1][at] == ends[0]
        cut_b = np.zeros(len(ids[1]), bool)
        cut_b[at[cut_a]] = True
        links = (ids[0][cut_a] << _B_BITS | ids[1][cut_b]).astype("<i8")
        # tokens in the order they are shown: group by group, A's before B's
        group = [np.cumsum(c) - c for c in (cut_a, cut_b)]
        count = [np.bincount(g, minlength=len(links)) for g in group]
        text = np.empty(len(ids[0]) + len(ids[1]), object)
        before = [np.r_[0, np.cumsum(c)[:-1]] for c in count]
        text[np.arange(len(ids[0])) + before[1][group[0]]] = np.where(cut_a, self.shown[0][1][ids[0]], self.shown[0][0][ids[0]])
        text[np.arange(len(ids[1])) + (before[0] + count[0])[group[1]]] = \
            np.where(cut_b, self.shown[1][1][ids[1]], self.shown[1][0][ids[1]])
        text = text.tolist()
        tokens = np.cumsum(n[0] + n[1]).tolist()
        linked = (8 * np.cumsum(cut_a)[np.cumsum(n[0]) - 1]).tolist()
        packed, counts = links.tobytes(), np.stack(n, axis=1).astype("<i8").tobytes()
        out, t, k = [], 0, 0
        for i, (t1, k1) in enumerate(zip(tokens, linked, strict=True)):
            out.append(("".join(text[t:t1])[:-1].encode(), packed[k:k1], counts[16 * i:16 * i + 16]))
            t, k = t1, k1
        return out

    def learn(self, units: set[str]) -> None:
        """Make sure that all of ``units`` are in the cache."""
        if len(self) > _CACHE_UNITS or self.chars > _CACHE_CHARS:
            self.clear()
            self.chars = 0
        new = list(units - self.keys())
        self.update(zip(new, self.aligned(new), strict=True))
        self.chars += sum(map(len, new))

    def of_texts(self, texts: list[str | None]) -> list[tuple[bytes, np.ndarray, int, int]]:
        """(groups, link pairs, A tokens, B tokens) of whole texts."""
        cut = [units_of(t) for t in texts]
        self.learn({u for units in cut for u in units})
        out = []
        for text, units in zip(texts, cut, strict=True):
            found = [self[u] for u in units]
            if None in found:
                found = self.aligned([text])
            if not found or found[0] is None:
                out.append((b"", np.empty(0, np.int64), 0, 0))
                continue
            counts = np.frombuffer(b"".join([x[2] for x in found]), "<i8")
            out.append((b";".join([x[0] for x in found]), np.frombuffer(b"".join([x[1] for x in found]), "<i8"),
                        int(counts[0::2].sum()), int(counts[1::2].sum())))
        return out


def units_of(text: str | None) -> list[str]:
    """A text's units, each without its leading space."""
    if not text:
        return []
    units = _CUT.split(f" {text}")
    return units[1:] if not units[0] else [units[0][1:], *units[1:]]


def _grouped(texts):
    """Lists of texts of about ``_GROUP_CHARS`` characters (a longer text is a list of its own)."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or "")
        if size >= _GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


_SHARED: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str | None = None, b_path: str | None = None) -> Aligner:
    """This worker process's tokenizers, loaded once, with their cache."""
    key = (a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE))
    if key not in _SHARED:
        _SHARED[key] = Aligner(*key)
    return _SHARED[key]


# ---- bitmaps of one chunk

class Chunk:
    """Postings of a chunk's documents, turned into bitmaps."""

    def __init__(self):
        self.docs = self.size = 0
        self.pairs, self.at, self.more = [], [], []

    def add(self, links: np.ndarray) -> int:
        """The document's number in the chunk."""
        pairs, n = np.unique(links, return_counts=True)
        self.pairs.append(pairs)
        self.at.append(np.full(len(pairs), self.docs, dtype=np.uint16))
        self.more.append((n - 1).astype(np.int32))
        self.size += len(pairs)
        self.docs += 1
        return self.docs - 1

    def bitmaps(self):
        """Arrow arrays (pair, plane, dense, bits) of every plane that has a document."""
        if not self.size:
            return
        pairs, at, more = (np.concatenate(x) for x in (self.pairs, self.at, self.more))
        order = np.argsort(pairs, kind="stable")  # documents of a pair stay in order
        pairs, at, more = pairs[order], at[order], more[order]
        for plane in range(int(more.max()).bit_length() + 1):
            if plane:
                on = more >> (plane - 1) & 1 == 1
                if on.any():
                    yield from _plane(pairs[on], at[on], plane, self.docs)
            else:
                yield from _plane(pairs, at, plane, self.docs)


def _plane(pairs: np.ndarray, at: np.ndarray, plane: int, docs: int):
    start = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    n = np.diff(np.r_[start, len(pairs)])
    width = -(-docs // 8)
    dense = 2 * n > width

    def batch(own: np.ndarray, bits: pa.Array, is_dense: bool):
        return [pa.array(pairs[start[own]]), pa.array(np.full(len(own), plane, np.int32)),
                pa.array(np.full(len(own), is_dense)), bits]

    few = np.flatnonzero(~dense)
    if len(few):
        values = at[np.repeat(~dense, n)].astype("<u2")
        offsets = np.r_[0, np.cumsum(2 * n[few])].astype(np.int32)
        yield batch(few, pa.Array.from_buffers(pa.binary(), len(few), [None, pa.py_buffer(offsets), pa.py_buffer(values)]),
                    False)
    many = np.flatnonzero(dense)
    for lo in range(0, len(many), 1024):
        own, bits = many[lo:lo + 1024], []
        for i in own:
            row = np.zeros(8 * width, np.uint8)
            row[at[start[i]:start[i] + n[i]]] = 1
            bits.append(np.packbits(row, bitorder="little").tobytes())
        yield batch(own, pa.array(bits, pa.binary()), True)


def popcount(dense: Column, bits: Column) -> Column:
    """Documents in a bitmap."""
    return F.when(dense, F.bitmap_count(bits)).otherwise(F.octet_length(bits) / 2).cast("long")


def plane_weight(plane: Column) -> Column:
    """Links that a document in a plane stands for."""
    return F.pow(F.lit(2.0), F.greatest(plane - 1, F.lit(0))).cast("long")


# ---- Spark

def indexed(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, postings) as stored tables in ``spark.checkpoint.dir``, from one pass over ``docs``.

    documents: chunk, at, doc_id, n_a, n_b, n_groups, n_links, groups_sha256; postings: chunk,
    pair (A id << 32 | B id), plane, dense, bits.
    """
    spark = docs.sparkSession
    with_workers(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    own = f"at int, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    schema = f"kind int, chunk long, {own}, pair long, plane int, dense boolean, bits binary"
    names = [x.strip().split(" ")[0] for x in schema.split(", ")]

    def run(batches):
        align, task, chunks, chunk = aligner(a_path, b_path), TaskContext.get().partitionId(), 0, Chunk()
        arrow_id = None

        def table(n, given):
            given = {"kind": pa.array(np.full(n, int("pair" in given), np.int32)),
                     "chunk": pa.array(np.full(n, task << 32 | chunks, np.int64))} | given
            kinds = {"at": pa.int32(), "doc_id": arrow_id, "groups_sha256": pa.string(), "plane": pa.int32(),
                     "dense": pa.bool_(), "bits": pa.binary()}
            return pa.RecordBatch.from_arrays(
                [given[c] if c in given else pa.nulls(n, kinds.get(c, pa.int64())) for c in names], names)

        def closed():
            for pair, plane, dense, bits in chunk.bitmaps():
                yield table(len(pair), {"pair": pair, "plane": plane, "dense": dense, "bits": bits})

        try:
            for b in batches:
                arrow_id = b.column(0).type
                rows, first = [], 0
                found = (x for g in _grouped(texts_of(b.column(1))) for x in align.of_texts(g))
                for k, (groups, links, n_a, n_b) in enumerate(found):
                    sha = hashlib.sha256(groups).hexdigest() if n_a else ""
                    rows.append((chunk.add(links), n_a, n_b, len(links), sha))
                    if chunk.docs >= CHUNK_DOCS or chunk.size >= CHUNK_POSTINGS:
                        yield _doc_rows(table, b.column(0).slice(first, len(rows)), rows)
                        yield from closed()
                        rows, first, chunk, chunks = [], k + 1, Chunk(), chunks + 1
                if rows:
                    yield _doc_rows(table, b.column(0).slice(first, len(rows)), rows)
            if chunk.docs:
                yield from closed()
        finally:
            align.clear()  # a worker outlives its task

    at = f"{ensure_checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    docs.select("doc_id", "text").mapInArrow(run, schema).write.partitionBy("kind").parquet(at)
    stored = spark.read.schema(schema).parquet(at)
    return (stored.where("kind = 0").select("chunk", *[x.split(" ")[0] for x in own.split(", ")]),
            stored.where("kind = 1").select("chunk", "pair", "plane", "dense", "bits"))


def _doc_rows(table, ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    at, n_a, n_b, n_links, sha = zip(*rows, strict=True)
    # one A and one B token end at every cut: as many links as groups
    return table(len(rows), {"at": pa.array(at, pa.int32()), "doc_id": ids, "n_a": pa.array(n_a, pa.int64()),
                             "n_b": pa.array(n_b, pa.int64()), "n_groups": pa.array(n_links, pa.int64()),
                             "n_links": pa.array(n_links, pa.int64()), "groups_sha256": pa.array(sha, pa.string())})


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, a, b, docs, links, best): documents and links that hold a pair, and whether no pair with its B id
    has more links."""
    n = popcount(F.col("dense"), F.col("bits"))
    counts = postings.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, n)).alias("docs"), F.sum(n * plane_weight(F.col("plane"))).alias("links"))
    counts = counts.select("pair", F.shiftright("pair", _B_BITS).alias("a"),
                           F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1)).alias("b"), "docs", "links")
    return counts.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def returned(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, at, n_best, count_sum, docs_sum): every posting adds its pair's counts to its documents."""
    d = postings.join(counts.select("pair", "docs", "links", "best"), "pair")
    d = d.select("chunk", "dense", "bits", plane_weight(F.col("plane")).alias("times"), "links", "docs", "best")

    def run(batches):
        now, sums = None, np.zeros((4, CHUNK_DOCS), np.int64)

        def done():
            at = np.flatnonzero(sums[3])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), now, np.int64)), pa.array(at.astype(np.int32)),
                 *[pa.array(x[at]) for x in sums[:3]]], ["chunk", "at", "n_best", "count_sum", "docs_sum"])

        for b in batches:
            chunk = b.column(0).to_numpy()
            edge = np.r_[0, np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, len(chunk)]
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if hi == lo:
                    continue
                if now is not None and chunk[lo] != now:
                    yield done()
                    sums[:] = 0
                now = int(chunk[lo])
                _post(sums, b.slice(lo, hi - lo))
        if now is not None:
            yield done()

    dealt = d.repartition(F.col("chunk")).sortWithinPartitions("chunk")
    return dealt.mapInArrow(run, "chunk long, at int, n_best long, count_sum long, docs_sum long")


def _post(sums: np.ndarray, b: pa.RecordBatch) -> None:
    """Add the rows (chunk, dense, bits, times, links, docs, best) of one chunk to (best, links, docs, any) per document."""
    dense, times = b.column(1).to_numpy(zero_copy_only=False), b.column(3).to_numpy()
    add = np.stack([times * b.column(6).to_numpy(zero_copy_only=False), times * b.column(4).to_numpy(),
                    times * b.column(5).to_numpy(), times])
    few, many = np.flatnonzero(~dense), np.flatnonzero(dense)
    bits = b.column(2).take(pa.array(few))
    if len(few):
        n = pc.binary_length(bits).to_numpy(zero_copy_only=False).astype(np.int64) // 2
        _, offsets, data = bits.buffers()
        first = np.frombuffer(offsets, np.int32)[bits.offset]
        at = np.frombuffer(data, "<u2", count=int(n.sum()), offset=int(first)).astype(np.int64)
        for k in range(4):
            np.add.at(sums[k], at, np.repeat(add[k, few], n))
    for i in many:
        at = np.flatnonzero(np.unpackbits(np.frombuffer(b.column(2)[int(i)].as_buffer(), np.uint8), bitorder="little"))
        sums[:, at] += add[:, i][:, None]


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, docs_sum, groups_sha256) of every row of ``docs``.

    count_sum and docs_sum: over the document's links, how many links, and documents, of the table hold their pair.
    """
    own, postings = indexed(docs, a_path, b_path)
    sums = returned(postings, pair_counts(postings))
    out = own.join(sums, ["chunk", "at"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum", "docs_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
