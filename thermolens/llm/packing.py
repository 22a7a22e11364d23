"""Best-fit packing of documents into fixed-length sequences, by exact complements.

A document is its token ids plus one end id; one longer than ``length`` is cut into
full pieces and a last one.  Pieces are packed by their length alone, so the plan is
made from the histogram of lengths (at most ``length`` numbers, whatever the input's
size):

1. full pieces fill a sequence each;
2. for every length, longest first, the gap it leaves is looked up among the single,
   pair and triple sums of the lengths still available; a combination that fills the gap
   exactly is consumed as often as its counts allow;
3. what remains is placed by best fit, longest first: into the open sequences with the
   smallest gap that holds it, as many at a time as there are;
4. the plan is made with complements of up to three, two, one and no lengths, and the one with
   the fewest sequences is kept.

The plan is a list of *layouts* (the lengths in one sequence) with counts.  Pieces get
a gapless rank within their length (counted in chunks, so a length may hold any
share of the pieces), and rank and length give layout, sequence and offset by a
binary search in the plan's intervals.  Each step uses up a length's count or a group of open
sequences, so the number of layouts depends on ``length`` only.

Defined cases: null text = empty text = one piece of one end id; null or equal ids are
packed like others (equal pieces are interchangeable); an empty table gives an empty result;
other columns, whatever their names, are not touched.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, gapless_positions, give_back, texts_of, with_workers

LENGTH = 2048
END_ID = 0
_CACHE_WORDS = 120_000
_CACHE_PARTS = 250_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# A word of precomposed Latin letters, then marks without an apostrophe: exactly two
# pre-tokens, whose ids the BPE model gives directly (the normalizer only lower-cases them).
_PLAIN_WORD = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017E]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds(dict):
    """Word -> its ids as little-endian 32-bit bytes; a bounded cache over the tokenizer.

    The tokenizer's pre-tokens never cross white space, so a text's ids are its
    words' ids in order.  Words that are not plain go through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}

    def of_text(self, text: str) -> bytes:
        # cut at any of the white space that the tokenizer drops; other kinds stay inside a word
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, words))

    def forget(self) -> None:
        self.clear()
        self.parts.clear()

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            ids = self._part(word.lower())
        elif m := _PLAIN_WORD.fullmatch(word):
            ids = self._part(m[1].lower()) + (self._part(m[2]) if m[2] else b"")
        else:
            ids = _packed_ids(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            ids = _packed_ids([t.id for t in self.model.tokenize(shown)])
            if len(self.parts) >= _CACHE_PARTS:
                self.parts.clear()
            self.parts[part] = ids
        return ids


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_SHARED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This worker process's tokenizer, loaded once, with its cache."""
    if path not in _SHARED:
        _SHARED[path] = WordIds(path)
    return _SHARED[path]


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every document."""
    with_workers(docs.sparkSession)
    where = path
    end = np.uint32(END_ID).astype("<u4").tobytes()

    def run(batches):
        ids = word_ids(where or tokenizer_path())
        try:
            for b in batches:
                row, piece, start, size, crc = [], [], [], [], []
                for i, text in enumerate(texts_of(b.column(1))):
                    own = ids.of_text(text or "") + end
                    n = len(own) // 4
                    for p, a in enumerate(range(0, n, length)):
                        m = min(length, n - a)
                        row.append(i)
                        piece.append(p)
                        start.append(a)
                        size.append(m)
                        crc.append(zlib.crc32(own[4 * a:4 * (a + m)]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            # a worker outlives its task; the next one may need the memory for something else
            ids.forget()
            give_back()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """[(layout, sequences)]: how often each layout is used; uses up ``counts`` exactly.

    Pairs and triples that fill a gap exactly spend small lengths, which are then missing for the gaps of
    others; where small lengths are scarce that costs more sequences than it saves.  So the histogram is packed with
    complements of up to three, two, one and no lengths, and the plan with the fewest sequences is kept
    (the deepest of equals): never more than best fit alone needs.
    """
    plans = [_plan_with(counts, length, depth) for depth in (3, 2, 1, 0)]
    return min(plans, key=lambda p: sum(times for _, times in p))


def _plan_with(counts: dict[int, int], length: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """The plan that fills gaps with exact complements of up to ``depth`` lengths, then packs the rest by best fit."""
    left = {n: c for n, c in counts.items() if c > 0}
    out: list[tuple[tuple[int, ...], int]] = []
    if left.get(length):
        out.append(((length,), left.pop(length)))

    def use(layout: tuple[int, ...]) -> bool:
        need: dict[int, int] = {}
        for n in layout:
            need[n] = need.get(n, 0) + 1
        times = min(left.get(n, 0) // k for n, k in need.items())
        if not times:
            return False
        for n, k in need.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        out.append((layout, times))
        return True

    if depth:
        for n in sorted(left, reverse=True):
            _fill(n, length, left, use, depth)
    out += _best_fit(left, length)
    return out


def _fill(n: int, length: int, left: dict[int, int], use, depth: int = 3) -> None:
    """Consume exact complements of ``n``: one length, then two, then three."""
    gap = length - n
    if n in left:
        use((n, gap))
    live = sorted(x for x in left if x < gap)
    for b in reversed(live if depth > 1 else []):
        if n not in left:
            return
        if b in left and gap - b in left and b >= gap - b:
            use((n, b, gap - b))
    for b in reversed(live if depth > 2 else []):
        if n not in left:
            return
        rest = gap - b
        # b >= c >= d: c runs over the upper half of the rest
        lo, hi = bisect_left(live, -(-rest // 2)), bisect_right(live, min(b, rest - 1))
        for c in live[lo:hi][::-1]:
            if n not in left or b not in left:
                break
            if c in left and rest - c in left:
                use((n, b, c, rest - c))


def _best_fit(left: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing on counts: open sequences are grouped by gap and layout."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    gaps: list[int] = []

    def put(gap: int, layout: tuple[int, ...], times: int) -> None:
        if gap not in open_:
            open_[gap] = {}
            gaps.insert(bisect_left(gaps, gap), gap)
        open_[gap][layout] = open_[gap].get(layout, 0) + times

    done: list[tuple[tuple[int, ...], int]] = []
    for n in sorted(left, reverse=True):
        todo = left[n]
        while todo:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                # no open sequence holds it: open new ones, as full of n as they get
                each = min(length // n, todo)
                times = todo // each
                put(length - n * each, (n,) * each, times)
                todo -= times * each
                continue
            gap = gaps[at]
            layout, times = open_[gap].popitem()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(at)
            each = min(gap // n, todo)
            m = min(times, todo // each)
            if m < times:
                put(gap, layout, times - m)
            new = gap - n * each
            if new:
                put(new, layout + (n,) * each, m)
            else:
                done.append((layout + (n,) * each, m))
            todo -= m * each
    return done + [(layout, t) for group in open_.values() for layout, t in group.items()]


def intervals(layouts: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: pieces of a length with
    ranks from ``first rank`` on go to consecutive sequences at that offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for layout, times in layouts:
        offset = 0
        for n in layout:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def packed(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    rows = checkpointed(pieces(docs, path, length))
    # at most ``length`` rows
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    sent = spark.sparkContext.broadcast(intervals(plan(counts, length)))
    ranked = gapless_positions(rows, ["length"], F.xxhash64("doc_id", "piece", "ids_crc32"),
                               ["doc_id", "piece", "ids_crc32"], "rank", sum(counts.values()))

    @F.pandas_udf("sequence_id long, offset long")
    def place(n: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = sent.value
        scale = int(max(t[:, 1].max(initial=0), rank.max() if len(rank) else 0)) + 1
        at = np.searchsorted(t[:, 0] * scale + t[:, 1], n.to_numpy() * scale + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": t[at, 2] + rank.to_numpy() - t[at, 1], "offset": t[at, 3]})

    d = ranked.withColumn("_p", place("length", "rank"))
    return d.select("doc_id", "piece", "start", "length", "ids_crc32",
                    F.col("_p.sequence_id").alias("sequence_id"), F.col("_p.offset").alias("offset"))
