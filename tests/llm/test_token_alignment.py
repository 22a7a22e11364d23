import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from thermolens.llm import token_alignment as T
from thermolens.llm.queries import op13_token_alignment

PARTS = ["a", "the", "word", " ", " ", "  ", "\n", "\t", "'s", "1", "23", "é", "中文", "\U0001F600", ".", ",", "!", "<s>", "</s>",
         "<unk>", "<0x41>", "<|endoftext|>", "\x00", "\x1c", "\x85", "　", " ", "ﬁ", "á", "Réeux", "_", "-"]


class Brute:
    """The contract, text by text: whole texts through both tokenizers, offsets as sets."""

    def __init__(self):
        import public_tokenizers as P
        import sentencepiece
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in
                 map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
        self.a_bytes = {i: t for t, i in ranks.items()}
        self.a = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def of_text(self, text):
        if not text:
            return None
        want = (" " + text).encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        a_bytes = [self.a_bytes[i] for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in zip(b, pieces)]
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            return None
        ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        own = [([], []) for _ in common]
        for side, ids, group in ((0, a, group_a), (1, b, group_b)):
            for i, g in zip(ids, group):
                own[g][side].append(i)
        groups = ["|".join(",".join(map(str, x)) for x in g) for g in own]
        at_end = defaultdict(list)
        for y, f in zip(b, ends_b.tolist()):
            at_end[f].append(y)
        links = [(x, y) for x, e in zip(a, ends_a.tolist()) for y in at_end[e]]
        return len(a), len(b), groups, links

    def table(self, texts):
        found = [self.of_text(t) for t in texts]
        count, held = Counter(), Counter()
        for f in found:
            if f:
                count.update(f[3])
                held.update(set(f[3]))
        top = defaultdict(int)
        for (_, b), n in count.items():
            top[b] = max(top[b], n)
        out = []
        for f in found:
            if not f:
                out.append((0, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, groups, links = f
            out.append((n_a, n_b, len(groups), len(links), sum(count[x] == top[x[1]] for x in links),
                        sum(count[x] for x in links), sum(held[x] for x in links),
                        hashlib.sha256(";".join(groups).encode()).hexdigest()))
        return out


@pytest.fixture(scope="module")
def brute():
    return Brute()


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "docs_sum", "groups_sha256"]


def rows(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


def want(brute, docs):
    return sorted(((i, *x) for (i, _), x in zip(docs, brute.table([t for _, t in docs]))), key=repr)


def test_units_equal_whole_texts(brute):
    rnd, align = random.Random(7), T.aligner()
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(1, 25))) + ("▁x" if rnd.random() < 0.03 else "")
             for _ in range(8000)]
    for text, (groups, links, n_a, n_b) in zip(texts, align.of_texts(texts)):
        w = brute.of_text(text)
        if w is None:
            assert (groups, len(links), n_a, n_b) == (b"", 0, 0, 0), repr(text)
        else:
            assert (n_a, n_b, groups.decode().split(";")) == w[:3], repr(text)
            assert [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in links] == w[3], repr(text)


def test_faster_encoder_equals_the_tokenizer():
    """Every character it takes, next to others."""
    rnd, align = random.Random(11), T.aligner()
    taken = [c for c in map(chr, range(0x250)) if T._PLAIN.fullmatch(c)]
    texts = [" " + "".join(rnd.choice(taken) for _ in range(12)) for _ in range(20000)] + [f" a{c}b {c} {c}{c}" for c in taken]
    for t in texts:
        assert align.a_ids(t) == align.a.encode(t, add_special_tokens=False).ids, repr(t)


def test_equals_brute_force(spark, edge, empty, brute):
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    docs += [(100, "▁ not spelled"), (101, " leading"), (102, "  two"), (103, " "), (104, "the the the the")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(T.aligned(d)) == want(brute, docs)
    assert T.aligned(empty).collect() == [] and T.aligned(empty).columns == COLS


def test_equals_brute_force_in_small_chunks(spark, brute, monkeypatch):
    """Chunks of a few documents: bitmaps of both kinds, several planes, many chunks."""
    rnd = random.Random(3)
    words = ["the", "cat", "sat", "réeux", "on", "mat."]
    docs = [(i % 40, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60)))) for i in range(120)]
    docs += [(500, None)] + [(600 + i, "copies of one text, copies of one text") for i in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    w = want(brute, docs)
    assert rows(T.aligned(d)) == w
    monkeypatch.setattr(T, "CHUNK_DOCS", 8)  # workers load the module afresh; the driver's closures carry no constant
    chunk = T.Chunk()
    links = [x[1] for x in T.aligner().of_texts([t for _, t in docs])]
    at = [chunk.add(x) for x in links]
    total = Counter()
    for pair, plane, dense, bits in chunk.bitmaps():
        for p, k, x, b in zip(pair.tolist() if hasattr(pair, "tolist") else pair.to_pylist(), plane.to_pylist(),
                              dense.to_pylist(), bits.to_pylist()):
            held = np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8), bitorder="little")) if x \
                else np.frombuffer(b, "<u2")
            for i in held:
                total[p, int(i)] += 1 if k == 0 else 1 << (k - 1)
    assert total == Counter((int(p), i) for i, x in zip(at, links) for p in x)


def test_pair_counts(spark, brute):
    docs = [(1, "the cat the cat"), (2, "the cat"), (3, "cats"), (4, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    count, held = Counter(), Counter()
    for _, t in docs:
        if f := brute.of_text(t):
            count.update(f[3])
            held.update(set(f[3]))
    got = {(r["a"], r["b"]): (r["docs"], r["links"]) for r in T.pair_counts(T.indexed(d)[1]).collect()}
    assert got == {k: (held[k], n) for k, n in count.items()}


def test_query_on_whole_table(spark, brute):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op13_token_alignment(spark, sf)) == want(brute, docs)


def test_long_text_without_spaces(brute):
    text = "abcd" * 5000 + "\n" * 3000 + "é" * 5000
    groups, links, n_a, n_b = T.aligner().of_texts([text])[0]
    w = brute.of_text(text)
    assert (n_a, n_b, groups.decode().split(";")) == w[:3] and len(links) == len(w[3])
