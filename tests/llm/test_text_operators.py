import re
from collections import Counter

import brute
import xxhash
from edge_docs import PLAIN, edge_rows
from pyspark.sql import functions as F

from thermolens.llm import merkle, pii, quality_rules, simhash

SF = "/root/testdata/sf0.001"


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- quality rules

def brute_scores(rows, trusted, buckets=quality_rules.BUCKETS, prior=quality_rules.PRIOR):
    """doc position -> mean log ratio, from the stated definition."""
    import math

    def grams(text):
        toks = re.findall(r"(?:[^\W_]|_)+|[^\w\s]+", (text or "").lower())
        hs = [xxhash.xxh64_intdigest(t, 42) for t in toks]
        hs = [h - (1 << 64) if h >= 1 << 63 else h for h in hs]
        two = [((a << 1) ^ b) & ((1 << 64) - 1) for a, b in zip(hs, hs[1:])]
        two = [h - (1 << 64) if h >= 1 << 63 else h for h in two]
        return [h % buckets for h in hs + two]

    raw, target = Counter(), Counter()
    every = [grams(t) for _, t in rows]
    for (i, _), g in zip(rows, every):
        raw.update(g)
        if i in trusted:
            target.update(g)
    nr, nt = sum(raw.values()), sum(target.values())
    llr = {b: math.log((target[b] + prior * c / nr) / (nt + prior) / (c / nr)) if nt else 0.0 for b, c in raw.items()}
    return [sum(llr[b] for b in g) / len(g) if g else 0.0 for g in every]


def test_quality_rules_match_brute_force(spark):
    docs = docs_of(spark).select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    good = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id").collect()}
    trusted = spark.createDataFrame([(i,) for i in good], "doc_id long")
    want = dict(zip([r[0] for r in rows], brute_scores(rows, good)))
    for r in quality_rules.judge(docs, trusted).collect():
        c = brute.text_counts(dict(rows)[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c
        assert r["base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert abs(r["llr_score"] - want[r["doc_id"]]) < 1e-5
        assert r["kept"] == (not r["base_failed"] and r["llr_score"] >= quality_rules.THRESHOLD)


def test_quality_rules_tell_junk_from_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    d = quality_rules.judge(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id")
    d = d.where("not base_failed")
    assert d.where("quality = 1 and not kept").count() == 0
    assert d.where("quality = 0 and kept").count() == 0


def test_quality_rules_edges(edge, empty, labels):
    trusted = labels.where("quality = 1").select("doc_id")
    got = quality_rules.judge(edge.select("doc_id", "text", "kept"), trusted).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        assert r["kept"] is not None and r["llr_score"] == r["llr_score"]
    kept = quality_rules.keep_good(edge, trusted)
    assert kept.columns == edge.columns
    assert kept.where("doc_id in (1, 2, 3, 10)").count() == 0
    assert kept.where("doc_id = 4").count() == 2 and kept.where("kept = 'k'").count() == kept.count()
    assert quality_rules.judge(empty, trusted).count() == 0
    none = quality_rules.judge(edge, trusted.limit(0)).agg(F.max(F.abs("llr_score"))).first()[0]
    assert none == 0.0


def test_repeated_windows_that_overlap(spark):
    texts = ["a b a b a b", "a a a a", "a b c", "x a b c a b c y", "a b", "", "p q r s p q r t"]
    d = quality_rules.text_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    for r in d.collect():
        assert r["n_repeat_words"] == brute.text_counts(r["text"])[4], r["text"]


# ---- SimHash

def check_groups(rows, got):
    """got: (doc_id, fp, component_id) of every row of rows (doc_id, text)."""
    fps = [brute.simhash(t) for _, t in rows]
    classes = brute.components(fps)
    low = {}
    for (i, _), c in zip(rows, classes):
        if i is not None and (c not in low or i < low[c]):
            low[c] = i
    want = Counter((i, f, low.get(c)) for (i, _), f, c in zip(rows, fps, classes))
    assert Counter((r[0], r[1] % (1 << 64), r[2]) for r in got) == want


def test_simhash_matches_brute_force(spark, edge, empty):
    for docs in (docs_of(spark), edge):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        check_groups(rows, simhash.near_duplicates(docs).collect())
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_large_drawers_lose_no_link(spark):
    import random
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(400):
        x = rng.choice(sorted(fps))
        for b in rng.sample(range(64), rng.randint(1, 5)):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(fps)
    signed = [(x - (1 << 64) if x >= 1 << 63 else x,) for x in fps]
    want = brute.components(fps)
    for limit in (4, 4096):
        links = simhash.links(spark.createDataFrame(signed, "fp long"), 3, drawer_max=limit)
        for a, b in links.collect():
            assert bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3
        root = {r["fp"] % (1 << 64): r["root"] for r in simhash.components(links).collect()}
        seen = {}
        for f, c in zip(fps, want):
            seen.setdefault(c, set()).add(root.get(f, f"own {f}"))
        assert all(len(v) == 1 for v in seen.values())
        assert len(set().union(*seen.values())) == len(seen)


def test_simhash_keeps_one_of_each_group(edge, spark, empty):
    kept = simhash.keep_representatives(edge)
    assert kept.columns == edge.columns
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    fps = [brute.simhash(t) for _, t in rows]
    assert kept.count() == len(set(brute.components(fps)))
    assert kept.where("doc_id = 4").count() == 1 and kept.where("doc_id = 5").count() == 0
    nameless = spark.createDataFrame([(None, "one two three four"), (None, "one two three four"), (None, "other words")],
                                     "doc_id long, text string")
    assert simhash.keep_representatives(nameless).count() == 2
    assert simhash.keep_representatives(empty).count() == 0


# ---- PII

def test_pii_base_spans_match_regular_expressions(spark):
    import random
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice("ab1229.@+-() %_é\n") for _ in range(rng.randint(0, 60)))
        got = ",".join(f"{k}:{s}:{e}" for s, e, k in pii.base_spans(t))
        assert got == brute.pii(t), repr(t)
    for t in ("9" * 50 + ".1.1.1", "0" * 50 + ".1.1.1", "+1" + "1" * 300):
        assert ",".join(f"{k}:{s}:{e}" for s, e, k in pii.base_spans(t)) == brute.pii(t)
    # long runs stay linear (the plain expressions would not)
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("1.1." * 20_000)[0] == (0, 7, "ip")
    assert pii.base_spans("a" * 100_000 + "@b.c") == [(0, 100_004, "email")]


def test_pii_finds_unseen_identifiers_by_context(spark):
    key = "0123456789abcdef" * 2 + "abcdef01"
    rows = [(i, f"Some text with number {i} token = \"{key[i:] + key[:i]}\" and more") for i in range(20)]
    rows += [(100, "Here a token = \"ZX-99-UNSEEN-77\" is shown"), (101, "the code ZX-99-UNSEEN-78 is not announced")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["spans"]) for r in pii.with_spans(docs, pii.learn_patterns(docs)).collect()}
    text, spans = got[100]
    kind, s, e = spans.split(":")
    assert kind == "secret" and text[int(s):int(e)] == "ZX-99-UNSEEN-77"
    assert got[101][1] == ""
    assert all(got[i][1].startswith("secret:") for i in range(20))


def test_pii_spaced_entities_are_seeds(spark):
    """Phones and cards in groups teach their contexts; unseen shapes are found there and nowhere else."""
    rows = []
    for i in range(12):
        rows.append((i, f"Please ring us +1 (017) 555-77{i:02d} today or later."))
        card = f"4111 1111 1111 {1000 + 10 * i}"
        digits = card.replace(" ", "")
        check = next(c for c in range(10) if pii._luhn(digits[:-1] + str(c)))
        rows.append((100 + i, f"They paid by card {card[:-1]}{check} and left."))
        rows.append((200 + i, f"You can write to someone{i}@host{i}.example.org about it."))
        rows.append((300 + i, f"A list of numbers {i} 2024-01-{i + 10} and 33 44 55 66 {i} more."))
    rows += [(900, "Please ring us (017) 555-9911 today."), (901, "They paid by card 4111-1111-1111-1112 yesterday."),
             (902, "You can write to some.one1(at)host.example.org there."), (903, "Numbers of 017 555 9911 are not announced."),
             (904, "Please ring us 12 today."), (905, "Please ring us 2024-01-15T10:11:12Z today.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    patterns = pii.learn_patterns(docs)
    kinds = {r["context"]: r["kind"] for r in patterns.collect()}
    assert kinds == {"ring us": "phone", "by card": "card", "write to": "email"}
    got = {r["doc_id"]: (r["text"], r["spans"]) for r in pii.with_spans(docs, patterns).collect()}
    for i, kind, want in ((900, "phone", "(017) 555-9911"), (901, "card", "4111-1111-1111-1112")):
        text, spans = got[i]
        k, s, e = spans.split(":")
        assert (k, text[int(s):int(e)]) == (kind, want)
    assert got[903][1] == got[904][1] == got[905][1] == ""
    for i in range(12):
        assert [got[k + i][1].split(":")[0] for k in (0, 100, 200)] == ["phone", "card", "email"] and got[300 + i][1] == ""


def test_pii_added_spans_match_brute_force():
    """Every instance, one by one, against quadratic overlap checks and contexts from whole splits."""
    import random
    rnd = random.Random(6)
    parts = ["ring us", "token is", "+1 (017) 555-7713", "017 555 77 13", "4111 1111 1111 1111", "a1b2c3d4", "x@y.org", "10.0.0.1", "no",
             '"', " ", "\n", "w" * 700, "12", "+", "("]
    kinds = {"ring us": "phone", "token is": "secret", "us ring": "card"}
    for _ in range(400):
        text = "".join(rnd.choice(parts) + rnd.choice(["", " ", "  "]) for _ in range(rnd.randrange(1, 14)))
        base = pii.base_spans(text)
        every = sorted({(s, e) for s, e, _ in base})
        for more in (pii._groups(text), pii._tokens(text)):
            every = sorted(every + [x for x in more if not any(a < x[1] and x[0] < b for a, b in every)])
        want = set(base)
        for s, e in every:
            left = text[:s]
            words = (left[:-1] if left[-1:] in "\"'`" and left else left).split()[-2:]
            c = " ".join(map(pii._plain, words))
            if len(words) == 2 and c in kinds and pii.SHAPES[kinds[c]].fullmatch(text, s, e) and \
                    not any(a < e and s < b for a, b, _ in base):
                want.add((s, e, kinds[c]))
        got_base, got = pii._text_spans(text, kinds, None)
        assert got_base == ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        assert {(int(s), int(e), k) for k, s, e in (x.split(":") for x in got.split(",") if x)} == want, repr(text)


def test_pii_many_contacts_stay_linear():
    import time
    text = " ".join(f"call us +1 (017) 555-{i % 10000:04d} or me{i}@host.org" for i in range(20_000))
    start = time.time()
    pii._text_spans(text, {"call us": "phone"}, None)
    assert time.time() - start < 20


def test_pii_edges_and_masking(edge, empty):
    patterns = pii.learn_patterns(edge)
    d = pii.with_spans(edge, patterns)
    assert set(d.columns) == set(edge.columns) | {"base_spans"} and d.count() == len(edge_rows())
    for r in d.collect():
        assert r["base_spans"] == brute.pii(r["text"])
    m = pii.masked(edge)
    assert m.columns == edge.columns
    nine = m.where("doc_id = 9").first()
    assert nine["text"] == "mail [EMAIL] or [PHONE] from [IP], 999.1.1.1 card [CARD] ok"
    assert nine["n_chars"] == len(nine["text"]) and nine["spans"] == "s"
    assert m.where("doc_id = 1 and text is null and n_chars is null").count() == 1
    assert pii.masked(empty).count() == 0
    assert pii.mask_text("abcdef", "card:1:4,ip:2:5") == "a[CARD]f"


# ---- Merkle fingerprints

def test_merkle_edits_match_brute_force(spark, edge):
    docs = docs_of(spark)
    rows = sorted((tuple(r) for r in docs.select("doc_id", "text").collect()), reverse=True)
    follow = {rows[k][0]: rows[(k + 1) % len(rows)][1] for k in range(len(rows))}
    got = merkle.fingerprinted(docs).collect()
    assert len(got) == len(rows)
    import hashlib
    by_text = {}
    for r in got:
        assert hashlib.sha256(r["edited"].encode()).hexdigest() == brute.edited_sha(r["text"], follow[r["doc_id"]])
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        by_text.setdefault(r["text"], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v)) for v in by_text.values()}) == len(by_text)
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.95 * len(got)


def brute_leaves(paragraph):
    """Pieces of a paragraph: up to 48 plain characters with the marks and white space after them, else 48 at most."""
    out, at, marks = [], 0, ".!?;:|,"
    while at < len(paragraph):
        end = at
        while end < len(paragraph) and end - at < 48 and paragraph[end] not in marks:
            end += 1
        if end < len(paragraph) and paragraph[end] in marks:
            while end < len(paragraph) and paragraph[end] in marks:
                end += 1
            while end < len(paragraph) and paragraph[end] in " \t\n\x0b\f\r":
                end += 1
        out.append(paragraph[at:end])
        at = end
    return out


def brute_fingerprint(text):
    import hashlib
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    leaves = [[md5(x) for x in brute_leaves(p)] for p in (text or "").split("\n")]
    paragraphs = [md5("".join(x)) for x in leaves]
    # a section's text is its paragraphs' digests, a comma after each but the one that ends it
    sections, run = [], ""
    for q in paragraphs:
        run += q
        if q[0] in "01":
            sections.append(md5(run))
            run = ""
        else:
            run += ","
    if run:
        sections.append(md5(run))
    short = lambda xs: ".".join(x[:8] for x in xs)
    counted = ".".join(f"{q[:8]}x{len(x)}" for q, x in zip(paragraphs, leaves))
    return ":".join([md5("".join(sections)), short(sections), counted, short([x for xs in leaves for x in xs])])


def brute_likeness(a, b):
    if a.split(":")[0] == b.split(":")[0]:
        return 1.0
    x, y = ({v for v in f.split(":")[3].split(".") if v} for f in (a, b))
    return min(len(x & y) / max(len(x), len(y), 1), 0.999999)


def test_merkle_columns_match_brute_force(spark):
    docs = docs_of(spark).select("doc_id", "text")
    top = docs.agg(F.max("doc_id")).first()[0]
    odd = ["", None, "a" * 48 + ".b" * 3, "x" * 49 + "., \t\u00a0y\n\n" + "\u00e9" * 100, "same\nline.", "same\nline."]
    docs = docs.unionByName(spark.createDataFrame([(top + 1 + i, t) for i, t in enumerate(odd)], docs.schema))
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    nxt = {rows[k][0]: rows[(k + 1) % len(rows)][1] for k in range(len(rows))}
    got = merkle.fingerprinted(docs).collect()
    assert len(got) == len(rows) == len(nxt)
    for r in got:
        following, n = nxt[r["doc_id"]], len(r["text"])
        fp, after = brute_fingerprint(r["text"]), r["text"][:n - n // 3] + following[:n // 3]
        assert r["fingerprint"] == fp
        assert r["edited_fingerprint"] == brute_fingerprint(after)
        assert abs(r["near_edited"] - brute_likeness(fp, brute_fingerprint(after))) < 1e-12
        assert abs(r["near_next"] - brute_likeness(fp, brute_fingerprint(following))) < 1e-12
    assert any(r["near_next"] == 1 for r in got) and any(0 < r["near_next"] < 1 for r in got)


def test_merkle_chunks_agree_with_one_window(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_CHUNK", 7)
    rows = [(i * i % 101, f"text {i}") for i in range(101)] + [(None, "null a"), (None, "null b")]
    d = merkle.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), ["doc_id", "text"])
    got = {(r["doc_id"], r["text"]): r["next_doc_id"] for r in d.collect()}
    assert len(got) == len(rows)
    ids = sorted((i for i, _ in rows if i is not None), reverse=True)
    want = Counter(zip(ids, ids[1:] + [None]))
    assert Counter((k[0], v) for k, v in got.items() if k[0] is not None) == want
    assert {v for k, v in got.items() if k[0] is None} == {None, ids[0]}


def test_merkle_edges(spark, edge, empty):
    got = merkle.fingerprinted(edge).collect()
    assert len(got) == len(edge_rows())
    fps = {}
    for r in got:
        fps.setdefault(r["text"], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in fps.values())
    assert merkle.fingerprinted(empty).count() == 0
    one = merkle.fingerprinted(spark.createDataFrame([(1, "a b. c d.")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0


def edits_of(spark, pairs):
    """Located edits of (text, changed text) pairs, and the trees' lists."""
    d = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    d = merkle.with_edits(merkle.with_fingerprint(merkle.with_fingerprint(d, "a", "fa"), "b", "fb"), "fa", "fb")
    return [r["edits"] and {k: tuple(v) for k, v in r["edits"].asDict().items()} for r in d.orderBy("i").collect()]


def paragraphs_of(text):
    return text.split("\n")


TREE = [f"Paragraph {i} has a sentence. And one more, of {i * 7} words." for i in range(60)]


def test_merkle_locates_edits(spark):
    a = "\n".join(TREE)
    swapped = TREE[:20] + [TREE[21], TREE[20]] + TREE[22:]
    twice = TREE[:31] + [TREE[30]] + TREE[31:]
    cases = [
        (a, a), (a, a.replace("And one more, of 210 words", "And one more, of 999 words")), (a, "\n".join(swapped)),
        ("\n".join(twice), a), (a, "\n".join(twice)), (a, a + "\nNew end."), (a, "New start.\n" + a), (a, ""), ("", a), ("", ""),
        ("x. y. z.", "x. q. z."),
    ]
    got = edits_of(spark, cases)
    assert got[0] is None and got[9] is None
    assert got[1]["paragraphs"] == (30, 31, 30, 31)
    before = sum(len(brute_leaves(p)) for p in TREE[:30])
    assert got[1]["leaves"] == (before + 2, before + 3, before + 2, before + 3)
    assert got[2]["paragraphs"] == (20, 22, 20, 22)
    # a copy that is gone, or has come: a range that is empty on one side, at either copy's place
    assert got[3]["paragraphs"] in ((30, 31, 30, 30), (31, 32, 31, 31)) and got[4]["paragraphs"] in ((30, 30, 30, 31), (31, 31, 31, 32))
    assert got[5]["paragraphs"] == (60, 60, 60, 61) and got[6]["paragraphs"] == (0, 0, 0, 1)
    assert got[7]["paragraphs"] == (0, 60, 0, 1) and got[8]["paragraphs"] == (0, 1, 0, 60)
    assert got[10]["leaves"] == (1, 2, 1, 2) and got[10]["paragraphs"] == (0, 1, 0, 1)


def test_merkle_edits_explain_the_change(spark):
    """Outside the located ranges both texts are the same; the ranges are as short as they can be."""
    import random
    rnd = random.Random(8)
    pairs = []
    for _ in range(120):
        a = [rnd.choice(TREE[:12]) for _ in range(rnd.randrange(0, 30))]
        b = list(a)
        for _ in range(rnd.randrange(0, 4)):
            at = rnd.randrange(len(b) + 1)
            b[at:at + rnd.randrange(3)] = [rnd.choice(TREE[:14]) for _ in range(rnd.randrange(3))]
        pairs.append(("\n".join(a), "\n".join(b)))
    for (a, b), e in zip(pairs, edits_of(spark, pairs)):
        if a == b:
            assert e is None
            continue
        pa, pb = paragraphs_of(a), paragraphs_of(b)
        a0, a1, b0, b1 = e["paragraphs"]
        assert pa[:a0] == pb[:b0] and pa[a1:] == pb[b1:]
        assert not (a0 < a1 and b0 < b1 and pa[a0] == pb[b0]) and not (a0 < a1 and b0 < b1 and pa[a1 - 1] == pb[b1 - 1])
        la, lb = ([x for p in q for x in brute_leaves(p)] for q in (pa, pb))
        a0, a1, b0, b1 = e["leaves"]
        assert la[:a0] == lb[:b0] and la[a1:] == lb[b1:]


def test_merkle_ids_of_the_whole_range(spark):
    ids = [-2 ** 63, -5, 0, 7, 2 ** 63 - 1, None]
    d = spark.createDataFrame([(i, f"text of {i}.") for i in ids], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["next_text"] for r in merkle.with_next(d, ["text"]).collect()}
    order = [2 ** 63 - 1, 7, 0, -5, -2 ** 63, None]
    assert got == {i: f"text of {j}." for i, j in zip(order, order[1:] + order[:1])}
    assert merkle.fingerprinted(d).count() == len(ids)
