import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from edge_docs import edge_rows
from pyspark.sql import functions as F

from thermolens.llm import licenses, mixing, packing, quality_classifier, sharding, url_filters

SF = "/root/testdata/sf0.001"


def docs_of(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ---- mixing

def check_mix(rows, got):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    want = brute.targets(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6)
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s], s


def test_mixing_meets_targets(spark, edge, empty):
    for docs in (docs_of(spark, "/root/testdata/sf0.01"), edge):
        rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        got = mixing.mixed(docs).collect()
        assert len(got) == len(rows)
        check_mix(rows, got)
    assert mixing.mixed(empty).count() == 0 and mixing.repeated(empty).count() == 0


def test_mixing_splits_rows_with_one_hash(spark):
    rows = [(1, "a b c d", "x")] * 90 + [(i, "a b", "y") for i in range(10)] + [(i, "a b c", "z") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    check_mix(rows, mixing.mixed(docs).collect())


def test_mixing_repeats_rows_and_is_stable(edge):
    times = {(r["doc_id"], r["text"], r["source"]): r["copies"] for r in mixing.mixed(edge).collect()}
    rep = mixing.repeated(edge)
    assert rep.columns == edge.columns
    n = Counter((r["doc_id"], r["text"], r["source"]) for r in rep.collect())
    rows = Counter((i, t, s) for i, t, _, s, *_ in edge_rows())
    assert all(n[k] == c * rows[k] or rows[k] > 1 for k, c in times.items())
    again = Counter((r["doc_id"], r["text"], r["source"]) for r in mixing.repeated(edge.repartition(7)).collect())
    assert n == again


# ---- packing

def check_packing(rows, got):
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == \
        Counter(brute.pieces(rows))
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= packing.LENGTH
    return len(seqs), -(-sum(r["length"] for r in got) // packing.LENGTH)


def test_packing_is_exact_and_tight(spark, edge, empty):
    for docs in (docs_of(spark), edge):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        used, bound = check_packing(rows, packing.packed(docs).collect())
        assert used <= bound + 2
    assert packing.packed(empty).count() == 0


def test_packing_plan_uses_every_piece_once():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 500, 20000):
        x = rng.integers(1, 2048, n)
        counts = dict(zip(*[a.tolist() for a in np.unique(x, return_counts=True)]))
        used = Counter()
        for layout, times in packing.plan(counts):
            assert sum(layout) <= 2048 and times > 0
            for k in layout:
                used[k] += times
        assert used == Counter(counts)
    assert packing.plan({1500: 3, 548: 2, 300: 1, 248: 1}) == [((1500, 548), 2), ((1500, 300, 248), 1)]


def test_packing_never_needs_more_than_best_fit():
    import random
    r = random.Random(1)
    histograms = [
        {n: r.randrange(1, 1000) for n in range(1, 2048)}, {n: r.randrange(1, 1000) for n in r.sample(range(1, 2048), 200)},
        {n: r.randrange(1, 1_000_000) for n in range(640, 760)}, {n: r.randrange(1, 1000) for n in r.sample(range(300, 1201), 200)},
        dict(Counter(min(2048, max(1, int(r.lognormvariate(6, 1)))) for _ in range(20_000))),
        {n: r.randrange(1, 1000) for n in r.sample(range(1000, 2048), 300)} | {n: 5 for n in range(1, 200, 4)}, {}, {2048: 7}, {1: 3},
    ]
    for counts in histograms:
        made = packing.plan(counts)
        used = Counter()
        for layout, times in made:
            assert sum(layout) <= 2048 and times > 0
            for n in layout:
                used[n] += times
        assert used == Counter(counts)
        rest = {n: c for n, c in counts.items() if n < 2048}
        assert sum(t for _, t in made) <= sum(t for _, t in packing._best_fit(rest, 2048)) + counts.get(2048, 0)


def test_packing_word_cache_equals_the_tokenizer():
    import random
    ids = packing.word_ids(packing.tokenizer_path())
    rng = random.Random(3)
    alphabet = "abcXYZ  \n\t'.,!éÉßÀœŒŸÿİıſΣςσ\u0301\u00a0\u3000中文12٣<|>#%_-’“ﬁ\x0b\x1c "
    for k in range(3000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) + ("<|endoftext|>x don't" if k % 9 == 0 else "")
        assert np.frombuffer(ids.of_text(t), "<u4").tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids


# ---- sharding

def test_sharding_law_and_slots(spark, edge, empty):
    for docs, slack in ((docs_of(spark, "/root/testdata/sf0.01"), 40_000), (edge, 300_000)):
        texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
        got = sharding.sharded(docs, 8).collect()
        want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
        size, slots, keys = Counter(), {}, {}
        for r in got:
            size[r["shard"]] += r["size"]
            slots.setdefault(r["shard"], []).append(r["slot"])
            keys.setdefault(r["shard"], []).append(r["key"])
        total = sum(size.values())
        assert all(abs(size[s] - total / 8) <= slack for s in range(8))
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        order = [keys[s] for s in sorted(keys)]
        assert all(max(a) < min(b) for a, b in zip(order, order[1:]))
    assert sharding.sharded(empty, 8).count() == 0


def test_sharding_splits_a_hot_text(spark):
    rows = [(i, "the same text in every row") for i in range(900)] + [(1000 + i, f"own {i}") for i in range(300)]
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), 8)
    by = [r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(by) == 8 and max(by) - min(by) <= 60


def test_sharding_writes_sorted_folders(edge, tmp_dir, spark):
    sharding.write_shards(edge.select("doc_id", "text"), f"{tmp_dir}/out", 4)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == len(edge_rows())


# ---- URL filters

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]


def test_url_rules_and_parsing(spark):
    urls = {
        "HTTP://WWW.Example.COM/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "https://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
        "x://com": ("com", "", None, "allow"), "x://net/es/": ("net", "/es/", "net/es/", "block"),
        "http://h?q=://z/": ("h", "", None, "allow"), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "": ("", "", None, "allow"), "a\nb://É.com/x#://q": ("É.com", "/x", "com/", "allow"),
    }
    pages = spark.createDataFrame([(i, u, "<p>", "v") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, verdict string")
    labels = spark.createDataFrame([], "page_id long, verdict string")
    got = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in url_filters.filtered(pages, labels, RULES).collect()}
    assert {u: g[:3] for u, g in got.items()} == {u: w[:3] for u, w in urls.items()}
    assert all(got[u][3] == w[3] for u, w in urls.items() if w[2])
    assert url_filters.filtered(pages.limit(0), labels, RULES).count() == 0


def test_url_mined_rules_match_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    host, path = url_filters.host_and_path()
    d = pages.withColumns({"host": host, "path": path}).withColumn("tokens", url_filters.url_tokens())
    d = d.withColumn("verdict", F.when(F.col("url").rlike("casino|spam|bets"), "block").otherwise("allow"))
    rows = [(frozenset(r["tokens"]), r["verdict"]) for r in d.collect()]
    rules = url_filters.mine_rules(d.select("tokens", "verdict")).collect()
    assert rules
    for r in rules:
        fits = [v for t, v in rows if t >= set(r["antecedent"])]
        assert r["confidence"] == pytest.approx(fits.count(r["verdict"]) / len(fits))
        assert r["support"] == fits.count(r["verdict"])
        assert r["confidence"] >= url_filters.MIN_CONFIDENCE and r["support"] >= url_filters.MIN_COUNT
    hit = url_filters.match_rules(d.select("tokens").distinct(), url_filters.mine_rules(d.select("tokens", "verdict")))
    best = {frozenset(r["tokens"]): (r["mined"]["confidence"], r["mined"]["support"]) for r in hit.collect()}
    for t, _ in rows:
        fit = [(r["confidence"], r["support"]) for r in rules if t >= set(r["antecedent"])]
        assert best.get(t) == (max(fit) if fit else None)


# ---- license scans

def brute_rules(rows, min_count, min_confidence):
    """{(tokens, verdict): (confidence, support)} from every subset of every row's items."""
    from itertools import combinations
    where = {}
    for i, (tokens, _) in enumerate(rows):
        for t in tokens:
            where.setdefault(t, set()).add(i)
    item = {}
    for t, at in where.items():
        if len(at) >= min_count:
            item.setdefault(frozenset(at), []).append(t)
    name = {t: tuple(sorted(ts)) for ts in item.values() for t in ts}
    n, by = Counter(), Counter()
    for tokens, verdict in rows:
        own = sorted({name[t] for t in tokens if t in name})
        for k in range(1, len(own) + 1):
            for x in combinations(own, k):
                n[x] += 1
                by[x, verdict] += 1
    found = {k: c / n[k[0]] for k, c in by.items() if c >= min_count and c / n[k[0]] >= min_confidence}
    kept = {(x, v) for (x, v), c in found.items()
            if not any(found.get((x[:i] + x[i + 1:], v), -1) >= c for i in range(len(x)))}
    return {(tuple(sorted(t for i in x for t in i)), v): (round(found[x, v], 9), by[x, v]) for x, v in kept}


def test_url_rules_are_complete(spark):
    import random
    rnd = random.Random(5)
    rows = []
    for _ in range(300):
        host = rnd.choice(["host:a", "host:b", "host:c"])
        tokens = {host, host.replace("host", "part"), *rnd.sample(["seg0:x", "seg0:y", "key:q", "ext:html", "fragment", "seg1:#"], 3)}
        bad = host == "host:a" and "key:q" in tokens or "ext:html" in tokens and "fragment" in tokens
        rows.append((sorted(tokens), "block" if bad != (rnd.random() < 0.05) else "allow"))
    d = spark.createDataFrame(rows, "tokens array<string>, verdict string").repartition(3)
    for min_count in (5, 20):
        got = {(tuple(r["antecedent"]), r["verdict"]): (round(r["confidence"], 9), r["support"])
               for r in url_filters.mine_rules(d, min_count).collect()}
        assert got == brute_rules(rows, min_count, url_filters.MIN_CONFIDENCE) and len(got) > 10


def test_url_long_shared_paths_and_long_urls(spark):
    import time
    path = "/".join(f"s{i}" for i in range(40))
    many = "&".join(f"k{chr(97 + i % 26)}{i}=1" for i in range(60))
    rows = [(i, f"http://site.example.com/{path}/{i}.html?{many}") for i in range(200)]
    rows += [(1000, "http://site.example.com/" + "/".join(f"p{i}" for i in range(20_000))), (1001, "http://x.org/" + "a" * 200_000)]
    labels = spark.createDataFrame([(i, "block") for i in range(150)], "page_id long, verdict string")
    start = time.time()
    got = {r["page_id"]: r for r in url_filters.filtered(
        spark.createDataFrame(rows, "page_id long, url string"), labels, [("net/", "allow")]).collect()}
    assert time.time() - start < 60 and len(got) == len(rows)
    assert all(got[i]["verdict"] == "block" for i in range(200)) and got[1001]["verdict"] == "allow"
    # support is a number of URLs, not a share of the table
    fill = spark.range(5000).select((F.col("id") + 5000).alias("page_id"), F.lit("http://other.example.org/q").alias("url"))
    labels = labels.unionByName(fill.select("page_id", F.lit("allow").alias("verdict")))
    more = spark.createDataFrame(rows[:25], "page_id long, url string").unionByName(fill)
    got = {r["page_id"]: r["verdict"] for r in url_filters.filtered(more, labels, []).where("page_id < 25").collect()}
    assert set(got.values()) == {"block"}


def test_url_extension_token(spark):
    d = spark.createDataFrame([("http://a.b/x/y.HTML?q=1", "a.b", "/x/y.HTML"), ("http://a.b/x.y/z", "a.b", "/x.y/z"),
                               ("http://a.b/1.2", "a.b", "/1.2")], "url string, host string, path string")
    got = [{t for t in r["t"] if t.startswith("ext:")} for r in d.select("url", url_filters.url_tokens().alias("t")).collect()]
    assert got == [{"ext:html"}, set(), set()]


def license_brute(rows, templates, threshold=licenses.THRESHOLD):
    """{row: (header license or None, file license or None)} of (path, text) rows, unit by unit."""
    import math
    import re
    tok = lambda s: re.findall(r"[^\W_]+", s.lower())
    n, df = len(rows), Counter(t for _, x in rows for t in set(tok(x or "")))
    idf = lambda t: math.log((1 + n) / (1 + df.get(t, 1))) + 1
    vector = lambda s: {t: m * idf(t) for t, m in Counter(tok(s)).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    vectors = [(t, vector(t.text)) for t in templates]

    def cosines(s):
        v = vector(s)
        return [(round(sum(x * v.get(t, 0.0) for t, x in u.items()) / length(u) / length(v), 9), k, t)
                for k, (t, u) in enumerate(vectors)] if v else []

    out = []
    for path, x in rows:
        x = x or ""
        clean = re.sub(licenses.COMMENT, "", x.lower())
        paragraphs = [" ".join(p.split()) for p in re.split(r"\n[ \t\r]*\n", clean)]
        units = {" ".join(y.split()) for y in clean.split("\n")} | {y for p in paragraphs for y in re.split(r"(?<=[.!?;])\s+", p)}
        header = [(-c, k, u, t.license) for u in units | set(paragraphs) for c, k, t in cosines(u) if c >= threshold and not t.whole]
        text = [(-c, k, t.license) for c, k, t in cosines(x) if c >= licenses.WHOLE_THRESHOLD and t.whole]
        named = re.match(licenses.LICENCE_NAME, (path or "").split("/")[-1])
        other = [(h[0], h[1], h[3]) for h in header] + [(-c, k, t.license) for c, k, t in cosines(x) if c >= threshold]
        file = min(text, default=None) or (min(other, default=None) if named else None)
        out.append((min(header)[3] if header else None, file and file[2]))
    return out


def license_results(spark, rows):
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, path string, text string").repartition(3)
    got = {r["id"]: r for r in licenses.scanned(d).collect()}
    return [(got[i]["header"] and got[i]["header"]["license"], got[i]["file"] and got[i]["file"]["license"]) for i in range(len(rows))]


def test_license_headers_match_brute_force(spark, edge, empty):
    rows = [("a/b", r["text"]) for r in docs_of(spark, "/root/testdata/sf0.01").select("text").collect()
            if r["text"] is None or len(r["text"]) < 20_000]
    got = license_results(spark, rows)
    assert sum(h is not None for h, _ in got) > 10 and got == license_brute(rows, licenses.known_templates())
    assert licenses.licensed(edge).count() == len(edge_rows())
    assert licenses.licensed(empty).count() == 0


HEADERS = [
    ("MIT", "Copyright (c) 2021 Jane Doe. Released under the MIT License."),
    ("MIT", "// This code is released under the MIT License."),
    ("CC-BY-4.0", "This article is licensed under CC BY 4.0."),
    ("Proprietary", "Copyright 2020 Acme Corp. All rights reserved."),
    ("Apache-2.0", "# SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "/* SPDX-License-Identifier: GPL-2.0-or-later */"),
    ("GPL-2.0", "/*\n * This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General "
     "Public License as published by\n * the Free Software Foundation; either version 2 of the License, or\n * (at your option) any "
     "later version.\n *\n * Something else.\n */"),
    ("Apache-2.0", "// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in compliance "
     "with the License.\n// You may obtain a copy of the License at\n//\n//     http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
     "files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, "
     "modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software "
     "is\nfurnished to do so, subject to the following conditions:"),
]


@pytest.mark.parametrize("n", [400, 40_000])
def test_license_headers_at_two_table_sizes(spark, n):
    filler = "this code and the article is a copyright of holders work"
    docs = spark.range(n).select("id", F.lit("a/b").alias("path"), F.lit(filler).alias("text")).unionByName(
        spark.createDataFrame([(-1 - i, "a/b", f"first\n\n{x}\n\n{filler}") for i, (_, x) in enumerate(HEADERS)],
                              "id long, path string, text string"))
    got = {r["id"]: r for r in licenses.scanned(docs).where("header is not null").collect()}
    for i, (want, x) in enumerate(HEADERS):
        assert -1 - i in got and got[-1 - i]["header"]["license"] == want, x
        assert got[-1 - i]["file"] is None
    assert len(got) == len(HEADERS)


def test_license_inheritance(spark):
    from thermolens.llm.license_templates import TEXTS
    full = dict(TEXTS)
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    filler = "\n" + "code line words " * 30
    rows = [
        ("lib/LICENSE", "Copyright 2020 J\n\n" + full["MIT"]), ("lib/a/x.py", "plain words only"), ("lib/a/b/y.py", f"# {apache}{filler}"),
        ("lib/a/b/z.py", "nothing here"), ("lib/a/x.py", "plain words only"), ("other/q.py", "nothing"), (None, None),
        ("two/1.py", f"first\n{apache}{filler}"), ("two/2.py", f"{apache}{filler}"), ("two/deep/3.py", "third"),
        ("short/1.txt", mit), ("short/2.txt", "not licensed"),            # a short notice speaks for itself only
        ("text/readme", full["BSD-3-Clause"]), ("text/deep/1", "not a word"),   # a full text does, whatever its name
        ("spdx/COPYING.txt", "SPDX-License-Identifier: MPL-2.0"), ("spdx/a", "words"),
        ("spdx/in/LICENSE.md", full["ISC"]), ("spdx/in/b/c", "more words"),
    ]
    assert license_results(spark, rows) == license_brute(rows, licenses.known_templates())
    d = licenses.licensed(spark.createDataFrame(rows, "path string, text string")).collect()
    got = {r["path"]: (r["license"], r["inherited_from"]) for r in d}
    assert len(d) == len(rows)
    assert got["lib/LICENSE"] == ("MIT", "lib") and got["lib/a/x.py"] == ("MIT", "lib") and got["lib/a/b/z.py"] == ("MIT", "lib")
    assert got["lib/a/b/y.py"] == ("Apache-2.0", "lib")
    assert got["two/deep/3.py"] == (None, None) and got["short/1.txt"] == ("MIT", None) and got["short/2.txt"] == (None, None)
    assert got["text/deep/1"] == ("BSD-3-Clause", "text") and got["spdx/a"] == ("MPL-2.0", "spdx")
    assert got["spdx/in/b/c"] == ("ISC", "spdx/in") and got["other/q.py"] == (None, None) and got[None] == (None, None)


def test_license_in_one_very_long_line(spark):
    import time
    line = "released under the MIT License " + " ".join(f"w{i}" for i in range(200_000))
    start = time.time()
    assert license_results(spark, [("a", line), ("b", line + "\nReleased under the MIT License.")]) == [(None, None), ("MIT", None)]
    assert time.time() - start < 60


# ---- quality classifier

def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = docs_of(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    out = quality_classifier.held_out(F.col("doc_id"))
    d = quality_classifier.scored(docs, model).join(labels, "doc_id").where(out)
    rows = [(r["score"], r["quality"]) for r in d.collect()]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    auc = np.mean([[a > b for b in bad] for a in good])
    assert auc > 0.97 and all(0 <= s <= 1 for s, _ in rows)
    assert np.mean([(s >= 0.7) == (q == 1) for s, q in rows]) > 0.95
    # held-out labels are not read: another model from flipped held-out labels is the same
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_classifier.fit(docs, flipped)
    assert np.array_equal(model["w"], again["w"]) and model["a"] == again["a"]


def test_classifier_held_out_rule(spark):
    d = spark.range(200).withColumn("h", quality_classifier.held_out(F.col("id")))
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in d.collect())


def test_classifier_class_counts_and_hinge_fit(spark):
    rows = [("good words here", 1), ("good words there", 1), ("bad junk junk", 0), (None, 0), ("", 1)]
    d = spark.createDataFrame(rows, "text string, y int").repartition(3)
    got = {r["bucket"]: (r["n0"], r["n1"]) for r in quality_classifier.class_counts(d).collect()}
    want = {-1: (2, 3)}
    for t, y in rows:
        for b in quality_classifier.features(t).tolist():
            x = want.get(b, (0, 0))
            want[b] = (x[0] + (y == 0), x[1] + (y == 1))
    assert got == want
    x = [quality_classifier.features(t) for t, _ in rows if t]
    r, n0, n1 = quality_classifier.log_ratios({"bucket": list(got), "n0": [v[0] for v in got.values()],
                                               "n1": [v[1] for v in got.values()]})
    w, bias = quality_classifier.fit_hinge(x, np.array([1, 1, 0]), r)
    assert (n0, n1) == (2, 3)
    assert [w[i] @ quality_classifier._unit(i, r) + bias > 0 for i in x] == [True, True, False]


def test_classifier_edges(edge, empty, labels):
    for docs, lab in ((edge, labels), (edge, labels.limit(0)), (empty, labels)):
        got = quality_classifier.scored(docs, quality_classifier.fit(docs, lab)).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
