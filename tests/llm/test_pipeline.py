from collections import Counter

import brute
import corpus_pipeline
import pytest
from test_table_operators import check_mix, check_packing
from test_text_operators import brute_scores

from thermolens.llm import pii, quality_rules
from thermolens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, rows in, rows out) of every stage, each written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        result.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_stage_order_and_columns(stages, spark):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert list(stages) == ["quality_rules", "simhash_near_dedup", "pii", "mixing", "best_fit_packing"]
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "best_fit_packing")


def test_quality_and_dedup_match_brute_force(stages, spark):
    rows = [tuple(r) for r in stages["quality_rules"][0].select("doc_id", "text").collect()]
    good = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    left = []
    for (i, t), s in zip(rows, brute_scores(rows, good)):
        n = brute.text_counts(t)
        if n[0] >= 50 and 100 * n[4] <= 50 * n[0] and s >= quality_rules.THRESHOLD:
            left.append((i, t))
    assert Counter(i for i, _ in left) == Counter(r[0] for r in stages["quality_rules"][1].select("doc_id").collect())
    classes = brute.components([brute.simhash(t) for _, t in left])
    first = {}
    for (i, _), c in zip(left, classes):
        first[c] = min(i, first.get(c, i))
    assert sorted(first.values()) == sorted(r[0] for r in stages["simhash_near_dedup"][1].select("doc_id").collect())


def test_pii_stage_masks_every_base_span(stages):
    before, after = stages["pii"]
    spans = {r["doc_id"]: r["spans"] for r in pii.with_spans(before, pii.learn_patterns(before)).collect()}
    want = {r["doc_id"]: pii.mask_text(r["text"], spans[r["doc_id"]]) for r in before.collect()}
    got = {r["doc_id"]: r["text"] for r in after.collect()}
    assert got == want
    assert not any(brute.pii(t) for t in got.values())


def test_mixing_and_packing_stages(stages):
    before, after = stages["mixing"]
    rows = [tuple(r) for r in before.select("doc_id", "text", "source").collect()]
    times = Counter(r["doc_id"] for r in after.collect())
    sizes = {i: len(brute.words(t)) for i, t, _ in rows}
    totals, taken = Counter(), Counter()
    for i, _, s in rows:
        totals[s] += sizes[i]
        taken[s] += sizes[i] * times[i]
    for s, goal in brute.targets(totals).items():
        assert abs(taken[s] - goal) <= max(sizes[i] for i, _, x in rows if x == s)
    assert max(times.values()) <= 3 and check_mix
    rows = [tuple(r) for r in after.select("doc_id", "text").collect()]
    used, bound = check_packing(rows, stages["best_fit_packing"][1].collect())
    assert used <= bound + 2


def test_run_equals_its_stages(stages, spark):
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    got = Counter(tuple(r[k] for k in key) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == Counter(tuple(r[k] for k in key) for r in stages["best_fit_packing"][1].collect())


def test_registered_queries(spark):
    import __spark_entry__
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 11))
    assert set(ORACLE) <= set(QUERIES)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    columns = {
        "op2_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept"],
        "op4_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op5_mixing": ["doc_id", "size", "source_size", "target", "taken"],
        "op6_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        "op8_document_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                      "near_edited", "near_next"],
        "op9_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
        "op10_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    }
    for name, cols in columns.items():
        df = names[name](spark, SF)
        assert df.columns[:len(cols)] == cols, name
        if name in ("op4_sharding", "op8_document_fingerprints", "op10_quality_classifier"):
            assert df.count() == n
