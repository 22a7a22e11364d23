"""Registered queries: one per operator, over its whole table, plus the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (hard_negatives, licenses, merkle, mixing, packing, pii, quality_classifier, quality_rules, sharding, simhash,
               token_alignment, toxicity, url_filters)
from .common import table


# The stated URL rules of the contract, ``host/path``.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document: its own header's, else the nearest ancestor directory's
    (a document's path is source/language/id)."""
    docs = table(spark, sf_dir, "documents")
    files = docs.select("doc_id", F.concat_ws("/", "source", "lang", "doc_id").alias("path"), "text")
    d = licenses.licensed(files)
    return d.select("doc_id", "path", F.col("header.license").alias("header_license"),
                    F.col("header.cosine").alias("header_cosine"), F.col("header.text").alias("header_text"),
                    F.col("file.license").alias("file_license"), "inherited_from", "inherited", "license")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the stated rule's, else the mined rules'.

    Pages are labelled by the stated rules, the others by the label of the document
    with the page's number, where there is one: low quality or toxic means block."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit("block")).otherwise(F.lit("allow"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("verdict"))
    d = url_filters.filtered(table(spark, sf_dir, "pages"), labels, URL_RULES)
    return d.select("page_id", "host", "path", "rule", "verdict", "mined_rule", "confidence")


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents that the labels call good: the trusted target."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text counts, base rule and n-gram ratio verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs, trusted_documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "llr_score")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: eight shards of nearly equal bytes."""
    d = sharding.sharded(table(spark, sf_dir, "documents"), shards=8)
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    d = mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return d.select("doc_id", "size", "source_size", "target", "taken")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document: stated kinds and discovered identifiers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = pii.with_spans(docs, pii.learn_patterns(docs))
    counts = {f"n_{k}": F.regexp_count("base_spans", F.lit(f"{k}:")).cast("long")
              for k in ("email", "ip", "card", "phone")}
    return d.select("doc_id", *[c.alias(n) for n, c in counts.items()],
                    F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprint of every document and of its edited text, and their likeness."""
    d = merkle.with_edits(merkle.fingerprinted(table(spark, sf_dir, "documents")), "fingerprint", "edited_fingerprint")
    return d.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                    "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                    F.col("edits.paragraphs.a_from").alias("edit_paragraph"), F.col("edits.leaves.a_from").alias("edit_leaf"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 3 bits)."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance that every document is of good quality."""
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    d = quality_classifier.scored(docs, model)
    return d.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted"))


def mining_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` with the stated label shift of every seventh row."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return table(spark, sf_dir, "embeddings").withColumn("label", shifted)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its five positives."""
    return hard_negatives.mined(mining_rows(spark, sf_dir), F.col("vec_id") % 100 == 0)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance that every document is toxic."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    d = toxicity.scored(docs, model)
    return d.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted"), "windows")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token links of two tokenizers in every document, and how often their pairs are linked."""
    return token_alignment.aligned(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_filter": op3_url_filter,
    "op4_sharding": op4_sharding,
    "op5_mixing": op5_mixing,
    "op6_pii": op6_pii,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_toxicity": op12_toxicity,
    "op13_token_alignment": op13_token_alignment,
}

_OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_inner_product(a.v, r.v)::BIGINT AS score
  FROM e a JOIN e r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5
"""

ORACLE: dict[str, str] = {
    "op11_hard_negatives": _OP11_SQL,
}
