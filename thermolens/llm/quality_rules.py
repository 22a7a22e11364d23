"""Quality rules: text counts, and a hashed n-gram log-likelihood ratio per document.

Built-in functions only, and every per-document figure is computed inside its own
row: the text of a document is never exploded towards a shuffle.

Method.  A text is cut into runs of letters and digits and runs of other marks; its
unigrams and bigrams are hashed into ``BUCKETS`` buckets.  One aggregate counts the
buckets in the raw corpus (all documents) and in the trusted target (documents that
``trusted`` names).  Each bucket's ratio is

    log((target count + prior * raw share) / (target total + prior)) - log(raw share)

and a document's score is the mean ratio of its n-grams, so length cancels out.
A document is kept when its score is at least ``threshold``, the same rule for every
document.  A text without n-grams scores 0.  The ratio table is one row of
``BUCKETS`` floats (64 KB), whatever the input's size.

Defined cases: null text = empty text; a null, repeated or unlabelled ``doc_id`` only
decides whether the row counts as trusted; without any trusted document every ratio is
zero; repeated rows are judged (and counted) each by itself; other columns, whatever
their names, are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, settled, text_of, words_of

BUCKETS = 1 << 14
GRAM_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Mean ratio per n-gram below which a document reads unlike the target: between the
# lowest scores of clean text (-0.39 on 200 documents, -0.13 and up on more) and marked-up junk (about -1).
THRESHOLD = -0.45
# Ids (about 70 bytes each, so 17 MB) up to which they are broadcast.
BROADCAST_IDS = 250_000
PRIOR = 1000.0


def _repeat_starts(sorted_grams: str) -> Column:
    """Start positions of the windows that equal a neighbour in the array sorted by content."""
    return F.expr(f"""
      sort_array(transform(filter({sorted_grams}, (g, j) ->
          (j > 0 and get({sorted_grams}, j - 1).a = g.a and get({sorted_grams}, j - 1).b = g.b
                 and get({sorted_grams}, j - 1).c = g.c)
          or (get({sorted_grams}, j + 1).a <=> g.a and get({sorted_grams}, j + 1).b <=> g.b
                 and get({sorted_grams}, j + 1).c <=> g.c)), g -> g.i))""")


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long).

    Words are ``[^\\x20\\x09-\\x0D]+``; a line counts as repeated when it has a word and
    equals an earlier line of the text.
    """
    own = [c for c in df.columns]
    t = text_of(text)
    d = df.withColumns({"_w": words_of(t)})
    # plain columns between the steps: an array that a lambda looks into must be a
    # finished column, or it would be computed again for each element
    d = d.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "_lines": F.expr(f"filter(split(coalesce(`{text}`, ''), '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"),
        # 32 bits of each window's hash over its position: sorted as plain longs, windows
        # whose hashes agree are neighbours
        "_k": F.expr("""sort_array(transform(slice(_w, 1, greatest(size(_w) - 2, 0)), (x, i) ->
            shiftleft(xxhash64(x, get(_w, i + 1), get(_w, i + 2)), 32) | cast(i as bigint)))"""),
    })
    d = d.withColumn("_cand", F.expr("""transform(filter(_k, (k, j) ->
        shiftright(k, 32) = shiftright(get(_k, j - 1), 32) or shiftright(k, 32) = shiftright(get(_k, j + 1), 32)),
        k -> cast(k & 4294967295L as int))"""))
    # those few are compared word by word, so the count is exact
    d = d.withColumn("_grams", F.expr("""sort_array(transform(_cand, i ->
        named_struct('a', get(_w, i), 'b', get(_w, i + 1), 'c', get(_w, i + 2), 'i', i)))"""))
    d = d.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_at": _repeat_starts("_grams"),
    })
    covered = F.expr("""aggregate(transform(_at, (p, j) -> least(3, coalesce(get(_at, j + 1) - p, 3))), 0L,
                        (s, x) -> s + x)""")
    d = d.withColumn("n_repeat_words", covered)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return settled(d.select(*own, *names), names)


def base_failed() -> Column:
    """The stated base rule over the columns of ``text_counts``."""
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


def with_buckets(df: DataFrame, text: str, name: str, buckets: int = BUCKETS) -> DataFrame:
    """Add ``name``: bucket numbers of the text's unigrams and bigrams, repeats included."""
    d = df.withColumn("_tok", F.regexp_extract_all(F.lower(text_of(text)), F.lit(GRAM_TOKEN), F.lit(0)))
    d = d.withColumn("_h", F.transform("_tok", lambda x: F.xxhash64(x)))
    uni = F.transform("_h", lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    d = d.withColumn("_bi", F.expr(f"""transform(slice(_h, 1, greatest(size(_h) - 1, 0)), (h, i) ->
        cast(pmod(shiftleft(h, 1) ^ get(_h, i + 1), {buckets}L) as int))"""))
    return d.withColumn(name, F.concat(uni, F.col("_bi"))).drop("_tok", "_h", "_bi")


def bucket_counts(docs: DataFrame, trusted_ids: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): n-gram counts of all documents and of the trusted ones."""
    ids = checkpointed(trusted_ids.select(F.col(trusted_ids.columns[0]).alias("_tid")).where("_tid is not null")
                       .distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)  # more ids than that meet the texts in a shuffled join
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    d = d.join(ids, F.col("_id") == F.col("_tid"), "left").select("_text", F.col("_tid").isNotNull().alias("_trusted"))
    grams = with_buckets(d, "_text", "_b", buckets).select("_trusted", F.explode_outer("_b").alias("bucket"))
    grams = grams.where("bucket is not null")  # not explode: its inferred filter would hash each text once more
    return grams.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.sum(F.col("_trusted").cast("long")).alias("target"))


def ratio_table(counts: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> DataFrame:
    """One row, ``_llr``: an array with the log ratio of each bucket, 0 where unseen."""
    every = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    every = every.join(counts, "bucket", "left")
    total = counts.agg(F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    share = F.col("raw") / F.col("n_raw")
    ratio = F.log((F.col("target") + F.lit(prior) * share) / (F.col("n_target") + F.lit(prior)) / share)
    ratio = F.when((F.col("n_target") > 0) & (F.col("raw") > 0), ratio).otherwise(0.0).cast("float")
    one = every.join(F.broadcast(total)).select(F.struct("bucket", ratio.alias("r")).alias("e"))
    return one.agg(F.sort_array(F.collect_list("e")).alias("e")).select(F.col("e.r").alias("_llr"))


def judge(docs: DataFrame, trusted_ids: DataFrame, text: str = "text", doc_id: str = "doc_id",
          threshold: float = THRESHOLD, buckets: int = BUCKETS, prior: float = PRIOR) -> DataFrame:
    """``docs`` with the text counts, ``base_failed``, ``llr_score`` and ``kept``.

    ``trusted_ids``: one column, the ids of the documents that make up the target.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "llr_score", "kept"]
    own = [c for c in docs.columns if c not in made]
    # one row of BUCKETS floats; written once, so that no retry counts the corpus again
    table = checkpointed(ratio_table(bucket_counts(docs, trusted_ids, text, doc_id, buckets), buckets, prior))
    d = with_buckets(docs.select(*own), text, "_b", buckets).crossJoin(F.broadcast(table))
    d = d.withColumn("llr_score", F.expr(
        "case when size(_b) = 0 then 0D else aggregate(_b, 0D, (s, b) -> s + get(_llr, b)) / size(_b) end"))
    d = text_counts(d.select(*own, "llr_score"), text)
    d = d.withColumn("base_failed", base_failed())
    d = d.withColumn("kept", ~F.col("base_failed") & (F.col("llr_score") >= F.lit(threshold)))
    return settled(d.select(*own, *made), made)


def keep_good(docs: DataFrame, trusted_ids: DataFrame, **how) -> DataFrame:
    """The documents that ``judge`` keeps, with their own columns."""
    # judged on a narrow copy under private names, so that clashing columns stay as they are
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                    F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return judge(d, trusted_ids, **how).where("kept").select("_row.*")
