"""URL filters: association rules over URL tokens, mined by FP-growth from labels.

A URL becomes a set of tokens: the host's suffixes and labels, path segments with their place,
the file extension, query keys and whether it has a fragment (digits become ``#``, so page numbers do not
make tokens of their own).  Tokens that stand in exactly the same labelled URLs (all segments of a path that many share, a
host and its labels) are one item: FP-growth would go through all of their subsets.  Whether two tokens do is decided by
counts and sums of two hashes of their URLs.  FP-growth runs on the labelled URLs with the label as one
more item; rules whose consequent is the label, with at least ``MIN_COUNT`` URLs (of any table size) and
``MIN_CONFIDENCE``, decide about URLs: the most confident rule that fits wins.  A rule asks for all tokens of its items.

Matching.  Each rule is filed under its rarest token; a URL meets only rules filed under one of its
tokens and is then checked for the rest.  URLs with equal token sets are matched once,
so a host with a third of all pages costs one row per distinct set.

Stated rules (``host/path`` with a verdict) go before mined ones: a rule fits its host and all subdomains
if the URL's path starts with the rule's, the longest wins.

Defined cases: a null URL, or one without ``://``, has empty host and path and no
tokens, so only the default verdict is left; unlabelled pages are not mined; without
labels, or without a rule that survives pruning, every verdict is stated or the default; null or repeated ids are rows
like others; an empty table gives an empty result; other columns are not touched.

Built-in functions and the DataFrame FP-growth only.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

MIN_COUNT = 20
MIN_CONFIDENCE = 0.8
LABEL = "label="
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_REST = r"(?s)^.*?://[^/?#]*[^?#]*(.*)$"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(u, _URL, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(u, _URL, 2)


def url_tokens(url: str = "url", host: str = "host", path: str = "path") -> Column:
    """The token set of a URL whose host and path are already columns."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(
        F.lit("host:"), F.array_join(F.slice(labels, F.greatest(n - i + 1, F.lit(1)), i), ".")))
    parts = F.transform(labels, lambda x: F.concat(F.lit("part:"), x))
    segs = F.filter(F.split(path, "/"), lambda x: x != "")
    places = F.transform(segs, lambda x, i: F.concat(
        F.lit("seg"), F.least(i, F.lit(3)).cast("string"), F.lit(":"), F.regexp_replace(x, "[0-9]+", "#")))
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _REST, 1)
    keys = F.transform(F.regexp_extract_all(rest, F.lit(r"[?&]([^=&#]+)"), F.lit(1)),
                       lambda x: F.concat(F.lit("key:"), x))
    # what follows the last dot of the last segment, if it is short and plain
    extension = F.lower(F.regexp_extract(path, r"\.([A-Za-z][A-Za-z0-9]{0,7})$", 1))
    extension = F.when(extension != "", F.array(F.concat(F.lit("ext:"), extension))).otherwise(F.array().cast("array<string>"))
    fragment = F.when(rest.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    every = F.concat(F.when(n > 0, suffixes).otherwise(F.array().cast("array<string>")), parts, places, extension, keys, fragment)
    return F.sort_array(F.array_distinct(every))


def stated_rule(rules: list[tuple[str, str]], host: str = "host", path: str = "path") -> Column:
    """struct(rule, verdict) of the longest stated rule that fits, else null.  rules: short list of
    (``host/path``, verdict)."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda x: len(x[0])):
        h, _, p = rule.partition("/")
        fits = ((F.col(host) == h) | F.col(host).endswith(f".{h}")) & F.col(path).startswith(f"/{p}")
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def items_of(rows: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """((_id, items), (item, tokens)) of (_id, tokens) rows: tokens in at least ``min_count`` rows, those of the same
    rows as one item, which has the name of the first."""
    words = rows.select("_id", F.explode("tokens").alias("t"))
    total = lambda seed: F.sum(F.xxhash64("_id", F.lit(seed)).cast("decimal(38,0)"))
    seen = words.groupBy("t").agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b")).where(F.col("n") >= min_count)
    # as many tokens at most as one URL has
    items = checkpointed(seen.groupBy("n", "a", "b").agg(F.sort_array(F.collect_list("t")).alias("tokens")).select(
        F.get("tokens", F.lit(0)).alias("item"), "tokens"))
    named = words.join(items.select(F.col("item").alias("t")), "t", "left_semi")
    return named.groupBy("_id").agg(F.collect_set("t").alias("items")), items


def mine_rules(labelled: DataFrame, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(antecedent, verdict, confidence, support) from (tokens, verdict) rows; support: labelled URLs that have the
    antecedent and the verdict.

    A rule with more items than another of the same verdict and no more confidence adds
    nothing and is pruned with those below the limits.
    """
    rows = labelled.where("verdict is not null and size(tokens) > 0")
    rows = checkpointed(rows.select(F.monotonically_increasing_id().alias("_id"), "tokens", "verdict"))
    items, tokens = items_of(rows, min_count)
    baskets = items.join(rows.select("_id", "verdict"), "_id").select(
        F.concat("items", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    baskets = checkpointed(baskets)
    n = baskets.count()
    empty = "antecedent array<string>, verdict string, confidence double, support long"
    if not n:
        return rows.sparkSession.createDataFrame([], empty)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (min_count - 0.5) / n), minConfidence=min_confidence).fit(baskets)
    found = model.associationRules.where(F.element_at("consequent", 1).startswith(LABEL)).select(
        F.sort_array("antecedent").alias("antecedent"),
        F.substring_index(F.element_at("consequent", 1), "=", -1).alias("verdict"), "confidence",
        F.round(F.col("support") * n).cast("long").alias("support"))
    found = checkpointed(found)
    # subsets of an antecedent: dropping one item at a time reaches every shorter rule that was kept
    parent = found.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("antecedent")), lambda i: F.filter(
        F.col("antecedent"), lambda x, j: j != i - 1))).alias("short"), "antecedent", "verdict", "confidence")
    worse = parent.join(found.select(F.col("antecedent").alias("short"), "verdict", F.col("confidence").alias("c")),
                        ["short", "verdict"]).where("c >= confidence").select("antecedent", "verdict").distinct()
    best = found.join(worse, ["antecedent", "verdict"], "left_anti").withColumn("_r", F.monotonically_increasing_id())
    best = checkpointed(best)
    whole = best.select("_r", F.explode("antecedent").alias("item")).join(tokens, "item").groupBy("_r").agg(
        F.sort_array(F.flatten(F.collect_list("tokens"))).alias("antecedent"))
    return checkpointed(best.drop("antecedent").join(whole, "_r").select("antecedent", "verdict", "confidence", "support"))


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined struct(verdict, confidence, support, antecedent)) of distinct token
    sets that fit a rule; the most confident, then best supported, rule wins."""
    words = sets.select("tokens", F.explode("tokens").alias("token"))
    freq = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = rules.withColumn("token", F.explode("antecedent")).join(freq, "token")
    filed = filed.groupBy("antecedent", "verdict", "confidence", "support").agg(
        F.min(F.struct("n", "token")).alias("r")).withColumn("token", F.col("r.token"))
    hit = words.join(filed, "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return hit.groupBy("tokens").agg(F.max(F.struct("confidence", "support", "verdict", "antecedent")).alias("mined"))


def filtered(pages: DataFrame, labels: DataFrame, stated: list[tuple[str, str]], default: str = "allow",
             min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, mined_rule, confidence) of every page.

    labels: (page_id, verdict) for some pages; pages that a stated rule judges are labelled by it.
    """
    host, path = host_and_path()
    d = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    d = checkpointed(d.withColumns({"tokens": url_tokens(), "_s": stated_rule(stated)}))
    known = labels.select(F.col("page_id").alias("_pid"), F.col("verdict").alias("_v")).where("_pid is not null")
    known = known.groupBy("_pid").agg(F.max("_v").alias("_v"))
    labelled = d.join(known, F.col("page_id") == F.col("_pid"), "left").select(
        "tokens", F.coalesce("_s.verdict", "_v").alias("verdict"))
    rules = mine_rules(labelled, min_count, min_confidence)
    mined = match_rules(d.select("tokens").where("size(tokens) > 0").distinct(), rules)
    out = d.join(mined, "tokens", "left")
    return out.select("page_id", "url", "host", "path", F.col("_s.rule").alias("rule"),
                      F.coalesce("_s.verdict", "mined.verdict", F.lit(default)).alias("verdict"),
                      F.array_join("mined.antecedent", " ").alias("mined_rule"),
                      F.col("mined.confidence").alias("confidence"))
