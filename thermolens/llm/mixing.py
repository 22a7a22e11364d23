"""Mixing sources to target weights by hash-threshold histograms.

Targets.  Sources, ordered by code point with null last, weigh 1, 2, 3, repeating, and
share the words of the whole input by weight; a target stops at ``CAP`` times its
source's words and the excess is shared again by weight until none is above.  That
fixed point is min(CAP * size, level * weight) for the one level at which targets add
up, found from running sums over the source table (one row per source).

Taking.  A source whose target is ``r`` times its size takes every document
``floor(r)`` times, and a hash-selected part of its documents once more.  The part is
nested: a document is in it when its hash lies below the source's threshold, so a
larger budget only adds documents.  Thresholds come from histograms: words are summed by
(source, leading hash bits), the buckets that fit the budget are taken whole, and only the
source's boundary bucket is summed again on its next bits, until that bucket is a single hash
value.  Then a plain filter decides every row; nothing is sorted.

Rows with the same hash (the same id and text) are numbered in chunks, and as many of
them are taken as the budget still holds.

Defined cases: null text has size 0; a null source is a source of its own; documents
without words are taken ``floor(r)`` times and at most once more, and weigh nothing; an empty table gives
an empty result; other columns, whatever their names, are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, gapless_positions, text_of, words_of

CAP = 3
WEIGHTS = (1, 2, 3)
# Hash bits summed by each pass; 5 passes see all 60 bits of the hash.
PASS_BITS = 12
HASH_BITS = 60
# Sources (about 200 bytes each) up to which the rule table is broadcast; more meet the rows in a shuffled join.
BROADCAST_SOURCES = 50_000


def n_words(text: str = "text") -> Column:
    return F.size(words_of(text_of(text))).cast("long")


def row_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """60 leading bits of the row's hash, 0 .. 2**60 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.col(doc_id).cast("string"), text_of(text)), 64 - HASH_BITS)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, extra_copies, budget) from (source, size) rows."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w)
    # in the order in which sources reach their cap as the level rises
    by = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    d = per.withColumns({
        "capped": F.coalesce(F.sum(F.lit(cap) * F.col("source_size")).over(before), F.lit(0)),
        "w_left": F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(whole),
        "nth": F.row_number().over(by),
    })
    # the level if exactly the sources before this one are capped; the first source
    # that this level leaves under its cap gives the true level
    level = (F.col("total") - F.col("capped")) / F.col("w_left")
    free = level * F.col("weight") <= F.lit(cap) * F.col("source_size")
    d = d.withColumn("lv", F.when(free, F.struct("nth", level.alias("level"))))
    d = d.withColumn("level", F.min("lv").over(whole)["level"])
    target = F.least((F.lit(cap) * F.col("source_size")).cast("double"), F.col("level") * F.col("weight"))
    d = d.withColumn("target", F.coalesce(target, (F.lit(cap) * F.col("source_size")).cast("double")))
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    d = d.withColumn("copies", F.least(ratio, F.lit(cap)).cast("long"))
    d = d.withColumn("budget", F.greatest(F.col("target") - F.col("copies") * F.col("source_size"), F.lit(0.0)))
    return d.select("source", "source_size", "target", "copies", "budget")


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, below, tie_rows): take hashes < below, and ``tie_rows`` rows of hash == below.

    rows: (source, hash, size).  One pass per PASS_BITS; after the first, only rows of
    the sources' boundary buckets are read on.
    """
    # (source, prefix): the boundary bucket so far; left: words still to take inside it
    open_ = goals.select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("left"))
    open_ = checkpointed(open_)
    for bits in range(PASS_BITS, HASH_BITS + 1, PASS_BITS):
        head = F.shiftright("hash", HASH_BITS - bits)
        up = F.shiftright(F.col("bucket"), PASS_BITS)
        hist = rows.groupBy("source", head.alias("bucket")).agg(F.sum("size").alias("words")) if bits == PASS_BITS \
            else _inside(rows, open_, bits).groupBy("source", head.alias("bucket")).agg(F.sum("size").alias("words"))
        o = open_.select(F.col("source").alias("_s"), F.col("prefix"), "left")
        hist = hist.join(o, F.col("source").eqNullSafe(F.col("_s")) & (up == F.col("prefix")))
        run = Window.partitionBy("source").orderBy("bucket")
        hist = hist.withColumn("upto", F.sum("words").over(run))
        # the first bucket that does not fit whole is the boundary; none: everything fits
        over = hist.where("upto > left").groupBy("source").agg(
            F.min(F.struct("bucket", (F.col("left") - F.col("upto") + F.col("words")).alias("rest"))).alias("b"))
        nxt = goals.select("source").alias("g").join(
            over.select(F.col("source").alias("_s"), "b"), F.col("source").eqNullSafe(F.col("_s")), "inner")
        open_ = checkpointed(nxt.select("source", F.col("b.bucket").alias("prefix"), F.col("b.rest").alias("left")))
    return open_.select("source", F.col("prefix").alias("below"), "left")


def _inside(rows: DataFrame, open_: DataFrame, bits: int) -> DataFrame:
    """Rows in the boundary bucket of their source."""
    o = open_.select(F.col("source").alias("_s"), F.col("prefix").alias("_p"))
    parent = F.shiftright("hash", HASH_BITS - bits + PASS_BITS)
    return rows.join(o, F.col("source").eqNullSafe(F.col("_s")) & (parent == F.col("_p")), "left_semi")


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies`` (times taken, 0 .. cap) and ``taken``."""
    made = ["size", "source_size", "target", "copies", "taken"]
    own = [c for c in docs.columns if c not in made]
    # each row's own words first: nothing below reads a text
    d = docs.select(*own).withColumns({"size": n_words(), "_hash": row_hash()})
    slim = checkpointed(d.select("source", F.col("_hash").alias("hash"), "size"))
    goals = checkpointed(targets(slim, weights, cap))
    cut = thresholds(slim, goals)
    # rows of a boundary hash: all have one size; take the nearest number of them
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("hash") == F.col("below"))
    at = slim.join(cut.select(F.col("source").alias("_s"), "below", "left"), same)
    ties = at.groupBy("source", "below").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("one"),
                                              F.first("left").alias("left"))
    ties = ties.withColumn("tie_rows", F.least(F.col("rows"), F.when(F.col("one") > 0, F.round(
        F.col("left") / F.col("one"))).otherwise(0).cast("long")))
    rule = goals.join(ties.select(F.col("source").alias("_s"), "below", "rows", "tie_rows"),
                      F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    rule = checkpointed(rule.withColumn("_split", (F.col("tie_rows") > 0) & (F.col("tie_rows") < F.col("rows"))))
    # one row per source, written and counted: small tables go to the texts, not the texts to them
    r = rule.select(F.col("source").alias("_s"), *[F.col(c).alias(f"_{c}") for c in (
        "source_size", "target", "copies", "budget", "below", "tie_rows")], "_split")
    if rule.count() <= BROADCAST_SOURCES:
        r = F.broadcast(r)
    d = d.join(r, F.col("source").eqNullSafe(F.col("_s")), "left")
    tie = F.col("_hash") == F.col("_below")
    if not rule.where("_split").isEmpty():
        n = slim.count()
        split = gapless_positions(d.where(tie & F.col("_split")), ["source"], F.monotonically_increasing_id(),
                                  ["size"], "_pos", n)
        rest = d.where(~F.coalesce(tie & F.col("_split"), F.lit(False))).withColumn("_pos", F.lit(0).cast("long"))
        d = split.unionByName(rest)
    else:
        d = d.withColumn("_pos", F.lit(0).cast("long"))
    more = F.when(F.col("_budget") <= 0, F.lit(0)).when(F.col("_below").isNull(), F.lit(1)) \
        .when(F.col("_hash") < F.col("_below"), F.lit(1)) \
        .when(tie & (F.col("_pos") < F.col("_tie_rows")), F.lit(1)).otherwise(F.lit(0))
    copies = F.least(F.col("_copies") + more, F.lit(cap)).cast("long")
    return d.select(*own, "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                    copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """The mix itself: every document of ``docs``, as many times as it is taken."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source", "text")
    times = mixed(d).where("copies > 0").withColumn("_t", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return times.select("_row.*")
