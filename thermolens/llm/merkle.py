"""Document fingerprints: Merkle trees over sections, paragraphs and pieces.

A paragraph is a line; its leaves are its pieces, cut after punctuation marks (or after
``LEAF_CHARS`` characters without one), so the pieces join to the paragraph.  A section
is a run of paragraphs that ends with one whose digest starts with 0 or 1: cut by
content, so an inserted paragraph does not move later sections.  Every digest is the
MD5 of its children's; equal roots mean equal texts, and a branch whose digests agree
need not be looked into.

A fingerprint is ``root:sections:paragraphs:leaves``, where the lists hold the first 8
digits of each digest, joined by dots, and a paragraph's also its number of leaves after an x.  Which
paragraphs form a section shows from their digests, so a fingerprint is the whole tree.

Edits (``with_edits``) are located by walking two trees from the root: where roots differ, sections that agree at
either end are left out, and only the paragraphs of those between are looked at; of these again what agrees at
either end is left out, and only the leaves of the rest are looked at.  What is left is a range of positions in each text, on every
level.

Defined cases: null text = empty text (one empty paragraph without leaves); ids are whole numbers, of the whole range of
their type; documents are ordered by descending id, null ids last, equal ids by the hash of the text; a single
document is its own next one; repeated rows are rows of their own; an empty table gives
an empty result; other columns, whatever their names, are not touched.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

LEAF_CHARS = 48
LEAF = rf"[^.!?;:|,]{{0,{LEAF_CHARS}}}+[.!?;:|,]+\s*|[^.!?;:|,]{{1,{LEAF_CHARS}}}"
ROWS_PER_CHUNK = 5_000


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, the fingerprint of column ``text`` (row by row)."""
    own = [F.col(f"`{c}`") for c in df.columns if c != name]
    d = df.withColumn("_p", F.split(text_of(text), "\n"))
    d = d.withColumn("_l", F.transform("_p", lambda p: F.transform(
        F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), lambda s: F.md5(s))))
    d = d.withColumn("_q", F.transform("_l", lambda x: F.md5(F.array_join(x, ""))))
    # a mark after each paragraph that ends a section; the text between marks is a section
    marked = F.transform("_q", lambda q: F.concat(q, F.when(q < F.lit("2"), F.lit("|")).otherwise(F.lit(","))))
    d = d.withColumn("_s", F.array_remove(F.split(F.array_join(marked, ""), r"\|"), ""))
    d = d.withColumn("_s", F.transform("_s", lambda s: F.md5(s)))

    def listed(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda x: F.substring(x, 1, 8)), ".")

    paragraphs = F.zip_with("_q", "_l", lambda q, x: F.concat(F.substring(q, 1, 8), F.lit("x"), F.size(x).cast("string")))
    fp = F.concat_ws(":", F.md5(F.array_join("_s", "")), listed(F.col("_s")), F.array_join(paragraphs, "."),
                     listed(F.flatten("_l")))
    return d.select(*own, fp.alias(name))


def _level(fp: Column, i: int) -> Column:
    return F.array_remove(F.split(F.split(fp, ":")[i], r"\."), "")


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add ``name``: 1 if the roots of fingerprints ``a`` and ``b`` agree, else the share
    of distinct leaves they have in common, of the larger one's (below 1)."""
    own = [F.col(f"`{c}`") for c in df.columns if c != name]
    d = df.withColumns({"_x": F.array_distinct(_level(F.col(a), 3)), "_y": F.array_distinct(_level(F.col(b), 3))})
    most = F.greatest(F.size("_x"), F.size("_y"), F.lit(1))
    part = F.least(F.size(F.array_intersect("_x", "_y")) / most, F.lit(0.999999))
    same = F.substring_index(F.col(a), ":", 1) == F.substring_index(F.col(b), ":", 1)
    return d.select(*own, F.when(same, F.lit(1.0)).otherwise(part).alias(name))


def _equal_start(a: str, b: str) -> Column:
    """How many elements two arrays have in common from their start."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, False)
    return F.when(at > 0, at - 1).otherwise(F.size(same)).cast("int")


def _agreeing(d: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add ``<name>_p`` and ``<name>_q``: how many elements of arrays ``a`` and ``b`` agree at the start, and at the end
    without those."""
    d = d.withColumns({f"{name}_p": _equal_start(a, b), "_ra": F.reverse(a), "_rb": F.reverse(b)})
    most = F.least(F.size(a), F.size(b)) - F.col(f"{name}_p")
    return d.withColumn(f"{name}_q", F.least(_equal_start("_ra", "_rb"), most)).drop("_ra", "_rb")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def with_edits(df: DataFrame, a: str, b: str, name: str = "edits") -> DataFrame:
    """Add ``name``: where the text of fingerprint ``b`` differs from that of ``a``, null if nowhere.

    A struct of ``sections``, ``paragraphs`` and ``leaves``, each with ``a_from, a_to, b_from, b_to``: the positions (from 0, ends
    exclusive) between which the two differ; an empty range on one side is an insertion or deletion there.
    """
    own = [F.col(f"`{c}`") for c in df.columns if c != name]
    d = df
    for x, fp in (("a", a), ("b", b)):
        d = d.withColumns({f"_s{x}": _level(F.col(fp), 1), f"_e{x}": _level(F.col(fp), 2), f"_l{x}": _level(F.col(fp), 3)})
        d = d.withColumns({
            f"_q{x}": F.transform(f"_e{x}", lambda p: F.substring(p, 1, 8)),
            f"_n{x}": F.transform(f"_e{x}", lambda p: F.substring_index(p, "x", -1).cast("int"))})
        # paragraphs per section, cut by the digests as the sections were
        marked = F.array_join(F.transform(f"_q{x}", lambda q: F.concat(q, F.when(q < F.lit("2"), F.lit("|")).otherwise(F.lit(",")))), "")
        d = d.withColumn(f"_z{x}", F.transform(F.array_remove(F.split(marked, r"\|"), ""), lambda p: F.ceil(F.length(p) / 9).cast("int")))
    d = _agreeing(d, "_sa", "_sb", "_1")
    # paragraphs of the differing sections
    for x in "ab":
        n = F.size(f"_q{x}")
        first = _total(F.slice(f"_z{x}", F.lit(1), F.col("_1_p")))
        last = _total(F.slice(F.reverse(f"_z{x}"), F.lit(1), F.col("_1_q")))
        d = d.withColumns({f"_f{x}": first, f"_g{x}": n - last})
        d = d.withColumn(f"_m{x}", F.slice(f"_q{x}", F.col(f"_f{x}") + 1, F.greatest(F.col(f"_g{x}") - F.col(f"_f{x}"), F.lit(0))))
    d = _agreeing(d, "_ma", "_mb", "_2")
    # leaves of the differing paragraphs
    for x in "ab":
        d = d.withColumns({f"_f{x}": F.col(f"_f{x}") + F.col("_2_p"), f"_g{x}": F.col(f"_g{x}") - F.col("_2_q")})
        d = d.withColumns({
            f"_h{x}": _total(F.slice(f"_n{x}", F.lit(1), F.col(f"_f{x}"))),
            f"_w{x}": _total(F.slice(f"_n{x}", F.col(f"_f{x}") + 1, F.greatest(F.col(f"_g{x}") - F.col(f"_f{x}"), F.lit(0))))})
        d = d.withColumn(f"_k{x}", F.slice(f"_l{x}", F.col(f"_h{x}") + 1, F.col(f"_w{x}")))
    d = _agreeing(d, "_ka", "_kb", "_3")

    def place(first: dict[str, Column], last: dict[str, Column]) -> Column:
        return F.struct(*[c[x].cast("int").alias(f"{x}_{end}") for x in "ab" for end, c in (("from", first), ("to", last))])

    col = lambda c: {x: F.col(f"{c}{x}") for x in "ab"}
    levels = F.struct(
        place({x: F.col("_1_p") for x in "ab"}, {x: F.size(f"_s{x}") - F.col("_1_q") for x in "ab"}).alias("sections"),
        place(col("_f"), col("_g")).alias("paragraphs"),
        place({x: F.col(f"_h{x}") + F.col("_3_p") for x in "ab"},
              {x: F.col(f"_h{x}") + F.col(f"_w{x}") - F.col("_3_q") for x in "ab"}).alias("leaves"))
    same = F.substring_index(F.col(a), ":", 1) == F.substring_index(F.col(b), ":", 1)
    return d.select(*own, F.when(~same, levels).alias(name))


def with_next(df: DataFrame, columns: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``next_<c>`` for each column: its value in the next row by descending id
    (after the last row: in the first).

    Rows go to chunks of neighbouring ids, bounded by approximate quantiles, in one
    exchange.  Each chunk also gets the first row of the chunk after it, so a window per chunk is enough.
    """
    n = df.count()
    if n == 0:
        return df.withColumns({f"next_{c}": F.col(c) for c in columns})
    k = max(1, n // ROWS_PER_CHUNK)  # as many as the rows need: 8 bytes each in the broadcast bounds
    probs = [i / k for i in range(1, k)] or [0.5]
    shares = F.split(F.lit(",".join(map(repr, probs))), ",").cast("array<double>")
    bounds = df.agg(F.percentile_approx(F.col(doc_id), shares, F.lit(20 * k + 100)).alias("_b"))
    d = df.withColumn("_h", F.xxhash64(text_of(text))).crossJoin(F.broadcast(bounds))
    # binary search: how many bounds are at most the id
    step = 1 << len(probs).bit_length() >> 1
    d = d.withColumn("_c", F.lit(0))
    while step:
        fits = F.get("_b", F.col("_c") + F.lit(step - 1)) <= F.col(doc_id)
        d = d.withColumn("_c", F.when(F.coalesce(fits, F.lit(False)), F.col("_c") + step).otherwise(F.col("_c")))
        step >>= 1
    d = d.withColumn("_c", F.when(F.col(doc_id).isNull(), F.lit(-1)).otherwise(F.col("_c"))).drop("_b")
    order = [F.col(doc_id).desc_nulls_last(), F.col("_h")]
    # the first row of every chunk, one row per chunk
    first = d.groupBy("_c").agg(F.max(F.struct(F.col(doc_id).alias("i"), F.bitwise_not("_h").alias("h"))).alias("f"))
    asc = Window.orderBy("_c")
    first = first.select(F.col("_c").alias("_fc"), F.col("f.i").alias("_fi"), F.bitwise_not("f.h").alias("_fh"),
                         F.coalesce(F.lead("_c").over(asc), F.min("_c").over(Window.partitionBy())).alias("_to"))
    heads = d.join(F.broadcast(first), (F.col("_c") == F.col("_fc")) & F.col(doc_id).eqNullSafe(F.col("_fi"))
                   & (F.col("_h") == F.col("_fh")))
    heads = heads.dropDuplicates(["_fc"]).withColumn("_c", F.col("_to")).drop("_fc", "_fi", "_fh", "_to")
    both = d.withColumn("_end", F.lit(0)).unionByName(heads.withColumn("_end", F.lit(1)))
    w = Window.partitionBy("_c").orderBy("_end", *order)
    both = both.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return both.where("_end = 0").drop("_end", "_c", "_h")


def edited(text: Column, following: Column) -> Column:
    """The text, its last third replaced by the first characters of the following text, as many or all."""
    n = F.length(text)
    m = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - m), F.substring(following, F.lit(1), m))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fingerprint, edited, edited_fingerprint, near_edited, near_next)."""
    d = docs.select("doc_id", text_of().alias("text"))
    d = with_next(with_fingerprint(d, "text", "fingerprint"), ["text", "fingerprint"])
    d = d.withColumn("edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    d = with_fingerprint(d, "edited", "edited_fingerprint")
    d = with_likeness(d, "fingerprint", "edited_fingerprint", "near_edited")
    return with_likeness(d, "fingerprint", "next_fingerprint", "near_next").drop("next_fingerprint")
