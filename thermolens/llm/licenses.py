"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest ancestor
directory.

Weights.  Tokens are runs of letters and digits; a token weighs its count times
ln((1 + documents) / (1 + documents that contain it)) + 1, where document counts cover
every token of the whole table.

Templates (``license_templates``): notices, SPDX tags, standard header paragraphs and titles, and the full texts of short
licences.

Header units.  Comment marks are taken off the lines.  A unit is a line, a sentence of a paragraph (lines up to
a blank one, joined), or a whole paragraph, so a header may span lines, and a notice may stand beside
other sentences.  A unit is compared only if it has one of a template's rarest tokens, without which the rest of the
template is too light (prefix filtering of the cosine join), and if it could reach the threshold were its tokens outside the
templates as light as a token can be.  The rest are compared with every template, exactly.  The best unit is a file's header.

Licence files.  A file is one if its whole text matches a full licence text, or if it is named like one (LICENSE, COPYING, ...)
and its text or a unit of it matches any template.  A short notice does not make a file a licence
file.  Licence files speak for their directory; a file without a license of its own inherits from the nearest ancestor directory
that has one, found by joining each directory's ancestor paths with the licensed directories.

Defined cases: null text = empty text; a null path is a file without a name in the root directory; ties between templates go to the
first by name of licence, between units to the first (lines, then sentences, then paragraphs); null or repeated ids are rows like others; an
empty table gives an empty result; very long lines take time in proportion to their length (and its logarithm); other
columns, whatever their names, are not touched.

Built-in functions only.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_of
from .license_templates import NOTICES, SPDX, TEXTS

THRESHOLD = 0.7
# A whole file must be nearer to a full licence text than a header to a notice: a part of the text is a header.
WHOLE_THRESHOLD = 0.9
# The weight of a token that every document has.
LEAST = 1.0
TOKEN = r"[\p{L}\p{N}]+"
# Marks at the start and end of a line of comment.
COMMENT = r"(?m)^[ \t\r]*(?://+!?|#+|/\*+|\*+/|\*+(?=[ \t\r]|$)|--+|;+|<!--+|%+|\"\"\"|''')[ \t]*|[ \t]*(?:\*+/|--+>)[ \t\r]*$"
LICENCE_NAME = r"(?i)^(un)?(licen[cs]e|copying|copyright|notice)s?([-_.].*)?$"


@dataclass(frozen=True)
class Template:
    license: str
    text: str
    whole: bool = False  # the full text of a licence


def known_templates() -> list[Template]:
    """All templates, in the order in which ties are decided."""
    spdx = [Template(re.sub("-(only|or-later)$", "", x), f"SPDX-License-Identifier: {x}") for x in SPDX]
    own = [Template(*x) for x in NOTICES] + spdx + [Template(*x, whole=True) for x in TEXTS]
    return sorted(own, key=lambda t: (t.license, t.whole, t.text))


def template_tokens(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for t in re.findall(r"[^\W_]+", text.lower()):
        out[t] = out.get(t, 0) + 1
    return out


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def listed(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A short list of rows, whose strings have letters and digits only, as a table without Python workers."""
    text = ";".join(",".join(map(str, r)) for r in rows)
    parts = spark.range(1).select(F.explode(F.split(F.lit(text), ";")).alias("r")).select(F.split("r", ",").alias("r"))
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return parts.select(*[F.get("r", F.lit(i)).cast(t).alias(c) for i, (c, t) in enumerate(fields)])


def document_counts(files: DataFrame) -> DataFrame:
    """(t, n): in how many files each token stands; tokens of a single file are left out.  A task adds up its own
    files' counts before anything is shuffled."""
    every = files.select(F.explode(F.array_distinct(tokens_of(text_of()))).alias("t"))
    return checkpointed(every.groupBy("t").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


class Weights:
    """Token weights of a corpus, and the templates as unit vectors (bounded by the templates)."""

    def __init__(self, files: DataFrame, templates: list[Template], threshold: float):
        self.templates, self.n = templates, files.count()
        self.counts = document_counts(files)
        tokens = [template_tokens(t.text) for t in templates]
        self.vocabulary = sorted({t for c in tokens for t in c})
        own = listed(files.sparkSession, [(t,) for t in self.vocabulary], "t string")
        df = {r["t"]: r["n"] for r in self.counts.join(F.broadcast(own), "t").collect()}
        self.idf = {t: math.log((1 + self.n) / (1 + df.get(t, 1))) + 1 for t in self.vocabulary}
        self.vectors, anchors = [], set()
        for c in tokens:
            w = {t: m * self.idf[t] for t, m in c.items()}
            norm = math.sqrt(sum(x * x for x in w.values()))
            self.vectors.append({t: x / norm for t, x in w.items()})
            left = 1.0
            # from the rarest token on: what is left in the end are words that most files have
            for t, x in sorted(self.vectors[-1].items(), key=lambda p: (-self.idf[p[0]], p[0])):
                if left < threshold * threshold:
                    break
                anchors.add(t)
                left -= x * x
        self.anchors = F.array(*[F.lit(t) for t in sorted(anchors)])
        self.words = F.array(*[F.lit(t) for t in self.vocabulary])
        most = {t: max(v.get(t, 0.0) for v in self.vectors) for t in self.vocabulary}
        # weight of a token, and its part of a dot product at most
        self.weights = F.map_from_arrays(self.words, F.array(*[F.struct(
            F.lit(self.idf[t]).alias("w"), F.lit(self.idf[t] * most[t]).alias("d")) for t in self.vocabulary]))

    def may_match(self, toks: Column, threshold: float) -> Column:
        """Whether a list of tokens can reach the threshold, going by a bound of its cosine with any template: each
        token's part of the dot product at most, and the list's length if the tokens that no template has weigh
        ``LEAST`` (a fold over the sorted list)."""
        known = F.array_sort(F.filter(toks, lambda x: F.array_contains(self.words, x)))
        start = F.struct(F.lit("").alias("t"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("dot"))

        def step(s, x):
            own = F.element_at(self.weights, x)
            w = own["w"]
            run = F.when(s["t"] == x, s["run"]).otherwise(F.lit(0.0))
            return F.struct(x.alias("t"), (run + w).alias("run"), (s["sum"] + (2 * run + w) * w).alias("sum"),
                            (s["dot"] + own["d"]).alias("dot"))

        rest = (F.size(toks) - F.size(known)) * F.lit(LEAST ** 2)
        return F.aggregate(known, start, step, lambda s: s["dot"] * s["dot"] * F.lit(1 + 1e-9) >=
                           (s["sum"] + rest) * F.lit(threshold ** 2))

    def postings(self, spark) -> DataFrame:
        """(t, k, w): the token's share of template k."""
        return listed(spark, [(t, k, w) for k, v in enumerate(self.vectors) for t, w in v.items()], "t string, k int, w double")


def units_of(text: Column) -> Column:
    """A text's lines, paragraphs and sentences, lower-cased and without comment marks, each once."""
    clean = F.regexp_replace(F.lower(text), COMMENT, "")
    paragraphs = F.transform(F.split(clean, r"\n[ \t\r]*\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    sentences = F.flatten(F.transform(paragraphs, lambda p: F.split(p, r"(?<=[.!?;])\s+")))
    lines = F.transform(F.split(clean, "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.array_distinct(F.concat(lines, sentences, paragraphs))


def scored(parts: DataFrame, w: Weights) -> DataFrame:
    """(_row, unit, k, cosine) of (_row, unit number, toks) rows and all templates they share a token with."""
    words = parts.select("_row", "unit", F.explode("toks").alias("t")).groupBy("_row", "unit", "t").agg(
        F.count(F.lit(1)).alias("m"))
    idf = F.log(F.lit(1.0 + w.n) / (F.coalesce("n", F.lit(1)) + 1)) + 1
    words = checkpointed(words.join(w.counts, "t", "left").select("_row", "unit", "t", (F.col("m") * idf).alias("x")))
    length = words.groupBy("_row", "unit").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    postings = F.broadcast(w.postings(parts.sparkSession))  # a few thousand rows, whatever the input
    dots = words.join(postings, "t").groupBy("_row", "unit", "k").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    return dots.join(length, ["_row", "unit"]).select("_row", "unit", "k", F.round(F.col("dot") / F.col("length"), 9).alias("cosine"))


def scanned(files: DataFrame, templates: list[Template] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (with columns path and text) without their text, plus ``header`` struct(cosine, license, text)
    and ``file`` struct(cosine, license), both null where nothing reaches the threshold."""
    templates = known_templates() if templates is None else templates
    own = [c for c in files.columns if c not in ("header", "file", "text")]
    w = Weights(files, templates, threshold)
    name = F.element_at(F.split(F.coalesce("path", F.lit("")), "/"), -1)
    d = files.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_own"), F.regexp_like(name, F.lit(LICENCE_NAME)).alias("_named"),
                     text_of().alias("_text"), tokens_of(text_of()).alias("_toks"))
    some = F.arrays_overlap("_toks", w.anchors)
    # only files that hold an anchor are cut into units; the first, without a text, is the whole file
    units = F.transform(units_of(F.col("_text")), lambda u: F.struct(u.alias("unit"), tokens_of(u).alias("toks")))
    units = F.filter(units, lambda u: F.arrays_overlap(u["toks"], w.anchors))
    units = F.filter(units, lambda u: w.may_match(u["toks"], threshold))
    whole = F.array(F.struct(F.lit("").alias("unit"), F.when(w.may_match(F.col("_toks"), threshold), F.col("_toks")).alias("toks")))
    d = d.select("_own", "_named", F.monotonically_increasing_id().alias("_row"),
                 F.when(some, F.concat(whole, units)).alias("_parts"))
    d = checkpointed(d)
    parts = d.where("_parts is not null").select("_row", F.posexplode("_parts").alias("unit", "p"))
    near = scored(parts.select("_row", "unit", "p.toks"), w).where(F.col("cosine") >= threshold)
    names = F.array(*[F.lit(t.license) for t in templates])
    full = F.array(*[F.lit(t.whole) for t in templates])
    near = near.select("_row", "unit", "cosine", (-F.col("k")).alias("order"), F.get(names, F.col("k")).alias("license"),
                       F.get(full, F.col("k")).alias("full"))
    best = near.groupBy("_row").agg(
        F.min(F.when((F.col("unit") > 0) & ~F.col("full"), F.struct((-F.col("cosine")).alias("c"), (-F.col("order")).alias("o"),
                                                                      "unit", "license"))).alias("h"),
        F.max(F.when((F.col("unit") == 0) & F.col("full") & (F.col("cosine") >= WHOLE_THRESHOLD), F.struct("cosine", "order", "license"))).alias("t"),
        F.max(F.struct("cosine", "order", "license")).alias("any"))
    out = d.join(best, "_row", "left")
    header = F.when(F.col("h").isNotNull(), F.struct(
        (-F.col("h.c")).alias("cosine"), F.col("h.license").alias("license"), F.get("_parts", F.col("h.unit"))["unit"].alias("text")))
    file = F.coalesce("t", F.when(F.col("_named"), F.col("any")))
    file = F.when(file.isNotNull(), F.struct(file["cosine"].alias("cosine"), file["license"].alias("license")))
    return out.select(*[F.col(f"_own.`{c}`").alias(c) for c in own], header.alias("header"), file.alias("file"))


def directory_licenses(scans: DataFrame) -> DataFrame:
    """(dir, license or null) from (dir, file) rows: the licence file that matches best speaks for a directory."""
    best = F.min(F.when(F.col("file").isNotNull(), F.struct((-F.col("file.cosine")).alias("c"), F.col("file.license").alias("license"))))
    return scans.groupBy("dir").agg(best.alias("f")).select("dir", F.col("f.license").alias("license"))


def nearest_ancestors(dirs: DataFrame) -> DataFrame:
    """(dir, inherited_from, inherited) from (dir, license or null) rows, one per directory."""
    parts = F.split("dir", "/")
    up = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("path")))).alias("a"))
    up = up.select("dir", "a.depth", F.col("a.path").alias("path")).distinct()
    licensed = dirs.where("license is not null").select(F.col("dir").alias("path"), "license")
    near = up.join(licensed, "path").groupBy("dir").agg(F.max(F.struct("depth", "path", "license")).alias("m"))
    return near.select("dir", F.col("m.path").alias("inherited_from"), F.col("m.license").alias("inherited"))


def licensed(files: DataFrame, templates: list[Template] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` without their text, plus ``header, file, dir, inherited_from, inherited, license``."""
    made = ["header", "file", "dir", "inherited_from", "inherited", "license"]
    own = [c for c in files.columns if c not in [*made, "text"]]
    path = F.coalesce("path", F.lit(""))
    scans = checkpointed(scanned(files, templates, threshold).select(
        *own, "header", "file", F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("dir")))
    near = checkpointed(nearest_ancestors(checkpointed(directory_licenses(scans))))
    # Spark's adaptive plan broadcasts a small side and splits a directory with very many files otherwise
    out = scans.join(near, "dir", "left")
    return out.select(*own, *made[:-1], F.coalesce("file.license", "header.license", "inherited").alias("license"))
