"""Personal data: stated patterns, plus bootstrapped contextual extraction.

Base kinds (email, ip, card, phone) are found leftmost and non-overlapping per kind.
The method adds spans of identifiers that no stated pattern describes:

1. Every base span, whatever its characters, is an *instance*; so is every group of numbers with
   separators (``MIN_DIGITS`` digits or more) and every identifier-like token (a run of identifier characters with a digit, at
   least ``MIN_LENGTH`` long) that overlaps none before it in this list.  The two words before an instance, apart from an opening
   quote, are its *lexical pattern*.  Instances that are base entities, or long hexadecimal keys, are
   *seeds* of their kind.
2. Spark scores the pattern-instance graph: a pattern's confidence in a kind is the mean score of its
   distinct instances (plus a prior), an instance's score is the best confidence of
   its patterns, seeds stay at 1.  ``ROUNDS`` rounds, each written to the checkpoint folder.
3. A pattern is accepted with at least ``MIN_SUPPORT`` distinct instances, confidence of
   at least ``MIN_CONFIDENCE``, and if at least ``MIN_CUE`` of all occurrences of its two words
   in the corpus are followed by an instance: the words announce an identifier.
4. Accepted patterns are applied to every text; the instances they announce become
   spans of the pattern's kind if they have that kind's shape (``SHAPES``), which is wider than its stated
   pattern, and do not overlap a base span.

Counts cover all documents.  Patterns reach the workers in blocks of at most
``PATTERN_BLOCK`` (a fixed size), however many there are.

Defined cases: null text = empty text (masking leaves it null); no seeds or an empty
table accept no pattern; repeated rows add occurrences but not distinct instances; ids
are never read, so null, equal or repeated ids do not matter; other columns, whatever their names,
are not touched.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, give_back, texts_of, with_workers

KINDS = ("email", "ip", "card", "phone", "secret")
MIN_LENGTH = 6
MIN_DIGITS = 7
MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.8
MIN_CUE = 0.5
PRIOR = 0.5
ROUNDS = 3
PATTERN_BLOCK = 100_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits matches from its start or not at all, so looking behind changes no
# match; possessive runs keep long digit strings linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_HEX_KEY = re.compile(r"(?=[a-f0-9]*[a-f])[a-f0-9]{32,64}")
# Numbers with separators between them.
_GROUP = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,3}[0-9])+")
_GAP = re.compile(r"[\x20().-]")
# What an announced instance of a kind may look like.
SHAPES = {
    "email": re.compile(r"\S*(?:@|[(\[]at[)\]])\S*"),
    "ip": re.compile(r"[0-9A-Fa-f]*[.:][0-9A-Fa-f.:]*"),
    "card": re.compile(r"[0-9](?:[\x20.-]?[0-9]){11,18}"),
    "phone": re.compile(r"[+(]?[0-9](?:[\x20().-]{0,3}[0-9]){6,14}"),
    "secret": re.compile(r"\S+"),
}
_LEFT = re.compile(r"[A-Za-z0-9_./+@-]*\Z")
_TOKEN = re.compile(r"[A-Za-z0-9_./+@-]*")
_NOISE = re.compile(r"[#$%&*!|]{2,}$")
_QUOTES = "\"'`"
_SPAN = 256


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        if i % 2:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the stated kinds, by start, then kind as listed."""
    out = []
    prev, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > prev and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), 0))
            prev = m.end()
        at = text.find("@", at + 1)
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(int(x) <= 255 if len(x) < 40 else not x.strip("0") or int(x.lstrip("0")[:4]) <= 255 and
                   len(x.lstrip("0")) < 4 for x in m[0].split(".")):
                out.append((*m.span(), 1))
        for m in _CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(d) <= 19 and _luhn(d):
                out.append((*m.span(), 2))
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append((*m.span(), 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


def _plain(word: str) -> str:
    """A context word: lower case, without trailing runs of marks."""
    return _NOISE.sub("", word).lower()


def _context(text: str, at: int) -> str | None:
    """The two words before a place, whole ones; a quote that opens there is not part of them."""
    if text[at - 1:at] in _QUOTES and at:
        at -= 1
    size = _SPAN
    while True:
        words = text[max(0, at - size):at].split()
        if len(words) > 2 or size >= at:  # the first word of three may be cut
            return f"{_plain(words[-2])} {_plain(words[-1])}" if len(words) > 1 else None
        size *= 4


def _tokens(text: str) -> list[tuple[int, int]]:
    """(start, end) of the identifier-like tokens."""
    out, at = [], 0
    while m := _DIGITS.search(text, at):
        start, at = m.start(), m.end()
        # the token around the digit, looked for in windows so that long runs stay linear
        lo = start
        while lo > 0:
            w = _LEFT.search(text, max(0, lo - _SPAN), lo)
            if w.start() == lo:
                break
            lo = w.start()
        end = _TOKEN.match(text, start).end()
        at = max(at, end)
        while end > lo and text[end - 1] in "./-":
            end -= 1
        if end - lo >= MIN_LENGTH:
            out.append((lo, end))
    return out


def _groups(text: str) -> list[tuple[int, int]]:
    """(start, end) of the groups of numbers with separators that are not part of a longer word."""
    return [m.span() for m in _GROUP.finditer(text) if _GAP.search(m[0]) and len(_DIGITS.findall(m[0])) >= MIN_DIGITS
            and not text[m.end():m.end() + 1].isalnum()]


def _apart(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none of ``taken`` (both sorted by start; one sweep)."""
    out, i, reach = [], 0, -1
    for s, e in spans:
        while i < len(taken) and taken[i][0] < e:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= s:
            out.append((s, e))
    return out


def instances(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, context) of the instances that two words precede, by start; base: the text's base spans."""
    kept = sorted({(s, e) for s, e, _ in base})
    if _DIGITS.search(text):
        for more in (_groups(text), _tokens(text)):
            kept = sorted(kept + _apart(more, kept))
    found = ((s, e, _context(text, s)) for s, e in kept)
    return [x for x in found if x[2] is not None]


def _occurrences(docs: DataFrame) -> DataFrame:
    """(context, value, kind): every instance in every text; kind is null unless a seed."""
    def run(batches):
        for b in batches:
            ctx, val, kind = [], [], []
            for text in texts_of(b.column(0)):
                if not text:
                    continue
                base = base_spans(text)
                known = {(s, e): k for s, e, k in reversed(base)}
                for s, e, c in instances(text, base):
                    ctx.append(c)
                    val.append(xxhash.xxh64_intdigest(text[s:e]) - (1 << 63))
                    kind.append(known.get((s, e)) or ("secret" if _HEX_KEY.fullmatch(text, s, e) else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ctx, pa.string()), pa.array(val, pa.int64()), pa.array(kind, pa.string())],
                ["context", "value", "kind"])
        give_back()

    return docs.select("text").mapInArrow(run, "context string, value long, kind string")


def _confident(graph: DataFrame) -> DataFrame:
    """(context, kind, support, confidence) after the rounds of scoring.

    graph: distinct (context, value, kind of the seed or null).  Edges are few per
    value; a frequent context is a map-side partial sum.
    """
    edges = graph.select("context", "value").distinct()
    seeds = checkpointed(graph.where("kind is not null").groupBy("value").agg(F.min("kind").alias("kind")))
    scores = seeds.withColumn("score", F.lit(1.0))
    support = edges.groupBy("context").agg(F.count(F.lit(1)).alias("support"))
    conf = None
    for _ in range(ROUNDS):
        mass = edges.join(scores, "value").groupBy("context", "kind").agg(F.sum("score").alias("mass"))
        conf = checkpointed(mass.join(support, "context").select(
            "context", "kind", "support",
            (F.round(F.col("mass") / (F.col("support") + F.lit(PRIOR)), 12)).alias("confidence")))
        found = edges.join(conf.where(f"support >= {MIN_SUPPORT} and confidence >= {MIN_CONFIDENCE}"), "context")
        found = found.groupBy("value").agg(F.max(F.struct("confidence", "kind")).alias("b"))
        found = found.join(seeds, "value", "left_anti").select(
            "value", F.col("b.kind").alias("kind"), F.col("b.confidence").alias("score"))
        scores = seeds.withColumn("score", F.lit(1.0)).unionByName(found)
    return conf.where(f"support >= {MIN_SUPPORT} and confidence >= {MIN_CONFIDENCE}")


def _blocks(df: DataFrame, key: str):
    """The rows of a small table, as lists of about PATTERN_BLOCK rows at most."""
    n = max(1, -(-df.count() // PATTERN_BLOCK))
    for i in range(n):
        yield df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i).collect()


def _context_counts(docs: DataFrame, contexts: list[str]) -> DataFrame:
    """(context, n): how often the two words stand next to each other in all texts."""
    sent = docs.sparkSession.sparkContext.broadcast(
        (frozenset(contexts), frozenset(c.rpartition(" ")[2] for c in contexts)))

    def run(batches):
        wanted, lasts = sent.value
        seen: Counter = Counter()
        plain: dict[str, str] = {}
        for b in batches:
            for text in texts_of(b.column(0)):
                if not text:
                    continue
                words = text.split()
                for w in set(words).difference(plain):
                    if len(plain) > 60_000:
                        plain.clear()
                    plain[w] = _plain(w.lstrip(_QUOTES))
                for i, w in enumerate(words):
                    if i and plain.get(w, w) in lasts:
                        c = f"{_plain(words[i - 1])} {_plain(w)}"
                        if c in wanted:
                            seen[c] += 1
        plain.clear()
        give_back()
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["context", "n"])

    return docs.select("text").mapInArrow(run, "context string, n long").groupBy("context").agg(F.sum("n").alias("n"))


def learn_patterns(docs: DataFrame) -> DataFrame:
    """(context, kind, support, confidence, cue): the accepted patterns of this corpus."""
    with_workers(docs.sparkSession)
    occ = checkpointed(_occurrences(docs).groupBy("context", "value", "kind").agg(F.count(F.lit(1)).alias("n")))
    best = _confident(occ.select("context", "value", "kind"))
    best = best.groupBy("context").agg(F.max(F.struct("confidence", "support", "kind")).alias("b"))
    best = checkpointed(best.select("context", F.col("b.kind").alias("kind"), F.col("b.support").alias("support"),
                                    F.col("b.confidence").alias("confidence")))
    followed = occ.groupBy("context").agg(F.sum("n").alias("followed"))
    total = None
    for rows in _blocks(best, "context"):
        if rows:
            part = _context_counts(docs, [r["context"] for r in rows])
            total = part if total is None else total.unionByName(part)
    if total is None:
        return best.withColumn("cue", F.lit(0.0)).limit(0)
    cue = F.col("followed") / F.greatest(F.col("n"), F.col("followed"))
    out = best.join(total, "context").join(followed, "context").withColumn("cue", cue)
    return checkpointed(out.where(f"cue >= {MIN_CUE}").select("context", "kind", "support", "confidence", "cue"))


def _text_spans(text: str, kinds: dict[str, str], before: str | None) -> tuple[str, str]:
    base = base_spans(text)
    spans = list(base)
    if before is not None:
        spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in before.split(",") if x)]
    if kinds:
        named = [(s, e, kinds[c]) for s, e, c in instances(text, base)
                 if c in kinds and SHAPES[kinds[c]].fullmatch(text, s, e)]
        free = set(_apart([x[:2] for x in named], sorted(x[:2] for x in spans)))
        spans += [x for x in named if x[:2] in free]
    spans.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    join = lambda xs: ",".join(f"{k}:{s}:{e}" for s, e, k in xs)
    return join(base), join(spans)


def _finder(sent):
    @F.pandas_udf("base string, spans string")
    def find(texts: pd.Series, before: pd.Series) -> pd.DataFrame:
        kinds = sent.value
        return pd.DataFrame([_text_spans(t or "", kinds, b) for t, b in zip(texts, before, strict=True)],
                            columns=["base", "spans"])

    return find


def with_spans(docs: DataFrame, patterns: DataFrame, text: str = "text",
               base: str = "base_spans", spans: str = "spans") -> DataFrame:
    """``docs`` with the base spans and all spans, ``kind:start:end`` joined by commas
    (code points, end exclusive), by start, then kind."""
    with_workers(docs.sparkSession)
    own = [c for c in docs.columns if c not in (base, spans)]
    d = docs.select(*own).withColumn("_f", F.lit(None).cast("struct<base:string,spans:string>"))
    for rows in _blocks(patterns, "context"):
        sent = docs.sparkSession.sparkContext.broadcast({r["context"]: r["kind"] for r in rows})

        d = d.withColumn("_f", _finder(sent)(F.col(text), F.col("_f.spans")))
    return d.select(*own, F.col("_f.base").alias(base), F.col("_f.spans").alias(spans))


def mask_text(text: str | None, spans: str) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans
    the first stands for all."""
    if not text or not spans:
        return text
    out, at = [], 0
    for x in spans.split(","):
        kind, s, e = x.split(":")
        s, e = int(s), int(e)
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with all found spans masked in ``text`` and ``n_chars`` recounted."""
    @F.pandas_udf("string")
    def mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([mask_text(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    d = with_spans(d, learn_patterns(docs)).withColumn("_new", mask(F.col("text"), F.col("spans")))
    new = {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("spans") == "", F.col("_row.n_chars")).otherwise(
            F.length("_new").cast(docs.schema["n_chars"].dataType))
    return d.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
