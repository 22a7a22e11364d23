"""Sharding by histogram sort: equal bytes per shard, one exchange.

The sort key is the hash of the text, then of the id, as 32 hexadecimal digits, so
equal texts are neighbours and only a shard boundary can part them.  Splitters are
found without sorting: bytes are summed by the key's leading digits, each splitter's
wanted byte count falls into one bucket, and only rows of those buckets are summed
again on their next digits, until the bucket is within the tolerance (or a single key).  A pass collects at
most 4096 sums per splitter, whatever the input's size.  Then comparisons with the
splitters give every row its shard, and one exchange numbers the rows of each shard.

Slots are gapless from 0 within a shard; they are given chunk by chunk (chunks are
dealt by a hash of the row), not in key order, so no task sees a whole shard.

Defined cases: null text = empty text (size 1); null or equal ids are keys like others;
rows equal in id and text share a key and stay in one shard; an empty table gives an
empty result; other columns, whatever their names, are not touched.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, gapless_positions, text_of

DIGITS = 3
TOLERANCE = 0.0005


def sort_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """32 hexadecimal digits: hash of the text, then hash of the id."""
    return F.concat(*[F.lpad(F.lower(F.hex(F.xxhash64(c))), 16, "0") for c in (text_of(text), F.col(doc_id))])


def splitters(rows: DataFrame, shards: int, total: int, tolerance: float = TOLERANCE) -> list[str]:
    """The ``shards - 1`` keys at which the bytes of ``rows`` (key, size) part evenly.

    A boundary is off by at most half of ``tolerance * total / shards`` bytes, or half a single key's bytes.
    """
    allowed = tolerance * total / shards
    found: dict[int, str] = {}
    # splitter -> (digits fixed so far, bytes below them)
    open_ = {i: ("", 0) for i in range(1, shards)} if total else {}
    depth = 0
    while open_:
        depth += DIGITS
        parents = sorted({p for p, _ in open_.values()})
        part = rows if depth == DIGITS else rows.where(F.substring("key", 1, depth - DIGITS).isin(parents))
        sums = part.groupBy(F.substring("key", 1, depth).alias("p")).agg(
            F.sum("size").alias("b"), (F.min("key") == F.max("key")).alias("one")).collect()
        inside: dict[str, list[tuple[str, int, bool]]] = {}
        for r in sorted((r["p"], r["b"], r["one"]) for r in sums):
            inside.setdefault(r[0][:depth - DIGITS], []).append(r)
        for i, (parent, below) in list(open_.items()):
            want = total * i / shards
            for p, b, one in inside[parent]:
                if below + b >= want:
                    break
                below += b
            if one or b <= allowed:
                # the nearer edge of the bucket: before it, or after all keys that begin so
                found[i] = p if want - below <= below + b - want else p + "~"
                del open_[i]
            else:
                open_[i] = (p, below)
    return [found[i] for i in sorted(found)]


def sharded(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, size, text_crc32, key, shard, slot) of every row; size is UTF-8 bytes plus 1."""
    d = docs.select("doc_id", (F.octet_length(text_of()) + 1).cast("long").alias("size"),
                    F.crc32(text_of().cast("binary")).alias("text_crc32"), sort_key().alias("key"))
    d = checkpointed(d)
    n, total = d.agg(F.count(F.lit(1)), F.sum("size")).first()
    cuts = splitters(d.select("key", "size"), shards, total or 0, tolerance)
    shard = F.lit(0)
    for c in cuts:
        shard = shard + (F.col("key") >= F.lit(c)).cast("int")
    return gapless_positions(d.withColumn("shard", shard.cast("int")), ["shard"],
                             F.xxhash64("key", "text_crc32"), ["key", "text_crc32"], "slot", n)


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """The rows of ``docs`` as Parquet folders ``shard=0`` .. ``shard=n-1``, in key order inside each file."""
    d = docs.withColumn("_key", sort_key())
    rows = d.select((F.octet_length(text_of()) + 1).alias("size"), F.col("_key").alias("key"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    shard = F.lit(0)
    for c in splitters(rows, shards, total):
        shard = shard + (F.col("_key") >= F.lit(c)).cast("int")
    d = d.withColumn("shard", shard).repartitionByRange("shard", "_key")
    d.sortWithinPartitions("shard", "_key").drop("_key").write.partitionBy("shard").parquet(path)
