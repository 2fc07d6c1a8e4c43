"""SimHash near-duplicates with a pigeonring filter (operator 7).

Method: a fingerprint is cut into ``max_bits + 1`` segments laid in a ring.
If two fingerprints differ in at most ``max_bits`` bits, some segment
starts a chain in which, for every length l, the first l segments together
differ in at most l * max_bits / segments bits.  So the first segment of
the chain is equal (these equal segments are the buckets candidates come from) and
the chain's running sums are checked within their budgets before the full
Hamming check.

Only distinct fingerprints are compared.  A bucket of at most ``most``
fingerprints is compared in one task, which hands on a spanning forest of
its links, not all pairs.  The fingerprints of a larger bucket are dealt
once more, by every value at most ``max_bits / 2`` bits away outside the
equal segment: two that are linked share such a midpoint, all that share
one are linked or, for an odd max_bits, checked.  Those groups are bounded by
the fingerprint's width, so no task grows with a bucket and no link is lost.

Defined results: null or blank text has fingerprint zero; repeated rows
stay, with the same component; an empty table gives an empty result; rows
with a null id get the smallest non-null id of their component, if any.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.common import Rows, cut, fresh_name, salted_join
from fundlake.llm.components import connected_components

SEED = 42
BITS = 64


def shingle_hashes(text: bytes, length: int) -> np.ndarray:
    """XXH64 of the text's word shingles, repeats included; A-Z lower-cased, words
    are separated by ASCII blanks."""
    words = text.lower().split()
    if len(words) < length:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(length))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in shingles), np.uint64)


def fingerprint(text: bytes, length: int) -> int:
    h = shingle_hashes(text, length)
    if not len(h):
        return 0
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(h), 8192):
        part = h[k:k + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprint_column(text_col, length: int = 3):
    """The SimHash fingerprint as a signed 64-bit number."""

    @arrow_udf("bigint")
    def fingerprinted(texts: pa.Array) -> pa.Array:
        out = [fingerprint(t, length) for t in texts.to_pylist()]
        return pa.array(np.array(out, np.uint64).view(np.int64), pa.int64())

    return fingerprinted.asNondeterministic()(F.coalesce(text_col, F.lit("")).cast("binary"))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the ring's segments."""
    n = max_bits + 1
    widths = [BITS // n + (i < BITS % n) for i in range(n)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def chain_links(bucket: np.ndarray, first: int, ring: list[tuple[int, int]], max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links in a bucket of distinct fingerprints that share
    segment ``first``, as pairs of positions."""
    n = len(ring)
    masks = [np.uint64(((1 << w) - 1) << s) for s, w in ring[first:] + ring[:first]]
    left = np.arange(1, len(bucket))
    front, links = [0], []
    while len(left):
        if not front:
            front, left = [int(left[0])], left[1:]
            continue
        at = front.pop()
        differ = bucket[left] ^ bucket[at]
        near = np.arange(len(left))
        total = np.zeros(len(left), np.int64)
        for k in range(1, n):  # the chain's running sums, within k + 1 segments' share
            total = total[: len(near)] + np.bitwise_count(differ[near] & masks[k])
            keep = total <= (k + 1) * max_bits // n
            near, total = near[keep], total[keep]
        near = near[np.bitwise_count(differ[near]) <= max_bits]
        links += [(at, int(left[i])) for i in near]
        front += left[near].tolist()
        left = np.delete(left, near)
    return links


def fingerprint_links(prints: DataFrame, max_bits: int = 2, most: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``, one row each) that
    differ in at most ``max_bits`` bits: enough of them to keep every pair connected."""
    ring = segments(max_bits)
    value = lambda s, w: F.shiftrightunsigned(F.col("fp"), s).bitwiseAND(F.lit((1 << w) - 1))
    if max_bits == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    keys = prints.select("fp", F.posexplode(F.array(*[value(s, w) for s, w in ring])).alias("seg", "val"))
    sizes = keys.groupBy("seg", "val").count().filter("count > 1")
    shared = cut(keys.join(sizes, ["seg", "val"]), "buckets")
    buckets = shared.filter(F.col("count") <= most).groupBy("seg", "val").agg(F.collect_list("fp").alias("fps"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(schema)
        for batch in batches:
            for seg, fps in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.sort(fps.values.to_numpy())
                for i, j in chain_links(own.view(np.uint64), seg, ring, max_bits):
                    rows.add(int(own[i]), int(own[j]))
                if rows.full():
                    yield rows.take()
        yield rows.take()

    small = buckets.select("seg", "fps").mapInArrow(linked, "a long, b long")
    large = shared.filter(F.col("count") > most)
    if large.isEmpty():
        return small
    return small.unionByName(midpoint_links(large, ring, max_bits))


def midpoint_links(members: DataFrame, ring: list[tuple[int, int]], max_bits: int) -> DataFrame:
    """Links inside large buckets (rows seg, fp), by shared midpoints outside the segment."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    flips = []
    for s, w in ring:
        free = [b for b in range(BITS) if not s <= b < s + w]
        flips.append(F.array(*[F.lit(signed(sum(1 << b for b in some))).cast("long")
                               for r in range((max_bits + 1) // 2 + 1) for some in combinations(free, r)]))
    masks = F.element_at(F.array(*flips), F.col("seg") + 1)
    near = members.select("seg", "fp", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))).alias("mid"))
    groups = near.groupBy("seg", "mid").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    if max_bits % 2 == 0:  # within max_bits / 2 of one midpoint: linked
        return groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    pairs = groups.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
    return pairs.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """(id, fp, fingerprint as 16 hex digits, component_id) per input row."""
    docs = cut(df.select(F.col(id_col).cast("long").alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")),
               "fingerprints")
    prints = cut(docs.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(prints.select("fp"), max_bits), "a", "b")
    linked = roots.join(prints, roots["node"] == prints["fp"]).select("fp", "root", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component"))
    classes = linked.join(smallest, "root").select("fp", "component")
    labels = prints.join(classes, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    # exact copies share a fingerprint: one that many rows have is dealt over several tasks
    return salted_join(docs, labels, ["fp"]).select(
        F.col("id").alias(id_col), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 2) -> DataFrame:
    """The rows of df, one per component: that of the smallest id, unknown ids last, then of
    the smallest fingerprint and text hash (any one of rows equal in id and text).  Components
    are told apart by fingerprint, so rows without an id and texts under one id count each."""
    text_hash = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    docs = cut(df.select(F.col(id_col).cast("long").alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp"),
                         text_hash.alias("hash")), "fingerprints")
    least = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "hash", "n")).alias("r")
    prints = cut(docs.groupBy("fp", "id", "hash").agg(F.count("*").alias("n")).groupBy("fp").agg(least), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(prints.select("fp"), max_bits), "a", "b")
    first = F.min(F.struct("r.unknown", "r.id", "fp", "r.hash", "r.n")).alias("c")
    chosen = cut(prints.join(roots, prints["fp"] == roots["node"], "left").groupBy(F.coalesce("root", "fp").alias("root"))
                 .agg(first).select(F.col("c.id").alias("_kept"), F.col("c.hash").alias("_kept_hash"), "c.n"), "chosen")
    name = fresh_name(df.columns, "_text_hash")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_kept")) & (F.col(name) == F.col("_kept_hash"))
    kept = df.withColumn(name, text_hash).join(chosen.select("_kept", "_kept_hash"), same, "left_semi")
    repeated = not chosen.filter("n > 1").isEmpty()
    return (kept.dropDuplicates([id_col, name]) if repeated else kept).drop(name)
