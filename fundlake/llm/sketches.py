"""Bottom-k sketches of documents (operator 6).

Method: the words of a text (A-Z lower-cased, cut at ASCII blanks) are hashed, five
neighbours are combined into a shingle hash, and the k smallest distinct
shingle hashes are the sketch.  Sketches of parts merge into the sketch of the union.
A sketch with fewer than k hashes holds all shingles, so small documents are
compared exactly; else the k smallest of the union estimate resemblance, and the
k-th smallest hash estimates the distinct shingle count.

Defined results: null text counts as empty; a text of fewer than five words
has its whole word sequence as one shingle, an empty one no shingles; two
empty sketches are alike (1.0), an empty and another one are not (0.0);
repeated rows stay; equal ids are ordered by the text's hash; null ids come
last in descending order; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.common import Rows, in_key_order, quoted

K, SHINGLE = 256, 5
_ODD = 0x9E3779B97F4A7C15  # 2**64 / golden ratio, odd


def shingle_hashes(text: bytes, length: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(length, len(w))
    total = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):  # order matters: multiply, then add the next word
        total *= np.uint64(_ODD)
        total += w[i:len(w) - n + 1 + i]
    # spread the bits, so that small hashes are a fair sample
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(29)
    total *= np.uint64(0x94D049BB133111EB)
    total ^= total >> np.uint64(32)
    return total


def smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct hashes, ascending."""
    while len(hashes) > 16 * k:  # only what can be among them, unless repeats get in the way
        part = np.partition(hashes, 8 * k)[:8 * k]
        distinct = np.unique(part)
        if len(distinct) >= k:
            return distinct[:k]
        hashes = np.unique(hashes)
        break
    return np.unique(hashes)[:k]


def sketch(text: bytes, k: int = K, length: int = SHINGLE) -> np.ndarray:
    return smallest(shingle_hashes(text, length), k)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Part of common shingles among all shingles of both."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, common, assume_unique=True).sum() / len(union))


def distinct_count(a: np.ndarray, k: int = K) -> float:
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Part of a's shingles that b has too."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return float(min(1.0, both / distinct_count(a, k)))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def sketch_column(text_col, k: int = K, length: int = SHINGLE):
    """The sketch as text."""

    @arrow_udf("string")
    def column(texts: pa.Array) -> pa.Array:
        return pa.array([to_text(sketch(t, k, length)) for t in texts.to_pylist()], pa.string())

    return column.asNondeterministic()(F.coalesce(text_col, F.lit("")).cast("binary"))


def merged_by(df: DataFrame, group: str, sketch_col: str, k: int = K) -> DataFrame:
    """(group, sketch, n_shingles): the union's sketch per group.  Every task merges its
    own rows first, so a large group sends one sketch per task, not one per row."""
    schema = pa.schema([(group, pa.string()), ("sketch", pa.string()), ("n_shingles", pa.float64())])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = Rows(schema), {}

        def out():
            for g, a in held.items():
                rows.add(g, to_text(a), distinct_count(a, k), size=8 * k)
            held.clear()
            return rows.take()

        for batch in batches:
            for g, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a = from_text(s)
                held[g] = merge(held[g], a, k) if g in held else a
                if len(held) > 10_000:
                    yield out()
        yield out()

    shape = f"{quoted(group)} string, sketch string, n_shingles double"
    rows = df.select(F.col(group).cast("string").alias(group), F.col(sketch_col).alias("sketch")).filter("sketch is not null")
    parts = rows.mapInArrow(merged, shape).select(group, "sketch")
    dealt = parts.repartition(F.col(group)).sortWithinPartitions(group)
    return dealt.mapInArrow(lambda b: _merge_sorted(b, schema, k), shape)


def _merge_sorted(batches: Iterator[pa.RecordBatch], schema: pa.Schema, k: int) -> Iterator[pa.RecordBatch]:
    """One row per group of rows that lie side by side."""
    rows, now, held = Rows(schema), None, None
    for batch in batches:
        for g, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a = from_text(s)
            if held is not None and g == now:
                held = merge(held, a, k)
                continue
            if held is not None:
                rows.add(now, to_text(held), distinct_count(held, k), size=8 * k)
            now, held = g, a
            if rows.full():
                yield rows.take()
    if held is not None:
        rows.add(now, to_text(held), distinct_count(held, k))
    yield rows.take()


def dealt_with_next(df: DataFrame) -> DataFrame:
    """Rows (id, text) dealt by descending id so that in each partition every row is
    followed by its successor; the last row of a partition is a copy (borrowed = 1) of the
    first row after it, or of the very first row at the end."""
    rows, n, at = in_key_order(df, "id")
    tops = rows.groupBy(at).agg(F.max("id").alias("top")).orderBy(at).collect()  # a row per range
    if not tops:
        return rows.select("id", "text", F.lit(0).alias("borrowed"))
    lower = [r["top"] for r in tops]
    # the range above a range needs its first row; the lowest range needs the very first one
    wanted = [(r[at], lower[i - 1] if i else lower[-1]) for i, r in enumerate(tops)]
    to: dict = {}
    for target, top in wanted:
        to.setdefault(top, []).append(target)
    own = f"struct({quoted(at)} AS part, 0 AS borrowed)"
    extra = " ".join(
        f"WHEN {'id IS NULL' if top is None else f'id = {top}L'} THEN array({own}, "
        + ", ".join(f"struct({t} AS part, 1 AS borrowed)" for t in targets) + ")" for top, targets in to.items())
    known = ", ".join(f"{t}L" for t in to if t is not None)
    case = f"CASE WHEN id IS NOT NULL {f'AND id NOT IN ({known})' if known else ''} THEN array({own}) {extra} ELSE array({own}) END"
    dealt = rows.select("id", "text", F.explode(F.expr(case)).alias("p"))
    return (dealt.select("id", "text", "p.part", "p.borrowed").repartitionById(n, F.col("part"))
            .withColumn("tie", F.xxhash64("text"))
            .sortWithinPartitions("borrowed", F.col("id").desc_nulls_last(), "tie").select("id", "text", "borrowed"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                 length: int = SHINGLE) -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_shingles, in_edited.  The edited text has its last half
    replaced by the beginning of the next document in descending order of the id."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = pa.schema([(id_col, pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64()), ("n_shingles", pa.float64()), ("in_edited", pa.float64())])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, before = Rows(schema), None
        for batch in batches:
            for doc, text, borrowed in zip(*(c.to_pylist() for c in batch.columns)):
                if before is not None and before[3]:
                    break  # the copy that ends the partition, and rows that share its id
                own = sketch(text.encode(), k, length)
                if before is not None:
                    doc0, text0, own0, _ = before
                    half = len(text0) // 2
                    edited = (text0[:len(text0) - half] + text[:half]).encode()
                    new = sketch(edited, k, length)
                    out.add(doc0, len(text0), hashlib.sha256(edited).hexdigest(), to_text(own0), to_text(new),
                            resemblance(own0, new, k), resemblance(own0, own, k), distinct_count(own0, k),
                            containment(own0, new, k), size=24 * k)
                before = doc, text, own, borrowed
                if out.full():
                    yield out.take()
        yield out.take()

    shape = (f"{quoted(id_col)} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, n_shingles double, in_edited double")
    return dealt_with_next(rows).mapInArrow(compared, shape)
