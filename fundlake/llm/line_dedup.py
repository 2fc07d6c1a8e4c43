"""Dropping lines that many documents share, by a sharded minimal perfect hash (operator 11).

Method: a line's key is hashed to 128 bits.  Every document gives each of its
distinct line hashes once; Spark adds them up, partial sums first, so every distinct
hash has the number of documents that hold it.  The distinct hashes are dealt into
shards of about ``SHARD_KEYS``.  A shard is a minimal perfect hash: in level after level the
hashes that fall alone into a slot of the level's bit array are placed, the
others go on to the next level.  A placed hash's number is the rank of its bit, and under
that number the shard keeps two compact arrays: a 16-bit fingerprint and the count,
in the narrowest whole-number type that holds the shard's counts.

Documents probe the arrays; lines are never joined.  A probe is one distinct line hash of
a document, sent to the shard's task, which streams the probes of a shard past its arrays and hands on
those whose count reaches ``min_docs``.  A hash of the index is always found at its own place, so
its count is exact; a hash that is not in the index (another corpus
is probed) is taken for one that is with probability 2 ** -16 at most.

Skew: a line of a third of all documents is one index entry, but many
probes go to its shard.  A shard with more than a thousandth of all
probes is copied and its probes are dealt to the copies by text.  Texts are told apart by hash
too: exact copies in a batch probe once.  Documents meet their lines to drop by text hash, and a text
held by more than a thousandth of all rows is dealt over as many tasks as it has thousandths.

Defined results: every row is a document, repeated rows and rows without an id too; a null or
empty text is one empty line; keys under ``min_chars`` code points are never dropped; an empty table gives no
rows; columns besides id and text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.common import Rows, cut, salted_join

BLANKS = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 1 << 16
#: Slots per hash in each level of a shard.
GAMMA = 1.7
#: Distinct hashes that a task holds before it hands on their partial counts.
HELD = 1 << 18
FINGERPRINT = "<u2"


def key_of(line: bytes) -> bytes:
    """The line without blanks at both ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def line_hashes(text: bytes, min_chars: int) -> list[bytes | None]:
    """The 128-bit hash of every line's key, None for keys that are too short."""
    out = []
    for line in text.split(b"\n"):
        key = key_of(line)
        long_enough = len(key) >= min_chars if min_chars <= 1 else len(key.decode()) >= min_chars
        out.append(xxhash.xxh3_128_digest(key) if long_enough else None)
    return out


def halves(digests) -> np.ndarray:
    """The two 64-bit halves of every digest, as rows of an int64 array."""
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def text_keys(text) -> list:
    """Two 64-bit hashes of a text, as columns: texts are told apart by both."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


# --- one shard -----------------------------------------------------------
def mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of both halves for a level (wrapping arithmetic)."""
    x = b * np.uint64(0x9E3779B97F4A7C15) + np.uint64((level * 0xD1B54A32D192ED03 + 1) % (1 << 64))
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = ((x ^ a) ^ ((x ^ a) >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys[:, 0], keys[:, 1], level) % np.uint64(size)).astype(np.int64)


class Shard:
    """Minimal perfect hash of distinct 128-bit keys with fingerprint and count arrays."""

    def __init__(self, sizes: list[int], bits: np.ndarray, prints: np.ndarray, counts: np.ndarray):
        self.sizes, self.bits, self.prints, self.counts = sizes, bits, prints, counts
        self.rank = np.cumsum(bits) - 1

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> Shard:
        """keys: uint64 rows of two, all different."""
        left, levels, placed = np.arange(len(keys)), [], []
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            at = slots(keys[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            good = alone[at]
            placed.append((left[good], at[good] + sum(map(len, levels))))
            levels.append(alone)
            left = left[~good]
        bits = np.concatenate([*levels, np.zeros(0, bool)])
        shard = cls([len(x) for x in levels], bits, np.zeros(len(keys), FINGERPRINT), np.zeros(len(keys), np.int64))
        for who, slot in placed:
            number = shard.rank[slot]
            shard.prints[number] = cls.fingerprint(keys[who])
            shard.counts[number] = counts[who]
        return shard

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (keys[:, 1] >> np.uint64(48)).astype(FINGERPRINT)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """The count of every key, 0 for one that the fingerprints refuse."""
        out, left, base = np.zeros(len(keys), np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = slots(keys[left], level, size) + base
            here = self.bits[at]
            number, who = self.rank[at[here]], left[here]
            same = self.prints[number] == self.fingerprint(keys[who])
            out[who[same]] = self.counts[number[same]]
            left, base = left[~here], base + size
        return out

    def stored(self) -> tuple[list[int], bytes, bytes, int, bytes]:
        most = int(self.counts.max(initial=0))
        width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - (w == 8)))
        return (self.sizes, np.packbits(self.bits).tobytes(), self.prints.tobytes(), width,
                self.counts.astype(f"<u{width}").tobytes())

    @classmethod
    def load(cls, sizes, bits: bytes, prints: bytes, width: int, counts: bytes) -> Shard:
        flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        return cls(list(sizes), flags, np.frombuffer(prints, FINGERPRINT), np.frombuffer(counts, f"<u{width}"))


SHELF = "struct<sizes:array<int>,bits:binary,prints:binary,width:int,counts:binary>"
SHELF_ARROW = pa.struct([("sizes", pa.list_(pa.int32())), ("bits", pa.binary()), ("prints", pa.binary()),
                         ("width", pa.int32()), ("counts", pa.binary())])


# --- the index -----------------------------------------------------------
def document_counts(df: DataFrame, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, n): every distinct line hash and the number of rows whose text holds it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def take():
            h, n = halves(seen), np.fromiter(seen.values(), np.int64, len(seen))
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(n)], ["h1", "h2", "n"])

        for batch in batches:
            for text in batch.column(0):
                seen.update({h for h in line_hashes(text.as_py(), min_chars) if h is not None})
                if len(seen) >= HELD:
                    yield take()
        yield take()

    texts = df.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(counted, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def build_index(df: DataFrame, text_col: str = "text", min_chars: int = 1, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(shard, shards, keys, probes, shelf): the sharded index over all distinct line hashes of df,
    stored in the shared folder.  ``probes`` is how often the documents of df will probe the shard."""
    lines = cut(document_counts(df, text_col, min_chars), "line-counts")
    shards = max(1, -(-lines.count() // shard_keys))
    schema = pa.schema([("shard", pa.int64()), ("keys", pa.int64()), ("probes", pa.int64()), ("shelf", SHELF_ARROW)])

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def close():
            h1, h2, n = (np.concatenate(c) for c in zip(*parts))
            shard = Shard.build(np.column_stack([h1, h2]).view(np.uint64), n)
            shelf = dict(zip((f.name for f in SHELF_ARROW), shard.stored()))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (now, len(n), int(n.sum()), shelf), schema)], schema=schema)

        for batch in batches:
            shard, *cols = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if now is not None and shard[a] != now:
                    yield close()
                    parts = []
                now = int(shard[a])
                parts.append([c[a:b] for c in cols])
        if parts:
            yield close()

    dealt = (lines.select(F.pmod("h1", F.lit(shards)).alias("shard"), "h1", "h2", "n")
             .repartition("shard").sortWithinPartitions("shard"))
    index = dealt.mapInArrow(built, f"shard long, keys long, probes long, shelf {SHELF}")
    return cut(index.withColumn("shards", F.lit(shards).cast("long")), "line-index")


def frequent_lines(df: DataFrame, index: DataFrame, min_docs: int, text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(t1, t2, dropped): for every text of df that has some, the hashes of its lines that are in
    at least ``min_docs`` documents of the index."""

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["t1", "t2", "h1", "h2"]
        for batch in batches:
            keys = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:2]])
            found, who, met = [], [], set()
            for i, (key, text) in enumerate(zip(map(tuple, keys.tolist()), batch.column(2))):
                if key in met:
                    continue
                met.add(key)
                own = {h for h in line_hashes(text.as_py(), min_chars) if h is not None}
                found += own
                who.append(np.full(len(own), i))
                if len(found) >= HELD:
                    yield _columns(names, keys[np.concatenate(who)], halves(found))
                    found, who = [], []
            if found:
                yield _columns(names, keys[np.concatenate(who)], halves(found))

    shards = index.select("shards").first()
    n = shards[0] if shards else 1
    texts = F.coalesce(F.col(text_col), F.lit(""))
    asked = df.select(*text_keys(texts), texts.cast("binary")).mapInArrow(probes, "t1 long, t2 long, h1 long, h2 long")
    asked = asked.withColumn("shard", F.pmod("h1", F.lit(n)))
    # at most a thousand shards have more than a thousandth of all probes
    total = max(1, index.agg(F.sum("probes").alias("s")).first()["s"] or 0)
    parts = F.ceil(F.col("probes") * 1000 / total).cast("int")
    hot = index.filter(F.col("probes") * 1000 > total).filter(F.lit(n) > 1).select("shard", parts.alias("parts"))
    asked = asked.join(F.broadcast(hot), "shard", "left")
    asked = asked.select("shard", F.pmod("t1", F.coalesce("parts", F.lit(1))).alias("part"), F.lit(1).alias("kind"),
                         "t1", "t2", "h1", "h2", F.lit(None).cast(SHELF).alias("shelf"))
    none = F.lit(None).cast("long")
    held = index.join(F.broadcast(hot), "shard", "left").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)).alias("part"),
        F.lit(0).alias("kind"), *[none.alias(c) for c in ("t1", "t2", "h1", "h2")], "shelf")
    met = asked.unionByName(held).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = None, None
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            group = np.column_stack([cols[c].to_numpy(zero_copy_only=False) for c in ("shard", "part", "kind")])
            edges = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1), len(group)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                *place, kind = group[a].tolist()
                if kind == 0:
                    shard, at = Shard.load(**cols["shelf"][a].as_py()), place
                    continue
                if place != at:  # no line of this shard is in the index
                    continue
                t1, t2, h1, h2 = (cols[c].slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                                  for c in ("t1", "t2", "h1", "h2"))
                keys = np.column_stack([h1, h2])
                hit = shard.probe(keys.view(np.uint64)) >= min_docs
                digests = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(16), int(hit.sum()), [None, pa.py_buffer(np.ascontiguousarray(keys[hit]))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(t1[hit]), pa.array(t2[hit]), digests], ["t1", "t2", "h"])

    hits = met.mapInArrow(probed, "t1 long, t2 long, h binary")
    return hits.groupBy("t1", "t2").agg(F.collect_set("h").alias("dropped"))


def _columns(names: list[str], *blocks: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for x in blocks for c in x.T], names)


# --- documents -----------------------------------------------------------
def drop_lines(df: DataFrame, index: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 1) -> DataFrame:
    """(<id_col>, n_lines, n_dropped, kept): every row of df without the lines that at least
    ``min_docs`` documents of the index hold."""

    @arrow_udf("struct<n_lines:bigint,n_dropped:bigint,kept:string>")
    def kept(texts: pa.Array, drops: pa.Array) -> pa.Array:
        schema = pa.schema([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])
        rows = Rows(schema)
        for text, drop in zip(texts, drops):
            text, drop = text.as_py(), drop.as_py()
            if drop is None:
                rows.add(text.count(b"\n") + 1, 0, text)
                continue
            bad = set(drop)
            lines = text.split(b"\n")
            stay = [x for x, h in zip(lines, line_hashes(text, min_chars)) if h not in bad]
            rows.add(len(lines), len(lines) - len(stay), b"\n".join(stay))
        counts = [pa.array(c, pa.int64()) for c in rows.columns[:2]]
        return pa.StructArray.from_arrays([*counts, pa.array(rows.columns[2], pa.binary()).cast(pa.string())], fields=list(schema))

    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), text.alias("text"), *text_keys(text))
    drops = frequent_lines(df, index, min_docs, text_col, min_chars)
    both = salted_join(docs, drops, ["t1", "t2"])
    out = both.select("id", kept.asNondeterministic()(F.col("text").cast("binary"), F.col("dropped")).alias("r"))
    return out.select(F.col("id").alias(id_col), "r.n_lines", "r.n_dropped", "r.kept")


def dedup(df: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """``drop_lines`` of df by the index of its own lines."""
    return drop_lines(df, build_index(df, text_col, min_chars), min_docs, id_col, text_col, min_chars)
