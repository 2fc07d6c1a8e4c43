"""Periodic runs of words, found per period octave (operator 13).

A run is a stretch of consecutive words in which words ``q`` apart are equal, q the
smallest such number, of length at least ``max(shortest, 3 * q)``, that no neighbouring word extends.

Method: for period q call position i a match if the words i and i + q are equal.  A run of
period q and length n is a stretch of n - q >= 2 * q matches.  Periods are parted into octaves
[B, 2B) (the first octave has all periods under 16, B = 8), and every octave lays
its own tiles of B positions.  A stretch that long covers one whole tile at least.  A
tile is solved alone: it sees the B words before it and the 3B words after its start, and gives for every period of its octave
that matches all over the tile the fragment of the stretch that it sees.  Windows
of B words have 64-bit names (a pair of names of half the length, mixed), so one comparison of
names per tile and period tells which tiles match all over.  The fragment's ends come from two Z-functions at the tile
boundaries, one forward, one on the words turned round.  Neighbouring tiles that both match all over
are one fragment at once, so the Z-functions are needed only where such a chain begins and ends.

Distribution: documents of up to ``span`` words are tiled and solved inside the scan's task, many
documents behind one another with a word of its own between them.  A longer document is
exploded into overlapping spans of tiles per octave, which are dealt out over the tasks.
The fragments of a document and period are then shuffled together and stitched:
fragments that overlap are one stretch.  Documents without any fragment are done and meet no shuffle. Of equal stretches the smallest period stays (two periods of a
stretch that long have their greatest common divisor as a period too).

A word is dropped from the collapsed text if a run holds it after the run's first q words.

Defined results: words are split at ASCII blanks; a null, empty or blank text has no words, no runs and
an empty collapsed text; every row stands for itself, repeated rows and rows without an id too; an empty
table gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.common import Rows, cut

SHORTEST, SPAN = 24, 1 << 16
#: Words of documents that are solved together.
HELD = 1 << 17
FIRST = 8


def octaves(longest: int) -> Iterator[tuple[int, int, int]]:
    """(B, least period, greatest period) of the octaves that a text of so many words needs."""
    size = FIRST
    while size == FIRST or 3 * size <= longest:
        yield size, (1 if size == FIRST else size), 2 * size - 1
        size *= 2


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doubled(names: np.ndarray, size: int) -> np.ndarray:
    """Names of the windows of 2 * size words from those of the windows of size words."""
    return mixed(names[:-size] * np.uint64(0x9E3779B97F4A7C15) + mixed(names[size:] + np.uint64(size)))


def z_function(s: list) -> list[int]:
    """z[i]: how many first elements of s the elements from i on repeat; z[0] is len(s)."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


class Boundaries:
    """How far matches reach from a tile boundary, at most B positions, for every period of the octave."""

    def __init__(self, words: np.ndarray, size: int):
        self.words, self.size = words, size
        self.ahead: dict[int, list[int]] = {}
        self.back: dict[int, list[int]] = {}

    def after(self, at: int, period: int) -> int:
        """Matches at positions at, at + 1, ..."""
        if at not in self.ahead:
            self.ahead[at] = z_function(self.words[at:at + 3 * self.size].tolist())
        z = self.ahead[at]
        return min(z[period], self.size) if period < len(z) else 0

    def before(self, at: int, period: int) -> int:
        """Matches at positions at - 1, at - 2, ..."""
        if at not in self.back:
            # turned round: the words before the boundary, a mark, the words up to 2B after it
            low, high = max(0, at - self.size), min(len(self.words), at + 2 * self.size)
            turned = self.words[low:high][::-1].tolist()
            self.back[at] = z_function(turned[high - at:] + [None] + turned), at - low, high - at
        z, pattern, after = self.back[at]
        place = pattern + 1 + after - period  # the word at - 1 + period in the turned words
        return min(z[place], self.size) if period <= after and pattern else 0


def fragments(words: np.ndarray, names: np.ndarray, size: int, least: int, greatest: int, first: int = 0,
              last: int | None = None) -> list[tuple[int, int, int]]:
    """(period, start, end): stretches of matches seen by the octave's tiles that start at positions
    first, first + size, ... before last.  ``names`` are those of the windows of ``size`` words."""
    last = len(words) if last is None else last
    starts = np.arange(first, min(last, len(names)), size)
    if not len(starts):
        return []
    padded = np.concatenate([names, np.zeros(greatest, np.uint64)])
    later = np.lib.stride_tricks.sliding_window_view(padded[least:], greatest - least + 1)
    found_tile, found_period = [], []
    block = max(1, (1 << 22) // (greatest - least + 1))
    for lo in range(0, len(starts), block):
        some = starts[lo:lo + block]
        tile, period = np.nonzero(later[some] == names[some][:, None])
        found_tile.append(tile + lo)
        found_period.append(period + least)
    tile, period = np.concatenate(found_tile), np.concatenate(found_period)
    real = starts[tile] + period < len(names)
    tile, period = tile[real], period[real]
    if not len(tile):
        return []
    order = np.lexsort((tile, period))
    tile, period = tile[order], period[order]
    new = np.r_[True, (period[1:] != period[:-1]) | (tile[1:] != tile[:-1] + 1)]
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(tile)] - 1
    edge = Boundaries(words, size)
    out = []
    for a, b in zip(begin.tolist(), end.tolist()):
        q, low, high = int(period[a]), int(starts[tile[a]]), int(starts[tile[b]]) + size
        out.append((q, low - edge.before(low, q), high + edge.after(high, q)))
    return out


def word_names(words: np.ndarray) -> np.ndarray:
    """Names of the windows of FIRST words."""
    names = mixed(words.astype(np.uint64) + np.uint64(1))
    size = 1
    while size < FIRST:
        names = doubled(names, size) if len(names) > size else names[:0]
        size *= 2
    return names


def solved(words: np.ndarray, longest: int) -> dict[tuple[int, int], int]:
    """(start, length) -> smallest period of all stretches that are long enough for their octave."""
    found: dict[tuple[int, int], int] = {}
    names = word_names(words)
    for size, least, greatest in octaves(longest):
        for q, low, high in fragments(words, names, size, least, greatest):
            if high - low + q >= 3 * q:
                key = low, high - low + q
                found[key] = min(q, found.get(key, q))
        names = doubled(names, size) if len(names) > size else names[:0]
    return found


def numbered(words: list[bytes], codes: dict[bytes, int]) -> np.ndarray:
    return np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))


# --- tasks ---------------------------------------------------------------
DOC, FRAGMENT, TILES, PLAIN = 0, 1, 2, 3
FOUND = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("period", pa.int64()), ("low", pa.int64()),
                   ("high", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64()), ("text", pa.binary())])
FOUND_SQL = "kind int, key long, period long, low long, high long, id long, n_words long, text binary"


def first_pass(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Every document with a key of its own (``PLAIN`` if it cannot have a run); the fragments of
    short ones, the tile spans of long ones."""
    task = TaskContext.get()
    key = (task.partitionId() if task else 0) << 40
    rows = Rows(FOUND, most_bytes=8 << 20)
    codes: dict[bytes, int] = {}
    held: list[tuple[int, int | None, bytes, np.ndarray]] = []
    total = 0

    def solve():
        # documents behind one another, a word that occurs nowhere else after each
        marks = iter(range(len(codes), len(codes) + len(held)))
        stream = np.concatenate([np.r_[words, next(marks)] for *_, words in held])
        starts = np.cumsum([0] + [len(words) + 1 for *_, words in held])
        hit = set()
        for (low, length), q in solved(stream, max(len(words) for *_, words in held)).items():
            i = int(np.searchsorted(starts, low, "right")) - 1
            hit.add(i)
            rows.add(FRAGMENT, held[i][0], q, low - starts[i], low - starts[i] + length - q, None, None, None)
        for i, (own, ident, raw, words) in enumerate(held):
            rows.add(DOC if i in hit else PLAIN, own, None, None, None, ident, len(words), raw, size=len(raw) + 64)

    for batch in batches:
        for ident, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_py()
            words = raw.split()
            key += 1
            if len(words) < 3 * FIRST:
                rows.add(PLAIN, key, None, None, None, ident, len(words), raw, size=len(raw) + 64)
            elif len(words) <= span:
                held.append((key, ident, raw, numbered(words, codes)))
                total += len(words) + 1
                if total >= HELD:
                    solve()
                    codes, held, total = {}, [], 0
            else:
                rows.add(DOC, key, None, None, None, ident, len(words), raw, size=len(raw) + 64)
                whole = numbered(words, {}).astype("<i4")
                for size, _, _ in octaves(len(whole)):
                    step = max(span // size, 16) * size
                    for low in range(0, len(whole), step):
                        part = whole[max(0, low - size):low + step + 3 * size].tobytes()
                        rows.add(TILES, key, size, low, min(low + step, len(whole)), None, None, part, size=len(part) + 64)
                        if rows.full():
                            yield rows.take()
            if rows.full():
                yield rows.take()
    if held:
        solve()
    yield rows.take()


def solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of the dealt spans of tiles (columns key, B, first position, end, words)."""
    schema = pa.schema([("key", pa.int64()), ("period", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
    rows = Rows(schema)
    for batch in batches:
        for key, size, low, high, part in zip(*(c.to_pylist() for c in batch.columns)):
            words = np.frombuffer(part, "<i4").astype(np.int64)
            shift = low - min(low, size)
            names, width = word_names(words), FIRST
            while width < size:
                names = doubled(names, width) if len(names) > width else names[:0]
                width *= 2
            least, greatest = next((a, b) for s, a, b in octaves(3 * size) if s == size)
            for q, a, b in fragments(words, names, size, least, greatest, low - shift, high - shift):
                rows.add(key, q, a + shift, b + shift)
                if rows.full():
                    yield rows.take()
    yield rows.take()


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, span: int = SPAN) -> DataFrame:
    """(<id_col>, n_words, runs array<struct<start,length,period>> by start and period, collapsed): one row per
    row of df.  ``shortest`` is the least length of a run, 24 at least for the first octave to be whole."""
    if shortest < SHORTEST:
        raise ValueError(f"runs of under {SHORTEST} words are not looked for")
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    found = cut(texts.mapInArrow(lambda b: first_pass(b, span), FOUND_SQL), "run-fragments")
    tiles = found.filter(F.col("kind") == TILES).select("key", "period", "low", "high", "text")
    dealt = tiles.repartition("key", "period", "low").mapInArrow(solve_tiles, "key long, period long, low long, high long")
    parts = found.filter(F.col("kind") == FRAGMENT).select("key", "period", "low", "high").unionByName(dealt)
    runs = stitched(parts, shortest).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    # documents without a fragment need not meet the runs
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    docs = found.filter(F.col("kind") == DOC).select("key", "id", "n_words", "text").join(runs, "key", "left")
    plain = found.filter(F.col("kind") == PLAIN).select("key", "id", "n_words", "text", none.alias("runs"))
    docs = docs.unionByName(plain)
    return docs.select(F.col("id").alias(id_col), "n_words", F.coalesce("runs", none).alias("runs"),
                       collapsed(F.col("text"), F.col("runs")).alias("collapsed"))


def stitched(parts: DataFrame, shortest: int) -> DataFrame:
    """(key, start, length, period): the runs made of all fragments (key, period, low, high)."""
    by_low = Window.partitionBy("key", "period").orderBy("low", "high")
    reach = F.max("high").over(by_low.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("low") > F.col("reach"), 1).otherwise(0)).over(by_low)
    whole = (parts.withColumn("reach", reach).withColumn("island", island).groupBy("key", "period", "island")
             .agg(F.min("low").alias("start"), F.max("high").alias("high")))
    length = F.col("high") - F.col("start") + F.col("period")
    long_enough = whole.withColumn("length", length).filter(F.col("length") >= F.greatest(F.lit(shortest), 3 * F.col("period")))
    return long_enough.groupBy("key", "start", "length").agg(F.min("period").alias("period"))


def collapsed(text, runs):
    """The text's words without the repeats of its runs, joined by one blank."""

    @arrow_udf("string")
    def column(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(texts, found):
            words, own = text.as_py().split(), own.as_py()
            if own:
                dropped = np.zeros(len(words) + 1, np.int64)
                for r in own:
                    dropped[r["start"] + r["period"]] += 1
                    dropped[r["start"] + r["length"]] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)]
            out.append(b" ".join(words))
        return pa.array(out, pa.binary()).cast(pa.string())

    return column.asNondeterministic()(text, runs)


def planted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(<id_col>, <text_col>) with a periodic stretch in every text whose id's CRC-32 h, as decimal text, divides by ten:
    with n words, g = h // 10, a = g % n and p = 1 + (n - a) // (3 + g % 8) each word i >= a becomes word
    a + (i - a) % p, words joined by blanks.  A null id plants nothing."""
    chosen = F.col("h") % 10 == 0
    rows = df.select(F.col(id_col), F.col(text_col), F.crc32(F.col(id_col).cast("long").cast("string")).alias("h"))
    words = F.when(chosen, F.array_remove(F.split(text_col, r"[\x20\x09-\x0D]+"), ""))
    rows = rows.withColumn("words", words).withColumn("n", F.greatest(F.size("words"), F.lit(1)))
    rows = rows.withColumn("a", F.expr("(h div 10) % n").cast("int"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)").cast("int"))
    head, period = F.slice("words", F.lit(1), F.col("a")), F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    text = F.array_join(F.slice(F.concat(head, F.flatten(F.array_repeat(period, times))), F.lit(1), F.col("n")), " ")
    return rows.select(id_col, F.when(chosen & (F.size("words") > 0), text).otherwise(F.col(text_col)).alias(text_col))
