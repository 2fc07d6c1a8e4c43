"""Harmonic packing of tokenised documents into sequences (operator 9).

Method: a piece of ``n`` tokens belongs to class ``k = capacity // n`` (its
length lies in (capacity/(k+1), capacity/k]), and a bin of class ``k`` takes
exactly ``k`` pieces.  Every worker fills the bins of its own partition, one
open bin per class, without a shuffle.  Documents are cut so that nearly
all tokens sit in pieces of exactly capacity/k for k = 1, 2, 4, ... down to
``grain`` tokens, which fill their bins without a gap; only a tail shorter
than ``grain`` is rounded to its class, where a bin loses less than
capacity/(k+1).  At the end of a partition the pieces of its unfilled bins
are laid in a row and cut at power-of-two lengths, which need no padding.

A worker holds one batch and at most one open bin per class.  Sequence ids
are (partition number << 40) + a running number, so a task that runs again
gives the same ids for the same input partition.

Defined results: null text counts as empty (one piece with the end id
only); repeated rows are packed one by one; null ids stay null; an empty
table gives no pieces.  Columns other than the named two are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.bpe import shared_encoder
from fundlake.llm.common import Rows

PIECES = ("{id} long, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long, "
          "bin_class int")


def cut_lengths(n: int, capacity: int, grain: int) -> list[int]:
    """Lengths a document of n tokens is cut into."""
    out = [capacity] * (n // capacity)
    rest, size = n % capacity, capacity // 2
    while size >= grain:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


def power_of_two_runs(n: int, capacity: int) -> list[int]:
    """Sequence lengths that hold exactly n tokens: full ones, then falling powers of two."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Packer:
    """Bins of one worker.  A piece is [doc_id, start, ids as bytes, doc_tokens]."""

    def __init__(self, capacity: int, grain: int, first_id: int):
        self.capacity, self.grain, self.next_id = capacity, grain, first_id
        self.open: dict[int, list[list]] = {}

    def closed(self, pieces: list[list], k: int) -> Iterator[tuple]:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            yield doc, start, n, ids, total, self.next_id, at, k
            at += n
        self.next_id += 1

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        total, start = len(ids) // 4, 0
        for n in cut_lengths(total, self.capacity, self.grain):
            k = self.capacity // n
            pieces = self.open.setdefault(k, [])
            pieces.append([doc, start, ids[4 * start:4 * (start + n)], total])
            start += n
            if len(pieces) == k:
                yield from self.closed(self.open.pop(k), k)

    def finish(self) -> Iterator[tuple]:
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        left.reverse()
        for size in power_of_two_runs(sum(len(p[2]) for p in left) // 4, self.capacity):
            pieces, room = [], 4 * size
            while room:
                doc, start, ids, total = left.pop()
                if len(ids) > room:
                    left.append([doc, start + room // 4, ids[room:], total])
                    ids = ids[:room]
                pieces.append([doc, start, ids, total])
                room -= len(ids)
            yield from self.closed(pieces, 0)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, grain: int = 64,
         end_id: int = 0, path: str | None = None) -> DataFrame:
    """Pieces: id, start and length in the document, ids (little-endian uint32),
    doc_tokens, sequence_id, offset in the sequence, bin_class (0: cut at a
    partition's end).  ``capacity`` is a power of two."""
    if capacity & (capacity - 1) or grain < 2:
        raise ValueError("capacity must be a power of two and grain at least 2")
    schema = pa.schema([(id_col, pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                        ("bin_class", pa.int32())])
    end = end_id.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, grain, TaskContext.get().partitionId() << 40)
        encoder = shared_encoder(path)
        rows = Rows(schema)
        for batch in batches:
            ids, offs = encoder.encode(batch.column(1))
            raw = ids.tobytes()
            bounds = (offs * 4).tolist()
            for doc, lo, hi in zip(batch.column(0).to_pylist(), bounds, bounds[1:]):
                for row in packer.add(doc, raw[lo:hi] + end):
                    rows.add(*row, size=len(row[3]) + 64)
                if rows.full():
                    yield rows.take()
        for row in packer.finish():
            rows.add(*row, size=len(row[3]) + 64)
        yield rows.take()

    return df.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(packed, PIECES.format(id=f"`{id_col}`"))
