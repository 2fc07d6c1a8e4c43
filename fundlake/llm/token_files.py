"""Token ids in binary files with one shared zstandard dictionary (operator 10).

Method: a dictionary is trained on serialised id arrays of a bounded sample
of documents; each document is compressed by itself with it.  A shard file
holds a header with the dictionary's SHA-256, the frames, and an index
with offset, size and count per document, so one short document is read
with two small reads.

File layout, all little-endian:

    header   8 bytes magic, uint32 bytes per id, uint32 zero, 32 bytes SHA-256 of the dictionary
    frames   one zstandard frame per document, ids serialised as uint16 or uint32
    index    per document: int64 id, uint64 1 if the id is not null, uint64 frame offset,
             uint64 frame size, uint64 number of ids
    footer   uint64 index offset, uint64 number of documents

Documents are dealt by ranges of the id (one shuffle of the texts), encoded
and written where they land, one file per range, in ascending order.  A file is
written under a temporary name and moved, and the same input gives the same
bytes, so a task that runs twice does no harm.  The manifest (one line per
shard, not per document) holds what comes before each shard.

Defined results: null text counts as empty (only the end id); null ids come first;
equal ids are ordered by the text's hash; an empty table gives no shards
and an empty result.  Columns other than the named two are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.bpe import IdEncoder, shared_encoder
from fundlake.llm.common import Rows, in_key_order

MAGIC = b"FLTOKEN1"
HEADER, FOOTER = "<8sII32s", "<QQ"
INDEX = np.dtype([("id", "<i8"), ("valid", "<u8"), ("offset", "<u8"), ("size", "<u8"), ("count", "<u8")])
#: At most so many documents, none longer than so many bytes, train the dictionary.
TRAIN_DOCS, TRAIN_DOC_BYTES, DICTIONARY_BYTES = 2_000, 65_536, 65_536


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        uri = folder if "://" in folder else "file://" + folder[len("file:"):]
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), folder


def write_whole(folder: str, name: str, chunks: Iterator[bytes]) -> None:
    """Write under a temporary name, then move into place."""
    fs, base = open_folder(folder)
    part = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        for c in chunks:
            out.write(c)
    fs.move(part, f"{base}/{name}")


def read_whole(folder: str, name: str) -> bytes:
    fs, base = open_folder(folder)
    with fs.open_input_file(f"{base}/{name}") as f:
        return f.read()


def id_type(path: str | None) -> np.dtype:
    return np.dtype("<u2" if shared_encoder(path).tok.get_vocab_size() <= 1 << 16 else "<u4")


def train_dictionary(df: DataFrame, id_col: str, text_col: str, path: str | None = None) -> bytes:
    """A dictionary from about TRAIN_DOCS documents picked by the hash of their ids
    (empty if the sample is too small to train on)."""
    total = df.count()
    if not total:
        return b""
    part = min(1.0, TRAIN_DOCS / total)
    top = (1 << 62) - 1
    sample = (df.filter(F.xxhash64(F.col(id_col)).bitwiseAND(F.lit(top)) <= int(part * top))
              .filter(F.octet_length(text_col) <= TRAIN_DOC_BYTES).select(text_col).limit(2 * TRAIN_DOCS))
    texts = [r[0] for r in sample.collect()]
    encoder, kind = IdEncoder(path), id_type(path)
    ids, offs = encoder.encode(pa.array(texts, pa.string()))
    blocks = [ids[lo:hi][k:k + 2048].astype(kind).tobytes()
              for lo, hi in zip(offs, offs[1:]) for k in range(0, hi - lo, 2048)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                      level: int = 3, path: str | None = None) -> dict:
    """Write shards, dictionary and manifest into a new folder; returns the manifest."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    trained = train_dictionary(rows, "id", "text", path)
    digest = hashlib.sha256(trained).digest()
    fs, base = open_folder(folder)
    fs.create_dir(base, recursive=True)
    write_whole(folder, "dictionary.zdict", iter([trained]))
    dealt, n, at = in_key_order(rows, "id")
    dealt = (dealt.repartitionById(n, F.col(at)).withColumn("_tie", F.xxhash64("text"))
             .sortWithinPartitions(F.col("id").asc_nulls_first(), "_tie").select(at, "id", "text"))
    schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                        ("n_bytes", pa.int64())])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, index, seen = id_type(path), [], {}
        encoder = shared_encoder(path)
        packer = zstandard.ZstdCompressor(
            level=level, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        end = np.array([end_id], kind)

        def frames(first: pa.RecordBatch) -> Iterator[bytes]:
            yield struct.pack(HEADER, MAGIC, kind.itemsize, 0, digest)
            at = struct.calcsize(HEADER)
            batch: pa.RecordBatch | None = first
            while batch is not None:
                ids, offs = encoder.encode(batch.column(2))
                ids = ids.astype(kind)
                for doc, lo, hi in zip(batch.column(1).to_pylist(), offs.tolist(), offs[1:].tolist()):
                    frame = packer.compress(np.concatenate([ids[lo:hi], end]).tobytes())
                    index.append((doc or 0, doc is not None, at, len(frame), hi - lo + 1))
                    at += len(frame)
                    yield frame
                batch = next((b for b in batches if b.num_rows), None)
            table = np.array(index, INDEX)
            yield table.tobytes()
            yield struct.pack(FOOTER, at, len(table))
            seen["bytes"] = at + table.nbytes + struct.calcsize(FOOTER)

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        shard = first.column(0)[0].as_py()
        name = f"shard-{shard:06d}.tok"
        write_whole(folder, name, frames(first))
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "file": name, "n_docs": len(index), "n_ids": sum(x[4] for x in index),
              "n_bytes": seen["bytes"]}], schema=schema)

    shards = dealt.mapInArrow(written, "shard int, file string, n_docs long, n_ids long, n_bytes long").collect()
    listed, start = [], 0
    for s in sorted(shards, key=lambda s: s["shard"]):
        listed.append(s.asDict() | {"start": start})
        start += s["n_ids"]
    manifest = {"dictionary_sha256": digest.hex(), "end_id": end_id, "n_ids": start, "shards": listed}
    write_whole(folder, "manifest.json", iter([json.dumps(manifest).encode()]))
    return manifest


class Shard:
    """One open shard file: its index, and documents by their place in it."""

    def __init__(self, folder: str, name: str):
        trained = read_whole(folder, "dictionary.zdict")
        fs, base = open_folder(folder)
        self.file = fs.open_input_file(f"{base}/{name}")
        size = self.file.size()
        magic, width, _, digest = struct.unpack(HEADER, self.file.read_at(struct.calcsize(HEADER), 0))
        if magic != MAGIC or digest != hashlib.sha256(trained).digest():
            raise ValueError(f"{name}: not a token file, or written with another dictionary")
        at, n = struct.unpack(FOOTER, self.file.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        self.index = np.frombuffer(self.file.read_at(n * INDEX.itemsize, at), INDEX)
        self.kind = np.dtype(f"<u{width}")
        self.unpacker = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)

    def ids(self, row: int) -> np.ndarray:
        e = self.index[row]
        raw = self.unpacker.decompress(self.file.read_at(int(e["size"]), int(e["offset"])))
        ids = np.frombuffer(raw, self.kind)
        if len(ids) != e["count"]:
            raise ValueError("a frame's length differs from the index")
        return ids

    def close(self) -> None:
        self.file.close()


def read_token_files(spark: SparkSession, folder: str, id_name: str = "doc_id") -> DataFrame:
    """Rows of all shards: id, start (ids before the document), n_tokens, ids (uint32 little-endian)."""
    manifest = json.loads(read_whole(folder, "manifest.json"))
    listed = [(i, s["file"], s["start"]) for i, s in enumerate(manifest["shards"])]
    schema = pa.schema([(id_name, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(schema)
        for batch in batches:
            for name, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                shard = Shard(folder, name)
                try:
                    for row, entry in enumerate(shard.index):
                        ids = shard.ids(row).astype("<u4").tobytes()
                        rows.add(int(entry["id"]) if entry["valid"] else None, start, len(ids) // 4, ids, size=len(ids) + 64)
                        start += len(ids) // 4
                        if rows.full():
                            yield rows.take()
                finally:
                    shard.close()
        yield rows.take()

    shards = spark.createDataFrame(listed, "shard int, file string, start long")
    return (shards.repartitionById(max(1, len(listed)), F.col("shard"))
            .mapInArrow(documents, f"`{id_name}` long, start long, n_tokens long, ids binary"))
