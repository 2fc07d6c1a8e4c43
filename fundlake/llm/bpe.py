"""Byte-level BPE over Arrow batches, with ids exactly as the ``tokenizers``
library gives them.

A batch's texts are cut into units at single blanks and line feeds between
non-blank characters; the pre-tokenizer always starts a new word there, so
encoding the units one by one gives the ids of the whole text.  Arrow finds
the distinct units of a batch, ``tokenizers`` encodes each once, and a take
lays the ids out in text order.  Texts with the special string or with
other Unicode blanks stay one unit and are encoded whole.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fundlake.llm.common import tokenizer_path

SPECIAL = "<|endoftext|>"
#: Unicode blanks beyond ASCII, and U+180E, which older tables count as one.
WIDE_BLANKS = "[\\x{85}\\x{A0}\\x{1680}\\x{180E}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
#: Units longer than this are not kept in the cache.
KEPT_BYTES = 48
#: Batches are worked through in steps of about so many bytes of text; a larger step
#: encodes fewer units twice, a smaller one needs less memory.
STEP_BYTES = 32 << 20


def load_tokenizer(path: str | None = None):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or tokenizer_path())


def as_texts(col: pa.Array) -> pa.Array:
    """Nulls become empty texts; always 64-bit offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.large_string()), "")


def split_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(units as binary, index of each text's first unit; one more at the end)."""
    n = len(texts)
    offs = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    lo, hi = int(offs[0]), int(offs[-1])
    buf = texts.buffers()[2]
    if hi == lo:
        return pa.array([], pa.large_binary()), np.zeros(n + 1, np.int64)
    data = np.frombuffer(buf, np.uint8, hi - lo, lo)
    offs = offs - lo
    blank = (data == 32) | ((data >= 9) & (data <= 13)) | ((data >= 28) & (data <= 31))
    starts = ((data == 32) | (data == 10))
    starts[1:] &= ~blank[:-1]
    starts[:-1] &= ~blank[1:]
    odd = pc.or_(pc.match_substring(texts, SPECIAL), pc.match_substring_regex(texts, WIDE_BLANKS))
    for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
        starts[offs[i]:offs[i + 1]] = False
    full = offs[1:] > offs[:-1]
    starts[offs[1:][full] - 1] = False
    starts[offs[:-1][full]] = True
    at = np.flatnonzero(starts)
    bounds = np.append(at, hi - lo).astype(np.int64)
    units = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return units, np.searchsorted(at, offs)


def in_steps(texts: pa.Array, step: int = STEP_BYTES) -> list[pa.Array]:
    """The texts in runs of at most ``step`` bytes, or of one text."""
    offs = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    cuts = [0]
    while cuts[-1] < len(texts):
        fits = int(np.searchsorted(offs, offs[cuts[-1]] + step, "right")) - 1
        cuts.append(min(len(texts), max(cuts[-1] + 1, fits)))
    return [texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


class UnitCache:
    """Value bytes per unit.  Only units seen twice in a batch are kept, and the
    oldest half goes when there are more than ``most``."""

    def __init__(self, make, most: int = 400_000, step: int = STEP_BYTES):
        self.make, self.most, self.step, self.kept = make, most, step, {}

    def lookup(self, units: pa.Array, seen: np.ndarray) -> pa.Array:
        kept, out, missing, where = self.kept, [], [], []
        for i, u in enumerate(units.to_pylist()):
            v = kept.get(u)
            if v is None:
                missing.append(u)
                where.append(i)
            out.append(v)
        if missing:
            for i, u, v in zip(where, missing, self.make(missing)):
                out[i] = v
                if seen[i] > 1 and len(u) <= KEPT_BYTES:
                    kept[u] = v
            if len(kept) > self.most:
                for u in list(kept)[: len(kept) // 2]:
                    del kept[u]
        return pa.array(out, pa.large_binary())

    def expand(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all value bytes in text order, byte offset of each text; one more at the end)."""
        parts = in_steps(texts, self.step)
        if len(parts) > 1:
            steps = [self.expand(t) for t in parts]
            shifts = np.cumsum([0, *(len(d) for d, _ in steps)])
            return (np.concatenate([d for d, _ in steps]),
                    np.concatenate([o[:-1] + k for (_, o), k in zip(steps, shifts)] + [shifts[-1:]]))
        units, first = split_units(texts)
        if len(units) == 0:
            return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
        enc = units.dictionary_encode()
        codes = enc.indices.to_numpy(zero_copy_only=False)
        seen = np.bincount(codes, minlength=len(enc.dictionary))
        laid = self.lookup(enc.dictionary, seen).take(enc.indices)
        offs = np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1, laid.offset * 8)
        size = int(offs[-1] - offs[0])
        if size == 0:
            return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
        data = np.frombuffer(laid.buffers()[2], np.uint8, size, int(offs[0]))
        return data, (offs - offs[0])[first]


class IdEncoder:
    """Token ids of whole batches of texts."""

    def __init__(self, path: str | None = None, joined: int = 1000):
        self.tok = load_tokenizer(path)
        self.cache = UnitCache(self._encode)
        self.joined = joined
        size = self.tok.get_vocab_size(with_added_tokens=True)
        # one character of a byte-level token stands for one byte
        self.id_bytes = np.array([len(self.tok.id_to_token(i) or "") for i in range(size)], np.int64)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, units: list[bytes]) -> list[bytes]:
        """Units that start with a blank and have no other are encoded many at a
        time, joined, and cut again at their byte lengths; the rest one by one."""
        out: list = [None] * len(units)
        plain, single = [], []
        for i, u in enumerate(units):
            s = u.decode()
            ok = len(u) <= KEPT_BYTES and s[0] in " \n" and s.split() == [s[1:]] and SPECIAL not in s and "\u180e" not in s
            (plain if ok else single).append(i)
        for i, ids in zip(single, self._ids([units[i].decode() for i in single])):
            out[i] = ids
        groups = [plain[k:k + self.joined] for k in range(0, len(plain), self.joined)]
        for g, raw in zip(groups, self._ids([b"".join([units[i] for i in g]).decode() for g in groups])):
            ids = np.frombuffer(raw, "<u4")
            ends = np.cumsum(self.id_bytes[ids])
            bounds = np.cumsum([len(units[i]) for i in g])
            at = np.searchsorted(ends, bounds)
            if len(ends) and at[-1] < len(ends) and np.array_equal(ends[at], bounds):
                at = (at + 1) * 4
                for i, lo, hi in zip(g, [0, *at[:-1].tolist()], at.tolist()):
                    out[i] = raw[lo:hi]
            else:  # a word ran across a joint
                for i, one in zip(g, self._ids([units[i].decode() for i in g])):
                    out[i] = one
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as uint32, id offset of each text; one more at the end)."""
        data, offs = self.cache.expand(as_texts(texts))
        return data.view("<u4"), offs // 4


_ENCODERS: dict = {}


def shared_encoder(path: str | None = None) -> IdEncoder:
    """One encoder per Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]
