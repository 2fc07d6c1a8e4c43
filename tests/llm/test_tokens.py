"""Operators 5, 9, 10: token counts at prefixes, packing, token files."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fundlake.llm import packing, token_counts, token_files
from fundlake.llm.bpe import STEP_BYTES, IdEncoder, in_steps
from fundlake.llm.common import scratch_folder, tokenizer_path

TOK = Tokenizer.from_file(tokenizer_path())
ALPHABET = [" ", "\n", "a", "b", "é", "\t", ".", "'s", "12", "<|endoftext|>", "'re", "'", "l", "the", "ing", "日", "!!",
            "　", "\x1c", "\x85", "Hello", "<|endo", "᠎", "  "]


def ids(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def odd_texts(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(n)] + \
        ["we'll they've 're'", "  x   y  ", "a" * 40, " " * 150 + "x", ""]


def test_ids_equal_the_library():
    texts = odd_texts(1500) + [None]
    got, offs = IdEncoder().encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert got[offs[i]:offs[i + 1]].tolist() == ids(t), t


def test_steps_cover_all_texts():
    texts = pa.array(["x" * (STEP_BYTES // 2 + 1)] * 3 + ["y" * (STEP_BYTES + 5), "z"], pa.large_string())
    parts = in_steps(texts)
    assert [len(p) for p in parts] == [1, 1, 1, 1, 1]
    assert pa.concat_arrays(parts) == texts


def test_prefix_counts_against_encoding_every_prefix():
    texts = odd_texts(250, seed=5)
    counter = token_counts.PrefixCounter()
    deltas, offs = counter.deltas(pa.array(texts))
    for i, t in enumerate(texts):
        got = token_counts.counts_from_deltas(deltas[offs[i]:offs[i + 1]].tobytes()).tolist()
        assert got == [len(ids(t[:k])) for k in range(len(t) + 1)], t


def test_token_counts_rows(spark, hard, empty):
    rows = token_counts.token_counts(hard, budget=20).collect()
    assert len(rows) == hard.count()
    texts = {(r.doc_id, len((r.text or "").encode())): r.text for r in hard.collect()}
    for r in rows:
        text = texts[r.doc_id, r.n_bytes] or ""
        assert r.n_tokens == len(ids(text)) and r.over_limit == (r.n_tokens > 20)
        assert len(ids(text[:r.fit_chars])) <= 20
        assert r.fit_chars == len(text) or len(ids(text[:r.fit_chars + 1])) > 20
        assert len(r.deltas) == len(text)
    assert token_counts.token_counts(empty).count() == 0


def padding(lengths):
    return sum(0 if n & (n - 1) == 0 else 1024 - n for n in lengths)


@pytest.mark.parametrize("which", ["hard", "docs"])
def test_packing_keeps_every_id_once(which, request):
    df = request.getfixturevalue(which)
    pieces = packing.pack(df).collect()
    want = sorted(np.array([*ids(r.text), 0], "<u4").tobytes() for r in df.collect())
    by_doc, by_seq = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    for ps in by_seq.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == list(np.cumsum([0, *(p.length for p in ps)])[:-1])
        assert sum(p.length for p in ps) <= 1024
    if which == "docs":  # ids are unique there
        got = sorted(b"".join(p.ids for p in sorted(ps, key=lambda p: p.start)) for ps in by_doc.values())
        assert got == want
        total = sum(p.length for p in pieces)
        assert padding([sum(p.length for p in ps) for ps in by_seq.values()]) < 0.01 * total
    else:
        assert sum(p.length for p in pieces) == sum(len(w) for w in want) // 4


def test_bins_hold_a_fixed_number_of_pieces_of_their_class(docs):
    pieces = [p for p in packing.pack(docs).collect() if p.bin_class]
    bins = {}
    for p in pieces:
        assert 1024 // p.length == p.bin_class
        bins.setdefault(p.sequence_id, []).append(p.bin_class)
    assert all(len(b) == b[0] and len(set(b)) == 1 for b in bins.values())


def test_packing_of_nothing(empty):
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("which", ["hard", "docs", "empty"])
def test_token_files_round_trip(spark, which, request):
    df = request.getfixturevalue(which)
    folder = scratch_folder(spark, "test-files")
    manifest = token_files.write_token_files(df, folder)
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys) and len(got) == df.count()
    assert sorted(bytes(r.ids) for r in got) == sorted(np.array([*ids(r.text), 0], "<u4").tobytes() for r in df.collect())
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1])
    assert manifest["n_ids"] == sum(r.n_tokens for r in got)
    if which == "docs":
        first = manifest["shards"][0]
        shard = token_files.Shard(folder, first["file"])
        row = min(3, first["n_docs"] - 1)
        doc = next(r for r in got if r.doc_id == shard.index[row]["id"])
        assert zlib.crc32(shard.ids(row).astype("<u4").tobytes()) == zlib.crc32(bytes(doc.ids))
        shard.close()


def test_another_dictionary_is_refused(spark, docs):
    folder = scratch_folder(spark, "test-dictionary")
    manifest = token_files.write_token_files(docs, folder)
    with open(f"{folder}/dictionary.zdict", "wb") as f:
        f.write(b"another")
    with pytest.raises(ValueError):
        token_files.Shard(folder, manifest["shards"][0]["file"])
    assert json.loads(token_files.read_whole(folder, "manifest.json"))["end_id"] == 0
