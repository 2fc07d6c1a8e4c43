"""Line dedup, conversation repair and periodic runs against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundlake.llm import conversations, line_dedup, queries, runs

BLANKS = " \t\n\x0b\x0c\r"
SF = "/root/testdata/sf0.001"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- line dedup ----------------------------------------------------------
def lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def slow_dedup(rows, least, min_chars=1):
    split = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda x: lower(x.strip(BLANKS))
    held = Counter(k for _, lines in split for k in {key(x) for x in lines})
    out = []
    for i, lines in split:
        kept = [x for x in lines if len(key(x)) < min_chars or held[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows(n=400, seed=3):
    rng = random.Random(seed)
    pool = [f"Line {k} äÖ" for k in range(60)] + ["", "  ", "\tX\r", "x", "X ", "ÄÖ", "äö"]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\t"]) for _ in range(rng.randrange(1, 12)))) for i in range(n)]
    copy = "shared one\nshared two\nown"
    rows += [(1000 + i, copy) for i in range(n // 2)] + [(None, copy), (None, copy), (5, None), (6, ""), (6, ""), (7, "\n\n")]
    return rows + [(9, "\n".join(f"long {k % 700}" for k in range(20_000)))]


@pytest.mark.parametrize("least, min_chars", [(2, 1), (10, 1), (10, 7), (10_000, 1)])
def test_dedup_equals_brute_force(spark, least, min_chars):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns({"h": F.lit(1), "n_lines": F.lit("clash")})
    got = line_dedup.dedup(df, min_docs=least, min_chars=min_chars)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == slow_dedup(rows, least, min_chars)


def test_dedup_with_many_shards_and_hot_lines(spark):
    rows = line_rows(seed=4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = line_dedup.build_index(df, shard_keys=16)
    assert index.count() > 20 and index.agg(F.sum("keys")).first()[0] == line_dedup.document_counts(df, "text", 1).count()
    got = line_dedup.drop_lines(df, index, min_docs=10)
    assert sorted(map(tuple, got.collect()), key=repr) == slow_dedup(rows, 10)


def test_index_of_another_corpus(spark, empty):
    index = line_dedup.build_index(spark.createDataFrame([(i, "Known") for i in range(10)], "doc_id long, text string"))
    got = line_dedup.drop_lines(spark.createDataFrame([(1, " known\nnew")], "doc_id long, text string"), index)
    assert [tuple(r) for r in got.collect()] == [(1, 2, 1, "new")]
    assert line_dedup.dedup(empty).count() == 0


def test_dedup_of_hard_rows(spark, hard):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    got = line_dedup.dedup(hard, min_docs=3)
    assert sorted(map(tuple, got.collect()), key=repr) == slow_dedup(rows, 3)


def test_shard_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    counts = rng.integers(1, 70_000, 5000)
    shard = line_dedup.Shard.load(*line_dedup.Shard.build(keys, counts).stored())
    assert int(shard.bits.sum()) == len(keys) == len(shard.counts)
    assert (shard.probe(keys) == counts).all()
    others = rng.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64)
    assert (shard.probe(others) > 0).sum() < 20
    assert line_dedup.Shard.build(keys[:0], counts[:0]).probe(keys[:3]).tolist() == [0, 0, 0]


def test_line_query_on_documents(spark, docs):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op11_line_dedup(spark, SF).collect()}
    want = slow_dedup([(r.doc_id, r.text) for r in docs.collect()], 10)
    assert got == {i: (n, d, sha(kept)) for i, n, d, kept in want}


# --- conversation repair -------------------------------------------------
NEXT = {("S", "s"): "Y", ("S", "u"): "U", ("Y", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def slow_repair(rows):
    """rows (turn, role, text) of one conversation, nulls replaced -> the digest columns."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", sha("")
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.strip(BLANKS)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    best = {}
    for i in range(len(rows), -1, -1):
        here = {}
        for state in "SYUA":
            ways = []
            if i == len(rows):
                ways += [(0, "", ())] if state in "SA" else []
            else:
                _, role, text = rows[i]
                cost, audit, out = best[state]
                ways.append((4 + cost, "D" + audit, out))
                extra = 3 if faults[i] == "truncated" else 0
                for price, letter, name in ((0, "K", role), (3, "R", "user"), (3, "R", "assistant")):
                    to = NEXT.get((state, name[:1]))
                    if to and faults[i] in ("", "truncated"):
                        cost, audit, out = best[to]
                        ways.append((price + extra + cost, letter + audit, ((name, text), *out)))
            here[state] = min(ways, key=lambda w: w[:2]) if ways else (10**9, "", ())
        for _ in range(4):
            for state in "SYUA":
                for name in ("user", "assistant"):
                    to = NEXT.get((state, name[0]))
                    if to:
                        cost, audit, out = here[to]
                        here[state] = min(here[state], (3 + cost, "I" + audit, ((name, ""), *out)), key=lambda w: w[:2])
        best = here
    cost, audit, out = best["S"]
    count = Counter(faults)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
            sha("\n".join(f"{role}:{text}" for role, text in out)))


def slow_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        held = out.setdefault(conv, [])
        said = lambda x: " " if x is None else x
        h = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", said(text)) if h == 2 else said(text)
        if h:
            held += [(turn, "user" if h == 4 else said(role), text)] * (2 if h == 3 else 1)
    return out


def talk(n, conversations, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "umpire", "Assistant"]
    texts = ["Yes.", "No!", "why?", "cut", " ", "", None, "Yes. ", "A long one. ", "日本", "end.\x0b"]
    return [(rng.choice(conversations), rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts) if rng.random() < .4 else f"t{k}.")
            for k in range(n)]


def check_repair(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).withColumn("tile", F.lit("clash"))
    got = conversations.repair(df)
    summary = {None if r.unknown else int(r.conv): tuple(r)[2:] for r in got.summary.collect()}
    digests = {None if r.unknown else int(r.conv): r.repaired_sha256 for r in conversations.hashes(got.rows).collect()}
    by = {}
    for conv, *row in rows:
        by.setdefault(conv, []).append((row[0], *(" " if x is None else x for x in row[1:])))
    for conv, own in by.items():
        assert (*summary[conv], digests.get(conv, sha(""))) == slow_repair(own), conv
    assert len(summary) == len(by)


@pytest.mark.parametrize("tile_bits", [13, 0, 1, 3])
def test_repair_equals_brute_force(spark, monkeypatch, tile_bits):
    monkeypatch.setattr(conversations, "TILE_BITS", tile_bits)
    check_repair(spark, talk(300, [1, 2, 3, *range(10, 40)], 5) + talk(150, [None, 7], 6) + [(90, 1, "user", "Same.")] * 9)


def test_one_conversation_of_most_rows_crosses_tiles(spark, monkeypatch):
    monkeypatch.setattr(conversations, "TILE_BITS", 4)
    check_repair(spark, talk(500, [1, 1, 1, 2], 8))


def test_repaired_rows_have_the_pattern(spark):
    rows = talk(400, list(range(60)), 9)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    initials = {}
    for r in sorted(conversations.repair(df).rows.collect(), key=lambda r: (r.place, r.step)):
        initials[r.conv] = initials.get(r.conv, "") + r.role[:1]
    assert initials and all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())


def test_conversation_query(spark, tmp_path):
    rows = talk(600, [None, *range(50)], 11) + [(1000 + k, 3, "user", "x") for k in range(40)]
    rows += [(2000, k, ("user", "assistant")[k % 2], "Fine.") for k in range(3000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {conv: slow_repair(own) for conv, own in slow_damage(rows).items()}


def test_empty_conversations(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_conversation_repair(spark, str(tmp_path)).count() == 0


# --- periodic runs -------------------------------------------------------
def slow_runs(words, shortest=24):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def slow_collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        size = rng.choice([0, 1, 23, 24, 25, 30, 60, 100, 200, 500])
        words = [str(rng.randrange(rng.choice([1, 2, 3, 40]))) for _ in range(size)]
        for _ in range(rng.randrange(4) if size else 0):
            a, p = rng.randrange(size), rng.randrange(1, max(2, size // 3))
            for i in range(a + p, min(size, a + rng.randrange(2 * p, 6 * p + 30))):
                words[i] = words[i - p]
        yield words


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert runs.z_function(s) == want


@pytest.mark.parametrize("span", [1 << 16, 30, 100])
def test_runs_equal_brute_force(spark, span):
    texts = list(periodic_texts(150, 7)) + [["a"] * 700, list("ab") * 300, ["x"] * 23 + ["y"] * 24]
    rows = [(i, "  ".join(words)) for i, words in enumerate(texts)] + [(None, None), (None, ""), (3, "\t \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("runs", F.lit("clash"))
    got = runs.find(df, span=span).collect()
    want = [(i, len(w), slow_runs(w), slow_collapsed(w, slow_runs(w))) for i, w in ((i, (t or "").split()) for i, t in rows)]
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr) == sorted(want, key=repr)


def test_runs_of_hard_rows(spark, hard, empty):
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in runs.find(hard).collect()), key=repr)
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in hard.collect()]
    long_run = [(0, 30_000, 1)]
    assert got == sorted(((i, len(w), long_run if len(w) == 30_000 else []) for i, w in rows), key=repr)
    assert runs.find(empty).count() == 0


def test_long_document_meets_every_octave(spark):
    rng = random.Random(4)
    words = [str(rng.randrange(10**6)) for _ in range(9000)]
    for a, p, b in ((100, 1000, 3600), (4000, 70, 4500), (5000, 1, 5030), (6000, 900, 8800)):
        for i in range(a + p, b):
            words[i] = words[i - p]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    want = [(100, 3500, 1000), (4000, 500, 70), (5000, 30, 1), (6000, 2800, 900)]
    for span in (1 << 16, 512):
        found = [tuple(x) for x in runs.find(df, span=span).first().runs]
        assert [(s, length, q) for s, length, q in found] == want


def test_run_query_on_documents(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, SF).collect()}
    hits = 0
    for d in docs.collect():
        words, h = (d.text or "").encode().split(), zlib.crc32(str(d.doc_id).encode())
        words = [w.decode() for w in words]
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
        found = fast_runs(np.array([ids[w] for w in words], np.int64))
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        milli = 1000 * best[1] // best[2] if found else None
        assert got[d.doc_id] == (len(found), *best, milli, sha(lines), sha(slow_collapsed(words, found)))
        hits += bool(found)
    assert hits >= 5


def fast_runs(w, shortest=24):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        same = np.r_[False, w[:-q] == w[q:], False]
        for a, b in np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2).tolist():
            if b - a + q >= max(shortest, 3 * q):
                found.setdefault((a, b - a + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def test_first_pass_gives_no_fragments_of_short_texts():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"a " * 23], pa.binary())], ["id", "text"])
    kinds = [k for b in runs.first_pass(iter([batch]), 100) for k in b.column(0).to_pylist()]
    assert kinds == [runs.PLAIN]
