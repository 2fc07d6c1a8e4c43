"""Operators 4, 6, 7: nearest neighbours, bottom-k sketches, SimHash."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fundlake.llm import ann, simhash, sketches


# ---------------------------------------------------------------- SimHash
def slow_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def components(prints, names, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(prints)):
        groups.setdefault(find(i), []).append(i)
    out = {}
    for g in groups.values():
        known = [names[i] for i in g if names[i] is not None]
        for i in g:
            out[i] = min(known) if known else None
    return out


@pytest.mark.parametrize("which", ["hard", "docs"])
def test_near_duplicates_against_brute_force(which, request):
    df = request.getfixturevalue(which)
    rows = df.select("doc_id", "text").collect()
    rows = rows if which == "hard" else [r for r in rows if len(r.text) < 4000]
    df = df if which == "hard" else df.filter("length(text) < 4000")
    prints = [slow_print(r.text) for r in rows]
    comp = components(prints, [r.doc_id for r in rows], 2)
    want = sorted((str(r.doc_id), f"{prints[i]:016x}", str(comp[i])) for i, r in enumerate(rows))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    assert got == want


@pytest.mark.parametrize("bits,most", [(1, 4096), (2, 4096), (3, 4096), (1, 3), (2, 3), (3, 3)])
def test_links_connect_what_brute_force_connects(spark, bits, most):
    """With a small bound, buckets go the way of the large ones."""
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 12, dtype=np.int64).tolist()
    prints = set(base)
    for x in base[:6]:
        for _ in range(25):
            y = x
            for b in rng.integers(0, 63, rng.integers(1, 4)):
                y ^= 1 << int(b)
            prints.add(y)
    prints = sorted(prints)
    want = components(prints, prints, bits)
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fp long"), bits, most).collect()
    assert all((a ^ b).bit_count() <= bits for a, b in links)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {p: find(p) for p in prints} == {prints[i]: c for i, c in want.items()}


def test_keep_one_of_each_group(spark, empty):
    text = "one two three four five six seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(3, text, "x"), (1, text, "x"), (1, text, "x"), (2, "something else entirely here now", "y")],
                               "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == [1, 2]
    assert simhash.keep_one(empty).count() == 0


def test_keep_one_loses_no_text_without_id_and_none_of_a_repeated_id(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(None, text(0), "a"), (None, text(1), "a"), (None, text(1), "a"), (None, text(2), "a"),  # 2 is also under id 7
            (7, text(2), "b"), (8, text(3), "b"), (8, text(4), "b"), (8, text(4), "b"), (9, text(4), "c"), (None, None, "d"),
            (None, "", "d"), (None, "  ", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = sorted((str(r.doc_id), (r.text or "").strip()) for r in simhash.keep_one(df).collect())
    assert got == sorted([("None", text(0)), ("None", text(1)), ("7", text(2)), ("8", text(3)), ("8", text(4)), ("None", "")])


# ---------------------------------------------------------------- sketches
def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("which", ["hard", "docs"])
def test_fingerprints_of_edited_texts(which, request):
    df = request.getfixturevalue(which)
    rows = df.select("doc_id", "text").collect()
    hashed = {id(r): xxhash.xxh64_intdigest((r.text or "").encode(), 42) for r in rows}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), signed(hashed[id(r)])))
    got = sketches.fingerprints(df).collect()
    assert len(got) == len(rows)
    want = []
    for r, after in zip(rows, rows[1:] + rows[:1]):
        text, other = r.text or "", after.text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        want.append((str(r.doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(),
                     alike(shingles(text), shingles(edited)), alike(shingles(text), shingles(other))))
    got = [(str(g.doc_id), g.n_chars, g.edited_sha256, g.near_edited, g.near_next) for g in got]
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:3] == b[:3]
        assert a[3] == pytest.approx(b[3], abs=0.15) and a[4] == pytest.approx(b[4], abs=0.15)


def test_sketches_merge_into_the_sketch_of_the_union(spark, docs):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, (1 << 64) - 1, n, dtype=np.uint64) for n in (5000, 3000))
    both = np.concatenate([a, b, a[:100]])
    merged = sketches.merge(sketches.smallest(a, 256), sketches.smallest(b, 256))
    assert np.array_equal(merged, sketches.smallest(both, 256))
    assert sketches.distinct_count(merged) == pytest.approx(8000, rel=0.2)
    assert np.array_equal(sketches.from_text(sketches.to_text(merged)), merged)
    from pyspark.sql import functions as F

    parts = docs.repartition(7).select("lang", sketches.sketch_column(F.col("text")).alias("s"))
    got = {r.lang: r for r in sketches.merged_by(parts, "lang", "s").collect()}
    for lang, rows in __import__("itertools").groupby(sorted(docs.collect(), key=lambda r: r.lang), key=lambda r: r.lang):
        every = np.concatenate([sketches.shingle_hashes((r.text or "").encode()) for r in rows])
        assert got[lang].sketch == sketches.to_text(sketches.smallest(every, 256))


def test_likeness_and_containment():
    text = b"a b c d e f g h i j k l m n o p"
    whole, part, none = sketches.sketch(text), sketches.sketch(text[:21]), sketches.sketch(b"")
    assert sketches.resemblance(whole, whole) == 1 and sketches.resemblance(none, none) == 1
    assert sketches.resemblance(whole, none) == 0
    assert sketches.containment(part, whole) == 1 and sketches.containment(whole, part) < 1


def test_fingerprints_of_nothing_and_of_one(spark, empty):
    assert sketches.fingerprints(empty).count() == 0
    one = sketches.fingerprints(spark.createDataFrame([(4, "abcdef", "en")], "doc_id long, text string, lang string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


# ---------------------------------------------------------------- nearest neighbours
def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        found = sorted(((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v)))
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def test_transform_keeps_lengths_and_inner_products():
    x = np.random.default_rng(0).normal(size=(6, 50))
    y = ann.turned(x, 3, 7)
    assert np.allclose(x @ x.T, y @ y.T)


def test_exact_when_every_cell_is_probed(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 12)) * rng.uniform(0.2, 3, (300, 1))
    v[7] = v[40] = v[41] = v[0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    bad = [(300, None), (301, [0.0] * 12), (302, [float("nan")] * 12), (303, [1.0] * 11 + [None]), (304, []), (None, v[1].tolist()),
           (305, v[2].tolist()[:5]), (5, v[5].tolist())]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(4)
    got = ann.nearest(df, df.filter("vec_id % 20 = 0"), k=20, tables=1, probes=64, block=64).collect()
    usable = dict(rows) | {305: v[2].tolist()[:5]}
    want = brute(list(usable.items()), [(i, x) for i, x in usable.items() if i % 20 == 0], 20)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {q for q, found in want.items() if found}
    for q, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, len(want[q]) + 1))
        assert [r.vec_id for r in rs] == [i for i, _ in want[q]]
        assert [r.score for r in rs] == pytest.approx([s for _, s in want[q]])


def test_recall_on_embeddings(spark):
    import os

    path = "/root/testdata/sf0.001/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("test data not present")
    df = spark.read.parquet(path)
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in df.collect()]
    want = brute(rows, [x for x in rows if x[0] % 20 == 0], 20)
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {i for i, _ in found}) for q, found in want.items())
    assert hits / sum(len(f) for f in want.values()) >= 0.9


@pytest.mark.parametrize("lengths", ["lognormal 0.3", "lognormal 1", "one outlier"])
def test_recall_on_unequal_lengths(spark, lengths):
    rng = np.random.default_rng(5)
    n, k = 10_000, 20
    v = rng.normal(size=(n, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    if lengths == "one outlier":
        v[13] *= 100
    else:
        v *= rng.lognormal(0, float(lengths.split()[1]), n)[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 50 = 0"), k=k).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = short = 0
    for q in range(0, n, 50):
        score = v @ v[q]
        score[q] = -np.inf
        short += len(got.get(q, ())) < k
        hits += len(got.get(q, set()) & set(np.argsort(-score)[:k].tolist()))
    print("recall", lengths, "short", short, hits / (k * (n // 50)))
    assert not short and hits / (k * (n // 50)) >= 0.9


def test_queries_without_candidates_meet_every_row(spark):
    """Members crowd around one axis, the query points away from it: no cell it probes holds any."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(200, 16)) * 1e-3
    v[:, 0] += 1.0
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(500, [-1.0] + [0.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.filter("vec_id = 500"), k=20, tables=1, probes=1, block=64).collect()
    want = brute([(i, np.array(x)) for i, x in rows], [(500, np.array(rows[-1][1]))], 20)[500]
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [i for i, _ in want]


def test_nearest_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df, df).count() == 0


def exact_ranks(vectors, queries, k):
    """query -> ids of the k largest inner products, ties to the smaller id (whole numbers, so no rounding)."""
    out = {}
    for q in queries:
        score = vectors @ vectors[q]
        order = [i for i in np.lexsort((np.arange(len(score)), -score)) if i != q]
        out[q] = [(int(i), float(score[i])) for i in order[:k]]
    return out


def ranks(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_a_thousand_equal_scores_go_to_the_smallest_ids(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(-3, 4, (1001, 16)).astype(float)
    v[:, 0] = 2  # the query is the first axis: every score is 2
    v[1000] = np.eye(16)[0]
    v[:1000, 1:] += np.arange(1000)[:, None] % 7 * 10  # all different
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(5)
    df = df.withColumns({"score": F.lit("clash"), "id": F.lit(1), "cells": F.lit(None)})
    # all cells are probed, so every member is a candidate
    got = ranks(ann.nearest(df, df.filter("vec_id = 1000"), k=20, probes=32, block=100).collect())
    assert got == {1000: [(i, 2.0) for i in range(20)]}


def test_whole_number_vectors_equal_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(-2, 3, (1500, 64)).astype(float)
    v[np.all(v == 0, axis=1), 0] = 1
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    asked = range(0, 1500, 30)
    got = ranks(ann.nearest(df, df.filter("vec_id % 30 = 0"), k=20, probes=128, block=300).collect())
    assert got == exact_ranks(v, asked, 20)


def test_best_takes_every_tie_at_the_cut():
    rng = np.random.default_rng(4)
    x = rng.integers(-2, 3, (400, 8)).astype(float)
    q = rng.integers(-2, 3, (9, 8)).astype(float)
    ids = rng.permutation(400).astype(np.int64)
    who, found, score = ann._best(q, np.arange(9), x, ids, np.ones(400, np.int64), np.arange(400), 21)
    for k in range(9):
        exact = x @ q[k]
        order = np.lexsort((ids, -exact))[:21]
        assert found[who == k].tolist() == ids[order].tolist() and score[who == k].tolist() == exact[order].tolist()


def test_small_tables_are_hashed_too(spark):
    """500 and 2,000 vectors: queries do not meet every member, and recall stays over 0.9."""
    rng = np.random.default_rng(6)
    for n in (500, 2000):
        v = rng.normal(size=(n, 64))
        v /= np.linalg.norm(v, axis=1)[:, None]
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
        band, hashed = ann.bands(ann.usable(df, "vec_id", "embedding"))
        assert [len(c) for c in hashed.values()] == [1]
        probing = ann.cells_column(F.col("vec"), F.size("vec"), F.lit(0), ann.TABLES, ann.PROBES, 7, False, hashed)
        cells = [r[0] for r in ann.usable(df, "vec_id", "embedding").select(probing).limit(20).collect()]
        assert all(len(c) < ann.TABLES * 128 for c in cells)
        got = ranks(ann.nearest(df, df.filter("vec_id % 20 = 0")).collect())
        want = {q: {i for i, _ in found} for q, found in exact_ranks(v, range(0, n, 20), 20).items()}
        assert sum(len({i for i, _ in got[q]} & ids) for q, ids in want.items()) >= 0.9 * 20 * len(want)
