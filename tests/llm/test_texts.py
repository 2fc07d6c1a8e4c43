"""Operators 1, 2, 3, 8: licences, sampled segmentations, surrogates, toxicity."""

import itertools
import os
import zlib
import re
from collections import Counter

import numpy as np
import pytest

from fundlake.llm import licenses, pii, spm_sample, toxicity
from fundlake.llm.license_templates import templates


@pytest.mark.parametrize("text, want", [
    ("Licensed under the GNU General Public License.", []), ("Licensed under the GNU General Public License, version 1.", []),
    ("Licensed under the Apache License, Version 1.1", []), ("Licensed under the Mozilla Public License 1.1", []),
    ("This work is licensed under a Creative Commons Attribution 2.0 License.", []),
    ("Distributed under the terms of the Python License", []), ("Licensed under the GNU General Public License, version 2.1.", []),
    ("Licensed under the GNU General Public License, version 2.", ["GPL-2.0"]), ("Released under the MIT Licence.", ["MIT"]),
    ("Licensed under the GNU General Public License, version 2.0.", ["GPL-2.0"]), ("Licensed under Apache License 2.0", ["Apache-2.0"]),
    ("licensed under the Mozilla Public License, version 2.0 here", ["MPL-2.0"]),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]),
    ("Licensed under the GNU Lesser General Public License, version 2.1, please", ["LGPL-2.1"])])
def test_a_notice_names_its_own_licence_or_none(text, want):
    assert [x["license"] for x in licenses.shared_scanner(0.8).scan(text)] == want
    assert [x["license"] for x in licenses.shared_scanner(0.8).scan("Some words before. " + text + " And some words after it.")] == want


def test_a_header_of_another_version_is_not_taken_for_a_known_one():
    from fundlake.llm.license_templates import GNU_HEADER

    scan = licenses.shared_scanner(0.8).scan
    assert [x["license"] for x in scan(GNU_HEADER.format("", 3, ""))] == ["GPL-3.0"]
    assert [x["license"] for x in scan(GNU_HEADER.format("", 1, ""))] == []


# ---------------------------------------------------------------- licences
def slow_best(text, known, threshold=0.8):
    """Every passage against every template, all pairs of places."""
    words = licenses.words_of(text)
    best = (0.0, None)
    for name, t in known:
        w = licenses.words_of(t)
        target = Counter(zip(w, w[1:]))
        n = target.total()
        for i in range(len(words) - 1):
            for j in range(i + 2, min(len(words), i + 2 * n + 2) + 1):
                c = licenses.dice(Counter(zip(words[i:j], words[i + 1:j])), target)
                best = max(best, (c, name), key=lambda x: x[0])
    return best if best[0] >= threshold else (0.0, None)


def test_scan_against_every_passage():
    known = [("A", "licensed under the mit license"), ("B", "this work is licensed under cc by nc 4 0"),
             ("C", "permission is hereby granted to use the software for any purpose")]
    scanner = licenses.Scanner(known)
    texts = ["nothing here at all", "Released; licensed under the MIT License.", "x y this work is licensed under CC BY-NC 4.0 z",
             "this work is licenced under cc by 4 0", "permission is granted to use the software, for any purpose!",
             "licensed under licensed under the mit licence", "", "one"]
    for t in texts:
        got = scanner.scan(t)
        want = slow_best(t, known)
        assert (max(g["score"] for g in got) if got else 0.0) == pytest.approx(want[0]), t


def slow_all(text, known, threshold=0.8):
    """(name, first word, last word) of all passages of all templates, chosen best first."""
    words, found = licenses.words_of(text), []
    for name, t in known:
        w = licenses.words_of(t)
        target = Counter(zip(w, w[1:]))
        n = target.total()
        at = [i for i in range(len(words) - 1) if (words[i], words[i + 1]) in target]
        for i in at:
            have, common = Counter(), 0
            for j in (j for j in at if i <= j < i + 2 * n):
                gram = (words[j], words[j + 1])
                have[gram] += 1
                common += have[gram] <= target[gram]
                c = 2 * common / (j - i + 1 + n)
                if c >= threshold:
                    found.append((-c, -n, name, i, j + 1))
    out = []
    for f in sorted(found):
        if all(f[4] < o[3] or f[3] > o[4] for o in out):
            out.append(f)
    return sorted((f[3], f[4], f[2]) for f in out)


def test_an_edited_copy_before_a_better_one_stays():
    known = [(n, t) for n, t in templates() if n in ("MIT", "ISC") and len(t) > 300]
    scanner = licenses.Scanner(known)
    rng, two = np.random.default_rng(3), 0
    for _, text in [(n, " ".join(t.split())) for n, t in known] * 4:
        copies = []
        for share in (0.05, 0.02, 0.0):
            words = text.split()
            for i in np.flatnonzero(rng.random(len(words)) < share):
                words[i] = f"edited{i}"
            copies.append(" ".join(words))
        for order in itertools.permutations(copies, 2):
            whole = " Copyright (c) 2001 by some one else. ".join(order)
            got = sorted((i, j, scanner.names[t]) for _, t, i, j in scanner.passages(licenses.words_of(whole)))
            assert got == slow_all(whole, known)
            two += len(got) == 2 and order[1] == text
    assert two >= 8


def test_full_texts_and_notices_are_found():
    scanner = licenses.Scanner(templates())
    for name, text in templates()[::9] + templates()[-14:]:
        got = scanner.scan("Some words before it.\n\n" + text + "\n\nand some after it")
        assert got and max(g["score"] for g in got) == pytest.approx(1.0)
        assert name in {g["license"] for g in got}


def test_whole_legal_texts_are_found():
    """The whole text, one word in fifty edited and without its last tenth (an appendix, if it has one)."""
    scanner, rng = licenses.Scanner(templates()), np.random.default_rng(4)
    whole = {n: t for n, t in templates() if len(t) > 5000}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "GFDL-1.3"} <= set(whole)
    for name, text in whole.items():
        words = text.split()[:len(text.split()) * 9 // 10]
        for i in np.flatnonzero(rng.random(len(words)) < 0.02):
            words[i] = f"edited{i}"
        text = "Some words before it. " + " ".join(words) + " and some after it"
        got = scanner.scan(text)
        assert name in {g["license"] for g in got if g["end"] - g["start"] > 0.8 * len(text)}, name


def test_scan_rows(spark, hard, empty):
    df = spark.createDataFrame([(1, "A poem. Released under the MIT License. The end."), (2, None), (3, "")],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[1].license == "MIT" and got[1].score == 1.0
    assert "A poem. Released under the MIT License. The end."[got[1].licenses[0].start:got[1].licenses[0].end] == \
        "Released under the MIT License"
    assert got[2].license is None and got[2].n_licenses == 0 and got[3].licenses == []
    assert licenses.scan(hard).count() == hard.count() and licenses.scan(empty).count() == 0


# ---------------------------------------------------------------- sampled segmentations
@pytest.fixture(scope="module")
def pieces():
    return spm_sample.Pieces()


def all_paths(p, text):
    t = p.sp.normalize(text)
    out = {}

    def go(i, ids, lp):
        if i == len(t):
            out[tuple(ids)] = lp
            return
        known = False
        for j in range(i + 1, min(len(t), i + p.longest) + 1):
            k = p.sp.piece_to_id(t[i:j])
            if p.text[k] == t[i:j] and np.isfinite(p.logp[k]):
                known = known or j == i + 1
                go(j, [*ids, k], lp + p.logp[k])
        if not known:
            go(i + 1, [*ids, *p.fallback(t[i])], lp + p.byte_logp * len(p.fallback(t[i])))

    go(0, [], 0.0)
    z = np.logaddexp.reduce(list(out.values()))
    return {k: v - z for k, v in out.items()}


@pytest.mark.parametrize("text", ["ab cat", "the\nend 水", "hi"])
def test_samples_follow_the_distribution_without_replacement(pieces, text):
    paths, n = all_paths(pieces, text), 6000
    first, pair = Counter(), Counter()
    for _, rows in itertools.groupby(spm_sample.sample_texts(list(range(n)), [text] * n, pieces, 3, 5), key=lambda r: r[0]):
        rows = list(rows)
        ids = [tuple(np.frombuffer(r[2], "<u4").tolist()) for r in rows]
        assert len(set(ids)) == len(ids) == min(3, len(paths))
        assert all(r[3] == pytest.approx(paths[i], abs=1e-9) for r, i in zip(rows, ids))
        values = [r[4] for r in rows]
        assert values == sorted(values, reverse=True)
        first[ids[0]] += 1
        pair[ids[0], ids[1]] += 1
    for i, lp in paths.items():
        assert first[i] / n == pytest.approx(np.exp(lp), abs=0.03)
        for j in paths:
            if i != j:
                assert pair[i, j] / n == pytest.approx(np.exp(lp + paths[j]) / -np.expm1(lp), abs=0.03)


def test_inclusion_scores_estimate_sums(pieces):
    """Horvitz-Thompson: each sampled path's probability over its inclusion, without the threshold's path, sums to 1."""
    n, total = 3000, 0.0
    for row in spm_sample.sample_texts(list(range(n)), ["ab cat"] * n, pieces, 3, 11):
        total += np.exp(row[3] - row[5])
    assert total / n == pytest.approx(1.0, abs=0.03)


def test_same_key_same_samples_however_batched(pieces):
    texts = ["the quick brown fox", "jumps over", "the lazy dog", ""]
    together = list(spm_sample.sample_texts([1, 2, 3, 4], texts, pieces, 2, 9))
    alone = [r for k, t in zip([1, 2, 3, 4], texts) for r in spm_sample.sample_texts([k], [t], pieces, 2, 9)]
    assert [r[:3] for r in together] == [r[:3] for r in alone]


def test_sample_rows_and_decoding(spark, hard, empty):
    from pyspark.sql import functions as F

    rows = spm_sample.sample(hard, k=2).withColumn("back", spm_sample.decode_column(F.col("ids"))).collect()
    texts = Counter((r.doc_id, r.text or "") for r in hard.collect())
    for r in rows:
        assert (r.doc_id, r.back) in texts and r.n_pieces * 4 == len(r.ids) and r.log_inclusion <= 0
    assert {r.doc_id for r in rows} == {k for k, _ in texts}
    assert sum(1 for r in rows if r.doc_id == 2) == 1  # an empty text has one segmentation
    assert spm_sample.sample(empty).count() == 0


# ---------------------------------------------------------------- surrogates
@pytest.mark.parametrize("pattern", ["ab1", "12", "Ab", "q7"])
def test_permutation_is_one_to_one(pattern):
    groups = [pii.CLASSES[c] for c in pattern]
    every = {"".join(x) for x in itertools.product(*groups)}
    assert {pii.permute(x, b"k", "t") for x in every} == every


def test_surrogates_keep_type_and_format():
    text = ("Mr. John Smith <john.smith99@mail3.example.com>, +1 (017) 555-7713. Smith paid 4111 1111 1111 1111 from 192.168.1.7 "
            "and 8.8.8.8; DE89 3704 0044 0532 0130 00; token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"; Frau Anna Weiß")
    new, found = pii.replaced(text, b"key")
    assert new == pii.replaced(text, b"key")[0] and new != pii.replaced(text, b"other")[0]
    by = {}
    for kind, s, e, v in found:
        by.setdefault(kind, []).append((text[s:e], v))
        assert v != text[s:e]
    for kind in ("email", "phone", "secret", "ip", "card", "iban"):
        for old, v in by[kind]:
            assert old not in new
            assert [c if not c.isalnum() else "x" for c in v] == [c if not c.isalnum() else "x" for c in old] or kind == "ip"
    assert by["phone"][0][1].startswith("+1 (") and by["email"][0][1].endswith(".example.com")
    card = "".join(c for c in by["card"][0][1] if c.isdigit())
    assert pii.luhn(card)
    iban = by["iban"][0][1].replace(" ", "")
    assert iban[:2] == "DE" and pii.iban_digits(iban[:2], iban[4:]) == iban[2:4]
    assert [pii.ip_kind(v) for _, v in by["ip"]] == ["private", "public"]
    names = dict(by["name"])
    assert names["John"] in pii.GIVEN["m"] and names["Anna"] in pii.GIVEN["f"]
    assert sum(v == names["Smith"] for _, v in by["name"]) == 2  # the same person twice
    assert set("".join(by["secret"][0][1])) <= set("0123456789abcdef")


def test_given_names_stay_in_their_list():
    for group, names in pii.GIVEN.items():
        assert sorted(pii.name(n, b"k", "") for n in names) == sorted(names)
        assert all(pii.name(n, b"k", "") != n for n in names)


def test_distinct_numbers_stay_distinct_and_grouping_does_not_matter():
    numbers = [f"{i:07d}" for i in range(0, 3000)]
    out = {pii.phone(f"+1 (555) {n[:3]}-{n[3:]}", b"k", "") for n in numbers}
    assert len(out) == len(numbers)
    digits = lambda s: "".join(c for c in s if c.isdigit())
    assert digits(pii.card("4111 1111 1111 1111", b"k", "")) == pii.card("4111111111111111", b"k", "")


@pytest.mark.parametrize("text", [
    *[" ".join(f"{form} {n}," for n in names) for form, names in (("Mr.", pii.GIVEN["m"]), ("Mrs.", pii.GIVEN["f"]),
                                                                  ("господин", pii.GIVEN["m-cyrillic"]))],
    " ".join(f"Mr. {n}," for n in pii.GIVEN["m"][:30]),
    " ".join(f"Dr. {a}{b}," for a in "BCDFGHJKLMNPQRSTVWXZ" for b in "aeiouy"),  # the whole pattern
    " ".join(f"{c}@x.com" for c in "aeiouy"), "Mr. שרה, Mr. דוד"])
def test_no_surrogate_is_shared_or_an_original_however_many(text):
    found = pii.replaced(text, b"k")[1]
    originals = {text[s:e] for _, s, e, _ in found}
    new = {text[s:e]: v for _, s, e, v in found}
    assert len(originals) >= 2 and len(set(new.values())) == len(new) and not originals & set(new.values())


def test_only_values_drawn_again_collide_in_the_corpus(spark):
    docs = [(i, f"Mr. {a} met Mr. {b} there") for i, (a, b) in enumerate(itertools.combinations(pii.GIVEN["m"], 2))]
    first = lambda n: pii.name(n, pii.DEFAULT_KEY, "")
    again = set()
    for i, t in docs:
        new = {t[s:e]: v for _, s, e, v in pii.replaced(t, pii.DEFAULT_KEY)[1]}
        assert len(set(new.values())) == 2 and not set(new) & set(new.values())
        assert set(new.values()) <= set(pii.GIVEN["m"])
        if any(first(n) != v for n, v in new.items()):
            again.add(i)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert 0 < len(again) <= 45 and pii.collisions(frame.filter(~frame["doc_id"].isin(sorted(again)))).count() == 0
    assert pii.collisions(frame).count() <= len(again)


def script_of(c):
    import unicodedata

    return unicodedata.name(c).split(" ")[0]


@pytest.mark.parametrize("text, names", [
    ("Mr محمد came", ["محمد"]), ("Mrs שרה came", ["שרה"]), ("Dr प्रिया came. So प्रिया left", ["प्रिया"] * 2), ("Dr Łukasz Żak", ["Łukasz", "Żak"]),
    ("Prof Χαράλαμπος here", ["Χαράλαμπος"]), ("Mr สมชาย", ["สมชาย"])])
def test_names_keep_their_script(text, names):
    new, found = pii.replaced(text, b"key")
    assert [text[s:e] for _, s, e, _ in found] == names
    for old, (_, _, _, v) in zip(names, found):
        assert len(v) == len(old) and v != old
        changed = [(a, b) for a, b in zip(old, v) if a.isalpha()]
        assert all(script_of(a) == script_of(b) and a.isupper() == b.isupper() for a, b in changed)
        assert all(a != b for a, b in changed) or len(changed) > 2


def test_an_address_stays_in_its_block():
    for block in pii.BLOCKS:
        for at in (1, 7, block.num_addresses // 3, block.num_addresses - 2):
            value = str(block[at])
            new = pii.ip(value, b"key", "")
            assert pii.block_of(int(__import__("ipaddress").IPv4Address(new))) == pii.block_of(int(block[at])), (value, new)
    public = {pii.ip(f"8.8.{i}.{j}", b"key", "") for i in range(20) for j in range(50)}
    assert len(public) == 1000 and all(pii.ip_kind(x) == "public" for x in public)


def test_possessive_is_the_same_person():
    text = "Mr Smith came. Smith's car, Smith\u2019s dog, O'Smith and Smith-Jones stay; Mrs O'Brien and O'Brien's hat"
    new, found = pii.replaced(text, b"key")
    by = {}
    for _, s, e, v in found:
        by.setdefault(text[s:e], []).append(v)
    assert {k: (len(v), len(set(v))) for k, v in by.items()} == {"Smith": (3, 1), "O'Brien": (2, 1)}
    assert "'s car" in new and "\u2019s dog" in new and "O'Smith and Smith-Jones" in new


@pytest.mark.parametrize("text, clear", [
    ("Señora María José García López vino", {"María", "José", "García", "López"}), ("Dr Jean Paul van Damme left", {"Jean", "Paul", "Damme"}),
    ("Maria Lopez called. Then Lopez left", {"Maria", "Lopez"}), ("Herr Anton von der Heide", {"Anton", "Heide"}),
    ("Sr Juan Pérez y Soto", {"Juan", "Pérez", "Soto"}), ("Иван Петров пришёл", {"Иван", "Петров"})])
def test_whole_names_go(text, clear):
    new, found = pii.replaced(text, b"key")
    assert {text[s:e] for _, s, e, _ in found} == clear and not clear & set(re.findall(r"\w+", new))


@pytest.mark.parametrize("text", ["Max said so", "The Mark of Paul is", "Marie. Lopez", "van Damme went", "a Will be"])
def test_words_that_are_no_names_stay(text):
    assert pii.replaced(text, b"key")[1] == []


def test_query_against_a_check_of_every_row(spark, docs):
    """Each row of the query by rules written apart from the operator: text outside the entities stays, one original has
    one surrogate in a document, no two share one, none is an original, types keep their check digits and shape."""
    from fundlake.llm import queries

    got = {r.doc_id: r for r in queries.op3_pii_surrogates(spark, "/root/testdata/sf0.001").collect()}
    everywhere, kinds = {}, Counter()
    for d in docs.collect():
        r, text = got[d.doc_id], d.text or ""
        assert r.n_entities == len(r.entities)
        at, rest, new_rest, mine, pos = 0, [], [], {}, 0
        for e in sorted(r.entities, key=lambda e: e.start):
            assert e.start >= at
            rest.append(text[at:e.start])
            new_rest.append((r.text or "")[pos:pos + e.start - at])
            pos += e.start - at
            assert (r.text or "")[pos:pos + len(e.surrogate)] == e.surrogate
            pos, at = pos + len(e.surrogate), e.end
            old = text[e.start:e.end]
            assert mine.setdefault((e.kind, old), e.surrogate) == e.surrogate != old
            everywhere.setdefault((e.kind, old), set()).add(e.surrogate)
            kinds[e.kind] += 1
            shape = lambda x: re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "0", x))
            if e.kind in ("phone", "card", "ssn", "email"):
                assert shape(e.surrogate) == shape(old) or len(e.surrogate) > len(old)
            if e.kind == "card":
                digits = ["".join(c for c in x if c.isdigit()) for x in (old, e.surrogate)]
                assert len({sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(x))) % 10 == 0
                            for x in digits}) == 1
        assert rest == new_rest and text[at:] == (r.text or "")[pos:]
        assert len(set(mine.values())) == len(mine) and not {v for _, v in mine} & set(mine.values())
    assert kinds["email"] >= 5 and sum(len(v) == 1 for v in everywhere.values()) >= 0.9 * len(everywhere)


def test_surrogate_rows(spark, hard, empty):
    from pyspark.sql import functions as F

    rows = pii.surrogates(hard).collect()
    assert len(rows) == hard.count()
    assert Counter(r.text for r in rows) == Counter(r.text for r in hard.collect())  # nothing personal there
    df = spark.createDataFrame([(1, "write to a.b@mail1.example.com", 30), (2, None, 0)], "doc_id long, text string, n_chars long")
    new = {r.doc_id: r for r in pii.with_surrogates(df).collect()}
    assert new[2].text is None and new[1].n_chars == len(new[1].text) and "a.b@" not in new[1].text
    many = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("Herr Klaus Muster"), F.col("id"), F.lit(
        " mail x"), F.col("id"), F.lit("@mail.example.com 555-010-"), F.lpad(F.col("id"), 4, "0")).alias("text"))
    assert pii.collisions(many).count() == 0
    assert pii.surrogates(empty).count() == 0


# ---------------------------------------------------------------- toxicity
def made_up(n, seed, bad):
    rng = np.random.default_rng(seed)
    common = ["the", "of", "and", "thing", "river", "stone", "house", "walk", "green", "over"]
    insults = ["blockhead", "dimwit", "nitwit"]
    out = []
    for _ in range(n):
        words = list(rng.choice(common, 60)) + ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(20)]
        if bad:
            words += list(rng.choice(insults, 3))
        rng.shuffle(words)
        out.append(" ".join(words))
    return out


def test_learns_the_marking_words(spark, hard, empty):
    texts = made_up(150, 1, True) + made_up(300, 2, False)
    model = toxicity.fit([t.encode() for t in texts], [1] * 150 + [0] * 300, 1 / 3)
    windows = toxicity.Windows(model.ordinary, model.toxic, model.settings)
    bad = [toxicity.score_text(windows, model, t.encode()) for t in made_up(60, 3, True)]
    good = [toxicity.score_text(windows, model, t.encode()) for t in made_up(120, 4, False)]
    assert np.mean(np.array(bad) >= 0.5) > 0.9 and np.mean(np.array(good) >= 0.5) < 0.1
    rows = toxicity.score(hard, model).collect()
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    kept = toxicity.keep_clean(hard, model)
    assert kept.columns == hard.columns and toxicity.score(empty, model).count() == 0


def test_every_marking_word_is_in_the_section():
    names = [f"{a}{b}{c}thing{c}{b}{a}" for a, b, c in itertools.product("bcdfghjk", "aeiou", "lmnpr")]
    toxic = [f"{n} {names[i - 1]} {names[i - 2]} river" for i, n in enumerate(names)] * 9
    section = toxicity.marking_section([t.encode() for t in toxic], [b"river stone house"] * 4000, toxicity.Settings())
    assert len(section) > 1024 and all(n.encode() in section for n in names)


def test_ordinary_dictionary_reads_the_whole_text():
    s, size = toxicity.Settings(), 60_000
    starts = toxicity.spread(size, s.most_blocks, s.block)
    assert len(starts) == s.most_blocks and starts[0] == 0 and starts[-1] == size - s.block
    assert max(b - a for a, b in zip(starts, starts[1:])) < size / 6
    tail = [(" ".join(made_up(60, i, False)) + " tabulated appendix figures" * 400).encode() for i in range(40)]
    assert b"appendix" in toxicity.ordinary_base(tail, s)


def test_without_labels_every_score_is_the_share(spark, hard):
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    model = toxicity.train(hard, labels)
    assert {r.score for r in toxicity.score(hard, model).collect()} == {0.0}


def test_held_out_accuracy(spark):
    """Accuracy on the labelled documents that training never reads."""
    sf = "/root/testdata/sf0.1"
    if not os.path.exists(sf):
        pytest.skip("test data not present")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    known = docs.join(labels.select("doc_id", "toxic"), "doc_id").filter(toxicity.held_out(docs["doc_id"]))
    rows = toxicity.score(known, model).join(known.select("doc_id", "toxic"), "doc_id").collect()
    right = np.mean([r.predicted == r.toxic for r in rows])
    share = np.mean([r.toxic for r in rows])
    bad, good = ([r.score for r in rows if r.toxic == y] for y in (1, 0))
    auc = np.mean([a > b for a in bad for b in good])
    assert right > 1 - share and auc > 0.9


def test_the_training_sample_depends_on_the_rows_alone(spark, monkeypatch):
    rows = [(i % 150, f"document {i} " + ("you idiot " if i % 150 < 40 else "a calm word ") * (3 + i % 5)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(150)], "doc_id long, toxic int")
    frame = lambda k: spark.createDataFrame(rows[k:] + rows[:k], "doc_id long, text string").repartition(1 + k % 5)
    a, b = (toxicity.train(frame(k), labels) for k in (0, 133))
    assert (a.ordinary, a.toxic, a.weights) == (b.ordinary, b.toxic, b.weights)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 0)
    assert toxicity.train(frame(0), labels).constant is not None  # nothing fits: the labels' share
