"""Token counts at every prefix of a text (operator 5).

Method: prefix dynamic programming.  Inside one pre-token the encoding of a
prefix that ends with token ``t`` is the encoding of what precedes ``t``
plus ``t``, and that holds for exactly one vocabulary token: the one that
stays apart from its left neighbour under the merge rules.  So one pass
over a pre-token stores the last token and the count at each byte; counts
at code points follow.  Over a text the counts are kept as one signed byte
per code point, the change of the count, and answer every truncation or
budget question by a running sum without encoding again.

Defined results: null text counts as empty (0 tokens, no deltas); repeated
rows and ids stay, one result row per input row; an empty table gives an
empty result.  Columns other than the named two are not read.
"""

from __future__ import annotations

import json
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.bpe import KEPT_BYTES, SPECIAL, UnitCache, as_texts
from fundlake.llm.common import tokenizer_path

#: The byte-level pre-tokenizer's pattern (fixed values; blanks by Unicode's White_Space).
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: No left neighbour; and what separates the two ids in a key.
NONE, SHIFT = 1 << 20, 1 << 21
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
BLANK_RUNS = regex.compile(r"\p{White_Space}{2,}")


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others are numbered from 256 on in ascending order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def signed_bytes(counts: list[int]) -> bytes:
    return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])


class PrefixCounter:
    """Prefix counts of one byte-level BPE vocabulary."""

    def __init__(self, path: str | None = None):
        with open(path or tokenizer_path(), encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        self.ids = {raw(t): i for t, i in model["vocab"].items() if all(c in alphabet for c in t)}
        self.raw = {i: t for t, i in self.ids.items()} | {NONE: b""}
        self.longest = max(map(len, self.ids))
        self.rank = {}
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[raw(a), raw(b)] = i
        self._apart: dict[int, bool] = {}
        self._words: dict[str, bytes] = {}
        self.most_words = 200_000
        self.cache = UnitCache(self.many_deltas, step=12 << 20)

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging by lowest rank; only used on at most two tokens' bytes."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def apart(self, key: int) -> bool:
        """True if the two tokens of the key (left * SHIFT + right) side by side are
        encoded as just these two; the left one may be NONE."""
        left, right = self.raw[key // SHIFT], self.raw[key % SHIFT]
        got = self.merged(left + right) == ([left, right] if left else [right])
        if len(self._apart) > 400_000:
            self._apart.clear()
        self._apart[key] = got
        return got

    def extend(self, data: bytes, last: list[int], count: list[int], start: list[int]) -> None:
        """Continue the program over data: last token, count and the last token's start
        after each byte, in place, from where the lists end (they hold the empty prefix
        at first).  Exactly one start fits, so the likeliest are tried first: where the
        token before began, then shorter tokens before longer ones."""
        ids, known, longest = self.ids, self._apart, self.longest
        for i in range(len(last), len(data) + 1):
            guess = start[i - 1]
            for j in chain((guess,), range(i - 1, max(-1, i - 1 - longest), -1)):
                t = ids.get(data[j:i])
                if t is not None:
                    key = last[j] * SHIFT + t
                    ok = known.get(key)
                    if ok or ok is None and self.apart(key):
                        last.append(t)
                        count.append(count[j] + 1)
                        start.append(j)
                        break
            else:
                raise ValueError(f"no token ends at byte {i}")

    def learn(self, words: set[str]) -> None:
        """Deltas of new pre-tokens.  In sorted order a word goes on from the prefix
        it shares with the one before."""
        before, last, count, start = b"", [NONE], [0], [0]
        for data, word in sorted((w.encode(), w) for w in words):
            same = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                same += 1
            del last[same + 1:], count[same + 1:], start[same + 1:]
            self.extend(data, last, count, start)
            before, counts = data, count
            if len(data) != len(word):
                counts = [0, *(count[e] for e in accumulate(len(c.encode()) for c in word))]
            if word in LONG_CONTRACTIONS:  # cut short, the letter is a word of its own
                counts = [0, count[1], count[1] + 1, count[3]]
            self._words[word] = signed_bytes(counts)

    def word_deltas(self, word: str) -> bytes:
        """Change of the count at each code point of one pre-token, as signed bytes."""
        if word not in self._words:
            self.learn({word})
        return self._words[word]

    def plain_deltas(self, text: str) -> bytes:
        """Deltas of a text in which the special string counts as ordinary text."""
        out = b"".join(map(self.word_deltas, WORDS.findall(text)))
        if not BLANK_RUNS.search(text):
            return out
        # a prefix that ends inside a run of blanks has the run so far as one pre-token
        counts = counts_from_deltas(out)
        for m in BLANK_RUNS.finditer(text):
            s, e = m.span()
            counts[s + 1:e + 1] = counts[s] + counts_from_deltas(self.word_deltas(m[0]))[1:]
        return signed_bytes(counts.tolist())

    def many_deltas(self, units: list[bytes]) -> list[bytes]:
        """Deltas of many units: their new pre-tokens are learnt together first."""
        texts = [u.decode() for u in units]
        words = [WORDS.findall(t) for t in texts]
        new = set().union(*words) - self._words.keys()
        if len(self._words) + len(new) > self.most_words:
            self._words.clear()
            new = set().union(*words)
        self.learn(new)
        got = self._words
        out = [b"".join(map(got.__getitem__, ws)) if SPECIAL not in t and not BLANK_RUNS.search(t)
               else self.unit_deltas(t) for t, ws in zip(texts, words)]
        for w in [w for w in got if len(w) > KEPT_BYTES]:
            del got[w]
        return out

    def unit_deltas(self, text: str) -> bytes:
        if SPECIAL not in text:
            return self.plain_deltas(text)
        parts = text.split(SPECIAL)
        counts = [0]
        for part in parts[:-1]:
            # until its last character has come, the special string is ordinary text
            here = counts_from_deltas(self.plain_deltas(part + SPECIAL[:-1])) + counts[-1]
            counts += here[1:].tolist()
            counts.append(int(here[len(part)]) + 1)
        return signed_bytes(counts) + self.plain_deltas(parts[-1])

    def deltas(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(deltas of all texts as int8, offset of each text; one more at the end)."""
        data, offs = self.cache.expand(as_texts(texts))
        return data.view(np.int8), offs


_COUNTERS: dict = {}


def shared_counter(path: str | None = None) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def counts_from_deltas(deltas) -> np.ndarray:
    """Tokens at every prefix, from the empty one on."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(deltas, np.int8), dtype=np.int64)])


def fitting_prefix(deltas, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts_from_deltas(deltas) <= budget)[-1])


def prefix_counts_column(text_col, budget: int = 1024, path: str | None = None):
    """Column struct<n_tokens long, fit_chars long, deltas binary>: the whole text's
    count, the code points of the longest prefix within the budget, and the
    stored counts."""

    @arrow_udf("struct<n_tokens:bigint,fit_chars:bigint,deltas:binary>")
    def counted(texts: pa.Array) -> pa.Array:
        data, offs = shared_counter(path).deltas(texts)
        total, fit = np.zeros(len(texts), np.int64), offs[1:] - offs[:-1]
        for i, (lo, hi) in enumerate(zip(offs.tolist(), offs[1:].tolist())):
            total[i] = data[lo:hi].sum(dtype=np.int64)
            if hi - lo > budget or total[i] > budget:
                fit[i] = fitting_prefix(data[lo:hi], budget)
        raw = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(data)])
        return pa.StructArray.from_arrays(
            [pa.array(total, pa.int64()), pa.array(fit, pa.int64()), raw.cast(pa.binary())],
            names=["n_tokens", "fit_chars", "deltas"])

    return counted.asNondeterministic()(text_col)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 1024,
                 path: str | None = None) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit, fit_chars, deltas."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = df.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"),
                        prefix_counts_column(text, budget, path).alias("_c"))
    return counted.select(
        id_col, "n_bytes", F.col("_c.n_tokens").alias("n_tokens"),
        (F.col("_c.n_tokens") > budget).alias("over_limit"), F.col("_c.fit_chars").alias("fit_chars"),
        F.col("_c.deltas").alias("deltas"))
