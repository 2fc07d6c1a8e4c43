"""Licence scan (operator 1).

Method: text and templates are normalised to lower-case words, and compared by the
Dice coefficient of their word bigrams (repeats counted), twice the common
ones over the sum of both counts.  A coefficient of at least ``threshold`` t needs a
passage of at least t/(2-t) and at most (2-t)/t times the template's
bigrams, and at least t/(2-t) times as many common ones.  An index from
bigrams to templates gives every template the places its bigrams stand at;
templates with fewer places than their bound are pruned, and so are
passages outside the size bounds.  The rest are compared exactly, passage by passage, at
any place of the whole text.  Passages of all templates are taken best first, and each
leaves out those that overlap it; a start whose best passage is left out so is tried
again with the passages that end before.  In a notice of a few words the licence's name and
version are less than a fifth of the bigrams, so a passage must have all bigrams of both, and its version must end where
the notice's does.

Defined results: null or empty text has no licences; of equal coefficients the
longer template wins, then the smaller identifier, the earlier and the shorter passage; repeated rows get the same
result; an empty table gives no rows.  Columns other than the named two are not
read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.license_templates import required, templates

WORD = re.compile(r"[^\W_]+")
# Spellings that mean the same in licence texts.
SAME = {"licence": "license", "licences": "licenses", "licenced": "licensed", "https": "http", "sublicence": "sublicense"}

OTHER_VERSION = re.compile(r"\d+\.(?!0+(?!\d|\.\d))\d")
#: Templates of more bigrams are indexed apart.
LONG = 500


def words_of(text: str) -> list[str]:
    words = WORD.findall(text.lower())
    return [SAME.get(w, w) for w in words] if "licence" in text.lower() or "https" in text else words


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Scanner:
    """``must`` has, for some template texts, the words that a passage must have."""

    def __init__(self, known: list[tuple[str, str]], threshold: float = 0.8, must: dict[str, str] | None = None):
        self.threshold = threshold
        self.names, self.grams, self.must = [], [], []
        for name, text in known:
            w = words_of(text)
            if len(w) > 1:
                self.names.append(name)
                self.grams.append(Counter(zip(w, w[1:])))
                own = words_of((must or {}).get(text, ""))
                self.must.append(frozenset(zip(own, own[1:])))
        self.sizes = [g.total() for g in self.grams]
        low, high = threshold / (2 - threshold), (2 - threshold) / threshold
        self.least = [max(1, -int(-low * n // 1)) for n in self.sizes]
        self.most = [int(high * n) for n in self.sizes]
        # long templates have an index of their own, left out for texts that are too short for them
        self.index: dict[str, dict[str, list[int]]] = defaultdict(dict)
        self.long_index: dict[str, dict[str, list[int]]] = defaultdict(dict)
        for t, g in enumerate(self.grams):
            index = self.long_index if self.sizes[t] > LONG else self.index
            for a, b in g:
                index[a].setdefault(b, []).append(t)
        self.shortest_long = min((n for n, s in zip(self.least, self.sizes) if s > LONG), default=float("inf"))

    def passages(self, words: list[str]) -> list[tuple[float, int, int, int]]:
        """(coefficient, template, first word, last word) of the best passages, without overlaps."""
        places = defaultdict(list)
        for index in (self.index, self.long_index) if len(words) > self.shortest_long else (self.index,):
            for i, w in enumerate(words[:-1]):
                row = index.get(w)
                if row is not None:
                    for t in row.get(words[i + 1], ()):
                        places[t].append(i)
        # best first: an upper bound per start, replaced by the exact passage when its turn comes
        queue = [(-bound, 0, -self.sizes[t], self.names[t], t, at[a], a, -1) for t, at in places.items()
                 if len(at) >= self.least[t] for a, bound in self._bounds(t, at)]
        heapify(queue)
        out: list = []  # accepted passages, by place
        while queue:
            c, exact, size, name, t, start, a, e = heappop(queue)
            k = bisect_right(out, (start, len(words)))
            if k and out[k - 1][1] >= start:
                continue
            limit = out[k][0] if k < len(out) else len(words)
            if exact and e < limit:
                out.insert(k, (start, e, -c, t))
                continue
            best = self._best(words, t, places[t], a, limit)
            if best:
                heappush(queue, (-best[0], 1, size, name, t, start, a, best[1]))
        return [(c, t, i, j) for i, j, c, t in out]

    def _bounds(self, t: int, at: list[int]) -> Iterator[tuple[int, float]]:
        """(place, bound) of the starts whose best passage may reach the threshold."""
        size, least, most = self.sizes[t], self.least[t], self.most[t]
        if len(at) > 1000:  # vectors pay off
            where = np.array(at)
            ends = np.searchsorted(where, where + most)
            for a in np.flatnonzero(ends - np.arange(len(at)) >= least).tolist():
                span = where[a + least - 1:ends[a]] - where[a]
                places = np.minimum(np.arange(least, least + len(span)), size)
                bound = float((2 * places / (span + 1 + size)).max())
                if bound >= self.threshold:
                    yield a, bound
            return
        for a, start in enumerate(at):
            end = bisect_right(at, start + most - 1, a)
            if end - a < least:
                continue
            # places count repeats beyond the template's own, so this only bounds the coefficient
            bound = max(2 * min(b - a + 1, size) / (at[b] - start + 1 + size) for b in range(a + least - 1, end))
            if bound >= self.threshold:
                yield a, bound

    def _best(self, words: list[str], t: int, at: list[int], a: int, limit: int) -> tuple[float, int] | None:
        """(coefficient, last word) of the best passage that begins at the place and ends at one of the
        template's before the word ``limit``, if it reaches the threshold; of equal ones the shortest."""
        size, start, grams = self.sizes[t], at[a], self.grams[t]
        missing = set(self.must[t])
        used: Counter = Counter()
        common, c, b = 0, 0.0, a
        for e in range(a, bisect_right(at, min(start + self.most[t] - 1, limit - 2), a)):
            gram = (words[at[e]], words[at[e] + 1])
            used[gram] += 1
            missing.discard(gram)
            common += used[gram] <= grams[gram]
            here = 2 * common / (at[e] - start + 1 + size)
            if here > c and not missing:
                c, b = here, e
        return (c, at[b] + 1) if c >= self.threshold else None

    def scan(self, text: str | None) -> list[dict]:
        if not text:
            return []
        best = self.passages(words_of(text))
        if not best:
            return []
        low = text.lower()
        spans = [m.span() for m in WORD.finditer(low)]
        # a number that goes on behind a notice's version is another version: 2 is not 2.1
        best = [p for p in best if not (self.must[p[1]] and OTHER_VERSION.match(low, spans[p[3]][0]))]
        if len(low) != len(text):
            spans = None
        return [{"license": self.names[t], "score": c, "start": spans[i][0] if spans else None,
                 "end": spans[j][1] if spans else None} for c, t, i, j in best]


_SCANNERS: dict = {}


def shared_scanner(threshold: float) -> Scanner:
    if threshold not in _SCANNERS:
        _SCANNERS[threshold] = Scanner(templates(), threshold, required())
    return _SCANNERS[threshold]


FOUND = "array<struct<license:string,score:double,start:int,end:int>>"


def license_column(text_col, threshold: float = 0.8):
    """The licences found, in text order; start and end in code points."""

    @arrow_udf(FOUND)
    def column(texts: pa.Array) -> pa.Array:
        scanner = shared_scanner(threshold)
        kind = pa.list_(pa.struct([("license", pa.string()), ("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([scanner.scan(t) for t in texts.to_pylist()], kind)

    return column.asNondeterministic()(text_col)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """(id, license, score, n_licenses, licenses) per input row: the best one, and all."""
    found = df.select(F.col(id_col), license_column(F.col(text_col), threshold).alias("licenses"))
    best = F.aggregate("licenses", F.lit(None).cast("struct<license:string,score:double,start:int,end:int>"),
                       lambda a, x: F.when(a.isNull() | (x["score"] > a["score"]), x).otherwise(a))
    return found.withColumn("_b", best).select(
        id_col, F.col("_b.license").alias("license"), F.col("_b.score").alias("score"),
        F.size("licenses").alias("n_licenses"), "licenses")
