"""Toxicity by compression distance (operator 8).

Method: two zstandard dictionaries, one of ordinary text, trained by zstandard, and the same
one with a section of what marks toxic text.  A text is cut into short overlapping windows, each window is compressed
with both, and the difference of the two lengths tells which kind of text
predicts the window better.  A calibrated threshold on the windows'
differences (a logistic fit) gives a score between 0 and 1.

A dictionary trained by zstandard on toxic text alone tells the kinds apart far worse (README).
The section holds all substrings at word starts that occur in clearly more toxic than
ordinary training documents (log-likelihood ratio), the strongest nearest
the end, where zstandard's references are cheapest.  The ordinary
dictionary is padded to the same length, so that equal references cost the
same in both and only the toxic section makes a difference.

Fitting reads a bounded sample of labelled documents without near copies: about ``MOST_TOXIC`` and
``MOST_ORDINARY`` of them at most, none over ``MOST_BYTES``, those whose ids hash below the
matching part of the hash range, never held-out ones.  At most twice as many ids, in order of their hash, and at most
``SAMPLE_BYTES`` of text go to the driver; of several texts under one id the one of the smallest digest is read,
so the sample and the model depend on the rows alone.  The calibration sees only documents that the
dictionaries used for it have not seen (two halves, crosswise), and the
intercept is shifted from the sample's to the labels' own share of toxic
documents.  Scoring covers every window of every whole text.

Defined results: null text counts as empty; an empty text has the score of
a text without any toxic window; without toxic or without ordinary training
documents every score is the labels' share of toxic ones (0 if there are no
labels); repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.common import fresh_name

MOST_TOXIC, MOST_ORDINARY, MOST_BYTES = 2_500, 5_000, 65_536
SAMPLE_BYTES = 48 << 20
FOLDS = 5


@dataclass
class Settings:
    window: int = 96
    overlap: int = 24
    ordinary_bytes: int = 16_384
    #: The ordinary dictionary is trained on so many blocks of so many bytes of a text at most.
    most_blocks: int = 8
    block: int = 512
    strategy: int = zstandard.STRATEGY_LAZY2
    #: A marking substring: its length in bytes, the least log-likelihood ratio, the least
    #: documents, and how much more often it occurs in toxic documents.
    shortest: int = 4
    longest: int = 14
    least_ratio: float = 25.0
    least_docs: int = 3
    least_lift: float = 3.0


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: list[float]
    mean: list[float]
    scale: list[float]
    settings: Settings
    constant: float | None = None


def word_starts(text: bytes, s: Settings) -> set[bytes]:
    """Prefixes of the text's words, with the blank before them, and the whole words."""
    words = set(text.lower().split())
    found = {b" " + w[:n] for w in words for n in range(s.shortest, min(len(w), s.longest) + 1)}
    return found | {b" " + w for w in words if len(w) <= s.longest}


def log_likelihood_ratio(a: np.ndarray, n: int, b: np.ndarray, m: int) -> np.ndarray:
    """Signed: positive where a of n is the larger share than b of m."""
    def term(k, expected):
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / expected), 0.0)

    share = (a + b) / (n + m)
    g = 2 * (term(a, n * share) + term(n - a, n * (1 - share) + 1e-9)
             + term(b, m * share) + term(m - b, m * (1 - share) + 1e-9))
    return np.where(a / n > b / m, g, -g)


def marking_section(toxic: list[bytes], ordinary: list[bytes], s: Settings) -> bytes:
    """The substrings that mark toxic text, the strongest last."""
    have: Counter = Counter()
    for t in toxic:
        have.update(word_starts(t, s))
    have = Counter({w: n for w, n in have.items() if n >= s.least_docs})
    other: Counter = Counter()
    for t in ordinary:
        other.update(w for w in word_starts(t, s) if w in have)
    names = sorted(have)
    if not names:
        return b""
    a, b = np.array([have[w] for w in names], float), np.array([other[w] for w in names], float)
    ratio = log_likelihood_ratio(a, len(toxic), b, len(ordinary))
    often = a / len(toxic) >= s.least_lift * b / len(ordinary)
    order = sorted(np.flatnonzero(often & (ratio >= s.least_ratio)),
                   key=lambda i: (-ratio[i], -len(names[i]), names[i]))
    chosen: list[bytes] = []
    for i in order:
        w = names[i]
        if not any(w in c or c in w for c in chosen):
            chosen.append(w)
    return b"".join(reversed(chosen))


def spread(size: int, most: int, block: int) -> list[int]:
    """Starts of at most ``most`` blocks, evenly spread over the whole text."""
    starts = range(0, size, block)
    if len(starts) <= most:
        return list(starts)
    return [k * (size - block) // (most - 1) for k in range(most)]


def ordinary_base(ordinary: list[bytes], s: Settings) -> bytes:
    blocks = [t.lower()[k:k + s.block] for t in ordinary for k in spread(len(t), s.most_blocks, s.block)]
    try:
        return zstandard.train_dictionary(2 * s.ordinary_bytes, blocks, k=48, d=6).as_bytes()[-s.ordinary_bytes:]
    except zstandard.ZstdError:  # too few samples to train on: the text itself
        return b" ".join(blocks)[-s.ordinary_bytes:]


def dictionaries(toxic: list[bytes], ordinary: list[bytes], s: Settings) -> tuple[bytes, bytes]:
    base, section = ordinary_base(ordinary, s), marking_section(toxic, ordinary, s)
    return base + bytes(len(section)), base + section


class Windows:
    """Compressed lengths of a text's windows under two dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes, s: Settings):
        params = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=15, hash_log=16, search_log=4, min_match=4, target_length=8, strategy=s.strategy,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        self.s, self.pair = s, []
        for d in (ordinary, toxic):
            made = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=params)
            self.pair.append(zstandard.ZstdCompressor(dict_data=made, compression_params=params).compress)

    def differences(self, text: bytes) -> np.ndarray:
        text, (plain, marked) = text.lower(), self.pair
        size, step = self.s.window, self.s.window - self.s.overlap
        cuts = [text[k:k + size] for k in range(0, max(1, len(text) - self.s.overlap), step)] if text else []
        return np.array([len(plain(w)) - len(marked(w)) for w in cuts], float)

    def features(self, text: bytes) -> list[float]:
        d = np.sort(self.differences(text))[::-1]
        n = len(d)
        if not n:
            return [0.0] * 8
        strong = int((d >= 3).sum())
        return [d[0], d[1] if n > 1 else 0.0, d[2] if n > 2 else 0.0, float(d.mean()), math.log(n), strong / n,
                math.log1p(strong), math.log1p(int((d >= 2).sum()))]


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps: weights with the intercept first, mean, scale."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-6] + [1.0] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def without_copies(texts: list[bytes], labels: list[int]) -> tuple[list[bytes], list[int]]:
    """The sample without near copies, which would count one text's words many times:
    a text goes if one of four smallest shingle hashes was seen before."""
    seen: set = set()
    out = []
    for t, y in zip(texts, labels):
        words = t.lower().split()
        joined = [b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))]
        keys = {(k, min(zlib.crc32(s, k) for s in joined)) for k in range(4)}
        if not keys & seen:
            out.append((t, y))
        seen |= keys
    return [t for t, _ in out], [y for _, y in out]


def fit(texts: list[bytes], labels: list[int], share: float, s: Settings | None = None) -> Model:
    """A model from training texts; ``share`` is the part of toxic documents among all labelled."""
    s = s or Settings()
    texts, labels = without_copies(texts, labels)
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(b"", b"", [], [], [], s, constant=min(1.0, max(0.0, share)))
    half = np.zeros(len(y), int)
    for k in (0, 1):  # both halves get their part of either label
        half[np.flatnonzero(y == k)[1::2]] = 1

    def split(keep):
        return ([t for t, l, k in zip(texts, y, keep) if k and l], [t for t, l, k in zip(texts, y, keep) if k and not l])

    x = np.zeros((len(y), 8))
    for side in (0, 1):
        seen_from = Windows(*dictionaries(*split(half != side), s), s)
        for i in np.flatnonzero(half == side):
            x[i] = seen_from.features(texts[i])
    w, mean, scale = fit_logistic(x, y)
    mine = y.mean()
    share = min(max(share, 1e-6), 1 - 1e-6)
    w[0] += math.log(share / (1 - share)) - math.log(mine / (1 - mine))
    ordinary, toxic = dictionaries(*split(np.ones(len(y), bool)), s)
    return Model(ordinary, toxic, w.tolist(), mean.tolist(), scale.tolist(), s)


def score_text(windows: Windows, model: Model, text: bytes) -> float:
    z = (np.array(windows.features(text)) - model.mean) / model.scale
    return float(1 / (1 + np.exp(-np.clip(model.weights[0] + z @ model.weights[1:], -30, 30))))


def held_out(id_col) -> F.col:
    return (F.crc32(id_col.cast("string").cast("binary")) % FOLDS).eqNullSafe(F.lit(0))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", settings: Settings | None = None) -> Model:
    """Fit on the bounded sample; held-out ids and null labels or ids are never read."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("y").alias("y")))
    count = known.groupBy("y").count().collect()
    total, toxic = sum(r["count"] for r in count), sum(r["count"] for r in count if r["y"])
    share = toxic / total if total else 0.0
    top = (1 << 62) - 1
    part = lambda n, most: F.lit(int(min(1.0, most / max(1, n)) * top))
    few = F.when(F.col("y") > 0, part(toxic, MOST_TOXIC)).otherwise(part(total - toxic, MOST_ORDINARY))
    by_hash = F.xxhash64("id").bitwiseAND(F.lit(top))
    chosen = known.filter(by_hash <= few).withColumn("h", by_hash).orderBy("h", "id").limit(2 * (MOST_TOXIC + MOST_ORDINARY))
    ids = docs.sparkSession.createDataFrame([tuple(r) for r in chosen.select("id", "y").collect()], "id long, y int")
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
             .filter(F.octet_length("text") <= MOST_BYTES).join(F.broadcast(ids), "id")
             .select("id", "y", "text", F.md5(F.col("text").cast("binary")).alias("digest")))
    # one text per id, whatever repeats; then by hash of the id until the sample's bytes are used
    one = texts.groupBy("id", "y").agg(F.min(F.struct("digest", F.octet_length("text").alias("n"))).alias("t"))
    sizes = sorted(one.select(F.xxhash64("id").alias("h"), "id", "t.digest", "t.n").collect())
    fits = np.cumsum([r["n"] for r in sizes]) <= SAMPLE_BYTES
    kept = [(r["id"], r["digest"]) for r, fit_ in zip(sizes, fits.tolist()) if fit_]
    if not kept:
        return fit([], [], share, settings)
    wanted = docs.sparkSession.createDataFrame(kept, "id long, digest string")
    rows = texts.join(F.broadcast(wanted), ["id", "digest"]).dropDuplicates(["id", "digest"]).collect()
    rows.sort(key=lambda r: (r["id"], r["text"]))
    return fit([r["text"].encode() for r in rows], [r["y"] for r in rows], share, settings)


def score_column(model: Model, text_col):
    """The toxicity score as a column."""

    @arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if model.constant is not None:
            return pa.array([model.constant] * len(texts), pa.float64())
        windows = Windows(model.ordinary, model.toxic, model.settings)
        return pa.array([score_text(windows, model, t) for t in texts.to_pylist()], pa.float64())

    return scored.asNondeterministic()(F.coalesce(text_col, F.lit("")).cast("binary"))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) per input row."""
    scored = df.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"),
                       score_column(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of df that the model does not call toxic, with df's columns."""
    name = fresh_name(df.columns, "_toxicity")
    return df.withColumn(name, score_column(model, F.col(text_col))).filter(F.col(name) < 0.5).drop(name)
