"""SentencePiece sampling without replacement (operator 2).

Method: a normalised text is a lattice of vocabulary pieces, and a path's weight is the
product of its pieces' probabilities.  Each path gets its log probability plus Gumbel
noise; the k largest perturbed values are k distinct segmentations, sampled without
replacement.  They are found by a perturbed A-star search, best first: a set of paths
has one value, the maximum over its paths, drawn from the set's total weight;
splitting a set passes the value on to the part that holds the maximum and draws
smaller ones for the others.  The search takes the set with the largest value, follows it to
one path, and leaves as further sets, per word, "the same up to here, another
segmentation of this word".

Pieces never cross from a character to a following word mark, so a text's
lattice is a chain of independent word lattices; forward sums per
distinct word of a batch give every set's weight.  All distinct words are laid into one
array, pieces are looked up by a rolling hash, and forward sums and draws run over
all words at a time.

A sample comes with its log probability, its perturbed value, and the log of its
inclusion probability given the (k+1)-th value kappa: log(1 - exp(-exp(logp - kappa))).
The draws are seeded by the row's key, so a task that runs again gives the
same samples.

Piece probabilities are the model's scores if it is a unigram model.  A BPE model
scores by merge rank; then a piece of rank r weighs 1 / (r + 2) (Zipf's law).
``alpha`` flattens (below 1) or sharpens the distribution.  Characters without a
piece fall back to their bytes.

Defined results: null text counts as empty; an empty text has one sample without
pieces; fewer than k segmentations give fewer samples, and log inclusion
0 if all are listed; repeated rows with one key get the same samples; null
keys are seeded as such; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.common import PIECE_BPE, Rows, quoted, tokenizer_path

MARK = "▁"
ODD = 0x9E3779B97F4A7C15
INVERSE = pow(ODD, -1, 1 << 64)
#: Texts are worked through in steps of about so many characters.
STEP_CHARS = 3 << 20


class HashTable:
    """Array lookup from 64-bit hashes to numbers; -2 if unknown."""

    def __init__(self, items: dict[int, int], bits: int = 20):
        self.hashes = np.array(list(items), np.uint64)
        self.values = np.array(list(items.values()), np.int64)
        self.levels = []
        left = np.arange(len(items))
        for level in range(64):
            mult, shift = np.uint64(ODD + 2 * level + 2 * level * level * 7919), np.uint64(64 - bits)
            slots = np.full(1 << bits, -1, np.int32)
            at = (self.hashes[left] * mult) >> shift
            slots[at[::-1]] = left[::-1]
            self.levels.append((mult, shift, slots))
            left = left[slots[at] != left]
            if not len(left):
                break

    def get(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -2, np.int64)
        todo = np.arange(len(h))
        for mult, shift, slots in self.levels:
            at = slots[(h[todo] * mult) >> shift]
            hit = (at >= 0) & (self.hashes[at] == h[todo])
            out[todo[hit]] = self.values[at[hit]]
            todo = todo[~hit & (at >= 0)]
            if not len(todo):
                break
        return out


def hash_of(text: str) -> int:
    return sum(ord(c) * pow(ODD, i, 1 << 64) for i, c in enumerate(text)) % (1 << 64)


class Pieces:
    """The vocabulary: pieces, their log probabilities, and byte pieces."""

    def __init__(self, path: str | None = None, alpha: float = 1.0):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path or tokenizer_path(PIECE_BPE))
        n = sp.get_piece_size()
        self.size = n
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = np.array([sp.get_score(i) for i in plain])
        if len(scores) and (scores == np.round(scores)).all():  # ranks of a BPE model
            scores = -np.log(np.minimum(-scores, n) + 2.0)
        scores = alpha * scores
        scores -= np.logaddexp.reduce(scores)
        self.logp = np.full(n, -np.inf)
        self.logp[plain] = scores
        self.byte_logp = float(scores.min())
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.longest = max(len(self.text[i]) for i in plain)
        prefixes: dict[str, int] = {}
        for i in plain:
            for k in range(1, len(self.text[i])):
                prefixes.setdefault(self.text[i][:k], -1)
            prefixes[self.text[i]] = i
        if any(MARK in self.text[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece runs across the start of a word")
        self.table = HashTable({hash_of(p): i for p, i in prefixes.items()})

    def fallback(self, char: str) -> list[int]:
        return [self.bytes.get(b, self.unknown) for b in char.encode()] if self.bytes else [self.unknown]


class Lattices:
    """Lattices of distinct words: nodes are the places between characters, numbered by
    depth and then by word; edges are the pieces, in order of the node they end at."""

    def __init__(self, words: list[str], p: Pieces):
        self.p = p
        lens = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lens)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        n = len(chars)
        power = np.full(n + 1, ODD, np.uint64)
        power[0] = 1
        inverse = np.full(n + 1, INVERSE, np.uint64)
        inverse[0] = 1
        power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars.astype(np.uint64) * power[:n], dtype=np.uint64)])
        del power
        word = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        stop = ends.astype(np.int32)[word]
        starts, stops, ids, logps = [], [], [], []
        active = np.arange(n, dtype=np.int32)
        self.odd_ids: list[list[int]] = []
        for size in range(1, p.longest + 1):
            active = active[active + size <= stop[active]]
            if not len(active):
                break
            got = p.table.get((sums[active + size] - sums[active]) * inverse[active])
            hit = got >= 0
            starts.append(active[hit])
            stops.append(active[hit] + np.int32(size))
            ids.append(got[hit].astype(np.int32))
            logps.append(p.logp[got[hit]])
            if size == 1 and not hit.all():  # characters without a piece
                lone = active[~hit]
                odd_chars, back = np.unique(chars[lone], return_inverse=True)
                spelt = [p.fallback(chr(int(c))) for c in odd_chars]
                names = []
                for ids_of in spelt:  # one byte: its piece; more: a number of their own
                    names.append(ids_of[0] if len(ids_of) == 1 else p.size + len(self.odd_ids))
                    if len(ids_of) > 1:
                        self.odd_ids.append(ids_of)
                starts.append(lone)
                stops.append(lone + np.int32(1))
                ids.append(np.array(names, np.int32)[back])
                logps.append(p.byte_logp * np.array([len(x) for x in spelt], float)[back])
            active = active[got >= -1]
        del sums, inverse
        # places in text order -> nodes by depth
        depth = np.arange(n + len(words), dtype=np.int32) - np.repeat(
            (ends - lens + np.arange(len(words))).astype(np.int32), lens + 1)
        deepest = int(depth.max(initial=0))
        order = np.argsort(depth.astype(np.int16) if deepest < 1 << 15 else depth, kind="stable")
        self.levels = np.searchsorted(depth[order], np.arange(deepest + 2))
        node = np.empty(len(order), np.int32)
        node[order] = np.arange(len(order), dtype=np.int32)
        self.last = node[ends + np.arange(len(words))]  # word w begins at node w
        self.nodes = len(node)
        starts = [node[x + word[x]] for x in starts]
        stops = [node[y + word[y - 1]] for y in stops]
        count = np.zeros(self.nodes, np.int64)
        for x in stops:  # a node has at most one edge of each list
            count[x] += 1
        self.edge_at = np.concatenate([[0], np.cumsum(count)])
        total, fill = int(self.edge_at[-1]), self.edge_at[:-1].copy()
        self.begin, self.id = np.empty(total, np.int32), np.empty(total, np.int32)
        self.edge_logp = np.empty(total)
        for x, y, i, lp in zip(starts[::-1], stops[::-1], ids[::-1], logps[::-1]):  # long pieces first: they are likelier
            at = fill[y]
            self.begin[at], self.id[at], self.edge_logp[at] = x, i, lp
            fill[y] += 1
        self._forward()

    def _forward(self) -> None:
        """Log forward sums, level by level: all words' nodes of one depth at a time."""
        self.total = total = np.zeros(self.nodes)
        at = self.edge_at
        weight = np.empty(int(at[-1]))
        for lo, hi in zip(self.levels[1:-1].tolist(), self.levels[2:].tolist()):
            a, b = int(at[lo]), int(at[hi])
            w = weight[a:b]
            np.add(total[self.begin[a:b]], self.edge_logp[a:b], out=w)
            starts, count = at[lo:hi] - a, at[lo + 1:hi + 1] - at[lo:hi]
            total[lo:hi] = np.logaddexp.reduceat(w, starts)
            w -= np.repeat(total[lo:hi], count)
            np.exp(w, out=w)
            run = np.cumsum(w)
            w[:] = run - np.repeat(run[starts] - w[starts], count)
            w[starts + count - 1] = 2.0  # the last edge takes what is left
        #: Running probability of a node's edges
        self.upto = weight

    def draw(self, words: np.ndarray, rng: np.random.Generator | Mixed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One segmentation per entry of words: (pieces laid side by side, count per entry, log
        probability per entry)."""
        node = self.last[words]
        who = np.flatnonzero(node != words)
        steps, logp = [], np.zeros(len(words))
        count = np.zeros(len(words), np.int64)
        while len(who):
            here = node[who]
            u = rng.random(len(who)) if isinstance(rng, np.random.Generator) else rng.random(who)
            e = self.edge_at[here]
            over = np.flatnonzero(self.upto[e] <= u)
            while len(over):
                e[over] += 1
                over = over[self.upto[e[over]] <= u[over]]
            steps.append((who, self.id[e]))
            logp[who] += self.edge_logp[e]
            count[who] += 1
            node[who] = self.begin[e]
            who = who[node[who] != words[who]]
        offset = np.cumsum(count)
        out = np.empty(int(count.sum()), np.int32)
        for k, (w, ids) in enumerate(steps):  # drawn from the end backwards
            out[offset[w] - 1 - k] = ids
        return out, count, logp - self.total[self.last[words]]

    def all_paths(self, word: int, most: int) -> list[tuple[tuple[int, ...], float]] | None:
        """Every segmentation of a word with its log probability, or None if there are more than ``most``."""
        paths: dict[int, list] = {word: [((), 0.0)]}
        todo, seen = [int(self.last[word])], set()
        while todo:  # the word's nodes, from its end backwards
            node = todo.pop()
            if node not in seen and node != word:
                seen.add(node)
                todo += self.begin[self.edge_at[node]:self.edge_at[node + 1]].tolist()
        for node in sorted(seen):
            here = []
            for e in range(int(self.edge_at[node]), int(self.edge_at[node + 1])):
                for ids, lp in paths[int(self.begin[e])]:
                    here.append(((*ids, int(self.id[e])), lp + float(self.edge_logp[e])))
            if len(here) > most:
                return None
            paths[node] = here
        z = float(self.total[self.last[word]])
        return [(ids, lp - z) for ids, lp in paths[int(self.last[word])]]

    def first_outside(self, word: int, seen: set[tuple[int, ...]], rng: np.random.Generator):
        """The first of some independent draws that is not in ``seen``."""
        ids, count, logp = self.draw(np.full(12, word), rng)
        at = 0
        for n, lp in zip(count.tolist(), logp.tolist()):
            one = tuple(ids[at:at + n].tolist())
            if one not in seen:
                return one, lp
            at += n
        return None

    def another(self, word: int, seen: set[tuple[int, ...]], rng: np.random.Generator) -> tuple[tuple[int, ...], float]:
        """A segmentation outside ``seen``, with the probabilities of those that are left."""
        for _ in range(4):
            got = self.first_outside(word, seen, rng)
            if got is not None:
                return got
        left = self.all_paths(word, 20_000)
        while left is None:  # too many to list: go on drawing
            got = self.first_outside(word, seen, rng)
            if got is not None:
                return got
        left = [x for x in left if x[0] not in seen]
        lp = np.array([x[1] for x in left])
        w = np.exp(lp - lp.max())
        return left[int(np.searchsorted(np.cumsum(w) / w.sum(), rng.random(), "right").clip(0, len(left) - 1))]

    def model_ids(self, ids) -> np.ndarray:
        """Piece ids with the byte fallbacks written out."""
        if not self.odd_ids or not len(ids) or ids.max() < self.p.size:
            return ids.astype("<u4")
        odd = np.flatnonzero(ids >= self.p.size)
        out, at = [], 0
        for i in odd.tolist():
            out += [ids[at:i], self.odd_ids[int(ids[i]) - self.p.size]]
            at = i + 1
        return np.concatenate([*out, ids[at:]]).astype("<u4")


def below(limit: float, location: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at the locations, given that they lie below the limit."""
    return -np.logaddexp(-limit, np.log(-np.log(u)) - location)


def log_rest(logp: np.ndarray) -> np.ndarray:
    """log(1 - exp(logp)), -inf where nothing is left."""
    with np.errstate(divide="ignore"):
        return np.where(logp > -1e-12, -np.inf, np.log(-np.expm1(np.minimum(logp, -1e-12))))


class Path:
    """A full segmentation: words from draws (by number), some of them drawn by themselves."""

    def __init__(self, value: float, draws: np.ndarray, own: dict[int, tuple[tuple[int, ...], float]], logp: np.ndarray):
        self.value, self.draws, self.own, self.logp = value, draws, own, logp


def search(words: np.ndarray, drawn: list, lat: Lattices, k: int, rng: np.random.Generator) -> tuple[list[Path], float]:
    """The k paths with the largest perturbed values, and the next value.  ``drawn``
    has, per draw, (word -> pieces, log probabilities)."""
    n = len(words)
    first = -math.log(-math.log(rng.random()))
    paths = [Path(first, np.zeros(n, np.int64), {}, drawn[0][1].copy())]
    agenda: list[dict] = []  # of sets: the words before ``at`` as in ``path``, word ``at`` not in ``seen``

    def leave(path: Path, since: int) -> None:
        """The sets left beside a path, for words from ``since`` on."""
        if since >= n:
            return
        before = np.cumsum(path.logp) - path.logp
        location = (before + log_rest(path.logp))[since:]
        values = np.where(np.isneginf(location), -np.inf, below(path.value, np.where(np.isneginf(location), 0.0, location), rng.random(n - since)))
        agenda.append({"path": path, "since": since, "values": values, "before": before})

    def segmentation(path: Path, w: int) -> tuple[int, ...]:
        return path.own[w][0] if w in path.own else tuple(drawn[int(path.draws[w])][0](w).tolist())

    leave(paths[0], 0)
    single: list[dict] = []  # sets whose word has been split before
    while True:
        best, which, at = -np.inf, None, 0
        for a in agenda:
            i = int(a["values"].argmax())
            if a["values"][i] > best:
                best, which, at = float(a["values"][i]), a, i
        for s in single:
            if s["value"] > best:
                best, which = s["value"], s
        if len(paths) == k or np.isneginf(best):
            return paths, best
        if "values" in which:
            parent, w = which["path"], which["since"] + at
            which["values"][at] = -np.inf
            seen = {segmentation(parent, w)}
            gone = float(np.exp(parent.logp[w]))
        else:
            parent, w, seen, gone = which["path"], which["at"], which["seen"], which["gone"]
            single.remove(which)
        r = len(paths)
        fresh = tuple(drawn[r][0](w).tolist())
        ids, lp = (fresh, float(drawn[r][1][w])) if fresh not in seen else lat.another(int(words[w]), seen, rng)
        logp = parent.logp.copy()
        logp[w], logp[w + 1:] = lp, drawn[r][1][w + 1:]
        draws = parent.draws.copy()
        draws[w + 1:] = r
        path = Path(best, draws, {i: x for i, x in parent.own.items() if i < w} | {w: (ids, lp)}, logp)
        paths.append(path)
        gone += math.exp(lp)
        if gone < 1 - 1e-12:  # what is left at this word
            place = float(logp[:w].sum()) + math.log1p(-gone)
            single.append({"value": float(below(best, np.array([place]), rng.random(1))[0]), "path": parent, "at": w,
                           "seen": seen | {ids}, "gone": gone})
        leave(path, w + 1)


def split_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Normalised texts cut before every run of word marks: (distinct words, number of
    each word in order, first word of each text; one more at the end)."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.cumsum([0, *map(len, raw)])
    starts = np.zeros(len(data) + 3, bool)
    if len(data) > 2:
        mark = np.zeros(len(data) + 3, bool)
        mark[3:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        starts[: len(data)] = mark[3:] & ~mark[:-3]
    full = offs[1:] > offs[:-1]
    starts[offs[:-1][full]] = True
    at = np.flatnonzero(starts[: len(data)])
    units = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)])
    enc = units.dictionary_encode()
    return ([w.decode() for w in enc.dictionary.to_pylist()], enc.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            np.searchsorted(at, offs))


def sample_texts(keys: list, texts: list[str], p: Pieces, k: int, seed: int) -> Iterator[tuple]:
    """(key, sample, ids, logp, perturbed, log_inclusion) rows of a batch of texts."""
    names, codes, bounds = split_words([p.sp.normalize(t) for t in texts])
    lat = Lattices(names, p)
    rngs = [np.random.Generator(np.random.Philox(key=xxhash.xxh3_128_intdigest(f"{seed}|{key}"))) for key in keys]
    draws = []
    for _ in range(k):
        # each text's own random numbers seed its words' draws, however texts are batched
        seeds = np.repeat(np.array([int(r.integers(1 << 63)) for r in rngs], np.uint64), np.diff(bounds))
        place = np.arange(len(codes), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
        ids, count, logp = lat.draw(codes, Mixed(seeds, place))
        draws.append((ids, np.concatenate([[0], np.cumsum(count)]), logp))
    for i, key in enumerate(keys):
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        mine = [((lambda w, d=d: d[0][d[1][lo + w]:d[1][lo + w + 1]]), d[2][lo:hi]) for d in draws]
        paths, kappa = search(codes[lo:hi], mine, lat, k, rngs[i])
        for rank, path in enumerate(paths):
            total = float(path.logp.sum())
            inclusion = 0.0 if np.isneginf(kappa) else log_inclusion(total - kappa)
            yield key, rank + 1, lat.model_ids(laid(path, draws, lo, hi)).tobytes(), total, path.value, inclusion


def log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x)))"""
    return x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 30.0))))


def laid(path: Path, draws: list, lo: int, hi: int) -> np.ndarray:
    """The path's pieces one after another."""
    parts = []
    at = 0
    for w in [*sorted(path.own), hi - lo]:
        while at < w:  # a run of words from one draw
            r = int(path.draws[at])
            other = path.draws[at:w] != r
            end = at + int(other.argmax()) if other.any() else w
            ids, offs, _ = draws[r]
            parts.append(ids[offs[lo + at]:offs[lo + end]])
            at = end
        if w < hi - lo:
            parts.append(np.array(path.own[w][0], np.int32))
            at = w + 1
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


class Mixed:
    """Uniform numbers from (seed, place, step), for entries that drop out one by one."""

    def __init__(self, seeds: np.ndarray, places: np.ndarray):
        with np.errstate(over="ignore"):
            self.state = seeds ^ (places * np.uint64(ODD))
        self.step = 0

    def random(self, who: np.ndarray) -> np.ndarray:
        self.step += 1
        x = self.state[who]
        with np.errstate(over="ignore"):
            x = x + np.uint64((ODD * self.step) % (1 << 64))
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
        return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


_PIECES: dict = {}


def shared_pieces(path: str | None, alpha: float) -> Pieces:
    if (path, alpha) not in _PIECES:
        _PIECES[path, alpha] = Pieces(path, alpha)
    return _PIECES[path, alpha]


def sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, alpha: float = 1.0, seed: int = 17,
           path: str | None = None) -> DataFrame:
    """(id, sample from 1, n_pieces, ids as little-endian uint32, logp, perturbed, log_inclusion), at
    most k rows per input row, in falling order of the perturbed value."""
    schema = pa.schema([(id_col, pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("ids", pa.binary()),
                        ("logp", pa.float64()), ("perturbed", pa.float64()), ("log_inclusion", pa.float64())])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared_pieces(path, alpha)
        rows = Rows(schema)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= STEP_CHARS):
                    size += len(texts[end])
                    end += 1
                for key, rank, ids, logp, value, inclusion in sample_texts(keys[at:end], texts[at:end], p, k, seed):
                    rows.add(key, rank, len(ids) // 4, ids, logp, value, inclusion, size=len(ids) + 64)
                    if rows.full():
                        yield rows.take()
                at = end
        yield rows.take()

    shape = (f"{quoted(id_col)} long, sample int, n_pieces long, ids binary, logp double, perturbed double, "
             "log_inclusion double")
    return df.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(sampled, shape)


def decode_column(ids_col, path: str | None = None):
    """The text of little-endian uint32 piece ids, as the model decodes it."""

    @arrow_udf("string")
    def decoded(col: pa.Array) -> pa.Array:
        sp = shared_pieces(path, 1.0).sp
        return pa.array([None if b is None else sp.decode(np.frombuffer(b, "<u4").tolist()) for b in col.to_pylist()], pa.string())

    return decoded.asNondeterministic()(ids_col)
