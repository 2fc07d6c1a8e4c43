"""Nearest neighbours by cross-polytope hashing (operator 4).

Method: a vector, scaled to length one and padded to a power of two, is turned by three
rounds of random signs and a fast Hadamard transform, and falls into the cell of the
nearest signed axis.  ``tables`` such turnings give every vector one cell per
table.  A query probes the ``probes`` nearest signed axes of every table; the members of the cells
it probes are its candidates, and all of them are ranked by the exact inner
product of the original vectors in double precision.

Vectors of unequal length would favour long ones, so the members of one
dimension are parted into bands by length: the lengths of band i lie between the longest
one divided by ``RATIO`` ** (i + 1) and by ``RATIO`` ** i.  Neighbouring bands with fewer members than a
table has cells are one band.  Every band is hashed apart, as unit vectors, and every query probes
each of them.  Members of one band differ little in length, so the nearest by angle are the nearest by inner
product, and the bands' finds are merged by exact score.  In a band of m members a query probes
``probes`` cells of a table, or as many as hold ``WANTED`` members if they are spread evenly: cells * WANTED / m, at
most all of them (then one table has every member).  Queries that still have fewer
than k + 1 candidates meet all members of their dimension.

Ranking is exact, ties included: a block product only tells which members cannot be among the
best, with a bound on its rounding error; all others are scored pair by pair and ordered by score and id.

Work is dealt by cell.  A cell of more than ``block`` members or probing
queries is split into blocks, every query block meeting every member block, so no
task holds more than two blocks.  Equal vectors are searched
once: a class of equal vectors is one member that carries its smallest ids
(more than ``k`` + 1 can never be among the nearest), and equal queries are one query.
At most k + 1 rows per query leave a pair of blocks, and Spark keeps k + 1 of
them per query before the last shuffle.

Defined results: vectors that are null, empty, zero or hold null or
non-finite numbers take no part; vectors of different dimensions are searched apart;
null ids take no part; rows that repeat id and vector count once; fewer than k other
members than that give fewer rows; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.common import Rows, cut

TABLES, PROBES, BLOCK = 8, 16, 2048
#: Lengths in one band differ by less than this factor.
RATIO = 1.25
#: A query probes at least as many cells of a table as hold so many members of a band, spread evenly.
WANTED = 256
#: The cell of all members, for queries that found too few.
EVERY = -1


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, width // (2 * step), 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        step *= 2
        x = x.reshape(n, width)
    return x / np.sqrt(width)


def turned(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """The table's pseudo-rotation of unit vectors, padded to a power of two."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rng = np.random.Generator(np.random.Philox(key=[seed, table * 1_000_003 + width]))
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], width))
    return x


def width_of(dim: int) -> int:
    """The dimension padded to a power of two; a table has twice as many cells."""
    return 1 << max(1, (dim - 1).bit_length())


def cells_column(vector, size, band, tables: int, probes: int, seed: int, member: bool, hashed: dict[int, list[list[int]]]):
    """array<int> of cells.  ``hashed`` has the count of members of each band, per dimension.  A member is in one cell per
    table of its band; a query probes the nearest cells of every table of every band.
    Cells are numbered (band * tables + table) * 2 * width + signed axis."""

    @arrow_udf("array<int>")
    def column(vectors: pa.Array, dims: pa.Array, bands: pa.Array) -> pa.Array:
        lens = np.asarray(dims.to_numpy(zero_copy_only=False), np.int64)
        band_of = np.asarray(bands.to_numpy(zero_copy_only=False), np.int64)
        flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
        ends = np.cumsum(lens)
        out: list = [[] for _ in lens]
        for dim in np.unique(lens):
            counts = hashed.get(int(dim), [])
            at = np.flatnonzero(lens == dim)
            if not len(at) or not counts:
                continue
            x = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
            x = x / np.abs(x).max(axis=1)[:, None]
            u = x / np.linalg.norm(x, axis=1)[:, None]
            per_table = 2 * width_of(int(dim))
            probed = [min(per_table, max(probes, -(-per_table * WANTED // m))) for m in counts]
            for t in range(tables):
                # a band whose cells are all probed needs one table only
                own = [b for b, n in enumerate(probed) if t == 0 or n < per_table]
                if not own:
                    break
                y = turned(u, t, seed)
                y = np.concatenate([y, -y], axis=1)
                if member:
                    cells = band_of[at] * (tables * per_table) + t * per_table + y.argmax(axis=1)
                    for i, cell, b in zip(at, cells.tolist(), band_of[at].tolist()):
                        if b in own:
                            out[i].append(cell)
                    continue
                ranked = np.argsort(-y, axis=1, kind="stable")
                for b in own:
                    cells = ranked[:, :probed[b]] + (b * tables + t) * per_table
                    for i, row in zip(at, cells.tolist()):
                        out[i] += row
        return pa.array(out, pa.list_(pa.int32()))

    return column.asNondeterministic()(vector, size, band)


def log_length(vector, size):
    """The logarithm of a vector's length, without overflow."""

    @arrow_udf("double")
    def column(vectors: pa.Array, dims: pa.Array) -> pa.Array:
        lens = np.asarray(dims.to_numpy(zero_copy_only=False), np.int64)
        flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
        if not len(lens):
            return pa.array([], pa.float64())
        start = np.cumsum(lens) - lens
        top = np.maximum.reduceat(np.abs(flat), start)
        return pa.array(np.log(top) + np.log(np.add.reduceat((flat / np.repeat(top, lens)) ** 2, start)) / 2)

    return column(vector, size)


def bands(rows: DataFrame):
    """The band of a vector as a column, and the number of different members of each band, per
    dimension.  The driver gets one number per dimension and one per range of lengths."""
    length = log_length(F.col("vec"), F.size("vec"))
    longest = {r[0]: r[1] for r in rows.withColumn("length", length).groupBy(F.size("vec")).agg(F.max("length")).collect()}
    if not longest:
        return F.lit(0), {}
    longest_of = F.create_map(*[F.lit(x) for pair in longest.items() for x in pair])
    below = F.element_at(longest_of, F.size("vec")) - length
    # lengths that differ by rounding only stay in one band
    narrow = F.greatest(F.lit(0), F.floor((below - 1e-4) / math.log(RATIO))).cast("int")
    held = (rows.select(F.size("vec").alias("d"), narrow.alias("band"), "vec").groupBy("d", "band")
            .agg(F.approx_count_distinct(F.xxhash64("vec")).alias("n")).collect())
    hashed: dict[int, list[int]] = {}
    number: dict[int, dict[int, int]] = {}
    for d, band, n in sorted((r["d"], r["band"], r["n"]) for r in held):
        counts, cells = hashed.setdefault(d, []), 2 * width_of(d)
        if counts and counts[-1] < cells and n < cells:
            counts[-1] += n
        else:
            counts.append(n)
        number.setdefault(d, {})[band] = len(counts) - 1
    numbers = F.create_map(*[x for d, of in number.items() for x in (
        F.lit(d), F.create_map(*[F.lit(v) for pair in of.items() for v in pair]))])
    return F.element_at(F.element_at(numbers, F.size("vec")), narrow), hashed


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("id"), v.alias("vec"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
            .filter(sound).filter(F.exists("vec", lambda x: x != 0.0)))


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            tables: int = TABLES, probes: int = PROBES, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """(query_id, rank, <id_col>, score): the k rows of df with the largest inner product
    among each query's candidates, the query's own id left out; nearest first, ties to the
    smaller id."""
    keep = k + 1  # the query's own row may be among them
    rows = usable(df, id_col, vec_col)
    band, hashed = bands(rows)
    in_class = Window.partitionBy("vec").orderBy("id")
    members = (rows.withColumn("n", F.dense_rank().over(in_class)).filter(F.col("n") <= keep)
               .groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids")))
    asked = usable(queries, id_col, vec_col).distinct()
    classes = asked.groupBy("vec").agg(F.min("id").alias("query"))
    dim = F.size("vec")
    held = cut(members.select("vec", "ids", cells_column(F.col("vec"), dim, band, tables, 1, seed, True, hashed).alias("cells")),
               "members")
    probing = cut(classes.select("vec", "query", cells_column(F.col("vec"), dim, F.lit(0), tables, probes, seed, False, hashed)
                                 .alias("cells")), "queries")
    best = cut(met_in_cells(held, probing, keep, block), "nearest")
    few = probing.join(
        best.groupBy("query").count().filter(F.col("count") >= keep), "query", "left_anti")
    few = cut(few.select("vec", "query", F.array(F.lit(EVERY)).alias("cells")), "few-candidates")
    if not few.isEmpty():
        whole = met_in_cells(held.withColumn("cells", F.array(F.lit(EVERY))), few, keep, block)
        best = best.join(few, "query", "left_anti").unionByName(whole)
    answers = asked.join(classes, "vec").select(F.col("id").alias("query_id"), "query")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (answers.join(best, "query").filter("id <> query_id").withColumn("rank", F.row_number().over(ranked))
            .filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"),
                                               F.col("id").alias(id_col), "score"))


def met_in_cells(held: DataFrame, probing: DataFrame, keep: int, block: int) -> DataFrame:
    """(query, id, score): the ``keep`` best ids per query among the members of its cells."""
    # at most tables * 2 * width cells per dimension and hashed band, however many rows there are
    parts = lambda d, name: (d.select(F.size("vec").alias("d"), F.explode("cells").alias("cell")).groupBy("d", "cell")
                             .agg(F.ceil(F.count("*") / block).cast("int").alias(name)))
    split = F.broadcast(parts(held, "m").join(parts(probing, "q"), ["d", "cell"]))
    here = held.select(F.size("vec").alias("d"), "vec", "ids", F.explode("cells").alias("cell")).join(split, ["d", "cell"])
    here = here.select("d", "cell", F.pmod(F.xxhash64("ids", "cell"), F.col("m")).cast("int").alias("mb"),
                       F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qb"), F.lit(0).alias("kind"),
                       F.lit(None).cast("long").alias("query"), "ids", "vec")
    there = probing.select(F.size("vec").alias("d"), "vec", "query", F.explode("cells").alias("cell")).join(split, ["d", "cell"])
    there = there.select("d", "cell", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("mb"),
                         F.pmod(F.xxhash64("query", "cell"), F.col("q")).cast("int").alias("qb"), F.lit(1).alias("kind"),
                         "query", F.array().cast("array<long>").alias("ids"), "vec")
    key = ["d", "cell", "mb", "qb"]
    dealt = here.unionByName(there).repartition(*key).sortWithinPartitions(*key, "kind")
    found = dealt.mapInArrow(lambda b: _scored(b, keep, block), "query long, id long, score double")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return (found.withColumn("n", F.dense_rank().over(order)).filter(F.col("n") <= keep)
            .groupBy("query", "id").agg(F.max("score").alias("score")))


def _scored(batches: Iterator[pa.RecordBatch], keep: int, block: int) -> Iterator[pa.RecordBatch]:
    """The best members of each pair of blocks, per query.  Members of a group come first."""
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    now, x, ids = None, [], []
    stacked: tuple | None = None

    def emit():
        q, i, s = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], schema=schema)

    for batch in batches:
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        keys = np.column_stack([cols[n].to_numpy(zero_copy_only=False) for n in ("d", "cell", "mb", "qb", "kind")])
        if not len(keys):
            continue
        edges = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        for a, b in zip([0, *edges], [*edges, len(keys)]):
            *group, kind = keys[a].tolist()
            vec = np.asarray(cols["vec"].slice(a, b - a).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(b - a, -1)
            if group != now:
                now, x, ids, stacked = group, [], [], None
            if kind == 0:
                x.append(vec)
                ids += cols["ids"].slice(a, b - a).to_pylist()
                continue
            if not x:
                continue
            if stacked is None:
                sizes = np.array([len(i) for i in ids])
                stacked = np.concatenate(x), np.concatenate([np.array(i, np.int64) for i in ids]), sizes, np.cumsum(sizes) - sizes
            mine, flat, sizes, first = stacked
            queries = cols["query"].slice(a, b - a).to_numpy(zero_copy_only=False)
            for lo in range(0, len(vec), block):
                out.append(_best(vec[lo:lo + block], queries[lo:lo + block], mine, flat, sizes, first, keep))
            if sum(len(o[0]) for o in out) > 200_000:
                yield emit()
    yield emit()


def _best(q: np.ndarray, names: np.ndarray, x: np.ndarray, flat: np.ndarray, sizes: np.ndarray, first: np.ndarray, keep: int):
    """(query, id, score) of the ``keep`` best ids per query, ties to the smaller id.  Scores are
    summed pair by pair in one order, so a pair has the same score wherever it is met."""
    guess = q @ x.T
    if keep < len(x):
        # a sum of d products is off by less than (d + 1) * 2 ** -53 times the lengths, whatever its order
        off = (q.shape[1] + 2) * 2.0 ** -52 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
        least = np.partition(guess, len(x) - keep, axis=1)[:, len(x) - keep]
        # lengths that overflow give no bound: then every member is scored
        who, members = np.nonzero(~(guess < (least - 2 * off)[:, None]))
    else:
        who, members = np.nonzero(np.ones(guess.shape, bool))
    score = np.empty(len(who))
    for lo in range(0, len(who), 1 << 16):
        score[lo:lo + (1 << 16)] = (q[who[lo:lo + (1 << 16)]] * x[members[lo:lo + (1 << 16)]]).sum(axis=1)
    many = sizes[members]
    if many.max(initial=0) > 1:  # classes of equal vectors: their ids one by one
        at = np.repeat(first[members], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        who, score, ids = np.repeat(who, many), np.repeat(score, many), flat[at]
    else:
        ids = flat[first[members]]
    order = np.lexsort((ids, -score, who))
    who, score, ids = who[order], score[order], ids[order]
    start = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, np.int64)
    place = np.arange(len(who)) - np.repeat(start, np.diff(np.r_[start, len(who)]))
    good = place < keep
    return names[who[good]], ids[good], score[good]
