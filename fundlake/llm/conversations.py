"""Conversation structure repair (operator 12).

A conversation is repaired by the cheapest edits that give it the role initials ``(s?(ua)+)?``: Keep a
row (0), Rerole it to user or assistant (3), Delete it (4; blank and duplicate rows must
go), Insert an empty user or assistant row (3); a truncated row that is not deleted adds 3.  The audit is the initials of
the edits in order; of equally cheap repairs the one of the least audit in ASCII order is made.

Method: a node is a place between two rows and a state of the role pattern.  A dynamic program from the end
gives every node its cheapest rest; the arcs that lie on a cheapest rest are the optimal ones.
These arcs are then ranked by prefix doubling: first by their letter, then, round after round,
by the pair (own rank, rank of the arc that the doubled pointer leads to), which is the order by the
first 2, 4, 8, ... letters of the audit.  A letter leads from a node to one node only, so every arc has
one pointer per round.  The arc of least rank at each node makes the least path, and the doubled pointers
read it off: arc number j of a path is reached by the pointers of the binary digits of j.

Distribution: no conversation is one task's.  The rows are range-partitioned by conversation, turn, role
and text; equal rows are counted first, so they are one row.  A tile is the rows of one
conversation among up to ``TILE`` rows that follow each other.  Every tile that does not hold its whole conversation gives the 4 x 4
matrix of cheapest costs between states (min-plus); a scan over a conversation's matrices, last tile first, gives the cheapest rest
behind each tile.  The tiles are then solved apart, for every state a path can enter in, and a second
scan over (state in, state out) picks one path per tile.  Only the hash over a whole
repaired conversation reads its rows in one task, as a stream: a hash is a chain.

Defined results: nulls in role or text are one space; rows of one turn are ordered by role, then
text (byte order), a null turn comes before all others; rows with a null conversation id are one conversation; a row is
blank without a character other than an ASCII blank, else duplicate if an earlier row has its role and text, else
truncated if its last such character is none of ``.!?``; a role without first letter s, u or a
cannot be kept; an empty table gives no rows; columns of other names are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import Rows, cut

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a tile are those whose number has the same high bits.
TILE_BITS = 13
SOUND, BLANK, DUPLICATE, CUT_OFF = 0, 1, 2, 3
#: States of the pattern: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a role initial (s, u, a, other); -1: not allowed.
STEP = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: State after a row whose role is free to choose between user and assistant.
FREE = np.array([USER, USER, ASSISTANT, USER])
#: Cheapest rest behind the last row: the inserted rows that end the pattern.
AT_END = np.array([0, 2 * INSERT, INSERT, 0])
FAR = 1 << 60
LETTERS = "DIKR"
KEY = ["conv", "unknown"]


class Repair(NamedTuple):
    """``rows``: (conv, unknown, place, step, edit, role, text), the repaired rows in order of place and step.
    ``summary``: one row per conversation with its faults, cost and audit.
    ``conv`` is the id as text, ``unknown`` marks the null id."""

    rows: DataFrame
    summary: DataFrame


# --- one batch of tiles --------------------------------------------------
class Steps:
    """The steps of many tiles: a row, or ``copies`` rows that must be deleted (0 for a row that may stay)."""

    def __init__(self, initial: np.ndarray, fault: np.ndarray, n: np.ndarray, tile_of: np.ndarray, tiles: int):
        sound = (fault == SOUND) | (fault == CUT_OFF)
        # a sound row is a step of its own, the copies behind it are another
        many = 1 + (sound & (n > 1))
        row = np.repeat(np.arange(len(n)), many)
        first = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
        self.initial = initial[row]
        self.copies = np.where(sound[row], np.where(first, 0, n[row] - 1), n[row])
        self.extra = np.where((fault[row] == CUT_OFF) & first, TRUNCATED, 0)
        self.length = np.bincount(tile_of[row], minlength=tiles)
        # nodes of tile i: places begin[i] .. begin[i] + length[i], four states each
        self.begin = np.cumsum(self.length + 1) - (self.length + 1)
        self.places = int((self.length + 1).sum())
        self.at = np.arange(len(row)) + tile_of[row]  # place of each step

    def per_place(self, values: np.ndarray, fill=0) -> np.ndarray:
        out = np.full(self.places, fill, np.int64)
        out[self.at] = values
        return out


def row_arcs(s: Steps, at: np.ndarray, rest: np.ndarray, initial, copies, extra) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost of Delete, Keep and Rerole at some places, per state; ``rest`` is the cheapest rest behind them (places, 4, ...)."""
    wide = (len(at),) + (1,) * (rest.ndim - 1)
    forced = copies[at].reshape(wide) > 0
    delete = DELETE * np.maximum(copies[at], 1).reshape(wide) + rest
    to = STEP[:, initial[at]].T
    keep = np.take_along_axis(rest, np.maximum(to, 0).reshape(to.shape + (1,) * (rest.ndim - 2)), axis=1)
    keep = np.where((to < 0).reshape(to.shape + (1,) * (rest.ndim - 2)) | forced, FAR, keep + extra[at].reshape(wide))
    rerole = np.where(forced, FAR, REROLE + extra[at].reshape(wide) + rest[:, FREE])
    return delete, keep, rerole


def cheapest(s: Steps, ends: np.ndarray) -> np.ndarray:
    """(places, 4, ...): the cheapest rest of every node, given that behind each tile (tiles, 4, ...)."""
    initial, copies, extra = s.per_place(s.initial), s.per_place(s.copies), s.per_place(s.extra)
    cost = np.full((s.places,) + ends.shape[1:], FAR, np.int64)
    cost[s.begin + s.length] = ends
    order = np.argsort(-s.length, kind="stable")
    for t in range(int(s.length.max(initial=0)) - 1, -1, -1):
        some = order[: np.searchsorted(-s.length[order], -t, "left")]  # tiles of more than t steps
        at = s.begin[some] + t
        base = np.minimum.reduce(row_arcs(s, at, cost[at + 1], initial, copies, extra))
        # inserted rows lead from every state to user or assistant at the same place
        user = np.minimum(base[:, USER], INSERT + base[:, ASSISTANT])
        assistant = np.minimum(base[:, ASSISTANT], INSERT + base[:, USER])
        cost[at] = np.stack([np.minimum(base[:, START], INSERT + user), np.minimum(base[:, SYSTEM], INSERT + user), user, assistant], axis=1)
    return np.minimum(cost, FAR)


class Paths:
    """The least cheapest paths from every node, by prefix doubling over the optimal arcs."""

    def __init__(self, s: Steps, cost: np.ndarray):
        initial, copies, extra = s.per_place(s.initial), s.per_place(s.copies), s.per_place(s.extra)
        inner = np.ones(s.places, bool)
        inner[s.begin + s.length] = False
        at = np.flatnonzero(inner)
        delete, keep, rerole = row_arcs(s, at, cost[at + 1], initial, copies, extra) if len(at) else [np.zeros((0, 4))] * 3
        states = np.arange(4)
        heads = ((at[:, None] + 1) * 4 + states, at[:, None] * 4 + FREE, (at[:, None] + 1) * 4 + np.maximum(STEP[:, initial[at]].T, 0),
                 (at[:, None] + 1) * 4 + FREE)
        costs = delete, INSERT + cost[at][:, FREE], keep, rerole
        tail, letter, head = [], [], []
        for k, (c, h) in enumerate(zip(costs, heads)):
            place, state = np.nonzero((c == cost[at]) & (cost[at] < FAR))
            tail.append(at[place] * 4 + state)
            head.append(h[place, state])
            letter.append(np.full(len(place), k + 1))
        # arc 0 is the end: no letter, leads to itself
        self.tail = np.concatenate([[-1], *tail]).astype(np.int64)
        self.head = np.concatenate([[-1], *head]).astype(np.int64)
        self.letter = np.concatenate([[0], *letter]).astype(np.int64)
        self.steps, self.copies = s, copies
        self._rank()

    def least_arc(self, rank: np.ndarray) -> np.ndarray:
        """The arc of least rank at every node, arc 0 where none leads on."""
        out = np.zeros(self.steps.places * 4, np.int64)
        order = np.argsort(-rank[1:], kind="stable") + 1
        out[self.tail[order]] = order  # the least one is written last
        return out

    def _rank(self) -> None:
        rank = self.letter.copy()
        first = self.least_arc(rank)
        jump = np.r_[0, first[self.head[1:]]]
        count = (self.letter > 0).astype(np.int64)
        self.jumps, self.count = [jump], count
        while jump.any():
            # by twice as many letters: own rank, then that of the arc behind them
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)
            count = count + count[jump]
            jump = jump[jump]
            self.jumps.append(jump)
        self.first, self.count = self.least_arc(rank), count

    def follow(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arcs of the least paths from some nodes, one after another, and the number of arcs of each."""
        start = self.first[nodes]
        many = self.count[start]
        now = np.repeat(start, many)
        j = np.arange(len(now)) - np.repeat(np.cumsum(many) - many, many)
        for k, jump in enumerate(self.jumps):
            on = (j >> k) & 1 == 1
            now[on] = jump[now[on]]
        return now, many


def illegal_pairs(initial: np.ndarray, n: np.ndarray, tile_of: np.ndarray, tiles: int) -> np.ndarray:
    """Neighbouring initials other than su, ua and au, per tile; a row and its copies are n rows."""
    out = np.bincount(tile_of, weights=n - 1, minlength=tiles).astype(np.int64)
    a, b = initial[:-1], initial[1:]
    return out + np.bincount(tile_of[1:][(tile_of[1:] == tile_of[:-1]) & ~legal(a, b)], minlength=tiles)


def legal(a, b):
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


# --- streams of whole groups ---------------------------------------------
def groups(batches: Iterator[pa.RecordBatch], key: int, most: int = 1 << 16) -> Iterator[pa.Table]:
    """Whole groups of rows equal in the first ``key`` columns, many small ones at once."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < most:
            continue
        table = pa.concat_tables(held).combine_chunks()
        new = _new(table, key)
        if new[-1]:
            yield table.slice(0, new[-1])
        held = [table.slice(new[-1])]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _new(table: pa.Table, key: int) -> np.ndarray:
    """Where a new group begins."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for c in table.columns[:key]:
        values = c.to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def tiles_of(table: pa.Table):
    """(Steps, group starts, columns as arrays) of a table conv, unknown, tile, initial, fault, n, ..."""
    begin = _new(table, 3)
    tile_of = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, table.num_rows]))
    initial, fault, n = (table.column(c).to_numpy().astype(np.int64) for c in ("initial", "fault", "n"))
    return Steps(initial, fault, n, tile_of, len(begin)), begin, (initial, n, tile_of)


MATRIX = pa.schema([("conv", pa.string()), ("unknown", pa.bool_()), ("tile", pa.int64()), ("costs", pa.list_(pa.int64()))])


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest cost from every state before a tile to every state behind it, row by row."""
    ends = np.where(np.eye(4, dtype=bool), 0, FAR)
    for table in groups(batches, 3):
        s, begin, _ = tiles_of(table)
        cost = cheapest(s, np.broadcast_to(ends, (len(begin), 4, 4)))[s.begin].reshape(-1, 16)
        key = table.select(["conv", "unknown", "tile"]).take(begin)
        yield from key.append_column("costs", pa.array(cost.tolist(), pa.list_(pa.int64()))).cast(MATRIX).to_batches()


def rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest rest behind each tile; the tiles of a conversation come last one first."""
    rows, now, rest = Rows(MATRIX), None, AT_END
    for batch in batches:
        for conv, unknown, tile, costs in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, unknown) != now:
                now, rest = (conv, unknown), AT_END
            rows.add(conv, unknown, tile, rest.tolist())
            rest = np.minimum((np.array(costs).reshape(4, 4) + rest).min(axis=1), FAR)
        if rows.full():
            yield rows.take()
    yield rows.take()


PATHS = pa.schema([("conv", pa.string()), ("unknown", pa.bool_()), ("tile", pa.int64()), ("state", pa.int32()), ("out", pa.int32()),
                   ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
PATHS_SQL = ("conv string, unknown boolean, tile long, state int, out int, cost long, audit string, illegal long, "
             "first int, last int")


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least cheapest path through each tile, for every state it can be entered in
    (columns of ``tiles_of``, the cheapest rest behind the tile and whether it is the conversation's first)."""
    for table in groups(batches, 3):
        s, begin, (initial, n, tile_of) = tiles_of(table)
        some = table.take(begin)
        keys = [some.column(c).to_pylist() for c in ("conv", "unknown", "tile")]
        cost = cheapest(s, np.array(some.column("rest").to_pylist(), np.int64).reshape(-1, 4))
        paths = Paths(s, cost)
        wrong = illegal_pairs(initial, n, tile_of, len(begin))
        end = np.r_[begin[1:], table.num_rows] - 1
        entered = [(i, state) for i, first in enumerate(some.column("opens").to_pylist()) for state in range(1 if first else 4)]
        which, state = (np.array(c) for c in zip(*entered))
        nodes = s.begin[which] * 4 + state
        arcs, many = paths.follow(nodes)
        # forced copies are one arc of as many letters
        letters = np.frombuffer(LETTERS.encode(), np.uint8)[paths.letter[arcs] - 1]
        times = np.maximum(paths.copies[paths.tail[arcs] // 4], 1)
        times[letters != ord("D")] = 1
        text = np.repeat(letters, times).tobytes().decode()
        stop = np.cumsum(np.add.reduceat(np.r_[times, 0], np.minimum(np.cumsum(many) - many, len(times))) * (many > 0))
        last_arc = arcs[np.cumsum(many) - 1]
        out = paths.head[last_arc] % 4
        rows = Rows(PATHS)
        for k, (i, first_state) in enumerate(entered):
            rows.add(*(c[i] for c in keys), first_state, int(out[k]), int(cost[s.begin[i], first_state]),
                     text[stop[k - 1] if k else 0:stop[k]], int(wrong[i]), int(initial[begin[i]]), int(initial[end[i]]))
        yield rows.take()


CHOSEN = pa.schema([*list(PATHS)[:4], ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())])
CHOSEN_SQL = "conv string, unknown boolean, tile long, state int, cost long, audit string, illegal long"
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One path per tile: the one that is entered in the state the tile before leaves
    (tiles of a conversation in order, the flag ``closes`` on the last one)."""
    rows, now, state, last, opened = Rows(CHOSEN), None, START, None, None
    for batch in batches:
        for r in batch.to_pylist():
            if (r["conv"], r["unknown"]) != now:
                now, state, last, opened = (r["conv"], r["unknown"]), START, None, None
            if r["tile"] == opened or r["state"] != state:
                continue
            first, opened = opened is None, r["tile"]
            wrong = r["illegal"] + (last is not None and not legal(last, r["first"]))
            audit = r["audit"] + (TAIL[r["out"]] if r["closes"] else "")
            rows.add(*now, opened, state, r["cost"] if first else 0, audit, int(wrong), size=len(audit) + 64)
            state, last = r["out"], r["last"]
        if rows.full():
            yield rows.take()
    yield rows.take()


REPAIRED = pa.schema([("conv", pa.string()), ("unknown", pa.bool_()), ("place", pa.int64()), ("step", pa.int64()),
                      ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
REPAIRED_SQL = "conv string, unknown boolean, place long, step long, edit string, role string, text string"


def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows of each tile (columns conv, unknown, tile, place, initial, n, role, text, state, audit)."""
    rows, now, audit, at, state, step = Rows(REPAIRED), None, "", 0, START, 0

    def insert(r):
        nonlocal state, step, at
        while audit[at:at + 1] == "I":
            state, at, step = int(FREE[state]), at + 1, step + 1
            rows.add(r["conv"], r["unknown"], r["place"], step, "I", "user" if state == USER else "assistant", "")

    for batch in batches:
        for r in batch.to_pylist():
            if (r["conv"], r["unknown"], r["tile"]) != now:
                now, audit, at, state = (r["conv"], r["unknown"], r["tile"]), r["audit"], 0, r["state"]
            left, step = r["n"], 0
            while left:
                insert(r)
                letter = audit[at]
                if letter == "D":  # deleted copies follow each other
                    gone = min(left, len(audit[at:at + left]) - len(audit[at:at + left].lstrip("D")))
                    left, at = left - gone, at + gone
                    continue
                state = int(STEP[state, r["initial"]] if letter == "K" else FREE[state])
                role = r["role"] if letter == "K" else "user" if state == USER else "assistant"
                left, at, step = left - 1, at + 1, step + 1
                rows.add(r["conv"], r["unknown"], r["place"], step, letter, role, r["text"], size=len(r["text"]) + 64)
            if at + 2 >= len(audit) and r["closes"]:
                insert(r)
            if rows.full():
                yield rows.take()
    yield rows.take()


# --- the operator --------------------------------------------------------
def ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Distinct rows with their count, fault and place in a stored table; places rise inside a conversation."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("conv"), F.col(conv_col).isNull().alias("unknown"),
                     F.col(turn_col).alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"))
    rows = rows.withColumns({"s1": F.xxhash64("role", "text"), "s2": F.xxhash64(F.lit(1), "role", "text")})
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    earliest = rows.groupBy(*KEY, "s1", "s2").agg(F.min(when).alias("earliest"), F.count("*").alias("m")).filter("m > 1").drop("m")
    counted = rows.groupBy(*KEY, "turn", "role", "text", "s1", "s2").agg(F.count("*").alias("n"))
    counted = counted.join(earliest, [*KEY, "s1", "s2"], "left")
    blank = r"\x20\x09-\x0D"
    fault = (F.when(~F.col("text").rlike(f"[^{blank}]"), BLANK).when(F.col("earliest") < when, DUPLICATE)
             .when(~F.col("text").rlike(rf"[.!?][{blank}]*\z"), CUT_OFF).otherwise(SOUND))
    initial = F.coalesce(F.array_position(F.array(*map(F.lit, "sua")), F.substring("role", 1, 1)), F.lit(0))
    initial = F.when(initial == 0, 3).otherwise(initial - 1).cast("int")
    order = [F.col(c).asc_nulls_first() for c in (*KEY, "turn", "role", "text")]
    placed = (counted.select(*KEY, "turn", "role", "text", "n", fault.alias("fault"), initial.alias("initial"))
              .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    return cut(placed.withColumn("tile", F.shiftright("place", TILE_BITS)), "conversation-rows")


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> Repair:
    rows = ordered(df, conv_col, turn_col, role_col, text_col)
    in_order = Window.partitionBy(*KEY).orderBy("tile")
    tiles = rows.select(*KEY, "tile").distinct()
    tiles = cut(tiles.withColumns({"opens": F.lag("tile").over(in_order).isNull(), "closes": F.lead("tile").over(in_order).isNull()}),
                "tiles")
    steps = rows.select(*KEY, "tile", "place", "initial", "fault", "n")
    whole = F.col("opens") & F.col("closes")
    dealt = lambda d: d.repartition(*KEY, "tile").sortWithinPartitions(*KEY, "tile", "place").drop("place")

    parts = dealt(steps.join(tiles.filter(~whole).select(*KEY, "tile"), [*KEY, "tile"], "left_semi"))
    backwards = (parts.mapInArrow(matrices, "conv string, unknown boolean, tile long, costs array<long>")
                 .repartition(*KEY).sortWithinPartitions(*KEY, F.desc("tile")))
    rest = backwards.mapInArrow(rests, "conv string, unknown boolean, tile long, rest array<long>")
    at_end = F.array(*[F.lit(int(x)).cast("long") for x in AT_END])
    known = (tiles.filter(whole).withColumn("rest", at_end)
             .unionByName(tiles.filter(~whole).join(rest, [*KEY, "tile"])))
    solving = dealt(steps.join(known.select(*KEY, "tile", "rest", "opens"), [*KEY, "tile"]))
    paths = solving.mapInArrow(solve, PATHS_SQL).join(tiles.select(*KEY, "tile", "closes"), [*KEY, "tile"])
    paths = paths.repartition(*KEY).sortWithinPartitions(*KEY, "tile")
    chosen = cut(paths.mapInArrow(chain, CHOSEN_SQL), "chosen-paths")

    picked = chosen.select(*KEY, "tile", "state", "audit").join(tiles.select(*KEY, "tile", "closes"), [*KEY, "tile"])
    repaired = dealt_rows(rows, picked).mapInArrow(replay, REPAIRED_SQL)
    copies = lambda bad: F.sum(F.when(bad, F.col("n")).otherwise(0))
    sound = F.col("fault").isin(SOUND, CUT_OFF)
    faults = (rows.groupBy(*KEY, "turn")
              .agg(copies(F.col("fault") == BLANK).alias("blank"),
                   (copies(F.col("fault") == DUPLICATE) + F.sum(F.when(sound, F.col("n") - 1).otherwise(0))).alias("duplicate"),
                   F.sum((F.col("fault") == CUT_OFF).cast("long")).alias("truncated"))
              .groupBy(*KEY).agg(F.max("turn").alias("last"), F.min("turn").alias("first"), F.count("turn").alias("turns"),
                                 *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]))
    gaps = F.coalesce(F.col("last") - F.col("first") + 1 - F.col("turns"), F.lit(0))
    audits = chosen.groupBy(*KEY).agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
                                      F.sort_array(F.collect_list(F.struct("tile", "audit"))).alias("parts"))
    summary = faults.join(audits, KEY).select(
        *KEY, gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join("parts.audit", "").alias("audit"))
    return Repair(repaired, summary)


def dealt_rows(rows: DataFrame, picked: DataFrame) -> DataFrame:
    """The rows of every tile in order, with the tile's path."""
    return (rows.select(*KEY, "tile", "place", "initial", "n", "role", "text").join(picked, [*KEY, "tile"])
            .repartition(*KEY, "tile").sortWithinPartitions(*KEY, "tile", "place"))


def hashes(repaired: DataFrame) -> DataFrame:
    """(conv, unknown, repaired_sha256): SHA-256 of each conversation's ``role:text`` lines.  A
    task streams a conversation's rows in order and holds only the hash."""
    schema = pa.schema([("conv", pa.string()), ("unknown", pa.bool_()), ("repaired_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, state = Rows(schema), None, None
        for batch in batches:
            for conv, unknown, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv, unknown) != now:
                    if now is not None:
                        rows.add(*now, state.hexdigest())
                    now, state = (conv, unknown), hashlib.sha256()
                    state.update(line.encode())
                else:
                    state.update(b"\n" + line.encode())
            if rows.full():
                yield rows.take()
        if now is not None:
            rows.add(*now, state.hexdigest())
        yield rows.take()

    lines = repaired.select(*KEY, "place", "step", F.concat_ws(":", "role", "text").alias("line"))
    lines = lines.repartition(*KEY).sortWithinPartitions(*KEY, "place", "step").drop("place", "step")
    return lines.mapInArrow(hashed, "conv string, unknown boolean, repaired_sha256 string")


# --- damaged input for the query -----------------------------------------
def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Rows dropped, emptied, shorn of ``.!?``, repeated or given to the user, by the CRC-32 of ``conv:turn`` modulo
    20 (0 to 4); nulls are one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col))) % 20
    rows = df.select(F.col(conv_col), F.col(turn_col), said(role_col).alias(role_col), said(text_col).alias(text_col), h.alias("_h"))
    text: Column = (F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.regexp_replace(text_col, "[.!?]", ""))
                    .otherwise(F.col(text_col)))
    rows = rows.filter("_h <> 0").withColumns({text_col: text, role_col: F.when(F.col("_h") == 4, "user").otherwise(F.col(role_col))})
    twice = F.explode(F.when(F.col("_h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(conv_col, turn_col, role_col, text_col, twice.alias("_copy")).drop("_copy")
