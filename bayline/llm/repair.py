"""Repair of damaged conversations: the cheapest edits that give the order of roles ``(s?(ua)+)?``.

Rows of a conversation are taken by turn, nulls first; rows of equal turn by the hash of role and text, so
equal rows are neighbours and which of them is which does not matter. A row's first fault counts: blank
(nothing but ASCII spaces), duplicate (role and text seen earlier in the conversation), truncated (its last
other character is none of ``.!?``). Blank and duplicate rows must be deleted.

A row is one of nine symbols: to be deleted, or its role's initial (s, u, a, other) with or without the
truncated fault. Each symbol has a min-plus matrix over the four states of the pattern (nothing yet, after
s, u, a). Equal neighbouring symbols collapse to runs; a run of n rows is applied by the matrix powers of the
bits of n, which are kept from run to run. That gives the least cost of the rest at every run, from the end to
the start. The choices are then unrolled forward: of the cheapest edits the first in ASCII order (D, I, K, R).

Spark ranks narrow rows (two 64-bit hashes instead of texts, trusted as one identity), finds first
occurrences with a minimum per role and text, and cuts the ranks into pieces of at most ``PIECE`` rows that
tasks collapse to runs; a conversation of any length is spread over pieces. Only the runs of a conversation
meet in one task, which writes its audit (one letter per row, one cell of the result), so they take no more
room than that cell. Texts are shuffled once, to the kept edits, and stream in order; a digest over a whole
conversation is a chain, so one task reads a conversation's texts, one batch at a time.

Defined results: a null role or text is one space. Null turns come first and have no part in gaps. Null
``conv_id`` is a conversation of its own. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.llm.common import prepare, shuffle_partitions, stage, with_rank

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"
#: Rows of consecutive rank that one task collapses at once, as a power of two.
PIECE_BITS = 16
#: Rows of a run unrolled at once.
UNROLL = 1024
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or renamed row.
ONWARD = (USER, USER, ASSISTANT, USER)
#: Initials of a row's role, as symbols; anything else is the last.
INITIALS = "sua"
FAR = 1 << 62
Vector = tuple[int, int, int, int]
RUNS = (
    "conv_id long, piece long, first_at long, n long, blank long, duplicate long, truncated long, illegal long, "
    "turns long, low long, high long, first_turn long, last_turn long, first_initial string, last_initial string, "
    "symbols array<tinyint>, lengths array<int>"
)
SOLVED = (
    "conv_id long, first_at long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
EDITS = "conv_id long, at long, place long, edit string, role string, before int, after int"
REPAIRED = "conv_id long, place long, edit string, role string, text string"


# The dynamic programme over symbols: 0 must go, 1 + 2 * initial + truncated may stay.


def kept_state(initial: int, state: int) -> int | None:
    """The state after a kept row, None if the pattern does not allow it."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


@lru_cache(None)
def choices(symbol: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """Edits of a row as (letter, cost, state after), in ASCII order, without inserts."""
    found = [("D", DELETE, state)]
    if symbol:
        initial, truncated = divmod(symbol - 1, 2)
        kept = kept_state(initial, state)
        if kept is not None:
            found.append(("K", TRUNCATED * truncated, kept))
        found.append(("R", REROLE + TRUNCATED * truncated, ONWARD[state]))
    return tuple(found)


@lru_cache(None)
def power(symbol: int, k: int) -> tuple[Vector, ...]:
    """Min-plus matrix of 2 ** k rows of a symbol, each with inserts before it."""
    if k:
        half = power(symbol, k - 1)
        return tuple(tuple(min(row[m] + half[m][q] for m in range(4)) for q in range(4)) for row in half)
    matrix = []
    for state in range(4):
        row, at, cost = [FAR] * 4, state, 0
        for _ in range(4):  # no cheapest repair inserts more rows at one place than lead back to a state
            for _, more, after in choices(symbol, at):
                row[after] = min(row[after], cost + more)
            at, cost = ONWARD[at], cost + INSERT
        matrix.append(tuple(row))
    return tuple(matrix)


def applied(matrix: tuple[Vector, ...], after: Vector) -> Vector:
    return tuple(min(row[q] + after[q] for q in range(4)) for row in matrix)


def before_run(symbol: int, length: int, after: Vector) -> Vector:
    """Least cost of the rest before a run, from that after it."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            after = applied(power(symbol, k), after)
    return after


@lru_cache(1 << 14)
def step(symbol: int, state: int, after: Vector) -> tuple[str, int]:
    """Letters up to and with the row's own, and the state behind it; ``after`` is relative."""
    before, letters = applied(power(symbol, 0), after), ""
    while True:
        for letter, cost, then in choices(symbol, state):
            if letter != "D" and before[ONWARD[state]] + INSERT == before[state]:
                break
            if cost + after[then] == before[state]:
                return letters + letter, then
        letters, state = letters + "I", ONWARD[state]


def unrolled(symbol: int, length: int, state: int, after: Vector) -> Iterator[tuple[str, int]]:
    """Letters of a run and the state behind them, some rows at a time."""
    for start in range(0, length, UNROLL):
        stop = min(start + UNROLL, length)
        costs, letters = [before_run(symbol, length - stop, after)], []
        for _ in range(stop - start - 1):
            costs.append(applied(power(symbol, 0), costs[-1]))
        for cost in reversed(costs):
            low = min(cost)
            chosen, state = step(symbol, state, tuple(c - low for c in cost))
            letters.append(chosen)
        yield "".join(letters), state


def cheapest(symbols: Sequence[int], lengths: Sequence[int]) -> tuple[int, str]:
    """Cost and audit of runs of symbols."""
    costs = [(0, 2 * INSERT, INSERT, 0)]  # behind the last row: what completes the pattern
    for symbol, length in zip(reversed(symbols), reversed(lengths)):
        costs.append(before_run(symbol, length, costs[-1]))
    audit, state = [], START
    for i, (symbol, length) in enumerate(zip(symbols, lengths)):
        for letters, state in unrolled(symbol, length, state, costs[-2 - i]):
            audit.append(letters)
    audit.append("I" * (0, 2, 1, 0)[state])
    return costs[-1][START], "".join(audit)


# Rows to symbols, symbols to runs, runs to audits.


def filled(turns: DataFrame) -> DataFrame:
    """The four columns; a null role or text is one space."""
    space = F.lit(" ")
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )


def identity() -> list[Column]:
    """Two hashes of role and text."""
    return [F.xxhash64(F.lit(i), "role", "text").alias(f"h{i}") for i in (1, 2)]


def narrow(turns: DataFrame) -> DataFrame:
    """Rows without texts: identity, initial of the role, blank, truncated."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    last = F.substring(trimmed, -1, 1)
    return turns.select(
        "conv_id", "turn", *identity(),
        F.substring("role", 1, 1).alias("initial"),
        (trimmed == "").alias("blank"),
        (~last.isin(*STOPS)).alias("truncated"),
    )


def marked(ranked: DataFrame) -> DataFrame:
    """ranked rows with duplicate: their role and text have an earlier rank in the conversation."""
    firsts = ranked.groupBy("conv_id", "h1", "h2").agg(F.min("at").alias("at"))
    rows = ranked.join(firsts.select("at", F.lit(False).alias("later")), "at", "left")
    return rows.select("at", "conv_id", "turn", "initial", "blank", F.coalesce("later", F.lit(True)).alias("duplicate"), "truncated")


def changes(values: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before; null equals null. The first does."""
    missing = np.asarray(values.is_null())
    raw = values.fill_null("" if pa.types.is_string(values.type) else 0).to_numpy(zero_copy_only=False)
    out = np.ones(len(values), bool)
    out[1:] = (raw[1:] != raw[:-1]) | (missing[1:] != missing[:-1])
    return out


def piece_runs(key: tuple, table: pa.Table) -> pa.Table:
    """For applyInArrow: rows of one piece -> a row for each conversation in it."""
    table = table.sort_by("at").combine_chunks()
    column = {n: table.column(n).combine_chunks() for n in table.column_names}
    flags = {n: column[n].to_numpy(zero_copy_only=False) for n in ("blank", "duplicate", "truncated")}
    at = column["at"].to_numpy()
    starts_conv = changes(column["conv_id"])
    first = np.flatnonzero(starts_conv)
    last = np.append(first[1:], len(at)) - 1

    gone = flags["blank"] | flags["duplicate"]
    cut = flags["truncated"] & ~gone
    initial = column["initial"].to_numpy(zero_copy_only=False)
    kind = np.full(len(at), len(INITIALS), np.int8)
    for i, letter in enumerate(INITIALS):
        kind[initial == letter] = i
    symbol = np.where(gone, 0, 1 + 2 * kind + cut).astype(np.int8)
    # s, u and a may be followed by u, a and u
    follows = np.zeros(len(at), bool)
    follows[1:] = ((kind[:-1] != 1) & (kind[:-1] < 3) & (kind[1:] == 1)) | ((kind[:-1] == 1) & (kind[1:] == 2))
    illegal = ~starts_conv & ~follows

    turn_there = np.asarray(column["turn"].is_valid())
    fresh = turn_there & (starts_conv | changes(column["turn"]))
    turn = column["turn"].fill_null(0).to_numpy()
    low = np.minimum.reduceat(np.where(turn_there, turn, np.iinfo(np.int64).max), first)
    high = np.maximum.reduceat(np.where(turn_there, turn, np.iinfo(np.int64).min), first)
    nowhere = ~np.logical_or.reduceat(turn_there, first)

    run = np.flatnonzero(starts_conv | changes(pa.array(symbol)))
    lengths = np.diff(np.append(run, len(at))).astype(np.int32)
    offsets = pa.array(np.append(np.searchsorted(run, first), len(run)).astype(np.int32))

    def total(values: np.ndarray) -> pa.Array:
        return pa.array(np.add.reduceat(values.astype(np.int64), first))

    return pa.table(
        {
            "conv_id": column["conv_id"].take(pa.array(first)),
            "piece": pa.array([key[0].as_py()] * len(first), pa.int64()),
            "first_at": pa.array(at[first]),
            "n": pa.array((last - first + 1).astype(np.int64)),
            "blank": total(flags["blank"]),
            "duplicate": total(flags["duplicate"] & ~flags["blank"]),
            "truncated": total(cut),
            "illegal": total(illegal),
            "turns": total(fresh),
            "low": pa.array(low, mask=nowhere),
            "high": pa.array(high, mask=nowhere),
            "first_turn": column["turn"].take(pa.array(first)),
            "last_turn": column["turn"].take(pa.array(last)),
            "first_initial": column["initial"].take(pa.array(first)),
            "last_initial": column["initial"].take(pa.array(last)),
            "symbols": pa.ListArray.from_arrays(offsets, pa.array(symbol[run])),
            "lengths": pa.ListArray.from_arrays(offsets, pa.array(lengths)),
        }
    )


class Conversation:
    """Pieces of one conversation, put together in order."""

    def __init__(self, piece: dict):
        self.piece = piece
        self.symbols, self.lengths = list(piece["symbols"]), list(piece["lengths"])

    def add(self, piece: dict) -> None:
        own = self.piece
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            own[name] += piece[name]
        own["illegal"] += own["last_initial"] + piece["first_initial"] not in ("su", "ua", "au")
        own["turns"] -= own["last_turn"] is not None and own["last_turn"] == piece["first_turn"]
        for name, pick in (("low", min), ("high", max)):
            own[name] = pick((v for v in (own[name], piece[name]) if v is not None), default=None)
        own["last_turn"], own["last_initial"] = piece["last_turn"], piece["last_initial"]
        joins = self.symbols[-1] == piece["symbols"][0]
        if joins:
            self.lengths[-1] += piece["lengths"][0]
        self.symbols += piece["symbols"][joins:]
        self.lengths += piece["lengths"][joins:]

    def solved(self) -> dict:
        own = self.piece
        cost, audit = cheapest(self.symbols, self.lengths)
        gaps = 0 if own["low"] is None else own["high"] - own["low"] + 1 - own["turns"]
        counts = {n: own[n] for n in ("conv_id", "first_at", "blank", "duplicate", "truncated", "illegal")}
        return {**counts, "gaps": gaps, "cost": cost, "audit": audit}


#: Conversations, and letters of their audits, in one batch of results.
SOLVED_ROWS, SOLVED_LETTERS = 4096, 1 << 24


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: pieces sorted by conversation and rank -> a row for each conversation."""
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SOLVED.split(", "))])
    now, done, letters = None, [], 0
    for batch in batches:
        for piece in batch.to_pylist():
            if now is not None and now.piece["conv_id"] == piece["conv_id"]:
                now.add(piece)
                continue
            if now is not None:
                done.append(now.solved())
                letters += len(done[-1]["audit"])
            now = Conversation(piece)
            if len(done) >= SOLVED_ROWS or letters >= SOLVED_LETTERS:
                yield pa.RecordBatch.from_pylist(done, schema)
                done, letters = [], 0
    if now is not None:
        done.append(now.solved())
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


# Audits to edits of rows, edits to repaired rows.


def edits_of(first_at: int, audit: str) -> list[np.ndarray]:
    """Rank, place, whether renamed, whether a user's, inserts before and after each kept row."""
    letter = np.frombuffer(audit.encode(), np.uint8)
    live, inserted = letter != ord("D"), letter == ord("I")
    place = np.cumsum(live) - 1
    row = np.cumsum(~inserted) - 1
    kept = np.flatnonzero(live & ~inserted)
    after = np.zeros(len(kept), np.int64)
    if len(kept):
        after[-1] = place[-1] - place[kept[-1]]
    leader = (len(place) and int(place[-1]) + 1) % 2  # a system row leads if the length is odd
    user = (place[kept] - leader) % 2 == 0
    return [first_at + row[kept], place[kept], letter[kept] == ord("R"), user, np.diff(place[kept], prepend=-1) - 1, after]


def kept_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: audits -> a row for each kept row: rank, place, new role, inserts around it."""
    for batch in batches:
        found = [edits_of(*a) for a in zip(*(batch.column(n).to_pylist() for n in ("first_at", "audit")))]
        at, place, renamed, user, before, after = (np.concatenate(c) for c in zip(*found))
        conv = batch.column("conv_id").take(pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found])))
        columns = [
            conv,
            pa.array(at),
            pa.array(place),
            pa.array(np.where(renamed, "R", "K").tolist(), pa.string()),
            pa.array(np.where(user, "user", "assistant").tolist(), pa.string(), mask=~renamed),
            pa.array(before.astype(np.int32)),
            pa.array(after.astype(np.int32)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "at", "place", "edit", "role", "before", "after"])


def repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: edits, each followed by the rows it may be of, all in order -> repaired rows.

    Whatever follows an edit before the next one is the same row repeated or of no edit; it is left out.
    """
    pending = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if pending is None else [pending, batch]).combine_chunks()
        pending = None
        is_edit = np.asarray(rows.column("place").combine_chunks().is_valid())
        if is_edit[-1]:
            pending = rows.slice(len(rows) - 1).to_batches()[0]
            rows, is_edit = rows.slice(0, len(rows) - 1), is_edit[:-1]
        edits = np.flatnonzero(is_edit)
        if not len(edits):
            continue
        edit = rows.take(pa.array(edits)).to_pydict()
        given = rows.select(["role", "text"]).take(pa.array(edits + 1)).to_pydict()
        out = []
        for i, conv in enumerate(edit["conv_id"]):
            at, role = edit["place"][i], edit["role"][i] or given["role"][i]
            initial = role[:1]
            for back in range(edit["before"][i], 0, -1):  # roles alternate towards the row
                name = "user" if (initial == "u") == (back % 2 == 0) else "assistant"
                out.append((conv, at - back, "I", name, ""))
            out.append((conv, at, edit["edit"][i], role, given["text"][i]))
            for on in range(1, edit["after"][i] + 1):
                name = "user" if (initial == "u") == (on % 2 == 0) else "assistant"
                out.append((conv, at + on, "I", name, ""))
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "place", "edit", "role", "text"])


def chain_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: repaired rows in order -> SHA-256 of ``role:text`` lines of each conversation."""
    now, state = None, None
    for batch in batches:
        ids, digests = [], []
        for conv, place, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "place", "role", "text"))):
            if not place:
                if state is not None:
                    ids.append(now)
                    digests.append(state.hexdigest())
                now, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests)], names=["conv_id", "sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], names=["conv_id", "sha256"])


class Repair:
    """The repair of a table of turns (conv_id, turn, role, text): ``solved`` per conversation, ``rows()`` of it."""

    def __init__(self, turns: DataFrame):
        spark = prepare(turns.sparkSession)
        self.turns = filled(turns)
        self.ranked = with_rank(narrow(self.turns), [F.col(c) for c in ("conv_id", "turn", "h1", "h2")], "at")
        piece = F.shiftright("at", PIECE_BITS).alias("piece")
        runs = marked(self.ranked).groupBy(piece).applyInArrow(piece_runs, RUNS)
        dealt = runs.repartition(shuffle_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "piece")
        #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
        self.solved = stage(dealt.mapInArrow(solve, SOLVED), "audits")

    def rows(self) -> DataFrame:
        """Repaired conversations: conv_id, place (from 0), edit, role, text, in order within each partition."""
        edits = self.solved.select("conv_id", "first_at", "audit").mapInArrow(kept_edits, EDITS)
        keys = self.ranked.select("at", "turn", "h1", "h2")
        edits = edits.join(keys, "at").select(
            "conv_id", "turn", "h1", "h2", F.lit(0).alias("kind"), "place", "edit", "before", "after", "role", F.lit(None).cast("string").alias("text")
        )
        none = [F.lit(None).cast(t).alias(n) for n, t in (("place", "long"), ("edit", "string"), ("before", "int"), ("after", "int"))]
        texts = self.turns.select("conv_id", "turn", *identity(), F.lit(1).alias("kind"), *none, "role", "text")
        order = ["conv_id", "turn", "h1", "h2", "kind"]
        both = edits.unionAll(texts).repartition(shuffle_partitions(edits.sparkSession), "conv_id").sortWithinPartitions(*order)
        return both.mapInArrow(repaired_rows, REPAIRED)

    def digests(self) -> DataFrame:
        """SHA-256 of each repaired conversation that has rows."""
        return self.rows().mapInArrow(chain_digests, "conv_id long, sha256 string")


def summary(ids: DataFrame, repair: Repair) -> DataFrame:
    """A row for each id (column conv_id): faults, cost, audit and digest of its repair; zeros where no rows are left."""
    every = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    solved = repair.solved.withColumnRenamed("conv_id", "solved_id")
    digests = repair.digests().withColumnRenamed("conv_id", "digest_id")
    rows = every.join(solved, F.expr("conv_id <=> solved_id"), "left").join(digests, F.expr("conv_id <=> digest_id"), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return rows.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults of known kind: crc32 of ``conv_id:turn`` modulo 20 chooses what is done.

    0 drops a row, 1 empties its text, 2 removes its stops, 3 repeats it, 4 makes it a user's.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = filled(turns).withColumn("kind", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
