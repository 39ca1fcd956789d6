"""N-gram model with interpolated modified Kneser-Ney smoothing, counted in Spark.

Tokens are words, runs of bytes other than the six ASCII spaces with A-Z lower-cased, and one end
after the last word. A word is known by a 64-bit hash.

Counting: tasks count the distinct words of their rows and pass on sorted arrays per shard of the
hash; each shard is merged and stored as a sorted hash array with counts. A word's place in the
arrays is its number. For each length from two to the order, tasks map these arrays, count entries (number
of the context, number of the word) and pass them on likewise; a context that is too frequent for one shard
is spread over all. Merged entries are stored as sorted arrays with counts, and an entry's place is its number
as the context of the next length. From the order downward, a merge by number then gives each context its
numbers of entries seen once, twice and more often, and each entry its number of words before it, which
is its count in the next step. Scoring tasks map all arrays and look up the words and entries of their rows.

Arrays live in the shared folder. Where it is a mounted file system they are memory-mapped in
place, else a worker maps a local copy that has no name any more.

Model: p(w | uv) = max(c(uvw) - D(c(uvw)), 0) / c(uv.) + g(uv) p(w | v), and so on down to p(w) over
1 / (V + 1), where V + 1 counts one unknown word. Below the order c is the number of different words
before, but for entries that begin with the start of a text, which keep how often they occur. D has three
values per length, from the numbers of entries counted one to four times. After a context that was not
seen the next shorter one is used.

Defined results: null is the empty text and has the end only. Nothing learned: each token has
probability 1. Numbers that would make a discount undefined give 0.5, 1 and 1.5. Repeated rows count
each time. Result columns replace columns of the same name. An empty table gives no rows.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from bayline.llm.common import row_chunks, stage, text_bytes
from bayline.llm.files import local_path, open_file, write_file
from bayline.session import scratch_dir

#: Bytes of training text per shard, and distinct entries that a task gathers before it passes them on.
SHARD_BYTES = 16 << 20
MOST_SHARDS = 1 << 14
GATHERED = 1 << 20
PIECE_BYTES = 1 << 20
#: Entries that a merge looks up at once.
LOOKED_UP = 1 << 18

END = np.uint64(0x656E64)
BASE = 0x5851F42D4C957F2D
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below n."""
    out = np.ones(n, np.uint64)
    have, step = 1, base
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * np.uint64(step)
        step, have = step * step & MASK, have + take
    return out


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
VALUE[65:91] = VALUE[97:123]  # A-Z as a-z


def word_hashes(raw: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each word; ``first`` are places at which a text starts."""
    n = len(raw)
    word = ~SPACE[raw]
    after = np.ones(n + 1, bool)  # no word goes on into this place
    after[1:n] = ~word[:-1]
    after[first[first < n]] = True
    starts = np.flatnonzero(word & after[:n])
    after[:-1] |= ~word
    ends = np.flatnonzero(word & after[1:]) + 1
    size = 1 << max(10, int(n).bit_length())
    if size not in _tables:
        _tables[size] = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)
    up, down = _tables[size]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(VALUE[raw] * up[:n], out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    return mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(48))), starts


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts, each text closed by END; the number of tokens of each."""
    hashes, places, at = [], [], 0
    while at < len(raw):
        to = min(len(raw), at + PIECE_BYTES)
        while to < len(raw) and not SPACE[raw[to]]:
            to += 1
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to)] - at
        found, starts = word_hashes(raw[at:to], inside)
        hashes.append(found)
        places.append(starts + at)
        at = to
    words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    counts = np.diff(np.searchsorted(np.concatenate(places), offsets)) if places else np.zeros(len(offsets) - 1, np.int64)
    out = np.full(len(words) + len(counts), END)
    is_word = np.ones(len(out), bool)
    is_word[np.cumsum(counts + 1) - 1] = False
    out[is_word] = words
    return out, counts + 1


def before(ids: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The token before each token; ``start`` before the first of a text."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[np.cumsum(lengths) - lengths] = start
    return out


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their sums."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def squeezed(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, without the planes that are zero in all; the first byte is their number."""
    planes = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    return bytes([planes]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()


def spread(data: bytes) -> np.ndarray:
    planes = data[0]
    out = np.zeros(((len(data) - 1) // planes, 8), np.uint8)
    out[:, :planes] = np.frombuffer(data, np.uint8, offset=1).reshape(planes, -1).T
    return out.view("<u8").ravel()


PARTS = "part int, keys binary, counts binary"


def part_rows(keys: np.ndarray, counts: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """Rows of PARTS: the entries of each part, keys as differences."""
    order = np.argsort(part, kind="stable")
    keys, counts, part = keys[order].astype(np.uint64), counts[order], part[order]
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(part))
    rows = [(int(part[a]), squeezed(np.diff(keys[a:b], prepend=np.uint64(0))), squeezed(counts[a:b])) for a, b in zip(cuts, ends)]
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["part", "keys", "counts"])


def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All entries of one part, summed."""
    keys = np.concatenate([np.cumsum(spread(k.as_py()), dtype=np.uint64) for k in table["keys"]])
    counts = np.concatenate([spread(c.as_py()) for c in table["counts"]]).astype(np.int64)
    return summed(keys, counts)


def gathered(batches: Iterator[pa.RecordBatch], keys_of, part_of) -> Iterator[pa.RecordBatch]:
    """Counts of the keys of all rows, passed on whenever GATHERED distinct ones are held."""
    held, sums = np.empty(0, np.uint64), np.empty(0, np.int64)
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for i, j in row_chunks(offsets):
            at = offsets[i : j + 1]
            keys, counts = summed(keys_of(*tokens(raw[at[0] : at[-1]], at - at[0])))
            held, sums = summed(np.concatenate((held, keys)), np.concatenate((sums, counts)))
            if len(held) >= GATHERED:
                yield part_rows(held, sums, part_of(held))
                held, sums = held[:0], sums[:0]
    if len(held):
        yield part_rows(held, sums, part_of(held))


_mapped: dict[str, np.ndarray] = {}


def mapped(uri: str) -> np.ndarray:
    """A file of unsigned 64-bit numbers, memory-mapped once per worker."""
    if uri not in _mapped:
        path = local_path(uri)
        if path is None:
            copy = tempfile.TemporaryFile()  # gone with the worker
            with open_file(uri) as source:
                while block := source.read(1 << 24):
                    copy.write(block)
            copy.flush()
            path = copy
        _mapped[uri] = np.memmap(path, "<u8", "r")
    return _mapped[uri]


def packed_counts(values: np.ndarray) -> bytes:
    """A byte per number, and places and values of those that need more."""
    big = np.flatnonzero(values >= 255)
    small = np.zeros(-(-len(values) // 8) * 8, np.uint8)
    small[: len(values)] = np.minimum(values, 255)
    head = np.array([len(values), len(big)], "<u8")
    return b"".join([head.tobytes(), small.tobytes(), big.astype("<u8").tobytes(), values[big].astype("<u8").tobytes()])


class Packed:
    """Numbers written by packed_counts at a place of a mapped array; ``end`` is where they end."""

    def __init__(self, data: np.ndarray, at: int):
        n, big = int(data[at]), int(data[at + 1])
        a = at + 2 + -(-n // 8)
        self.small, self.places, self.values = data[at + 2 : a].view(np.uint8)[:n], data[a : a + big], data[a + big : a + 2 * big]
        self.end = a + 2 * big

    def __getitem__(self, at) -> np.ndarray:
        out = self.small[at].astype(np.int64)
        big = np.flatnonzero(out == 255)
        places = np.arange(len(self.small))[at] if isinstance(at, slice) else at
        out[big] = self.values[np.searchsorted(self.places, places[big].astype(np.uint64))]
        return out


@dataclass
class Counts:
    """Where the arrays are and what a task has to know of them."""

    path: str
    shards: int
    starts: list[int]  # number of the first word of each shard, and of all words
    tokens: int
    texts: int
    grams: dict[int, list[int]]  # by length, from two on: number of the first entry of each shard, and of all

    @property
    def words(self) -> int:
        return self.starts[-1]

    @property
    def range_size(self) -> int:
        return max(1, -(-(self.words + 1) // self.shards))

    def word_array(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        n, data = self.starts[shard + 1] - self.starts[shard], mapped(f"{self.path}/words-{shard:05d}")
        return data[:n], data[n : 2 * n]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1 if unknown) and count of each word, sorted distinct hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        shard = shard_of(hashes, self.shards)
        edges = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(edges)):
            if self.starts[s] == self.starts[s + 1]:
                continue
            a, b = edges[s], edges[s + 1]
            keys, totals = self.word_array(s)
            at = np.minimum(np.searchsorted(keys, hashes[a:b]), len(keys) - 1)
            hit = keys[at] == hashes[a:b]
            ids[a:b][hit] = at[hit] + self.starts[s]
            counts[a:b][hit] = totals[at[hit]]
        return ids, counts

    def looked_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts = self.numbers(distinct)
        return ids[back], counts[back]

    def gram_array(self, length: int, shard: int) -> tuple[np.ndarray, Packed]:
        """Sorted keys of a shard and their counts."""
        data = mapped(f"{self.path}/grams-{length}-{shard:05d}")
        n = int(data[0])
        return data[1 : n + 1], Packed(data, n + 1)

    def by_shard(self, length: int, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Shard, places in ``ids`` and places in the shard of numbered entries."""
        starts = self.starts if length == 1 else self.grams[length]
        shard = np.searchsorted(starts, ids, "right") - 1
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(edges)):
            some = order[edges[s] : edges[s + 1]]
            yield s, some, ids[some] - starts[s]

    def context_counts(self, ids: np.ndarray, length: int = 1) -> np.ndarray:
        """How often each context occurs; the number after the last word is the start of a text."""
        out = np.full(len(ids), self.texts, np.int64)
        inside = np.flatnonzero(ids < self.words) if length == 1 else np.arange(len(ids))
        for s, some, at in self.by_shard(length, ids[inside]):
            out[inside[some]] = self.word_array(s)[1][at] if length == 1 else self.gram_array(length, s)[1][at]
        return out

    def gram_shard(self, length: int, keys: np.ndarray) -> np.ndarray:
        """Shard of each entry: by its context, or by the entry if the context is a hot one."""
        contexts, back = np.unique(keys >> np.uint64(32), return_inverse=True)
        hot = self.context_counts(contexts.astype(np.int64), length - 1) > max(1, self.tokens // self.shards // 2)
        by = np.where(hot[back], keys, contexts[back])
        return (mix(by + np.uint64(1)) % np.uint64(self.shards)).astype(np.int64)

    def found(self, length: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1 if there is none) and count of each entry."""
        keys, back = np.unique(keys, return_inverse=True)
        ids, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        shard = self.gram_shard(length, keys)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.shards + 1))
        starts = self.grams[length]
        for s in np.flatnonzero(np.diff(edges)):
            if starts[s] == starts[s + 1]:  # no entry of the training texts fell into this shard
                continue
            some = order[edges[s] : edges[s + 1]]
            stored, totals = self.gram_array(length, s)
            at = np.minimum(np.searchsorted(stored, keys[some]), len(stored) - 1)
            hit = stored[at] == keys[some]
            ids[some[hit]] = at[hit] + starts[s]
            counts[some[hit]] = totals[at[hit]]
        return ids[back], counts[back]

    def keys_at(self, length: int, ids: np.ndarray) -> np.ndarray:
        """The keys of numbered entries."""
        out = np.zeros(len(ids), np.uint64)
        for s, some, at in self.by_shard(length, ids):
            out[some] = self.gram_array(length, s)[0][at]
        return out

    def without_first(self, length: int, keys: np.ndarray) -> np.ndarray:
        """Number of each entry's words but the first, as an entry one shorter."""
        context, word = split(keys)
        if length == 2:
            return word
        heads, back = np.unique(context, return_inverse=True)
        rest = self.without_first(length - 1, self.keys_at(length - 1, heads))[back]
        return self.found(length - 1, joined(rest, word))[0]

    def at_start(self, length: int, keys: np.ndarray) -> np.ndarray:
        """Whether the entry begins with the start of a text."""
        context = split(keys)[0]
        if length == 2:
            return context == self.words
        heads, back = np.unique(context, return_inverse=True)
        return self.at_start(length - 1, self.keys_at(length - 1, heads))[back]

    def contexts(self, numbers: np.ndarray, lengths: np.ndarray, length: int) -> np.ndarray:
        """Number of the context of each token, an entry one shorter than ``length``; -1 if there is none."""
        return before(numbers, lengths, self.words if length == 2 else -1)


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (context << 32 | word).astype(np.uint64)


def split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def count_words(shards: int):
    def run(batches):
        return gathered(batches, lambda hashes, lengths: hashes, lambda keys: shard_of(keys, shards))

    return run


def store_words(path: str):
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        keys, counts = merged(table)
        write_file(f"{path}/words-{part:05d}", [keys.astype("<u8").tobytes(), counts.astype("<u8").tobytes()])
        return pa.table({"part": pa.array([part], pa.int32()), "words": [len(keys)], "tokens": [int(counts.sum())]})

    return run


def count_grams(model: Counts, length: int):
    def keys_of(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        ids = model.looked_up(hashes)[0]
        numbers = ids
        for shorter in range(2, length):
            context = model.contexts(numbers, lengths, shorter)
            there = np.flatnonzero(context >= 0)
            numbers = np.full(len(ids), -1, np.int64)
            numbers[there] = model.found(shorter, joined(context[there], ids[there]))[0]
        context = model.contexts(numbers, lengths, length)
        return joined(context[context >= 0], ids[context >= 0])

    return lambda batches: gathered(batches, keys_of, lambda keys: model.gram_shard(length, keys))


STATS = "kind int, part int, keys binary, counts binary"
#: Kinds of STATS rows: contexts by number of entries seen once, twice, more often; words before an entry;
#: sum of a context's entries; entries by count, with the count as key; entries of a shard.
ONCE, TWICE, MORE, CONTEXTS, TOTAL, ENTRIES, SIZE = range(7)


def stats_rows(kind: int, ids: np.ndarray, n: np.ndarray, part: np.ndarray) -> pa.Table:
    rows = pa.Table.from_batches([part_rows(ids, n, part)])
    return rows.add_column(0, "kind", pa.array([kind] * len(rows), pa.int32()))


def stats_of(model: Counts, length: int, keys: np.ndarray, counts: np.ndarray, top: bool) -> list[pa.Table]:
    """What entries tell of their contexts, of the entries one shorter and of their counts."""
    context = split(keys)[0]
    rest = np.concatenate([model.without_first(length, keys[i : i + LOOKED_UP]) for i in range(0, len(keys), LOOKED_UP)])
    found = [(kind, *np.unique(some, return_counts=True)) for kind, some in ((ONCE, context[counts == 1]), (TWICE, context[counts == 2]), (MORE, context[counts > 2]), (CONTEXTS, rest))]
    if not top:
        found.append((TOTAL, *summed(context, counts)))
    starts = np.array(model.grams.get(length - 1, []))
    out = [stats_rows(kind, ids, n, ids // model.range_size if length == 2 else np.searchsorted(starts, ids, "right") - 1) for kind, ids, n in found]
    ids, n = np.unique(counts[counts < 5], return_counts=True)
    return [*out, stats_rows(ENTRIES, ids, n, np.zeros(len(ids), np.int64))]


def store_grams(model: Counts, length: int, top: bool):
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        keys, counts = merged(table)
        write_file(f"{model.path}/grams-{length}-{part:05d}", [np.array([len(keys)], "<u8").tobytes(), keys.astype("<u8").tobytes(), packed_counts(counts)])
        size = stats_rows(SIZE, np.zeros(1, np.int64), np.array([len(keys)]), np.array([part]))
        return pa.concat_tables([size, *(stats_of(model, length, keys, counts, True) if top else [])])

    return run


def dense(table: pa.Table, first: int, size: int) -> np.ndarray:
    """Values by kind of the numbers from ``first`` on."""
    arrays = np.zeros((TOTAL + 1, size), np.int64)
    for kind in range(TOTAL + 1):
        rows = table.filter(pa.compute.equal(table["kind"], kind))
        if len(rows):
            keys, counts = merged(rows)
            arrays[kind][keys.astype(np.int64) - first] = counts
    return arrays


def store_gram_ranges(model: Counts, length: int):
    """Dense arrays for the entries of a shard -> stats of their counts, the numbers of words before them."""

    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        first = model.grams[length][part]
        arrays = dense(table, first, model.grams[length][part + 1] - first)
        keys, counts = model.gram_array(length, part)
        keys, raw = np.array(keys), counts[:]
        # nothing stands before the start of a text
        for i in range(0, len(keys), LOOKED_UP):
            start = np.flatnonzero(model.at_start(length, keys[i : i + LOOKED_UP])) + i
            arrays[CONTEXTS][start] = raw[start]
        write_file(f"{model.path}/ranges-{length}-{part:05d}", [packed_counts(a) for a in arrays])
        return pa.concat_tables(stats_of(model, length, keys, arrays[CONTEXTS], False))

    return run


def store_ranges(model: Counts):
    """Dense arrays for a range of numbers; how many words have one to four contexts, and all pairs."""

    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        arrays = dense(table, part * model.range_size, model.range_size)
        write_file(f"{model.path}/ranges-1-{part:05d}", [packed_counts(a) for a in arrays])
        n = [int((arrays[CONTEXTS] == i).sum()) for i in range(1, 5)]
        return pa.table({"part": pa.array([part], pa.int32()), "n": pa.array([n], pa.list_(pa.int64())), "pairs": [int(arrays[CONTEXTS].sum())], "words": [int((arrays[CONTEXTS] > 0).sum())]})

    return run


def discounts(n: list[int]) -> list[float]:
    """For counts 0, 1, 2 and more, from how many entries have the counts one to four."""
    if not all(n):
        return [0.0, 0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [0.0, *(min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05), i + 1.0) for i in range(3))]


@dataclass
class Model:
    counts: Counts
    gram_discounts: dict[int, list[float]]
    word_discounts: list[float]
    pairs: int  # distinct ones
    by_contexts: list[int]  # words in one, two and more contexts
    there: list[int]  # ranges of words that have a file

    @property
    def order(self) -> int:
        return max(self.gram_discounts)

    def range_values(self, ids: np.ndarray, length: int = 1) -> np.ndarray:
        """The dense values of each number, as rows."""
        c, out = self.counts, np.zeros((TOTAL + 1, len(ids)), np.int64)
        if length == 1:
            part = ids // c.range_size
            places = ((p, np.flatnonzero(part == p), ids[part == p] - p * c.range_size) for p in np.unique(part) if p in self.there)
        else:
            places = c.by_shard(length, ids)
        for p, some, at in places:
            data, end = mapped(f"{c.path}/ranges-{length}-{p:05d}"), 0
            for kind in range(TOTAL + 1):
                values = Packed(data, end)
                out[kind, some], end = values[at], values.end
        return out

    def word_probability(self, ids: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """p(w): ids of -1 are unknown."""
        uniform = 1 / (self.counts.words + 1)
        if not self.pairs:
            return np.full(len(ids), uniform)
        d = np.array(self.word_discounts)
        left = float(d[1:] @ np.array(self.by_contexts)) / self.pairs
        return np.maximum(contexts - d[np.minimum(contexts, 3)], 0) / self.pairs + left * uniform

    def token_scores(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: count in training, base and model log10 probability."""
        c = self.counts
        distinct, back = np.unique(hashes, return_inverse=True)
        numbers, totals = c.numbers(distinct)
        contexts = np.zeros(len(distinct), np.int64)
        known = numbers >= 0
        contexts[known] = self.range_values(numbers[known])[CONTEXTS]
        single = self.word_probability(numbers, contexts)[back]
        ids, counts = numbers[back], totals[back]
        base = np.log10((counts + 1) / (c.tokens + c.words + 1))
        p, numbers = single, ids
        for length in range(2, self.order + 1):
            context = c.contexts(numbers, lengths, length)
            numbers = np.full(len(ids), -1, np.int64)
            seen = np.flatnonzero((context >= 0) & (c.texts > 0))
            if not len(seen):
                continue
            heads, at = np.unique(context[seen], return_inverse=True)
            values = self.range_values(heads, length - 1)
            d = np.array(self.gram_discounts[length])
            total = np.maximum(c.context_counts(heads, length - 1) if length == self.order else values[TOTAL], 1)
            rest = (d[1:, None] * values[:3]).sum(0) / total
            both = seen[ids[seen] >= 0]
            gram = np.zeros(len(ids), np.int64)
            numbers[both], gram[both] = c.found(length, joined(context[both], ids[both]))
            if length < self.order:
                some = np.flatnonzero(numbers >= 0)
                gram[some] = self.range_values(numbers[some], length)[CONTEXTS]
            gram = gram[seen]
            # a context whose entries were all lost to nothing has no rest: it cannot occur, but stays finite
            rest = np.where(values[:3].sum(0) > 0, rest, 1.0)
            lower, p = p, p.copy()
            p[seen] = np.maximum(gram - d[np.minimum(gram, 3)], 0) / total[at] + rest[at] * lower[seen]
        return counts, base, np.log10(p)


def train(docs: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Count the texts of all rows and store the arrays in the shared folder."""
    if order < 2:
        raise ValueError("the order is two or more")
    spark = docs.sparkSession
    path = scratch_dir(spark, "kneser-ney")
    rows = docs.select(F.col(text).cast("string").alias("text"))
    texts, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = int(max(1, min(MOST_SHARDS, size // SHARD_BYTES + 1)))
    found = rows.mapInArrow(count_words(shards), PARTS).groupBy("part").applyInArrow(store_words(path), "part int, words long, tokens long")
    stored = {r.part: r for r in stage(found, "word-shards").collect()}  # one row per shard
    starts = np.cumsum([0, *(stored[s].words if s in stored else 0 for s in range(shards))]).tolist()
    counts = Counts(path, shards, starts, sum(r.tokens for r in stored.values()), texts, {})
    if counts.words >= (1 << 32) - 1:
        raise ValueError("entries hold numbers of 32 bits: too many distinct words")
    for length in range(2, order + 1):
        grams = rows.mapInArrow(count_grams(counts, length), PARTS).groupBy("part").applyInArrow(store_grams(counts, length, length == order), STATS)
        stats = stage(grams, "gram-stats")
        sizes = {r.part: int(spread(r["counts"])[0]) for r in stats.filter(F.col("kind") == SIZE).select("part", "counts").collect()}  # one row per shard
        starts = np.cumsum([0, *(sizes.get(s, 0) for s in range(shards))]).tolist()
        if length < order and starts[-1] >= (1 << 32) - 1:
            raise ValueError("entries hold numbers of 32 bits: too many distinct contexts")
        counts = replace(counts, grams={**counts.grams, length: starts})
    gram_discounts = {order: entry_discounts(stats)}
    for length in range(order - 1, 1, -1):
        ranges = stats.filter(F.col("kind") <= TOTAL).groupBy("part").applyInArrow(store_gram_ranges(counts, length), STATS)
        stats = stage(ranges, "gram-stats")
        gram_discounts[length] = entry_discounts(stats)
    ranges = stats.filter(F.col("kind") <= TOTAL).groupBy("part").applyInArrow(store_ranges(counts), "part int, n array<long>, pairs long, words long")
    ranges = stage(ranges, "ranges").collect()  # one row per range
    n = [sum(r.n[i] for r in ranges) for i in range(4)]
    words = sum(r.words for r in ranges)
    return Model(
        counts, gram_discounts, discounts(n),
        sum(r.pairs for r in ranges), [n[0], n[1], words - n[0] - n[1]], [r.part for r in ranges],
    )


def entry_discounts(stats: DataFrame) -> list[float]:
    by_count = {}
    for row in stats.filter(F.col("kind") == ENTRIES).select("keys", "counts").collect():  # one row per shard
        for key, n in zip(np.cumsum(spread(row["keys"])).tolist(), spread(row["counts"]).tolist()):
            by_count[key] = by_count.get(key, 0) + n
    return discounts([by_count.get(i, 0) for i in range(1, 5)])


SCORES = (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double"))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Columns of ``docs`` but the text, and n_tokens, n_known, base_score and score."""
    names = [n for n, _ in SCORES]
    kept = [f for f in docs.schema.fields if f.name != text and f.name not in names]
    schema = StructType([*kept, *(StructField(n, LongType() if t == "long" else DoubleType()) for n, t in SCORES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(text))
            found: list[list[np.ndarray]] = [[], [], [], []]
            for i, j in row_chunks(offsets):
                at = offsets[i : j + 1]
                hashes, lengths = tokens(raw[at[0] : at[-1]], at - at[0])
                counts, base, score = model.token_scores(hashes, lengths)
                first = np.cumsum(lengths) - lengths
                for column, value in zip(found, (lengths, *(np.add.reduceat(x, first) for x in ((counts > 0).astype(np.int64), base, score)))):
                    column.append(value)
            made = [np.concatenate(c) if c else np.empty(0, np.int64) for c in found]
            columns = [batch.column(f.name) for f in kept] + [pa.array(m, pa.int64() if t == "long" else pa.float64()) for m, (_, t) in zip(made, SCORES)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), *names])

    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").cast("string").alias(text))
    return rows.mapInArrow(run, schema)
