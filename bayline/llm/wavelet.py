"""Token ids of documents in wavelet-matrix files, one per shard.

A file holds the ids of a run of documents as bit planes, most significant first. Each plane is
cut into blocks of 32,768 bits; a directory gives the offset of each compressed block and the
number of ones before it, so that access, rank and select open a few blocks per plane. Documents
are found by their first position. Files are ordered: the shard is a range of document ids, a shard
rolls to the next file once it holds ``file_tokens`` ids.

Layout: magic, length of the header, header (JSON: counts and the byte offset of each part), document
ids and their first positions (int64), per plane: ones before each block (int64), block offsets
(int64), blocks (zlib).

Defined results: a null text is empty and has only the end id; rows with a null id come first; rows
that share an id are ordered by their text. An empty table gives no files. Texts are encoded in
pieces at ASCII spaces, which the tokenizer drops, and where it always parts two characters; a piece's
ids are kept per worker, so that each distinct piece is encoded about once.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.common import row_chunks, shuffle_partitions, text_bytes
from bayline.llm.files import open_file, write_file

MAGIC = b"WMX1"
BLOCK_BITS = 1 << 15
END_ID = 2
FILE_TOKENS = 2_000_000
#: Bytes of text per shard of ids; cut points of ids are approximate quantiles.
SHARD_BYTES = 8 << 20
MOST_SHARDS = 10_000
#: Pieces whose ids a worker keeps; then it starts anew.
KEPT_PIECES = 500_000
#: Fixed value: the pattern of words of the tokenizers that take pieces.
WORDS_OF_TOKENIZER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SMALL_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")  # a-z and the small letters of Latin-1
#: Bytes of text whose pieces are found at once; numpy temporaries take about 30 times as much.
PIECE_BYTES = 4 << 20
#: Kinds of bytes; all that is not ASCII, and control characters, are OTHER.
OTHER, LETTER, MARK, APOSTROPHE, DIGIT, SPACE = range(6)
#: Fixed value: how the special tokens of these tokenizers begin.
SPECIAL = b"<|"

_pieces: dict[str, PieceIds] = {}
_tokenizers: dict[str, object] = {}
_by_pieces: dict[str, bool] = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it is printable and
    no space, else the next free one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(others)}


LETTERS = byte_letters()


def kinds_of_bytes() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    kinds[0x21:0x7F] = MARK
    for first, last, kind in ((b"a", b"z", LETTER), (b"A", b"Z", LETTER), (b"0", b"9", DIGIT), (b"'", b"'", APOSTROPHE)):
        kinds[first[0] : last[0] + 1] = kind
    kinds[list(b" \t\n\v\f\r")] = SPACE
    return kinds


def parting_pairs() -> np.ndarray:
    """Whether the tokenizer always parts a byte of one kind from the next of another: a space from
    all, a letter from a mark after it, a mark from a letter after it unless it is an apostrophe, a
    digit from all ASCII characters."""
    parts = np.zeros((6, 6), bool)
    parts[SPACE, :] = parts[:, SPACE] = True
    parts[LETTER, MARK] = parts[LETTER, APOSTROPHE] = parts[MARK, LETTER] = True
    parts[DIGIT, LETTER : DIGIT + 1] = parts[LETTER : DIGIT + 1, DIGIT] = True
    return parts.ravel()


KINDS, PARTING = kinds_of_bytes(), parting_pairs()


def pieces_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased pieces of all texts, one after the other, and the first piece of each text."""
    kinds = KINDS[raw]
    solid = kinds != SPACE
    first = np.ones(len(raw) + 1, bool)
    first[1:-1] = PARTING[kinds[:-1] * np.uint8(6) + kinds[1:]]
    first[offsets] = True
    starts = np.flatnonzero(first[:-1] & solid)
    ends = (np.cumsum(solid, dtype=np.int32) - 1)[starts] if len(starts) else np.empty(0, np.int32)
    letters = raw[solid].tobytes().lower()
    bounds = np.append(ends, len(letters)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return pieces, np.searchsorted(starts, offsets)


class PieceIds:
    """Ids of pieces already encoded. Two generations: what is not used for long is dropped.

    A piece of small Latin letters is one word to the tokenizer, already normalised, so it goes
    straight to the tokenizer's model; all other pieces go through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.path, self.young, self.old = path, {}, {}

    def of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces, as little-endian 32-bit integers."""
        if len(self.young) > KEPT_PIECES:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, pieces))
        new = [piece for piece, ids in zip(pieces, found) if ids is None]
        whole, tokenize = [], tokenizer(self.path).model.tokenize
        for piece in new:
            if piece in self.old:
                self.young[piece] = self.old[piece]
            elif SMALL_LETTERS.fullmatch(piece):
                tokens = tokenize(piece.decode("latin-1").translate(LETTERS))
                self.young[piece] = array("I", [t.id for t in tokens]).tobytes()
            else:
                whole.append(piece)
        encoded = tokenizer(self.path).encode_batch([p.decode() for p in whole], add_special_tokens=False)
        self.young.update((p, array("I", e.ids).tobytes()) for p, e in zip(whole, encoded))
        return list(map(self.young.__getitem__, pieces)) if new else found


def by_pieces(path: str) -> bool:
    """Whether the file describes the kind of tokenizer for which pieces may be encoded alone."""
    if path not in _by_pieces:
        made = json.loads(tokenizer(path).to_str())
        steps = [made["normalizer"] or {}, made["pre_tokenizer"] or {}]
        kinds = [[s["type"] for s in step.get("normalizers", step.get("pretokenizers", []))] for step in steps]
        _by_pieces[path] = (
            kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]
            and steps[0]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and steps[1]["pretokenizers"][0]["pattern"] == {"Regex": WORDS_OF_TOKENIZER}
            and not steps[1]["pretokenizers"][1]["add_prefix_space"]
            and made["post_processor"] is None
            and all(t["content"].startswith(SPECIAL.decode()) for t in made["added_tokens"])
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in made["added_tokens"])
        )
    return _by_pieces[path]


def encode_whole(texts: list[bytes], path: str, end_id: int) -> list[np.ndarray]:
    encoded = tokenizer(path).encode_batch([t.decode() for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, end_id], "<u4") for e in encoded]


def encode_pieces(raw: np.ndarray, offsets: np.ndarray, path: str, end_id: int) -> list[np.ndarray]:
    """Ids of each text by way of the ids of its distinct pieces."""
    pieces, first_piece = pieces_of(raw, offsets)
    coded = pieces.dictionary_encode()
    known = _pieces.setdefault(path, PieceIds(path)).of(coded.dictionary.to_pylist())
    lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
    which = coded.indices.to_numpy()
    counts = lengths[which]
    upto = np.concatenate(([0], np.cumsum(counts)))
    shift = (np.cumsum(lengths) - lengths)[which] - upto[:-1]
    ids = np.frombuffer(b"".join(known), "<u4")[np.repeat(shift, counts) + np.arange(upto[-1])]
    bounds = upto[first_piece]
    ids = np.insert(ids, bounds[1:], end_id)
    bounds += np.arange(len(bounds))
    return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def encode_texts(raw: np.ndarray, offsets: np.ndarray, path: str, end_id: int = END_ID) -> list[np.ndarray]:
    """Ids of each text and the end id, as unsigned 32-bit integers.

    Texts that may hold a special token are encoded whole.
    """
    made: list[np.ndarray] = []
    for i, j in row_chunks(offsets, PIECE_BYTES):
        part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        data, special = part.tobytes(), range(j - i)
        if by_pieces(path):
            made += encode_pieces(part, at, path, end_id)
            special = [k for k in special if data.find(SPECIAL, at[k], at[k + 1]) >= 0] if SPECIAL in data else []
        else:
            made += [None] * (j - i)
        for k, ids in zip(special, encode_whole([data[at[k] : at[k + 1]] for k in special], path, end_id)):
            made[i + k] = ids
    return made


def build(ids: np.ndarray) -> tuple[list[tuple[np.ndarray, list[bytes]]], int, int]:
    """Planes of a wavelet matrix, each as (ones before each block, compressed blocks)."""
    width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    now, planes = ids.astype(np.uint16 if width <= 16 else np.uint32), []
    for bit in range(width - 1, -1, -1):
        one = (now & now.dtype.type(1 << bit)) != 0
        counts = np.add.reduceat(one, np.arange(0, len(one), BLOCK_BITS), dtype=np.int64) if len(one) else []
        before, packed = np.cumsum([0, *counts]), np.packbits(one).tobytes()
        blocks = [zlib.compress(packed[i : i + BLOCK_BITS // 8], 1) for i in range(0, len(packed), BLOCK_BITS // 8)]
        planes.append((before.astype("<i8"), blocks))
        now = np.concatenate((now[~one], now[one]))
    return planes, width, len(ids)


def dump(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """The content of one file."""
    starts = np.cumsum([0, *map(len, ids)]).astype("<i8")
    planes, width, n = build(np.concatenate(ids) if ids else np.empty(0, np.uint32))
    nulls = [i for i, d in enumerate(doc_ids) if d is None]
    parts = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), starts.tobytes()]
    for before, blocks in planes:
        parts += [before.tobytes(), np.cumsum([0, *map(len, blocks)]).astype("<i8").tobytes(), b"".join(blocks)]
    at = np.cumsum([0, *map(len, parts)]).tolist()
    header = json.dumps({"tokens": n, "width": width, "documents": len(doc_ids), "nulls": nulls, "parts": at}).encode()
    return MAGIC + len(header).to_bytes(4, "little") + header + b"".join(parts)


class WaveletFile:
    """Reads one file; blocks are fetched as they are needed."""

    def __init__(self, stream):
        self.stream = stream
        if stream.read(4) != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        head = json.loads(stream.read(int.from_bytes(stream.read(4), "little")))
        self.base, self.at = stream.tell(), head["parts"]
        self.tokens, self.width, n = head["tokens"], head["width"], head["documents"]
        ids = self.array(0)
        self.doc_ids: list[int | None] = ids.tolist()
        for i in head["nulls"]:
            self.doc_ids[i] = None
        self.starts = self.array(1)
        self.before = [self.array(2 + 3 * p) for p in range(self.width)]
        self.offsets = [self.array(3 + 3 * p) for p in range(self.width)]
        self.zeros = [self.tokens - int(b[-1]) for b in self.before]
        self.kept: dict[tuple[int, int], np.ndarray] = {}

    def read(self, start: int, n: int) -> bytes:
        self.stream.seek(self.base + start)
        return self.stream.read(n)

    def array(self, part: int) -> np.ndarray:
        return np.frombuffer(self.read(self.at[part], self.at[part + 1] - self.at[part]), "<i8")

    def block(self, plane: int, k: int) -> np.ndarray:
        """Bits of one block."""
        if (plane, k) not in self.kept:
            if len(self.kept) > 256:
                self.kept.clear()
            a, b = int(self.offsets[plane][k]), int(self.offsets[plane][k + 1])
            packed = zlib.decompress(self.read(self.at[4 + 3 * plane] + a, b - a))
            bits = np.unpackbits(np.frombuffer(packed, np.uint8))
            self.kept[plane, k] = bits[: self.tokens - k * BLOCK_BITS]
        return self.kept[plane, k]

    def ones_before(self, plane: int, i: int) -> int:
        k, within = divmod(i, BLOCK_BITS)
        return int(self.before[plane][k]) + (int(self.block(plane, k)[:within].sum()) if within else 0)

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        token = 0
        for p in range(self.width):
            bit = int(self.block(p, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self.ones_before(p, i)
            token, i = token << 1 | bit, self.zeros[p] + ones if bit else i - ones
        return token

    def range_of(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences of a token before position i lie below the last plane."""
        low, high = 0, i
        for p in range(self.width):
            a, b = self.ones_before(p, low), self.ones_before(p, high)
            if token >> (self.width - 1 - p) & 1:
                low, high = self.zeros[p] + a, self.zeros[p] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, i: int) -> int:
        """How often a token occurs before position i."""
        if token >> self.width or not self.tokens:
            return 0
        low, high = self.range_of(token, min(i, self.tokens))
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.tokens)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of a token."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self.range_of(token, 0)[0] + k
        for p in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - p) & 1
            i = self.find(p, bit, i - self.zeros[p] if bit else i)
        return i

    def find(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th bit of a value in a plane: the block by its directory, then within."""
        ones = self.before[plane]
        size = np.minimum(np.arange(len(ones)) * BLOCK_BITS, self.tokens)
        counts = ones if bit else size - ones
        block = int(np.searchsorted(counts, k, "right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self.block(plane, block) == bit)[k - int(counts[block])])

    def all_ids(self) -> np.ndarray:
        """All ids in order: the planes' stable partitions are undone from the last to the first."""
        ids = np.zeros(self.tokens, np.uint32)
        for p in range(self.width - 1, -1, -1):
            blocks = [self.block(p, k) for k in range(len(self.before[p]) - 1)]
            one = np.concatenate(blocks).astype(bool) if blocks else np.empty(0, bool)
            back = np.empty_like(ids)
            back[~one] = ids[: self.zeros[p]]
            back[one] = ids[self.zeros[p] :] | np.uint32(1 << (self.width - 1 - p))
            ids = back
        return ids


def larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows in tables of about PIECE_BYTES, so that fewer pieces are looked up repeatedly."""
    kept, size = [], 0
    for batch in batches:
        kept.append(batch)
        size += batch.nbytes
        if size >= PIECE_BYTES:
            yield pa.Table.from_batches(kept).combine_chunks()
            kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


MANIFEST = "file string, shard int, roll int, documents long, tokens long"


def shard_writer(path: str, vocabulary: str, end_id: int, file_tokens: int):
    """For mapInArrow: rows sorted by shard and id become files; one manifest row per file."""
    schema = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("roll", pa.int32()), ("documents", pa.int64()), ("tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, roll, docs, ids, n = None, 0, [], [], 0

        def close() -> pa.RecordBatch:
            name = f"shard-{at:06d}-{roll:06d}.wmx"
            write_file(f"{path}/{name}", [dump(docs, ids)])
            row = {"file": name, "shard": at, "roll": roll, "documents": len(docs), "tokens": n}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in larger(batches):
            made = encode_texts(*text_bytes(batch.column("text")), vocabulary, end_id)
            for shard, doc, one in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), made):
                if docs and (shard != at or n + len(one) > file_tokens):
                    yield close()
                    roll = roll + 1 if shard == at else 0
                    docs, ids, n = [], [], 0
                elif shard != at:
                    roll = 0
                at = shard
                docs.append(doc)
                ids.append(one)
                n += len(one)
        if docs:
            yield close()

    return write


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Encode doc_id and text of all rows into files below ``path``; the manifest."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, min(MOST_SHARDS, size // shard_bytes + 1))
    cuts: list[int] = []
    if count > 1:
        shares = [i / count for i in range(1, count)]
        cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 20 * count)).first()[0] or []))
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    shard = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda c: c < F.col("doc_id")))) + 1
    dealt = rows.withColumn("shard", shard.cast("int")).repartitionByRange(shuffle_partitions(spark), "shard")
    ordered = dealt.sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "text")
    manifest = ordered.mapInArrow(shard_writer(path, vocabulary, end_id, file_tokens), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


READ = "doc_id long, start long, n_tokens long, ids_crc32 long, file string"


def file_reader(path: str):
    """For mapInArrow: each listed file is decoded whole; one row per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("file", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                with open_file(f"{path}/{name}") as stream:
                    file = WaveletFile(stream)
                    ids = file.all_ids().astype("<u4")
                starts = file.starts
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                columns = [file.doc_ids, starts[:-1] + first, np.diff(starts), crc, [name] * len(crc)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return read


def read_tokens(manifest: DataFrame, path: str) -> DataFrame:
    """Position, number and checksum of the ids of each document, from the files."""
    spark = manifest.sparkSession
    # one row per file of millions of ids
    files = manifest.select("file", "tokens").orderBy("file").collect()
    firsts = np.cumsum([0, *(f.tokens for f in files)]).tolist()
    listed = spark.createDataFrame([(f.file, n) for f, n in zip(files, firsts)], "file string, first long")
    listed = listed.repartition(shuffle_partitions(spark), "file")
    return listed.mapInArrow(file_reader(path), READ)
