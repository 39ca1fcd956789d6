"""WARC archives: a deterministic sharded writer and its reader.

Records are range-sorted by page id. The exact ranks of the ids cut the table into segments of
``segment_rows`` records, more if there would be over ``MOST_SEGMENTS``; one task writes a segment,
in which a new file begins once the compressed size would exceed ``file_bytes``. The cuts depend on
the ids alone, so another number of partitions, a retry or a second attempt gives the same files,
byte by byte. Records are compressed where pages are read, and move once. Each file is written under a temporary name
and renamed; the manifest, a table of file, records, bytes and checksum, is written last, and
readers take only what it lists.

Of records with equal payloads of at least ``revisit_bytes`` bytes the one with the smallest page
id is a response and holds the payload; the others are revisits that refer to it. All headers and
digests are made anew from the payload.

Defined results: a null html is an empty payload; a null url gives a record without a target; a
null page id is the largest one; records without page id are named by their payload's digest; rows that share the smallest
page id are all responses. Empty tables give an empty manifest. Control characters in urls are
percent-encoded.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.common import shuffle_partitions, stage, with_rank
from bayline.llm.files import open_file, write_file
from bayline.session import scratch_dir

SEGMENT_ROWS = 2048
MOST_SEGMENTS = 10_000
FILE_BYTES = 16 << 20
REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, segment long, roll int, records long, bytes long, sha256 string"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, file string, offset long"
)


def classified(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload (null for revisits), n_bytes, digest, first (null for responses)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n_bytes"), F.unhex(F.sha2(payload, 256)).alias("digest"),
    )
    firsts = (
        rows.filter(F.col("n_bytes") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    firsts = stage(firsts, "repeated-payloads")
    rows = rows.join(firsts, "digest", "left")
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.withColumn("first", F.when(repeats, F.col("first"))).withColumn("payload", F.when(~repeats, F.col("payload")))


def record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:page:none:{digest.hex()}>"


def record(page_id, url, payload, n_bytes, digest, first, date: str = DATE) -> bytes:
    """One gzip member with one record."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = head + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest.hex()}")
    lines.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    if first is not None:
        lines += [f"WARC-Refers-To: {record_id(first, digest)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)  # gzip without a time stamp
    return squeeze.compress(raw) + squeeze.flush()


def compressor(cuts: list[int]):
    """For mapInArrow: classified pages -> segment and gzip member of each record."""
    schema = pa.schema([("segment", pa.int64()), ("page_id", pa.int64()), ("digest", pa.binary()), ("url", pa.string()), ("member", pa.binary())])

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [batch.column(n) for n in ("page_id", "url", "payload", "n_bytes", "digest", "first")]
            made = pa.array([record(*(f[i].as_py() for f in fields)) for i in range(batch.num_rows)], pa.binary())
            page = fields[0].fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            segment = pa.array(np.searchsorted(np.array(cuts, np.int64), page, "right"), pa.int64())
            columns = [segment, fields[0], fields[4].cast(pa.binary()), fields[1].cast(pa.string()), made]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return compress


def segment_cuts(pages: DataFrame, segment_rows: int) -> list[int]:
    """First page id of every segment but the first; fewer than MOST_SEGMENTS."""
    ranked = with_rank(pages.select("page_id"), [F.col("page_id").asc_nulls_last()], "rank", rows_name="n")
    step = F.greatest(F.lit(segment_rows).cast("long"), F.ceil(F.col("n") / MOST_SEGMENTS))
    cuts = ranked.filter((F.col("rank") > 0) & (F.col("rank") % step == 0) & F.col("page_id").isNotNull())
    return sorted({r.page_id for r in cuts.collect()})


def segment_writer(path: str, file_bytes: int):
    """For mapInArrow: rows sorted by segment and rank become files; one manifest row per file."""
    schema = pa.schema([("file", pa.string()), ("segment", pa.int64()), ("roll", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, roll, members, size = None, 0, [], 0

        def close() -> pa.RecordBatch:
            name, digest = f"segment-{at:010d}-{roll:04d}.warc.gz", hashlib.sha256()
            for member in members:
                digest.update(member)
            write_file(f"{path}/{name}", members)
            row = {"file": name, "segment": at, "roll": roll, "records": len(members), "bytes": size, "sha256": digest.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for segment, member in zip(batch.column("segment").to_pylist(), batch.column("member").to_pylist()):
                if members and (segment != at or size + len(member) > file_bytes):
                    yield close()
                    roll = roll + 1 if segment == at else 0
                    members, size = [], 0
                elif segment != at:
                    roll = 0
                at = segment
                members.append(member)
                size += len(member)
        if members:
            yield close()

    return write


def write_archives(pages: DataFrame, path: str, segment_rows: int = SEGMENT_ROWS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all pages below ``path``; the manifest, which ``path/manifest`` holds as well."""
    spark = pages.sparkSession
    typed = pages.withColumn("page_id", F.col("page_id").cast("long"))
    made = classified(typed).mapInArrow(
        compressor(segment_cuts(typed, segment_rows)),
        "segment long, page_id long, digest binary, url string, member binary",
    )
    order = ["segment", F.col("page_id").asc_nulls_last(), "digest", "url"]
    dealt = made.repartition(shuffle_partitions(spark), "segment").sortWithinPartitions(*order)
    manifest = dealt.mapInArrow(segment_writer(path, file_bytes), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def members(stream, read_bytes: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member of a stream."""
    data, start = b"", 0
    more = stream.read(read_bytes)
    while more or data:
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not data:
                data, more = more, stream.read(read_bytes) if more else b""
                if not data:
                    raise ValueError("the archive ends within a record")
            parts.append(inflate.decompress(data))
            used += len(data) - len(inflate.unused_data)
            data = inflate.unused_data
        yield start, b"".join(parts)
        start += used


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"the block of {fields['WARC-Record-ID']} does not match its digest")
    return fields, block


def page_of(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def file_reader(path: str):
    """For mapInArrow: one row per record of the files that the manifest lists."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with open_file(f"{path}/{name}") as stream:
                    for offset, raw in members(stream):
                        fields, block = parsed(raw)
                        head, _, payload = block.partition(b"\r\n\r\n")
                        n, digest = int(re.search(rb"Content-Length: (\d+)", head)[1]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if fields["WARC-Type"] == "response":
                            if (len(payload), hashlib.sha256(payload).hexdigest()) != (n, digest):
                                raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not match its digest")
                        rows.append((page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), n, digest, fields["WARC-Type"], page_of(fields.get("WARC-Refers-To")), name, offset))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return read


def read_archives(manifest: DataFrame, path: str) -> DataFrame:
    """One row per record of all files of a manifest, digests checked."""
    files = manifest.select("file").repartition(shuffle_partitions(manifest.sparkSession), "file")
    return files.mapInArrow(file_reader(path), RECORD)


def scratch_archives(pages: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_dir(pages.sparkSession, "warc")
    return write_archives(pages, path), path
