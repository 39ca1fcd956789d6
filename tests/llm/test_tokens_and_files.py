"""Wavelet files, WARC archives and shards: round trips and defined results of odd rows."""

import hashlib
import io
import random
import zlib

import numpy as np
import pytest

from bayline.llm import hilbert, warc, wavelet

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_wavelet_file_answers_access_rank_and_select():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 300, 70_000).astype(np.uint32)
    file = wavelet.WaveletFile(io.BytesIO(wavelet.dump([1, None], [ids[:10], ids[10:]])))
    assert (file.all_ids() == ids).all() and file.doc_ids == [1, None]
    for token in (0, 7, 299, 5000):
        places = np.flatnonzero(ids == token)
        assert file.count(token) == len(places)
        assert file.rank(token, 40_000) == (places < 40_000).sum()
        for k in range(0, len(places), 50):
            assert file.select(token, k) == places[k]
    for i in (0, 32_767, 32_768, 69_999):
        assert file.access(i) == ids[i]
    with pytest.raises(IndexError):
        file.access(70_000)


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(2)
    texts = ["", "A.b, <|endoftext|> <|ENDOFTEXT|>", "x́, \x1c y\x85z İ ß"]
    texts += ["".join(rng.choice("abçéàùÿßÉ ,.'st\n<|>1") for _ in range(80)) for _ in range(300)]
    marks = [*"astmdTx ,-_=<>|\"05\t\x0b\x1c\u00a0é\u0338\u212aſİ中𝒜½~#$\x00\x7f", "'s", "'ll", "n't", "<|endoftext|>"]
    texts += ["".join(rng.choice(marks) for _ in range(rng.choice((1, 3, 40)))) for _ in range(500)]
    encoder = wavelet.tokenizer(PATH)
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    got = wavelet.encode_texts(np.frombuffer(b"".join(raw), np.uint8), offsets, PATH)
    assert [g.tolist() for g in got] == [encoder.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_tokens_of_odd_rows(spark, odd, none, tmp_path):
    manifest = wavelet.write_tokens(odd, str(tmp_path / "a"), PATH, file_tokens=50, shard_bytes=1000)
    got = sorted(tuple(r)[:4] for r in wavelet.read_tokens(manifest, str(tmp_path / "a")).collect() if r.doc_id is not None)
    encoder, at, wanted = wavelet.tokenizer(PATH), 0, []
    order = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    for r in order:
        ids = np.array(encoder.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        wanted.append((r.doc_id, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    assert got == sorted(w for w in wanted if w[0] is not None)
    empty = wavelet.write_tokens(none, str(tmp_path / "b"), PATH)
    assert wavelet.read_tokens(empty, str(tmp_path / "b")).count() == 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, rank long")


def test_archives_come_back_and_are_the_same_twice(spark, tmp_path):
    body = "<p>" + "x" * 200
    rows = [(5, "http://a/ b\r\n", body, 1), (3, None, body, 1), (9, "u", body + "é", 1), (9, "u", body + "é", 1),
            (1, "u", "short", 1), (2, "u", "short", 1), (4, "u", None, 1), (None, "u", body, 1)]
    manifest = warc.write_archives(pages(spark, rows), str(tmp_path / "a"), segment_rows=2, file_bytes=300)
    other = warc.write_archives(pages(spark, rows[::-1]).repartition(5), str(tmp_path / "b"), segment_rows=2, file_bytes=300)
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, other.collect()))
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.endswith(".tmp")]
    got = {}
    for r in warc.read_archives(manifest, str(tmp_path / "a")).collect():
        got.setdefault(r.page_id, []).append((r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))
    digest = hashlib.sha256(body.encode()).hexdigest()
    assert got[3] == [(203, digest, "response", None)]
    assert got[5] == got[None] == [(203, digest, "revisit", 3)]
    assert [x[2] for x in got[9]] == ["response", "response"]
    assert got[1][0][2] == got[2][0][2] == "response"
    assert got[4] == [(0, hashlib.sha256(b"").hexdigest(), "response", None)]
    empty = warc.write_archives(pages(spark, []), str(tmp_path / "c"))
    assert warc.read_archives(empty, str(tmp_path / "c")).count() == 0


def test_a_broken_archive_is_refused():
    member = warc.record(1, "u", b"payload", 7, hashlib.sha256(b"payload").digest(), None)
    (_, raw), = warc.members(io.BytesIO(member))
    warc.parsed(raw)
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"payload", b"pauload"))
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(member[:-9])))


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    code = np.arange(1 << (dims * bits))
    cells = np.stack([(code >> (bits * i)) & ((1 << bits) - 1) for i in range(dims)], axis=1)
    index = hilbert.curve_index(cells, bits)
    assert sorted(index) == code.tolist()
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards_are_even_gapless_and_prunable(spark, odd, none, tmp_path):
    rows = hilbert.shards(odd, 3, ["source", "lang", "n_chars"]).collect()
    assert len(rows) == odd.count()
    sizes = [sorted(r.slot for r in rows if r.shard == s) for s in range(3)]
    assert all(s == list(range(len(s))) for s in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert hilbert.shards(none, 3, ["source"]).count() == 0
    table = spark.range(2000).selectExpr("id AS doc_id", "'t' AS text", "id % 40 AS a", "concat('s', id DIV 100) AS b")
    sharded = hilbert.shards(table, 8, ["a", "b"])
    manifest = hilbert.write_shards(sharded, str(tmp_path), ["a", "b"])
    assert manifest.count() == 8
    near = manifest.filter("max_a >= 3 AND min_a <= 4").count()
    found = hilbert.read_shards(spark, str(tmp_path), {"a": (3, 4)})
    assert found.count() == 100 and near < 8


def plain_cells(values, bits=4):
    """Cell of each value: how many of the quantiles lie below it; None is in the lowest."""
    there = sorted(v for v in values if v is not None)
    cuts = sorted({there[max(1, -(-len(there) * i // (1 << bits))) - 1] for i in range(1, 1 << bits)})
    return [0 if v is None else sum(v > c for c in cuts) for v in values]


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_shards_follow_a_plain_sort(spark, monkeypatch, most):
    monkeypatch.setattr(hilbert, "BROADCAST_ROWS", most)  # groups broadcast, or joined by a shuffle
    rng = random.Random(12)
    texts = [f"text {rng.randrange(90)}" for _ in range(400)] + [None] * 5
    prefix = "https://host.example/a/long/common/prefix/"
    rows = [(i, t, rng.choice("abcde"), prefix + str(rng.randrange(30)), rng.choice([None, rng.randrange(500)])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long").repartition(6)
    got = hilbert.shards(df, 7, ["source", "lang", "n"]).collect()
    cells = [plain_cells([r[i] for r in rows]) for i in (3, 2, 4)]
    assert len(set(cells[0])) == 16  # a common prefix does not matter
    group = {}
    for i, r in enumerate(rows):
        group.setdefault(r[1], i)
    curve = hilbert.curve_index(np.array([[cells[d][group[r[1]]] for d in range(3)] for r in rows]), 4)
    crc = [zlib.crc32((r[1] or "").encode()) if r[1] is not None else 0 for r in rows]
    own = hilbert.curve_index(np.array(cells).T, 4)
    order = sorted(range(len(rows)), key=lambda i: (curve[i], crc[i], own[i], i))
    where = {r.doc_id: (r.shard, r.slot) for r in got}
    assert sorted(where, key=where.get) == order
    assert {r.doc_id: r.curve for r in got} == dict(enumerate(curve.tolist()))
    assert [where[i][0] for i in order] == [p * 7 // len(rows) for p in range(len(rows))]
