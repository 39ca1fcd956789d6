"""The registered queries' own columns, and what each stage of the pipeline keeps, against plain Python."""

import math
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from bayline.llm import toxicity
from tests.llm.test_text_operators import least_members, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def run(spark, name):
    rows = entry.queries()[name](spark, SF_DIR).collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_op2_columns(spark, documents):
    rows = run(spark, "op2_toxicity_scores")
    assert set(rows) == set(documents)
    for i, r in rows.items():
        assert r.held_out == (remainder(i, 3) == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_op2_learns_nothing_from_held_out_rows(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    from bayline.llm.queries import remainder as learnt

    one, two = (toxicity.fit(docs, table, learnt(3) != 1) for table in (labels, flipped))
    assert (one.weights == two.weights).all() and one.intercept == two.intercept
    assert (one.weights != 0).sum() <= toxicity.FEATURES


def test_op4_columns(spark, documents):
    rows = run(spark, "op4_kneser_ney_scores")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*WORD.findall((d.text or "").translate(lower)), None] for i, d in documents.items()}
    counts = Counter(w for i, t in tokens.items() if remainder(i, 7) != 2 for w in t)
    total, distinct = sum(counts.values()), len(counts)
    assert set(rows) == set(documents)
    for i, r in rows.items():
        assert r.held_out == (remainder(i, 7) == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[i]), sum(w in counts for w in tokens[i]), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens[i]))
        assert r.score < 0


def test_op5_columns(spark, documents):
    rows = run(spark, "op5_hilbert_shards")
    assert set(rows) == set(documents)
    for i, r in rows.items():
        raw = (documents[i].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    shards = Counter(r.shard for r in rows.values())
    assert set(shards) == set(range(24)) and max(shards.values()) - min(shards.values()) <= 1
    order = sorted(rows, key=lambda i: (rows[i].shard, rows[i].slot))
    assert [rows[i].slot for i in order] == [s for shard in range(24) for s in range(shards[shard])]
    texts = [documents[i].text for i in order]
    parts = sum(a != b for a, b in zip(texts, texts[1:])) + 1
    assert parts == len(set(texts))  # equal texts lie side by side


def test_op6_columns(spark, documents):
    rows = run(spark, "op6_simhash_groups")
    fps = {i: plain_fingerprint(d.text) for i, d in documents.items()}
    assert {i: int(r.fingerprint, 16) for i, r in rows.items()} == fps
    assert {i: r.component_id for i, r in rows.items()} == least_members(list(fps), fps)


def word_list(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_what_each_stage_of_the_pipeline_keeps(spark, documents, tmp_path):
    now = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {}
    for name, function in corpus_pipeline.STAGES:
        function(spark, now, SF_DIR).write.parquet(out := f"{tmp_path}/{name}")
        now = spark.read.parquet(out)
        kept[name] = [r.doc_id for r in now.select("doc_id").collect()]

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    clean = [i for i, t in labels.items() if t == 0]
    assert len(set(kept["toxicity"]) & set(clean)) > 0.95 * len(clean)

    fps = {i: plain_fingerprint(documents[i].text) for i in kept["toxicity"]}
    assert sorted(kept["near_duplicates"]) == sorted(set(least_members(list(fps), fps).values()))

    items = [shingles(word_list(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert all(items)
    leaked = {i for i in kept["near_duplicates"] for s in [shingles(word_list(documents[i].text))] if any(5 * len(t & s) >= 4 * len(t) for t in items)}
    assert sorted(kept["decontamination"]) == sorted(set(kept["near_duplicates"]) - leaked) and leaked

    mixed = Counter(kept["mixing"])
    sizes = {i: len(WORD.findall(documents[i].text or "")) for i in kept["decontamination"]}
    assert set(mixed) <= set(sizes) and max(mixed.values()) <= 2
    taken = sum(n * sizes[i] for i, n in mixed.items())
    assert taken == pytest.approx(1.5 * sum(sizes.values()), rel=0.1)

    assert Counter(kept["sharding"]) == mixed
    counts = Counter(r.shard for r in now.collect())
    assert max(counts.values()) - min(counts.values()) <= 1
