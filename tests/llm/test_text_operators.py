"""Toxicity, containment, language model, SimHash and repeated strings against plain loops."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bayline.llm import common, containment, kneser_ney, simhash, suffixes, toxicity


def documents(spark, texts, first=0):
    return spark.createDataFrame(list(enumerate(texts, first)), "doc_id long, text string")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_toxicity_learns_held_out_insults(spark):
    rng = random.Random(3)
    toxic = [rng.random() < 0.3 for _ in range(900)]
    texts = [words(rng, 60) + (f" you {rng.choice(['idiot', 'moron'])} {words(rng, 5)}" if t else "") for t in toxic]
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, texts), labels, F.col("doc_id") % 3 != 1)
    scores = {r.doc_id: r.score for r in toxicity.scored(documents(spark, texts), model).collect()}
    held = [i for i in scores if i % 3 == 1]
    assert sum((scores[i] >= toxicity.THRESHOLD) == toxic[i] for i in held) > 0.95 * len(held)


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (4, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels, F.lit(True))
    rows = toxicity.scored(odd.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    constant = toxicity.fit(odd, labels.filter("toxic = 0 AND doc_id = 4"), F.lit(True))
    assert toxicity.scored(odd, constant).first().score == pytest.approx(1 / 3)
    assert toxicity.scored(none, toxicity.fit(none, labels.limit(0), F.lit(True))).count() == 0


def test_items_are_found_exactly(spark, none):
    rng = random.Random(4)
    items = [words(rng, rng.randrange(20, 50), 10_000) for _ in range(20)] + ["two words", "", None, "w1 w2 w3 w4", "one", "w7 w8 w9 w10 w11"]
    texts = []
    for i in range(60):
        item = items[i % 20].split()
        for _ in range(i % 4):
            item[rng.randrange(len(item))] = "other"
        texts.append(f"{words(rng, rng.choice([3, 3000]))} {' '.join(item).upper()}. {words(rng, 30)}")
    texts += [None, "", "Two words!", "two words more"]

    texts += ["w0 w1 w2 w3 w4 w5", "w1 w2 w3", "one", f"{words(rng, 500, 10_000)} here are two words and one", "w7 w8 w9 w10 w11", "w1 w2 w4 w3"]

    def word_list(text):
        return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()

    def shingles(w, width):
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}

    wanted = set()
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            width = min(5, len(word_list(item)))
            s = shingles(word_list(item), width) if width else set()
            if s and len(s & shingles(word_list(text), width)) * 5 >= len(s) * 4:
                wanted.add((d, i))
    assert {20, 23, 24, 25} <= {i for _, i in wanted}
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("row", F.lit(1))
    docs = documents(spark, texts).withColumn("item_id", F.lit(7))
    got = containment.leaks(docs, table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == wanted and len(got) == len(wanted)
    kept = containment.decontaminated(docs, table)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in wanted}
    assert kept.columns == docs.columns
    assert containment.leaks(none, table).count() == containment.leaks(docs, table.limit(0)).count() == 0


def test_contained_in_odd_rows(spark, odd):
    items = odd.select(F.col("doc_id").alias("item_id"), "text")
    found = {(r.doc_id, r.item_id) for r in containment.leaks(odd, items).collect()}
    assert {(1, 1), (1, 2), (2, 1), (2, 2), (6, 6), (None, None)} <= found
    assert not any(3 in pair or 4 in pair or 5 in pair for pair in found)


def model_score(train, text):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in enumerate(train)}
    unigrams, pairs = Counter(), Counter()
    for t in tokens.values():
        unigrams.update(t)
        pairs.update(zip(["start", *t[:-1]], t))
    contexts = Counter(z for _, z in pairs)
    by_pair, by_context = Counter(pairs.values()), Counter(contexts.values())
    d2, d1 = (kneser_ney.discounts([c[i] for i in range(1, 5)]) for c in (by_pair, by_context))
    rest = defaultdict(float)
    heads = Counter()
    for (y, _), c in pairs.items():
        rest[y] += d2[min(c, 3)]
        heads[y] += c
    left = sum(d1[min(c, 3)] for c in contexts.values()) / len(pairs) / (len(unigrams) + 1)
    score, y = 0.0, "start"
    for z in [*(text or "").encode().lower().split(), None]:
        p = max(contexts[z] - d1[min(contexts[z], 3)], 0) / len(pairs) + left
        if heads[y]:
            p = max(pairs[y, z] - d2[min(pairs[y, z], 3)], 0) / heads[y] + rest[y] / heads[y] * p
        score, y = score + math.log10(p), z
    return score


def test_model_scores_match_plain_counting(spark, odd, none, monkeypatch):
    rng = random.Random(5)
    train = [words(rng, rng.randrange(0, 80), 60) for _ in range(80)] + ["A\x0bB a b", None, "", "x" * 5000]
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 2000)
    model = kneser_ney.train(documents(spark, train))
    assert model.counts.shards > 5
    asked = [*train[:20], "never seen w1 w2", None, " ", *train[-4:]]
    rows = kneser_ney.scored(documents(spark, asked).withColumn("score", F.lit("x")), model).collect()
    for r in rows:
        assert r.score == pytest.approx(model_score(train, asked[r.doc_id]), abs=1e-8)
    assert kneser_ney.scored(odd, model).count() == odd.count()
    nothing = kneser_ney.train(none)
    assert {r.score for r in kneser_ney.scored(odd, nothing).collect()} == {0.0}
    assert kneser_ney.scored(none, model).count() == 0


def trigram_score(train, text):
    def split(t):
        return ["start", *(t or "").encode().lower().split(), None]

    raw = {k: Counter(tuple(t[i : i + k]) for t in map(split, train) for i in range(len(t) - k + 1)) for k in (2, 3)}
    before = Counter(g[1:] for g in raw[3])
    counts = {3: raw[3], 2: {g: c if g[0] == "start" else before[g] for g, c in raw[2].items()}, 1: Counter(g[1:] for g in raw[2])}
    d = {k: kneser_ney.discounts([Counter(c.values())[i] for i in range(1, 5)]) for k, c in counts.items()}
    entries = defaultdict(list)
    for c in counts.values():
        for g, n in c.items():
            entries[g[:-1]].append(n)

    def p(gram):
        k, some = len(gram), entries.get(gram[:-1])
        if not k:
            return 1 / (len(counts[1]) + 1)
        if not some:
            return p(gram[1:])
        n, total = counts[k].get(gram, 0), sum(some)
        return max(n - d[k][min(n, 3)], 0) / total + sum(d[k][min(x, 3)] for x in some) / total * p(gram[1:])

    t = split(text)
    return sum(math.log10(p(tuple(t[max(0, i - 2) : i + 1]))) for i in range(1, len(t)))


def test_trigram_scores_match_plain_counting(spark, odd, none, monkeypatch):
    rng = random.Random(12)
    train = [words(rng, rng.randrange(0, 80), 12) for _ in range(90)] + ["w1 w2 w3 " * 400, "A\x0bB a b", None, ""]
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 1500)
    model = kneser_ney.train(documents(spark, train), order=3)
    assert model.counts.shards > 5
    asked = [*train[:20], "never seen w1 w2 w3 never w2", None, " ", *train[-4:]]
    rows = kneser_ney.scored(documents(spark, asked), model).collect()
    for r in rows:
        assert r.score == pytest.approx(trigram_score(train, asked[r.doc_id]), abs=1e-8)
    nothing = kneser_ney.train(none, order=3)
    assert {r.score for r in kneser_ney.scored(odd, nothing).collect()} == {0.0}


def test_long_texts_are_tokenised_in_parts(monkeypatch):
    text = " ".join(f"word{i}" for i in range(5000)).encode()
    raw, offsets = np.frombuffer(text, np.uint8), np.array([0, 9, 9, len(text)])
    whole = kneser_ney.tokens(raw, offsets)
    monkeypatch.setattr(kneser_ney, "PIECE_BYTES", 100)
    parts = kneser_ney.tokens(raw, offsets)
    assert all((a == b).all() for a, b in zip(whole, parts))


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_members(ids, fps):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_fingerprint_links_are_whole(spark):
    rng = random.Random(6)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    values = set(seeds) | {0, (1 << 64) - 1}
    for seed in seeds:
        value = seed
        for _ in range(12):
            for _ in range(rng.randrange(1, 5)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    fps = dict(enumerate(sorted(values)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps.values()]
    rows = spark.createDataFrame([(i, f[0]) for i, f in enumerate(signed)], "id long, fp long")
    wanted = least_members(list(fps), fps)
    assert {r.id: r.component_id for r in simhash.with_components(rows).collect()} == wanted
    tiled = simhash.fingerprint_links(rows.select("fp"), tile=2)
    whole = simhash.components(tiled).select("label").distinct().count()
    assert whole == len({w for i, w in wanted.items() if list(wanted.values()).count(w) > 1})


def test_groups_of_odd_rows(spark, odd, none):
    rows = simhash.grouped(odd).collect()
    assert all(int(r.fingerprint, 16) == plain_fingerprint(r.text) for r in rows)
    by_id = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by_id == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 6, 8: 8}
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 8]
    assert simhash.grouped(none).count() == simhash.near_dedup(none).count() == 0


def test_one_document_of_each_group_of_fingerprints_stays(spark):
    rng = random.Random(11)
    texts = [words(rng, rng.randrange(1, 12), 3) for _ in range(20)]
    for _ in range(40):
        base = words(rng, rng.randrange(5, 400), 10_000).split()
        for _ in range(rng.randrange(1, 5)):
            texts.append(" ".join(base))
            base[rng.randrange(len(base))] = "other"
    fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    least = least_members(list(fps), fps)
    assert len(texts) - len(set(least.values())) > len(texts) - len(set(texts))
    assert {r.doc_id for r in simhash.near_dedup(documents(spark, texts)).collect()} == set(least.values())


def plain_removal(texts):
    raw = [(t or "").encode() for t in texts]
    n = suffixes.LENGTH
    seen = Counter(b[p : p + n] for b in raw for p in range(len(b) - n + 1))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                mark[p : p + n] = b"\1" * n
        kept = bytes(c for c, m in zip(b, mark) if not m)
        out.append((len(b), sum(mark), len(bytes(mark).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("many,piece", [(5000, 1 << 19), (3, 700)])
def test_repeated_strings(spark, monkeypatch, many, piece):
    monkeypatch.setattr(suffixes, "MANY_CONTEXTS", many)
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rng = random.Random(7)
    shared = [words(rng, 70, 10_000) for _ in range(4)]
    texts = []
    for i in range(30):
        parts = [words(rng, 40, 10_000)]
        for _ in range(rng.randrange(3)):
            passage, cut = rng.choice(shared), rng.randrange(150)
            parts += [passage[cut : cut + rng.choice([199, 200, 201, 260])], words(rng, 30, 10_000)]
        texts.append(" ".join(parts))
    texts += [texts[0], "é" * 300, "a" * 900, "ab" * 300, "x" * 199, "", None]
    rows = suffixes.without_repeats(documents(spark, texts).withColumn("row", F.lit("x")), batches=3).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in rows}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts)


def test_repeated_strings_of_odd_rows(odd, none):
    rows = suffixes.without_repeats(odd).collect()
    assert sorted(r.n_bytes for r in rows) == sorted(len((r.text or "").encode()) for r in odd.collect())
    assert suffixes.without_repeats(none).count() == 0


def test_rows_are_cut_into_chunks():
    offsets = np.array([0, 5, 5, 30, 31, 32])
    assert list(common.row_chunks(offsets, 8)) == [(0, 2), (2, 3), (3, 5)]
    assert list(common.row_chunks(np.array([0]), 8)) == []
