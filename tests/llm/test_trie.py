"""Prefix trie of rebuilt conversations against a plain trie of whole sequences."""

import hashlib
import random
import zlib

import numpy as np

from bayline.llm import common, products, trie

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    """rows (conv_id, turn, role, text) -> set of the columns of ``trie.trie``, by the definition."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=lambda t: (t[0], hashlib.sha256(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).digest()))] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = set()
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if built[c] == path)))
        out.add((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(len(p) == len(path) + 1 for p in below), leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def random_turns(rng, conversations):
    rows = []
    for c in conversations:
        length = rng.choice([1, 2, 3, 5, 9])
        rows += [(c, t, rng.choice(["user", "assistant"]) if t % 3 else "user", rng.choice(["a", "bb", "ccc"])) for t in range(length)]
    rng.shuffle(rows)
    return rows


def found(spark, rows):
    got = [tuple(r) for r in trie.trie(spark.createDataFrame(rows, TURNS)).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_nodes_match_a_plain_trie(spark):
    rng = random.Random(2)
    rows = random_turns(rng, [*range(0, 60), *range(101, 190), 300, 305, 5_000_000_017])  # base 100 is absent
    rows += [(305, 40 + t, "user", f"turn {t % 4}") for t in range(120)]  # a long one, over several ranges
    assert found(spark, rows) == plain_trie(rows)


def test_nodes_of_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 0, "user", "ties"), (1, 0, "user", "come"),
        (None, 0, "user", "of nobody"), (2, 3, "", ""), (3, 3, "us", "er"), (4, 3, "user", ""), (5, 1, "user", "é" * 40_000),
        (-7, 0, "user", "below"), (-7, 1, "user", "zero"), (0, 0, "user", "base"), (0, 1, "assistant", "head"),
    ]
    rows += [(c, 0, "user", "one turn each") for c in range(7, 60)]  # turnless where the head is longer
    assert found(spark, rows) == plain_trie(rows)
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS + ", place long, depth long")
    assert {tuple(r) for r in trie.trie(turns).collect()} == plain_trie(rows)
    assert found(spark, [r for r in rows if r[0] == 5]) == plain_trie([r for r in rows if r[0] == 5])
    assert trie.trie(turns.limit(0)).count() == 0


def test_equal_fingerprints_of_other_turns_are_noticed(spark, monkeypatch):
    rows = [(c, t, "user", text) for c, texts in ((900, "ab"), (901, "ba"), (902, "ab")) for t, text in enumerate(texts * 6)]
    usual, asked = trie.bases, []

    def bases(salt):
        asked.append(salt)
        return usual(salt) if salt else (1, 1)  # base one forgets the order

    monkeypatch.setattr(trie, "bases", bases)
    assert found(spark, rows) == plain_trie(rows)
    assert asked == [0, 1]


def test_products_are_those_of_whole_sequences():
    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, products.P, 300, dtype=np.uint64) for _ in range(2))
    a[:2], b[:2] = products.P - 1, [products.P - 1, 1]
    assert products.times(a, b).tolist() == [int(x) * int(y) % products.P for x, y in zip(a, b)]
    assert products.running(a).tolist() == [sum(map(int, a[: i + 1])) % products.P for i in range(300)]
    exponents = np.array([-5, -1, 0, 1, 2, 1000, 123_456_789])
    assert products.powers(987_654_321, exponents).tolist() == [pow(987_654_321, int(e), products.P) for e in exponents]


def test_products_go_on_over_ranges(spark):
    rng = random.Random(9)
    data = [(c, t, rng.randrange(1 << 60)) for c, n in ((1, 3), (2, 4000), (3, 1), (4, 700)) for t in range(n)]
    wanted = {}
    for base in (31, 1):
        for c, t, v in data:
            wanted[c, t, base] = (0 if t == 0 else wanted[c, t - 1, base][1], ((0 if t == 0 else wanted[c, t - 1, base][1]) + v * pow(base, t, products.P)) % products.P)
    rows = common.prepare(spark).createDataFrame(rng.sample(data, len(data)), "id long, t long, v long").selectExpr("*", "v AS w").repartition(5)
    got = products.prefix_products(rows, "id", ["t"], [("v", 31), ("w", 1)], ["t"]).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.place == r.t and (r.v_before, r.v_through) == wanted[r.id, r.t, 31] and (r.w_before, r.w_through) == wanted[r.id, r.t, 1]
