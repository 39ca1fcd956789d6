"""Repair of conversations against a plain search over all edits."""

import hashlib
import heapq
import random
import zlib

import pytest

from bayline.llm import repair

TURNS = "conv_id long, turn long, role string, text string"


def plain_repair(rows):
    """rows (turn, role, text) in order -> the columns of ``repair.summary``, by the definition."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    def step(last, role):
        """What a role may follow; the empty string is the start."""
        return {"s": last == "", "u": last != "u", "a": last == "u"}.get(role[:1], False)

    # least (cost, audit) first, so the first whole repair is the wanted one
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            break
        if (i, last) in done:
            continue
        done.add((i, last))
        for other in ("user", "assistant"):
            if step(last, other):
                heapq.heappush(heap, (cost + 5, audit + "I", i, other[0], (*lines, f"{other}:")))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, lines))
        if faults[i] not in ("blank", "duplicate"):
            more = cost + 5 * (faults[i] == "truncated")
            for letter, price, new in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                if step(last, new):
                    heapq.heappush(heap, (more + price, audit + letter, i + 1, new[0], (*lines, f"{new}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def summary(spark, turns, repaired):
    rows = repair.summary(turns.select("conv_id"), repair.Repair(repaired)).collect()
    return {r.conv_id: tuple(r)[1:] for r in rows}


def random_rows(rng, n):
    texts = ["Yes.", "No!", "cut", "so", "", " \t", "Why? ", "Go.\n", "A", "B."]
    roles = ["user", "assistant", "system", "tool", "", "sage"]
    return [(t, rng.choice(roles[: rng.choice([2, 3, 6])]), rng.choice(texts) + rng.choice(["", str(rng.random()) + ".", "x"])) for t in range(n)]


def test_repair_is_the_cheapest_and_least(spark, monkeypatch):
    rng = random.Random(5)
    convs = {c: random_rows(rng, rng.randrange(1, 11)) for c in range(250)}
    for rows in convs.values():  # gaps in the turns
        rows[:] = [r for r in rows if rng.random() < 0.9] or rows
    data = [(c, *r) for c, rows in convs.items() for r in rows]
    rng.shuffle(data)
    turns = spark.createDataFrame(data, TURNS)
    wanted = {c: plain_repair(rows) for c, rows in convs.items()}
    assert summary(spark, turns, turns) == wanted
    monkeypatch.setattr(repair, "PIECE_BITS", 2)  # conversations over several pieces
    assert summary(spark, turns, turns) == wanted


def test_long_runs_are_like_single_rows(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(repair, "UNROLL", 7)
    for _ in range(60):
        runs = [(rng.randrange(9), rng.choice([1, 2, 3, 8, 40])) for _ in range(rng.randrange(1, 6))]
        single = [s for s, n in runs for _ in range(n)]
        assert repair.cheapest(*zip(*runs)) == repair.cheapest(single, [1] * len(single))
    cost, audit = repair.cheapest([3], [100_000])  # users only: every second one is renamed
    assert (cost, audit) == (50_000, "KR" * 50_000)


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in (0, 1, None)] + [(None, None, None, None)]
    wanted = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role or " ", ["", "One Two"][kind - 1] if kind in (1, 2) else text or " ")
        wanted += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = [tuple(r) for r in repair.damaged(spark.createDataFrame(rows, TURNS)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert {len(wanted) - len(rows)} != {0}


def test_repair_of_odd_rows(spark):
    long_text = "word " * 50_000 + "end."
    rows = [
        (1, 0, "user", long_text), (1, 1, "assistant", "Fine."),
        (2, None, "user", "Hi."), (2, None, "user", "Hi."), (2, 5, "assistant", "Yes."),  # nulls first, repeated rows
        (3, 1, None, "Hello."), (3, 2, "user", None), (3, 3, None, None),
        (None, 1, "user", "Is it?"), (None, 2, "assistant", "Ünïcode."),
        (4, 1, "", ""),
    ]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS + ", piece string, at int")
    plain = {}
    for conv, turn, role, text in rows:
        plain.setdefault(conv, []).append((turn, role or (" " if role is None else ""), text or (" " if text is None else "")))
    got = summary(spark, turns, turns)
    assert got == {c: plain_repair(r) for c, r in plain.items()}
    assert got[2][:7] == (0, 0, 1, 0, 1, 2, "KDK") and got[4][6] == "D" and got[1][6] == "KK"
    assert summary(spark, turns.limit(0), turns.limit(0)) == {}
    assert summary(spark, turns, turns.filter("conv_id = 1"))[3] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_ties_of_turn_do_not_depend_on_the_given_order(spark):
    rows = [(1, 1, r, t) for r in ("user", "assistant") for t in ("a.", "b.", "c")] * 3
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        turns = spark.createDataFrame(rows, TURNS)
        found.add(summary(spark, turns, turns)[1])
    assert len(found) == 1


@pytest.mark.parametrize("edit", ["K", "R", "I"])
def test_repaired_rows_carry_texts(spark, edit):
    rows = {"K": [(1, 0, "user", "Q?"), (1, 1, "assistant", "A.")], "R": [(1, 0, "user", "Q?"), (1, 1, "user", "A.")], "I": [(1, 0, "system", "S.")] * 1}
    turns = spark.createDataFrame(rows[edit], TURNS)
    out = [tuple(r) for r in repair.Repair(turns).rows().collect()]
    wanted = {
        "K": [(1, 0, "K", "user", "Q?"), (1, 1, "K", "assistant", "A.")],
        "R": [(1, 0, "K", "user", "Q?"), (1, 1, "R", "assistant", "A.")],
        "I": [],
    }
    assert out == wanted[edit]
