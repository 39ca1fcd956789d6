"""Plain Euclidean silhouette against all pairs of rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from bayline.operators import clustering, silhouette
from bayline.operators.silhouette import _distances, euclidean_silhouette


def plain(rows):
    """rows (label, vector) -> mean silhouette, by the definition."""
    scores = []
    for i, (label, x) in enumerate(rows):
        towards = {}
        for j, (other, y) in enumerate(rows):
            if i != j:
                towards.setdefault(other, []).append(math.dist(x, y))
        if label not in towards or len(towards) == 1:
            scores.append(0.0)
            continue
        a = sum(towards[label]) / len(towards[label])
        b = min(sum(d) / len(d) for other, d in towards.items() if other != label)
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return sum(scores) / len(scores)


def frame(spark, rows):
    return spark.createDataFrame(rows, "label string, x array<double>").repartition(5)


@pytest.mark.parametrize("tile", [1, 7, 64, 1024])
def test_all_pairs(spark, tile):
    rng = random.Random(tile)
    rows = [(c, [rng.gauss("abc".index(c) * 1.5, 1), rng.gauss(0, 1), 1e6 + rng.random()]) for c in rng.choices("abc", k=90)]
    rows += rows[:20] + [rows[0]] * 15 + [("single", [9.0, 9.0, 1e6])]  # repeated vectors and a cluster of one
    got = euclidean_silhouette(frame(spark, rows + [(None, [1.0, 1.0, 1.0]), ("a", None)]), "x", "label", tile=tile).first()
    assert (got.n, got.standard_error) == (len(rows), 0)
    assert got.silhouette_score == pytest.approx(plain(rows))


def test_edges(spark):
    same = [("a", [1.0])] * 5 + [("b", [1.0])] * 5
    assert euclidean_silhouette(frame(spark, same), "x", "label").first().silhouette_score == 0
    one = [("a", [float(i)]) for i in range(5)]
    assert euclidean_silhouette(frame(spark, one), "x", "label").first().silhouette_score == plain(one) == 0
    assert tuple(euclidean_silhouette(frame(spark, []), "x", "label").first()) == (0, None, None)


def test_a_sample_is_within_its_standard_error(spark):
    rng = random.Random(8)
    rows = [(c, [rng.gauss(2 * "ab".index(c), 1), rng.gauss(0, 1)]) for c in rng.choices("ab", k=600)]
    exact = plain(rows)
    got = euclidean_silhouette(frame(spark, rows), "x", "label", sample=0.3, tile=50).first()
    again = euclidean_silhouette(frame(spark, rows).repartition(3), "x", "label", sample=0.3, tile=64).first()
    assert 0 < got.standard_error < 0.05 and abs(got.silhouette_score - exact) < 5 * got.standard_error
    assert got.silhouette_score == pytest.approx(again.silhouette_score)
    whole = euclidean_silhouette(frame(spark, rows), "x", "label", sample=1.0).first()
    assert whole.silhouette_score == pytest.approx(exact) and whole.standard_error == 0


def test_no_pairs_are_written(spark):
    rows = [("ab"[i % 2], [float(i)]) for i in range(200)]
    plan = euclidean_silhouette(frame(spark, rows), "x", "label", tile=20)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Join" not in plan


def test_search_by_either_distance(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(10 * (i % 3), 0.5), rng.gauss(10 * (i % 2), 0.5)) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    found = clustering.k_search(df, "k", ["x", "y"], [2, 6], restarts=2, distance="euclidean").collect()
    assert [r.k for r in found if r.best] == [6] and all(-1 <= r.silhouette_score <= 1 for r in found)
    with pytest.raises(ValueError):
        clustering.k_search(df, "k", ["x", "y"], [2], restarts=1, distance="cosine")


def test_distances_by_product_keep_the_digits_of_near_rows():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(40, 3)) + 1e6
    b = np.concatenate([a[:9] + 1e-5 * rng.normal(size=(9, 3)), a[:4], rng.normal(size=(20, 3)) * 50 + 1e6, [[1e9, 0, -1e9]]])
    plain_distances = np.array([[math.dist(x, y) for y in b] for x in a])
    assert _distances(a, b) == pytest.approx(plain_distances, rel=1e-8, abs=0)
    for odd in (np.nan, np.inf, 1e200):
        b[3, 1] = odd
        with np.errstate(over="ignore"):
            direct = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
        np.testing.assert_allclose(_distances(a, b), direct, rtol=1e-8)


@pytest.mark.parametrize("share", [1.0, 0.3])
def test_two_groups_meet_once(monkeypatch, share):
    """Each distance of two wholly evaluated groups is worked out once and serves both."""
    rng, met = random.Random(3), []
    monkeypatch.setattr(silhouette, "_distances", lambda a, b: met.append(len(a) * len(b)) or _distances(a, b))
    groups = [[(rng.choice([0, 1]), rng.randint(1, 3), rng.random() < share, [rng.random(), rng.random()]) for _ in range(n)] for n in (30, 17)]
    members = [[dict(zip(("label", "weight", "chosen", "x"), m)) for m in g] for g in groups]
    kind = pa.list_(pa.struct([("label", pa.int32()), ("weight", pa.int64()), ("chosen", pa.bool_()), ("x", pa.list_(pa.float64()))]))
    rows = [(0, 0, True, members[0]), (1, 0, False, members[0]), (1, 1, False, members[1]), (3, 1, True, members[1])]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.bool_(), kind))]
    found = {}
    for batch in silhouette._summer(2, 8)([pa.RecordBatch.from_arrays(columns, names=["pair", "tile", "itself", "members"])]):
        for tile, sums in zip(*batch.to_pydict().values()):
            found[tile] = found.get(tile, 0) + np.frombuffer(sums).reshape(-1, 2)
    everyone = groups[0] + groups[1]
    for tile, g in enumerate(groups):
        expected = [[sum(w * math.dist(x, y) for other, w, _, y in everyone if other == c) for c in (0, 1)] for _, _, chosen, x in g if chosen]
        assert found[tile] == pytest.approx(np.array(expected))
    if share == 1.0:
        assert sum(met) == 30 * 30 + 30 * 17 + 17 * 17


def test_groups_of_bounded_size(spark, monkeypatch):
    rows = [("ab"[i % 2], [float(i)]) for i in range(600)]
    monkeypatch.setattr(silhouette, "GROUP_BYTES", 8 * 20)
    got = euclidean_silhouette(frame(spark, rows), "x", "label").first()
    assert got.n == 600 and got.silhouette_score == pytest.approx(plain(rows))


def test_no_row_of_a_shuffle_holds_a_whole_group(spark, monkeypatch):
    staged, stage = {}, silhouette.stage
    monkeypatch.setattr(silhouette, "stage", lambda df, purpose: staged.setdefault(purpose, stage(df, purpose)))
    rows = [("ab"[i % 2], [i / 7, float(i % 11)]) for i in range(3000)]
    got = euclidean_silhouette(frame(spark, rows), "x", "label", tile=25).first()
    held = [len(r.members) for df in staged.values() if "members" in df.columns for r in df.collect()]
    assert sum(held) == 3000 and max(held) <= 60
    x, own = np.array([v for _, v in rows]), np.array([c for c, _ in rows])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    a, b = ((d * (own[:, None] == own if same else own[:, None] != own)).sum(axis=1) / (1499 if same else 1500) for same in (True, False))
    assert got.silhouette_score == pytest.approx(((b - a) / np.maximum(a, b)).mean())


def test_a_far_row_leaves_the_others_to_the_product(monkeypatch):
    rng, differences, squared = np.random.default_rng(6), [], silhouette._squared
    monkeypatch.setattr(silhouette, "_squared", lambda a, b: differences.append(squared(a, b)) or differences[-1])
    a, b = rng.normal(size=(80, 4)), rng.normal(size=(70, 4))
    b[3] = 1e12
    expected = np.array([[math.dist(x, y) for y in b] for x in a])
    assert _distances(a, b) == pytest.approx(expected, rel=1e-8, abs=0)
    assert sum(d.size for d in differences) == 0
    b[5, 1] = np.nan
    assert np.isnan(_distances(a, b)).sum() == 80
    assert sum(d.size for d in differences) == 80


@pytest.mark.parametrize("share", [1.0, 0.4, 0.0])
def test_groups_of_several_tiles(share):
    rng = random.Random(share)
    tiles = [[(rng.choice([0, 1, 2]), rng.randint(1, 3), rng.random() < share, [rng.random() for _ in range(3)]) for _ in range(n)] for n in (9, 4, 1, 12, 7)]
    members = [[dict(zip(("label", "weight", "chosen", "x"), m)) for m in g] for g in tiles]
    kind = pa.list_(pa.struct([("label", pa.int32()), ("weight", pa.int64()), ("chosen", pa.bool_()), ("x", pa.list_(pa.float32()))]))
    numbers = [0, 1, 2, 3, 5]  # groups of two; the tile numbered 4 has no rows
    pairs = {(g, h): [i for i, n in enumerate(numbers) if n // 2 in (g, h)] for g in range(3) for h in range(g, 3)}
    rows = [(g * 3 + h, numbers[i], g == h, members[i]) for (g, h), those in pairs.items() for i in those]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.bool_(), kind))]
    whole = pa.RecordBatch.from_arrays(columns, names=["pair", "tile", "itself", "members"])
    found = {}
    for batch in silhouette._summer(3, 4, 2)([whole.slice(0, 3), whole.slice(3, 4), whole.slice(7)]):
        for tile, sums in zip(*batch.to_pydict().values()):
            found[tile] = found.get(tile, 0) + np.frombuffer(sums).reshape(-1, 3)
    everyone = [m for g in tiles for m in g]
    for n, g in zip(numbers, tiles):
        expected = [[sum(w * math.dist(x, y) for other, w, _, y in everyone if other == c) for c in range(3)] for _, _, chosen, x in g if chosen]
        assert (n in found) == bool(expected)
        if expected:
            assert found[n] == pytest.approx(np.array(expected), rel=1e-5)


def test_vectors_keep_their_width(spark):
    """Single-precision vectors are moved as such, and give what they give in double precision."""
    rng = random.Random(12)
    rows = [(c, [rng.gauss("ab".index(c), 1), None if i == 7 else -0.0, rng.random()]) for i, c in enumerate(rng.choices("ab", k=300))]
    single = frame(spark, rows).selectExpr("label", "cast(x as array<float>) as x")
    double = single.selectExpr("label", "cast(x as array<double>) as x")
    for sample in (None, 0.4):
        a, b = (euclidean_silhouette(df, "x", "label", sample, tile=100).first() for df in (single, double))
        assert a.silhouette_score == pytest.approx(b.silhouette_score) and a.standard_error == pytest.approx(b.standard_error)
