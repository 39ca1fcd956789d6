"""Top-k search, curriculum mixing and the pipeline."""

import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bayline.llm import curriculum, topk

VECTORS = "vec_id long, embedding array<float>, score long"


def test_top_k_matches_all_pairs(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(9)], 0) for i in range(300)]
    rows += [(300 + i, rows[i][1], 0) for i in range(60)]
    rows += [(500, None, 0), (501, [1.0, None], 0), (502, [math.nan], 0), (503, [math.inf], 0), (504, [], 0), (505, [3.0], 0), (None, [1.0], 0), (506, [2.0**21], 0), (507, [-(2.0**30), 0.5], 0), (550, [2.0**10, -1.0], 0)]
    table = spark.createDataFrame(rows, VECTORS)
    known = {r.vec_id: [math.floor(1024 * x) for x in r.embedding] for r in table.collect() if r.vec_id is not None and r.vec_id not in (500, 501, 502, 503)}
    wanted = []
    for q in sorted(i for i in known if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(known[q], v)), i) for i, v in known.items() if i != q)
        wanted += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:7], 1)]
    got = topk.top_k(table, table.filter("vec_id % 50 = 0"), 7, block=64, query_block=3)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == wanted
    few = table.filter("vec_id < 3")
    assert topk.top_k(few, few, 10).count() == 6
    assert topk.top_k(table.limit(0), table, 3).count() == topk.top_k(table, table.limit(0), 3).count() == 0


def test_an_index_answers_later_queries(spark):
    rng = random.Random(21)
    rows = [(i, [rng.uniform(-3, 3) for _ in range(rng.choice([4, 5]))]) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = topk.Index(table, block=50)
    assert index.blocks.agg(F.sum("n")).first()[0] == 400
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    for seed in (1, 2):
        asked = [(1000 + i, [random.Random(seed * 100 + i).uniform(-3, 3) for _ in range(6)]) for i in range(5)]
        got = index.top_k(spark.createDataFrame(asked, "vec_id long, embedding array<double>"), 4, query_block=2).collect()
        wanted = []
        for q, v in asked:
            v = [math.floor(1024 * x) for x in v]
            best = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in whole.items())[:4]
            wanted += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
        assert sorted(map(tuple, got)) == wanted
    few = topk.Index(table.limit(3), block=1)  # some blocks are empty
    assert few.top_k(table.limit(3), 10).count() == 6


def test_scores_that_leave_64_bits_are_refused(spark):
    def best(*rows):
        table = spark.createDataFrame([(i, list(x)) for i, x in enumerate(rows)], "vec_id long, embedding array<double>")
        return [tuple(r) for r in topk.top_k(table, table.filter("vec_id = 0"), 1).collect()]

    wide = 2.0**52
    assert best((1 / 1024, 0.0), (wide, 0.0), (-wide, 1.0)) == [(0, 1, 1, 1 << 62)]
    assert best((0.0, 1.0), (wide, -1.0), (-wide, -2.0)) == [(0, 1, 1, -(1 << 20))]
    with pytest.raises(Exception, match="leaves 64 bits"):
        best((2.0, 0.0), (wide, 0.0))
    with pytest.raises(Exception, match="leaves 64 bits"):
        best((1.0, 0.0), (1e30, 0.0))


def test_targets_and_copies(spark):
    rng = random.Random(9)
    rows = [(i, f"s{i % 2}" if i % 3 else "big", rng.randrange(1, 50)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, taken long").withColumnRenamed("taken", "words")
    got = curriculum.allocate(docs, F.col("words")).collect()
    sizes = {r.source: r.source_size for r in got}
    weight = dict(zip(sorted(sizes), (3, 1, 2)))
    targets, total = {}, 1.5 * sum(sizes.values())
    while True:  # round by round
        free = [s for s in sizes if s not in targets]
        level = (total - sum(targets.values())) / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not above:
            break
        targets.update((s, 2.0 * sizes[s]) for s in above)
    targets.update((s, level * weight[s]) for s in free)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert mine[0].target == pytest.approx(targets[s])
        assert abs(sum(r.taken for r in mine) - targets[s]) <= 25
    assert all(r.taken == r.copies * r.size <= 2 * r.size and len(r.positions) == r.copies for r in got)
    again = curriculum.allocate(docs.repartition(7), F.col("words")).collect()
    assert sorted((r.doc_id, r.taken, r.positions) for r in got) == sorted((r.doc_id, r.taken, r.positions) for r in again)


def test_positions_follow_the_schedule(spark):
    schedule = ((0.0, 0.0), (0.5, 2.0), (1.0, 0.0))
    shares = [i / 20 for i in range(21)]
    times = spark.createDataFrame([(s,) for s in shares], "s double").select(curriculum.inverse(schedule, F.col("s"))).collect()
    for share, (t,) in zip(shares, times):
        area = 2 * t * t if t <= 0.5 else 1 - 2 * (1 - t) ** 2
        assert area == pytest.approx(share, abs=1e-9)


def test_mix_of_odd_rows(odd, none):
    rows = curriculum.allocate(odd).collect()
    assert len(rows) == odd.count() and all(r.taken <= 2 * r.size for r in rows)
    assert {r.source_size for r in rows if r.source is None} == {0}
    assert curriculum.arranged(curriculum.allocate(odd)).count() == sum(r.copies for r in rows)
    assert curriculum.allocate(none).count() == 0


def test_hash_buckets_do_not_change_the_mix(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a', 'b') AS source", "id % 17 AS words")
    before = sorted(map(tuple, curriculum.allocate(docs, F.col("words")).select("doc_id", "taken", "positions").collect()))
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 100)
    after = sorted(map(tuple, curriculum.allocate(docs, F.col("words")).select("doc_id", "taken", "positions").collect()))
    assert before == after


def test_pipeline_stages_keep_columns_and_survive_odd_rows(spark, odd, none, tmp_path):
    docs = odd.select(*corpus_pipeline.COLUMNS)
    for name, kind in (("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        rows = [(1, 1), (4, 0)] if name == "labels" else [(1, "one two three four five six")]
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    for start in (docs, none.select(*corpus_pipeline.COLUMNS)):
        now = start
        for i, (name, function) in enumerate(corpus_pipeline.STAGES):
            now = function(spark, now, str(tmp_path))
            assert now.columns[:5] == corpus_pipeline.COLUMNS
            now.write.parquet(out := f"{tmp_path}/{start is docs}-{i}")
            now = spark.read.parquet(out)
        assert (now.count() > 0) == (start is docs)
