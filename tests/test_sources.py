import datetime as dt

import pytest

from pyspark.sql import functions as F

from bayline import session
from bayline.plans.script import returns_rows, run_script, statements_of
from bayline.session import scratch_dir
from bayline.sources import sinks
from bayline.sources.contract import check_inputs
from bayline.sources.csv import load_csv, register_csv
from bayline.sources.schemas import PRIMARY_KEYS, RELATIONSHIPS, SCHEMAS
from bayline.sources.sinks import stage, write_marts, write_numbered, write_result

DDL = "k BIGINT, x DOUBLE, t TIMESTAMP_NTZ, s STRING"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, 0.1, dt.datetime(2024, 1, 1, 10, 0, 0, 123456), "a,b"),
            (2, None, None, 'say "hi"'),
            (None, 1e-300, dt.datetime(2024, 1, 2), None),
        ],
        DDL,
    )


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_csv_round_trip_keeps_microseconds_quotes_and_gaps(spark, rows, tmp_path):
    assert same(load_csv(spark, write_result(rows, f"{tmp_path}/a", "csv"), DDL), rows)


def test_malformed_rows_are_dropped_whatever_is_selected(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("k,x,s\n1,1.5,ok\n2,oops,ok\n3,,ok\n4,2.0,ok,extra\n")
    register_csv(spark, "checked", str(path), "k BIGINT, x DOUBLE, s STRING")
    kept = [r.k for r in spark.sql("SELECT k FROM checked ORDER BY k").collect()]
    assert kept in ([1, 3], [1, 3, 4]) and spark.table("checked").count() == len(kept)
    loose = load_csv(spark, str(path), "k BIGINT, x DOUBLE, s STRING").orderBy("k").collect()
    assert [r.x for r in loose][:3] == [1.5, None, None]


def test_contract(spark, rows):
    report = check_inputs(
        {"fits": rows, "empty": rows.limit(0), "bad": rows},
        {"fits": DDL, "empty": DDL, "bad": "k INT, z STRING"},
    )
    got = {r.table: (r.missing_columns, r.mistyped_columns, r.row_count, r.ok) for r in report.collect()}
    assert got == {"fits": ("", "", 3, True), "empty": ("", "", 0, False), "bad": ("z", "k", 3, False)}


def test_schemas_cover_keys_and_relationships(spark):
    columns = {name: spark.createDataFrame([], ddl).columns for name, ddl in SCHEMAS.items()}
    assert all(key in columns[table] for table, key in PRIMARY_KEYS.items())
    assert all(fk in columns[c] and pk in columns[p] for c, fk, p, pk in RELATIONSHIPS)


def test_numbered_results_and_marts(spark, rows, tmp_path):
    paths = write_numbered([rows, rows.limit(1)], str(tmp_path), "kpi")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["kpi_01", "kpi_02"]
    assert spark.read.parquet(paths[1]).count() == 1
    mart = rows.selectExpr("k", "year(t) AS y", "month(t) AS m")
    written = write_marts({"fact": mart, "dim": rows}, str(tmp_path), {"fact": ["y", "m"]})
    assert spark.read.parquet(written["fact"]).filter("y = 2024").count() == 2
    assert same(stage(rows, "unit"), rows)


def test_scratch_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and (named is None or one.startswith(named))


SCRIPT = """
-- first; with a semicolon
SELECT 'a;b' AS s;
CREATE OR REPLACE TEMPORARY VIEW v AS SELECT 1 AS x;
-- only a comment
;
with w as (select x from v) select x + 1 as y from w
"""


def test_script_statements():
    found = statements_of(SCRIPT)
    assert len(found) == 3 and [returns_rows(s) for s in found] == [True, False, True]


def test_comments_and_escapes_do_not_shift_quotes():
    text = """/* it's; */ SELECT 1; SELECT 'a\\'; b' AS s; SELECT "x;y" AS t /* ; */"""
    assert len(statements_of(text)) == 3 and all(map(returns_rows, statements_of(text)))


def test_csv_keeps_text_as_written(spark, tmp_path):
    texts = ["  padded  ", "two\nlines", 'say "x"', "back\\slash", "a,b", "\\", "end\\"]
    df = spark.createDataFrame([(i, t, float("nan")) for i, t in enumerate(texts)], "k INT, s STRING, x DOUBLE")
    path = write_result(df, str(tmp_path / "csv"), "csv")
    wanted = [(i, t, None) for i, t in enumerate(texts)]
    schema = "k INT, s STRING, x DOUBLE"
    assert sorted(map(tuple, load_csv(spark, path, schema).collect())) == wanted
    assert sorted(map(tuple, register_csv(spark, "kept_text", path, schema).collect())) == wanted


def test_script_runs_in_order_and_stops_at_an_error(spark, tmp_path):
    written = run_script(spark, SCRIPT, str(tmp_path), "r")
    assert list(written) == ["r_01", "r_02"]
    assert spark.read.parquet(written["r_01"]).first().s == "a;b"
    assert spark.read.parquet(written["r_02"]).first().y == 2
    with pytest.raises(Exception):
        run_script(spark, ["SELECT 1 AS a", "SELECT nothing FROM nowhere", "SELECT 2 AS b"], str(tmp_path), "e")
    assert (tmp_path / "e_01").exists() and not (tmp_path / "e_02").exists()


def test_clean_scratch_removes_the_folder_of_the_session(spark, tmp_path, monkeypatch):
    assert scratch_dir(spark, "x").startswith(session.session_scratch(spark) + "/x-")
    monkeypatch.setattr(session, "session_scratch", lambda _: str(tmp_path / "own"))
    assert stage(spark.range(3).toDF("x"), "kept").count() == 3 and (tmp_path / "own").exists()
    assert session.clean_scratch(spark) and not list(tmp_path.iterdir())


def published(spark, path):
    return {name: sorted(r[0] for r in df.collect()) for name, df in sinks.read_published(spark, path).items()}


def test_readers_see_all_tables_of_one_version(spark, tmp_path):
    path = f"{tmp_path}/mart"
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, path)
    one = {"a": spark.range(3), "b": spark.range(2)}
    sinks.publish_marts(one, path, "v1")
    before = sinks.read_published(spark, path)
    assert published(spark, path) == {"a": [0, 1, 2], "b": [0, 1]}

    broken = {"a": spark.range(9), "b": spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))}
    with pytest.raises(Exception, match="no"):  # fails between the two tables
        sinks.publish_marts(broken, path, "v2")
    assert sinks.current_version(spark, path)["version"] == "v1"
    assert published(spark, path) == {"a": [0, 1, 2], "b": [0, 1]}

    sinks.publish_marts({"a": spark.range(9), "b": spark.range(5)}, path, "v2")  # over what the failed run left
    assert published(spark, path) == {"a": list(range(9)), "b": list(range(5))}
    assert before["a"].count() == 3  # a reader of the former version goes on
    with pytest.raises(ValueError):
        sinks.publish_marts(one, path, "v2")
    assert sinks.drop_versions(spark, path) == ["v1"]
    assert published(spark, path)["b"] == list(range(5))
    assert not [f for f in tmp_path.joinpath("mart").iterdir() if f.name not in ("versions", "_current.json", "._current.json.crc") and not f.name.endswith(".crc")]
