"""Roles that are shared by several tables of one query."""

from bayline.plans.binding import GIVEN_SCHEMAS, Tables


def test_first_lines_are_kept_for_all_roles(spark, tmp_path):
    line = "1L, {p}L, 7L, {n}, 5D, 10D, 0.02D, 0D, 'N', 'O', timestamp_ntz'2024-01-0{n} 00:00:00'"
    rows = ", ".join(f"({line.format(p=p, n=n)})" for p, n in ((30, 2), (20, 1), (20, 1)))
    names = [c.split()[0] for c in GIVEN_SCHEMAS["lineitem"].split(", ")]
    spark.sql(f"select * from values {rows} as t({', '.join(names)})").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 5)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    plain, kept = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    kept.keep_first_lines()
    assert kept.visits.collect() == plain.visits.collect() and kept.visits.count() == 1
    assert [r.vehicle_id for r in kept.vehicles.collect()] == ["5-20"]
    assert "Aggregate" in plain.visits._jdf.queryExecution().toString()
    assert "Aggregate" not in kept.visits._jdf.queryExecution().toString()
