"""Drift of data and scores, metrics of runs, freshness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.operators import drift as drifts
from bayline.operators import monitoring
from bayline.plans.binding import GIVEN_SCHEMAS, Tables
from bayline.plans.registry import query, rounded
from bayline.session import scratch_dir

# ---- drift -------------------------------------------------------------------------------

#: Lines shipped from here on are the newer sample; their discounts are raised and some prices missing.
_SPLIT = "1998-07-01"
_DRIFT_COLUMNS = f"""l_quantity, l_quantity / 50 as delay_probability,
  case when l_shipdate >= timestamp '{_SPLIT}' then l_discount * 1.5 else l_discount end as l_discount,
  case when l_shipdate >= timestamp '{_SPLIT}' and l_linenumber = 1 then null else l_extendedprice end as l_extendedprice,
  l_returnflag, case when l_shipdate >= timestamp '{_SPLIT}' and l_quantity > 40 then 'X' else l_linestatus end as l_linestatus"""
_NUMBERS = ("l_quantity", "delay_probability", "l_discount", "l_extendedprice")
_LABELS = ("l_returnflag", "l_linestatus")


def _drift_sql(column: str, number: bool) -> str:
    cuts = "[" + ", ".join(f"quantile_cont(v, {i / 10})" for i in range(1, 10)) + "]"
    place = f"case when v is null then -1 else len([c for c in (select {cuts} from v where not newer) if c < v]) end" if number else "v"
    ks = (
        """(select max(abs(gap)) from (
              select (sum(o) over w)::double / sum(o) over () - (sum(n) over w)::double / sum(n) over () as gap
              from (select v, count_if(not newer) as o, count_if(newer) as n from v where v is not null group by v)
              window w as (order by v)))"""
        if number
        else "null::double"
    )
    return f"""select * from (
      with v as (select l_shipdate >= timestamp '{_SPLIT}' as newer, {column} as v from lines),
      sizes as (select count_if(not newer and v is not null) as n_old, count_if(newer and v is not null) as n_new,
                       count_if(not newer)::double as all_old, count_if(newer)::double as all_new from v),
      bins as (select {place} as bin, count_if(not newer) as o, count_if(newer) as n from v group by 1),
      shares as (select greatest(o / all_old, 0.0001) as o, greatest(n / all_new, 0.0001) as n from bins, sizes),
      psi as (select sum((n - o) * ln(n / o)) as psi from shares),
      ks as (select {ks} as ks)
      select '{column}' as metric, n_old, n_new, round(ks, 6) as ks,
        round(case when ks is null then null when ks * sqrt(n_old * n_new / (n_old + n_new)) < 0.2 then 1
          else greatest(least(2 * list_sum([case when k % 2 = 1 then 1 else -1 end
            * exp(-2 * k * k * ks * ks * n_old * n_new / (n_old + n_new)) for k in range(1, 101)]), 1), 0) end, 6)::double as ks_p,
        round(psi, 6) + 0.0 as psi,
        case when psi < 0.1 then 'stable' when psi < 0.25 then 'moderate' else 'large' end as shift
      from sizes, psi, ks)"""


@query(
    "mon3_drift",
    f"with lines as (select l_shipdate, {_DRIFT_COLUMNS} from lineitem) "
    + "\nunion all ".join([_drift_sql(c, True) for c in _NUMBERS] + [_drift_sql(c, False) for c in _LABELS]),
)
def drift(t: Tables):
    """Drift of columns and of a score between lines shipped before and after a day."""
    lines = t.given("lineitem")
    rows = lines.selectExpr(f"l_shipdate >= timestamp_ntz '{_SPLIT}' as newer", *_split(_DRIFT_COLUMNS))
    return rounded(drifts.drift(rows, F.col("newer"), _NUMBERS, _LABELS))


def _split(columns: str) -> list[str]:
    """Select expressions, one by one, for a session without a cast from one kind of timestamp to the other."""
    return [c.strip().replace("timestamp '", "timestamp_ntz '") for c in columns.split(",")]


# ---- metrics of runs ---------------------------------------------------------------------

#: Runs of a growing table; the last one has lost half its rows and many prices.
_RUNS = (1, 2, 3, 4, 5, 6)


def _run_columns(i: int) -> str:
    missing = f"o_custkey % {20 + i} = 0" if i < 6 else "o_custkey % 3 = 0"
    return f"o_orderkey, o_orderdate, case when {missing} then null else o_totalprice end as o_totalprice"


def _run_filter(i: int) -> str:
    return f"o_orderkey % 50 <> {i}" if i < 6 else "o_orderkey % 2 = 0"


_RUNS_SQL = "\nunion all ".join(
    f"""select {i} as n, 'run-{i}' as run, m.* from (
          select count(*)::double as c, 1 - count(o_orderkey) / count(*) as k, 1 - count(o_orderdate) / count(*) as d,
                 1 - count(o_totalprice) / count(*) as p
          from (select {_run_columns(i)} from orders where {_run_filter(i)})),
          lateral (select * from (values ('', 'row_count', c), ('o_orderkey', 'null_rate', k),
                                         ('o_orderdate', 'null_rate', d), ('o_totalprice', 'null_rate', p)) m("column", metric, value)) m"""
    for i in _RUNS
)


@query(
    "mon2_run_metrics",
    f"""with vals as ({_RUNS_SQL}),
        judged as (
          select v.*, (select count(*) from vals e where e.n < v.n and e."column" = v."column" and e.metric = v.metric) as runs,
                 (select median(value) from vals e where e.n < v.n and e."column" = v."column" and e.metric = v.metric) as median,
                 (select mad(value) from vals e where e.n < v.n and e."column" = v."column" and e.metric = v.metric) as deviation
          from vals v)
        select run, 'orders' as "table", "column", metric, round(value, 6) + 0.0 as value, runs, round(median, 6) + 0.0 as median,
               round(deviation, 6) + 0.0 as deviation,
               case when runs < 3 then 'new'
                    when abs(value - median) > greatest(3.5 * 1.4826 * deviation,
                                                        case when metric = 'row_count' then 0.01 * median else 0.01 end)
                    then 'anomaly' else 'ok' end as status
        from judged""",
)
def run_metrics(t: Tables):
    """Every run of a table judged against the earlier ones; the fourth is recorded twice, the second time with other rows."""
    store = scratch_dir(t.spark, "run-metrics")
    orders = t.given("orders")
    for i in (*_RUNS[:4], 4, *_RUNS[4:]):
        rows = orders if i == 4 and _recorded(t, store, "run-4") else orders.filter(_run_filter(i)).selectExpr(*_columns(i))
        monitoring.record(monitoring.scanned_metrics(rows, "orders", f"run-{i}", f"2024-01-0{i} 00:00:00", "o_orderdate"), store)
    metrics = monitoring.read_metrics(t.spark, store)
    return rounded(reduce(DataFrame.unionByName, [monitoring.judge(metrics, f"run-{i}") for i in _RUNS]))


def _recorded(t: Tables, store: str, run: str) -> bool:
    return not monitoring.read_metrics(t.spark, store).filter(F.col("run") == run).isEmpty()


def _columns(i: int) -> list[str]:
    return [c.strip() for c in _run_columns(i).split(",")]


# ---- freshness ---------------------------------------------------------------------------

_TIMES = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
#: Hours that a table may lie behind the newest one.
_LIMITS = {"orders": 24.0 * 365 * 30, "lineitem": 24.0 * 365 * 10}


@query(
    "mon1_freshness",
    "with newest as ("
    + "\nunion all ".join(f"select '{t}' as \"table\", count(*) as row_count, max({c}) as newest from {t}" for t, c in _TIMES.items())
    + """), lags as (
          select *, floor(date_diff('microsecond', newest, (select max(newest) from newest)) / 1e6) / 3600.0 as lag_hours,
                 case "table" when 'orders' then 262800.0 when 'lineitem' then 87600.0 end::double as limit_hours from newest)
        select "table", row_count, newest, round(lag_hours, 6) + 0.0 as lag_hours, limit_hours, lag_hours > limit_hours as stale from lags""",
)
def freshness(t: Tables):
    """How far tables lie behind the newest of them, from file footers: no table is scanned."""
    times = monitoring.file_times(t.spark, {name: (f"{t.sf_dir}/{name}.parquet", column) for name, column in _TIMES.items()})
    as_of = times.agg(F.max("newest")).scalar()
    return rounded(monitoring.freshness(times, as_of, _LIMITS))


@query(
    "mon1_written_metrics",
    "\nunion all ".join(
        f"""select '{t}' as "table", count(*) as row_count, max({c}) as newest, {n} as columns,
                   round({" + ".join(f"(1 - count({x}) / count(*))" for x in cols)}, 6) as null_rates from {t}"""
        for t, c, n, cols in (
            (name, column, len(GIVEN_SCHEMAS[name].split(", ")), [f.split()[0] for f in GIVEN_SCHEMAS[name].split(", ")])
            for name, column in _TIMES.items()
        )
    ),
)
def written_metrics(t: Tables):
    """Metrics taken while tables are written, recorded and read back."""
    store = scratch_dir(t.spark, "written-metrics")
    for name, column in _TIMES.items():
        path = scratch_dir(t.spark, f"written-{name}")
        monitoring.record(monitoring.written_metrics(t.given(name), path, name, "load-1", "2024-01-01 00:00:00", column), store)
    rates = F.aggregate("nulls", F.lit(0.0), lambda total, n: total + n["null_rate"])
    return rounded(
        monitoring.read_metrics(t.spark, store).select(
            "table", "row_count", "newest", F.size("nulls").alias("columns"), rates.alias("null_rates")
        )
    )
