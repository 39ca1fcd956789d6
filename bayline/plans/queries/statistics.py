"""Hypothesis tests, effect sizes and chart data (STA)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.functions.noncentral import t_test_size
from bayline.operators import ordering, stats
from bayline.operators.experiment import CONTROL, GROUP, TREATMENT
from bayline.plans.binding import Tables, with_roles
from bayline.plans.queries.kpis import EXPERIMENT_SQL, experiment_rows
from bayline.plans.registry import query, rounded


def erfc_sql(x: str) -> str:
    """erfc of a non-negative SQL expression: series below 2.5, continued fraction above."""
    near = (
        "list_reduce(list_prepend(1.0::double, range(60, 0, -1)::double[]), "
        f"lambda acc, k: 1.0::double + acc * 2 * ({x}) * ({x}) / (2 * k + 1))"
    )
    far = (
        f"list_reduce(list_prepend(({x})::double, range(60, 0, -1)::double[]), "
        f"lambda acc, k: ({x}) + k / 2 / acc)"
    )
    return f"""(case when ({x}) < 2.5
        then 1 - 2 / sqrt(pi()) * exp(-({x}) * ({x})) * ({x}) * {near}
        else exp(-({x}) * ({x})) / (sqrt(pi()) * {far}) end)"""


def two_sided_sql(z: str) -> str:
    return erfc_sql(f"abs({z}) / sqrt(2)")


def mann_whitney_sql(source: str, group: str, value: str, first: str, second: str) -> str:
    """Statistic and p-value from average ranks over the pooled rows, row by row."""
    return f"""
pooled as (select {group} as g, {value}::double as v from {source}
           where {value} is not null and {group} in ({first}, {second})),
ranked as (select g, v, rank() over (order by v) + (count(*) over (partition by v) - 1) / 2
             as r, count(*) over (partition by v) as t from pooled),
sums as (select count_if(g = {first})::double as n1, count_if(g = {second})::double as n2,
                sum(case when g = {first} then r end)::double as r1,
                sum(t::double * t - 1) as ties,
                median(case when g = {first} then v end) as median_1,
                median(case when g = {second} then v end) as median_2 from ranked),
stat as (select *, r1 - n1 * (n1 + 1) / 2 as u,
                sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) as sd
         from sums),
mw as (select *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sd as z from stat),
mwp as (select *, case when z < 0 then 1.0 else {two_sided_sql('z')} end as p from mw)
"""


_MW_COLUMNS = """select n1::bigint as n1, n2::bigint as n2, median_1, median_2, u as u_statistic,
       round(z, 6) as z_statistic, round(p, 9) as p_value, p < 0.05 as significant_at_0_05
 from mwp"""


def _tested(df):
    return df.withColumns(
        {"z_statistic": F.round("z_statistic", 6), "p_value": F.round("p_value", 9)}
    )


@query(
    "sta1_csat_by_delay",
    with_roles("base") + "," + mann_whitney_sql("base", "delayed", "csat_score", "false", "true")
    + _MW_COLUMNS,
)
def csat_by_delay(t: Tables):
    """Satisfaction of on-time against delayed visits."""
    visits = t.surveyed.select("delayed", "csat_score")
    return _tested(
        stats.mann_whitney(visits, "delayed", "csat_score", False, True, closed_domain=True)
    )


@query(
    "sta1_delay_by_parts",
    with_roles("visits", "visit_parts")
    + """, joined as (select coalesce(p.parts_delayed, false) as late, v.delay_hours
               from visits v left join visit_parts p on v.visit_id = p.visit_id),"""
    + mann_whitney_sql("joined", "late", "delay_hours", "false", "true")
    + _MW_COLUMNS,
)
def delay_by_parts(t: Tables):
    """Delay of visits without against visits with delayed parts."""
    parts = t.visit_parts.select("visit_id", F.col("parts_delayed").alias("late"))
    joined = t.visits.select("visit_id", "delay_hours").join(parts, "visit_id", "left")
    joined = joined.withColumn("late", F.coalesce("late", F.lit(False)))
    return _tested(stats.mann_whitney(joined, "late", "delay_hours", False, True))


@query(
    "sta1_price_by_status",
    "with " + mann_whitney_sql("orders", "o_orderstatus", "o_totalprice", "'F'", "'O'")
    + _MW_COLUMNS,
)
def price_by_status(t: Tables):
    """The same test on a continuous column, where nearly every value is distinct."""
    return _tested(stats.mann_whitney(t.given("orders"), "o_orderstatus", "o_totalprice", "F", "O"))


@query(
    "sta1_small_samples",
    """with recursive f as (select 'F' as g, o_totalprice as v from orders where o_orderstatus = 'F' order by o_orderkey limit 6),
         o as (select 'O' as g, o_totalprice as v from orders where o_orderstatus = 'O' order by o_orderkey limit 7),
         pooled as (select *, row_number() over (order by v) as r from (select * from f union all select * from o)),
         chosen as (select 0 as n, 0 as last, 0 as total union all
                    select n + 1, r::int, total + r::int from chosen, (select unnest(range(1, 14)) as r) where n < 6 and r > last),
         u as (select sum(r) filter (g = 'F') - 21 as u, median(v) filter (g = 'F') as m1, median(v) filter (g = 'O') as m2 from pooled)
       select 6::bigint as n1, 7::bigint as n2, m1 as median_1, m2 as median_2, u::double as u_statistic,
              round((greatest(u, 42 - u) - 21.5) / sqrt(42 / 12 * 14), 6) as z_statistic,
              round((select least(1, 2 * count_if(total - 21 >= greatest(u, 42 - u)) / count(*)) from chosen where n = 6), 9)::double as p_value,
              (select 2 * count_if(total - 21 >= greatest(u, 42 - u)) / count(*) from chosen where n = 6) < 0.05 as significant_at_0_05
       from u""",
)
def small_samples(t: Tables):
    """Six against seven prices, the first of each status: the exact p-value, checked by enumeration."""
    orders = t.given("orders")
    first = [ordering.top_n(orders.filter(F.col("o_orderstatus") == s), [], "o_orderkey", n) for s, n in (("F", 6), ("O", 7))]
    return _tested(stats.mann_whitney(first[0].unionByName(first[1]), "o_orderstatus", "o_totalprice", "F", "O"))


def chi_square_sql(source: str, a: str, b: str) -> str:
    return f"""
cells as (select x.a, y.b, (select count(*) from {source} where {a} = x.a and {b} = y.b) as o
          from (select distinct {a} as a from {source} where {a} is not null and {b} is not null) x,
               (select distinct {b} as b from {source} where {a} is not null and {b} is not null) y),
margins as (select *, sum(o) over (partition by a)::double * sum(o) over (partition by b)
              / sum(o) over () as e, dense_rank() over (order by a) as ra,
              dense_rank() over (order by b) as rb from cells),
dims as (select ((max(ra) - 1) * (max(rb) - 1))::int as dof from margins),
chi as (select any_value(dof) as dof,
               sum(case when dof = 1 then (abs(o - e) - least(0.5, abs(o - e))) ^ 2
                        else (o - e) ^ 2 end / e) as x
        from margins, dims)
"""


@query(
    "sta2_complaints_by_delay",
    with_roles("base") + "," + chi_square_sql("base", "delayed", "complaint_flag")
    + f""" select round(x, 6) as chi_square, dof as degrees_of_freedom,
                round({erfc_sql('sqrt(x / 2)')}, 9) as p_value,
                {erfc_sql('sqrt(x / 2)')} < 0.05 as significant_at_0_05 from chi""",
)
def complaints_by_delay(t: Tables):
    test = stats.chi_square(t.surveyed, "delayed", "complaint_flag")
    return test.withColumns(
        {"chi_square": F.round("chi_square", 6), "p_value": F.round("p_value", 9)}
    )


@query(
    "sta2_priority_by_status",
    "with " + chi_square_sql("orders", "o_orderpriority", "o_orderstatus")
    + """ select round(x, 6) as chi_square, dof as degrees_of_freedom,
                round(exp(-x / 2) * (1 + x / 2 + (x / 2) ^ 2 / 2 + (x / 2) ^ 3 / 6), 9) as p_value,
                exp(-x / 2) * (1 + x / 2 + (x / 2) ^ 2 / 2 + (x / 2) ^ 3 / 6) < 0.05
                  as significant_at_0_05 from chi""",
)
def priority_by_status(t: Tables):
    """Eight degrees of freedom, so without the correction."""
    test = stats.chi_square(t.given("orders"), "o_orderpriority", "o_orderstatus")
    return test.withColumns(
        {"chi_square": F.round("chi_square", 6), "p_value": F.round("p_value", 9)}
    )


def proportion_sql(flag: str) -> str:
    return f"""
ab as (select count({flag}) filter (experiment_group = 'Control')::double as nc,
              count({flag}) filter (experiment_group = 'Treatment')::double as nt,
              sum({flag}) filter (experiment_group = 'Control')::double as xc,
              sum({flag}) filter (experiment_group = 'Treatment')::double as xt from experiment),
zt as (select *, (xt / nt - xc / nc)
         / sqrt((xc + xt) / (nc + nt) * (1 - (xc + xt) / (nc + nt)) * (1 / nc + 1 / nt)) as z
       from ab)
"""


@query(
    "sta3_delay_rate_z_test",
    EXPERIMENT_SQL + "," + proportion_sql("final_delay_flag")
    + f""" select round(xc / nc, 6) as control_rate, round(xt / nt, 6) as treatment_rate,
                round(xt / nt - xc / nc, 6) as absolute_difference,
                round(100 * (xt / nt - xc / nc) / (xc / nc), 6) as relative_change_percent,
                round(z, 6) as z_statistic, round({two_sided_sql('z')}, 6) as p_value,
                {two_sided_sql('z')} < 0.05 as significant_at_0_05 from zt""",
)
def delay_rate_z_test(t: Tables):
    return rounded(
        stats.two_proportion_z(
            experiment_rows(t), GROUP, "final_delay_flag", TREATMENT, CONTROL
        )
    )


EFFECT_SQL = """
fx as (select count(csat_score) filter (experiment_group = 'Control')::double as nc,
              count(csat_score) filter (experiment_group = 'Treatment')::double as nt,
              avg(csat_score) filter (experiment_group = 'Control') as mc,
              avg(csat_score) filter (experiment_group = 'Treatment') as mt,
              var_samp(csat_score) filter (experiment_group = 'Control') as vc,
              var_samp(csat_score) filter (experiment_group = 'Treatment') as vt
       from experiment),
effect as (select *, (mt - mc) / sqrt(((nc - 1) * vc + (nt - 1) * vt) / (nc + nt - 2)) as d
           from fx)
"""


@query(
    "sta4_cohens_d",
    EXPERIMENT_SQL + "," + EFFECT_SQL + "select round(d, 6) as cohens_d from effect",
)
def cohens_d(t: Tables):
    return rounded(stats.cohens_d(experiment_rows(t), GROUP, "csat_score", TREATMENT, CONTROL))


@query(
    "sta5_lift",
    EXPERIMENT_SQL + "," + EFFECT_SQL
    + """select round(mc, 6) as mean_1, round(mt, 6) as mean_2,
               round(mt - mc, 6) as absolute_difference,
               round(100 * (mt - mc) / mc, 6) as relative_difference_percent from effect""",
)
def lift(t: Tables):
    sample = stats.sample_stats(experiment_rows(t), GROUP, "csat_score", CONTROL, TREATMENT)
    return rounded(
        stats.lift(sample).select(
            "mean_1", "mean_2", "absolute_difference", "relative_difference_percent"
        )
    )


SAMPLE_SIZE_SQL = """select 'Observed Cohen''s d' as parameter, round(abs(d), 6) as value from effect
union all select 'Alpha', 0.05 from effect
union all select 'Desired Power', 0.8 from effect
union all select 'Required Sample Size Per Group',
     round(2 * (1.959963984540054::double + 0.8416212335729143::double) ^ 2
           / greatest(abs(d), 0.01) ^ 2, 6) from effect
union all select 'Actual Control Size', nc from effect
union all select 'Actual Treatment Size', nt from effect"""


@query("sta6_sample_size", EXPERIMENT_SQL + "," + EFFECT_SQL + SAMPLE_SIZE_SQL)
def sample_size(t: Tables):
    return rounded(
        stats.sample_size(experiment_rows(t), GROUP, "csat_score", TREATMENT, CONTROL)
    )


# published rows per group of the two-sided t-test at 0.05 and power 0.8, as fixed values
PUBLISHED_SIZES = {0.2: 393.405695, 0.5: 63.765610, 0.8: 25.524572}

_GRID = 160
_NORMAL = "(case when x < 0 then " + erfc_sql("abs(x) / sqrt(2)") + " / 2 else 1 - " + erfc_sql("abs(x) / sqrt(2)") + " / 2 end)"
# one evaluation of a tail per step: 44 halvings for the critical value, one for the size, 36 times
_EXACT_SIZE_SQL = f"""
search as (
  select 0 as step, greatest(abs(d), 0.01) as d, 2 * (1.959963984540054::double + 0.8416212335729143::double) ^ 2 / greatest(abs(d), 0.01) ^ 2 as lo,
         2 * (1.959963984540054::double + 0.8416212335729143::double) ^ 2 / greatest(abs(d), 0.01) ^ 2 + 6 as hi, 1.9::double as t_lo, 3.5::double as t_hi
  from effect
  union all
  select step + 1, d, case when step % 45 = 44 and tail < 0.8 then m else lo end, case when step % 45 = 44 and tail >= 0.8 then m else hi end,
         case when step % 45 = 44 then 1.9 when tail > 0.05 then t else t_lo end, case when step % 45 = 44 then 3.5 when tail > 0.05 then t_hi else t end
  from (
    select step, d, lo, hi, t_lo, t_hi, m, t, sum(w * beyond) / sum(w) as tail
    from (
      select step, d, lo, hi, t_lo, t_hi, m, t, w, list_sum([{_NORMAL} for x in [delta - t * s, -delta - t * s]]) as beyond
      from (
        select *, exp(u) as s, exp(v * (u - (exp(2 * u) - 1) / 2)) as w
        from (
          select *, (lo + hi) / 2 as m, lo + hi - 2 as v, (t_lo + t_hi) / 2 as t, case when step % 45 = 44 then d * sqrt((lo + hi) / 4) else 0 end as delta,
                 (2 * sqrt(39 / v) + 39 / v) * i / {_GRID} - sqrt(39 / v) - 39 / v as u
          from search, range({_GRID + 1}) g(i) where step < 45 * 36)))
    group by all)),
size as (select (lo + hi) / 2 as n from search where step = 45 * 36)
"""


@query(
    "sta6_exact_size",
    EXPERIMENT_SQL.replace("with ", "with recursive ", 1) + "," + EFFECT_SQL + "," + _EXACT_SIZE_SQL
    + "select 'observed' as effect, round(n, 3) as size from size"
    + "".join(f" union all select '{d}', round({n}::double, 4)" for d, n in PUBLISHED_SIZES.items()),
)
def exact_size(t: Tables):
    """Rows per group by the power of the t-test, for the observed effect and for those of published tables."""
    found = stats.sample_size(experiment_rows(t), GROUP, "csat_score", TREATMENT, CONTROL, exact=True)
    observed = found.filter(F.col("parameter") == "Required Sample Size Per Group").select(F.lit("observed").alias("effect"), F.round("value", 3).alias("size"))
    effects = t.spark.createDataFrame([(d,) for d in PUBLISHED_SIZES], "d double")
    known = effects.select(F.col("d").cast("string").alias("effect"), F.round(t_test_size(F.col("d"), 0.05, 0.8), 4).alias("size"))
    return observed.unionByName(known)


@query(
    "sta7_decisions",
    "with "
    + mann_whitney_sql("orders", "o_orderstatus", "o_totalprice", "'F'", "'O'")
    + "," + chi_square_sql("orders", "o_orderpriority", "o_orderstatus")
    + """, tests as (
           select 'Primary — CSAT' as metric, p as p_value from mwp
           union all select 'Secondary — Delay', null
           union all select 'Secondary — Complaint',
             exp(-x / 2) * (1 + x / 2 + (x / 2) ^ 2 / 2 + (x / 2) ^ 3 / 6) from chi)
         select metric, round(p_value, 9) as p_value,
           case metric
             when 'Primary — CSAT' then case when p_value < 0.05
               then 'Statistically significant difference in CSAT between treatment and control.'
               else 'No statistically significant difference in CSAT was detected.' end
             when 'Secondary — Delay' then case when p_value < 0.05
               then 'Statistically significant difference in delay rate.'
               else 'No statistically significant difference in delay rate was detected.' end
             else case when p_value < 0.05
               then 'Statistically significant difference in complaint rate.'
               else 'No statistically significant difference in complaint rate was detected.' end
             end as result
         from tests""",
)
def decisions(t: Tables):
    """Verdicts from three tests, one of them undefined because both of its rates are 1."""
    orders = t.given("orders")
    constant = orders.withColumn("always", F.lit(1))
    tests = stats.tests_table(
        {
            "Primary — CSAT": stats.mann_whitney(
                orders, "o_orderstatus", "o_totalprice", "F", "O"
            ),
            "Secondary — Delay": stats.two_proportion_z(
                constant, "o_orderstatus", "always", "F", "O"
            ),
            "Secondary — Complaint": stats.chi_square(orders, "o_orderpriority", "o_orderstatus"),
        }
    )
    return rounded(stats.decisions(tests), 9)


_BOX_SQL = """quart as (select {g} as g, quantile_cont({v}, 0.25) as q1, median({v}) as median,
                quantile_cont({v}, 0.75) as q3 from {s} where {v} is not null group by 1)
 select {g}, min({v}) as minimum,
        min({v}) filter ({v} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_low,
        any_value(q1) as q1, any_value(median) as median, any_value(q3) as q3,
        max({v}) filter ({v} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_high,
        max({v}) as maximum
 from {s} join quart on {g} = g where {v} is not null group by {g}"""


@query(
    "sta8_csat_box",
    with_roles("base") + ", " + _BOX_SQL.format(g="delayed", v="csat_score", s="base"),
)
def csat_box(t: Tables):
    visits = t.surveyed.select("delayed", "csat_score")
    return stats.box_stats(visits, "delayed", "csat_score", closed_domain=True)


@query(
    "sta8_value_box",
    """with quart as (select event_type as g, quantile_cont(value, 0.25) as q1,
                median(value) as median, quantile_cont(value, 0.75) as q3 from events group by 1)
       select event_type, min(value) as minimum,
              min(value) filter (value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))
                as whisker_low,
              round(any_value(q1), 6) as q1, round(any_value(median), 6) as median,
              round(any_value(q3), 6) as q3,
              max(value) filter (value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))
                as whisker_high,
              max(value) as maximum
       from events join quart on event_type = g group by event_type""",
)
def value_box(t: Tables):
    return rounded(stats.box_stats(t.given("events"), "event_type", "value"))
