"""Experiment on high-risk rows (EXP)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.operators import experiment

from bayline.plans.binding import Tables
from bayline.plans.queries.kpis import EXPERIMENT_SQL, SCORED_SQL, experiment_rows, scored_lines
from bayline.plans.queries.statistics import (
    EFFECT_SQL,
    SAMPLE_SIZE_SQL,
    erfc_sql,
    chi_square_sql,
    mann_whitney_sql,
    proportion_sql,
    two_sided_sql,
)
from bayline.plans.registry import query, rounded
from bayline.sources.sinks import stage


def staged_experiment(t: Tables):
    """Experiment rows for reports that run several tests on them."""
    return stage(experiment_rows(t), "experiment")


@query(
    "exp1_eligible",
    "with " + SCORED_SQL
    + """select l_orderkey, l_linenumber, round(delay_probability, 6) as delay_probability
         from scored where risk_band = 'High Risk'""",
)
def eligible(t: Tables):
    kept = experiment.eligible(scored_lines(t))
    return rounded(kept.select("l_orderkey", "l_linenumber", "delay_probability"))


@query("exp2_assignment", EXPERIMENT_SQL + "select visit_id, experiment_group from experiment")
def assignment(t: Tables):
    return experiment.assign(t.visits.select("visit_id"), "visit_id", "ab")


_READOUT_SQL = """select experiment_group, count(*) as customers,
       round(avg(final_delay_flag), 6) as delay_rate, round(avg(csat_score), 6) as avg_csat,
       round(avg(complaint_flag), 6) as complaint_rate
 from experiment group by experiment_group"""


@query(
    "exp3_readout",
    EXPERIMENT_SQL.replace("left join surveys s on v.visit_id = s.visit_id",
                           "join surveys s on v.visit_id = s.visit_id") + _READOUT_SQL,
)
def readout(t: Tables):
    """Readout over the surveyed visits only."""
    surveyed = experiment_rows(t).join(t.surveys.select("visit_id"), "visit_id", "left_semi")
    return rounded(experiment.readout(surveyed))


_PRIMARY_SQL = mann_whitney_sql(
    "experiment", "experiment_group", "csat_score", "'Control'", "'Treatment'"
)


@query(
    "exp4_primary_test",
    EXPERIMENT_SQL + "," + EFFECT_SQL + "," + _PRIMARY_SQL
    + """select round(mc, 6) as control_mean, round(mt, 6) as treatment_mean,
               round(mt - mc, 6) as absolute_difference,
               round(100 * (mt - mc) / mc, 6) as relative_difference_percent,
               u as u_statistic, round(p, 6) as p_value, p < 0.05 as significant_at_0_05
         from mwp, effect""",
)
def primary_test(t: Tables):
    return rounded(experiment.primary_test(staged_experiment(t)))


_CHI_SQL = chi_square_sql("experiment", "experiment_group", "complaint_flag")
_COMPLAINT_SQL = f"""
rates as (select avg(complaint_flag) filter (experiment_group = 'Control') as rc,
                 avg(complaint_flag) filter (experiment_group = 'Treatment') as rt
          from experiment),
complaint as (select rc, rt, x, {erfc_sql('sqrt(x / 2)')} as pc from chi, rates)
"""


@query(
    "exp5_complaint_test",
    EXPERIMENT_SQL + "," + _CHI_SQL + "," + _COMPLAINT_SQL
    + """select round(rc, 6) as control_rate, round(rt, 6) as treatment_rate,
               round(rt - rc, 6) as absolute_difference, round(x, 6) as chi_square,
               round(pc, 6) as p_value, pc < 0.05 as significant_at_0_05 from complaint""",
)
def complaint_test(t: Tables):
    return rounded(experiment.complaint_test(staged_experiment(t)))


@query(
    "exp5_secondary_delay",
    EXPERIMENT_SQL + "," + proportion_sql("final_delay_flag")
    + f""" select round(z, 6) as z_statistic, round({two_sided_sql('z')}, 6) as p_value from zt""",
)
def secondary_delay(t: Tables):
    tests = experiment.secondary_tests(experiment_rows(t))
    return rounded(tests["delay"].select("z_statistic", "p_value"))


@query("exp5_sample_size", EXPERIMENT_SQL + "," + EFFECT_SQL + SAMPLE_SIZE_SQL)
def sample_size(t: Tables):
    return rounded(experiment.secondary_tests(experiment_rows(t))["sample_size"])


@query(
    "exp5_decision_report",
    EXPERIMENT_SQL + "," + _PRIMARY_SQL + "," + proportion_sql("final_delay_flag") + ","
    + _CHI_SQL + "," + _COMPLAINT_SQL
    + f""", tests as (select 'Primary — CSAT' as metric, 'CSAT' as name, p as p_value from mwp
               union all select 'Secondary — Delay', 'delay rate', {two_sided_sql('z')} from zt
               union all select 'Secondary — Complaint', 'complaint rate', pc from complaint)
         select metric, round(p_value, 6) as p_value,
                case when p_value < 0.05 then 'Statistically significant difference in ' || name
                       || case when name = 'CSAT' then ' between treatment and control.' else '.' end
                     else 'No statistically significant difference in ' || name || ' was detected.'
                end as result
         from tests""",
)
def decision_report(t: Tables):
    return rounded(experiment.decision_report(staged_experiment(t)))


REPLICATES = 100

_BOOTSTRAP_SQL = f"""
steps as (select k, exp(-1) * sum(1.0::double / factorial(k::int)::double) over (order by k) as bound
          from range(13) r(k)),
draws as (
  select visit_id, experiment_group, csat_score, 4 * block + part as replicate,
         ('0x' || substr(md5('boot:' || visit_id || ':' || block), 8 * part + 1, 8))::ubigint
           / 4294967296.0 as u
  from experiment, range({REPLICATES // 4}) b(block), range(4) p(part)
  where csat_score is not null),
weights as (select *, (select count(*) from steps where draws.u >= bound) as weight from draws),
lifts as (
  select replicate,
         sum(weight * csat_score) filter (experiment_group = 'Treatment')
           / sum(weight) filter (experiment_group = 'Treatment')
         - sum(weight * csat_score) filter (experiment_group = 'Control')
           / sum(weight) filter (experiment_group = 'Control') as lift
  from weights group by replicate)
select count(lift) as replicates, round(avg(lift), 6) as mean_lift,
       round(quantile_cont(lift, 0.025), 6) as ci_low,
       round(quantile_cont(lift, 0.975), 6) as ci_high
from lifts
"""


@query("exp6_bootstrap_lift", EXPERIMENT_SQL + "," + _BOOTSTRAP_SQL)
def bootstrap_lift(t: Tables):
    rows = staged_experiment(t)
    return rounded(
        experiment.bootstrap_lift(rows, "visit_id", "csat_score", REPLICATES, "boot")
    )


@query("exp_model_to_experiment")
def model_to_experiment(t: Tables):
    """From the fitted model over its high-risk visits to the group readout."""
    from bayline.operators import model
    from bayline.plans.queries.models import fitted

    fit, test = fitted(t)
    high = experiment.eligible(model.score_and_band(fit, test)).select(
        "visit_id", F.col("delayed_visit").alias("final_delay_flag")
    )
    surveyed = high.join(
        t.surveys.select("visit_id", "csat_score", "complaint_flag"), "visit_id", "left"
    )
    return rounded(experiment.readout(experiment.assign(surveyed, "visit_id", "ab")))
