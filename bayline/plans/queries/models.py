"""Delay-risk model (ML)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bayline.operators import kpi, model, sampling
from bayline.operators.features import delayed, lead_time_days
from bayline.plans.binding import Tables, with_roles
from bayline.plans.queries.kpis import SCORED_SQL, scored_lines
from bayline.plans.registry import query, rounded
from bayline.sources.sinks import stage

NUMERIC = ("lead_time_days", "scheduled_duration_hours", "parts_delayed", "parts_delay_days")
# one slot per level, so categories come from closed lists: the nation stands for the dealer,
# because the number of suppliers grows with the data
CATEGORICAL = ("dealer_nation", "service_type")
TARGET = "delayed_visit"


def model_frame(t: Tables):
    """Features and target of every visit, staged: the split, the fit and the score read it."""
    parts = t.visit_parts.select(
        "visit_id",
        F.col("parts_delayed").cast("int").alias("parts_delayed"),
        F.col("max_parts_delay_days").alias("parts_delay_days"),
    )
    nations = (
        t.given("supplier")
        .join(t.given("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("dealer_id"), F.col("n_name").alias("dealer_nation"))
    )
    visits = (
        t.visits.join(
            t.appointments.select("appointment_id", "booking_date", "service_type"),
            "appointment_id",
            "left",
        )
        .join(parts, "visit_id", "left")
        .join(nations, "dealer_id", "left")
        .select(
            "visit_id",
            "dealer_nation",
            "service_type",
            lead_time_days(F.col("booking_date"), F.col("check_in_time"))
            .cast("double")
            .alias("lead_time_days"),
            "scheduled_duration_hours",
            F.coalesce("parts_delayed", F.lit(0)).cast("double").alias("parts_delayed"),
            F.coalesce("parts_delay_days", F.lit(0)).cast("double").alias("parts_delay_days"),
            delayed(F.col("delay_hours")).cast("int").alias(TARGET),
        )
    )
    return stage(model.stratified_split(visits, "visit_id", TARGET), "model_frame")


def fitted(t: Tables):
    """The fitted model and the test rows."""
    frame = model_frame(t)
    fit = model.fit_logit(frame.filter(~F.col("is_test")), TARGET, NUMERIC, CATEGORICAL)
    return fit, frame.filter("is_test").drop("is_test")


_GAPS_SQL = """gaps as (select o_orderkey, case when o_orderstatus <> 'P' then o_totalprice end as price,
       case when o_totalprice > 100000 then o_orderpriority end as priority,
       ('0x' || substr(md5('split:' || o_orderkey), 1, 8))::ubigint / 4294967296.0 < 0.2 as is_test
  from orders)
"""


def _gaps(t: Tables):
    orders = t.given("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_orderpriority")).alias("priority"),
        F.lit(1).alias("label"),
    )
    return model.stratified_split(orders, "o_orderkey", "label").drop("label")


@query(
    "ml1_median_imputer",
    "with " + _GAPS_SQL + "select round(median(price), 6) as price from gaps where not is_test",
)
def median_imputer(t: Tables):
    train = _gaps(t).filter(~F.col("is_test"))
    return rounded(model.median_imputer(train, ["price"]))


@query(
    "ml2_mode_imputer",
    "with " + _GAPS_SQL
    + """(select 'priority' as "column", priority as value from gaps
          where not is_test and priority is not null
          group by priority order by count(*) desc, priority limit 1)""",
)
def mode_imputer(t: Tables):
    train = _gaps(t).filter(~F.col("is_test"))
    return model.mode_imputer(train, ["priority"])


@query(
    "ml2_imputed",
    "with " + _GAPS_SQL
    + """select o_orderkey, is_test,
               round(coalesce(price, (select median(price) from gaps where not is_test)), 6) as price,
               coalesce(priority, (select priority from gaps where not is_test
                 and priority is not null group by priority
                 order by count(*) desc, priority limit 1)) as priority
         from gaps""",
)
def imputed(t: Tables):
    gaps = _gaps(t)
    return rounded(model.impute(gaps, gaps.filter(~F.col("is_test")), ["price"], ["priority"]))


@query(
    "ml3_one_hot",
    """with levels as (select o_orderpriority, row_number() over (order by o_orderpriority) - 1 as slot
                    from (select distinct o_orderpriority from orders
                          where o_orderpriority <> '5-LOW'))
       select o.o_orderpriority, s.slot::int as slot,
              sum((l.slot is not null and l.slot = s.slot)::int)::double as total
       from orders o left join levels l using (o_orderpriority), levels s
       group by o.o_orderpriority, s.slot""",
)
def one_hot(t: Tables):
    """Levels of the training rows encoded; a level that only the test rows have is all zero."""
    orders = t.given("orders").select("o_orderkey", "o_orderpriority")
    train = orders.filter(F.col("o_orderpriority") != "5-LOW")
    fit = Pipeline(stages=model.one_hot(["o_orderpriority"])).fit(train)
    vector = vector_to_array("o_orderpriority_vec")
    return (
        fit.transform(orders)
        .select("o_orderpriority", F.posexplode(vector).alias("slot", "value"))
        .groupBy("o_orderpriority", "slot")
        .agg(F.sum("value").alias("total"))
    )


@query(
    "ml4_stratified_split",
    """select o_orderkey, o_orderstatus,
              ('0x' || substr(md5('split:' || o_orderkey), 1, 8))::ubigint / 4294967296.0 < 0.2
                as is_test
       from orders where o_orderstatus is not null""",
)
def stratified_split(t: Tables):
    orders = t.given("orders").select("o_orderkey", "o_orderstatus")
    return model.stratified_split(orders, "o_orderkey", "o_orderstatus")


@query(
    "ml4_exact_split",
    """with sizes as (select o_orderpriority, count(*) as n, floor(0.15::double * count(*)) as base from orders
                    where o_orderpriority is not null group by 1),
         takes as (select o_orderpriority, base + (row_number() over (order by 0.15::double * n - base desc, o_orderpriority)
                          <= round(0.15::double * sum(n) over ()) - sum(base) over ())::int as take from sizes)
       select o_orderkey, o_orderpriority,
              row_number() over (partition by o_orderpriority
                                 order by ('0x' || substr(md5('exact:' || o_orderkey), 1, 8))::ubigint, o_orderkey) <= take as is_test
       from orders join takes using (o_orderpriority)""",
)
def exact_split(t: Tables):
    """A split whose classes have the wanted share to within one row."""
    orders = t.given("orders").select("o_orderkey", "o_orderpriority")
    return sampling.exact_split(orders, "o_orderkey", "o_orderpriority", 0.15, "exact")


FRAME_SQL = with_roles("visits", "appointments", "visit_parts") + """, frame as (
  select v.visit_id, n.n_name as dealer_nation, a.service_type,
         floor(date_diff('microsecond', a.booking_date, v.check_in_time) / 8.64e10)::double
           as lead_time_days,
         v.scheduled_duration_hours,
         coalesce(p.parts_delayed::int, 0)::double as parts_delayed,
         coalesce(p.max_parts_delay_days, 0)::double as parts_delay_days,
         (v.delay_hours > 0)::int as delayed_visit,
         ('0x' || substr(md5('split:' || v.visit_id), 1, 8))::ubigint / 4294967296.0 < 0.2
           as is_test
  from visits v left join appointments a using (appointment_id)
  left join visit_parts p on p.visit_id = v.visit_id
  left join supplier on s_suppkey = v.dealer_id left join nation n on n_nationkey = s_nationkey)
"""


@query(
    "ml5_column_transformer",
    FRAME_SQL
    + """, train as (select * from frame where not is_test),
         fit as (select avg(lead_time_days) as m, stddev_pop(lead_time_days) as sd,
                        avg(scheduled_duration_hours) as m2,
                        stddev_pop(scheduled_duration_hours) as sd2,
                        count(distinct dealer_nation) + count(distinct service_type) as levels
                 from train)
         select is_test, count(*) as rows, (4 + any_value(levels))::int as width,
                2.0::double as max_hot_levels,
                round(avg((lead_time_days - m) / sd), 6) + 0.0 as mean_lead_time,
                round(stddev_samp((scheduled_duration_hours - m2) / sd2), 6) as sd_scheduled
         from frame, fit group by is_test""",
)
def column_transformer(t: Tables):
    """Width of the assembled vector, its encoded levels and two scaled columns."""
    frame = model_frame(t)
    train = frame.filter(~F.col("is_test"))
    fit = Pipeline(stages=model.feature_pipeline(train, NUMERIC, CATEGORICAL)).fit(train)
    vector = vector_to_array("features")
    levels = F.slice(vector, len(NUMERIC) + 1, F.size(vector))
    hot = F.aggregate(levels, F.lit(0.0), lambda total, x: total + x)
    rows = fit.transform(frame).select("is_test", vector.alias("v"), hot.alias("hot"))
    return rounded(
        rows.groupBy("is_test").agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(F.size("v")).alias("width"),
            F.max("hot").alias("max_hot_levels"),
            F.avg(F.col("v")[0]).alias("mean_lead_time"),
            F.stddev_samp(F.col("v")[1]).alias("sd_scheduled"),
        )
    )


@query("ml6_balanced_logit")
def balanced_logit(t: Tables):
    """Metrics of the fitted model on the test rows."""
    fit, test = fitted(t)
    scored = model.score(fit, test)
    return model.binary_metrics(scored, TARGET, "delay_probability", "predicted_delayed")


@query(
    "ml6_logit_optimum",
    FRAME_SQL
    + """select count(*) as rows, count(*) / 2.0::double as weight_0, count(*) / 2.0::double as weight_1,
               0.5::double as weighted_probability, 0.0::double as gradient_norm
         from frame where not is_test""",
)
def logit_optimum(t: Tables):
    """Conditions of the optimum on the training rows, by the fit of all features."""
    train = model_frame(t).filter(~F.col("is_test"))
    fit = model.fit_logit(train, TARGET, NUMERIC, CATEGORICAL)
    return rounded(model.optimum(fit, train, TARGET), 3)


# With one two-valued feature and no penalty, the fitted probability of a level is its weighted rate
# among the training rows, and the coefficient the difference of the log odds.
LEVELS_SQL = """with rows as (
  select l_orderkey, l_linenumber, (l_quantity >= 25)::int as large, (l_extendedprice > 30000)::int as dear,
         ('0x' || substr(md5('split:' || l_orderkey || '-' || l_linenumber), 1, 8))::ubigint
           / 4294967296.0 < 0.2 as is_test
  from lineitem where l_quantity is not null and l_extendedprice is not null),
train as (select * from rows where not is_test),
classes as (select count_if(dear = 1)::double as n1, count_if(dear = 0)::double as n0 from train),
levels as (select large, count_if(dear = 1) / any_value(n1) as w1, count_if(dear = 0) / any_value(n0) as w0
           from train, classes group by large),
scores as (select large, w1 / (w1 + w0) as p, ln(w1 / w0) as log_odds from levels),
scored as (select r.*, s.p from rows r join scores s using (large) where is_test)
"""


def levels(t: Tables):
    """Lines with one two-valued feature, staged with their split, and the model of the training rows."""
    lines = t.given("lineitem").dropna(subset=["l_quantity", "l_extendedprice"])
    rows = lines.select(
        "l_orderkey",
        "l_linenumber",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
        (F.col("l_quantity") >= 25).cast("int").alias("large"),
        (F.col("l_extendedprice") > 30000).cast("int").alias("dear"),
        F.lit("all").alias("kind"),
        F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")).alias("event"),
    )
    rows = stage(model.stratified_split(rows, "line", "dear"), "levels")
    fit = model.fit_logit(rows.filter(~F.col("is_test")), "dear", ["large"], ["kind"], penalty=0.0)
    return fit, rows.filter("is_test")


@query(
    "ml6_level_metrics",
    LEVELS_SQL
    + """, c as (select count_if(dear = 1 and p > 0.5) as tp, count_if(dear = 0 and p > 0.5) as fp,
                    count_if(dear = 1 and p <= 0.5) as fn, count_if(dear = 0 and p <= 0.5) as tn from scored)
         select 'ROC-AUC' as metric, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 4) as value from c
         union all select 'Precision', round(tp / (tp + fp), 4) from c
         union all select 'Recall', round(tp / (tp + fn), 4) from c
         union all select 'F1', round(2 * tp / (2 * tp + fp + fn), 4) from c""",
)
def level_metrics(t: Tables):
    fit, test = levels(t)
    scored = model.score(fit, test)
    return rounded(model.binary_metrics(scored, "dear", "delay_probability", "predicted_delayed"), 4)


@query(
    "ml7_level_scores",
    LEVELS_SQL
    + """select l_orderkey, l_linenumber, dear, round(p, 4) as probability, (p > 0.5)::int as predicted
         from scored""",
)
def level_scores(t: Tables):
    fit, test = levels(t)
    return rounded(
        model.score(fit, test).select(
            "l_orderkey",
            "l_linenumber",
            "dear",
            F.col("delay_probability").alias("probability"),
            F.col("predicted_delayed").alias("predicted"),
        ),
        4,
    )


@query(
    "ml11_level_coefficient",
    LEVELS_SQL
    + """select 'numeric__large' as feature, round(c, 3) as coefficient, round(abs(c), 3) as absolute_coefficient
         from (select (select log_odds from scores where large = 1) - (select log_odds from scores where large = 0)
                 as gap, (select stddev_pop(large) from train) as sd), lateral (select gap * sd as c)""",
)
def level_coefficient(t: Tables):
    """The coefficient of the scaled feature."""
    fit, test = levels(t)
    table = model.coefficients(fit, test, ["large"])
    return rounded(table.filter(F.col("feature") == "numeric__large"), 3)


@query(
    "ml12_level_bands",
    LEVELS_SQL
    + """select case when p <= 0.3 then 'Low Risk' when p <= 0.6 then 'Medium Risk' else 'High Risk' end
                  as risk_band,
               count(*) as lines, sum(dear) as dear, round(avg(p), 4) as avg_probability
         from scored group by 1""",
)
def level_bands(t: Tables):
    fit, test = levels(t)
    return rounded(
        model.score_and_band(fit, test)
        .groupBy("risk_band")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("dear").alias("dear"),
            F.avg("delay_probability").alias("avg_probability"),
        ),
        4,
    )


@query(
    "ml6_balanced_weights",
    """with o as (select o_orderkey, (o_orderstatus = 'F')::int as label from orders)
       select o_orderkey, label, round(count(*) over () / (2.0 * count(*) over (partition by label)), 6)
                as weight from o""",
)
def balanced_weights(t: Tables):
    orders = t.given("orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label")
    )
    return rounded(model.balanced_weights(orders, "label"))


@query("ml7_scores")
def scores(t: Tables):
    fit, test = fitted(t)
    return model.score(fit, test).select(
        "visit_id", TARGET, "delay_probability", "predicted_delayed"
    )


@query(
    "ml8_binary_metrics",
    "with " + SCORED_SQL
    + """, auc as (
           select (sum(case when actual_delayed = 1 then r end) - any_value(n1) * (any_value(n1) + 1) / 2)
                  / (any_value(n1) * any_value(n0)) as value
           from (select *, rank() over (order by delay_probability)
                          + (count(*) over (partition by delay_probability) - 1) / 2 as r,
                        sum(actual_delayed) over ()::double as n1,
                        sum(1 - actual_delayed) over ()::double as n0 from scored)),
         c as (select count_if(actual_delayed = 1 and predicted_delayed = 1) as tp,
                      count_if(actual_delayed = 0 and predicted_delayed = 1) as fp,
                      count_if(actual_delayed = 1 and predicted_delayed = 0) as fn from scored)
         select 'ROC-AUC' as metric, round(value, 6) as value from auc
         union all select 'Precision', round(tp / (tp + fp), 6) from c
         union all select 'Recall', round(tp / (tp + fn), 6) from c
         union all select 'F1', round(2 * tp / (2 * tp + fp + fn), 6) from c""",
)
def binary_metrics(t: Tables):
    return rounded(
        model.binary_metrics(
            scored_lines(t), "actual_delayed", "delay_probability", "predicted_delayed"
        )
    )


_CONFUSION_SQL = """c as (select count_if(quality = 0 and toxic = 0) as tn,
            count_if(quality = 0 and toxic = 1) as fp, count_if(quality = 1 and toxic = 0) as fn,
            count_if(quality = 1 and toxic = 1) as tp from labels)
"""


@query(
    "ml9_confusion",
    "with " + _CONFUSION_SQL
    + """select 'Actual On-Time' as actual, tn::bigint as "Predicted On-Time",
               fp::bigint as "Predicted Delayed" from c
         union all select 'Actual Delayed', fn::bigint, tp::bigint from c""",
)
def confusion(t: Tables):
    return model.confusion(t.given("labels"), "quality", "toxic")


@query(
    "ml10_class_report",
    "with " + _CONFUSION_SQL
    + """, m as (select *, tn / (tn + fn) as p0, tn / (tn + fp) as r0, 2 * tn / (2 * tn + fn + fp) as f0,
                  (tn + fp)::double as s0,
                  case when tp + fp = 0 then 0 else tp / (tp + fp) end as p1, tp / (tp + fn) as r1,
                  2 * tp / (2 * tp + fp + fn) as f1, (tp + fn)::double as s1,
                  (tn + tp) / (tn + fp + fn + tp) as acc from c)
         select '0' as label, round(p0, 6) as precision, round(r0, 6) as recall,
                round(f0, 6) as f1_score, round(s0, 6) as support from m
         union all select '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 from m
         union all select 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), round(acc, 6) from m
         union all select 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6),
                round((f0 + f1) / 2, 6), s0 + s1 from m
         union all select 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6),
                round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                round((f0 * s0 + f1 * s1) / (s0 + s1), 6), s0 + s1 from m""",
)
def class_report(t: Tables):
    return rounded(model.class_report(t.given("labels"), "quality", "toxic"))


@query("ml11_coefficients")
def coefficients(t: Tables):
    fit, test = fitted(t)
    return model.coefficients(fit, test, NUMERIC)


@query("ml12_scored_visits")
def scored_visits(t: Tables):
    fit, test = fitted(t)
    return model.score_and_band(fit, test)


@query("ml13_model_band_summary")
def model_band_summary(t: Tables):
    """Summary per risk band of the fitted model's scores."""
    fit, test = fitted(t)
    scored = model.score_and_band(fit, test).withColumn("actual_delayed", F.col(TARGET))
    return kpi.band_summary(scored)


@query(
    "ml13_band_summary",
    "with " + SCORED_SQL
    + """select risk_band, count(*) as visits, round(avg(actual_delayed), 6) as actual_delay_rate,
               round(avg(delay_probability), 6) as avg_predicted_probability
         from scored where actual_delayed is not null group by risk_band""",
)
def band_summary(t: Tables):
    return rounded(kpi.band_summary(scored_lines(t).dropna(subset=["actual_delayed"])))
