"""Joins (JN), ordered lists (SRT), row append and sampling (SET)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bayline.operators import joins, ordering, sampling
from bayline.operators.features import customer_rollup_v1
from bayline.plans.binding import Tables, with_roles
from bayline.plans.registry import query, rounded

# ---- joins -----------------------------------------------------------------------------


@query(
    "jn1_attach_parent",
    with_roles("visits", "appointments")
    + """select visit_id, appointment_id, delay_hours, customer_id, service_type
         from visits left join appointments using (appointment_id)""",
)
def attach_parent(t: Tables):
    fact = t.visits.select("visit_id", "appointment_id", "delay_hours")
    return joins.attach_parent(
        fact, t.appointments, "appointment_id", ["customer_id", "service_type"]
    )


@query(
    "jn2_attach_optional",
    with_roles("visits", "surveys")
    + """select v.visit_id, delay_hours, csat_score, complaint_flag
         from visits v left join surveys s on v.visit_id = s.visit_id""",
)
def attach_optional(t: Tables):
    fact = t.visits.select("visit_id", "delay_hours")
    return joins.attach_optional(fact, t.surveys, "visit_id", ["csat_score", "complaint_flag"])


@query(
    "jn3_attach_dimension",
    with_roles("repairs", "visits", "raw_dealers")
    + """select l_orderkey, l_linenumber, l_suppkey as dealer_id, dealer_name, region
         from lineitem left join raw_dealers on l_suppkey = dealer_id""",
)
def attach_dimension(t: Tables):
    fact = t.given("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("dealer_id")
    )
    return joins.attach_dim(fact, t.raw["dealers"].drop("balance"), "dealer_id")


@query(
    "jn4_expand_children",
    """select o_orderkey, o_custkey, l_partkey, l_quantity
       from orders left join lineitem on o_orderkey = l_orderkey""",
)
def expand_children(t: Tables):
    parent = t.given("orders").select("o_orderkey", "o_custkey")
    child = t.given("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity"
    )
    return joins.expand_children(parent, child, "o_orderkey")


@query(
    "jn5_attach_aggregate",
    """select o_orderkey, o_custkey, n, round(spent, 4) as spent
       from orders left join (select o_custkey, count(*) as n, sum(o_totalprice) as spent
                              from orders group by o_custkey) using (o_custkey)""",
)
def attach_aggregate(t: Tables):
    orders = t.given("orders").select("o_orderkey", "o_custkey")
    totals = (
        t.given("orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 4).alias("spent"))
    )
    return joins.attach_agg(orders, totals, "o_custkey")


@query(
    "jn6_keep_valid",
    with_roles("appointments", "clean_customers")
    + """select appointment_id, customer_id from appointments
         where customer_id in (select customer_id from clean_customers)""",
)
def keep_valid(t: Tables):
    child = t.appointments.select("appointment_id", "customer_id")
    return joins.keep_valid(child, "customer_id", t.raw["customers"], "customer_id")


@query(
    "jn7_orphans",
    with_roles("appointments", "clean_customers")
    + """select appointment_id, customer_id from appointments
         where customer_id not in (select customer_id from clean_customers)""",
)
def orphans(t: Tables):
    child = t.appointments.select("appointment_id", "customer_id")
    return joins.orphans(child, "customer_id", t.raw["customers"], "customer_id")


@query(
    "jn8_lookup_key",
    """select l_orderkey as order_id, l_linenumber, o_custkey
       from lineitem join orders on l_orderkey = o_orderkey""",
)
def lookup_key(t: Tables):
    lines = t.given("lineitem").select(F.col("l_orderkey").alias("order_id"), "l_linenumber")
    ref = t.given("orders").withColumnRenamed("o_orderkey", "order_id")
    return joins.lookup_key(lines, ref, "order_id", "o_custkey")


@query(
    "jn9_alias_join",
    with_roles("visits", "appointments", "dealers", "customers")
    + """select c.customer_id, c.region, a.appointment_id, d.region as dealer_region, d.dealer_id
         from appointments a
         join visits v using (appointment_id)
         join customers c using (customer_id)
         left join dealers d on d.dealer_id = v.dealer_id""",
)
def alias_join(t: Tables):
    fact = t.appointments.join(t.visits.select("appointment_id", "dealer_id"), "appointment_id")
    fact = fact.join(t.customers, "customer_id").select(
        "customer_id", "region", "appointment_id", "dealer_id"
    )
    dealers = t.dealers.select("dealer_id", "region")
    return joins.alias_join(fact, dealers, "dealer_id", "dealer_")


# ---- ordered lists ---------------------------------------------------------------------

_BY_CUSTOMER = """, spend as (select o_custkey, count(*) as n, sum(o_totalprice) as spent,
                  min(o_orderdate) as first_order from orders group by o_custkey)
"""


def _spend(t: Tables):
    return (
        t.given("orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("o_totalprice").alias("spent"),
            F.min("o_orderdate").alias("first_order"),
        )
    )


@query(
    "srt1_priority_list",
    with_roles("features_v1")
    + """select customer_id, round(complaint_rate, 6) as complaint_rate,
               round(delay_rate, 6) as delay_rate, round(avg_csat, 6) as avg_csat
         from features_v1
         order by complaint_rate desc nulls last, delay_rate desc, avg_csat, customer_id""",
)
def priority_list(t: Tables):
    features = rounded(customer_rollup_v1(t.base)).select(
        "customer_id", "complaint_rate", "delay_rate", "avg_csat"
    )
    return ordering.priority_list(
        features,
        [("complaint_rate", "desc"), ("delay_rate", "desc"), ("avg_csat", "asc")],
        "customer_id",
    )


@query(
    "srt2_top1",
    "with x as (select 1)" + _BY_CUSTOMER
    + "select o_custkey, n from spend order by n desc, o_custkey limit 1",
)
def top1(t: Tables):
    return ordering.top1(_spend(t), [("n", "desc")], "o_custkey").select("o_custkey", "n")


@query(
    "srt3_top1_excluding",
    "with x as (select 1)" + _BY_CUSTOMER
    + """select o_custkey, n, first_order from spend
         where o_custkey <> (select o_custkey from spend order by n desc, o_custkey limit 1)
         order by n desc, first_order, o_custkey limit 1""",
)
def top1_excluding(t: Tables):
    spend = _spend(t)
    winner = ordering.argmax(spend, "n", "o_custkey").scalar()
    best = ordering.top1(
        spend,
        [("n", "desc"), ("first_order", "asc")],
        "o_custkey",
        exclude=F.col("o_custkey") == winner,
    )
    return best.select("o_custkey", "n", "first_order")


@query(
    "srt4_argmax",
    with_roles("visits")
    + """select part_id from (select part_id, count(*) as n from visits group by part_id)
         order by n desc, part_id limit 1""",
)
def argmax(t: Tables):
    counts = t.visits.groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))
    return ordering.argmax(counts, "n", "part_id")


@query(
    "srt5_top_n",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 15",
)
def top_n(t: Tables):
    orders = t.given("orders").select("o_orderkey", "o_totalprice")
    return ordering.top_n(orders, [("o_totalprice", "desc")], "o_orderkey", 15)


@query(
    "srt6_by_magnitude",
    with_roles("visits")
    + "select visit_id, delay_hours from visits order by abs(delay_hours) desc, visit_id",
)
def by_magnitude(t: Tables):
    return ordering.by_magnitude(t.visits.select("visit_id", "delay_hours"), "delay_hours", "visit_id")


# ---- row append and samples ------------------------------------------------------------


@query(
    "set1_union_all",
    """select c_custkey as key, 'customer' as source from customer
       union all select s_suppkey, 'dealer' from supplier""",
)
def union_all(t: Tables):
    customers = t.given("customer").select(F.col("c_custkey").alias("key"), F.lit("customer").alias("source"))
    dealers = t.given("supplier").select(F.col("s_suppkey").alias("key"), F.lit("dealer").alias("source"))
    return sampling.union_all(customers, dealers)


@query(
    "set2_sample_n",
    """select o_orderkey, o_custkey from orders
       order by ('0x' || substr(md5('visits:' || o_orderkey), 1, 8))::ubigint, o_orderkey
       limit 500""",
)
def sample_n(t: Tables):
    return sampling.sample_n(t.given("orders"), "o_orderkey", 500, "visits").select(
        "o_orderkey", "o_custkey"
    )


# Poisson(1) distribution function at 0..12, as the weights are defined
_POISSON_SQL = """
steps as (select k, exp(-1) * sum(1.0::double / factorial(k::int)::double) over (order by k) as bound
          from range(13) r(k)),
draws as (
  select o_orderkey, block, part,
         ('0x' || substr(md5('draw:' || o_orderkey || ':' || block), 8 * part + 1, 8))::ubigint
           / 4294967296.0 as u
  from orders, range(5) b(block), range(4) p(part)),
weights as (
  select o_orderkey, 4 * block + part as replicate,
         (select count(*) from steps where draws.u >= bound) as weight
  from draws)
"""


@query(
    "set3_bootstrap_weights",
    "with " + _POISSON_SQL
    + """select replicate::int as replicate, count(*) as distinct_rows,
               sum(weight)::bigint as drawn_rows, round(sum(weight * o_totalprice), 2) as total
         from weights join orders using (o_orderkey) where weight > 0
         group by replicate""",
)
def bootstrap_weights(t: Tables):
    weighted = sampling.bootstrap_weights(
        t.given("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 20, "draw"
    )
    return weighted.groupBy("replicate").agg(
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum("weight").alias("drawn_rows"),
        F.round(F.sum(F.col("weight") * F.col("o_totalprice")), 2).alias("total"),
    )
