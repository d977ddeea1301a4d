"""Queries: aggregates, windows and dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import aggregates as agg
from wayline.operators import ranking
from wayline.operators import windows as win
from wayline.workload import model_sql as sql
from wayline.workload.registry import query


def _n():
    return F.count(F.lit(1))



@query("agg_group_all", """
select l_returnflag, l_linestatus, cast(sum(cast(l_extendedprice as decimal(14,2))) as double) as price,
  count(*) as n from {lineitem} group by all""")
def _(t):
    return agg.agg_group_all(t["lineitem"], ["l_returnflag", "l_linestatus"],
                             price=F.sum(F.col("l_extendedprice").cast("decimal(14,2)")), n=_n())


@query("agg_count_if", """
select l_suppkey, count(*) filter (l_returnflag = 'R') as returned, count(*) filter (l_quantity >= 25) as large
from {lineitem} group by 1""")
def _(t):
    return agg.agg_count_if(t["lineitem"], ["l_suppkey"], returned=F.col("l_returnflag") == "R",
                            large=F.col("l_quantity") >= 25)


@query("agg_count_distinct", "select l_suppkey, count(distinct l_partkey) as parts from {lineitem} group by 1")
def _(t):
    return agg.agg_count_distinct(t["lineitem"], ["l_suppkey"], "parts", "l_partkey")


@query("agg_count_distinct_if", """
select o_orderpriority, count(distinct case when o_orderstatus <> 'P' then o_custkey end) as users
from {orders} group by 1""")
def _(t):
    return agg.agg_count_distinct_if(t["orders"], ["o_orderpriority"], "users", "o_custkey",
                                     F.col("o_orderstatus") != "P")


@query("agg_conditional_sum_avg", """
select l_suppkey, cast(sum(case when l_returnflag = 'N' then l_linenumber else 0 end) as bigint) as total,
  round(cast(sum(case when l_returnflag = 'N' then l_linenumber end) as double)
        / count(case when l_returnflag = 'N' then l_linenumber end), 6) as mean from {lineitem} group by 1""")
def _(t):
    return agg.agg_conditional_sum_avg(t["lineitem"], ["l_suppkey"], "l_linenumber", F.col("l_returnflag") == "N")


@query("agg_min_max", """
select o_custkey, min(o_orderdate) as first_value, max(o_orderdate) as last_value, count(*) as row_count
from {orders} group by 1""")
def _(t):
    return agg.agg_min_max(t["orders"], ["o_custkey"], "o_orderdate")


@query("agg_safe_ratio", f"""
select l_suppkey, {sql.div("count(*) filter (l_returnflag = 'R')", "count(*) filter (l_quantity > 49)", 4)} as ratio,
  {sql.div('count(*)', 'count(*) filter (l_quantity > 50)', 4)} as none from {{lineitem}} group by 1""")
def _(t):
    from wayline.functions import agg_safe_ratio
    many = F.count_if(F.col("l_quantity") > 49)
    return agg.agg_group_all(t["lineitem"], ["l_suppkey"],
                             ratio=agg_safe_ratio(F.count_if(F.col("l_returnflag") == "R"), many, 4),
                             none=agg_safe_ratio(_n(), F.count_if(F.col("l_quantity") > 50), 4))


@query("agg_weighted_average", """
select p_type, round(cast(sum(cast(p_retailprice as decimal(12,2)) * p_size) as double) / sum(p_size), 6)
  as weighted_mean from {part} group by 1""")
def _(t):
    rows = t["part"].withColumn("price", F.col("p_retailprice").cast("decimal(12,2)"))
    return agg.agg_weighted_average(rows, ["p_type"], "price", "p_size")


@query("agg_ratio_rollup", """
with fine as (select l_suppkey, l_linenumber, count(*) as n, count(*) filter (l_returnflag = 'R') as r
              from {lineitem} group by all)
select l_suppkey, round(cast(sum(r) as double) / sum(n), 6) as rate from fine group by 1""")
def _(t):
    fine = agg.agg_group_all(t["lineitem"], ["l_suppkey", "l_linenumber"], n=_n(),
                             r=F.count_if(F.col("l_returnflag") == "R"))
    return agg.agg_ratio_rollup(fine, ["l_suppkey"], F.col("r"), F.col("n"))


@query("agg_array_ordered", """
select o_custkey, string_agg(o_orderpriority, ',' order by o_orderpriority) as priorities from {orders} group by 1""")
def _(t):
    return agg.agg_array_ordered(t["orders"], ["o_custkey"], "o_orderpriority", "priorities")


@query("agg_having", """
select o_custkey, count(*) as n from {orders} group by 1 having count(*) >= 10""")
def _(t):
    return agg.agg_having(agg.agg_group_all(t["orders"], ["o_custkey"], n=_n()), F.col("n") >= 10)


@query("agg_distinct_rows", "select distinct l_returnflag, l_linestatus, l_linenumber from {lineitem}")
def _(t):
    return agg.agg_distinct_rows(t["lineitem"], ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("agg_arg_min", """
select o_custkey, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) as first_status from {orders} group by 1""")
def _(t):
    return agg.agg_arg_min(t["orders"], ["o_custkey"], "o_orderstatus", ["o_orderdate", "o_orderkey"], "first_status")


@query("agg_bool_or", """
select o_custkey, bool_or(o_orderstatus = 'P') as any_pending from {orders} group by 1""")
def _(t):
    return agg.agg_bool_or(t["orders"], ["o_custkey"], F.col("o_orderstatus") == "P", "any_pending")


@query("agg_median_quantile", """
select l_suppkey, median(l_quantity) as med, round(quantile_cont(l_quantity, 0.97), 6) as p97
from {lineitem} group by 1""")
def _(t):
    stats = ranking.agg_median_quantile(t["lineitem"], ["l_suppkey"], "l_quantity", {"med": 0.5, "p97": 0.97})
    return stats.withColumn("p97", F.round("p97", 6))


@query("agg_multi_level", """
with per_user as (select o_custkey, count(*) as orders, min(o_orderdate) as first from {orders} group by 1)
select cast(year(first) as integer) as cohort, count(*) as users, cast(sum(orders) as bigint) as orders
from per_user group by 1""")
def _(t):
    return agg.agg_multi_level(
        t["orders"], ["o_custkey"], {"orders": _n(), "first": F.min("o_orderdate")},
        [F.year("first").alias("cohort")], {"users": _n(), "orders": F.sum("orders")})


@query("agg_global", """
select count(*) as n, count(distinct o_custkey) as users, min(o_orderdate) as first,
  cast(sum(cast(o_totalprice as decimal(14,2))) as double) as value from {orders}""")
def _(t):
    return agg.agg_global(t["orders"], n=_n(), users=F.countDistinct("o_custkey"), first=F.min("o_orderdate"),
                          value=F.sum(F.col("o_totalprice").cast("decimal(14,2)")))


@query("agg_share_of_total", """
with y as (select l_linenumber, count(*) filter (l_returnflag = 'R') as r, count(*) filter (l_returnflag = 'A') as a,
             count(*) filter (l_returnflag = 'N') as n from {lineitem} group by 1)
select *, round(cast(r as double) / (r + a + n), 6) as r_share, round(cast(a as double) / (r + a + n), 6) as a_share,
  round(cast(n as double) / (r + a + n), 6) as n_share from y""")
def _(t):
    flags = agg.agg_count_if(t["lineitem"], ["l_linenumber"],
                             **{k.lower(): F.col("l_returnflag") == k for k in ("R", "A", "N")})
    return agg.agg_share_of_total(flags, ["r", "a", "n"])


# --- windows and dedup --------------------------------------------------------------------------

_TIES = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
_LINE = "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice"
_TIE_SQL = ", ".join(f"{c} desc nulls first" for c in _TIES)


@query("dedup_latest", f"""
select {_LINE} from {{lineitem}}
qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc nulls first, {_TIE_SQL}) = 1
""")
def _(t):
    return win.dedup_latest(t["lineitem"], ["l_orderkey", "l_linenumber"], "l_shipdate", _TIES).select(
        *_LINE.split(", "))


@query("dedup_latest_two_keys", f"""
with x as (select *, nullif(l_linestatus, 'O') as status from {{lineitem}})
select {_LINE}, status from x qualify row_number() over (partition by l_orderkey, l_linenumber
  order by status desc nulls first, l_shipdate desc nulls first, {_TIE_SQL}) = 1""")
def _(t):
    rows = t["lineitem"].withColumn("status", F.nullif("l_linestatus", F.lit("O")))
    return win.dedup_latest_two_keys(rows, ["l_orderkey", "l_linenumber"], "status", "l_shipdate", _TIES).select(
        *_LINE.split(", "), "status")


@query("dedup_priority", """
select p_brand, p_partkey, p_type from {part} qualify row_number() over (partition by p_brand
  order by p_size > 25 desc nulls first, case p_type when 'LARGE' then 1 when 'MEDIUM' then 2 else 9 end, p_partkey) = 1
""")
def _(t):
    from wayline.functions import project_decode
    rank = project_decode(F.col("p_type"), {"LARGE": 1, "MEDIUM": 2}, 9)
    return win.dedup_priority(t["part"], ["p_brand"], [(F.col("p_size") > 25).desc_nulls_first(), rank.asc(),
                                                       F.col("p_partkey").asc()]).select(
        "p_brand", "p_partkey", "p_type")


@query("dedup_distinct_on", """
select distinct on (o_custkey) o_custkey, o_orderkey, o_orderdate from {orders}
order by o_custkey, o_orderdate desc, o_orderkey""")
def _(t):
    return win.dedup_distinct_on(t["orders"], ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(),
                                                              F.col("o_orderkey").asc()]).select(
        "o_custkey", "o_orderkey", "o_orderdate")


@query("window_top_n_per_group", """
select l_suppkey, l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice from {lineitem} qualify
row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_shipdate,
                   l_partkey) <= 5""")
def _(t):
    order = [F.col("l_extendedprice").desc(), *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_shipdate",
                                                                   "l_partkey")]]
    return win.window_top_n_per_group(t["lineitem"], ["l_suppkey"], order, 5).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")


@query("window_row_number_id", """
select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as row_id from {orders}""")
def _(t):
    return ranking.window_row_number_id(t["orders"].select("o_orderkey", "o_orderdate"),
                                        [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]).select(
        "o_orderkey", "row_id")


@query("window_named_count", """
select event_id, event_type, row_number() over (p order by value desc, event_id) as rn, count(*) over p as cnt
from {events} window p as (partition by event_type)""")
def _(t):
    return ranking.window_named_count(t["events"].select("event_id", "event_type", "value"), ["event_type"],
                                      [F.col("value").desc(), F.col("event_id").asc()]).drop("value")


@query("window_forward_fill", """
select o_custkey, o_orderdate, o_orderkey,
  last_value(case when o_orderstatus = 'F' then o_totalprice end ignore nulls) over (partition by o_custkey
    order by o_orderdate, o_orderkey rows between unbounded preceding and current row) as known
from {orders}""")
def _(t):
    orders = t["orders"].select("o_custkey", "o_orderdate", "o_orderkey", F.when(
        F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("known"))
    return win.window_forward_fill(orders, ["o_custkey"], "o_orderdate", ["known"], ["o_orderkey"])
