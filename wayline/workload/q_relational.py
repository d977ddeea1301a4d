"""Queries: joins, sorting, sets, reshaping, generator operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wayline import functions as fn
from wayline.operators import relational as rel
from wayline.operators import travel
from wayline.workload import model_sql as sql
from wayline.workload.q_columns import u_sql
from wayline.workload.registry import query

# --- joins --------------------------------------------------------------------------------------


@query("join_inner_equi", """
select o_orderkey, c_mktsegment from {orders} join {customer} on c_custkey = o_custkey""")
def _(t):
    customers = t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return rel.join_inner_equi(t["orders"], customers, "o_custkey").select("o_orderkey", "c_mktsegment")


@query("join_left_dim", """
select l_orderkey, l_linenumber, l_shipdate, l_partkey, s_name, n_name from {lineitem}
left join {supplier} on s_suppkey = l_suppkey left join {nation} on n_nationkey = s_nationkey""")
def _(t):
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    nations = t["nation"].select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    joined = rel.join_left_dim(rel.join_left_dim(t["lineitem"], suppliers, "l_suppkey"), nations, "s_nationkey")
    return joined.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "s_name", "n_name")


@query("join_multi_key_fx", """
select s.stay_booking_id, s._source_file, s.currency_code, cast(f.usd_per_unit as double) as usd_per_unit
from {raw_stay_bookings} s left join {fx_rates} f
  on f.currency_code = s.currency_code and f.rate_date = cast(substr(s.booked_at, 1, 10) as date)""")
def _(t):
    day = fn.cast_try_date(F.substring("booked_at", 1, 10))
    return rel.join_multi_key_fx(t["raw_stay_bookings"], t["fx_rates"], "currency_code", day).select(
        "stay_booking_id", "_source_file", "currency_code", "usd_per_unit")


@query("join_self", """
select a.c_custkey, a.c_name, b.c_name as parent_name from {customer} a
left join {customer} b on b.c_custkey = case when a.c_custkey % 5 > 0 then a.c_custkey - 1 end""")
def _(t):
    parent = F.when(F.col("c_custkey") % 5 > 0, F.col("c_custkey") - 1)
    return rel.join_self(t["customer"].withColumn("parent", parent), "c_custkey", "parent",
                         {"c_name": "parent_name"}).select("c_custkey", "c_name", "parent_name")


@query("join_using", """
select doc_id, source, quality, toxic from {documents} join {labels} using (doc_id)""")
def _(t):
    return rel.join_using(t["documents"].select("doc_id", "source"), t["labels"], ["doc_id"])


@query("join_latest_snapshot", """
select c.city, c.snapshot_date, c.listing_id, c.calendar_date from {raw_calendar} c
where c.snapshot_date = (select max(x.snapshot_date) from {raw_calendar} x where x.city = c.city)""")
def _(t):
    return rel.join_latest_snapshot(t["raw_calendar"], ["city"], "snapshot_date").select(
        "city", "snapshot_date", "listing_id", "calendar_date")


@query("join_residual_predicate", """
select o_orderkey, l_linenumber, l_shipdate, l_quantity from {orders}
left join {lineitem} on l_orderkey = o_orderkey and l_returnflag = 'R'""")
def _(t):
    lines = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate", "l_quantity",
                                 "l_returnflag")
    return rel.join_residual_predicate(t["orders"], lines, "o_orderkey", F.col("l_returnflag") == "R", "left").select(
        "o_orderkey", "l_linenumber", "l_shipdate", "l_quantity")


@query("join_three_way_chain", """
select c_mktsegment, p_type, count(*) as n, count(distinct o_orderkey) as orders from {lineitem}
join {orders} on o_orderkey = l_orderkey join {customer} on c_custkey = o_custkey
join {part} on p_partkey = l_partkey group by all""")
def _(t):
    joined = rel.join_three_way_chain(
        [t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey")),
         t["orders"].select("o_orderkey", F.col("o_custkey").alias("c_custkey")),
         t["customer"].select("c_custkey", "c_mktsegment"), t["part"].select("p_partkey", "p_type")],
        ["o_orderkey", "c_custkey", "p_partkey"])
    return joined.groupBy("c_mktsegment", "p_type").agg(F.count(F.lit(1)).alias("n"),
                                                        F.countDistinct("o_orderkey").alias("orders"))


@query("join_null_tolerant_or", """
select r.listing_id, r.snapshot_date, m.metro_key from {raw_listings} r
left join {city_airports} m
  on m.city = r.city and (m.neighbourhood_group is null or m.neighbourhood_group = r.neighbourhood_group_cleansed)""")
def _(t):
    listings = t["raw_listings"].select("listing_id", "snapshot_date", "city",
                                        F.col("neighbourhood_group_cleansed").alias("neighbourhood_group"))
    return rel.join_null_tolerant_or(listings, t["city_airports"], "city", "neighbourhood_group",
                                     ["metro_key"]).select("listing_id", "snapshot_date", "metro_key")


@query("join_semi_exists", """
select o_orderkey, o_custkey from {orders} o
where exists (select 1 from {lineitem} l where l.l_orderkey = o.o_orderkey and l.l_returnflag = 'A')""")
def _(t):
    returned = t["lineitem"].filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    return rel.join_semi_exists(t["orders"], returned, "o_orderkey").select("o_orderkey", "o_custkey")


@query("join_anti_not_exists", """
select doc_id, lang from {documents} d where not exists (select 1 from {labels} l where l.doc_id = d.doc_id)""")
def _(t):
    return rel.join_anti_not_exists(t["documents"], t["labels"], "doc_id").select("doc_id", "lang")


@query("join_cross_values", """
select o_orderkey, leg from {orders} cross join (values ('outbound'), ('return')) v(leg)""")
def _(t):
    return rel.join_cross_values(t["orders"].select("o_orderkey"), "leg", ["outbound", "return"])


# requests: orders of a customer's region; candidates: suppliers of that region on a weekday
_REQ = """select o_orderkey, r_name as area, cast(o_orderkey % 7 as integer) as slot from {orders}
  join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey
  join {region} on r_regionkey = n_regionkey"""
_CAND = """select r_name as area, cast(s_suppkey % 8 as integer) as slot, s_suppkey from {supplier}
  join {nation} on n_nationkey = s_nationkey join {region} on r_regionkey = n_regionkey"""
_PICK = f"""with req as ({_REQ}),
cand as (select *, row_number() over (p order by s_suppkey desc) as rn, count(*) over p as cnt from ({_CAND})
         window p as (partition by area, slot)),
picked as (select o_orderkey, area, slot, s_suppkey, rn from req join cand using (area, slot)
           where rn = 1 + cast(floor({u_sql('o_orderkey', 'pick')} * cnt) as bigint))"""


def _trips(t):
    region = t["nation"].join(t["region"], F.col("r_regionkey") == F.col("n_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("area"))
    requests = (t["orders"].join(t["customer"], F.col("c_custkey") == F.col("o_custkey"))
                .join(region, F.col("n_nationkey") == F.col("c_nationkey"))
                .select("o_orderkey", "area", (F.col("o_orderkey") % 7).cast("int").alias("slot")))
    candidates = t["supplier"].join(region, F.col("n_nationkey") == F.col("s_nationkey")).select(
        "area", (F.col("s_suppkey") % 8).cast("int").alias("slot"), "s_suppkey")
    return requests, candidates


@query("join_nth_candidate", _PICK + " select o_orderkey, area, slot, s_suppkey, rn from picked")
def _(t):
    requests, candidates = _trips(t)
    return rel.join_nth_candidate(requests, candidates, ["area", "slot"], [F.col("s_suppkey").desc()],
                                  "o_orderkey", "pick").select("o_orderkey", "area", "slot", "s_suppkey", "rn")


@query("route_match", _PICK + """
select (select count(*) from req) as requested, (select count(*) from picked) as matched,
  round(cast((select count(*) from picked) as double) / (select count(*) from req), 6) as match_rate""")
def _(t):
    requests, candidates = _trips(t)
    return travel.route_match(requests, candidates, ["area", "slot"], [F.col("s_suppkey").desc()], "o_orderkey",
                              "pick")[1]


@query("join_conditional_aliases", """
select airport_ident, iata_code from {stg_airports} where iata_code is not null union all
select c.airport_ident, a.iata_code from {airport_code_aliases} a
join {stg_airports} c on c.airport_ident = a.airport_ident""")
def _(t):
    return rel.join_conditional_aliases(t["stg_airports"].select("airport_ident", "iata_code"),
                                        t["airport_code_aliases"], "airport_ident", "iata_code")


@query("join_scalar_subqueries", """
select (select count(*) from {orders}) as orders, (select max(l_shipdate) from {lineitem}) as last_ship,
  (select count(*) from {customer} where c_custkey < 0) as nobody, (select min(c_name) from {customer}) as first_name""")
def _(t):
    one = F.count(F.lit(1))
    return rel.join_scalar_subqueries([
        t["orders"].agg(one.alias("orders")), t["lineitem"].agg(F.max("l_shipdate").alias("last_ship")),
        t["customer"].filter("c_custkey < 0").agg(one.alias("nobody")),
        t["customer"].agg(F.min("c_name").alias("first_name"))])


# --- sorting, sets, reshaping -------------------------------------------------------------------

@query("sort_result", "select c_custkey, c_mktsegment from {customer} order by 2, 1 desc")
def _(t):
    return rel.sort_result(t["customer"].select("c_custkey", "c_mktsegment"),
                           [F.col("c_mktsegment").asc_nulls_last(), F.col("c_custkey").desc()])


@query("topk_limit", """
select o_custkey, count(*) as n from {orders} group by 1 order by n desc, o_custkey limit 60""")
def _(t):
    counted = t["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return rel.topk_limit(counted, [F.col("n").desc(), F.col("o_custkey")], 60)


@query("topk_hash_sample", """
select doc_id, lang from {documents}
order by cast('0x' || substr(md5(cast(doc_id as varchar) || '|draw|42'), 1, 15) as bigint), doc_id limit 100""")
def _(t):
    return rel.topk_hash_sample(t["documents"].select("doc_id", "lang"), "doc_id", 100, "draw")


@query("limit_rows_cap", """
select o_orderkey, o_totalprice from {orders} order by o_totalprice desc, o_orderkey limit 500""")
def _(t):
    return rel.limit_rows_cap(t["orders"].select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey"))


@query("set_union_all", """
select 'c' as kind, c_nationkey as nation, c_acctbal as balance from {customer} union all
select 's', s_nationkey, s_acctbal from {supplier} union all
select 's', s_nationkey, s_acctbal from {supplier}""")
def _(t):
    c = t["customer"].select(F.lit("c").alias("kind"), F.col("c_nationkey").alias("nation"),
                             F.col("c_acctbal").alias("balance"))
    s = t["supplier"].select(F.col("s_acctbal").alias("balance"), F.lit("s").alias("kind"),
                             F.col("s_nationkey").alias("nation"))
    return rel.set_union_all([c, s, s])


_TYPES = ["click", "error", "purchase", "view", "nothing"]


@query("pivot_matrix", f"""
with cells as (select cast(ts as date) as day, event_type, cast(sum(cast(value as decimal(12,2))) as double) as v
               from {{events}} group by all)
select day, {', '.join(f"max(v) filter (event_type = '{x}') as {x}" for x in _TYPES)},
  {sql.mean('cast(v as decimal(18,2))', 6)} as row_mean
from (select * from cells where event_type in ({', '.join(f"'{x}'" for x in _TYPES)})) group by day""")
def _(t):
    cells = t["events"].groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(
        F.sum(F.col("value").cast("decimal(12,2)")).alias("v"))
    return rel.pivot_matrix(cells, "day", "event_type", _TYPES, "v")


@query("unpivot_rates", """
select p_partkey, currency_code, usd_per_unit from (
  select p_partkey, 'EUR' as currency_code, p_retailprice as usd_per_unit from {part} union all
  select p_partkey, 'GBP', case when p_size % 3 > 0 then p_retailprice + 1 end from {part} union all
  select p_partkey, 'JPY', case when p_size % 5 > 0 then p_retailprice + 2 end from {part})
where usd_per_unit is not null""")
def _(t):
    wide = t["part"].select("p_partkey", F.col("p_retailprice").alias("EUR"),
                            F.when(F.col("p_size") % 3 > 0, F.col("p_retailprice") + 1).alias("GBP"),
                            F.when(F.col("p_size") % 5 > 0, F.col("p_retailprice") + 2).alias("JPY"))
    return rel.unpivot_rates(wide, "p_partkey", ["EUR", "GBP", "JPY"])


@query("lateral_flatten", "select review_id, unnest(topics) as topic from {enrichments}")
def _(t):
    return rel.lateral_flatten(t["enrichments"], "topics", "topic").select("review_id", "topic")


# --- generator operators --------------------------------------------------------------------------

_PRICE = "case when p_partkey % 9 = 0 then 0 when p_partkey % 10 > 0 then cast(p_retailprice as decimal(12,2)) end"


@query("impute_and_cap", f"""
with src as (select p_partkey, p_brand, cast({_PRICE} as decimal(12,2)) as price from {{part}}),
stats as (select p_brand, median(cast(price as double)) as med, quantile_cont(cast(price as double), 0.97) as cap
          from src where price > 0 group by 1)
select p_partkey, p_brand, round(least(coalesce(nullif(cast(price as double), 0), med), cap), 6) as price_filled
from src join stats using (p_brand)""")
def _(t):
    price = F.when(F.col("p_partkey") % 9 == 0, F.lit(0).cast("decimal(12,2)")).when(
        F.col("p_partkey") % 10 > 0, F.col("p_retailprice").cast("decimal(12,2)"))
    src = t["part"].select("p_partkey", "p_brand", price.cast("double").alias("price"))
    return travel.impute_and_cap(src, ["p_brand"], "price").select(
        "p_partkey", "p_brand", F.round("price_filled", 6).alias("price_filled"))


@query("price_deflate", """
select o_orderkey, round(o_totalprice
    / pow(1 + case when o_custkey % 2 = 0 then 0.05e0 else 0.02e0 end,
          date_diff('day', cast(o_orderdate as date), date '2002-01-01') / 365.25e0)
    * case when month(o_orderdate) in (6, 7, 8) then 1.18e0 when month(o_orderdate) = 12 then 1.1e0
           when month(o_orderdate) in (1, 2) then 0.88e0 else 1e0 end, 4) as price_then from {orders}""")
def _(t):
    growth = F.when(F.col("o_custkey") % 2 == 0, F.lit(0.05)).otherwise(F.lit(0.02))
    rows = t["orders"].withColumn("day", F.col("o_orderdate").cast("date"))
    return travel.price_deflate(rows, "o_totalprice", growth, "day", dt.date(2002, 1, 1)).select(
        "o_orderkey", F.round("price_then", 4).alias("price_then"))


@query("hash_sample_share", f"""
select o_orderkey, o_custkey from {{orders}} where {u_sql('o_orderkey', 'cancel')} < 0.12""")
def _(t):
    return travel.hash_sample_share(t["orders"].select("o_orderkey", "o_custkey"), "o_orderkey", "cancel", 0.12)


@query("fee_breakdown", """
with f as (
  select o_orderkey, o_orderstatus, o_orderkey % 10 as k, 1 + o_orderkey % 14 as nights,
    cast(o_totalprice as decimal(14,2)) as rate from {orders}),
g as (
  select *, cast(round(rate * cast(nights as decimal(2,0)), 2) as decimal(18,2)) as subtotal,
    cast(round(rate * case when k < 5 then cast(0.45 as decimal(4,2)) else cast(0.2 as decimal(4,2)) end, 2)
      as decimal(18,2)) as cleaning from f)
select o_orderkey, cast(subtotal as double) as subtotal, cast(cleaning as double) as cleaning_fee,
  cast(round(cast(0.142 as decimal(4,3)) * (subtotal + cleaning), 2) as double) as service_fee,
  cast(round((subtotal + cleaning) + cast(0.142 as decimal(4,3)) * (subtotal + cleaning), 2) as double) as total_amount,
  case when o_orderstatus = 'P' then cast(round(cast((subtotal + cleaning) + cast(0.142 as decimal(4,3))
    * (subtotal + cleaning) as decimal(24,5)) * case when k % 2 = 0 then cast(1 as decimal(4,2))
    else cast(0.5 as decimal(4,2)) end, 2) as double) end as refund_amount from g""")
def _(t):
    k = F.col("o_orderkey") % 10
    rows = t["orders"].select("o_orderkey", F.col("o_totalprice").alias("rate"), "o_orderstatus",
                              (F.col("o_orderkey") % 14 + 1).cast("int").alias("nights"))
    refund = F.when(F.col("o_orderstatus") == "P", F.when(k % 2 == 0, F.lit(1.0)).otherwise(F.lit(0.5)))
    return travel.fee_breakdown(rows, "rate", "nights", F.when(k < 5, F.lit("0.45")).otherwise(F.lit("0.20")),
                                refund).select("o_orderkey", "subtotal", "cleaning_fee", "service_fee",
                                               "total_amount", "refund_amount")


_QUOTES = """
select cast(o_orderdate as date) as day,
  cast(1 + max(o_orderkey % 97) * 0.001 as decimal(12,6)) as usd,
  max(case when o_orderkey % 3 > 0 then cast(0.8 + o_orderkey % 89 * 0.001 as decimal(12,6)) end) as gbp,
  max(case when o_orderdate > timestamp '1996-01-01' then cast(100 + o_orderkey % 31 as decimal(12,6)) end) as jpy
from {orders} where isodow(o_orderdate) < 6 group by 1"""


@query("fx_daily_rates", f"""
with q as ({_QUOTES}),
days as (select cast(unnest(generate_series((select min(day) from q), (select max(day) from q), interval 1 day))
         as date) as day),
filled as (select d.day, last_value(usd ignore nulls) over w as usd, last_value(gbp ignore nulls) over w as gbp,
             last_value(jpy ignore nulls) over w as jpy from days d left join q on q.day = d.day
           window w as (order by d.day rows between unbounded preceding and current row))
select day as rate_date, currency_code, usd_per_unit from (
  select day, 'EUR' as currency_code, cast(usd as double) as usd_per_unit from filled union all
  select day, 'GBP', round(cast(usd as double) / cast(gbp as double), 8) from filled union all
  select day, 'JPY', round(cast(usd as double) / cast(jpy as double), 8) from filled union all
  select day, 'USD', 1.0 from filled) where usd_per_unit is not null""")
def _(t):
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    quotes = t["orders"].filter(F.weekday("o_orderdate") < 5).groupBy(day.cast("date").alias("day")).agg(
        (F.lit(1) + F.max(k % 97) * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(12,6)").alias("USD"),
        F.max(F.when(k % 3 > 0, F.lit("0.8").cast("decimal(4,3)") + k % 89 * F.lit("0.001").cast("decimal(4,3)")).cast(
            "decimal(12,6)")).alias("GBP"),
        F.max(F.when(day > F.lit("1996-01-01").cast("timestamp_ntz"), 100 + k % 31).cast("decimal(12,6)")).alias("JPY"))
    return travel.fx_daily_rates(quotes, "day", "USD", ["GBP", "JPY"])


