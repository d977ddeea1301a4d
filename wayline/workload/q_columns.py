"""Queries: casts, projections, filters and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wayline import functions as fn
from wayline.operators import relational as rel
from wayline.workload import model_sql as sql
from wayline.workload.registry import query


@query("cast_try_number", f"""
select listing_id, snapshot_date, {sql.num('review_scores_accuracy')} as rounded,
  cast(try_cast(review_scores_accuracy as decimal(4,2)) as double) as two_places, {sql.num('price')} as not_a_number,
  cast(try_cast(bathrooms as decimal(4,1)) as double) as bathrooms, {sql.num('last_review')} as empty_text
from {{raw_listings}}""")
def _(t):
    c = F.col
    return t["raw_listings"].select(
        "listing_id", "snapshot_date", fn.cast_try_number(c("review_scores_accuracy")).alias("rounded"),
        fn.cast_try_number(c("review_scores_accuracy"), 4, 2).alias("two_places"),
        fn.cast_try_number(c("price")).alias("not_a_number"),
        fn.cast_try_number(c("bathrooms"), 4, 1).alias("bathrooms"),
        fn.cast_try_number(c("last_review")).alias("empty_text"))


@query("cast_try_date_ts", """
select user_id, try_cast(birth_date as date) as birth_date, try_cast(signed_up_at as timestamp) as signed_up_at,
  cast(null as date) as bad from {raw_users}""")
def _(t):
    return t["raw_users"].select(
        "user_id", fn.cast_try_date_ts(F.col("birth_date")).alias("birth_date"),
        fn.cast_try_date_ts(F.col("signed_up_at"), "timestamp").alias("signed_up_at"),
        fn.cast_try_date_ts(F.col("email")).alias("bad"))


@query("cast_try_boolean", f"select user_id, {sql.yes_no('marketing_opt_in')} as opted_in from {{raw_users}}")
def _(t):
    return t["raw_users"].select("user_id", fn.cast_try_boolean(F.col("marketing_opt_in")).alias("opted_in"))


@query("cast_try_double", """
select id, try_cast(latitude_deg as double) as lat, try_cast(longitude_deg as double) as lon from {raw_airports}""")
def _(t):
    return t["raw_airports"].select("id", fn.cast_try_double(F.col("latitude_deg")).alias("lat"),
                                    fn.cast_try_double(F.col("longitude_deg")).alias("lon"))


@query("cast_numeric_flag", f"""
select {sql.flag('cancelled')} as cancelled, {sql.flag('diverted')} as diverted, {sql.flag('dep_del15')} as dep15,
  {sql.flag('arr_del15')} as arr15, count(*) as n from {{raw_flights}} group by all""")
def _(t):
    flags = {"cancelled": "cancelled", "diverted": "diverted", "dep15": "dep_del15", "arr15": "arr_del15"}
    return t["raw_flights"].groupBy(*[fn.cast_numeric_flag(F.col(c)).alias(n) for n, c in flags.items()]).agg(
        F.count(F.lit(1)).alias("n"))


@query("project_except_add", """
select * exclude (c_acctbal), cast(cast(c_acctbal as decimal(12,2)) as double) as balance from {customer}""")
def _(t):
    return rel.project_except_add(t["customer"], ["c_acctbal"], balance=F.col("c_acctbal").cast("decimal(12,2)"))


@query("project_case_bucket", """
select p_partkey, case when p_retailprice < 925 then 'low' when p_retailprice < 950 then 'middle' else 'high' end
  as band from {part}""")
def _(t):
    return t["part"].select("p_partkey", fn.project_case_bucket(
        F.col("p_retailprice"), [(925, "low"), (950, "middle")], "high").alias("band"))


@query("project_decode", """
select o_orderkey, case o_orderstatus when 'F' then 'filled' when 'P' then 'pending' end as known,
  case o_orderstatus when 'F' then 1 else 9 end as rank from {orders}""")
def _(t):
    c = F.col("o_orderstatus")
    return t["orders"].select("o_orderkey", fn.project_decode(c, {"F": "filled", "P": "pending"}).alias("known"),
                              fn.project_decode(c, {"F": 1}, 9).alias("rank"))


@query("project_null_handling", """
select _source_file, flight_number, nullif(trim(tail_number), '') as tail,
  coalesce(arr_delay, dep_delay, 'none') as delay, dep_delay is not null as departed from {raw_flights}""")
def _(t):
    return t["raw_flights"].select(
        "_source_file", "flight_number", fn.project_null_handling(F.col("tail_number")).alias("tail"),
        F.coalesce("arr_delay", "dep_delay", F.lit("none")).alias("delay"),
        F.col("dep_delay").isNotNull().alias("departed"))


@query("project_iff", """
select o_orderpriority, cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as bigint) as filled,
  cast(sum(case when o_orderstatus = 'F' then 0 else cast(o_totalprice as decimal(14,2)) end) as double) as open_value
from {orders} group by 1""")
def _(t):
    filled = F.col("o_orderstatus") == "F"
    return t["orders"].groupBy("o_orderpriority").agg(
        F.sum(fn.project_iff(filled, 1, 0)).alias("filled"),
        F.sum(fn.project_iff(filled, 0, F.col("o_totalprice").cast("decimal(14,2)"))).alias("open_value"))


@query("filter_basic", """
select o_orderkey, o_orderstatus, o_orderdate from {orders}
where o_orderstatus in ('F', 'P') and o_orderkey between 100 and 1000000000
  and not (o_orderpriority = '1-URGENT') and year(o_orderdate) = 1997 and o_totalprice is not null""")
def _(t):
    c = F.col
    # the year is written as a date range, which reaches the scan as a pushed filter
    start, end = F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz")
    return rel.filter_basic(t["orders"], c("o_orderstatus").isin("F", "P") & c("o_orderkey").between(100, 1000000000)
                            & ~(c("o_orderpriority") == "1-URGENT") & (c("o_orderdate") >= start)
                            & (c("o_orderdate") < end) & c("o_totalprice").isNotNull()).select(
        "o_orderkey", "o_orderstatus", "o_orderdate")


@query("filter_optional_param", """
select 'all' as asked, count(*) as n from {documents} union all
select 'fr', count(*) from {documents} where lang = 'fr'""")
def _(t):
    def counted(name, value):
        return rel.filter_optional_param(t["documents"], "lang", value).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("asked"), "n")
    return counted("all", None).unionByName(counted("fr", "fr"))


@query("filter_high_water", """
select o_orderkey, o_orderdate from {orders}
where o_orderdate > (select coalesce(max(o_orderdate), timestamp '1900-01-01') from {orders} where o_orderdate < timestamp '2000-01-01')""")
def _(t):
    target = t["orders"].filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return rel.filter_high_water(t["orders"].select("o_orderkey", "o_orderdate"), target, "o_orderdate")


@query("filter_not_in_correlated", """
select c.c_custkey, n.n_name as metro_key, upper(substr(r.r_name, 1, 3)) as iata_code
from {customer} c join {nation} n on n.n_nationkey = c.c_nationkey join {region} r on r.r_regionkey = n.n_regionkey
where upper(substr(r.r_name, 1, 3)) not in (select iata_code from {city_airports} a where a.metro_key = n.n_name)""")
def _(t):
    homes = (t["customer"].join(t["nation"], F.col("n_nationkey") == F.col("c_nationkey"))
             .join(t["region"], F.col("r_regionkey") == F.col("n_regionkey"))
             .select("c_custkey", F.col("n_name").alias("metro_key"),
                     F.upper(F.substring("r_name", 1, 3)).alias("iata_code")))
    return rel.filter_not_in_correlated(homes, t["city_airports"], ["metro_key"], "iata_code").select(
        "c_custkey", "metro_key", "iata_code")


@query("query_parameters", """
select o_orderpriority, count(*) as n from {orders}
where o_orderdate >= timestamp '1999-01-01' and o_orderstatus = 'O' group by 1""")
def _(t):
    text = ("select o_orderpriority, count(*) as n from {orders} where o_orderdate >= cast(:since as timestamp_ntz) "
            "and o_orderstatus = :status group by 1")
    return rel.query_parameters(t.spark, text, {"since": dt.date(1999, 1, 1), "status": "O"}, orders=t["orders"])


# --- scalar functions ---------------------------------------------------------------------------

@query("fn_surrogate_key", """
select o_orderkey, md5(coalesce(cast(o_orderkey as varchar), '_dbt_utils_surrogate_key_null_') || '-' ||
  coalesce(nullif(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_') || '-' ||
  coalesce(cast(cast(o_orderdate as date) as varchar), '_dbt_utils_surrogate_key_null_')) as id from {orders}""")
def _(t):
    return t["orders"].select("o_orderkey", fn.fn_surrogate_key(
        F.col("o_orderkey"), F.nullif("o_orderstatus", F.lit("P")), F.col("o_orderdate").cast("date")).alias("id"))


@query("fn_trim_case", """
select upper(trim(reporting_airline)) as carrier, lower(trim(origin)) as origin, count(*) as n
from {raw_flights} group by all""")
def _(t):
    return t["raw_flights"].groupBy(fn.fn_trim_case(F.col("reporting_airline")).alias("carrier"),
                                    fn.fn_trim_case(F.col("origin"), "lower").alias("origin")).agg(
        F.count(F.lit(1)).alias("n"))


@query("fn_lpad_clock", f"""
select crs_dep_time, {sql.clock('crs_dep_time')} as minute, {sql.clock("crs_dep_time || '7'")} as odd, count(*) as n
from {{raw_flights}} group by all""")
def _(t):
    c = F.col("crs_dep_time")
    return t["raw_flights"].groupBy("crs_dep_time", fn.fn_lpad_clock(c).alias("minute"),
                                    fn.fn_lpad_clock(F.concat(c, F.lit("7"))).alias("odd")).agg(
        F.count(F.lit(1)).alias("n"))


@query("fn_replace_money", """
select listing_id, snapshot_date,
  cast(try_cast(replace(replace(price, '$', ''), ',', '') as decimal(12,2)) as double) as price from {raw_listings}""")
def _(t):
    return t["raw_listings"].select("listing_id", "snapshot_date", fn.fn_replace_money(F.col("price")).alias("price"))


@query("fn_percent", f"""
select listing_id, snapshot_date,
  cast(cast({sql.num("replace(host_acceptance_rate, '%', '')")} as decimal(18,2)) / 100 as double) as share
from {{raw_listings}}""")
def _(t):
    return t["raw_listings"].select("listing_id", "snapshot_date",
                                    fn.fn_percent(F.col("host_acceptance_rate")).alias("share"))


@query("fn_clean_html", f"""
select page_id, md5({sql.html('html')}) as text_md5, cast(length({sql.html('html')}) as integer) as n from {{pages}}""")
def _(t):
    text = fn.fn_clean_html(F.col("html"))
    return t["pages"].select("page_id", F.md5(text).alias("text_md5"), F.length(text).alias("n"))


@query("fn_length", "select doc_id, cast(length(text) as integer) as n from {documents}")
def _(t):
    return t["documents"].select("doc_id", fn.fn_length(F.col("text")).alias("n"))


@query("fn_split_mask", """
select user_id, '***@' || split_part(email, '@', 2) as email, '***-***-****' as phone from {raw_users}""")
def _(t):
    return t["raw_users"].select("user_id", fn.fn_split_mask(F.col("email")).alias("email"),
                                 fn.fn_split_mask(F.col("user_id"), "phone").alias("phone"))


@query("fn_concat_left", "select c_custkey, left(c_mktsegment, 2) || '-' || c_name as code from {customer}")
def _(t):
    return t["customer"].select("c_custkey", fn.fn_concat_left(F.col("c_mktsegment"), 2, F.lit("-"),
                                                               F.col("c_name")).alias("code"))


@query("fn_ascii_fold", """
select doc_id, case when folded = '' then 'traveler' else folded end as folded from (
  select doc_id, regexp_replace(nfc_normalize(strip_accents(replace(replace(replace(replace(replace(replace(replace(
    lower(text), 'ı', 'i'), 'ł', 'l'), 'ø', 'o'), 'æ', 'ae'), 'ß', 'ss'), 'đ', 'd'), 'œ', 'oe'))), '[^a-z]', '', 'g')
    as folded from {documents})""")
def _(t):
    return t["documents"].select("doc_id", fn.fn_ascii_fold(F.col("text")).alias("folded"))


@query("fn_json_array", """
select listing_id, snapshot_date, case when json_valid(amenities) then cast(json_array_length(amenities) as integer)
  end as n from {raw_listings}""")
def _(t):
    return t["raw_listings"].select("listing_id", "snapshot_date", fn.fn_json_array(F.col("amenities")).alias("n"))


@query("fn_json_to_array", """
select vec_id, len(embedding) as n, md5(array_to_string(list_transform(embedding,
  lambda x: cast(cast(round(x * 1000) as bigint) as varchar)), ',')) as sig from {embeddings}""")
def _(t):
    back = fn.fn_json_to_array(F.to_json("embedding"), "float")
    text = F.concat_ws(",", F.transform(back, lambda x: F.round(x * 1000).cast("bigint").cast("string")))
    return t["embeddings"].select("vec_id", F.size(back).cast("bigint").alias("n"), F.md5(text).alias("sig"))


@query("fn_array_filter_slice", """
select review_id, case when len(kept) = 0 then 'other' else array_to_string(kept[1:2], ',') end as topics
from (select review_id, list_filter(topics, lambda x: list_contains(['value', 'comfort', 'noise'], x)) as kept
      from {enrichments})""")
def _(t):
    return t["enrichments"].select("review_id", fn.fn_array_filter_slice(
        F.col("topics"), ["value", "comfort", "noise"], 2, "other").alias("topics"))


@query("fn_date_trunc", """
select cast(date_trunc('month', o_orderdate) as date) as month, cast(date_trunc('week', o_orderdate) as date) as week,
  count(*) as n from {orders} group by all""")
def _(t):
    day = F.col("o_orderdate").cast("date")
    return t["orders"].groupBy(fn.fn_date_trunc(day, "month").alias("month"),
                               fn.fn_date_trunc(day, "week").alias("week")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_date_parts", """
select event_id, cast(year(ts) as integer) as year, cast(quarter(ts) as integer) as quarter,
  cast(month(ts) as integer) as month, cast(hour(ts) as integer) as hour, cast(isodow(ts) as integer)
    as day_of_week_iso, strftime(ts, '%a') as day_name, strftime(ts, '%b') as month_name,
  strftime(ts, '%Y-%m') as year_month, isodow(ts) in (6, 7) as is_weekend from {events}""")
def _(t):
    return t["events"].select("event_id", fn.fn_date_parts(F.col("ts")).alias("p")).select("event_id", "p.*")


@query("fn_date_diff", """
select o_orderkey, l_linenumber, l_shipdate, cast(date_diff('day', o_orderdate, l_shipdate) as integer) as days,
  cast(date_diff('month', o_orderdate, l_shipdate) as integer) as months,
  cast(date_diff('year', o_orderdate, l_shipdate) as integer) as years
from {orders} join {lineitem} on l_orderkey = o_orderkey""")
def _(t):
    a, b = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    joined = t["orders"].join(t["lineitem"], F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("o_orderkey", "l_linenumber", "l_shipdate",
                         *[fn.fn_date_diff(u, a, b).alias(u + "s") for u in ("day", "month", "year")])


@query("fn_date_add", """
select event_id, cast(ts as date) + cast(event_id % 40 as integer) as later_day, ts + to_minutes(event_id % 500)
  as later, ts - interval 90 second as earlier from {events}""")
def _(t):
    k = F.col("event_id")
    return t["events"].select("event_id", fn.fn_date_add(F.col("ts").cast("date"), "day", k % 40).alias("later_day"),
                              fn.fn_date_add(F.col("ts"), "minute", k % 500).alias("later"),
                              fn.fn_date_add(F.col("ts"), "second", -90).alias("earlier"))


@query("fn_timestamp_from_parts", f"""
select flight_number, _source_file,
  cast(try_cast(flight_date as date) as timestamp) + to_minutes({sql.clock('crs_dep_time')}) as departs
from {{raw_flights}}""")
def _(t):
    at = fn.fn_timestamp_from_parts(fn.cast_try_date(F.col("flight_date")), fn.fn_lpad_clock(F.col("crs_dep_time")))
    return t["raw_flights"].select("flight_number", "_source_file", at.alias("departs"))


@query("fn_round_money", """
select o_orderkey, cast(round(price * cast(0.1425 as decimal(5,4)), 2) as double) as two,
  cast(round(-price * cast(0.00005 as decimal(6,5)), 4) as double) as four
from (select o_orderkey, cast(o_totalprice as decimal(14,2)) as price from {orders})""")
def _(t):
    price = F.col("o_totalprice").cast("decimal(14,2)")
    return t["orders"].select(
        "o_orderkey", fn.fn_round_money(price * F.lit("0.1425").cast("decimal(5,4)")).alias("two"),
        fn.fn_round_money(-price * F.lit("0.00005").cast("decimal(6,5)"), 4).alias("four"))


@query("fn_greatest_least", """
select event_id, least(greatest(value, 5.0e0), 20.0e0) as clamped from {events}""")
def _(t):
    return t["events"].select("event_id", fn.fn_greatest_least(F.col("value"), 5.0, 20.0).alias("clamped"))


@query("fn_math", """
select event_id, cast(floor(value) as bigint) as whole, event_id % 7 as rest, abs(value - 10) as distance,
  round(exp(value / 100), 9) as e, round(ln(value + 1), 9) as l, round(pow(value, 1.5e0), 6) as p,
  round(sqrt(value), 9) as s, round(cos(value * pi()), 9) + 0 as c from {events}""")
def _(t):
    v, r = F.col("value"), lambda c, n=9: F.round(c, n)
    return t["events"].select(
        "event_id", fn.fn_math("floor", v).alias("whole"), fn.fn_math("mod", F.col("event_id"), F.lit(7)).alias("rest"),
        fn.fn_math("abs", v - 10).alias("distance"), r(fn.fn_math("exp", v / 100)).alias("e"),
        r(fn.fn_math("ln", v + 1)).alias("l"), r(fn.fn_math("pow", v, F.lit(1.5)), 6).alias("p"),
        r(fn.fn_math("sqrt", v)).alias("s"), (r(fn.fn_math("cos", v * fn.fn_math("pi"))) + 0).alias("c"))


@query("fn_cosine_similarity", """
select a.vec_id, round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 9)
  as score from {embeddings} a join {embeddings} b on b.vec_id = a.vec_id - 1""")
def _(t):
    before = t["embeddings"].select((F.col("vec_id") + 1).alias("vec_id"), F.col("embedding").alias("other"))
    return t["embeddings"].join(before, "vec_id").select(
        "vec_id", F.round(fn.fn_cosine_similarity(F.col("embedding"), F.col("other")), 9).alias("score"))


@query("fn_fx_convert", """
select s.stay_booking_id, s._source_file,
  cast(round(cast(s.total_amount as decimal(14,2)) * f.usd_per_unit, 2) as double) as usd
from {raw_stay_bookings} s left join {fx_rates} f
  on f.currency_code = s.currency_code and f.rate_date = cast(s.checkin_date as date)""")
def _(t):
    stays = t["raw_stay_bookings"]
    joined = rel.join_multi_key_fx(stays, t["fx_rates"], "currency_code", fn.cast_try_date(F.col("checkin_date")))
    return joined.select("stay_booking_id", "_source_file", fn.fn_fx_convert(
        fn.cast_try_number(F.col("total_amount"), 14, 2), F.col("usd_per_unit")).alias("usd"))



@query("fn_cross_rate", """
select o_orderkey, round(cast(cast(o_orderkey % 13 + 7 as decimal(18,8)) as double)
  / cast(cast(o_custkey % 11 + 3 as decimal(18,8)) as double), 8) as rate from {orders}""")
def _(t):
    return t["orders"].select("o_orderkey", fn.fn_cross_rate(F.col("o_orderkey") % 13 + 7,
                                                             F.col("o_custkey") % 11 + 3).alias("rate"))


_U = "(cast('0x' || substr(md5(cast({k} as varchar) || '|{s}|42'), 1, 15) as bigint) % 1000000007) / 1000000007.0e0"


def u_sql(key: str, salt: str) -> str:
    """The uniform draw in the oracle's dialect."""
    return _U.format(k=key, s=salt)


@query("hash_uniform", f"select o_orderkey, {u_sql('o_orderkey', 'pick')} as u from {{orders}}")
def _(t):
    return t["orders"].select("o_orderkey", fn.hash_uniform(F.col("o_orderkey"), "pick").alias("u"))


@query("hash_normal", f"""
select o_orderkey, round(sqrt(-2 * ln(greatest({u_sql('o_orderkey', 'na')}, 1e-12))) *
  cos(2 * pi() * {u_sql('o_orderkey', 'nb')}), 8) + 0 as z from {{orders}}""")
def _(t):
    return t["orders"].select("o_orderkey", (F.round(fn.hash_normal(F.col("o_orderkey"), "n"), 8) + 0).alias("z"))


@query("hash_exponential", f"""
select o_orderkey, round(-ln(1 - {u_sql('o_orderkey', 'lag')}) * 3, 8) as e from {{orders}}""")
def _(t):
    return t["orders"].select("o_orderkey", F.round(fn.hash_exponential(F.col("o_orderkey"), "lag", 3), 8).alias("e"))


@query("weighted_assign", f"""
select case when u < 0.49 then 'F' when u < 0.98 then 'M' else 'X' end as gender, count(*) as n
from (select {u_sql('c_custkey', 'gender')} as u from {{customer}}) group by 1""")
def _(t):
    u = fn.hash_uniform(F.col("c_custkey"), "gender")
    return t["customer"].groupBy(fn.weighted_assign(u, {"F": 49, "M": 49, "X": 2}).alias("gender")).agg(
        F.count(F.lit(1)).alias("n"))
