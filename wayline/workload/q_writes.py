"""Queries: merges, history, layouts, streams and data tests."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from wayline.operators import checks, upsert
from wayline.plans import facts, marts, quality
from wayline.session import scratch_path
from wayline.sources import sinks
from wayline.sources.parts import append_part
from wayline.streaming import ingest, merge
from wayline.workload.registry import query

_NEWEST_STAYS = """
select stay_booking_id, checkin_date, guests, _loaded_at from {raw_stay_bookings}
qualify row_number() over (partition by stay_booking_id order by _loaded_at desc) = 1"""


@query("merge_upsert", _NEWEST_STAYS)
def _(t):
    rows = t["raw_stay_bookings"].select("stay_booking_id", "checkin_date", "guests", "_loaded_at")
    target = rows.filter(F.col("_loaded_at") == F.lit(dt.date(2024, 1, 1)))
    return upsert.merge_upsert(target, rows, ["stay_booking_id"], "_loaded_at")


@query("merge_insert_only", """
select doc_id, quality, toxic from {labels} union all
select doc_id, 0, cast(length(lang) as integer) from {documents}
where doc_id not in (select doc_id from {labels})""")
def _(t):
    src = t["documents"].select("doc_id", F.lit(0).alias("quality"), F.length("lang").alias("toxic"))
    return upsert.merge_insert_only(t["labels"], src, ["doc_id"])


@query("merge_schema_append", """
select doc_id, quality, null::varchar as lang from {labels} union all
select doc_id, null::integer, lang from {documents}""")
def _(t):
    return upsert.merge_schema_append(t["labels"].select("doc_id", "quality"), t["documents"].select("doc_id", "lang"))


_SCD = """
with v as (
  select listing_id as k, price_local::double as old_price, room_type as old_kind, is_superhost, accommodates,
    minimum_nights, case when listing_id % 3 = 0 then old_price + 1 else old_price end as new_price,
    case when listing_id % 7 = 0 then 'Hotel room' else room_type end as new_kind
  from {stg_listings}),
w as (
  select *, k % 10 as g, old_price is distinct from new_price or old_kind is distinct from new_kind as moved from v),
spans as (
  select *, unnest(case
    when g = 9 then [struct_pack(new := true, since := date '2024-02-01', until := null::date)]
    when g = 8 then [struct_pack(new := false, since := date '2024-01-01', until := date '2024-02-01'),
                     struct_pack(new := true, since := date '2024-03-01', until := null::date)]
    when moved then [struct_pack(new := false, since := date '2024-01-01', until := date '2024-02-01'),
                     struct_pack(new := true, since := date '2024-02-01', until := null::date)]
    else [struct_pack(new := false, since := date '2024-01-01', until := null::date)] end) as span
  from w)
select k, case when span.new then new_price else old_price end as price_local,
  case when span.new then new_kind else old_kind end as room_type, accommodates, minimum_nights, is_superhost,
  span.since as valid_from, span.until as valid_to
from spans"""


@query("scd2_snapshot", _SCD)
def _(t):
    checked = ["price_local", "room_type", "accommodates", "minimum_nights", "is_superhost"]
    k = F.col("k")
    before = t["stg_listings"].select(F.col("listing_id").alias("k"), *checked)
    # one group appears late, one vanishes and returns; one snapshot changes nothing
    days = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 2, 15), dt.date(2024, 3, 1)]
    day, later = F.col("day"), F.col("day") > days[0]
    missing = F.when(day == days[0], k % 10 == 9).when(day < days[3], k % 10 == 8).otherwise(F.lit(False))
    snapshots = before.withColumn("day", F.explode(F.array(*[F.lit(d) for d in days]))).filter(~missing).withColumns({
        "price_local": F.when(later & (k % 3 == 0), F.col("price_local") + 1).otherwise(F.col("price_local")).cast(
            before.schema["price_local"].dataType),
        "room_type": F.when(later & (k % 7 == 0), "Hotel room").otherwise(F.col("room_type"))})
    return upsert.scd2_snapshots(snapshots, "k", checked, "day", days)


@query("fact_partition_layout", """
select strftime(o_orderdate, '%Y-%m') as month, count(*) as n, cast(min(o_orderdate) as date) as first_day,
  cast(max(o_orderdate) as date) as last_day from {orders} group by 1""")
def _(t):
    path = scratch_path(t.spark, "fact")
    rows = t["orders"].select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    sinks.fact_partition_layout(rows, "day", path)
    return t.spark.read.parquet(path).groupBy(F.col("_month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query("fact_bucket_layout", "select * from {mart_traveler_disruption}")
def _(t):
    # a flight per line item
    root, buckets = scratch_path(t.spark, "bucketed"), facts.flight_buckets(sinks.buckets_for(t["lineitem"].count()))
    stored = {}
    for name in ("fct_flights", "fct_flight_bookings"):
        key, date, date_in_key = facts.FACT_KEYS[name]
        stored[name] = sinks.merge_into_partitions(t.parts(name), f"{root}/{name}", [key], "_loaded_at", date, date_in_key,
                                                   buckets[name])
    return marts.mart_traveler_disruption(stored["fct_flight_bookings"], stored["fct_flights"], t["airlines"])


@query("stream_ingest_files", """
select count(*) as n, count(distinct doc_id) as docs, cast(sum(length(text)) as bigint) as chars from {documents}""")
def _(t):
    from pyspark.sql import types as T

    from wayline.sources.files import write_staged_csv
    root = scratch_path(t.spark, "stream")
    rows = t["documents"].select(F.col("doc_id").cast("string"), "text")
    schema = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("text", T.StringType())])
    for number in (0, 1):   # the second run must load the second half only
        write_staged_csv(rows.filter(F.col("doc_id") % 2 == number), f"{root}/in/part{number}")
        ingest.stream_ingest_files(t.spark, f"{root}/in/*", schema, f"{root}/out",
                                   f"{root}/state").awaitTermination()
    return t.spark.read.parquet(f"{root}/out").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("docs"), F.sum(F.length("text")).alias("chars"))


@query("stream_merge_upsert", _NEWEST_STAYS)
def _(t):
    root = scratch_path(t.spark, "stream-merge")
    rows = t["raw_stay_bookings"].select("stay_booking_id", F.col("checkin_date"), "guests", "_loaded_at")
    # the newer load arrives first
    for day in (dt.date(2024, 2, 1), dt.date(2024, 1, 1)):
        rows.filter(F.col("_loaded_at") == F.lit(day)).write.mode("append").parquet(f"{root}/in")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        merge.stream_merge_upsert(stream, f"{root}/fact", ["stay_booking_id"], "_loaded_at", "checkin_date",
                                  f"{root}/state").awaitTermination()
    return sinks.read_fact(t.spark, f"{root}/fact")


@query("check_while_writing", """
select 'stg_reviews.review_id not null' as check_name, count(*) filter (review_id is null) as failures from {stg_reviews}
union all select 'stg_reviews.review_date not null', count(*) filter (review_date is null) from {stg_reviews}
union all select 'stg_stay_bookings.stay_booking_id not null', count(*) filter (stay_booking_id is null)
  from {stg_stay_bookings}
union all select 'stg_stay_bookings.user_id not null', count(*) filter (user_id is null) from {stg_stay_bookings}
union all select 'stg_stay_bookings.booking_status allowed',
  count(*) filter (booking_status not in ('completed', 'cancelled')) from {stg_stay_bookings}
union all select 'stg_stay_bookings.total_amount_local range', count(*) filter (total_amount_local < 0)
  from {stg_stay_bookings}
union all select 'stg_flights.flight_id not null', count(*) filter (flight_id is null) from {stg_flights}
union all select 'stg_flights.flight_date not null', count(*) filter (flight_date is null) from {stg_flights}
union all select 'stg_flights.airline_code not null', count(*) filter (airline_code is null) from {stg_flights}
union all select 'stg_flights.arrival_status allowed',
  count(*) filter (arrival_status not in ('on_time', 'delayed', 'cancelled', 'diverted')) from {stg_flights}
union all select 'stg_flights.cancellation_reason allowed',
  count(*) filter (cancellation_reason not in ('carrier', 'weather', 'national_air_system', 'security'))
  from {stg_flights}""")
def _(t):
    counts = Counter()
    for name in ("stg_reviews", "stg_stay_bookings", "stg_flights"):
        path = scratch_path(t.spark, name)
        for part in t.parts(name).frames:
            rows, seen = quality.observe_rules(name, part)
            append_part(rows, path)
            counts.update(seen.get)
    return t.spark.createDataFrame(list(counts.items()), "check_name string, failures bigint")


# --- data tests -----------------------------------------------------------------------------------

@query("check_unique", """
select l_orderkey, count(*) as n_rows from {lineitem} group by 1 having count(*) > 1""")
def _(t):
    return checks.check_unique(t["lineitem"], "l_orderkey")


@query("check_not_null", "select _source_file, flight_number from {raw_flights} where arr_delay is null")
def _(t):
    return checks.check_not_null(t["raw_flights"], "arr_delay").select("_source_file", "flight_number")


@query("check_accepted_values", """
select cancellation_code, count(*) as n_rows from {raw_flights}
where cancellation_code not in ('A', 'B', 'C') group by 1""")
def _(t):
    return checks.check_accepted_values(t["raw_flights"], "cancellation_code", ["A", "B", "C"])


@query("check_relationships", """
select doc_id from {documents} where doc_id not in (select doc_id from {labels})""")
def _(t):
    return checks.check_relationships(t["documents"], "doc_id", t["labels"], "doc_id")


@query("check_accepted_range", "select event_id, value from {events} where value < 2 or value > 30")
def _(t):
    return checks.check_accepted_range(t["events"], "value", 2, 30).select("event_id", "value")


@query("check_unique_combination", """
select l_orderkey, l_linenumber, count(*) as n_rows from {lineitem} group by 1, 2 having count(*) > 1""")
def _(t):
    return checks.check_unique_combination(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query("check_severity_warn", """
with f as (
  select 'orders_unique' as check_name, 'error' as severity,
    (select count(*) from (select o_orderkey from {orders} group by 1 having count(*) > 1)) as failures
  union all select 'lines_unique', 'warn',
    (select count(*) from (select l_orderkey from {lineitem} group by 1 having count(*) > 1))
  union all select 'labelled', 'error', (select count(*) from {documents} where doc_id not in
    (select doc_id from {labels})))
select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status from f""")
def _(t):
    return checks.run_checks({
        "orders_unique": (checks.check_unique(t["orders"], "o_orderkey"), "error"),
        "lines_unique": (checks.check_unique(t["lineitem"], "l_orderkey"), "warn"),
        "labelled": (checks.check_relationships(t["documents"], "doc_id", t["labels"], "doc_id"), "error")})


@query("check_reconcile", """
select 'flights' as tbl, (select count(distinct flight_id) from {stg_flights}) as raw_ids,
  (select count(*) from {fct_flights}) as fact_rows union all
select 'stay_bookings', (select count(distinct stay_booking_id) from {raw_stay_bookings}),
  (select count(*) from {fct_stay_exact}) union all
select 'flight_bookings', (select count(distinct flight_booking_id) from {raw_flight_bookings}),
  (select count(*) from {fct_legs_exact})""")
def _(t):
    return checks.check_reconcile({
        "flights": (t["stg_flights"], "flight_id", t["fct_flights"]),
        "stay_bookings": (t["raw_stay_bookings"], "stay_booking_id", t["fct_stay_bookings"]),
        "flight_bookings": (t["raw_flight_bookings"], "flight_booking_id", t["fct_flight_bookings"])},
        only_failures=False)
