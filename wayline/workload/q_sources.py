"""Queries: scans, loads, lineage, manifests, sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.session import scratch_path
from wayline.sources import files, sinks
from wayline.sources.schemas import SEED_TYPES, bronze_schema
from wayline.workload.registry import query


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@query("scan_staged_csv", """
select cast(doc_id as varchar) as doc_id, md5(text) as text_md5, cast(length(text) as integer) as n, lang
from {documents}""")
def _(t):
    path = scratch_path(t.spark, "staged")
    files.write_staged_csv(t["documents"].select(F.col("doc_id").cast("string"), "text", "lang"), path)
    back = files.scan_staged_csv(t.spark, path, _text("doc_id", "text", "lang"))
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"), "lang")


@query("bronze_schema", """
select flight_booking_id, stay_booking_id, user_id, leg, booked_at, flight_date, airline_code, flight_number, origin,
  dest, crs_dep_time, cabin_class, passengers, fare_per_passenger_usd, total_fare_usd, booking_status
from {raw_flight_bookings}""")
def _(t):
    schema, path = bronze_schema("flight_bookings"), scratch_path(t.spark, "raw")
    files.ensure_raw_table(t.spark, path, schema)
    t["raw_flight_bookings"].select(*schema.names).write.mode("append").parquet(path)
    return files.ensure_raw_table(t.spark, path, schema)


@query("load_lineage", """
select 'orders.parquet' as file_name, timestamp '2024-05-01 06:00:00' as loaded_at, count(*) as row_count
from {orders}""")
def _(t):
    rows = files.load_lineage(t["orders"].select("o_orderkey"), F.to_timestamp_ntz(F.lit("2024-05-01 06:00:00")))
    return rows.groupBy(F.regexp_extract("_source_file", r"([^/]+)$", 1).alias("file_name"),
                        F.col("_loaded_at").cast("timestamp_ntz").alias("loaded_at")).agg(
        F.count(F.lit(1)).alias("row_count"))


@query("load_incremental_files", """
select case when o_orderdate < timestamp '1998-01-01' then 'first' else 'second' end as load_name,
  count(*) as row_count, min(o_orderkey) as first_key, max(o_orderkey) as last_key from {orders} group by 1""")
def _(t):
    root = scratch_path(t.spark, "load")
    columns = _text("order_id", "day", "comment")
    rows = t["orders"].select(F.col("o_orderkey").cast("string").alias("order_id"),
                              F.col("o_orderdate").cast("date").cast("string").alias("day"),
                              F.concat(F.lit('said "'), "o_orderpriority", F.lit('",\nthen\\left')).alias("comment"))
    loads = [("first", F.col("day") < "1998-01-01"), ("second", F.col("day") >= "1998-01-01")]
    for number, (name, part) in enumerate(loads, 1):
        files.write_staged_csv(rows.filter(part), f"{root}/source/{name}")
        when = dt.datetime(2024, 1, number, tzinfo=dt.timezone.utc)
        files.load_incremental_files(t.spark, f"{root}/source", f"{root}/bronze", f"{root}/history", columns, when)
    bronze = files.read_bronze(t.spark, f"{root}/bronze", columns)
    key = F.col("order_id").cast("bigint")
    name = F.when(F.col("_loaded_at") == F.lit(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)), "first").otherwise(
        "second")
    return bronze.groupBy(name.alias("load_name")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


@query("load_reload_overwritten", """
select url as path, cast(length(html) as bigint) as length from {pages} where page_id % 3 <> 1""")
def _(t):
    when = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    found = t["pages"].select("page_id", F.col("url").alias("path"), F.length("html").cast("bigint").alias("length"),
                              when.alias("modificationTime"))
    # a third was loaded in this state, a third in a shorter state, a third never
    seen = found.filter("page_id % 3 > 0").withColumn("length", F.col("length") - (F.col("page_id") % 3 - 1))
    return files.load_reload_overwritten(found, seen).select("path", "length")


@query("load_row_counts", """
select 'orders' as table_name, count(*) as row_count from {orders}
union all select 'lineitem', count(*) from {lineitem} union all select 'events', count(*) from {events}
union all select 'documents', count(*) from {documents} union all select 'nation', count(*) from {nation}""")
def _(t):
    return files.load_row_counts({n: t[n] for n in ("orders", "lineitem", "events", "documents", "nation")})


@query("csv_fixed_layout", """
select 'lake' as origin_system, cast(c_custkey as varchar) as user_id, c_name as full_name, '' as phone,
  c_mktsegment as channel from {customer}""")
def _(t):
    return files.csv_fixed_layout(t["customer"], {"c_custkey": "user_id", "c_name": "full_name", "c_phone": "phone",
                                                  "c_mktsegment": "channel"}, {"origin_system": "lake"})


@query("pii_drop_columns", "select user_id, gender, home_country_code, preferred_language from {raw_users}")
def _(t):
    return files.pii_drop_columns(t["raw_users"], ["user_id", "gender", "home_country_code", "preferred_language"])


@query("load_manifest", """
select 'reviews/' || source as folder, 'reviews' as source, 'open' as license, count(*) as rows, true as has_bytes
from {documents} group by 1
union all select 'labels/' || cast(quality as varchar), 'before', 'none', count(*), false from {labels} group by 1""")
def _(t):
    root = scratch_path(t.spark, "exports")
    (t["documents"].select("doc_id", F.col("lang").alias("a"), F.col("n_chars").alias("b"), "source").repartition(
        "source").write.partitionBy("source").options(header="true", compression="gzip").csv(f"{root}/reviews"))
    scan = t.spark.read.option("header", "true").schema("doc_id string, a string, b string").csv(
        f"{root}/reviews/source=*")
    listed = files.file_row_counts(scan, "reviews", "open")
    gone = t["documents"].groupBy(F.concat(F.lit("reviews/old-"), "lang").alias("path")).agg(
        F.count(F.lit(1)).alias("rows")).withColumns({"source": F.lit("before"), "license": F.lit("none")})
    kept = t["labels"].groupBy(F.concat(F.lit("labels/"), F.col("quality").cast("string")).alias("path")).agg(
        F.count(F.lit(1)).alias("rows")).withColumns({"source": F.lit("before"), "license": F.lit("none")})
    found = F.regexp_extract("path", "(reviews/)source=([^/]+)/", 2)
    made = files.load_manifest(listed.withColumn("path", F.regexp_replace("path", "^.*/exports[^/]*/", "")),
                               gone.unionByName(kept), prefix="reviews/")
    # a source may lie in several files: their names are Spark's own, so they are added up by folder
    return made.groupBy(F.when(found != "", F.concat(F.lit("reviews/"), found)).otherwise(F.col("path")).alias("folder"),
                        "source", "license").agg(F.sum("rows").alias("rows"),
                                                 (F.sum("bytes") > 0).alias("has_bytes")).withColumn(
        "has_bytes", F.coalesce("has_bytes", F.lit(False)))


@query("seed_read", "select city, city_name, country_code, currency_code, is_us from {cities}")
def _(t):
    path = scratch_path(t.spark, "seed")
    t["cities"].write.option("header", "true").csv(path)
    return files.seed_read(t.spark, path, SEED_TYPES["cities"])


@query("source_multi_glob", """
select lang, count(*) as row_count, cast(sum(n_chars) as bigint) as chars from {documents} group by lang""")
def _(t):
    root = scratch_path(t.spark, "globs")
    rows = t["documents"].select("doc_id", "lang", "n_chars").withColumn("part", F.col("doc_id") % 2)
    for number in (0, 1):
        files.write_staged_csv(rows.filter(F.col("part") == number).drop("part"), f"{root}/p{number}/x")
    read = files.source_multi_glob(t.spark, [f"{root}/p0/*/*.csv.gz", f"{root}/p1/*/*.csv.gz"],
                                   _text("doc_id", "lang", "n_chars"))
    return read.groupBy("lang").agg(F.count(F.lit(1)).alias("row_count"),
                                    F.sum(F.col("n_chars").cast("bigint")).alias("chars"))


@query("sink_partitioned_csv", """
select strftime(ts, '%Y') as year, strftime(ts, '%m') as month, count(*) as row_count from {events} group by 1, 2
union all
select strftime(o_orderdate, '%Y'), strftime(o_orderdate, '%m'), count(*) from {orders} group by 1, 2""")
def _(t):
    events = t["events"].select(F.col("event_id").alias("id"), F.col("ts").alias("at"), F.col("props").alias("note"))
    orders = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"),
                                F.col("o_orderpriority").alias("note"))
    return sinks.sink_partitioned_csv(events.unionByName(orders), "at", scratch_path(t.spark, "export"))


@query("sink_named_csv", """
select strftime(o_orderdate, '%Y') as year, strftime(o_orderdate, '%m') as month, count(*) as row_count,
  sum(o_orderkey)::bigint as keys, true as named from {orders} group by 1, 2""")
def _(t):
    path = scratch_path(t.spark, "named")
    sinks.sink_partitioned_csv(t["orders"].select("o_orderkey", F.col("o_orderdate").alias("at"), "o_orderpriority"), "at", path,
                               names="orders_{year}-{month}_{part:04d}.csv.gz")
    back = files.scan_staged_csv(t.spark, f"{path}/year=*/month=*", _text("o_orderkey", "at", "o_orderpriority"))
    place = F.regexp_extract(F.input_file_name(), r"year=(\d+)/month=(\d+)/orders_\1-\2_\d{4}[.]csv[.]gz$", 0)
    return back.withColumns({"year": F.date_format("at", "yyyy"), "month": F.date_format("at", "MM"),
                             "place": place}).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("o_orderkey").cast("bigint")).alias("keys"),
        F.bool_and(F.startswith("place", F.concat(F.lit("year="), F.col("year"), F.lit("/month="), F.col("month")))
                   ).alias("named"))


@query("materialize_view_table", """
select 'view' as kind, count(*) as row_count, count(distinct o_custkey) as users from {orders} union all
select 'table', count(*), count(distinct o_custkey) from {orders} union all
select 'incremental', count(*), count(distinct o_custkey) from {orders}""")
def _(t):
    rows = t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"),
                              F.to_timestamp(F.lit("2024-01-01")).alias("_loaded_at"))
    result = None
    for kind in ("view", "table", "incremental"):
        made = sinks.materialize_view_table(rows, kind, "wayline_orders", scratch_path(t.spark, kind),
                                            ["o_orderkey"], "_loaded_at", "day")
        if kind == "view":
            made = t.spark.table("wayline_orders")
        row = made.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("o_custkey").alias("users")).select(
            F.lit(kind).alias("kind"), "row_count", "users")
        result = row if result is None else result.unionByName(row)
    return result


@query("source_freshness", """
select 'events' as source_name, max(ts) as newest,
  case when max(ts) + interval 35 day < timestamp '2024-02-15' then 'warn' else 'pass' end as status from {events}
union all
select 'orders', max(o_orderdate),
  case when max(o_orderdate) + interval 35 day < timestamp '2024-02-15' then 'warn' else 'pass' end from {orders}""")
def _(t):
    sources = {"events": t["events"].select(F.col("ts").alias("_loaded_at")),
               "orders": t["orders"].select(F.col("o_orderdate").alias("_loaded_at"))}
    return files.source_freshness(sources, "_loaded_at", dt.datetime(2024, 2, 15))


@query("date_spine", """
with daily as (select cast(ts as date) as date_day, count(*) as n from {events} where event_type = 'error' group by 1),
days as (select cast(unnest(generate_series((select min(cast(ts as date)) from {events}),
                                            (select max(cast(ts as date)) from {events}), interval 1 day)) as date)
         as date_day)
select date_day, coalesce(n, 0) as errors from days left join daily using (date_day)""")
def _(t):
    day = F.col("ts").cast("date")
    first, last = t["events"].agg(F.min(day), F.max(day)).first()
    daily = t["events"].filter("event_type = 'error'").groupBy(day.alias("date_day")).agg(
        F.count(F.lit(1)).alias("n"))
    return files.date_spine(t.spark, first, last).join(daily, "date_day", "left").select(
        "date_day", F.coalesce("n", F.lit(0)).alias("errors"))


@query("month_range", """
with span as (select min(o_orderdate) as a, max(o_orderdate) as b from {orders})
select cast(year(m) as integer) as year, cast(month(m) as integer) as month, n.orders
from (select unnest(generate_series(date_trunc('month', a), date_trunc('month', b), interval 1 month)) as m from span)
join (select date_trunc('month', o_orderdate) as om, count(*) as orders from {orders} group by 1) n on n.om = m""")
def _(t):
    day = F.col("o_orderdate").cast("date")
    first, last = t["orders"].agg(F.min(day), F.max(day)).first()
    counted = t["orders"].groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"))
    return files.month_range(t.spark, first, last).join(counted, ["year", "month"])


@query("values_inline", """
select v.label, count(*) as orders from {orders} o
join (values ('P', 'pending'), ('F', 'filled')) v(code, label) on v.code = o.o_orderstatus group by 1""")
def _(t):
    labels = files.values_inline(t.spark, [("P", "pending"), ("F", "filled")], "o_orderstatus string, label string")
    return t["orders"].join(labels, "o_orderstatus").groupBy("label").agg(F.count(F.lit(1)).alias("orders"))
