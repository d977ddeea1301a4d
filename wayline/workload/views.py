"""Travel-shaped raw tables derived from the given tables.

Each derivation is one statement in the SQL both engines share; ``{name}`` stands for a table. Spark
reads it lazily over the parquet files, the oracle uses it as a common table expression. Everything
after this point (typing, dedup, models, operators) is written twice, independently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.functions.casts import cast_try_number
from wayline.functions.text import flight_key
from wayline.sources.files import spread_small_scan
from wayline.sources.parts import Parts, deal_by_key, parts_for

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

VIEWS: dict[str, str] = {}

VIEWS["flight_rows"] = """
select
  cast(cast(o.o_orderdate as date) + cast(l.l_linenumber * 3 as int) as string) as flight_date,
  case when l.l_linenumber % 2 = 0 then ' c' else 'C' end
    || lpad(cast((l.l_orderkey + l.l_linenumber) % 18 as string), 2, '0') as reporting_airline,
  cast(l.l_orderkey * 10 + l.l_linenumber as string) as flight_number,
  case when l.l_partkey % 50 = 0 then ' ' else 'N' || cast(l.l_partkey as string) end as tail_number,
  case when l.l_orderkey % 3 = 0 then lower(substr(r.r_name, 1, 3)) || ' ' else upper(substr(r.r_name, 1, 3)) end
    as origin,
  n.n_name as origin_city_name, r.r_name as origin_state,
  'X' || lpad(cast(l.l_linenumber as string), 2, '0') as dest,
  'City ' || cast(l.l_linenumber as string) as dest_city_name, 'S' || cast(l.l_linenumber as string) as dest_state,
  cast((l.l_orderkey % 25) * 100
    + case when l.l_orderkey % 25 = 24 then 0 else (l.l_linenumber * 7) % 60 end as string) as crs_dep_time,
  cast(((l.l_orderkey + l.l_linenumber) % 24) * 100 + (l.l_linenumber * 11) % 60 as string) as crs_arr_time,
  case when l.l_returnflag = 'R' then null
       else cast(cast(l.l_tax * 500 - 10 as decimal(10,2)) as string) end as dep_delay,
  case when l.l_returnflag = 'R' or (l.l_returnflag = 'A' and l.l_quantity = 50) then null
       else cast(cast(l.l_quantity * 5 - 60 as decimal(10,2)) as string) end as arr_delay,
  case when l.l_returnflag = 'R' then null else cast(l.l_linenumber + 5 as string) || '.00' end as taxi_out,
  case when l.l_returnflag = 'R' then null else cast(l.l_suppkey % 9 + 2 as string) || '.4' end as taxi_in,
  cast(60 + l.l_linenumber * 10 as string) as crs_elapsed_time,
  case when l.l_returnflag = 'R' then 'n/a' else cast(65 + l.l_linenumber * 10 as string) || '.5' end
    as actual_elapsed_time,
  cast(40 + l.l_linenumber * 10 as string) as air_time,
  cast(cast(l.l_quantity * 10 + 100 as decimal(10,2)) as string) as distance,
  case when l.l_returnflag = 'R' then '1.00' else '0.00' end as cancelled,
  case when l.l_returnflag <> 'R' then null
       else substr('ABCDE', cast(l.l_suppkey % 5 + 1 as int), 1) end as cancellation_code,
  case when l.l_returnflag = 'A' and l.l_quantity = 50 then '1.00' when l.l_linenumber = 7 then null
       else '0.00' end as diverted,
  case when l.l_tax * 500 - 10 >= 15 then '1' else '0' end as dep_del15,
  case when l.l_quantity * 5 - 60 >= 15 then '1.00' else '' end as arr_del15,
  case when l.l_quantity >= 15 and l.l_linenumber % 5 = 0 then '12.00' end as carrier_delay,
  case when l.l_quantity >= 15 and l.l_linenumber % 5 = 1 then '7.50' end as weather_delay,
  case when l.l_quantity >= 15 and l.l_linenumber % 5 = 2 then cast(l.l_suppkey as string) end as nas_delay,
  case when l.l_quantity >= 15 and l.l_linenumber % 5 = 3 then '3' end as security_delay,
  case when l.l_quantity >= 15 and l.l_linenumber % 5 = 4 then cast(l.l_partkey as string) end
    as late_aircraft_delay,
  'flights/' || cast(l.l_partkey as string) || '-' || cast(l.l_suppkey as string) || '-'
    || cast(cast(l.l_extendedprice as decimal(14,2)) as string) || '-'
    || cast(cast(l.l_tax as decimal(4,2)) as string) || l.l_returnflag as _source_file,
  cast(l.l_shipdate as date) as _loaded_at,
  l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_returnflag, o.o_custkey, o.o_orderdate, o.o_orderstatus
from {lineitem} l
join {orders} o on o.o_orderkey = l.l_orderkey
join {customer} c on c.c_custkey = o.o_custkey
join {nation} n on n.n_nationkey = c.c_nationkey
join {region} r on r.r_regionkey = n.n_regionkey
"""

VIEWS["raw_flights"] = """
select flight_date, reporting_airline, flight_number, tail_number, origin, origin_city_name, origin_state, dest,
  dest_city_name, dest_state, crs_dep_time, crs_arr_time, dep_delay, arr_delay, taxi_out, taxi_in,
  crs_elapsed_time, actual_elapsed_time, air_time, distance, cancelled, cancellation_code, diverted, dep_del15,
  arr_del15, carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay, _source_file,
  _loaded_at
from {flight_rows}
"""

VIEWS["raw_stay_bookings"] = """
select
  cast(s.o_orderkey as string) as stay_booking_id, cast(s.o_custkey as string) as user_id,
  cast(s.o_orderkey % (select count(*) from {part}) as string) as listing_id, s.n_name as city,
  case when s.o_orderstatus = 'P' then null
       else cast(s.o_orderkey % (select count(*) from {documents}) as string) end as review_id,
  cast(cast(s.o_orderdate as date) - cast(s.o_orderkey % 60 as int) as string) || ' 10:'
    || lpad(cast(s.o_orderkey % 60 as string), 2, '0') || ':00' as booked_at,
  cast(cast(s.o_orderdate as date) as string) as checkin_date,
  cast(cast(s.o_orderdate as date) + cast(1 + s.o_orderkey % 14 as int) as string) as checkout_date,
  cast(1 + s.o_orderkey % 14 as string) as nights,
  cast(1 + (s.o_orderkey + s.load_no) % 4 as string) as guests, s.currency_code,
  cast(s.price as string) as nightly_rate,
  cast(cast(s.price * cast(0.2 as decimal(2,1)) as decimal(14,2)) as string) as cleaning_fee,
  cast(cast(s.price * cast(0.142 as decimal(4,3)) as decimal(14,2)) as string) as service_fee,
  cast(s.price * cast(1 + s.o_orderkey % 14 as int) as string) as total_amount,
  case when s.o_orderkey % 3 = 0 then 'card' when s.o_orderkey % 3 = 1 then 'paypal' else 'invoice' end
    as payment_method,
  case when s.o_orderkey % 2 = 0 then 'web' else 'app' end as booking_channel,
  case when s.o_orderstatus = 'P' then 'cancelled' else 'completed' end as booking_status,
  case when s.o_orderstatus = 'P' then cast(cast(s.o_orderdate as date) as string) || ' 08:30:15' end
    as cancelled_at,
  case when s.o_orderstatus = 'P' then cast(cast(s.price * cast(0.5 as decimal(2,1)) as decimal(14,2)) as string)
       end as refund_amount,
  'stays/' || cast(s.load_no as string) as _source_file,
  cast(case when s.load_no = 0 then '2024-01-01' else '2024-02-01' end as date) as _loaded_at
from (
  select o.*, n.n_name, cast(o.o_totalprice as decimal(14,2)) as price,
         case n.n_regionkey when 0 then 'EUR' when 1 then 'USD' when 2 then 'JPY' when 3 then 'GBP' else 'TRY' end
           as currency_code
  from (select *, 0 as load_no from {orders} union all
        select *, 1 as load_no from {orders} where o_orderkey % 3 = 0) o
  join {customer} c on c.c_custkey = o.o_custkey
  join {nation} n on n.n_nationkey = c.c_nationkey
) s
"""

VIEWS["raw_flight_bookings"] = """
select
  flight_number as flight_booking_id, cast(l_orderkey as string) as stay_booking_id,
  cast(o_custkey as string) as user_id,
  case when l_linenumber % 2 = 1 then 'outbound' else 'return' end as leg,
  cast(cast(o_orderdate as date) - 20 as string) || ' 09:00:00' as booked_at,
  flight_date, trim(reporting_airline) as airline_code, flight_number, trim(origin) as origin, dest,
  crs_dep_time,
  case when l_linenumber % 3 = 0 then 'business' else 'economy' end as cabin_class,
  cast(1 + l_orderkey % 4 as string) as passengers,
  cast(cast(l_quantity as decimal(12,2)) as string) as fare_per_passenger_usd,
  cast(cast(l_quantity as decimal(10,2)) * cast(1 + l_orderkey % 4 as int) as string) as total_fare_usd,
  case when l_returnflag = 'R' then 'cancelled_by_airline' when o_orderstatus = 'P' then 'cancelled_by_customer'
       else 'flown' end as booking_status,
  _source_file, _loaded_at
from {flight_rows}
"""

VIEWS["raw_users"] = """
select
  cast(c.c_custkey as string) as user_id, cast(c.c_custkey * 7 as string) as source_reviewer_id,
  c.c_name as first_name, c.c_mktsegment as last_name,
  'User' || cast(c.c_custkey as string) || '@Mail' || cast(c.c_nationkey as string) || '.Example' as email,
  substr('FMX', cast(c.c_custkey % 3 + 1 as int), 1) as gender,
  case when c.c_custkey % 40 = 0 then null when c.c_custkey % 41 = 0 then '1999-13-01'
       else cast(date '1940-01-01' + cast(c.c_custkey * 17 % 25000 as int) as string) end as birth_date,
  case when n.n_regionkey = 1 then 'US' when c.c_custkey % 30 = 0 then null else 'N' || cast(n.n_nationkey as string)
       end as home_country_code,
  case when c.c_custkey % 10 = 0 then '' else upper(substr(r.r_name, 1, 3)) end as home_airport,
  case when c.c_custkey % 2 = 0 then 'en' else 'fr' end as preferred_language,
  cast(date '2014-01-01' + cast(c.c_custkey % 3000 as int) as string) || ' 07:'
    || lpad(cast(c.c_custkey % 60 as string), 2, '0') || ':30' as signed_up_at,
  lower(c.c_mktsegment) as acquisition_channel,
  case when c.c_custkey % 4 = 0 then 'TRUE' when c.c_custkey % 4 = 1 then 'f' when c.c_custkey % 4 = 2 then 'on'
       else '?' end as marketing_opt_in,
  'users' as _source_file, cast('2024-01-01' as date) as _loaded_at
from {customer} c
join {nation} n on n.n_nationkey = c.c_nationkey
join {region} r on r.r_regionkey = n.n_regionkey
"""

VIEWS["raw_listings"] = """
select
  'NATION_' || cast(p.p_partkey % 25 as string) as city,
  case when p.snap = 0 then '2025-03-01' else '2025-06-01' end as snapshot_date,
  cast(p.p_partkey as string) as listing_id, '2025-06-0' || cast(1 + p.p_partkey % 9 as string) as last_scraped,
  p.p_name as name, p.p_name || '<br />' || p.p_brand || ' &amp; ' || p.p_type || '<BR>' as description,
  cast(p.p_partkey % 77 as string) as host_id, '20' || cast(10 + p.p_size % 10 as string) || '-05-17' as host_since,
  cast(p.p_size + 50 as string) || '%' as host_response_rate,
  case when p.p_partkey % 9 = 0 then 'N/A' else cast(p.p_size + 40 as string) || '%' end as host_acceptance_rate,
  case when p.p_size % 2 = 0 then 't' else 'f' end as host_is_superhost,
  cast(p.p_partkey % 4 as string) as calculated_host_listings_count,
  p.p_brand as neighbourhood_cleansed, p.p_type as neighbourhood_group_cleansed,
  cast(p.p_size as string) || '.25' as latitude, '-' || cast(p.p_size as string) || '.5' as longitude,
  p.p_type as property_type,
  case p.p_size % 4 when 0 then 'Entire home/apt' when 1 then 'Private room' when 2 then 'Hotel room'
       else 'Shared room' end as room_type,
  cast(1 + p.p_size % 6 as string) as accommodates, cast(p.p_size % 5 as string) || '.5' as bathrooms,
  cast(p.p_size % 5 as string) || '.5 baths' as bathrooms_text, cast(p.p_size % 4 as string) as bedrooms,
  cast(p.p_size % 7 as string) as beds,
  case when p.p_partkey % 11 = 0 then 'not json' when p.p_partkey % 13 = 0 then '[]'
       else '["wifi", "' || p.p_type || '"]' end as amenities,
  case when p.p_partkey % 17 = 0 then null
       when p.p_partkey % 7 = 0 then '$' || cast(1 + p.p_partkey % 3 as string) || ','
         || lpad(cast(cast(p.p_retailprice - 900 as decimal(10,2)) as string), 6, '0')
       else '$' || cast(cast((p.p_retailprice - 900) * 4 + p.snap as decimal(10,2)) as string) end as price,
  case when p.p_partkey % 6 = 0 then '30' else cast(1 + p.p_size % 5 as string) end as minimum_nights,
  '365' as maximum_nights, case when p.p_partkey % 5 = 0 then 'f' else 't' end as has_availability,
  cast(p.p_size % 30 as string) as availability_30, cast(p.p_size % 90 as string) as availability_90,
  cast(p.p_partkey % 365 as string) as availability_365, cast(p.p_partkey % 200 as string) as number_of_reviews,
  cast(p.p_partkey % 50 as string) as number_of_reviews_ltm, '2019-01-15' as first_review,
  case when p.p_partkey % 8 = 0 then '' else '2025-02-28' end as last_review,
  cast(p.p_size % 5 as string) || '.5' as review_scores_rating, '4.755' as review_scores_accuracy,
  '4.5' as review_scores_cleanliness, '' as review_scores_checkin, '4' as review_scores_communication,
  '4.25' as review_scores_location, '3.999' as review_scores_value,
  case when p.p_partkey % 2 = 0 then 't' else 'f' end as instant_bookable,
  case when p.p_partkey % 3 = 0 then '  ' else 'L-' || cast(p.p_partkey as string) end as license,
  cast(p.p_partkey % 255 as string) as estimated_occupancy_l365d,
  cast(cast(p.p_retailprice * 10 as decimal(12,1)) as string) as estimated_revenue_l365d,
  'listings/' || cast(p.snap as string) as _source_file,
  cast(case when p.snap = 0 then '2025-03-02' else '2025-06-02' end as date) as _loaded_at
from (select *, 0 as snap from {part} union all select *, 1 as snap from {part} where p_partkey % 2 = 0) p
"""

VIEWS["raw_calendar"] = """
select
  'NATION_' || cast(e.user_id % 25 as string) as city,
  case when e.event_id % 2 = 0 then '2024-01-01' else '2024-02-01' end as snapshot_date,
  cast(e.user_id as string) as listing_id, cast(cast(e.ts as date) + cast(31 * (e.event_id % 13) as int) as string) as calendar_date,
  case when e.event_type in ('error', 'purchase') then 'f' else 't' end as available,
  cast(1 + e.event_id % 5 as string) as minimum_nights, '365' as maximum_nights,
  'calendar' as _source_file, cast('2024-02-02' as date) as _loaded_at
from {events} e
"""

VIEWS["raw_reviews"] = """
select
  d.source as city, case when d.snap = 0 then '2024-03-01' else '2024-06-01' end as snapshot_date,
  case when d.doc_id % 97 = 13 then 'x' || cast(d.doc_id as string) else cast(d.doc_id as string) end as review_id,
  cast(d.doc_id % (select count(*) from {part}) as string) as listing_id,
  cast(date '2023-01-01' + cast(d.doc_id % 700 as int) as string) as review_date,
  cast(d.doc_id % 500 as string) as reviewer_id,
  case when d.doc_id % 101 = 7 then ' <br/> ' else '<BR >' || d.text || '<br/>&amp;lt; &quot;' || d.lang || '&quot; '
    || case when d.snap = 1 then 'edited' else '' end end as comments,
  'reviews/' || cast(d.snap as string) as _source_file,
  cast(case when d.snap = 0 then '2024-03-02' else '2024-06-02' end as date) as _loaded_at
from (select *, 0 as snap from {documents} union all
      select *, 1 as snap from {documents} where doc_id % 5 = 0) d
"""

VIEWS["raw_airports"] = """
select
  cast(s.s_suppkey as string) as id, 'K' || cast(s.s_suppkey as string) as ident,
  case when s.s_suppkey % 4 = 0 then 'large_airport' when s.s_suppkey % 4 = 1 then 'small_airport'
       when s.s_suppkey % 4 = 2 then 'heliport' else 'medium_airport' end as type,
  s.s_name as name, cast(cast(s.s_acctbal as decimal(10,2)) as string) as latitude_deg,
  'bad' as longitude_deg, cast(s.s_suppkey * 3 as string) || '.5' as elevation_ft, r.r_name as continent,
  'N' || cast(n.n_nationkey as string) as iso_country, 'R' || cast(r.r_regionkey as string) as iso_region,
  n.n_name as municipality, case when s.s_suppkey % 3 = 0 then 'yes' else 'no' end as scheduled_service,
  ' ' as icao_code,
  case when s.s_suppkey % 7 = 0 then '' when s.s_suppkey % 2 = 0 then upper(substr(r.r_name, 1, 3)) || ' '
       else 'X' || lpad(cast(s.s_suppkey % 20 as string), 2, '0') end as iata_code,
  'airports' as _source_file, cast('2024-01-01' as date) as _loaded_at
from {supplier} s
join {nation} n on n.n_nationkey = s.s_nationkey
join {region} r on r.r_regionkey = n.n_regionkey
"""

VIEWS["raw_countries"] = """
select cast(n.n_nationkey as string) as id, 'N' || cast(n.n_nationkey as string) as code, n.n_name as name,
       r.r_name as continent, 'countries' as _source_file, cast('2024-01-01' as date) as _loaded_at
from {nation} n join {region} r on r.r_regionkey = n.n_regionkey
"""

VIEWS["raw_regions"] = """
select cast(r.r_regionkey as string) as id, 'R' || cast(r.r_regionkey as string) as code, r.r_name as name,
       r.r_name as continent, 'N0' as iso_country, 'regions' as _source_file, cast('2024-01-01' as date) as _loaded_at
from {region} r
"""

VIEWS["cities"] = """
select n.n_name as city, 'City of ' || n.n_name as city_name, 'N' || cast(n.n_nationkey as string) as country_code,
       case n.n_regionkey when 0 then 'EUR' when 1 then 'USD' when 2 then 'JPY' when 3 then 'GBP' else 'TRY' end
         as currency_code, n.n_regionkey = 1 as is_us
from {nation} n
"""

VIEWS["city_airports"] = """
select n.n_name as city, case when n.n_nationkey % 2 = 0 then cast(null as string) else 'PROMO' end
         as neighbourhood_group,
       n.n_name as metro_key,
       case when n.n_nationkey < 5 then upper(substr(r.r_name, 1, 3))
            else 'X' || lpad(cast(n.n_nationkey - 5 as string), 2, '0') end as iata_code
from {nation} n join {region} r on r.r_regionkey = n.n_regionkey
"""

VIEWS["airlines"] = """
select 'C' || lpad(cast(s.s_suppkey % 18 as string), 2, '0') as airline_code, min(s.s_name) as airline_name,
       case when s.s_suppkey % 18 < 6 then 'mainline' when s.s_suppkey % 18 < 12 then 'low_cost' else 'regional' end
         as carrier_type,
       case when s.s_suppkey % 18 >= 12 then 'C' || lpad(cast(s.s_suppkey % 18 - 12 as string), 2, '0') end
         as parent_airline_code
from {supplier} s group by s.s_suppkey % 18
"""

VIEWS["airport_code_aliases"] = """
select 'Z' || lpad(cast(r.r_regionkey as string), 2, '0') as iata_code, 'K' || cast(r.r_regionkey as string)
         as airport_ident
from {region} r
"""

VIEWS["fx_rates"] = """
select q.rate_date, q.currency_code,
       cast(case q.currency_code when 'USD' then 1 else 0.5 + length(q.currency_code) * 0.01
              + cast(extract(month from q.rate_date) as int) * 0.003 end as decimal(18,8)) as usd_per_unit
from (
  select cast(substr(booked_at, 1, 10) as date) as rate_date, currency_code from {raw_stay_bookings}
  union
  select cast(l.snapshot_date as date) as rate_date, c.currency_code
  from {raw_listings} l join {cities} c on c.city = l.city
) q
where not (q.currency_code = 'TRY' and extract(month from q.rate_date) = 3)
"""

VIEWS["enrich_rows"] = """
select l.doc_id as review_id, d.lang as language,
  case when l.quality = 1 and l.toxic = 0 then 'positive' when l.quality = 0 and l.toxic = 0 then 'neutral'
       when l.quality = 1 then 'mixed' else 'negative' end as sentiment,
  case when l.quality = 1 and l.toxic = 0 then 0.8e0 when l.quality = 0 and l.toxic = 0 then 0e0
       when l.quality = 1 then -0.1e0 else -0.9e0 end as sentiment_score,
  case l.doc_id % 4 when 0 then '' when 1 then 'location' when 2 then 'value,noise' else 'location,value,comfort' end
    as topics_text,
  case when l.toxic = 1 then 'complaint about ' || d.source end as complaint,
  l.doc_id % 7 = 0 as mentions_travel_disruption, 'Review ' || cast(l.doc_id as string) as summary_en
from {labels} l join {documents} d on d.doc_id = l.doc_id
"""


# a view's driving table and the columns that spread it evenly
SPREAD = {"flight_rows": ("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]),
          "raw_stay_bookings": ("orders", ["o_orderkey"]), "raw_reviews": ("documents", ["doc_id"]),
          "raw_calendar": ("events", ["event_id"]), "raw_listings": ("part", ["p_partkey"])}

# raw tables that can be made in parts: columns that cut the tables they are made of, and the key their rows are typed by
_OF_ORDERS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
CUTS = {"raw_flights": _OF_ORDERS, "raw_flight_bookings": _OF_ORDERS, "raw_stay_bookings": {"orders": "o_orderkey"},
        "raw_reviews": {"documents": "doc_id"}}
_FLIGHT = ["flight_date", "reporting_airline", "flight_number", "origin", "dest", "crs_dep_time"]
RAW_KEYS = {"raw_flights": lambda: flight_key(*map(F.col, _FLIGHT)),
            "raw_flight_bookings": lambda: cast_try_number(F.col("flight_booking_id")),
            "raw_stay_bookings": lambda: cast_try_number(F.col("stay_booking_id")),
            "raw_reviews": lambda: cast_try_number(F.col("review_id"))}


def dependencies(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Inputs:
    """Given, derived and modelled tables over one data folder, each built on first use and only once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._model(name) if name in MODELS else self._table(name)
        return self._built[name]

    def parts(self, name: str) -> Parts:
        """A model of one raw table, in parts that hold all rows of their keys: the raw rows are made slice by slice, stored by
        key, and typed key part by key part. A small one is a single part, and nothing is stored."""
        raw = name
        while raw in MODELS:
            (raw,) = MODELS[raw][1]
        count = parts_for(self[raw])
        if count == 1:
            return Parts(1, [self[name]])
        dealt = deal_by_key((self._cut(raw, n, count) for n in range(count)), RAW_KEYS[raw](), count)
        return Parts(count, (self._over(**{raw: rows})[name] for rows in dealt))

    def _cut(self, raw: str, number: int, count: int) -> DataFrame:
        return self._over(**{
            table: self[table].filter(F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(count)) == number)
            for table, column in CUTS[raw].items()})[raw]

    def _over(self, **tables: DataFrame) -> Inputs:
        """The same folder with some tables given."""
        other = Inputs(self.spark, self.sf_dir)
        other._built.update(tables)
        return other

    def _model(self, name: str) -> DataFrame:
        fn, needs = MODELS[name]
        return fn(*[self[n] for n in needs])

    def _table(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name == "enrichments":
            topics = F.filter(F.split("topics_text", ","), lambda x: x != "")
            return self["enrich_rows"].withColumn("topics", topics).drop("topics_text")
        inputs = {d: self[d] for d in dependencies(VIEWS[name])}
        if name in SPREAD:
            driving, columns = SPREAD[name]
            inputs[driving] = spread_small_scan(inputs[driving], columns)
        return self.spark.sql(VIEWS[name], **inputs)


def _models():
    import datetime as dt

    from wayline.plans import dims, facts, marts, staging
    as_of = dt.date(2025, 6, 30)
    return {
        "stg_flights": (staging.stg_flights, ["raw_flights"]),
        "stg_listings": (staging.stg_listings, ["raw_listings", "cities"]),
        "stg_calendar": (staging.stg_calendar, ["raw_calendar"]),
        "stg_reviews": (staging.stg_reviews, ["raw_reviews"]),
        "stg_airports": (staging.stg_airports, ["raw_airports"]),
        "stg_countries": (staging.stg_countries, ["raw_countries"]),
        "stg_regions": (staging.stg_regions, ["raw_regions"]),
        "stg_users": (staging.stg_users, ["raw_users"]),
        "stg_stay_bookings": (staging.stg_stay_bookings, ["raw_stay_bookings"]),
        "stg_flight_bookings": (staging.stg_flight_bookings, ["raw_flight_bookings"]),
        "dim_airlines": (dims.dim_airlines, ["airlines", "stg_flights"]),
        "dim_airports": (dims.dim_airports, ["stg_airports", "stg_regions", "stg_countries", "city_airports",
                                             "airport_code_aliases"]),
        "dim_cities": (dims.dim_cities, ["cities", "stg_countries", "city_airports", "stg_listings"]),
        "dim_listings": (dims.dim_listings, ["stg_listings", "fx_rates"]),
        "dim_users": (lambda u, c: dims.dim_users(u, c, as_of), ["stg_users", "city_airports"]),
        "fct_flights": (facts.fct_flights, ["stg_flights"]),
        "fct_stay_bookings": (facts.fct_stay_bookings, ["stg_stay_bookings", "fx_rates"]),
        "fct_flight_bookings": (facts.fct_flight_bookings, ["stg_flight_bookings"]),
        "mart_airline_performance": (marts.mart_airline_performance, ["fct_flights", "airlines", "dim_airports"]),
        "mart_city_revenue": (marts.mart_city_revenue, ["fct_stay_bookings", "dim_listings"]),
        "mart_forward_occupancy": (marts.mart_forward_occupancy, ["stg_calendar", "dim_listings"]),
        "mart_traveler_disruption": (marts.mart_traveler_disruption,
                                     ["fct_flight_bookings", "fct_flights", "airlines"]),
        "mart_user_cohorts": (marts.mart_user_cohorts, ["fct_stay_bookings"]),
        "mart_review_insights": (marts.mart_review_insights, ["enrichments", "stg_reviews"]),
        "mart_delay_impact": (marts.mart_delay_impact, ["fct_stay_bookings", "fct_flight_bookings", "fct_flights",
                                                        "enrichments"]),
    }


MODELS = _models()
