"""One test per semantic trap, on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wayline import functions as fn
from wayline.operators import enrichment, vectors
from wayline.operators import relational as rel
from wayline.operators import windows as win
from wayline.plans import dims, facts, marts, staging
from wayline.sources.schemas import bronze_schema

C = F.col


def values(spark, rows, schema, **exprs):
    df = spark.createDataFrame(rows, schema).select(*[e.alias(n) for n, e in exprs.items()])
    return [tuple(r) for r in df.collect()]


def raw(spark, table, rows):
    """Raw rows from dicts; missing fields are NULL."""
    schema = bronze_schema(table, lineage=True)
    when = dt.datetime(2024, 1, 1)
    full = [tuple({"_source_file": "f", "_loaded_at": when, **r}.get(n) for n in schema.names) for r in rows]
    return spark.createDataFrame(full, schema)


def test_t1_numbers_round_half_away(spark):
    rows = [("3.7",), ("-2.5",), ("",), (" 7 ",), ("1e3",), ("abc",), (None,)]
    got = values(spark, rows, "a string", n=fn.cast_try_number(C("a")), d=fn.cast_try_number(C("a"), 10, 2))
    assert [g[0] for g in got] == [4, -3, None, 7, 1000, None, None]
    assert got[0][1] == Decimal("3.70") and got[5][1] is None


def test_t2_safe_ratio(spark):
    rows = [(1, 0), (0, 0), (None, 2), (2, None), (1, 3), (None, 0)]
    got = values(spark, rows, "a long, b long", r=fn.agg_safe_ratio(C("a"), C("b"), 4))
    assert [g[0] for g in got] == [0, 0, None, None, Decimal("0.3333"), None]


def test_t3_null_is_largest(spark):
    rows = [("k", None, "unknown"), ("k", dt.date(2024, 1, 1), "known")]
    df = spark.createDataFrame(rows, "k string, ts date, v string")
    assert win.dedup_latest(df, ["k"], "ts").first()["v"] == "unknown"
    assert win.dedup_distinct_on(df, ["k"], [C("ts").asc_nulls_last()]).first()["v"] == "known"


def test_t4_boundaries(spark):
    rows = [(dt.date(2000, 12, 31), dt.date(2001, 1, 1)), (dt.date(2024, 1, 31), dt.date(2024, 2, 1))]
    got = values(spark, rows, "a date, b date", y=fn.fn_date_diff("year", C("a"), C("b")),
                 m=fn.fn_date_diff("month", C("a"), C("b")), d=fn.fn_date_diff("day", C("a"), C("b")))
    assert got == [(1, 1, 1), (0, 1, 1)]


def test_t5_clock(spark):
    rows = [("659",), ("0659",), ("2400",), ("2460",), ("1299",), ("ab",), (None,), ("2359",)]
    got = values(spark, rows, "a string", m=fn.fn_lpad_clock(C("a")))
    assert [g[0] for g in got] == [419, 419, 0, None, None, None, None, 1439]


def test_t6_t7_flight_times_and_status(spark):
    base = {"flight_date": "2024-03-05", "reporting_airline": " aa ", "flight_number": "12", "origin": "jfk",
            "dest": "LAX"}
    rows = [{**base, "flight_number": "1", "crs_dep_time": "2330", "crs_arr_time": "115", "arr_delay": "15.00",
             "dep_delay": "-5.00"},
            {**base, "flight_number": "2", "crs_dep_time": "2400", "crs_arr_time": "0130"},
            {**base, "flight_number": "3", "crs_dep_time": "0900", "crs_arr_time": "1000", "cancelled": "1.00",
             "diverted": "1.00", "cancellation_code": "B", "arr_delay": "99"},
            {**base, "flight_number": "4", "crs_dep_time": "0900", "crs_arr_time": "1000", "diverted": "1"}]
    got = {r["flight_number"]: r for r in staging.stg_flights(raw(spark, "flights", rows)).collect()}
    assert got[1]["scheduled_arrival_at"] == dt.datetime(2024, 3, 6, 1, 15)
    assert got[1]["actual_departure_at"] == dt.datetime(2024, 3, 5, 23, 25)
    assert got[1]["arrival_status"] == "delayed" and got[1]["airline_code"] == "AA"
    assert got[2]["scheduled_departure_at"] == dt.datetime(2024, 3, 5) and got[2]["arrival_status"] == "on_time"
    assert got[3]["arrival_status"] == "cancelled" and got[3]["cancellation_reason"] == "weather"
    assert got[4]["arrival_status"] == "diverted" and got[4]["is_cancelled"] is False


def test_flight_key_matches_on_both_sides(spark):
    flight = raw(spark, "flights", [{"flight_date": "2024-03-05", "reporting_airline": " aa", "flight_number": "007",
                                     "origin": "jfk ", "dest": "lax", "crs_dep_time": "659"}])
    leg = raw(spark, "flight_bookings", [{"flight_booking_id": "1", "flight_date": "2024-03-05", "airline_code": "AA",
                                          "flight_number": "7", "origin": "JFK", "dest": "LAX",
                                          "crs_dep_time": "0659"}])
    assert staging.stg_flights(flight).first()["flight_id"] == staging.stg_flight_bookings(leg).first()["flight_id"]


def test_t8_price_without_rate_is_luxury(spark):
    cities = spark.createDataFrame([("x", "X", "US", "USD", True)],
                                   "city string, city_name string, country_code string, currency_code string, "
                                   "is_us boolean")
    rows = [{"listing_id": str(i), "city": "x", "snapshot_date": "2024-01-01", "price": p}
            for i, p in enumerate(["$10.00", None, "$1,299.50"])]
    fx = spark.createDataFrame([], "rate_date date, currency_code string, usd_per_unit decimal(18,8)")
    listings = staging.stg_listings(raw(spark, "listings", rows), cities)
    got = {r["listing_id"]: r for r in dims.dim_listings(listings, fx).collect()}
    assert got[0]["price_band"] == "luxury" and got[0]["price_usd"] is None
    assert got[1]["price_band"] is None and got[2]["price_local"] == Decimal("1299.50")


def test_t9_unknown_birth_date_and_birthday(spark):
    rows = [{"user_id": "1"}, {"user_id": "2", "birth_date": "2000-12-31"}, {"user_id": "3", "birth_date": "1960-01-01"}]
    airports = spark.createDataFrame([], "city string, neighbourhood_group string, metro_key string, iata_code string")
    got = {r["user_id"]: r for r in dims.dim_users(staging.stg_users(raw(spark, "users", rows)), airports,
                                                   dt.date(2025, 1, 1)).collect()}
    assert (got[1]["age"], got[1]["age_band"]) == (None, "65+")
    assert (got[2]["age"], got[2]["age_band"]) == (25, "25-34")
    assert got[3]["age_band"] == "65+"


def test_t10_html(spark):
    rows = [("a<BR/>b<br >c",), ("&amp;lt;",), ("&quot;x&#39;",), ("  <br>  ",), (None,)]
    got = values(spark, rows, "a string", t=fn.fn_clean_html(C("a")))
    assert [g[0] for g in got][:3] == ["a\nb\nc", "<", "\"x'"] and got[4][0] is None


def test_t11_cohorts_include_cancelled_first_booking(spark):
    rows = [(1, dt.datetime(2024, 1, 31), True, Decimal("10.00")), (1, dt.datetime(2024, 2, 1), False, Decimal("20.00")),
            (2, dt.datetime(2024, 1, 5), False, Decimal("5.00")), (None, dt.datetime(2024, 1, 5), False, Decimal("5.00"))]
    stays = spark.createDataFrame(rows, "user_id long, booked_at timestamp_ntz, is_cancelled boolean, "
                                        "total_amount_usd decimal(14,2)")
    got = {(r["cohort_month"].month, r["months_since_first_booking"]): r for r in marts.mart_user_cohorts(stays).collect()}
    assert got[(1, 0)]["cohort_users"] == 2 and got[(1, 0)]["gross_booking_value_usd"] == Decimal("5.00")
    assert got[(1, 1)]["active_users"] == 1 and got[(1, 1)]["retention_rate"] == Decimal("0.5000")
    assert len(got) == 2


def test_t12_disruption_counts(spark):
    flights = spark.createDataFrame([("a", True, False, None), ("b", False, True, None), ("c", False, False, 75),
                                     ("d", False, False, None)],
                                    "flight_id string, is_cancelled boolean, is_diverted boolean, arr_delay_min int")
    legs = spark.createDataFrame([(f, dt.date(2024, 1, 2), "AA", "outbound", 2, Decimal("10.00")) for f in "abcd"],
                                 "flight_id string, flight_date date, airline_code string, leg string, "
                                 "passengers long, total_fare_usd decimal(12,2)")
    airlines = spark.createDataFrame([("AA", "A")], "airline_code string, airline_name string")
    row = marts.mart_traveler_disruption(legs, flights, airlines).first()
    assert row["passengers_disrupted"] == 4 and row["disruption_rate"] == Decimal("0.7500")


def test_t13_latest_snapshot_keeps_repeats(spark):
    rows = [{"city": "x", "snapshot_date": s, "listing_id": "1", "calendar_date": "2024-05-01", "available": a}
            for s, a in [("2024-01-01", "t"), ("2024-02-01", "f"), ("2024-02-01", "f")]]
    got = staging.stg_calendar(raw(spark, "calendar", rows)).collect()
    assert len(got) == 2 and all(r["is_available"] is False for r in got)


def test_t14_null_ids(spark):
    reviews = [{"review_id": "x"}, {"review_id": None}, {"review_id": "5", "comments": "a"}]
    assert staging.stg_reviews(raw(spark, "reviews", reviews)).count() == 1
    users = [{"user_id": "x"}, {"user_id": None}, {"user_id": "5"}]
    assert staging.stg_users(raw(spark, "users", users)).count() == 2


def test_t15_flatten_drops_empty(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, ["a", "b"])], "k int, topics array<string>")
    assert rel.lateral_flatten(df, "topics", "topic").count() == 2


def test_t16_cap_keeps_order(spark):
    df = spark.range(600).orderBy(C("id").desc())
    assert [r[0] for r in rel.limit_rows_cap(df).collect()] == list(range(599, 99, -1))


def test_t17_hash_is_stable(spark):
    import hashlib
    rows = [(7,), (8,)]
    got = values(spark, rows, "k long", a=fn.hash_uniform(C("k"), "s"), b=fn.hash_uniform(C("k"), "t"))
    want = [int(hashlib.md5(f"{k}|s|42".encode()).hexdigest()[:15], 16) % 1000000007 / 1000000007 for k in (7, 8)]
    assert [g[0] for g in got] == want and got[0][0] != got[0][1]


def test_booleans_dates_and_flags(spark):
    rows = [("t", "2024", "1.00"), ("OFF", "2024-02-30", "0"), ("maybe", "2024-02-29", None), (None, None, "x")]
    got = values(spark, rows, "a string, b string, c string", a=fn.cast_try_boolean(C("a")),
                 b=fn.cast_try_date(C("b")), c=fn.cast_numeric_flag(C("c")))
    assert [g[0] for g in got] == [True, False, None, None]
    assert [g[1] for g in got] == [None, None, dt.date(2024, 2, 29), None]
    assert [g[2] for g in got] == [True, False, False, False]


def test_timestamp_does_not_depend_on_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:    # 02:30 does not exist on this day in New York
        got = values(spark, [("2024-03-10 02:30:00",)], "a string", t=fn.cast_try_timestamp(C("a")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(dt.datetime(2024, 3, 10, 2, 30),)]


def test_ascii_fold(spark):
    rows = [("Zoë",), ("Łukasz",), ("Straße",), ("李",), (None,)]
    got = values(spark, rows, "a string", f=fn.fn_ascii_fold(C("a")))
    assert [g[0] for g in got] == ["zoe", "lukasz", "strasse", "traveler", None]


def test_airports_priority_and_alias(spark):
    rows = [{"id": "1", "ident": "K1", "iata_code": "AAA", "type": "large_airport", "scheduled_service": "no"},
            {"id": "2", "ident": "K2", "iata_code": "AAA", "type": "small_airport", "scheduled_service": "yes"},
            {"id": "3", "ident": "K3", "iata_code": "", "type": "heliport", "scheduled_service": "yes"}]
    empty = {"regions": "region_code string, region_name string", "countries": "country_code string, country_name string",
             "city_airports": "city string, neighbourhood_group string, metro_key string, iata_code string"}
    frames = [spark.createDataFrame([], s) for s in empty.values()]
    aliases = spark.createDataFrame([("ZZZ", "K2", "renamed")], "iata_code string, airport_ident string, reason string")
    got = {r["iata_code"]: r["airport_type"] for r in dims.dim_airports(
        staging.stg_airports(raw(spark, "airports", rows)), *frames, aliases).collect()}
    assert got == {"AAA": "small_airport", "ZZZ": "small_airport"}


@pytest.mark.parametrize("city,want", [(None, 3), ("a", 2)])
def test_optional_filter(spark, city, want):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "city string")
    assert rel.filter_optional_param(df, "city", city).count() == want


def test_large_numbers_become_values_or_null_but_stop_no_job(spark):
    rows = [("97%",), ("1000000000000000000%",), ("99999999999999999999%",)]
    got = [g[0] for g in values(spark, rows, "a string", p=fn.fn_percent(C("a")))]
    assert got == [Decimal("0.97"), Decimal(10**16), None]
    stay = {"booked_at": "2024-01-01 10:00:00", "currency_code": "USD", "nightly_rate": "9999999999.99"}
    stays = raw(spark, "stay_bookings", [
        {**stay, "stay_booking_id": "1", "nights": "1000000"}, {**stay, "stay_booking_id": "2", "nights": "2"},
        {**stay, "stay_booking_id": "3", "nights": str(10**18)}])
    fx = spark.createDataFrame([(dt.date(2024, 1, 1), "USD", Decimal(1))],
                               "rate_date date, currency_code string, usd_per_unit decimal(18,8)")
    fact = {r["stay_booking_id"]: r for r in facts.fct_stay_bookings(staging.stg_stay_bookings(stays), fx).collect()}
    assert fact[1]["nights"] == 1_000_000 and fact[1]["accommodation_usd"] == Decimal("9999999999990000.00")
    assert fact[2]["accommodation_usd"] == Decimal("19999999999.98") and fact[3]["accommodation_usd"] is None


def test_first_load_keeps_rows_without_a_load_time(spark):
    rows = raw(spark, "users", [{"user_id": "1", "_loaded_at": None}, {"user_id": "2"}])
    assert facts.new_rows(rows, None).count() == 2


def test_question_without_text_keeps_its_row(spark):
    hits = spark.createDataFrame([(1, 1, "x", dt.date(2024, 1, 1), None), (2, 2, "x", dt.date(2024, 1, 1), "b"),
                                  (2, 1, None, None, None)],
                                 "query_id long, rank int, city string, review_date date, comment_text string")
    got = {r["query_id"]: (r["n_hits"], r["context"]) for r in vectors.rag_context(hits).collect()}
    assert got == {1: (0, ""), 2: (1, "[2] (x, 2024-01-01) b")}


def test_one_of_several_results_is_taken_in_order(spark):
    results = spark.createDataFrame([(1, "b", None), (1, "a", None), (2, "c", "late"), (2, "d", None)],
                                    "review_id long, v string, error string")
    target = spark.createDataFrame([], "review_id long, v string")
    for _ in range(3):
        got = enrichment.enrich_failed_retry(results.repartition(3), target, [C("v")]).collect()
        assert sorted(tuple(r) for r in got) == [(1, "a"), (2, "d")]
