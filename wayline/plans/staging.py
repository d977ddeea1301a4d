"""Raw text tables -> typed rows, one per business key (the newest load wins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.functions.casts import (cast_numeric_flag, cast_try_boolean, cast_try_date, cast_try_double,
                                     cast_try_int, cast_try_number, cast_try_timestamp)
from wayline.functions.dates import fn_date_add, fn_lpad_clock, fn_timestamp_from_parts
from wayline.functions.numbers import project_decode, project_null_handling
from wayline.functions.text import (flight_key, fn_clean_html, fn_json_array, fn_json_to_array, fn_percent,
                                    fn_replace_money, fn_trim_case)
from wayline.operators.relational import join_latest_snapshot, join_left_dim
from wayline.operators.windows import dedup_latest, dedup_latest_two_keys

# Carrier codes of a cancellation, and the lateness that counts as delayed.
CANCELLATION_REASONS = {"A": "carrier", "B": "weather", "C": "national_air_system", "D": "security"}
LATE_MINUTES = 15

_TIE = ["_source_file"]     # two rows of one load time are told apart by their file


def _numbers(*names: str) -> list:
    return [cast_try_number(F.col(n)).alias(n) for n in names]


def stg_flights(raw: DataFrame) -> DataFrame:
    """One row per scheduled flight. Actual times are scheduled times plus the reported delay."""
    c = F.col
    minutes = {"dep_delay_min": "dep_delay", "arr_delay_min": "arr_delay", "taxi_out_min": "taxi_out",
               "taxi_in_min": "taxi_in", "scheduled_elapsed_min": "crs_elapsed_time",
               "actual_elapsed_min": "actual_elapsed_time", "air_time_min": "air_time",
               "carrier_delay_min": "carrier_delay", "weather_delay_min": "weather_delay",
               "nas_delay_min": "nas_delay", "security_delay_min": "security_delay",
               "late_aircraft_delay_min": "late_aircraft_delay", "distance_miles": "distance"}
    flags = {"is_cancelled": "cancelled", "is_diverted": "diverted", "is_dep_delayed_15": "dep_del15",
             "is_arr_delayed_15": "arr_del15"}
    # one rule over an array instead of thirteen copies of it: a generated method of over 8,000 bytes is never compiled
    keyed = raw.withColumn("flight_id", flight_key(c("flight_date"), c("reporting_airline"), c("flight_number"),
                                                   c("origin"), c("dest"), c("crs_dep_time"))).withColumn(
        "_minutes", F.transform(F.array(*minutes.values()), cast_try_int))
    # numbers, dates and flags go through the dedup's shuffle and sort, not the raw texts
    typed = dedup_latest(keyed.select(
        "flight_id", cast_try_date(c("flight_date")).alias("flight_date"),
        fn_trim_case(c("reporting_airline")).alias("airline_code"),
        cast_try_number(c("flight_number")).alias("flight_number"),
        project_null_handling(c("tail_number")).alias("tail_number"),
        fn_trim_case(c("origin")).alias("origin_airport"), "origin_city_name", "origin_state",
        fn_trim_case(c("dest")).alias("dest_airport"), "dest_city_name", "dest_state",
        fn_lpad_clock(c("crs_dep_time")).alias("scheduled_dep_minute"),
        fn_lpad_clock(c("crs_arr_time")).alias("scheduled_arr_minute"),
        *[c("_minutes")[i].alias(out) for i, out in enumerate(minutes)],
        *[cast_numeric_flag(c(src)).alias(out) for out, src in flags.items()],
        project_decode(c("cancellation_code"), CANCELLATION_REASONS).alias("cancellation_reason"),
        "_source_file", "_loaded_at"), ["flight_id"], "_loaded_at", _TIE)
    next_day = F.coalesce((c("scheduled_arr_minute") < c("scheduled_dep_minute")).cast("int"), F.lit(0))
    timed = typed.withColumns({
        "scheduled_departure_at": fn_timestamp_from_parts(c("flight_date"), c("scheduled_dep_minute")),
        "scheduled_arrival_at": fn_timestamp_from_parts(F.date_add(c("flight_date"), next_day),
                                                        c("scheduled_arr_minute")),
        "arrival_status": F.when(c("is_cancelled"), "cancelled").when(c("is_diverted"), "diverted")
        .when(c("arr_delay_min") >= LATE_MINUTES, "delayed").otherwise("on_time")})
    return timed.withColumns({
        "actual_departure_at": fn_date_add(c("scheduled_departure_at"), "minute", c("dep_delay_min")),
        "actual_arrival_at": fn_date_add(c("scheduled_arrival_at"), "minute", c("arr_delay_min"))})


def stg_listings(raw: DataFrame, cities: DataFrame) -> DataFrame:
    """Newest state of each listing; the price is in the city's own currency."""
    c = F.col
    plain = ["accommodates", "bedrooms", "beds", "minimum_nights", "maximum_nights", "availability_30",
             "availability_90", "availability_365", "number_of_reviews", "number_of_reviews_ltm"]
    scores = ["rating", "accuracy", "cleanliness", "checkin", "communication", "location", "value"]
    keyed = raw.withColumns({"_id": cast_try_number(c("listing_id")), "_snap": cast_try_date(c("snapshot_date"))})
    typed = dedup_latest_two_keys(keyed.select(
        c("_id").alias("listing_id"), "city", c("_snap").alias("snapshot_date"),
        cast_try_date(c("last_scraped")).alias("last_scraped_date"), c("name").alias("listing_name"),
        fn_clean_html(c("description")).alias("description"), cast_try_number(c("host_id")).alias("host_id"),
        cast_try_date(c("host_since")).alias("host_since"),
        fn_percent(c("host_response_rate")).alias("host_response_rate"),
        fn_percent(c("host_acceptance_rate")).alias("host_acceptance_rate"),
        cast_try_boolean(c("host_is_superhost")).alias("is_superhost"),
        cast_try_number(c("calculated_host_listings_count")).alias("host_listings_count"),
        c("neighbourhood_cleansed").alias("neighbourhood"),
        c("neighbourhood_group_cleansed").alias("neighbourhood_group"),
        cast_try_double(c("latitude")).alias("latitude"), cast_try_double(c("longitude")).alias("longitude"),
        "property_type", "room_type", cast_try_number(c("bathrooms"), 4, 1).alias("bathrooms"), "bathrooms_text",
        fn_json_to_array(c("amenities")).alias("amenities"), fn_json_array(c("amenities")).alias("amenity_count"),
        fn_replace_money(c("price")).alias("price_local"),
        cast_try_boolean(c("has_availability")).alias("has_availability"),
        cast_try_boolean(c("instant_bookable")).alias("is_instant_bookable"),
        project_null_handling(c("license")).alias("license"), *_numbers(*plain),
        cast_try_date(c("first_review")).alias("first_review_date"),
        cast_try_date(c("last_review")).alias("last_review_date"),
        *[cast_try_number(c(f"review_scores_{s}"), 4, 2).alias(f"review_score_{s}") for s in scores],
        cast_try_number(c("estimated_occupancy_l365d")).alias("estimated_occupied_nights_l365d"),
        cast_try_number(c("estimated_revenue_l365d"), 14, 2).alias("estimated_revenue_local_l365d"),
        "_source_file", "_loaded_at"), ["listing_id"], "snapshot_date", "_loaded_at", _TIE)
    return join_left_dim(typed, cities.select("city", "currency_code"), "city")


def stg_calendar(raw: DataFrame) -> DataFrame:
    """Nights of each city's newest snapshot. The largest table: a group-max and a semi join, no sort."""
    c = F.col
    return join_latest_snapshot(raw, ["city"], "snapshot_date").select(
        cast_try_number(c("listing_id")).alias("listing_id"), "city",
        cast_try_date(c("snapshot_date")).alias("snapshot_date"),
        cast_try_date(c("calendar_date")).alias("calendar_date"),
        cast_try_boolean(c("available")).alias("is_available"),
        *_numbers("minimum_nights", "maximum_nights"), "_loaded_at")


def stg_reviews(raw: DataFrame) -> DataFrame:
    """One row per review with clean text; rows without a valid id are left out first."""
    c = F.col
    keyed = raw.withColumns({"_id": cast_try_number(c("review_id")), "_snap": cast_try_date(c("snapshot_date"))})
    newest = dedup_latest_two_keys(keyed.filter(c("_id").isNotNull()), ["_id"], "_snap", "_loaded_at", _TIE)
    return newest.select(
        c("_id").alias("review_id"), cast_try_number(c("listing_id")).alias("listing_id"), "city",
        cast_try_date(c("review_date")).alias("review_date"),
        cast_try_number(c("reviewer_id")).alias("reviewer_id"), fn_clean_html(c("comments")).alias("comment_text"),
        c("_snap").alias("snapshot_date"), "_loaded_at").withColumn("comment_length", F.length("comment_text"))


def stg_airports(raw: DataFrame) -> DataFrame:
    c = F.col
    newest = dedup_latest(raw.withColumn("_id", cast_try_number(c("id"))), ["_id"], "_loaded_at", _TIE)
    return newest.select(
        c("_id").alias("airport_id"), c("ident").alias("airport_ident"),
        project_null_handling(c("iata_code")).alias("iata_code"),
        project_null_handling(c("icao_code")).alias("icao_code"), c("name").alias("airport_name"),
        c("type").alias("airport_type"), cast_try_double(c("latitude_deg")).alias("latitude"),
        cast_try_double(c("longitude_deg")).alias("longitude"),
        cast_try_number(c("elevation_ft")).alias("elevation_ft"), "continent",
        c("iso_country").alias("country_code"), c("iso_region").alias("region_code"), "municipality",
        (c("scheduled_service") == "yes").alias("has_scheduled_service"), "_loaded_at")


def stg_countries(raw: DataFrame) -> DataFrame:
    c = F.col
    return dedup_latest(raw, ["code"], "_loaded_at", _TIE).select(
        c("code").alias("country_code"), c("name").alias("country_name"), "continent", "_loaded_at")


def stg_regions(raw: DataFrame) -> DataFrame:
    c = F.col
    return dedup_latest(raw, ["code"], "_loaded_at", _TIE).select(
        c("code").alias("region_code"), c("name").alias("region_name"), "continent",
        c("iso_country").alias("country_code"), "_loaded_at")


def stg_users(raw: DataFrame) -> DataFrame:
    c = F.col
    newest = dedup_latest(raw.withColumn("_id", cast_try_number(c("user_id"))), ["_id"], "_loaded_at", _TIE)
    return newest.select(
        c("_id").alias("user_id"), *_numbers("source_reviewer_id"), "first_name", "last_name",
        F.lower("email").alias("email"), "gender", cast_try_date(c("birth_date")).alias("birth_date"),
        "home_country_code", F.nullif(c("home_airport"), F.lit("")).alias("home_airport"), "preferred_language",
        cast_try_timestamp(c("signed_up_at")).alias("signed_up_at"), "acquisition_channel",
        cast_try_boolean(c("marketing_opt_in")).alias("marketing_opt_in"), "_loaded_at")


def stg_stay_bookings(raw: DataFrame) -> DataFrame:
    c = F.col
    newest = dedup_latest(raw.withColumn("_id", cast_try_number(c("stay_booking_id"))), ["_id"], "_loaded_at", _TIE)
    money = {"nightly_rate_local": "nightly_rate", "cleaning_fee_local": "cleaning_fee",
             "service_fee_local": "service_fee", "total_amount_local": "total_amount",
             "refund_amount_local": "refund_amount"}
    return newest.select(
        c("_id").alias("stay_booking_id"), *_numbers("user_id", "listing_id", "review_id", "nights", "guests"),
        "city", cast_try_timestamp(c("booked_at")).alias("booked_at"),
        cast_try_date(c("checkin_date")).alias("checkin_date"),
        cast_try_date(c("checkout_date")).alias("checkout_date"), "currency_code",
        *[cast_try_number(c(src), 14, 2).alias(out) for out, src in money.items()],
        "payment_method", "booking_channel", "booking_status",
        cast_try_timestamp(c("cancelled_at")).alias("cancelled_at"), "_loaded_at")


def stg_flight_bookings(raw: DataFrame) -> DataFrame:
    """One row per booked leg; its flight key is built as in ``stg_flights``."""
    c = F.col
    newest = dedup_latest(raw.withColumn("_id", cast_try_number(c("flight_booking_id"))), ["_id"], "_loaded_at",
                          _TIE)
    return newest.select(
        c("_id").alias("flight_booking_id"), *_numbers("stay_booking_id", "user_id"),
        flight_key(c("flight_date"), c("airline_code"), c("flight_number"), c("origin"), c("dest"),
                   c("crs_dep_time")).alias("flight_id"),
        "leg", cast_try_timestamp(c("booked_at")).alias("booked_at"),
        cast_try_date(c("flight_date")).alias("flight_date"), F.upper("airline_code").alias("airline_code"),
        F.upper("origin").alias("origin_airport"), F.upper("dest").alias("dest_airport"), "cabin_class",
        *_numbers("passengers"),
        cast_try_number(c("fare_per_passenger_usd"), 12, 2).alias("fare_per_passenger_usd"),
        cast_try_number(c("total_fare_usd"), 12, 2).alias("total_fare_usd"), "booking_status", "_loaded_at")
