"""Facts. Each function gives the full fact; ``new_rows`` restricts a run to what was loaded since."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.functions.dates import fn_date_diff
from wayline.functions.numbers import fn_fx_convert
from wayline.operators.relational import filter_high_water, join_multi_key_fx
from wayline.sources.sinks import Buckets

# key, date column, and whether the key holds the date
FACT_KEYS = {"fct_flights": ("flight_id", "flight_date", True),
             "fct_stay_bookings": ("stay_booking_id", "checkin_date", False),
             "fct_flight_bookings": ("flight_booking_id", "flight_date", False)}


def flight_buckets(count: int) -> dict[str, Buckets]:
    """Layouts in which booked legs and flights join on the flight without a shuffle."""
    return {name: Buckets("flight_id", count) for name in ("fct_flights", "fct_flight_bookings")}


def new_rows(raw: DataFrame, fact: DataFrame | None) -> DataFrame:
    """Raw rows loaded after the newest time of the fact (or of its load mark), cut before the dedup so the scan can skip old files.
    The result is the same: a key's newest row either passes, or the key has nothing new."""
    return filter_high_water(raw, fact, "_loaded_at")


def fct_flights(flights: DataFrame) -> DataFrame:
    return flights.select(
        "flight_id", "flight_date", "airline_code", "flight_number", "tail_number", "origin_airport",
        "dest_airport", "distance_miles", "scheduled_departure_at", "scheduled_arrival_at", "actual_departure_at",
        "actual_arrival_at", F.hour("scheduled_departure_at").alias("scheduled_dep_hour"), "dep_delay_min",
        "arr_delay_min", "taxi_out_min", "taxi_in_min", "scheduled_elapsed_min", "actual_elapsed_min",
        "air_time_min", "arrival_status", "is_cancelled", "is_diverted", "is_dep_delayed_15", "is_arr_delayed_15",
        "cancellation_reason", "carrier_delay_min", "weather_delay_min", "nas_delay_min", "security_delay_min",
        "late_aircraft_delay_min", "_loaded_at")


def _lodging_usd(nightly: Column, nights: Column, rate: Column) -> Column:
    """Nightly rate times nights in the report currency; a product too large for money is NULL."""
    usual = fn_fx_convert(nightly * nights.try_cast("decimal(6,0)"), rate)
    large = F.try_multiply((nightly * nights.cast("decimal(19,0)")).try_cast("decimal(20,2)"), rate)
    kind = "decimal(24,2)"
    return F.when(nights.between(-999_999, 999_999), usual.try_cast(kind)).otherwise(
        F.round(large, 2).try_cast(kind))


def fct_stay_bookings(stays: DataFrame, fx: DataFrame) -> DataFrame:
    """Stays with local and converted money, at the rate of the booking day."""
    day = F.col("booked_at").cast("date")
    joined = join_multi_key_fx(stays.withColumn("booking_date", day), fx, "currency_code", F.col("booking_date"))
    rate = F.col("usd_per_unit")

    def usd(amount) -> F.col:
        return fn_fx_convert(amount, rate)

    return joined.select(
        "stay_booking_id", "user_id", "listing_id", "city", "review_id",
        F.col("review_id").isNotNull().alias("has_review"), "booked_at", "booking_date", "checkin_date",
        "checkout_date", fn_date_diff("day", F.col("booking_date"), F.col("checkin_date")).alias("lead_time_days"),
        "nights", "guests", "booking_status", (F.col("booking_status") == "cancelled").alias("is_cancelled"),
        "cancelled_at", "payment_method", "booking_channel", "currency_code", "nightly_rate_local",
        "total_amount_local", rate.alias("fx_usd_per_unit"),
        usd(F.col("nightly_rate_local")).alias("nightly_rate_usd"),
        _lodging_usd(F.col("nightly_rate_local"), F.col("nights"), rate).alias("accommodation_usd"),
        usd(F.col("cleaning_fee_local")).alias("cleaning_fee_usd"),
        usd(F.col("service_fee_local")).alias("service_fee_usd"),
        usd(F.col("total_amount_local")).alias("total_amount_usd"),
        usd(F.col("refund_amount_local")).alias("refund_amount_usd"), "_loaded_at")


def fct_flight_bookings(legs: DataFrame) -> DataFrame:
    booked = F.col("booked_at").cast("date")
    return legs.select(
        "flight_booking_id", "stay_booking_id", "user_id", "flight_id", "leg", "booked_at",
        booked.alias("booking_date"), "flight_date",
        fn_date_diff("day", booked, F.col("flight_date")).alias("lead_time_days"), "airline_code",
        "origin_airport", "dest_airport", "cabin_class", "passengers", "fare_per_passenger_usd", "total_fare_usd",
        "booking_status", "_loaded_at")
