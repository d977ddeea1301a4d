"""Reporting marts. Counts and sums are stored beside the rates, so reports can roll them up again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.functions.dates import fn_date_diff, fn_date_trunc
from wayline.functions.numbers import agg_mean, agg_safe_ratio
from wayline.operators.relational import join_residual_predicate, lateral_flatten

# Arrival delay bands of the delay report, upper to lower.
DELAY_BANDS = [(180, "3_delayed_3h_plus"), (60, "2_delayed_1_3h"), (15, "1_delayed_15_59m")]


def _share(condition: Column, scale: int = 4) -> Column:
    return agg_safe_ratio(F.count_if(condition), F.count(F.lit(1)), scale)


def _sum_if(condition: Column, value: Column) -> Column:
    """Rows outside the condition, or with an unknown one, add 0."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def mart_airline_performance(flights: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Month x carrier x origin. The counts are grouped on the short codes; names join the small result."""
    c = F.col
    status, delay = c("arrival_status"), c("arr_delay_min")
    causes = ["carrier_delay_min", "weather_delay_min", "nas_delay_min", "security_delay_min",
              "late_aircraft_delay_min"]
    reasons = {"cancelled_carrier": "carrier", "cancelled_weather": "weather",
               "cancelled_nas": "national_air_system", "cancelled_security": "security"}
    grouped = flights.groupBy(fn_date_trunc(c("flight_date"), "month").alias("month"), "airline_code",
                              "origin_airport").agg(
        F.count(F.lit(1)).alias("scheduled_flights"), F.count_if("is_cancelled").alias("cancelled_flights"),
        F.count_if("is_diverted").alias("diverted_flights"),
        F.count_if(status == "on_time").alias("on_time_flights"),
        F.count_if(status == "delayed").alias("delayed_flights"),
        F.count_if(delay >= 60).alias("delayed_60_plus_flights"),
        agg_safe_ratio(F.count_if(status == "on_time"), F.count_if(~c("is_cancelled") & ~c("is_diverted")),
                       4).alias("on_time_rate"),
        _share(c("is_cancelled")).alias("cancellation_rate"),
        agg_mean(F.when(delay > 0, delay), 1, kind="bigint").alias("avg_arrival_delay_when_late_min"),
        agg_mean(c("dep_delay_min"), 1, kind="bigint").alias("avg_departure_delay_min"),
        agg_mean(c("taxi_out_min"), 1, kind="bigint").alias("avg_taxi_out_min"),
        *[F.sum(m).alias(m) for m in causes],
        *[F.count_if(c("cancellation_reason") == r).alias(n) for n, r in reasons.items()])
    named = grouped.join(airlines.select("airline_code", "airline_name", "carrier_type"), "airline_code", "left")
    return named.join(airports.select(c("iata_code").alias("origin_airport"),
                                      c("airport_name").alias("origin_airport_name"),
                                      c("region_code").alias("origin_state")), "origin_airport", "left")


def mart_city_revenue(stays: DataFrame, listings: DataFrame) -> DataFrame:
    """Check-in month x city x room type."""
    c = F.col
    kept, lost = ~c("is_cancelled"), c("is_cancelled")
    rows = stays.select("listing_id", "checkin_date", "city", "user_id", "is_cancelled", "nights", "guests",
                        "lead_time_days", "total_amount_usd", "service_fee_usd", "refund_amount_usd",
                        "accommodation_usd").join(listings.select("listing_id", "room_type"), "listing_id", "left")
    nights = _sum_if(kept, c("nights"))
    return rows.groupBy(fn_date_trunc(c("checkin_date"), "month").alias("month"), "city", "room_type").agg(
        F.count(F.lit(1)).alias("bookings"), F.count_if(kept).alias("completed_stays"),
        F.count_if(lost).alias("cancelled_bookings"), _share(lost).alias("cancellation_rate"),
        F.countDistinct(F.when(kept, c("user_id"))).alias("unique_guests"),
        nights.alias("nights_sold"), _sum_if(kept, c("guests") * c("nights")).alias("guest_nights"),
        agg_mean(F.when(kept, c("nights")), 2, kind="bigint").alias("avg_length_of_stay"),
        agg_mean(c("lead_time_days"), 1, kind="bigint").alias("avg_lead_time_days"),
        F.round(_sum_if(kept, c("total_amount_usd")), 2).alias("gross_booking_value_usd"),
        F.round(_sum_if(kept, c("service_fee_usd")), 2).alias("platform_revenue_usd"),
        F.round(_sum_if(lost, c("refund_amount_usd")), 2).alias("refunds_usd"),
        agg_safe_ratio(_sum_if(kept, c("accommodation_usd")), nights, 2, inner=8).alias("adr_usd"))


def mart_forward_occupancy(calendar: DataFrame, listings: DataFrame) -> DataFrame:
    """Calendar month x city x room type; a night that cannot be booked counts as taken."""
    c = F.col
    rows = calendar.select("listing_id", "calendar_date", "city", "snapshot_date", "is_available",
                           "minimum_nights").join(listings.select("listing_id", "room_type"), "listing_id", "left")
    return rows.groupBy(fn_date_trunc(c("calendar_date"), "month").alias("month"), "city", "room_type").agg(
        F.min("snapshot_date").alias("snapshot_date"), F.countDistinct("listing_id").alias("listings"),
        F.count(F.lit(1)).alias("listing_nights"), F.count_if(~c("is_available")).alias("unavailable_nights"),
        F.count_if("is_available").alias("available_nights"),
        _share(~c("is_available")).alias("occupancy_proxy"),
        agg_mean(c("minimum_nights"), 1, kind="bigint").alias("avg_minimum_nights"))


def mart_traveler_disruption(legs: DataFrame, flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Flight month x carrier x leg; diverted flights count in the rate, not in the passengers."""
    c = F.col
    outcome = flights.select("flight_id", "is_cancelled", "is_diverted", "arr_delay_min")
    rows = legs.select("flight_id", "flight_date", "airline_code", "leg", "passengers", "total_fare_usd").join(
        outcome, "flight_id")
    delay = c("arr_delay_min")
    grouped = rows.groupBy(fn_date_trunc(c("flight_date"), "month").alias("month"), "airline_code", "leg").agg(
        F.count(F.lit(1)).alias("legs_booked"), F.sum("passengers").alias("passengers"),
        F.round(F.sum("total_fare_usd"), 2).alias("fares_usd"),
        F.count_if("is_cancelled").alias("legs_on_cancelled_flights"),
        F.count_if("is_diverted").alias("legs_on_diverted_flights"),
        F.count_if(delay >= 15).alias("legs_arrived_15_plus_late"),
        F.count_if(delay >= 60).alias("legs_arrived_60_plus_late"),
        F.count_if(delay >= 180).alias("legs_arrived_3h_plus_late"),
        _sum_if(c("is_cancelled") | (delay >= 60), c("passengers")).alias("passengers_disrupted"),
        _share(c("is_cancelled") | c("is_diverted") | (delay >= 60)).alias("disruption_rate"),
        agg_mean(F.when(delay > 0, delay), 1, kind="bigint").alias("avg_delay_when_late_min"))
    return grouped.join(airlines.select("airline_code", "airline_name"), "airline_code", "left")


def mart_user_cohorts(stays: DataFrame) -> DataFrame:
    """Cohort month x months since the first booking. Cohorts include cancelled bookings, their value
    does not. Bookings shrink to one row per user and month first, so even a user with very many
    bookings reaches the later steps as a few rows."""
    c = F.col
    monthly = stays.filter(c("user_id").isNotNull()).groupBy("user_id", fn_date_trunc(c("booked_at"), "month").alias("booking_month")).agg(
        F.count(F.lit(1)).alias("bookings"), _sum_if(~c("is_cancelled"), c("total_amount_usd")).alias("value"))
    started = monthly.withColumn("cohort_month", F.min("booking_month").over(Window.partitionBy("user_id"))).filter(c("cohort_month").isNotNull())
    activity = started.groupBy("cohort_month", fn_date_diff("month", c("cohort_month"), c("booking_month")).alias(
        "months_since_first_booking")).agg(
        F.count("user_id").alias("active_users"), F.sum("bookings").alias("bookings"),
        F.round(F.sum("value"), 2).alias("gross_booking_value_usd"))
    # month 0 holds every member of the cohort exactly once
    size = F.max(F.when(c("months_since_first_booking") == 0, c("active_users"))).over(
        Window.partitionBy("cohort_month"))
    sized = activity.withColumn("cohort_users", size)
    return sized.select(
        "cohort_month", "months_since_first_booking", "cohort_users", "active_users",
        agg_safe_ratio(c("active_users"), c("cohort_users"), 4).alias("retention_rate"), "bookings",
        "gross_booking_value_usd")


def mart_review_insights(enrichments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review month x city x topic; a review counts once per topic."""
    c = F.col
    rows = enrichments.select("review_id", "language", "sentiment", "sentiment_score", "complaint",
                              "mentions_travel_disruption", "topics").join(
        reviews.select("review_id", "city", fn_date_trunc(c("review_date"), "month").alias("month")), "review_id")
    return lateral_flatten(rows, "topics", "topic").groupBy("month", "city", "topic").agg(
        F.count(F.lit(1)).alias("reviews"), agg_mean(c("sentiment_score"), 3, inner=6).alias("avg_sentiment_score"),
        _share(c("sentiment") == "negative").alias("negative_share"),
        _share(c("sentiment") == "mixed").alias("mixed_share"),
        F.count("complaint").alias("reviews_with_complaint"),
        F.count_if("mentions_travel_disruption").alias("disruption_mentions"),
        F.countDistinct("language").alias("languages"))


def mart_delay_impact(stays: DataFrame, legs: DataFrame, flights: DataFrame, enrichments: DataFrame) -> DataFrame:
    """Arrival delay band of the outbound flight against the review's tone, completed stays only."""
    c = F.col
    bands = F.when(c("is_cancelled"), "5_cancelled").when(c("is_diverted"), "4_diverted")
    for lower, label in DELAY_BANDS:
        bands = bands.when(c("arr_delay_min") >= lower, label)
    completed = stays.filter(~c("is_cancelled")).select("stay_booking_id", "review_id")
    reviewed = completed.join(enrichments.select("review_id", "sentiment", "sentiment_score",
                                                 "mentions_travel_disruption"), "review_id")
    outbound = join_residual_predicate(reviewed, legs.select("stay_booking_id", "flight_id", "leg"),
                                       "stay_booking_id", c("leg") == "outbound")
    flown = outbound.join(flights.select("flight_id", "is_cancelled", "is_diverted", "arr_delay_min"), "flight_id")
    return flown.groupBy(bands.otherwise("0_on_time").alias("delay_bucket")).agg(
        F.count(F.lit(1)).alias("reviewed_stays"), agg_mean(c("arr_delay_min"), 1, kind="bigint").alias("avg_arrival_delay_min"),
        agg_mean(c("sentiment_score"), 3).alias("avg_sentiment_score"),
        _share(c("sentiment") == "negative").alias("negative_share"),
        _share(c("mentions_travel_disruption")).alias("mentions_disruption_share")).orderBy("delay_bucket")
