"""Dimensions, rebuilt as a whole."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.functions.dates import fn_date_diff, fn_date_parts, fn_date_trunc, season_of
from wayline.functions.numbers import fn_fx_convert, project_case_bucket, project_decode
from wayline.operators.aggregates import agg_array_ordered
from wayline.operators.relational import join_conditional_aliases, join_multi_key_fx, join_self
from wayline.operators.windows import dedup_priority
from wayline.sources.files import date_spine

# Calendar range, price and age bands, airport size order, whole-home room type.
SPINE = (dt.date(2014, 1, 1), dt.date(2027, 12, 31))
PRICE_BANDS = [(75, "budget"), (150, "mid"), (300, "upscale")]
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
AIRPORT_SIZES = {"large_airport": 1, "medium_airport": 2, "small_airport": 3}
WHOLE_HOME = "Entire home/apt"
LONG_STAY_NIGHTS = 30


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a column ``date_day``."""
    d = F.col("date_day")
    p = days.withColumn("_p", fn_date_parts(d))
    return p.select(
        "date_day", "_p.year", "_p.quarter", "_p.month", "_p.month_name", "_p.year_month",
        fn_date_trunc(d, "month").alias("month_start"), fn_date_trunc(d, "week").alias("week_start"),
        "_p.day_of_week_iso", "_p.day_name", "_p.is_weekend", season_of(d).alias("season_northern"))


def dim_date(spark: SparkSession, start: dt.date = SPINE[0], end: dt.date = SPINE[1]) -> DataFrame:
    return describe_days(date_spine(spark, start, end))


def dim_airlines(airlines: DataFrame, flights: DataFrame) -> DataFrame:
    """Carriers with their parent and their activity window in the flights."""
    activity = flights.groupBy("airline_code").agg(
        F.min("flight_date").alias("first_flight_date"), F.max("flight_date").alias("last_flight_date"),
        F.count(F.lit(1)).alias("flights"))
    named = join_self(airlines, "airline_code", "parent_airline_code", {"airline_name": "parent_airline_name"})
    return named.join(activity, "airline_code", "left").select(
        "airline_code", "airline_name", "carrier_type", "parent_airline_code", "parent_airline_name",
        "first_flight_date", "last_flight_date", F.coalesce("flights", F.lit(0)).alias("flights"))


def dim_airports(airports: DataFrame, regions: DataFrame, countries: DataFrame, city_airports: DataFrame,
                 aliases: DataFrame) -> DataFrame:
    """One airport per code: in service first, then the larger one, then the older id."""
    coded = join_conditional_aliases(airports, aliases, "airport_ident", "iata_code")
    size = project_decode(F.col("airport_type"), AIRPORT_SIZES, 9)
    best = dedup_priority(coded, ["iata_code"], [F.col("has_scheduled_service").desc_nulls_first(),
                                                 size.asc_nulls_last(), F.col("airport_id").asc_nulls_last()])
    return (best.join(regions.select("region_code", "region_name"), "region_code", "left")
            .join(countries.select("country_code", "country_name"), "country_code", "left")
            .join(city_airports.select("iata_code", F.col("city").alias("served_city"), "metro_key"),
                  "iata_code", "left")
            .select("iata_code", "icao_code", "airport_name", "airport_type", "municipality", "region_code",
                    "region_name", "country_code", "country_name", "continent", "latitude", "longitude",
                    "elevation_ft", "has_scheduled_service", "served_city", "metro_key"))


def dim_cities(cities: DataFrame, countries: DataFrame, city_airports: DataFrame, listings: DataFrame) -> DataFrame:
    """Cities with their sorted airports and listing supply."""
    supply = listings.groupBy("city").agg(F.count(F.lit(1)).alias("listings"),
                                          F.count_if(F.col("room_type") == WHOLE_HOME).alias("entire_homes"))
    codes = agg_array_ordered(city_airports, ["city"], "iata_code", "airport_codes")
    return (cities.join(countries.select("country_code", "country_name"), "country_code", "left")
            .join(codes, "city", "left").join(supply, "city", "left")
            .select("city", "city_name", "country_code", "country_name", "currency_code", "is_us", "airport_codes",
                    F.coalesce("listings", F.lit(0)).alias("listings"),
                    F.coalesce("entire_homes", F.lit(0)).alias("entire_homes")))


def dim_listings(listings: DataFrame, fx: DataFrame) -> DataFrame:
    """Listings with prices at the snapshot day's rate. A known price without a rate compares as
    unknown and therefore falls into the last band."""
    joined = join_multi_key_fx(listings, fx, "currency_code", F.col("snapshot_date"))
    usd = F.col("price_local") * F.col("usd_per_unit")
    return joined.select(
        "listing_id", "city", "listing_name", "neighbourhood", "neighbourhood_group", "latitude", "longitude",
        "property_type", "room_type", "accommodates", "bedrooms", "beds", "bathrooms", "amenity_count", "host_id",
        "is_superhost", "host_listings_count", (F.col("host_listings_count") > 1).alias("is_multi_listing_host"),
        "minimum_nights", (F.col("minimum_nights") >= LONG_STAY_NIGHTS).alias("is_long_term_only"),
        "currency_code", "price_local",
        fn_fx_convert(F.col("price_local"), F.col("usd_per_unit")).alias("price_usd"),
        F.when(F.col("price_local").isNotNull(), project_case_bucket(usd, PRICE_BANDS, "luxury")).alias("price_band"),
        "availability_365", "number_of_reviews", "number_of_reviews_ltm", "first_review_date", "last_review_date",
        "review_score_rating", "review_score_cleanliness", "review_score_location", "review_score_value",
        "estimated_occupied_nights_l365d",
        fn_fx_convert(F.col("estimated_revenue_local_l365d"), F.col("usd_per_unit")).alias(
            "estimated_revenue_usd_l365d"), "snapshot_date")


def dim_users(users: DataFrame, city_airports: DataFrame, as_of: dt.date) -> DataFrame:
    """Users with age (difference of years) on ``as_of`` and home city. An unknown birth date falls
    into the last age band."""
    age = fn_date_diff("year", F.col("birth_date"), F.lit(as_of))
    homes = city_airports.select(F.col("iata_code").alias("home_airport"), F.col("city").alias("home_city"))
    return users.join(homes, "home_airport", "left").select(
        "user_id", "first_name", "last_name", "email", "gender", "birth_date", age.alias("age"),
        project_case_bucket(age, AGE_BANDS, "65+").alias("age_band"), "home_country_code",
        (F.col("home_country_code") == "US").alias("is_us_resident"), "home_airport", "home_city",
        "preferred_language", "signed_up_at", F.col("signed_up_at").cast("date").alias("signup_date"),
        "acquisition_channel", "marketing_opt_in")
