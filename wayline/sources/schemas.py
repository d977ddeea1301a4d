"""Layouts of the ten raw tables (all text) and of the lookup files.

Column names and their order are fixed values: they must match the headers of the files.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = {
    "countries": "id code name continent wikipedia_link keywords",
    "regions": "id code local_code name continent iso_country wikipedia_link keywords",
    "airports": "id ident type name latitude_deg longitude_deg elevation_ft continent iso_country iso_region "
                "municipality scheduled_service icao_code iata_code gps_code local_code home_link "
                "wikipedia_link keywords",
    "listings": "city snapshot_date listing_id last_scraped name description host_id host_since "
                "host_response_rate host_acceptance_rate host_is_superhost calculated_host_listings_count "
                "neighbourhood_cleansed neighbourhood_group_cleansed latitude longitude property_type room_type "
                "accommodates bathrooms bathrooms_text bedrooms beds amenities price minimum_nights "
                "maximum_nights has_availability availability_30 availability_90 availability_365 "
                "number_of_reviews number_of_reviews_ltm first_review last_review review_scores_rating "
                "review_scores_accuracy review_scores_cleanliness review_scores_checkin "
                "review_scores_communication review_scores_location review_scores_value instant_bookable "
                "license estimated_occupancy_l365d estimated_revenue_l365d",
    "calendar": "city snapshot_date listing_id calendar_date available minimum_nights maximum_nights",
    "reviews": "city snapshot_date review_id listing_id review_date reviewer_id comments",
    "flights": "flight_date reporting_airline airline_iata_code tail_number flight_number origin "
               "origin_city_name origin_state dest dest_city_name dest_state crs_dep_time dep_time dep_delay "
               "dep_delay_minutes dep_del15 taxi_out wheels_off wheels_on taxi_in crs_arr_time arr_time arr_delay "
               "arr_delay_minutes arr_del15 cancelled cancellation_code diverted crs_elapsed_time "
               "actual_elapsed_time air_time distance carrier_delay weather_delay nas_delay security_delay "
               "late_aircraft_delay",
    "users": "user_id source_reviewer_id first_name last_name email gender birth_date home_country_code "
             "home_airport preferred_language signed_up_at acquisition_channel marketing_opt_in",
    "stay_bookings": "stay_booking_id user_id listing_id city review_id booked_at checkin_date checkout_date "
                     "nights guests currency_code nightly_rate cleaning_fee service_fee total_amount "
                     "payment_method booking_channel booking_status cancelled_at refund_amount",
    "flight_bookings": "flight_booking_id stay_booking_id user_id leg booked_at flight_date airline_code "
                       "flight_number origin dest crs_dep_time cabin_class passengers fare_per_passenger_usd "
                       "total_fare_usd booking_status",
}

SEED_TYPES = {
    "cities": "city string, city_name string, country_code string, currency_code string, is_us boolean",
    "city_airports": "city string, neighbourhood_group string, metro_key string, iata_code string",
    "airlines": "airline_code string, airline_name string, carrier_type string, parent_airline_code string",
    "airport_code_aliases": "iata_code string, airport_ident string, reason string",
    "fx_rates_daily": "rate_date date, currency_code string, usd_per_unit decimal(18,8)",
}

ENRICHMENT_TYPES = ("review_id bigint, language string, sentiment string, sentiment_score double, "
                    "topics array<string>, complaint string, mentions_travel_disruption boolean, "
                    "summary_en string")

EMBEDDING_TYPES = ("review_id bigint, listing_id bigint, city string, review_date date, comment_text string, "
                   "embedding array<float>, model string, embedded_at timestamp")

LINEAGE = ["_source_file", "_loaded_at"]


def bronze_schema(table: str, lineage: bool = False) -> T.StructType:
    """All-text schema of one raw table, with the two lineage columns when stored."""
    fields = [T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table].split()]
    if lineage:
        fields += [T.StructField("_source_file", T.StringType()),
                   T.StructField("_loaded_at", T.TimestampType())]
    return T.StructType(fields)
