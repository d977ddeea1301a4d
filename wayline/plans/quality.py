"""The data tests of all models, as one report.

Row rules of a table (not null, allowed values, range) are counted while it is written, or together in one pass over it;
uniqueness and parent checks need a shuffle each.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wayline.operators import checks

# Keys (unique and not null), further unique columns, grains, not-null columns, allowed
# values, ranges and parents of each table.
KEYS = {
    "cities": "city", "city_airports": "iata_code", "airport_code_aliases": "iata_code", "airlines": "airline_code",
    "stg_flights": "flight_id", "stg_listings": "listing_id", "stg_reviews": "review_id",
    "stg_airports": "airport_id", "stg_countries": "country_code", "stg_regions": "region_code",
    "stg_users": "user_id", "stg_stay_bookings": "stay_booking_id", "stg_flight_bookings": "flight_booking_id",
    "dim_date": "date_day", "dim_cities": "city", "dim_airports": "iata_code", "dim_airlines": "airline_code",
    "dim_listings": "listing_id", "dim_users": "user_id", "fct_flights": "flight_id",
    "fct_stay_bookings": "stay_booking_id", "fct_flight_bookings": "flight_booking_id",
    "review_enrichments": "review_id", "mart_delay_impact": "delay_bucket"}
UNIQUE = {"stg_users": ["email", "source_reviewer_id"], "dim_users": ["email"]}
GRAINS = {
    "fx_rates_daily": ["rate_date", "currency_code"],
    "mart_airline_performance": ["month", "airline_code", "origin_airport"],
    "mart_city_revenue": ["month", "city", "room_type"],
    "mart_traveler_disruption": ["month", "airline_code", "leg"],
    "mart_forward_occupancy": ["month", "city", "room_type"],
    "mart_user_cohorts": ["cohort_month", "months_since_first_booking"],
    "mart_review_insights": ["month", "city", "topic"]}
NOT_NULL = {
    "stg_flights": ["flight_date", "airline_code"], "stg_listings": ["currency_code"],
    "stg_calendar": ["listing_id", "calendar_date"], "stg_reviews": ["review_date"], "stg_users": ["email"],
    "stg_stay_bookings": ["user_id"], "stg_flight_bookings": ["flight_id"],
    "fct_stay_bookings": ["total_amount_usd"]}
ALLOWED = {
    "stg_flights": {"arrival_status": ["on_time", "delayed", "cancelled", "diverted"],
                    "cancellation_reason": ["carrier", "weather", "national_air_system", "security"]},
    "stg_listings": {"room_type": ["Entire home/apt", "Private room", "Shared room", "Hotel room"]},
    "stg_stay_bookings": {"booking_status": ["completed", "cancelled"]},
    "stg_flight_bookings": {"booking_status": ["flown", "cancelled_by_airline", "cancelled_by_customer"],
                            "leg": ["outbound", "return"]},
    "dim_listings": {"price_band": ["budget", "mid", "upscale", "luxury"]},
    "review_enrichments": {"sentiment": ["positive", "neutral", "negative", "mixed"]}}
RANGES = {
    "stg_stay_bookings": {"total_amount_local": (0, None)},
    "fct_stay_bookings": {"total_amount_usd": (0, None), "lead_time_days": (0, None)},
    "mart_airline_performance": {"on_time_rate": (0, 1)}, "mart_forward_occupancy": {"occupancy_proxy": (0, 1)},
    "mart_user_cohorts": {"retention_rate": (0, 1)}}
PARENTS = [
    ("stg_flights", "airline_code", "airlines", "airline_code", "error"),
    ("stg_listings", "city", "cities", "city", "error"),
    ("stg_stay_bookings", "user_id", "stg_users", "user_id", "error"),
    ("stg_flight_bookings", "flight_id", "stg_flights", "flight_id", "error"),
    ("stg_flight_bookings", "stay_booking_id", "stg_stay_bookings", "stay_booking_id", "error"),
    ("fct_flights", "airline_code", "dim_airlines", "airline_code", "error"),
    ("fct_flights", "origin_airport", "dim_airports", "iata_code", "warn"),
    ("fct_stay_bookings", "user_id", "dim_users", "user_id", "error"),
    ("fct_stay_bookings", "listing_id", "dim_listings", "listing_id", "error"),
    ("fct_flight_bookings", "flight_id", "fct_flights", "flight_id", "error"),
    ("fct_flight_bookings", "stay_booking_id", "fct_stay_bookings", "stay_booking_id", "error")]


def rule_counts(name: str) -> dict[str, Column]:
    """The failing rows of each row rule of one table, as aggregates."""
    rules = {}
    for column in [*([KEYS[name]] if name in KEYS else []), *NOT_NULL.get(name, [])]:
        rules[f"{name}.{column} not null"] = F.count_if(F.col(column).isNull())
    for column, values in ALLOWED.get(name, {}).items():
        rules[f"{name}.{column} allowed"] = F.count_if(~F.col(column).isin(values))
    for column, (low, high) in RANGES.get(name, {}).items():
        bad = F.lit(False)
        bad = bad if low is None else bad | (F.col(column) < low)
        bad = bad if high is None else bad | (F.col(column) > high)
        rules[f"{name}.{column} range"] = F.count_if(bad)
    return rules


def observe_rules(name: str, df: DataFrame) -> tuple[DataFrame, Observation | None]:
    """The table with its row rules counted while it is written; None if it has no such rule.

    The counts are taken in the tasks that write, so a table has to be written as it is returned here, without a further
    shuffle; a task that runs again counts once."""
    rules = rule_counts(name)
    if not rules:
        return df, None
    seen = Observation(name)
    return df.observe(seen, *[failing.alias(rule) for rule, failing in rules.items()]), seen


def row_rules(name: str, df: DataFrame) -> DataFrame | None:
    """(check_name, failures) of all row rules of one table, from one aggregate."""
    rules = rule_counts(name)
    if not rules:
        return None
    counts = df.agg(F.array(*[F.struct(F.lit(n).alias("check_name"), c.alias("failures")) for n, c in rules.items()])
                    .alias("r"))
    return counts.select(F.explode("r").alias("r")).select("r.check_name", F.lit("error").alias("severity"),
                                                           "r.failures")


def quality_report(tables: Mapping[str, DataFrame], observed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """One row per test of the given tables: name, severity, failures, status.

    ``observed`` holds, for tables whose row rules were counted while they were written, the counts by rule; these tables
    are not read again for them. A table whose counts are not complete is."""
    parts, taken = [], []

    def counted(name: str, failing: DataFrame, severity: str = "error") -> None:
        parts.append(failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures"))

    for name, df in tables.items():
        counts = (observed or {}).get(name, {})
        known = bool(counts) and set(counts) == set(rule_counts(name))
        if known:
            taken += [(rule, "error", failures) for rule, failures in counts.items()]
        rules = None if known else row_rules(name, df)
        if rules is not None:
            parts.append(rules)
        for column in [*([KEYS[name]] if name in KEYS else []), *UNIQUE.get(name, [])]:
            counted(f"{name}.{column} unique", checks.check_unique(df, column))
        if name in GRAINS:
            counted(f"{name} grain", checks.check_unique_combination(df, GRAINS[name]))
    for child, column, parent, parent_column, severity in PARENTS:
        if child in tables and parent in tables:
            counted(f"{child}.{column} parent", checks.check_relationships(
                tables[child], column, tables[parent], parent_column), severity)
    if taken:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(taken, "check_name string, severity string, failures bigint"))
    n = F.col("failures")
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn(
        "status", F.when(n == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))
