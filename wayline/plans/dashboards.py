"""Served report queries over the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.functions.numbers import agg_mean, agg_safe_ratio, exact_ratio
from wayline.operators.aggregates import agg_share_of_total
from wayline.operators.relational import join_scalar_subqueries, lateral_flatten, pivot_matrix

# Sentiments that count as critical, and sizes of the served lists.
CRITICAL = ["negative", "mixed"]
MIN_TOPIC_REVIEWS, TOP_LANGUAGES, TOP_COMPLAINTS, GRID_MONTHS = 10, 10, 50, 12


def _on_time(only=None):
    flown = F.col("scheduled_flights") - F.col("cancelled_flights") - F.col("diverted_flights")
    on_time = F.col("on_time_flights")
    if only is not None:
        on_time, flown = F.when(only, on_time), F.when(only, flown)
    return exact_ratio(F.sum(on_time), F.sum(flown))


def dash_kpis(performance: DataFrame, revenue: DataFrame, enrichments: DataFrame, year: int) -> DataFrame:
    """Six headline numbers in one row; each mart is read once."""
    return join_scalar_subqueries([
        performance.agg(F.sum("scheduled_flights").alias("flights"),
                        _on_time(F.year("month") == year).alias("on_time_rate_year")),
        revenue.agg(F.sum("completed_stays").alias("stays"), F.sum("gross_booking_value_usd").alias("gbv_usd"),
                    F.sum("platform_revenue_usd").alias("revenue_usd")),
        enrichments.agg(F.count(F.lit(1)).alias("enriched"))])


def dash_flights_per_month(performance: DataFrame) -> DataFrame:
    """Monthly flights, with the lowest month marked."""
    monthly = performance.groupBy("month").agg(F.sum("scheduled_flights").alias("flights"))
    lowest = monthly.agg(F.min_by("month", F.struct("flights", "month")).alias("low_month"))
    marked = monthly.join(lowest, monthly["month"] == lowest["low_month"], "left")
    return marked.select("month", "flights", F.col("low_month").isNotNull().alias("is_lowest")).orderBy("month")


def dash_stays_per_month(revenue: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (revenue.filter(F.col("month").between(F.lit(start), F.lit(end))).groupBy("month")
            .agg(F.sum("completed_stays").alias("completed_stays")).orderBy("month"))


def dash_airline_ranking(performance: DataFrame, year: int) -> DataFrame:
    ranked = performance.filter(F.year("month") == year).groupBy("airline_name", "airline_code", "carrier_type").agg(
        F.sum("scheduled_flights").alias("flights"), _on_time().alias("on_time_rate"),
        exact_ratio(F.sum("cancelled_flights"), F.sum("scheduled_flights")).alias("cancellation_rate"))
    return ranked.orderBy(F.col("on_time_rate").asc_nulls_last(), "airline_code")


def dash_delay_causes(performance: DataFrame) -> DataFrame:
    causes = {"carrier": "carrier_delay_min", "late_aircraft": "late_aircraft_delay_min",
              "air_traffic_system": "nas_delay_min", "weather": "weather_delay_min",
              "security": "security_delay_min"}
    yearly = performance.groupBy(F.year("month").alias("year")).agg(
        *[F.sum(src).alias(out) for out, src in causes.items()])
    return agg_share_of_total(yearly, list(causes)).orderBy("year")


def dash_airline_monthly(performance: DataFrame) -> DataFrame:
    return performance.groupBy("month", "airline_code", "airline_name").agg(
        _on_time().alias("on_time_rate")).orderBy("month", "airline_code")


def dash_city_year(revenue: DataFrame, cities: DataFrame, year: int) -> DataFrame:
    """Yearly value per city; the daily rate is weighted by the nights sold."""
    rows = revenue.filter(F.year("month") == year).join(
        cities.select("city", F.col("city_name")), "city").drop("city")
    nights = F.sum("nights_sold")
    return rows.groupBy(F.col("city_name").alias("city")).agg(
        F.sum("gross_booking_value_usd").alias("gbv_usd"), F.sum("platform_revenue_usd").alias("platform_revenue_usd"),
        nights.alias("nights_sold"),
        agg_safe_ratio(F.sum(F.col("adr_usd") * F.col("nights_sold")), nights, 8, inner=8).alias("adr_usd"),
        agg_safe_ratio(F.sum("cancelled_bookings"), F.sum("bookings"), 6).alias("cancellation_rate"))


def dash_city_season(revenue: DataFrame, cities: DataFrame, city_name: str, start: dt.date, end: dt.date) -> DataFrame:
    """Monthly nights of one city; the city's key is found first, so the mart is filtered before it is read."""
    chosen = cities.filter(F.col("city_name") == city_name).select("city")
    return (revenue.filter(F.col("month").between(F.lit(start), F.lit(end))).join(chosen, "city")
            .groupBy("month").agg(F.sum("nights_sold").alias("nights_sold")).orderBy("month"))


def dash_occupancy_grid(occupancy: DataFrame, cities: DataFrame, months: int = GRID_MONTHS,
                        skip: int = 1) -> DataFrame:
    """City x month matrix of full months, rows ordered by their mean. The month names become columns,
    so they are read first (one value per calendar month)."""
    rows = occupancy.join(cities.select("city", "city_name"), "city").groupBy(
        F.col("city_name").alias("city"), F.date_format("month", "yyyy-MM").alias("ym")).agg(
        agg_safe_ratio(F.sum("unavailable_nights"), F.sum("listing_nights"), 6).alias("proxy"))
    names = [r[0] for r in rows.select("ym").distinct().orderBy("ym").limit(skip + months).collect()]
    grid = pivot_matrix(rows, "city", "ym", names[skip:], "proxy")
    return grid.orderBy(F.col("row_mean").asc_nulls_last(), "city")


def dash_review_stats(enrichments: DataFrame) -> DataFrame:
    negative = F.when(F.col("sentiment") == "negative", 1).otherwise(0)
    return enrichments.agg(
        F.count(F.lit(1)).alias("reviews"), F.countDistinct("language").alias("languages"),
        agg_mean(negative, 6, kind="bigint").alias("negative_share"), agg_mean(F.col("sentiment_score"), 6).alias("avg_score"))


def dash_topics_critical(enrichments: DataFrame, least: int = MIN_TOPIC_REVIEWS) -> DataFrame:
    critical = F.when(F.col("sentiment").isin(CRITICAL), 1).otherwise(0)
    topics = lateral_flatten(enrichments.select("topics", "sentiment"), "topics", "topic").groupBy("topic").agg(
        F.count(F.lit(1)).alias("reviews"), agg_mean(critical, 6, kind="bigint").alias("critical_share"))
    return topics.filter(F.col("reviews") >= least).orderBy("critical_share", "topic")


def dash_languages(enrichments: DataFrame, k: int = TOP_LANGUAGES) -> DataFrame:
    return (enrichments.groupBy("language").agg(F.count(F.lit(1)).alias("reviews"))
            .orderBy(F.col("reviews").desc(), "language").limit(k))


def dash_complaints(enrichments: DataFrame, reviews: DataFrame, k: int = TOP_COMPLAINTS) -> DataFrame:
    """Newest critical reviews with a complaint; equal days by id."""
    critical = enrichments.filter(F.col("sentiment").isin(CRITICAL) & F.col("complaint").isNotNull())
    joined = critical.select("review_id", "sentiment", "complaint", "summary_en").join(
        reviews.select("review_id", "city", "review_date"), "review_id")
    return (joined.orderBy(F.col("review_date").desc_nulls_first(), "review_id").limit(k)
            .select("review_id", "city", "review_date", "sentiment", "complaint", "summary_en"))


def dash_delay_impact(impact: DataFrame) -> DataFrame:
    return impact.orderBy("delay_bucket")


def dash_city_list(cities: DataFrame) -> DataFrame:
    return cities.select("city", "city_name").orderBy("city_name")
