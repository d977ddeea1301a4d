"""The daily build: raw tables -> staging -> dimensions and facts -> marts -> data tests.

Every step is a Spark job that ends in a table below ``root``, so a later step (or a repeated run after
a failure) starts from stored rows. Facts take only raw rows loaded since their newest row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.operators import checks
from wayline.operators.travel import fx_daily_rates
from wayline.operators.upsert import scd2_snapshot
from wayline.plans import dims, facts, marts, staging
from wayline.plans.quality import observe_rules, quality_report
from wayline.plans.refresh import refresh_months
from wayline.sources.schemas import ENRICHMENT_TYPES
from wayline.sources.sinks import Buckets, layer_path, merge_into_partitions, read_mark, read_version, write_version

# columns of a listing whose change opens a new validity row
LISTING_CHECKS = ["price_local", "room_type", "accommodates", "minimum_nights", "is_superhost"]

_STAGED = {"stg_listings": staging.stg_listings, "stg_calendar": staging.stg_calendar,
           "stg_reviews": staging.stg_reviews, "stg_airports": staging.stg_airports,
           "stg_countries": staging.stg_countries, "stg_regions": staging.stg_regions,
           "stg_users": staging.stg_users}


def _publish(df: DataFrame, root: str, layer: str, name: str,
             observed: dict[str, Mapping[str, int]] | None = None) -> DataFrame:
    """Write a table and give back the stored one; ``observed`` receives the counts of its row rules."""
    path = layer_path(root, layer, name)
    rows, seen = (df, None) if observed is None else observe_rules(name, df)
    rows.write.mode("overwrite").parquet(path)
    if seen is not None:
        observed[name] = seen.get
    return df.sparkSession.read.parquet(path)


def build(spark: SparkSession, root: str, raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame],
          as_of: dt.date, enrichments: DataFrame | None = None,
          calendar_range: tuple[dt.date, dt.date] = dims.SPINE, stop: bool = True,
          buckets: Mapping[str, Buckets] | None = None) -> dict[str, DataFrame]:
    """Build every model below ``root`` and return the stored tables by name.

    ``raw`` holds the ten raw tables (text columns with ``_source_file`` and ``_loaded_at``), ``seeds``
    the five lookup tables; instead of ``fx_rates_daily`` they may hold ``fx_quotes`` (day and one column per
    currency, per unit of the pivot currency). ``enrichments`` defaults to the stored ones.

    Listings also enter a validity history. The data tests are stored as ``checks``; with ``stop`` a failed
    test of severity error ends the run with an AssertionError after that. Row rules of tables that a run writes
    whole are counted while they are written; facts and monthly marts, of which a run writes some months, are read for them.

    ``buckets`` names facts that are stored for joins on a key (see ``facts.flight_buckets``).
    """
    observed: dict[str, Mapping[str, int]] = {}
    t: dict[str, DataFrame] = {name: df for name, df in seeds.items()}
    if "fx_rates_daily" not in t:
        quotes = seeds["fx_quotes"]
        named = [c for c in quotes.columns if c not in ("day", "USD")]
        t["fx_rates_daily"] = _publish(fx_daily_rates(quotes, "day", "USD", named), root, "staging", "fx_rates_daily",
                                       observed)
    for name, fn in _STAGED.items():
        source = raw[name.removeprefix("stg_")]
        rows = fn(source, seeds["cities"]) if name == "stg_listings" else fn(source)
        t[name] = _publish(rows, root, "staging", name, observed)
    t["listing_history"] = snapshot_listings(t["stg_listings"], layer_path(root, "snapshots", "listings"), as_of)

    def fact(name: str, source: str, make) -> DataFrame:
        key, date, date_in_key = facts.FACT_KEYS[name]
        path = layer_path(root, "facts", name)
        rows = make(facts.new_rows(raw[source], read_mark(spark, path, "_loaded_at")))
        return merge_into_partitions(rows, path, [key], "_loaded_at", date, date_in_key, (buckets or {}).get(name))

    t["fct_flights"] = fact("fct_flights", "flights", lambda r: facts.fct_flights(staging.stg_flights(r)))
    t["fct_stay_bookings"] = fact("fct_stay_bookings", "stay_bookings", lambda r: facts.fct_stay_bookings(
        staging.stg_stay_bookings(r), t["fx_rates_daily"]))
    t["fct_flight_bookings"] = fact("fct_flight_bookings", "flight_bookings",
                                    lambda r: facts.fct_flight_bookings(staging.stg_flight_bookings(r)))

    made = {
        "dim_date": dims.dim_date(spark, *calendar_range),
        "dim_airlines": dims.dim_airlines(seeds["airlines"], t["fct_flights"]),
        "dim_airports": dims.dim_airports(t["stg_airports"], t["stg_regions"], t["stg_countries"],
                                          seeds["city_airports"], seeds["airport_code_aliases"]),
        "dim_cities": dims.dim_cities(seeds["cities"], t["stg_countries"], seeds["city_airports"],
                                      t["stg_listings"]),
        "dim_listings": dims.dim_listings(t["stg_listings"], t["fx_rates_daily"]),
        "dim_users": dims.dim_users(t["stg_users"], seeds["city_airports"], as_of)}
    for name, df in made.items():
        t[name] = _publish(df, root, "dimensions", name, observed)

    t["review_enrichments"] = enrichments
    if enrichments is None:
        stored = read_version(spark, layer_path(root, "ai", "review_enrichments"))
        t["review_enrichments"] = spark.createDataFrame([], ENRICHMENT_TYPES) if stored is None else stored
    reports = {
        "mart_forward_occupancy": marts.mart_forward_occupancy(t["stg_calendar"], t["dim_listings"]),
        "mart_traveler_disruption": marts.mart_traveler_disruption(t["fct_flight_bookings"], t["fct_flights"],
                                                                   t["dim_airlines"]),
        "mart_user_cohorts": marts.mart_user_cohorts(t["fct_stay_bookings"]),
        "mart_review_insights": marts.mart_review_insights(t["review_enrichments"], t["stg_reviews"]),
        "mart_delay_impact": marts.mart_delay_impact(t["fct_stay_bookings"], t["fct_flight_bookings"],
                                                     t["fct_flights"], t["review_enrichments"])}
    for name, df in reports.items():
        t[name] = _publish(df, root, "ai" if name in ("mart_review_insights", "mart_delay_impact") else "business",
                           name, observed)
    # these two depend on one fact, month by month
    monthly = {
        "mart_airline_performance": ("fct_flights", lambda f: marts.mart_airline_performance(
            f, t["dim_airlines"], t["dim_airports"]),
            [(t["dim_airlines"], ["airline_code", "airline_name", "carrier_type"]),
             (t["dim_airports"], ["iata_code", "airport_name", "region_code"])]),
        "mart_city_revenue": ("fct_stay_bookings", lambda f: marts.mart_city_revenue(f, t["dim_listings"]),
                              [(t["dim_listings"], ["listing_id", "room_type"])])}
    for name, (source, make, lookups) in monthly.items():
        t[name], _ = refresh_months(spark, layer_path(root, "business", name), layer_path(root, "facts", source), make,
                                    "month", lookups)
    facts_of = {"flights": (staging.stg_flights(raw["flights"]), "flight_id", t["fct_flights"]),
                "stay_bookings": (raw["stay_bookings"], "stay_booking_id", t["fct_stay_bookings"]),
                "flight_bookings": (raw["flight_bookings"], "flight_booking_id", t["fct_flight_bookings"])}
    reconciled = checks.check_severity_warn("facts reconcile with raw", checks.check_reconcile(facts_of), "error")
    t["checks"] = _publish(check(t, observed).unionByName(reconciled), root, "checks", "report")
    if stop:
        checks.assert_passed(t["checks"])
    return t


def snapshot_listings(listings: DataFrame, path: str, as_of: dt.date) -> DataFrame:
    """Next version of the listings' validity history: changes of the checked columns, vanished listings."""
    spark = listings.sparkSession
    current = listings.select("listing_id", *LISTING_CHECKS)
    history = read_version(spark, path)
    if history is None:
        unknown = F.lit(None).cast("date")
        history = current.limit(0).withColumns({"valid_from": unknown, "valid_to": unknown})
    return write_version(scd2_snapshot(history, current, "listing_id", LISTING_CHECKS, as_of), path)


def check(tables: Mapping[str, DataFrame], observed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """The data tests over the tables of a build; see ``quality_report`` for ``observed``."""
    return quality_report(tables, observed)
