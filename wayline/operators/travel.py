"""Pricing, sampling, trip matching and exchange rates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.functions.hashing import hash_uniform
from wayline.functions.numbers import fn_cross_rate
from wayline.operators.ranking import agg_median_quantile
from wayline.operators.relational import join_nth_candidate, unpivot_rates
from wayline.operators.windows import window_forward_fill

# The service share, and the price level of each season's months.
SERVICE_SHARE = "0.142"
SEASON_FACTORS = {1.18: [6, 7, 8], 1.10: [12], 0.88: [1, 2]}


def impute_and_cap(df: DataFrame, group: Sequence[str], column: str, quantile: float = 0.97,
                   name: str = "price_filled") -> DataFrame:
    """Missing or zero becomes the group's median, everything is capped at the group's quantile.
    The statistics use positive values only; a group without any is dropped, as in an inner join."""
    stats = agg_median_quantile(df.filter(F.col(column) > 0), group, column, {"_med": 0.5, "_cap": quantile})
    joined = df.join(stats, list(group), "inner")
    filled = F.coalesce(F.nullif(F.col(column), F.lit(0).cast(df.schema[column].dataType)), F.col("_med"))
    return joined.withColumn(name, F.least(filled, F.col("_cap"))).drop("_med", "_cap")


def season_factor(day: Column) -> Column:
    cases = F
    for factor, months in SEASON_FACTORS.items():
        cases = cases.when(F.month(day).isin(months), F.lit(factor))
    return cases.otherwise(F.lit(1.0))


def price_deflate(df: DataFrame, column: str, growth: Column | float, day: str, snapshot: dt.date,
                  name: str = "price_then") -> DataFrame:
    """Price of the snapshot day carried back at a yearly growth, times the season's level."""
    rate = growth if isinstance(growth, Column) else F.lit(float(growth))
    years = F.datediff(F.lit(snapshot), F.col(day)) / F.lit(365.25)
    then = F.col(column).cast("double") / F.pow(F.lit(1.0) + rate, years) * season_factor(F.col(day))
    return df.withColumn(name, then)


def hash_sample_share(df: DataFrame, key: str, salt: str, share: float) -> DataFrame:
    """The same share of keys on every run."""
    return df.filter(hash_uniform(F.col(key), salt) < F.lit(share))


def fee_breakdown(df: DataFrame, rate: str, nights: str, ratio: Column, refund_share: Column) -> DataFrame:
    """Subtotal, cleaning, service, total and refund as decimals. ``refund_share`` is NULL for a kept stay."""
    money = "decimal(14,2)"
    exact = df.withColumns({
        "subtotal": F.round(F.col(rate).cast(money) * F.col(nights), 2).cast("decimal(18,2)"),
        "cleaning_fee": F.round(F.col(rate).cast(money) * ratio.cast("decimal(4,2)"), 2).cast("decimal(18,2)")})
    base = F.col("subtotal") + F.col("cleaning_fee")
    service = F.lit(SERVICE_SHARE).cast("decimal(4,3)") * base
    return exact.withColumns({
        "service_fee": F.round(service, 2).cast("decimal(18,2)"),
        "total_amount": F.round(base + service, 2).cast("decimal(18,2)"),
        "refund_amount": F.round((base + service) * refund_share.cast("decimal(4,2)"), 2).cast("decimal(18,2)")})


def route_match(requests: DataFrame, candidates: DataFrame, group: Sequence[str], orders: Sequence[Column],
                pick_key: str, salt: str) -> tuple[DataFrame, DataFrame]:
    """Trips matched to one of that day's candidates on their route, and a report of the match rate."""
    matched = join_nth_candidate(requests, candidates, group, orders, pick_key, salt)
    asked = requests.agg(F.count(F.lit(1)).alias("requested"), F.lit(0).cast("bigint").alias("matched"))
    found = matched.agg(F.lit(0).cast("bigint").alias("requested"), F.count(F.lit(1)).alias("matched"))
    report = asked.unionByName(found).agg(F.sum("requested").alias("requested"), F.sum("matched").alias("matched"))
    rate = F.round(F.try_divide(F.col("matched").cast("decimal(18,0)"), F.col("requested").cast("decimal(18,0)")), 6)
    return matched, report.withColumn("match_rate", rate)


def fx_daily_rates(quotes: DataFrame, day: str, base: str, currencies: Sequence[str],
                   pivot_currency: str = "EUR", start: dt.date | None = None) -> DataFrame:
    """Daily price of every currency in ``base``, from quotes per unit of the pivot currency.

    Calendar days without quotes take the last known ones; rates still unknown are left out.
    """
    known = quotes if start is None else quotes.filter(F.col(day) >= F.lit(start))
    first = F.min(day) if start is None else F.lit(start)
    span = known.agg(first.alias("_a"), F.max(day).alias("_b")).filter(F.col("_b").isNotNull())
    grid = span.select(F.explode(F.sequence("_a", "_b")).alias(day))
    filled = window_forward_fill(grid.join(known, day, "left"), [], day, [base, *currencies])
    rates: Mapping[str, Column] = {
        pivot_currency: F.round(F.col(base).cast("decimal(18,8)"), 8),
        **{c: fn_cross_rate(F.col(base), F.col(c)) for c in currencies},
        base: F.lit(1)}
    wide = filled.select(F.col(day).alias("rate_date"),
                         *[r.cast("decimal(18,8)").alias(c) for c, r in rates.items()])
    return unpivot_rates(wide, "rate_date", list(rates))
