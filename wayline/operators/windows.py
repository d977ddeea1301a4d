"""Newest-row and first-n rules, and forward fill.

``row_number() <= n`` lets Spark keep at most n rows of a key in every map task before the shuffle
(window group limit), so a key that holds a third of the table arrives as a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark prunes groups in the map tasks up to this rank (spark.sql.optimizer.windowGroupLimitThreshold)
_MAP_SIDE_RANK = 1000
_SPREAD = 64


def dedup_distinct_on(df: DataFrame, key: Sequence[str | Column], orders: Sequence[Column]) -> DataFrame:
    """First row per key in the given order; NULL keys form one group."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*orders)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def newest(*columns: str) -> list[Column]:
    """Descending with NULL as the largest value."""
    return [F.col(c).desc_nulls_first() for c in columns]


def dedup_latest(df: DataFrame, key: Sequence[str | Column], ts: str, ties: Sequence[str] = ()) -> DataFrame:
    return dedup_distinct_on(df, key, newest(ts, *ties))


def dedup_latest_two_keys(df: DataFrame, key: Sequence[str | Column], snapshot: str, ts: str,
                          ties: Sequence[str] = ()) -> DataFrame:
    return dedup_distinct_on(df, key, newest(snapshot, ts, *ties))


def dedup_priority(df: DataFrame, key: Sequence[str], preferences: Sequence[Column]) -> DataFrame:
    return dedup_distinct_on(df, key, preferences)


def window_top_n_per_group(df: DataFrame, group: Sequence[str], orders: Sequence[Column], n: int,
                           spread_by: Sequence[str] = ()) -> DataFrame:
    """At most n rows per group. Beyond Spark's map-side limit the group is first cut into slices by
    a hash of ``spread_by`` (all columns by default): the winners of a group are among its slices' winners."""
    if n > _MAP_SIDE_RANK:
        spread = F.pmod(F.xxhash64(*(spread_by or df.columns)), F.lit(_SPREAD))
        sliced = df.withColumn("_slice", spread)
        local = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*orders))
        df = sliced.withColumn("_rn", local).filter(F.col("_rn") <= n).drop("_rn", "_slice")
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*orders)))
    return ranked.filter(F.col("_rn") <= n).drop("_rn")


def window_forward_fill(df: DataFrame, key: Sequence[str], date: str, columns: Sequence[str],
                        ties: Sequence[str] = ()) -> DataFrame:
    """Carry the last known value forward along ``date``, then ``ties``; together they must be unique in a key.

    A key is filled month by month, so no task sorts a key's whole history; the last known values of
    the months (one row per key and month) are carried into the following months.
    """
    order = [date, *ties]
    months = df.withColumn("_month", F.trunc(F.col(date).cast("date"), "MM"))
    in_month = Window.partitionBy(*key, "_month").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_last_{c}") for c in columns]
    lasts = months.groupBy(*key, "_month").agg(*known)
    over_key = Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))
    earlier = over_key.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(*key, "_month", *[
        F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns])
    filled = months.join(carried, [*key, "_month"], "left")
    for c in columns:
        filled = filled.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(in_month), F.col(f"_carry_{c}")))
    return filled.select(*df.columns)
