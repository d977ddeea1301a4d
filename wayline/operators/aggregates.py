"""Grouped reductions. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.functions.numbers import exact_ratio


def agg_group_all(df: DataFrame, keys: Sequence[str | Column], **aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def agg_count_if(df: DataFrame, keys: Sequence[str], **conditions: Column) -> DataFrame:
    return agg_group_all(df, keys, **{n: F.count_if(c) for n, c in conditions.items()})


def agg_count_distinct(df: DataFrame, keys: Sequence[str], name: str, *columns: str) -> DataFrame:
    return agg_group_all(df, keys, **{name: F.countDistinct(*columns)})


def agg_count_distinct_if(df: DataFrame, keys: Sequence[str], name: str, column: str,
                          condition: Column) -> DataFrame:
    return agg_group_all(df, keys, **{name: F.countDistinct(F.when(condition, F.col(column)))})


def agg_conditional_sum_avg(df: DataFrame, keys: Sequence[str], column: str, condition: Column) -> DataFrame:
    """Sum with 0 for rows outside the condition; count and mean of the rows inside it."""
    inside = F.when(condition, F.col(column))
    return agg_group_all(df, keys, total=F.sum(F.coalesce(inside, F.when(~F.coalesce(condition, F.lit(False)),
                                                                         F.lit(0)))),
                         mean=exact_ratio(F.sum(inside), F.count(inside)))


def agg_min_max(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return agg_group_all(df, keys, first_value=F.min(column), last_value=F.max(column),
                         row_count=F.count(F.lit(1)))


def agg_weighted_average(df: DataFrame, keys: Sequence[str], value: str, weight: str,
                         name: str = "weighted_mean") -> DataFrame:
    """Mean of means: sum(value * weight) / sum(weight)."""
    return agg_group_all(df, keys, **{name: exact_ratio(F.sum(F.col(value) * F.col(weight)), F.sum(weight))})


def agg_ratio_rollup(df: DataFrame, keys: Sequence[str], num: Column, den: Column,
                     name: str = "rate") -> DataFrame:
    """Rebuild a rate at a coarser grain from stored counts."""
    return agg_group_all(df, keys, **{name: exact_ratio(F.sum(num), F.sum(den))})


def agg_array_ordered(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Sorted values per group, one per input row; the output row is as long as its group."""
    return agg_group_all(df, keys, **{name: F.array_sort(F.collect_list(column))})


def agg_having(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)


def agg_distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def agg_arg_min(df: DataFrame, keys: Sequence[str], value: str, by: Sequence[str], name: str) -> DataFrame:
    """Value at the smallest order; further order columns break ties."""
    return agg_group_all(df, keys, **{name: F.min_by(value, F.struct(*by))})


def agg_bool_or(df: DataFrame, keys: Sequence[str], condition: Column, name: str) -> DataFrame:
    return agg_group_all(df, keys, **{name: F.bool_or(condition)})


def agg_global(df: DataFrame, **aggs: Column) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in aggs.items()])


def agg_multi_level(df: DataFrame, inner_keys: Sequence[str], inner: dict[str, Column],
                    outer_keys: Sequence[str], outer: dict[str, Column]) -> DataFrame:
    """Aggregate of an aggregate."""
    return agg_group_all(agg_group_all(df, inner_keys, **inner), outer_keys, **outer)


def agg_share_of_total(df: DataFrame, columns: Sequence[str], suffix: str = "_share") -> DataFrame:
    """Each column over the row's total."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0)))
    return df.select("*", *[exact_ratio(F.col(c), total).alias(c + suffix) for c in columns])
