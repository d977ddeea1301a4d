"""Exact row numbers that never pull a group, however large, into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.session import cut_lineage

_BLOCK, _POS, _FIRST, _ROWS, _BEFORE = "_block", "_pos", "_first", "_rows", "_before"


def rank_rows(df: DataFrame, group: Sequence[str], orders: Sequence[Column],
              rank: str = "rn", total: str | None = None) -> DataFrame:
    """Add ``rank`` (1..n inside each group, by ``orders``) and, if named, the group's row count.

    A range sort on (group, orders) spreads even one huge group over many tasks. Each sorted task
    holds a contiguous piece of a group; the pieces' sizes (one small row each) give the offsets.
    The sorted rows are checkpointed, so the pieces and the rows come from the same sort. ``orders``
    must be unique within a group for a repeatable numbering.
    """
    keys = list(group)
    columns = df.columns
    placed = df.orderBy(*[F.col(k).asc_nulls_last() for k in keys], *orders).withColumn(
        _POS, F.monotonically_increasing_id())
    # the high bits of the generated id name the sort task, the low 33 bits the row in it
    rows = cut_lineage(placed.withColumn(_BLOCK, F.shiftright(_POS, 33)))
    pieces = rows.groupBy(F.col(_BLOCK).alias("_pb"), *[F.col(k).alias(f"_pk_{k}") for k in keys]).agg(
        F.min(_POS).alias(_FIRST), F.count(F.lit(1)).alias(_ROWS))
    piece_keys = [f"_pk_{k}" for k in keys]
    in_group = Window.partitionBy(*piece_keys) if keys else Window.partitionBy(F.lit(0))
    pieces = pieces.select(
        "_pb", *piece_keys, _FIRST,
        F.coalesce(F.sum(_ROWS).over(in_group.orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_BEFORE),
        F.sum(_ROWS).over(in_group).alias(_ROWS))
    same = [F.col(k).eqNullSafe(F.col(p)) for k, p in zip(keys, piece_keys)]
    joined = rows.join(pieces, reduce(lambda x, y: x & y, same, F.col(_BLOCK) == F.col("_pb")))
    result = [F.col(c) for c in columns]
    result.append((F.col(_BEFORE) + F.col(_POS) - F.col(_FIRST) + 1).alias(rank))
    if total:
        result.append(F.col(_ROWS).alias(total))
    return joined.select(*result)


def window_row_number_id(df: DataFrame, orders: Sequence[Column], name: str = "row_id") -> DataFrame:
    """Dense ids 1..n in a global order."""
    return rank_rows(df, [], orders, rank=name)


def window_named_count(df: DataFrame, group: Sequence[str], orders: Sequence[Column]) -> DataFrame:
    """Row number inside the group (``rn``) beside the size of the whole group (``cnt``)."""
    return rank_rows(df, group, orders, rank="rn", total="cnt")


def _cumulated(df: DataFrame, group: Sequence[str], order: str, weight: str) -> DataFrame:
    """Running sum of ``weight`` inside each group (``_upto``) and the group's sum (``_all``).

    The same pieces as in ``rank_rows``: a running sum inside a piece, which is at most one sort task's
    rows, plus the sum of the group's earlier pieces.
    """
    keys = list(group)
    placed = df.orderBy(*[F.col(k).asc_nulls_last() for k in keys], F.col(order)).withColumn(
        _BLOCK, F.spark_partition_id())
    rows = cut_lineage(placed)
    piece_keys = [f"_pk_{k}" for k in keys]
    in_group = Window.partitionBy(*piece_keys) if keys else Window.partitionBy(F.lit(0))
    pieces = rows.groupBy(F.col(_BLOCK).alias("_pb"), *[F.col(k).alias(p) for k, p in zip(keys, piece_keys)]).agg(
        F.sum(weight).alias(_ROWS))
    pieces = pieces.select(
        "_pb", *piece_keys,
        F.coalesce(F.sum(_ROWS).over(in_group.orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_BEFORE),
        F.sum(_ROWS).over(in_group).alias("_all"))
    inside = Window.partitionBy(_BLOCK, *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumn("_inside", F.sum(weight).over(inside))
    same = [F.col(k).eqNullSafe(F.col(p)) for k, p in zip(keys, piece_keys)]
    joined = running.join(pieces, reduce(lambda x, y: x & y, same, F.col(_BLOCK) == F.col("_pb")))
    return joined.select(*[F.col(c) for c in df.columns], (F.col(_BEFORE) + F.col("_inside")).alias("_upto"), "_all")


def agg_median_quantile(df: DataFrame, keys: Sequence[str], value: str,
                        quantiles: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group.

    Equal values are counted together in the map tasks first; of the counted values only the two
    neighbours of each cut take part in the last aggregate.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_w"))
    running = _cumulated(counted, keys, value, "_w")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_w") < rank) & (rank <= F.col("_upto")), F.col(value)))

    outputs = []
    for name, q in quantiles.items():
        cut = F.lit(float(q)) * (F.col("_all") - 1)
        low, high = at(F.floor(cut) + 1), at(F.ceil(cut) + 1)
        outputs.append((low + (high - low) * F.max(cut - F.floor(cut))).alias(name))
    return running.groupBy(*keys).agg(*outputs)
