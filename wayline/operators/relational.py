"""Projections, filters, joins and row sets as DataFrame -> DataFrame functions.

Joins carry no broadcast hint unless a side was counted: Catalyst broadcasts a side whose size it knows, and
adaptive execution does so after measuring the shuffled side, with a sort-merge join (split on skew) otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.functions.hashing import hash_int, hash_uniform
from wayline.operators.ranking import window_named_count

# sides counted up to this many rows are broadcast
SMALL_ROWS = 10_000

# --- projections and filters -------------------------------------------------------------------


def project_except_add(df: DataFrame, drop: Sequence[str], **new: Column) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in set(drop)],
                     *[c.alias(name) for name, c in new.items()])


def filter_basic(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)


def filter_optional_param(df: DataFrame, column: str, value=None) -> DataFrame:
    """A missing parameter means no filter at all, so nothing blocks pushdown."""
    return df if value is None else df.filter(F.col(column) == F.lit(value))


def filter_high_water(df: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """Rows newer than the newest row of the target; all rows when there is none.

    The mark is one scalar; as a literal it reaches the scan as a pushed filter.
    """
    newest = target.agg(F.max(ts)).first()[0] if target is not None else None
    return df if newest is None else df.filter(F.col(ts) > F.lit(newest))


def filter_not_in_correlated(df: DataFrame, other: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """``value NOT IN (select value from other where keys match)``, for a value that is not NULL."""
    guarded = df.filter(F.col(value).isNotNull())
    return guarded.join(other.filter(F.col(value).isNotNull()), [*on, value], "left_anti")


def query_parameters(spark: SparkSession, sql: str, args: dict, **views: DataFrame) -> DataFrame:
    """SQL text with bound values and DataFrames; values never become part of the text."""
    return spark.sql(sql, args=args, **views)


# --- joins -------------------------------------------------------------------------------------


def join_inner_equi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "inner")


def join_left_dim(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    return fact.join(dim, on, "left")


def join_multi_key_fx(fact: DataFrame, fx: DataFrame, currency: str, day: Column) -> DataFrame:
    """Attach ``usd_per_unit`` of the row's currency on ``day``; unknown rates stay NULL."""
    rates = fx.select(F.col("currency_code").alias("_fx_cur"), F.col("rate_date").alias("_fx_day"),
                      "usd_per_unit")
    joined = fact.join(rates, (fact[currency] == rates["_fx_cur"]) & (day == rates["_fx_day"]), "left")
    return joined.drop("_fx_cur", "_fx_day")


def join_self(df: DataFrame, key: str, parent: str, take: Mapping[str, str]) -> DataFrame:
    """Columns of the row named by ``parent``, under new names."""
    parents = df.select(F.col(key).alias("_parent"), *[F.col(c).alias(n) for c, n in take.items()])
    return df.join(parents, F.col(parent) == F.col("_parent"), "left").drop("_parent")


def join_using(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    return left.join(right, list(keys), how)


def join_latest_snapshot(df: DataFrame, group: Sequence[str], snapshot: str) -> DataFrame:
    """Rows of each group's newest snapshot.

    The distinct (group, snapshot) pairs come from one hash aggregate; their maxima, one row per group, are
    counted: up to ``SMALL_ROWS`` they are broadcast, so the big table is neither shuffled nor sorted. More
    groups than that meet the table in an ordinary join.
    """
    pairs = df.select(*group, snapshot).distinct()
    newest = pairs.groupBy(*group).agg(F.max(snapshot).alias(snapshot))
    few = newest.limit(SMALL_ROWS + 1).collect()
    if len(few) <= SMALL_ROWS:
        newest = F.broadcast(df.sparkSession.createDataFrame(few, newest.schema))
    return df.join(newest, [*group, snapshot], "left_semi")


def join_residual_predicate(left: DataFrame, right: DataFrame, on, predicate: Column,
                            how: str = "inner") -> DataFrame:
    """A constant condition on the right side is applied before the shuffle."""
    return left.join(right.filter(predicate), on, how)


def join_three_way_chain(frames: Sequence[DataFrame], keys: Sequence) -> DataFrame:
    return reduce(lambda acc, step: acc.join(step[0], step[1], "inner"), zip(frames[1:], keys), frames[0])


def join_null_tolerant_or(left: DataFrame, right: DataFrame, key: str, column: str,
                          take: Sequence[str]) -> DataFrame:
    """Left join where a NULL ``column`` on the right matches every row of the key.

    The rules of a key become one array, joined once by key; a row then takes the rules that fit it. The
    left side is read once, and a hot key meets one row instead of all its rules.
    """
    rules = right.groupBy(key).agg(F.collect_list(F.struct(F.col(column).alias("_for"), *take)).alias("_rules"))
    fit = F.filter("_rules", lambda r: r["_for"].isNull() | (r["_for"] == F.col(column)))
    matched = left.join(rules, key, "left").withColumn("_rule", F.explode_outer(fit))
    return matched.select(*left.columns, *[F.col(f"_rule.{c}").alias(c) for c in take])


def join_semi_exists(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_semi")


def join_anti_not_exists(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_anti")


def join_cross_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """One row per listed value, by exploding a literal array instead of a cross join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def join_nth_candidate(requests: DataFrame, candidates: DataFrame, group: Sequence[str],
                       orders: Sequence[Column], pick_key: str, salt: str) -> DataFrame:
    """For each request choose candidate ``1 + floor(u * n)`` of its group of n.

    The group sizes are joined first, which fixes the number; the second join is then an equality
    on (group, number). No request ever meets all candidates of its group.
    """
    numbered = window_named_count(candidates, group, orders)
    sizes = numbered.groupBy(*group).agg(F.max("cnt").alias("cnt"))
    wanted = requests.join(sizes, list(group), "inner").withColumn(
        "rn", F.lit(1) + F.floor(hash_uniform(F.col(pick_key), salt) * F.col("cnt")))
    return wanted.join(numbered.drop("cnt"), [*group, "rn"], "inner")


def join_conditional_aliases(df: DataFrame, aliases: DataFrame, key: str, code: str) -> DataFrame:
    """Rows with a code, plus the same rows again under replacement codes."""
    renamed = df.drop(code).join(aliases.select(key, code), key, "inner")
    return df.filter(F.col(code).isNotNull()).unionByName(renamed)


def join_scalar_subqueries(frames: Sequence[DataFrame]) -> DataFrame:
    """Several one-row frames side by side: stacked with missing columns NULL, then folded into one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


# --- sorting, limits, sets, reshaping -------------------------------------------------------------


def sort_result(df: DataFrame, orders: Sequence[Column]) -> DataFrame:
    return df.orderBy(*orders)


def topk_limit(df: DataFrame, orders: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*orders).limit(k)


def topk_hash_sample(df: DataFrame, key: str, k: int, salt: str) -> DataFrame:
    """The same k rows on every run: smallest hash of the key, ties by the key."""
    return df.orderBy(hash_int(F.col(key), salt), F.col(key)).limit(k)


def limit_rows_cap(df: DataFrame, n: int = 500) -> DataFrame:
    """Cap after the ordering, which keeps the inner order."""
    return df.limit(n)


def set_union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def pivot_matrix(df: DataFrame, row: str, column: str, values: Sequence, measure: str) -> DataFrame:
    """One column per listed value, with the mean of the filled cells to order rows by."""
    grid = df.groupBy(row).pivot(column, list(values)).agg(F.max(measure))
    cells = F.filter(F.array(*[F.col(f"`{v}`") for v in grid.columns[1:]]), lambda x: x.isNotNull())
    total = F.aggregate(F.transform(cells, lambda x: x.cast("decimal(24,6)")),
                        F.lit(0).cast("decimal(32,6)"), lambda a, x: (a + x).cast("decimal(32,6)"))
    return grid.withColumn("row_mean", F.round(F.try_divide(total, F.size(cells).cast("decimal(10,0)")), 6))


def unpivot_rates(df: DataFrame, id_column: str, columns: Sequence[str], name: str = "currency_code",
                  value: str = "usd_per_unit") -> DataFrame:
    return df.unpivot(id_column, list(columns), name, value).filter(F.col(value).isNotNull())


def lateral_flatten(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per element; rows with an empty or missing array disappear."""
    return df.withColumn(name, F.explode(column))
