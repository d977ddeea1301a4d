"""Marts that follow their fact month by month."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.sources.files import path_exists, remove_path
from wayline.sources.sinks import changed_months, read_fact, read_months

STATE_TYPES = "merge bigint, looked_up string"


def _digest(table: DataFrame, columns: Sequence[str]) -> str:
    """Equal for equal rows in any order."""
    row = F.xxhash64(*columns)
    got = table.agg(F.count(F.lit(1)), F.bit_xor(row), F.sum(F.shiftright(row, 20))).first()
    return "/".join(map(str, got))


def refresh_months(spark: SparkSession, path: str, fact: str, make: Callable[[DataFrame], DataFrame], month: str,
                   lookups: Sequence[tuple[DataFrame, Sequence[str]]] = ()) -> tuple[DataFrame, set[str] | None]:
    """Bring the mart at ``path`` up to date with the fact at ``fact``; returns it and the months rebuilt (None: all).

    ``make`` turns rows of whole months of the fact into rows of the mart whose ``month`` column is the first day of the
    fact's month, so that months don't depend on each other. Only the months that merges touched since the last refresh are
    read and replaced; a month the fact lost goes. If the named columns of a ``lookups`` table are not what they
    were, every month may differ, and all are rebuilt.

    The state is written last: a run that dies is repeated with the same months.
    """
    state = f"{path}/_state"
    seen = spark.read.schema(STATE_TYPES).parquet(state).first() if path_exists(spark, f"{state}/_SUCCESS") else None
    looked_up = " ".join(_digest(table, columns) for table, columns in lookups)
    whole = seen is None or seen["looked_up"] != looked_up
    newest, months = changed_months(spark, fact, 0 if whole else seen["merge"])
    named = F.coalesce(F.date_format(month, "yyyy-MM"), F.lit("unknown"))
    made = make(read_fact(spark, fact) if whole else read_months(spark, fact, sorted(months)))
    schema = made.schema
    if whole or months:
        rows = made.withColumn("_month", named)
        if not whole:
            # a month without rows writes nothing, so its old rows have to go
            held = {m for m in months if path_exists(spark, f"{fact}/_month={m}")}
            for lost in months - held:
                remove_path(spark, f"{path}/_month={lost}")
        (rows.hint("rebalance", F.col("_month")).write.mode("overwrite")
         .option("partitionOverwriteMode", "static" if whole else "dynamic").partitionBy("_month").parquet(path))
        spark.createDataFrame([(newest, looked_up)], STATE_TYPES).coalesce(1).write.mode("overwrite").parquet(state)
    return spark.read.schema(schema).parquet(path).select(*schema.names), None if whole else months
