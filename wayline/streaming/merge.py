"""Continuous merging into a month-partitioned fact."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayline.sources.files import list_folders, path_exists, remove_path
from wayline.sources.sinks import merge_into_partitions

KEPT_BATCHES = 100
LEDGER_TYPES = "stream string, batch bigint, rows bigint, newest string, oldest string"


def _ledger(target: str, checkpoint: str) -> str:
    """A stream's part of the ledger, beside the fact's months; a stream is known by its checkpoint."""
    return f"{target}/_batches/stream={hashlib.md5(checkpoint.encode()).hexdigest()}"


def committed(spark: SparkSession, target: str, checkpoint: str, batch_id: int) -> bool:
    return path_exists(spark, f"{_ledger(target, checkpoint)}/batch={batch_id}/_SUCCESS")


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """The last committed batches of every stream: rows, oldest and newest time of each."""
    if not path_exists(spark, f"{target}/_batches"):
        return spark.createDataFrame([], LEDGER_TYPES)
    return spark.read.schema(LEDGER_TYPES).parquet(f"{target}/_batches/stream=*/batch=*")


def merge_batch(batch: DataFrame, batch_id: int, target: str, key: Sequence[str], ts: str, date: str,
                checkpoint: str) -> bool:
    """Merge one micro-batch unless the ledger has it; True if it was merged.

    The batch enters the ledger when its merge is complete. A run that dies in between merges it again, which
    changes nothing, as the newest row of a key wins whatever the order; later replays are skipped without
    reading the batch. The ledger keeps the last ``KEPT_BATCHES`` batches; earlier ones are known by their number.
    """
    spark, path = batch.sparkSession, _ledger(target, checkpoint)
    known = [int(f.name.removeprefix("batch=")) for f in list_folders(spark, path)
             if f.name.startswith("batch=")] if path_exists(spark, path) else []
    complete = sorted(b for b in known if committed(spark, target, checkpoint, b))
    if batch_id in complete or (len(complete) >= KEPT_BATCHES and batch_id < complete[0]):
        return False
    sums = batch.agg(F.count(F.lit(1)).alias("rows"), F.max(ts).cast("string").alias("newest"),
                     F.min(ts).cast("string").alias("oldest")).first()
    if sums["rows"]:
        merge_into_partitions(batch, target, key, ts, date)
    row = (path.rsplit("=", 1)[1], batch_id, sums["rows"], sums["newest"], sums["oldest"])
    spark.createDataFrame([row], LEDGER_TYPES).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    for old in complete[:max(0, len(complete) + 1 - KEPT_BATCHES)]:
        remove_path(spark, f"{path}/batch={old}")
    return True


def stream_merge_upsert(stream: DataFrame, target: str, key: Sequence[str], ts: str, date: str, checkpoint: str,
                        merge: Callable[..., bool] = merge_batch) -> StreamingQuery:
    """Merge each micro-batch once: the newest row of a key wins, and a batch in the ledger is skipped."""

    def run(batch: DataFrame, batch_id: int) -> None:
        merge(batch, batch_id, target, key, ts, date, checkpoint)

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
