"""Large tables made and written in parts, one after another, so that scratch files and shuffles hold a part at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import ExitStack, contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.session import scratch_path
from wayline.sources.files import path_exists, remove_path

# source bytes of a part; plans give sizes they don't know as far larger numbers than any table has
PART_BYTES = 200 << 20
_UNKNOWN_BYTES = 1 << 60


class Parts(NamedTuple):
    """A table as ``count`` parts of one schema, about; a part may be gone once the next is asked for."""

    count: int
    frames: Iterable[DataFrame]


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def lean_writes(spark: SparkSession, folders: int = 0) -> Iterator[None]:
    """Writes inside leave less on disk: a query's shuffle files go when it ends, not with some later garbage collection, and
    columns are packed by zstandard unless the session names a codec. Up to ``folders`` partition folders are written at once
    by a task, without a sort."""
    codec = "spark.sql.parquet.compression.codec"
    with ExitStack() as held:
        for name, value in {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                            codec: spark.conf.get(codec, None) or "zstd",
                            "spark.sql.maxConcurrentOutputFileWriters": str(folders)}.items():
            held.enter_context(setting(spark, name, value))
        yield


def parts_for(df: DataFrame, bytes_each: int | None = None, most: int = 64) -> int:
    """A number of parts by the size of the files a table is made from, as its plan knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    known = sum(size for size in sizes if size < _UNKNOWN_BYTES)
    return max(1, min(most, -(-known // (bytes_each or PART_BYTES))))


def append_part(df: DataFrame, path: str) -> None:
    with lean_writes(df.sparkSession):
        df.write.mode("append").parquet(path)


def append_dealt(df: DataFrame, path: str, part: Column, count: int) -> None:
    """Add rows to the folders ``_part=0`` to ``_part=count-1``. A task per core writes, so that the files don't get small."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    with lean_writes(df.sparkSession, count):
        df.withColumn("_part", part).coalesce(cores).write.mode("append").partitionBy("_part").parquet(path)


def read_dealt(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows written by ``append_dealt``, with their ``_part``."""
    return spark.read.schema(T.StructType(schema.fields + [T.StructField("_part", T.IntegerType())])).parquet(path)


def deal_by_key(frames: Iterable[DataFrame], key: Column, count: int) -> Iterator[DataFrame]:
    """The rows of all frames in ``count`` tables at most, all rows of a key (and all without one) in the same table. They are
    stored; a table's files go when the next table is asked for."""
    path = schema = None
    for frame in frames:
        spark, schema, path = frame.sparkSession, frame.schema, path or scratch_path(frame.sparkSession, "dealt")
        append_dealt(frame, path, F.pmod(F.xxhash64(key), F.lit(count)).cast("int"), count)
    held = [f"{path}/_part={n}" for n in range(count) if path_exists(spark, f"{path}/_part={n}")]
    if not held:
        yield spark.createDataFrame([], schema)
    for folder in held:
        yield spark.read.schema(schema).parquet(folder)
        remove_path(spark, folder)
    remove_path(spark, path)
