"""Continuous file loading. Only for tables whose files are never rewritten in place: the file source
remembers paths, so a rewritten file would not be read again (use the batch load for those)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wayline.sources.files import CSV_OPTIONS


def stream_files(spark: SparkSession, source: str, schema: T.StructType, fmt: str = "csv",
                 files_per_batch: int = 1000) -> DataFrame:
    """New files below ``source`` as a stream, with lineage columns."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    return reader.load(source).select("*", F.col("_metadata.file_path").alias("_source_file"),
                                      F.current_timestamp().alias("_loaded_at"))


def stream_ingest_files(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str,
                        fmt: str = "csv") -> StreamingQuery:
    """Load everything that is new, then stop; each file arrives exactly once."""
    return (stream_files(spark, source, schema, fmt).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).option("path", target)
            .trigger(availableNow=True).start())
