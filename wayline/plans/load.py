"""The load step: new and rewritten files of every raw table, with lineage, history and a manifest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from wayline.sources import files
from wayline.sources.schemas import RAW_COLUMNS, bronze_schema
from wayline.sources.sinks import read_version, write_version


def load_all(spark: SparkSession, source: str, root: str, load_ts: dt.datetime, licence: str = "unknown",
             names: Iterable[str] = tuple(RAW_COLUMNS)) -> dict[str, DataFrame]:
    """Load ``source``/<table> into ``root``/raw/<table> for every raw table and return the raw tables.

    A table without files is empty. The manifest (``root``/manifest) gets rows and bytes of the files that hold
    rows; a repeated load changes nothing.
    """
    raw = {}
    for name in names:
        schema, folder, target = bronze_schema(name), f"{source}/{name}", f"{root}/raw/{name}"
        if files.path_exists(spark, folder) and files.load_incremental_files(
                spark, folder, target, f"{root}/history/{name}", schema, load_ts):
            scan = spark.read.schema(schema).options(**files.CSV_OPTIONS, recursiveFileLookup="true").csv(folder)
            counts = files.file_row_counts(scan, name, licence)
            before = read_version(spark, f"{root}/manifest")
            write_version(files.load_manifest(counts, counts.limit(0) if before is None else before),
                          f"{root}/manifest")
        raw[name] = (files.read_bronze(spark, target, schema) if files.path_exists(spark, target)
                     else spark.createDataFrame([], bronze_schema(name, lineage=True)))
    return raw
