"""Reading staged text files, load history, manifests and lookup files."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text layout of a staged file (header line, quoted newlines, literal backslashes,
# empty field = missing, wrong column count = error).
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "nullValue": "",
               "emptyValue": "", "encoding": "UTF-8", "mode": "FAILFAST"}
HISTORY_TYPES = "path string, length bigint, modificationTime timestamp, loaded_at timestamp"
PACKED_TYPES = "state string, pack string"
#: Paths of staged files, and how long the history knows them.
PATTERN = ".*[.]csv([.]gz)?"
KEEP_DAYS = 64


def scan_staged_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Positional read of one table's files. Compressed or multi-line files are one task each, so
    parallelism comes from the number of files."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(paths)


def spread_small_scan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spread a scan that has fewer splits than the session has cores (one small file, one unsplittable
    archive) before heavy per-row work; a scan with enough splits is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *columns) if df.rdd.getNumPartitions() < cores else df


def source_multi_glob(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Explicit lists and globs read as one table."""
    return scan_staged_csv(spark, paths, schema)


def load_lineage(df: DataFrame, load_ts: dt.datetime | Column) -> DataFrame:
    """Source file and one load time per load. ``df`` must come straight from a file scan."""
    stamp = load_ts if isinstance(load_ts, Column) else F.lit(load_ts).cast("timestamp")
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"), stamp.alias("_loaded_at"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modificationTime) of every file below a folder; file contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
            .select("path", "length", "modificationTime"))


def load_reload_overwritten(files: DataFrame, history: DataFrame) -> DataFrame:
    """Files never loaded in this state: a rewritten file has another size or time and loads again."""
    return files.join(history, ["path", "length", "modificationTime"], "left_anti")


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _file_system(spark, path)
    return files.exists(folder)


class Folder(NamedTuple):
    name: str


def list_folders(spark: SparkSession, path: str) -> list[Folder]:
    """Folders directly below a path (a table's versions: a handful)."""
    files, folder = _file_system(spark, path)
    return [Folder(status.getPath().getName()) for status in files.listStatus(folder) if status.isDirectory()]


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly below a path."""
    files, folder = _file_system(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isFile()]
    return [n for n in names if not n.startswith(("_", "."))]


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    files, target = _file_system(spark, new)
    files.mkdirs(target.getParent())
    if not files.rename(_file_system(spark, old)[1], target):
        raise OSError(f"could not rename {old} to {new}")


def remove_path(spark: SparkSession, path: str) -> None:
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A parquet table that may not have been written yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def ensure_raw_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An empty raw table with its fixed schema, written only when nothing is there yet."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _history(spark: SparkSession, history: str) -> DataFrame:
    """File states loaded lately: one folder per day of loading."""
    return read_or_empty(spark, history, HISTORY_TYPES).select("path", "length", "modificationTime", "loaded_at")


def _first_load(spark: SparkSession, history: str, load_ts: dt.datetime) -> int:
    """When the table was first loaded, in microseconds; kept apart, as the history expires."""
    path = f"{history}/_first"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(load_ts,)], "loaded_at timestamp").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("loaded_at timestamp").parquet(path).agg(F.unix_micros(F.min("loaded_at"))).first()[0]


def expire_history(spark: SparkSession, history: str, load_ts: dt.datetime, keep_days: int = KEEP_DAYS) -> None:
    """Drop the days of loading that lie more than ``keep_days`` before this load."""
    limit = f"day={(load_ts - dt.timedelta(days=keep_days)).date().isoformat()}"
    for folder in list_folders(spark, history) if path_exists(spark, history) else []:
        if folder.name.startswith("day=") and folder.name < limit:
            remove_path(spark, f"{history}/{folder.name}")


def load_incremental_files(spark: SparkSession, source: str, target: str, history: str,
                           schema: T.StructType, load_ts: dt.datetime, pattern: str = PATTERN,
                           keep_days: int = KEEP_DAYS, load_uncertain: bool = False) -> int:
    """Load every new or rewritten file below ``source`` whose path matches ``pattern`` into the raw table.

    Each state of a file owns one partition of the target, which the load overwrites. A load that
    died before its history was written therefore repeats without doubling rows. Returns the number
    of files. Only their names pass through the driver, as the reader needs them.

    The history forgets file states ``keep_days`` after their load. A file last written before that, of a table
    first loaded before that, may have been loaded and forgotten: it is left out unless ``load_uncertain``. States
    that ``pack_raw`` has packed are in the table already and enter the history only.
    """
    first = _first_load(spark, history, load_ts)
    found = list_files(spark, source).filter(F.col("path").rlike(f"^(?:{pattern})$"))
    fresh = load_reload_overwritten(found, _history(spark, history))
    limit = int((load_ts - dt.timedelta(days=keep_days)).timestamp() * 1_000_000)
    if first < limit and not load_uncertain:
        fresh = fresh.filter(F.unix_micros("modificationTime") >= limit)
    state = _file_state(F.col("path"), F.col("length"), F.col("modificationTime"))
    packed = read_or_empty(spark, f"{target}/_packed", PACKED_TYPES).select("state", F.lit(True).alias("packed"))
    found = fresh.withColumn("state", state).join(packed, "state", "left").orderBy("path").collect()
    if not found:
        return 0
    new = [f["path"] for f in found if not f["packed"]]
    if new:
        rows = scan_staged_csv(spark, new, schema)
        own = _file_state(F.col("_metadata.file_path"), F.col("_metadata.file_size"),
                          F.col("_metadata.file_modification_time"))
        stamped = rows.select("*", own.alias("_file_state"), F.col("_metadata.file_path").alias("_source_file"),
                              F.lit(load_ts).cast("timestamp").alias("_loaded_at"))
        (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_file_state").parquet(target))
    loaded = spark.createDataFrame([(f["path"], f["length"], f["modificationTime"], load_ts) for f in found],
                                   HISTORY_TYPES)
    loaded.coalesce(1).write.mode("append").parquet(f"{history}/day={load_ts.date().isoformat()}")
    expire_history(spark, history, load_ts, keep_days)
    return len(found)


def _file_state(path: Column, length: Column, modified: Column) -> Column:
    return F.md5(F.concat_ws("|", path, length, F.unix_micros(modified)))


def pack_raw(spark: SparkSession, target: str, schema: T.StructType, least_bytes: int = 64 << 20) -> int:
    """Bring the raw table's small partitions together, in few files; returns how many were packed.

    Partitions below ``least_bytes`` are written into one hidden folder, and their file states noted as packed; then the
    old partitions go and the folder takes their place. A run that dies is finished by the next: before the note is
    complete nothing was removed, after it nothing is read again. Not to be run while others read the table.
    """
    _finish_packing(spark, target)
    sizes = list_files(spark, target).withColumn("part", F.regexp_extract("path", "/(_file_state=[^/]+)/", 1)).filter(
        "part <> ''").groupBy("part").agg(F.sum("length").alias("bytes")).filter(F.col("bytes") < least_bytes)
    small = [r["part"] for r in sizes.orderBy("part").collect()]
    if len(small) < 2:
        return 0
    name = hashlib.md5("|".join(small).encode()).hexdigest()
    rows = read_bronze(spark, [f"{target}/{part}" for part in small], schema)
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{target}/_packing/{name}/rows")
    states = [(part.removeprefix("_file_state="), name) for part in small]
    spark.createDataFrame(states, PACKED_TYPES).coalesce(1).write.mode("overwrite").parquet(
        f"{target}/_packing/{name}/states")
    _finish_packing(spark, target)
    return len(small)


def _finish_packing(spark: SparkSession, target: str) -> None:
    """Put complete packs into the table; an incomplete one is thrown away, as its partitions are still there."""
    folder = f"{target}/_packing"
    for pack in list_folders(spark, folder) if path_exists(spark, folder) else []:
        path = f"{folder}/{pack.name}"
        if path_exists(spark, f"{path}/states/_SUCCESS"):
            states = spark.read.schema(PACKED_TYPES).parquet(f"{path}/states")
            noted = read_or_empty(spark, f"{target}/_packed", PACKED_TYPES)
            states.join(noted, ["state", "pack"], "left_anti").coalesce(1).write.mode("append").parquet(f"{target}/_packed")
            for row in states.collect():
                remove_path(spark, f"{target}/_file_state={row['state']}")
            system, _ = _file_system(spark, path)
            place = spark._jvm.org.apache.hadoop.fs.Path
            if path_exists(spark, f"{path}/rows"):
                system.rename(place(f"{path}/rows"), place(f"{target}/_file_state={pack.name}"))
        remove_path(spark, path)


def read_bronze(spark: SparkSession, target: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """The raw table with its lineage columns."""
    fields = list(schema.fields) + [T.StructField("_source_file", T.StringType()),
                                    T.StructField("_loaded_at", T.TimestampType())]
    paths = [target] if isinstance(target, str) else list(target)
    return spark.read.schema(T.StructType(fields)).parquet(*paths).select(*[f.name for f in fields])


def load_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, largest first."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    return total.orderBy(F.desc("row_count"), "table_name")


def csv_fixed_layout(df: DataFrame, columns: Mapping[str, str], constants: Mapping[str, str]) -> DataFrame:
    """Constants first, then the named columns renamed; a missing column becomes empty text."""
    present = set(df.columns)
    return df.select(
        *[F.lit(v).alias(k) for k, v in constants.items()],
        *[(F.coalesce(F.col(src).cast("string"), F.lit("")) if src in present else F.lit("")).alias(out)
          for src, out in columns.items()])


def pii_drop_columns(df: DataFrame, allow: Sequence[str]) -> DataFrame:
    """Only the allowed columns, in the table's order; anything new stays out until it is allowed."""
    return df.select(*[c for c in df.columns if c in set(allow)])


def load_manifest(rows_per_file: DataFrame, manifest: DataFrame, prefix: str | None = None) -> DataFrame:
    """Manifest with the new entries; entries below ``prefix``, or of the same path, are replaced."""
    kept = manifest if prefix is None else manifest.filter(~F.col("path").startswith(prefix))
    return kept.join(rows_per_file, "path", "left_anti").unionByName(rows_per_file, allowMissingColumns=True)


def file_row_counts(df: DataFrame, source: str, licence: str) -> DataFrame:
    """Rows and bytes of every file of a scan, as manifest entries."""
    meta = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return meta.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes")).withColumns(
        {"source": F.lit(source), "license": F.lit(licence)})


def write_staged_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text files in the layout ``scan_staged_csv`` reads, one per task."""
    (df.write.mode(mode).options(header="true", escape='"', compression="gzip", ignoreLeadingWhiteSpace="false",
                                 ignoreTrailingWhiteSpace="false", emptyValue="").csv(path))


def seed_read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A small lookup file with declared types."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def source_freshness(sources: Mapping[str, DataFrame], ts: str, as_of: dt.datetime, days: int = 35) -> DataFrame:
    """Newest load per source; ``warn`` when it is older than the limit."""
    newest = [df.agg(F.max(F.col(ts)).alias("newest")).select(F.lit(name).alias("source_name"), "newest")
              for name, df in sources.items()]
    report = newest[0]
    for more in newest[1:]:
        report = report.unionByName(more)
    now = F.lit(as_of).cast(report.schema["newest"].dataType)
    late = F.col("newest") + F.make_dt_interval(F.lit(days)) < now
    return report.withColumn("status", F.when(F.col("newest").isNull() | late, "warn").otherwise("pass"))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_day"))


def month_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """(year, month) of every month from the first date's to the last date's."""
    months = F.sequence(F.trunc(F.lit(start), "MM"), F.trunc(F.lit(end), "MM"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("d")).select(
        F.year("d").alias("year"), F.month("d").alias("month"))


def values_inline(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
