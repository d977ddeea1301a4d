"""Helpers the text operators share: stored tables, words, vectorised word hashes, packed arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wayline.session import scratch_path

#: Fixed value: the characters that separate words.
WORD_GAP = "[\\x20\\x09-\\x0D]+"

MASK64 = (1 << 64) - 1
_RADIX = 0x9E3779B97F4A7C15 | 1
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table once into the shared scratch folder and go on from the files.

    This cuts the lineage: the rows survive lost executors and are computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to differ from all columns of a table."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    """The Arrow type a column has inside ``mapInArrow``."""
    return to_arrow_type(df.schema[column].dataType)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; NULL counts as an empty text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def row_key(id_column: Column, text: Column) -> Column:
    """16 bytes that stand for (id, text): equal rows share a key, so it can be recomputed at any time."""
    named = F.concat(F.coalesce(F.concat(F.lit("i"), id_column.cast("string")), F.lit("n")), F.lit("\n"),
                     F.coalesce(text, F.lit("")))
    return F.unhex(F.md5(named))


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 texts of an Arrow string column; NULL becomes empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Parts of few rows, so that only these stand in memory as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def chunked(texts: Sequence[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes together; a longer text stands alone."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a public finaliser of multiply and shift steps)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int, radix: int, kept: dict = {}) -> np.ndarray:  # noqa: B006 - one table for each worker
    have = kept.get(radix)
    if have is None or len(have) < n:
        table_ = np.full(1 << (n - 1).bit_length() if n > 1 else 1, radix, dtype=np.uint64)
        table_[0] = 1
        have = np.cumprod(table_)
        if n <= 1 << 23:
            kept[radix] = have
    return have[:n]


def word_bounds(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, ends, words per text) of all words of some texts, laid out one after another."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    gap = (buffer == 32) | ((buffer >= 9) & (buffer <= 13))
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([np.zeros(1, dtype=edge.dtype), edge])
    starts, ends = edge[0::2], edge[1::2]
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    return buffer, starts, ends, counts


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 19) -> np.ndarray:
    """A 64-bit hash of every word: polynomial prefix sums over the bytes, shifted to the word's start, then mixed.

    Works on blocks of words that lie in about ``block`` bytes, so the tables stay small.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + block, side="right")))
        n = int(ends[j - 1] - base)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((buffer[base:base + n].astype(np.uint64) + np.uint64(1)) * _powers(n, _RADIX), out=sums[1:])
        first, last = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[last] - sums[first]) * _powers(n, _RADIX_INVERSE)[first]
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (the last n - 1 positions have none)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        total = total * np.uint64(_RADIX) + words[i:i + size]
    return mix(total)


def inside_texts(counts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of the window positions over joined texts lie inside one text."""
    last = np.cumsum(counts)
    ok = np.ones(max(size, 0), dtype=bool)
    for end, count in zip(last.tolist(), counts.tolist()):
        ok[max(end - min(n - 1, count), 0):end] = False
    return ok


def pack(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, limit: int = 8 << 20,
                  most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) if isinstance(v, (bytes, str, np.ndarray)) else 8 for v in row)
        if size > limit or len(held) >= most:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def join_counted(left: DataFrame, counted: DataFrame, key: str, n: str, share: int = 1000) -> DataFrame:
    """Inner join of stored rows with one counted row per key, safe for hot keys.

    Keys that hold more than 1 / ``share`` of the counted rows are fewer than ``share``: these are broadcast, so
    their rows stay where they are. All other keys meet in an ordinary join. Both sides should be stored tables.
    """
    total = counted.agg(F.sum(n)).first()[0] or 0
    hot = counted.filter(F.col(n) * share > total)
    rest = counted.filter(F.col(n) * share <= total)
    many = left.join(F.broadcast(hot), key)
    others = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return many.unionByName(others)
