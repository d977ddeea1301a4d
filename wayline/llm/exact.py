"""Exact dedup: a two-pass Bloom filter tells which hashes may repeat; only those rows shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import WORD_GAP, arrow_batches, join_counted, stored

#: Bits of one filter segment; a hash sets all its bits inside the segment its first bytes name.
SEGMENT_BITS = 1 << 18
PROBES = 3


def _places(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and bit places of 32-byte hashes given as rows of four 64-bit words."""
    segment = (hashes[:, 0] % np.uint64(segments)).astype(np.int64)
    bits = [(hashes[:, 1] >> np.uint64(18 * i)) % np.uint64(SEGMENT_BITS) for i in range(PROBES)]
    return segment, np.stack(bits, axis=1).astype(np.int64)


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(-1, 4)


def _local_bits(segments: int):
    """First pass in a task: the places its rows set, once or more often."""
    schema = pa.schema([("segment", pa.int64()), ("once", pa.binary()), ("more", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            segment, bits = _places(_words(batch.column(0)), segments)
            # a hash may name one place twice; that alone is no repetition
            bits = np.sort(bits, axis=1)
            fresh = np.ones(bits.shape, dtype=bool)
            fresh[:, 1:] = bits[:, 1:] != bits[:, :-1]
            place = (segment[:, None] * SEGMENT_BITS + bits)[fresh]
            place, counts = np.unique(place, return_counts=True)
            cuts = np.flatnonzero(np.diff(place // SEGMENT_BITS)) + 1
            rows = []
            for part, n in zip(np.split(place, cuts), np.split(counts, cuts)):
                inside = (part % SEGMENT_BITS).astype("<u4")
                rows.append((int(part[0] // SEGMENT_BITS), inside[n == 1].tobytes(), inside[n > 1].tobytes()))
            yield from arrow_batches(rows, schema)

    return run


def _merge_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unite the tasks' places: a bit stays if two rows set it. Holds 64 KB for each segment dealt here."""
    schema = pa.schema([("segment", pa.int64()), ("bits", pa.binary())])
    seen: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, once, more in zip(*(c.to_pylist() for c in batch.columns)):
            if segment not in seen:
                seen[segment] = np.zeros(SEGMENT_BITS // 8, dtype=np.uint8)
                twice[segment] = np.zeros(SEGMENT_BITS // 8, dtype=np.uint8)
            flat = np.zeros(SEGMENT_BITS, dtype=bool)
            flat[np.frombuffer(once, dtype="<u4")] = True
            again = np.zeros(SEGMENT_BITS, dtype=bool)
            again[np.frombuffer(more, dtype="<u4")] = True
            flat |= again
            set_bits, more_bits = np.packbits(flat), np.packbits(again)
            twice[segment] |= more_bits | (seen[segment] & set_bits)
            seen[segment] |= set_bits
    yield from arrow_batches(((s, b.tobytes()) for s, b in twice.items() if b.any()), schema)


def _probe(filters, segments: int):
    """Second pass: may the row's hash occur in another row?"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(filters.value, dtype=np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            segment, places = _places(_words(batch.column(batch.schema.get_field_index("sha"))), segments)
            at = segment[:, None] * SEGMENT_BITS + places
            maybe = ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], names=[*batch.schema.names, "maybe"])

    return run


def repeat_filter(hashes: DataFrame, rows: int, bits_per_row: int = 16, max_bytes: int = 32 << 20) -> tuple[bytes, int]:
    """Bits set by two or more rows of a column of 32-byte hashes, and the number of segments.

    The filter is proportional to the rows up to ``max_bytes``. Beyond that bound more rows count as
    possibly repeated and shuffle; the result stays the same.
    """
    segments = max(1, min(max_bytes * 8, rows * bits_per_row) // SEGMENT_BITS)
    local = hashes.mapInArrow(_local_bits(segments), "segment long, once binary, more binary")
    merged = local.repartition("segment").mapInArrow(_merge_bits, "segment long, bits binary")
    bits = bytearray(segments * SEGMENT_BITS // 8)
    size = SEGMENT_BITS // 8
    for row in merged.toLocalIterator():
        bits[row.segment * size:(row.segment + 1) * size] = row.bits
    return bytes(bits), segments


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits_per_row: int = 16,
                max_filter_bytes: int = 32 << 20) -> DataFrame:
    """One row per input row: which row of its group of equal texts stays.

    Texts are equal when they are identical after every run of spaces, tabs and line ends became one space.
    NULL counts as an empty text. The row with the smallest id stays; a NULL id comes last, and of repeated
    rows exactly one stays. Other columns are not read. An empty table gives an empty table.

    The rows are first reduced to (id, hash, row number) and stored. Pass one unites the tasks' Bloom
    filters into one whose bits were set by two rows; pass two probes it. Only possibly repeated rows are
    grouped (with map-side partial counts) and joined, very large groups by a broadcast of at most 1000 of them;
    the rest pass straight through.
    """
    spark = docs.sparkSession
    plain = F.regexp_replace(F.coalesce(F.col(text_column), F.lit("")), WORD_GAP, " ")
    narrow = stored(docs.select(F.col(id_column).alias("doc_id"), F.unhex(F.sha2(plain, 256)).alias("sha"),
                                F.monotonically_increasing_id().alias("row")), "exact-hashes")
    bits, segments = repeat_filter(narrow.select("sha"), narrow.count(), bits_per_row, max_filter_bytes)
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    probed = narrow.mapInArrow(_probe(spark.sparkContext.broadcast(bits), segments),
                               f"doc_id {id_type}, sha binary, row long, maybe boolean")
    maybe = stored(probed.filter("maybe"), "exact-maybe")
    groups = stored(maybe.groupBy("sha").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("n")), "exact-groups")
    grouped = join_counted(maybe, groups, "sha", "n").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("first.row") == F.col("row")).alias("kept"), "sha")
    alone = probed.filter("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    return alone.unionByName(grouped).withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")
