"""LM scoring: exact word counts, and a log-frequency Bloom filter of quantised bigram counts."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import MASK64, arrow_batches, arrow_type, byte_texts, mix, pack, slices, stored, unpack

#: The end of a text as a token; it holds a separator, so no word can be equal to it.
END = b"\n"
#: Bytes of text that a task counts together.
CHUNK_BYTES = 16 << 20
BUCKETS_PER_PARTITION = 4
PROBES = 6
BITS_PER_ENTRY = 10
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = 0xC2B2AE3D27D4EB4F

_ROW = "kind string, bucket long, chunk long, level long, n long, total long, data binary"
_ROW_ARROW = pa.schema([("kind", pa.string()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("level", pa.int64()),
                        ("n", pa.int64()), ("total", pa.int64()), ("data", pa.binary())])


def pack_numbers(values: np.ndarray) -> bytes:
    """Bytes of equal weight brought together, then compressed."""
    raw = np.ascontiguousarray(values)
    return pack(np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), raw.itemsize).T).tobytes())


def unpack_numbers(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(unpack(data), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(kind).ravel()


def pack_counts(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes as differences, with a count for each."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8")
    return pickle.dumps((pack_numbers(steps), pack_numbers(counts.astype("<i8"))))


def unpack_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = pickle.loads(data)
    return np.cumsum(unpack_numbers(steps, "<u8"), dtype=np.uint64), unpack_numbers(counts, "<i8")


def bucket_of(hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Equal ranges of the hash's values, in order."""
    return ((hashes >> np.uint64(bits - 24)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def pair_hashes(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """48-bit hashes of two words in a row."""
    return mix(before * _PAIR + word) >> np.uint64(16)


def _level_of(counts: np.ndarray) -> np.ndarray:
    """Quantised count: 1 for 1, 2 for 2 and 3, 3 for 4 to 7 and so on."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def level_count(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level; 0 for level 0."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1) - 0.5, 0.0)


def split_sorted(hashes: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, slice]]:
    if not len(hashes):
        return
    owner = bucket_of(hashes, bits, buckets)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield int(owner[a]), slice(a, b)


def _count_chunk(chunk: int, ids: list, train: list, held: list, texts: list, buckets: int) -> Iterator[tuple]:
    """A chunk's words and bigrams by bucket, and its texts as word numbers."""
    numbers: dict[bytes, int] = {END: 0}
    parts = []
    for text in texts:
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in text.lower().split()), np.int32))
    lengths = np.array([len(p) + 1 for p in parts])
    ends = np.cumsum(lengths)
    tokens = np.zeros(int(ends[-1]), dtype=np.int32)
    for part, end in zip(parts, ends.tolist()):
        tokens[end - 1 - len(part):end - 1] = part
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), dtype=np.uint64, count=len(numbers))
    values, renumbered = np.unique(hashes, return_inverse=True)
    tokens = renumbered.astype(np.int32)[tokens]
    end_number = int(renumbered[0])
    learned = np.repeat(np.array(train, dtype=bool), lengths)
    counts = np.bincount(tokens[learned], minlength=len(values))
    for bucket, part in split_sorted(values, 64, buckets):
        yield "words", bucket, chunk, None, None, None, pack_counts(values[part], counts[part])
    before = np.concatenate([[end_number], tokens[:-1]])  # a text starts after an end
    pairs, at = np.unique(pair_hashes(values[before], values[tokens]), return_inverse=True)
    pair_counts = np.bincount(at[learned], minlength=len(pairs))  # 0 for pairs of other texts only
    for bucket, part in split_sorted(pairs, 48, buckets):
        yield "pairs", bucket, chunk, None, None, None, pack_counts(pairs[part], pair_counts[part])
    yield "texts", buckets, chunk, None, None, None, pickle.dumps((ids, held, lengths, end_number, pack_numbers(tokens)))


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24

        def rows() -> Iterator[tuple]:
            nonlocal chunk
            held, size = ([], [], [], []), 0
            for batch in slices(batches):
                for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               batch.column(2).to_pylist(), byte_texts(batch.column(3))):
                    for kept, value in zip(held, row):
                        kept.append(value)
                    size += len(row[3]) + 1
                    if size > CHUNK_BYTES:
                        yield from _count_chunk(chunk, *held, buckets)
                        chunk += 1
                        held, size = ([], [], [], []), 0
            if held[0]:
                yield from _count_chunk(chunk, *held, buckets)

        yield from arrow_batches(rows(), _ROW_ARROW)

    return run


def _sum_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    # whole numbers below 2**53 are exact in the sums
    return values, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


def _merge_bucket(kind: str, bucket: int, rows: list[tuple[int, bytes]], least: int) -> Iterator[tuple]:
    parts = [unpack_counts(data) for _, data in rows]
    values, counts = _sum_counts(parts)
    if kind == "pairs":
        found = filter_of(values, _level_of(counts), least).levels(values).astype(np.int8)
        for (chunk, _), (own, _) in zip(rows, parts):
            yield "levels", bucket, chunk, None, None, None, pack_numbers(found[np.searchsorted(values, own)])
        return
    yield "sums", bucket, 0, None, int((counts > 0).sum()), int(counts.sum()), None
    for (chunk, _), (own, _) in zip(rows, parts):
        yield "known", bucket, chunk, None, None, None, pack_counts(own, counts[np.searchsorted(values, own)])


def _merge(least: int):
    """Rows sorted by (bucket, kind): one bucket's counts are summed at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            at, held = None, []
            for batch in batches:
                for kind, bucket, chunk, data in zip(*(batch.column(c).to_pylist()
                                                       for c in ("kind", "bucket", "chunk", "data"))):
                    if (bucket, kind) != at and held:
                        yield from _merge_bucket(at[1], at[0], held, least)
                        held = []
                    at = (bucket, kind)
                    held.append((chunk, data))
            if held:
                yield from _merge_bucket(at[1], at[0], held, least)

        yield from arrow_batches(rows(), _ROW_ARROW)

    return run


def _places(pairs: np.ndarray, level: int, bits: int, probe: int) -> np.ndarray:
    """Bit of a (bigram, level) entry for one probe, inside its bucket's part of the filter."""
    first = mix(pairs + np.uint64(level * _LEVEL & MASK64))
    second = mix(first ^ _PAIR) | np.uint64(1)
    return ((first + np.uint64(probe) * second) % np.uint64(bits)).astype(np.int64)


def _fill(bits: int, least: int):
    """A bucket's part of the filter from its bigrams by level; level q sets the entries least..q."""
    schema = pa.schema([("bucket", pa.int64()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            bucket, flags = None, np.zeros(bits, dtype=bool)
            for batch in batches:
                for b, level, data in zip(*(c.to_pylist() for c in batch.columns)):
                    if b != bucket and bucket is not None:
                        yield bucket, np.packbits(flags).tobytes()
                        flags[:] = False
                    bucket = b
                    pairs, _ = unpack_counts(data)
                    for j in range(least, level + 1):
                        for probe in range(PROBES):
                            flags[_places(pairs, j, bits, probe)] = True
            if bucket is not None:
                yield bucket, np.packbits(flags).tobytes()

        yield from arrow_batches(rows(), schema)

    return run


class CountFilter:
    """Quantised bigram counts: level after level is looked up until one is missing."""

    def __init__(self, data: bytes, buckets: int, bits: int, least: int, top: int):
        self.data, self.buckets, self.bits, self.least, self.top = data, buckets, bits, least, top

    def levels(self, pairs: np.ndarray) -> np.ndarray:
        found = np.zeros(len(pairs), dtype=np.int64)
        if not self.bits:
            return found
        flags = np.frombuffer(self.data, dtype=np.uint8)
        base = bucket_of(pairs, 48, self.buckets) * self.bits
        alive = np.arange(len(pairs))
        for level in range(self.least, self.top + 1):
            for probe in range(PROBES):
                if not len(alive):
                    return found
                at = base[alive] + _places(pairs[alive], level, self.bits, probe)
                alive = alive[(flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
            found[alive] = level
        return found


def filter_of(pairs: np.ndarray, levels: np.ndarray, least: int) -> CountFilter:
    """Filter of one bucket's bigrams from level ``least`` on; it grows with its entries."""
    entries = int(np.maximum(levels - least + 1, 0).sum())
    bits, top = -(-entries * BITS_PER_ENTRY // 64) * 64, int(levels.max(initial=0))
    flags = np.zeros(bits, dtype=bool)
    for level in range(least, top + 1):
        chosen = pairs[levels >= level]
        for probe in range(PROBES):
            flags[_places(chosen, level, bits, probe)] = True
    return CountFilter(np.packbits(flags).tobytes(), 1, bits, least, top)


def build_filter(grams: DataFrame, buckets: int, min_count: int, max_bytes: int) -> CountFilter:
    """One filter of the bigrams counted at least ``min_count`` times, for use on the driver.

    ``score_texts`` keeps its filter split by bucket instead. More than ``max_bytes`` is an error: nothing is left out.
    """
    sizes = {r.level: r.n for r in grams.groupBy("level").agg(F.sum("n").alias("n")).collect()}
    least, top = int(_level_of(np.array([min_count]))[0]), max(sizes, default=0)
    entries = sum(n * (level - least + 1) for level, n in sizes.items() if level >= least)
    bits = -(-entries * BITS_PER_ENTRY // buckets // 64) * 64
    if buckets * bits > max_bytes * 8 + buckets * 64:
        raise ValueError(f"the bigrams need a filter of more than {max_bytes} bytes")
    if not entries:
        return CountFilter(b"", buckets, 0, least, top)
    parts = grams.filter(F.col("level") >= least).select("bucket", "level", "data").repartition(
        "bucket").sortWithinPartitions("bucket").mapInArrow(_fill(bits, least), "bucket long, bits binary")
    data = bytearray(buckets * bits // 8)
    for row in parts.toLocalIterator():
        data[row.bucket * bits // 8:(row.bucket + 1) * bits // 8] = row.bits
    return CountFilter(bytes(data), buckets, bits, least, top)


def _score_texts(data: bytes, hashes: np.ndarray, counts: np.ndarray, levels: np.ndarray, total: int, kinds: int,
                 weight: float) -> Iterator[tuple]:
    ids, held, lengths, end_number, packed = pickle.loads(data)
    tokens = unpack_numbers(packed, "<i4")
    single = (counts + 1) / (total + kinds + 1)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    known = np.add.reduceat((counts > 0).astype(np.int64)[tokens], starts)
    base = np.add.reduceat(np.log10(single)[tokens], starts)
    met = np.concatenate([[end_number], tokens[:-1]])
    # the levels stand in order of the chunk's distinct pairs, as _count_chunk sent them
    levels = levels[np.unique(pair_hashes(hashes[met], hashes[tokens]), return_inverse=True)[1]]
    score = np.empty(len(tokens))
    for a in range(0, len(tokens), 1 << 20):
        word = tokens[a:a + (1 << 20)]
        before = met[a:a + len(word)]
        seen = level_count(levels[a:a + len(word)].astype(np.int64))
        context = counts[before]
        seen = np.minimum(seen, np.minimum(context, counts[word]))
        mixed = (1 - weight) * single[word] + weight * seen / np.maximum(context, 1)
        score[a:a + len(word)] = np.log10(np.where(context > 0, mixed, single[word]))
    score = np.add.reduceat(score, starts)
    for row in zip(ids, held, lengths.tolist(), known.tolist(), base.tolist(), score.tolist()):
        yield (*row[:4], total, *row[4:])


def _score(total: int, kinds: int, weight: float, schema: pa.Schema):
    """Rows sorted by (chunk, bucket): known counts of a chunk's words and levels of its pairs in order of hash,
    then its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held, levels = [], []
            for batch in batches:
                for kind, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    data = data.as_py()
                    if kind == "known":
                        held.append(unpack_counts(data))
                    elif kind == "levels":
                        levels.append(unpack_numbers(data, "<i1"))
                    else:
                        hashes = np.concatenate([h for h, _ in held])
                        counts = np.concatenate([c for _, c in held])
                        met = np.concatenate(levels)
                        held, levels = [], []
                        yield from _score_texts(data, hashes, counts, met, total, kinds, weight)

        yield from arrow_batches(rows(), schema)

    return run


def score_texts(docs: DataFrame, trains: Column, held_out: Column, id_column: str = "doc_id",
                text_column: str = "text", min_count: int = 1, weight: float = 0.2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Tokens are the words (A-Z in lower case) and one end. ``base_score`` sums log10((c + 1) / (N + V + 1)) with
    exact counts of the training texts. ``score`` mixes that share with the bigram's: (1 - weight) * unigram +
    weight * c(pair) / c(word before); a text starts after an end, and after a word that training never met
    only the unigram counts. c(pair) comes from a log-frequency Bloom filter of the pairs met ``min_count``
    times or more, as the middle of its quantised level, at most the count of either word.

    NULL texts are empty: one end. A NULL id neither trains nor is held out unless the given columns say so.
    Repeated rows are scored each. Without training texts N and V are 0. Empty tables give empty tables.

    Tasks count chunks of about 16 MB; a chunk sends each distinct word and pair once to the bucket of its
    hash, which sums counts over all chunks and sends back those of the chunk's words. Hot words thus cost one
    entry per chunk. The filter stays split by bucket and grows with its entries: a bucket fills its part, looks
    the chunks' pairs up in it and sends their levels back. Two sums are all that is gathered.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_column].dataType.simpleString()
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(trains, F.lit(False)).alias("trains"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_column).alias("text"))
    least = int(_level_of(np.array([min_count]))[0])
    counted = stored(ready.mapInArrow(_count(buckets), _ROW), "lm-chunks", "kind")
    merged = stored(counted.filter("kind in ('words', 'pairs')").select("kind", "bucket", "chunk", "data")
                    .repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_merge(least), _ROW),
                    "lm-counts", "kind")
    sums = merged.filter("kind = 'sums'").agg(F.sum("n").alias("kinds"), F.sum("total").alias("total")).first()
    schema = pa.schema([("doc_id", arrow_type(docs, id_column)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64())])
    met = merged.filter("kind in ('known', 'levels')").select("kind", "chunk", "bucket", "data").unionByName(
        counted.filter("kind = 'texts'").select("kind", "chunk", "bucket", "data"))
    return met.repartition("chunk").sortWithinPartitions("chunk", "bucket").select("kind", "data").mapInArrow(
        _score(sums.total or 0, sums.kinds or 0, weight, schema),
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double")
