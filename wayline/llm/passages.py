"""Substring dedup: windows travel as super-k-mers to the bucket of their minimiser and are counted there."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import (arrow_batches, arrow_type, byte_texts, chunked, inside_texts, pack, row_key, slices, unpack,
                                window_hashes, word_bounds, word_hashes)

#: Words whose hash may become a window's minimiser.
SEED_WORDS = 4
#: Bytes of text after which a task sends its super-k-mers on.
FLUSH_BYTES = 12 << 20
BUCKETS_PER_PARTITION = 4

_SPACES = bytes(32 if 9 <= b <= 13 else b for b in range(256))
_HIGH = np.uint64(1 << 63)
_HIT_SCHEMA = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("last", pa.int64())])


def plain_words(text: bytes) -> bytes:
    """The words joined by one space."""
    text = text.translate(_SPACES)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text.strip(b" ")


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n neighbours, by doubling."""
    size, width = values, 1
    while width * 2 <= n:
        size = np.minimum(size[:-width], size[width:])
        width *= 2
    rest = n - width
    return np.minimum(size[:len(size) - rest], size[rest:]) if rest else size


def super_kmers(texts: Sequence[bytes], n: int, heavy: np.ndarray) -> tuple:
    """Runs of windows that share a minimiser: (buffer, starts, ends, text number, word offset of the text,
    first window, last window, minimiser). ``heavy`` seeds come last in the order of seeds."""
    buffer, starts, ends, counts = word_bounds(texts)
    empty = np.zeros(0, dtype=np.int64)
    if len(starts) < n:
        return buffer, starts, ends, empty, empty, empty, empty, empty.astype(np.uint64)
    seeds = window_hashes(word_hashes(buffer, starts, ends), min(SEED_WORDS, n)) >> np.uint64(1)
    if len(heavy):
        at = np.searchsorted(heavy, seeds)
        at[at == len(heavy)] = 0
        seeds = np.where(heavy[at] == seeds, seeds | _HIGH, seeds)
    least = sliding_min(seeds, n - min(SEED_WORDS, n) + 1)
    windows = np.flatnonzero(inside_texts(counts, n, len(starts))[:len(least)])
    if not len(windows):
        return buffer, starts, ends, empty, empty, empty, empty, empty.astype(np.uint64)
    mins = least[windows]
    cut = np.flatnonzero((np.diff(windows) != 1) | (mins[1:] != mins[:-1])) + 1
    # a window never spans two texts, so a new text always breaks the run of neighbours (if n > 1)
    first = windows[np.concatenate([[0], cut])]
    last = windows[np.concatenate([cut - 1, [len(windows) - 1]])]
    offsets = np.concatenate([[0], np.cumsum(counts)])
    text = np.searchsorted(offsets, first, side="right") - 1
    return buffer, starts, ends, text, offsets[text], first, last, mins[np.concatenate([[0], cut])]


def _count_seeds(n: int, buckets: int):
    """Minimisers that hold a notable share of a task's super-k-mers; at most 8 * buckets of a batch of texts."""
    schema = pa.schema([("seed", pa.int64()), ("n", pa.int64()), ("all", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            mins = []
            for part in slices([batch]):
                texts = [plain_words(t) for t in byte_texts(part.column(0))]
                mins += [super_kmers(texts[a:b], n, none)[-1] for a, b in chunked(texts)]
            if mins:
                joined = np.concatenate(mins)
                seeds, counts = np.unique(joined, return_counts=True)
                notable = counts * (8 * buckets) >= max(len(joined), 1)
                notable &= counts > 4
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([seeds[notable].astype(np.int64), [-1]])),
                    pa.array(np.concatenate([counts[notable], [0]])),
                    pa.array(np.concatenate([np.zeros(int(notable.sum()), dtype=np.int64), [len(joined)]]))],
                    schema=schema)

    return run


def heavy_seeds(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """Minimisers that would hold more than a quarter of a bucket: at most 4 * buckets values.

    They are moved to the end of the order of seeds, so their windows spread over other minimisers.
    This only changes where windows meet, never which windows are equal.
    """
    found = texts.mapInArrow(_count_seeds(n, buckets), "seed long, n long, all long")
    sums = found.groupBy("seed").agg(F.sum("n").alias("n"), F.sum("all").alias("all"))
    rows = sums.orderBy(F.col("seed") != -1, F.desc("n")).limit(4 * buckets + 1).collect()
    total = rows[0]["all"] if rows else 0
    return np.sort(np.array([r["seed"] for r in rows[1:] if r["n"] * 4 * buckets > total], dtype=np.uint64))


def _send(n: int, buckets: int, heavy: Broadcast):
    """Super-k-mers of a task, packed by bucket. Equal ones travel once: if a task has met one twice, all its
    windows repeat, so it needs no return address and its places are reported at once."""
    schema = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, tuple] = {}
        again: dict[bytes, set] = {}
        size = 0

        def flush() -> Iterator[tuple]:
            by_bucket: dict[int, list] = {}
            for text, (bucket, key, at, windows) in met.items():
                by_bucket.setdefault(bucket, []).append((text, key, at, windows, text in again))
            for bucket, rows in by_bucket.items():
                places = {(key, at, windows) for text, *_ in rows for key, at, windows in again.get(text, ())}
                yield bucket, pack(_to_bytes(rows, places), 5)

        def made() -> Iterator[tuple]:
            nonlocal size, met, again
            for batch in slices(batches):
                keys = batch.column(0).to_pylist()
                texts = [plain_words(t) for t in byte_texts(batch.column(1))]
                for a, b in chunked(texts):
                    buffer, starts, ends, text, offset, first, last, mins = super_kmers(texts[a:b], n, heavy.value)
                    data = buffer.tobytes()
                    buckets_of = (mins * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(buckets)
                    for bucket, t, at, begin, end, windows in zip(
                            buckets_of.tolist(), text.tolist(), (first - offset).tolist(), starts[first].tolist(),
                            ends[last + n - 1].tolist(), (last - first + 1).tolist()):
                        piece = data[begin:end]
                        have = met.get(piece)
                        if have is None:
                            met[piece] = (bucket, keys[a + t], at, windows)
                        else:
                            again.setdefault(piece, {have[1:]}).add((keys[a + t], at, windows))
                    size += len(data)
                    if size > FLUSH_BYTES:
                        yield from flush()
                        met, again, size = {}, {}, 0
            yield from flush()

        yield from arrow_batches(made(), schema)

    return run


def _to_bytes(rows: list[tuple], places: set[tuple]) -> bytes:
    """Packed super-k-mers (text, address, windows, already repeated) and places already known to repeat."""
    known = [(key, at, windows) for key, at, windows in places]
    head = np.array([len(rows), len(known)], dtype="<i8")
    lengths = np.array([len(r[0]) for r in rows], dtype="<u4")
    spots = np.array([r[2] for r in rows] + [p[1] for p in known], dtype="<i8")
    windows = np.array([r[3] for r in rows] + [p[2] for p in known], dtype="<u4")
    many = np.array([r[4] for r in rows], dtype=np.uint8)
    return b"".join([head.tobytes(), lengths.tobytes(), spots.tobytes(), windows.tobytes(), many.tobytes(),
                     *[r[1] for r in rows], *[p[0] for p in known], *[r[0] for r in rows]])


def _from_bytes(data: bytes) -> tuple[list[tuple], list[tuple]]:
    n_rows, n_known = np.frombuffer(data, "<i8", 2).tolist()
    at = 16
    lengths = np.frombuffer(data, "<u4", n_rows, at)
    at += 4 * n_rows
    spots = np.frombuffer(data, "<i8", n_rows + n_known, at).tolist()
    at += 8 * (n_rows + n_known)
    windows = np.frombuffer(data, "<u4", n_rows + n_known, at).tolist()
    at += 4 * (n_rows + n_known)
    many = np.frombuffer(data, np.uint8, n_rows, at).tolist()
    at += n_rows
    keys = [data[at + 16 * i:at + 16 * i + 16] for i in range(n_rows + n_known)]
    at += 16 * (n_rows + n_known)
    ends = (at + np.cumsum(lengths, dtype=np.int64)).tolist()
    begins = [at, *ends[:-1]]
    rows = [(data[b:e], k, s, w, bool(m)) for b, e, k, s, w, m in zip(begins, ends, keys, spots, windows, many)]
    return rows, list(zip(keys[n_rows:], spots[n_rows:], windows[n_rows:]))


def repeated_windows(texts: Sequence[bytes], many: Sequence[bool], n: int) -> list[tuple[int, int, int]]:
    """Runs (text, first window, last window) of windows whose words occur in another place of the bucket.

    Sorting the window hashes brings equal windows together; runs of neighbours are then compared byte by
    byte, so the counts are exact. A text marked ``many`` stands for two or more places.
    """
    buffer, starts, ends, counts = word_bounds(texts)
    size = len(starts) - n + 1
    if size <= 0:
        return []
    hashes = window_hashes(word_hashes(buffer, starts, ends), n)
    places = np.flatnonzero(inside_texts(counts, n, len(starts))[:size])
    text = np.repeat(np.arange(len(counts)), np.maximum(counts - n + 1, 0))
    values = hashes[places]
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    group = np.cumsum(head) - 1
    leader = np.empty(len(places), dtype=np.int64)
    leader[order] = order[np.flatnonzero(head)[group]]
    weight = np.where(np.asarray(many, dtype=bool)[text], 2, 1)
    total = np.bincount(group, weights=weight[order])
    repeated = np.empty(len(places), dtype=bool)
    repeated[order] = total[group] >= 2
    # compare every repeated window with the first of its kind, neighbours at a time
    check = np.flatnonzero(repeated & (leader != np.arange(len(places))))
    wrong: set[int] = set()
    if len(check):
        lead = leader[check]
        cut = np.flatnonzero((np.diff(check) != 1) | (np.diff(lead) != 1) | (np.diff(text[check]) != 0)
                             | (np.diff(text[lead]) != 0)) + 1
        firsts, lasts = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(check) - 1]])
        data = buffer.tobytes()
        a0, a1 = starts[places[check[firsts]]].tolist(), ends[places[check[lasts]] + n - 1].tolist()
        b0, b1 = starts[places[lead[firsts]]].tolist(), ends[places[lead[lasts]] + n - 1].tolist()
        for i, (p, q, r, s) in enumerate(zip(a0, a1, b0, b1)):
            if data[p:q] != data[r:s]:
                wrong.update(values[check[firsts[i]:lasts[i] + 1]].tolist())
        if wrong:  # two different windows share a hash: count these by their words
            exact: dict[bytes, int] = {}
            odd = np.flatnonzero(np.isin(values, np.array(list(wrong), dtype=np.uint64))).tolist()
            words = {i: data[starts[places[i]]:ends[places[i] + n - 1]] for i in odd}
            for i in odd:
                exact[words[i]] = exact.get(words[i], 0) + int(weight[i])
            for i in odd:
                repeated[i] = exact[words[i]] >= 2
    found = np.flatnonzero(repeated)
    if not len(found):
        return []
    cut = np.flatnonzero((np.diff(found) != 1) | (np.diff(text[found]) != 0)) + 1
    base = np.concatenate([[0], np.cumsum(np.maximum(counts - n + 1, 0))])
    firsts, lasts = found[np.concatenate([[0], cut])], found[np.concatenate([cut - 1, [len(found) - 1]])]
    return list(zip(text[firsts].tolist(), (firsts - base[text[firsts]]).tolist(),
                    (lasts - base[text[firsts]]).tolist()))


def _count_bucket(rows: list[bytes], n: int) -> Iterator[tuple]:
    addresses: dict[bytes, list[tuple]] = {}
    many: dict[bytes, bool] = {}
    for data in rows:
        pieces, known = _from_bytes(unpack(data))
        for key, at, windows in known:
            yield key, at, at + windows - 1
        for text, key, at, windows, repeated in pieces:
            if text in many:
                many[text] = True
            else:
                many[text] = repeated
            addresses.setdefault(text, [])
            if not repeated:
                addresses[text].append((key, at, windows))
    texts = list(many)
    for text in texts:
        if many[text]:
            for key, at, windows in addresses[text]:
                yield key, at, at + windows - 1
    for i, first, last in repeated_windows(texts, [many[t] for t in texts], n):
        if not many[texts[i]]:
            for key, at, _ in addresses[texts[i]]:
                yield key, at + first, at + last


def _count(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hits() -> Iterator[tuple]:
            bucket, held = None, []
            for batch in batches:
                for b, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    data = data.as_py()
                    if b != bucket and held:
                        yield from _count_bucket(held, n)
                        held = []
                    bucket = b
                    held.append(data)
            if held:
                yield from _count_bucket(held, n)

        yield from arrow_batches(hits(), _HIT_SCHEMA)

    return run


def repeated_spans(keyed: DataFrame, n: int = 35) -> DataFrame:
    """Runs of repeated windows of a table (key, text): key, first, last (numbers of a window's first word).

    Every window of every text goes, inside a super-k-mer, to the bucket of its minimiser; equal windows have
    equal minimisers, so they meet. A bucket is sorted and streamed to a worker on its own; minimisers that
    would fill a bucket are put last in the order beforehand.
    """
    spark = keyed.sparkSession
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = spark.sparkContext.broadcast(heavy_seeds(keyed.select("text"), n, buckets))
    sent = keyed.select("key", "text").mapInArrow(_send(n, buckets, heavy), "bucket long, data binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _count(n), "key binary, first long, last long")


def _cut(n: int, id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in slices(batches):
            spans = batch.column(2).to_pylist()
            for doc, text, found in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), spans):
                words = text.split()
                if not found:
                    yield doc, len(words), 0, b" ".join(words)
                    continue
                step = np.zeros(len(words) + 1, dtype=np.int64)
                for span in found:
                    step[span["first"]] += 1
                    step[span["last"] + n] -= 1
                keep = np.cumsum(step[:-1]) == 0
                kept = [words[i] for i in np.flatnonzero(keep).tolist()]
                yield doc, len(words), len(words) - len(kept), b" ".join(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from arrow_batches(rows(batches), schema)

    return run


def drop_repeated_passages(docs: DataFrame, n: int = 35, id_column: str = "doc_id",
                           text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of every row.

    Words are runs of anything but spaces, tabs and line ends. A word goes if a window of ``n`` words of its
    text covers it whose words also start anywhere else, in the same row or another; windows are judged on the
    input. All copies of a passage go. kept_text joins the kept words by one space.

    A NULL text has no words, nor windows; shorter texts than ``n`` words stay whole. Repeated rows are rows of
    their own, so their windows repeat. Rows with equal id and text get equal results, which is why spans are
    kept by a hash of both. NULL ids are allowed; other columns are not read; empty tables give empty tables.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    keyed = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
                        row_key(F.col(id_column), F.col(text_column)).alias("key"))
    spans = repeated_spans(keyed, n).groupBy("key").agg(
        F.collect_set(F.struct("first", "last")).alias("spans"))
    return keyed.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut(n, arrow_type(docs, id_column)), f"doc_id {id_type}, n_words long, n_removed long, kept_text string")
