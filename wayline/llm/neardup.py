"""Near-duplicates: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import (MASK64, arrow_batches, byte_texts, chunked, inside_texts, join_counted, mix, pack,
                                row_key, slices, stored, unpack, window_hashes, word_bounds, word_hashes)
from wayline.llm.components import components
from wayline.llm.scoring import pack_numbers, unpack_numbers

SHINGLE = 5
#: Cells of each of two rows of document counts; a power of two.
CELLS = 1 << 21
SEGMENT = 1 << 16
DRAWS = 1 << 16
CANDIDATE_BITS = 1 << 25
#: Texts of one block; a cell compares two blocks of a bucket.
BLOCK = 512
_COLUMNS = 2048
_STEP = 0x9E3779B97F4A7C15


@dataclass
class Weights:
    """Shared by all tasks and of fixed size: weight levels by cell, and the tables samples are drawn from."""

    levels: np.ndarray  # two rows of CELLS levels
    values: np.ndarray  # weight of each level
    gamma: np.ndarray  # Gamma(2, 1) draws
    log_gamma: np.ndarray  # logarithms of other Gamma(2, 1) draws


def word_node(text: bytes) -> int:
    """63 bits that stand for a text's words."""
    digest = hashlib.blake2b(b" ".join(text.split()), digest_size=8).digest()
    return int.from_bytes(digest, "little") >> 1


def shingle_counts(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, 48-bit shingle hash, occurrences), by text and hash. A text of fewer than five words is one
    shingle as a whole; one without words has none."""
    buffer, starts, ends, counts = word_bounds(texts)
    words = word_hashes(buffer, starts, ends)
    size = max(len(starts) - SHINGLE + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    inside = inside_texts(counts, SHINGLE, len(starts))[:size]
    keys = [(text[:size][inside].astype(np.uint64) << np.uint64(48)) | (window_hashes(words, SHINGLE)[inside]
                                                                        >> np.uint64(16))]
    offsets = np.concatenate([[0], np.cumsum(counts)])
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist():
        whole = window_hashes(words[offsets[i]:offsets[i + 1]], int(counts[i])) ^ np.uint64(counts[i])
        keys.append((np.uint64(i) << np.uint64(48)) | (mix(whole) >> np.uint64(16)))
    joined = np.sort(np.concatenate(keys))
    head = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]])) if len(joined) else np.zeros(0, int)
    return ((joined[head] >> np.uint64(48)).astype(np.int64), joined[head] & np.uint64((1 << 48) - 1),
            np.diff(np.append(head, len(joined))))


def parts(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded bytes and number."""
    for a, b in chunked(texts):
        for i in range(a, b, 50_000):
            yield i, min(b, i + 50_000)


def cells_of(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ((shingles & np.uint64(CELLS - 1)).astype(np.int64),
            (mix(shingles) & np.uint64(CELLS - 1)).astype(np.int64))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns key, doc_id, row, text: one row per document, and the task's document counts by cell."""
    schema = None
    counts = np.zeros((2, CELLS), dtype=np.uint32)
    for batch in slices(batches):
        schema = schema or pa.schema([
            ("kind", pa.string()), ("key", pa.binary()), ("doc_id", batch.schema.field(1).type), ("row", pa.int64()),
            ("node", pa.int64()), ("n_words", pa.int64()), ("segment", pa.int64()), ("data", pa.binary())])
        texts = byte_texts(batch.column(3))
        sizes = []
        for a, b in parts(texts):
            _, shingles, _ = shingle_counts(texts[a:b])
            for row, cells in enumerate(cells_of(shingles)):
                counts[row] += np.bincount(cells, minlength=CELLS).astype(np.uint32)
        sizes = [len(t.split()) for t in texts]
        nodes = [word_node(t) if n else None for t, n in zip(texts, sizes)]
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([
            pa.array(["doc"] * n), batch.column(0), batch.column(1), batch.column(2), pa.array(nodes, pa.int64()),
            pa.array(sizes, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], schema=schema)
    if schema is None:
        return
    flat = counts.ravel()
    for segment in range(len(flat) // SEGMENT):
        part = flat[segment * SEGMENT:(segment + 1) * SEGMENT]
        if part.any():
            yield pa.RecordBatch.from_arrays([
                pa.array(["cells"]), pa.nulls(1, pa.binary()), pa.nulls(1, schema.field(2).type),
                pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                pa.array([segment], pa.int64()), pa.array([pack_numbers(part.astype("<u4"))], pa.binary())],
                schema=schema)


def _sum_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("segment", pa.int64()), ("data", pa.binary())])
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, data in zip(*(c.to_pylist() for c in batch.columns)):
            part = unpack_numbers(data, "<u4").astype(np.int64)
            sums[segment] = sums[segment] + part if segment in sums else part
    yield from arrow_batches(((s, pack_numbers(p.astype("<i8"))) for s, p in sums.items()), schema)


def idf_weights(cells: DataFrame, documents: int, damping: float) -> Weights:
    """Inverse document frequencies by cell: 1 + damping * ln(N / df) / ln(N), in 64 levels.

    A shingle's document frequency is the smaller of its two cells' counts, less what other shingles add on
    average. The counts cover all documents; their space is fixed. More documents than cells can tell
    apart only bring the weights of rare shingles together; they stay the same for equal shingles.
    """
    flat = np.zeros(2 * CELLS, dtype=np.int64)
    for row in cells.repartition("segment").mapInArrow(_sum_cells, "segment long, data binary").toLocalIterator():
        flat[row.segment * SEGMENT:(row.segment + 1) * SEGMENT] = unpack_numbers(bytes(row.data), "<i8")
    usual = flat.sum() / (2 * CELLS)
    frequency = np.clip(flat - usual, 1, max(documents, 1)).reshape(2, CELLS)
    share = np.log(max(documents, 2) / frequency) / np.log(max(documents, 2))
    levels = np.clip(np.rint(share * 63), 0, 63).astype(np.uint8)
    draws = mix(np.arange(4 * DRAWS, dtype=np.uint64) * np.uint64(_STEP))
    logs = np.log((draws >> np.uint64(11)).astype(np.float64) / 2.0**53 + 2.0**-54).reshape(4, DRAWS)
    return Weights(levels, (1 + damping * np.arange(64) / 63).astype(np.float64),
                   (-logs[0] - logs[1]).astype(np.float32), np.log(-logs[2] - logs[3]).astype(np.float32))


def shingle_weights(shingles: np.ndarray, counts: np.ndarray, weights: Weights) -> np.ndarray:
    first, second = cells_of(shingles)
    return counts * weights.values[np.maximum(weights.levels[0][first], weights.levels[1][second])]


def consistent_samples(text: np.ndarray, shingles: np.ndarray, weight: np.ndarray, n: int,
                       weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Improved consistent weighted samples: (text numbers that have shingles, n samples for each).

    For every sample j and shingle, r and c are Gamma(2, 1) and b is uniform, all drawn from a hash of both;
    t = floor(ln w / r + b), and the shingle with the least ln c - r (t - b) - r is taken together with t.
    Two texts agree in a sample with a probability equal to their weighted Jaccard similarity.
    """
    starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    lengths = np.diff(np.append(starts, len(text)))
    log_weight = np.log(weight).astype(np.float32)
    low = np.uint64(DRAWS - 1)
    out = np.empty((len(starts), n), dtype=np.uint64)
    for j in range(n):
        h = shingles * np.uint64((2 * j + 1) * _STEP & MASK64)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        r = weights.gamma[(h & low).astype(np.int64)]
        c = weights.log_gamma[((h >> np.uint64(16)) & low).astype(np.int64)]
        b = ((h >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)
        t = np.floor(log_weight / r + b)
        key = c - r * (t - b) - r
        least = np.repeat(np.minimum.reduceat(key, starts), lengths)
        hit = np.flatnonzero(key == least)
        taken = hit[np.searchsorted(hit, starts)]
        out[:, j] = mix(shingles[taken] + t[taken].astype(np.int64).astype(np.uint64) * np.uint64(_STEP))
    return text[starts], out


def _sign(weights: Broadcast, bands: int, rows: int):
    """Columns node, text: node, its samples and the hashes of its bands; a node once per task."""
    schema = pa.schema([("node", pa.int64()), ("samples", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            shared = Weights(**weights.value)
            for batch in slices(batches):
                seen: set[int] = set()
                nodes, texts = [], []
                for text in byte_texts(batch.column(0)):
                    if text.split(None, 1):
                        node = word_node(text)
                        if node not in seen:
                            seen.add(node)
                            nodes.append(node)
                            texts.append(text)
                for a, b in parts(texts):
                    text, shingles, counts = shingle_counts(texts[a:b])
                    if not len(text):
                        continue
                    weight = shingle_weights(shingles, counts, shared)
                    found, samples = consistent_samples(text, shingles, weight, bands * rows, shared)
                    hashes = np.zeros((len(found), bands), dtype=np.uint64)
                    for band in range(bands):
                        total = np.full(len(found), np.uint64(band + 1))
                        for j in range(band * rows, band * rows + rows):
                            total = mix(total * np.uint64(_STEP) + samples[:, j])
                        hashes[:, band] = total
                    for i, t in enumerate(found.tolist()):
                        yield nodes[a + t], samples[i].astype("<u8").tobytes(), hashes[i].astype(np.int64)

        yield from arrow_batches(made(), schema)

    return run


def _payloads(wanted: Broadcast):
    """Columns draw (hash of the id), text: texts of documents that may be candidates."""
    schema = pa.schema([("node", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, dtype=np.uint8)

        def made() -> Iterator[tuple]:
            for batch in slices(batches):
                at = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64) & (CANDIDATE_BITS - 1)
                maybe = np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                for text in byte_texts(batch.column(1).take(pa.array(maybe))):
                    if text.split(None, 1):
                        yield word_node(text), pack(text)

        yield from arrow_batches(made(), schema)

    return run


def _verify(weights: Broadcast, threshold: float):
    """Columns a, b, data_a, data_b: the pairs whose weighted Jaccard similarity reaches the threshold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            shared = Weights(**weights.value)
            for whole in batches:
                for begin in range(0, whole.num_rows, 500):
                    batch = whole.slice(begin, 500)
                    first, second = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                    packed = dict(zip(first, batch.column(2).to_pylist()))
                    packed.update(zip(second, batch.column(3).to_pylist()))
                    nodes = list(packed)
                    texts = [unpack(packed[n]) for n in nodes]
                    known = {}
                    for a, b in parts(texts):
                        text, shingles, counts = shingle_counts(texts[a:b])
                        weight = shingle_weights(shingles, counts, shared)
                        cuts = np.searchsorted(text, np.arange(b - a + 1))
                        for i in range(b - a):
                            known[nodes[a + i]] = shingles[cuts[i]:cuts[i + 1]], weight[cuts[i]:cuts[i + 1]]
                    for x, y in zip(first, second):
                        (s, v), (t, w) = known[x], known[y]
                        _, at_s, at_t = np.intersect1d(s, t, assume_unique=True, return_indices=True)
                        both = np.minimum(v[at_s], w[at_t]).sum()
                        similarity = float(both / (v.sum() + w.sum() - both))
                        if similarity >= threshold:
                            yield x, y, similarity

        yield from arrow_batches(made(), schema)

    return run


def cell_links(texts: Sequence[bytes], labels: Sequence[int], left: np.ndarray, right: np.ndarray, weights: Weights,
               threshold: float) -> Iterator[tuple[int, int]]:
    """Pairs (one of ``left``, one of ``right``) of different labels at or above the threshold, without those whose
    labels earlier pairs have joined already: fewer pairs than texts come out.

    The shared weight of all pairs is a product of matrices over the shingles that two texts have; repeated
    shingles count as first, second and so on. Pairs too near the threshold for its precision are counted anew.
    """
    owner, keys, values, own = [], [], [], []
    for a, b in parts(texts):
        text, shingles, counts = shingle_counts(texts[a:b])
        single = shingle_weights(shingles, np.ones(len(counts)), weights)
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        owner.append(np.repeat(text, counts) + a)
        keys.append(mix(np.repeat(shingles, counts) + nth.astype(np.uint64) * np.uint64(_STEP)))
        values.append(np.repeat(single, counts))
    owner, keys, values = np.concatenate(owner), np.concatenate(keys), np.concatenate(values)
    total = np.bincount(owner, values, minlength=len(texts))
    _, column, times = np.unique(keys, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    renumber = np.cumsum(times > 1) - 1
    row, column, root = owner[shared], renumber[column[shared]], np.sqrt(values[shared]).astype(np.float32)
    order = np.argsort(column, kind="stable")
    row, column, root = row[order], column[order], root[order]
    common_weight = np.zeros((len(left), len(right)), dtype=np.float32)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + _COLUMNS + 1, _COLUMNS))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if a < b:
            block = np.zeros((len(texts), _COLUMNS), dtype=np.float32)
            block[row[a:b], column[a:b] % _COLUMNS] = root[a:b]
            common_weight += block[left] @ block[right].T
    similar = common_weight / (total[left][:, None] + total[right][None, :] - common_weight)
    labels = np.asarray(labels)
    near = (similar >= threshold - 1e-3) & (labels[left][:, None] != labels[right][None, :])
    joined: dict[int, int] = {}

    def find(label: int) -> int:
        while label in joined:
            label = joined[label]
        return label

    exact = [None] * len(texts)
    by_text = np.argsort(owner, kind="stable")
    bounds = np.searchsorted(owner[by_text], np.arange(len(texts) + 1))

    def entries(i: int) -> tuple[np.ndarray, np.ndarray]:
        if exact[i] is None:
            at = by_text[bounds[i]:bounds[i + 1]]
            at = at[np.argsort(keys[at])]
            exact[i] = keys[at], values[at]
        return exact[i]

    for i, j in zip(*np.nonzero(near)):
        x, y = int(left[i]), int(right[j])
        one, other = find(int(labels[x])), find(int(labels[y]))
        if one == other:
            continue
        if similar[i, j] < threshold + 1e-3:
            (s, v), (t, _) = entries(x), entries(y)
            _, at, _ = np.intersect1d(s, t, assume_unique=True, return_indices=True)
            both = v[at].sum()
            if both / (total[x] + total[y] - both) < threshold:
                continue
        joined[max(one, other)] = min(one, other)
        yield x, y


def _cells(weights: Broadcast, threshold: float):
    """Rows sorted by cell (band, i, j): links across components between blocks i and j of a bucket."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(rows: list[tuple], shared: Weights) -> Iterator[tuple]:
        i, j = rows[0][1:3]
        block = np.array([r[3] for r in rows])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        labels = [r[5] for r in rows]
        if len(left) and len(right) and len(set(labels)) > 1:
            for x, y in cell_links([unpack(r[6]) for r in rows], labels, left, right, shared, threshold):
                yield min(rows[x][4], rows[y][4]), max(rows[x][4], rows[y][4])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            shared = Weights(**weights.value)
            cell, held = None, []
            for batch in slices(batches):
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if row[:3] != cell and held:
                        yield from links(held, shared)
                        held = []
                    cell = row[:3]
                    held.append(row)
            if held:
                yield from links(held, shared)

        yield from arrow_batches(made(), schema)

    return run


def near_duplicate_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                           threshold: float = 0.8, bands: int = 12, rows: int = 3,
                           damping: float = 0.25) -> DataFrame:
    """One row per input row: key (hash of id and text), doc_id, class_id, class_size, kept.

    Two texts are linked when the weighted Jaccard similarity of their five-word shingles (lower case, weight:
    occurrences * damped idf) is ``threshold`` or more; classes are the connected texts. class_id is the
    smallest doc_id of the class, kept is true for one row of it (the first id, NULL ids last; of repeated
    rows one). Texts with the same words are the same text: they are collapsed before anything is compared.
    Texts of fewer than five words are one shingle. A text without words (NULL, empty) is a class of its own.
    Other columns are not read; empty tables give empty tables.

    Candidates are texts that share a band of samples; a pair at the threshold misses all bands with a chance
    of (1 - threshold^rows)^bands. In a band's bucket every text is compared with the smallest one first. What
    the found components leave apart is compared block by block, about 512 texts against as many, spread over
    tasks; a cell gives only links that join components. So no bucket is capped, none meets in one task, and
    pairs are never written out. Every link is verified on the texts. Document counts for the idf cover all documents in a table of fixed size.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    id_type = docs.schema[id_column].dataType.simpleString()
    ready = docs.select(row_key(F.col(id_column), F.col(text_column)).alias("key"), F.col(id_column).alias("doc_id"),
                        F.monotonically_increasing_id().alias("row"), F.lower(text_column).alias("text"))
    survey = stored(ready.mapInArrow(
        _survey, f"kind string, key binary, doc_id {id_type}, row long, node long, n_words long, segment long, "
                 "data binary"), "near-survey", "kind")
    listed = survey.filter("kind = 'doc'").select("key", "doc_id", "row", "node")
    weights = context.broadcast(vars(idf_weights(survey.filter("kind = 'cells'").select("segment", "data"),
                                                 listed.count(), damping)))
    nodes = stored(listed.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")), "near-nodes")

    signed = ready.select("text").mapInArrow(_sign(weights, bands, rows),
                                             "node long, samples binary, bands array<long>")
    signed = stored(signed.groupBy("node").agg(F.first("samples").alias("samples"), F.first("bands").alias("bands")),
                    "near-samples")
    banded = stored(signed.select("node", F.explode("bands").alias("band")), "near-bands")
    buckets = stored(banded.groupBy("band").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("n")).filter(
        "n > 1"), "near-buckets")
    members = stored(join_counted(banded, buckets, "band", "n"), "near-members")

    # texts of candidates: a fixed-size Bloom filter of their first documents' ids picks them from the scan
    draw = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = members.select("node").distinct().join(nodes, "node").select(
        F.expr(f"cast(xxhash64(cast(doc_id as string)) & {CANDIDATE_BITS - 1} as int)").alias("place"))
    bits = np.zeros(CANDIDATE_BITS // 8, dtype=np.uint8)
    cells = chosen.groupBy(F.shiftright("place", 3).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1, place & 7)")).alias("bits"))
    for row in cells.toLocalIterator():
        bits[row.cell] = row.bits
    texts = stored(ready.select(draw.alias("draw"), "text").mapInArrow(
        _payloads(context.broadcast(bits.tobytes())), "node long, data binary").join(
        members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.first("data").alias("data")), "near-texts")

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("data").alias("data_a")), "a")
        both = both.join(texts.select(F.col("node").alias("b"), F.col("data").alias("data_b")), "b")
        return both.select("a", "b", "data_a", "data_b").mapInArrow(
            _verify(weights, threshold), "a long, b long, similarity double").select("a", "b")

    star = members.filter("node != center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(verified(star), "near-links")
    labels = components(links)

    # buckets with texts of several components: compare those across components, block by block
    placed = members.join(labels, "node", "left").select(
        "band", "node", "n", F.coalesce("label", "node").alias("label"))
    member = F.xxhash64("node")
    mixed = placed.groupBy("band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"),
        F.bit_xor(member).alias("sign"), F.bit_xor(F.xxhash64(member)).alias("check")).filter("low != high")
    # bands in which the same texts meet need one comparison
    mixed = mixed.groupBy("size", "sign", "check").agg(F.min("band").alias("band")).select("band")
    apart = placed.join(mixed, "band").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    apart = apart.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "node"), "blocks"))
    spread = apart.join(texts, "node").select(
        "band", "block", "node", "label", "data",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    cells = spread.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                          "block", "node", "label", "data")
    further = stored(cells.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(
        _cells(weights, threshold), "a long, b long").distinct(), "near-links")
    labels = components(links.unionByName(further)) if further.limit(1).count() else labels

    named = stored(listed.join(labels, "node", "left").select(
        "key", "doc_id", "row", F.coalesce("label", "node").alias("label")), "near-labels")
    classes = stored(named.filter("label is not null").groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("class_size")), "near-classes")
    grouped = join_counted(named, classes, "label", "class_size").select(
        "key", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("first.row") == F.col("row")).alias("kept"))
    alone = named.filter("label is null").select(
        "key", "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"))
    return grouped.unionByName(alone)
