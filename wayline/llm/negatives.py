"""Hard negatives: packed pair scores in a secondary-sort shuffle, read by a streaming iterator."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.common import stored

#: Vector components of a tile: so many of anchors stand in memory, so many of rows stream past them in one task.
ANCHOR_CELLS = 1 << 20
ROW_CELLS = 1 << 24
#: A tile has at least so many rows where the table has them.
LEAST_ROWS = 1024
#: Anchors and rows whose scores are looked at together.
_ANCHORS, _ROWS = 512, 2048
#: Stands for "no score"; scores are held inside 62 bits, larger ones count as the largest.
_NONE = -(1 << 62)
_SAFE = 1 << 51

_KEY = np.dtype([("anchor", ">u8"), ("below", ">u8"), ("kind", "u1"), ("id", ">u8")])
_SIGN = 1 << 63
_CANDIDATES = pa.schema([("anchor_id", pa.int64()), ("score", pa.int64()), ("id", pa.int64()), ("key", pa.binary())])
_CANDIDATE_TYPES = "anchor_id long, score long, id long, key binary"
PAIRS = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))


def quantised(vector: Column, scale: int = 256) -> Column:
    """Whole-number components: floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows of a matrix; shorter ones end in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def pair_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole-number inner products of all rows of two matrices; exact, or the limit of 62 bits."""
    width = min(left.shape[1], right.shape[1])  # a missing component is a zero
    left, right = left[:, :width], right[:, :width]
    most = float(np.abs(left.astype(np.float64)).max(initial=0)) * float(np.abs(right.astype(np.float64)).max(initial=0))
    if most * max(width, 1) < _SAFE:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    exact = left.astype(object) @ right.T.astype(object)
    return np.clip(exact, _NONE + 1, -_NONE - 1).astype(np.int64)


def first_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest allowed scores of each row, the first column first among equals; no order."""
    width = scores.shape[1]
    if width <= k:
        return np.broadcast_to(np.arange(width), scores.shape)
    if np.abs(scores).max(initial=0) < _SAFE:
        order = np.where(allowed, scores * width + np.arange(width - 1, -1, -1), _NONE)
        return np.argpartition(order, width - k, axis=1)[:, width - k:]
    return np.argsort(-np.where(allowed, scores, _NONE), axis=1, kind="stable")[:, :k]


class Tile:
    """The anchors of a tile and the best rows met so far, for each of their score windows.

    An anchor has ``windows`` of (least, most) score; of the rows on the wanted side of its label the first
    ``k`` of each window stay, by score, then id.
    """

    def __init__(self, ids: np.ndarray, labels: list, vectors: np.ndarray, windows: np.ndarray, k: int, same: bool):
        self.codes = {label: i for i, label in enumerate(dict.fromkeys(labels))}
        self.ids, self.vectors, self.windows, self.same = ids, vectors, windows, same
        self.labels = np.array([self.codes[label] for label in labels], dtype=np.int64)
        shape = (len(ids), windows.shape[1], k)
        self.scores, self.found = np.full(shape, _NONE, dtype=np.int64), np.zeros(shape, dtype=np.int64)

    def add(self, ids: np.ndarray, labels: list, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        codes = np.array([self.codes.get(label, -1) for label in labels], dtype=np.int64)[order]
        ids, vectors = ids[order], vectors[order]
        for a in range(0, len(self.ids), _ANCHORS):
            part = slice(a, a + _ANCHORS)
            scores = pair_scores(self.vectors[part], vectors)
            side = (self.labels[part][:, None] == codes) == self.same
            side &= self.ids[part][:, None] != ids
            for w in range(self.windows.shape[1]):
                low, high = self.windows[part, w, 0][:, None], self.windows[part, w, 1][:, None]
                allowed = side & (scores >= low) & (scores <= high)
                k = self.scores.shape[2]
                top = first_of(scores, allowed, k)
                new = np.where(np.take_along_axis(allowed, top, axis=1), np.take_along_axis(scores, top, axis=1), _NONE)
                both = np.hstack([self.scores[part, w], new])
                found = np.hstack([self.found[part, w], ids[top]])
                best = np.lexsort((found, -both), axis=1)[:, :k]
                self.scores[part, w] = np.take_along_axis(both, best, axis=1)
                self.found[part, w] = np.take_along_axis(found, best, axis=1)

    def candidates(self) -> pa.RecordBatch:
        """The rows that stayed, once for each anchor, with the sort key of their pair."""
        at, window, place = np.nonzero(self.scores > _NONE)
        pairs = np.unique(np.stack([self.ids[at], self.scores[at, window, place], self.found[at, window, place]], 1), axis=0)
        anchor, score, row = pairs[:, 0], pairs[:, 1], pairs[:, 2]
        keys = np.zeros(len(pairs), dtype=_KEY)
        keys["anchor"], keys["id"] = _ordered(anchor), _ordered(row)
        keys["below"], keys["kind"] = ~_ordered(score), 0 if self.same else 1
        raw = keys.tobytes()
        packed = [raw[i:i + _KEY.itemsize] for i in range(0, len(raw), _KEY.itemsize)]
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(score), pa.array(row), pa.array(packed, pa.binary())], schema=_CANDIDATES)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Signed numbers as unsigned ones in the same order."""
    return values.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)


def _runs(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``size`` rows that lie in one tile and are of one kind."""
    place = (batch.column("tile").to_numpy(zero_copy_only=False) * 2
             + batch.column("kind").to_numpy(zero_copy_only=False))
    edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
    for first, last in zip(edges[:-1], edges[1:]):
        for at in range(first, last, size):
            yield batch.slice(at, min(size, last - at))


def _search(k: int, windows: int, same: bool, low: int, high: int):
    """Rows arrive by tile, anchors first: they are kept, the other rows stream past them."""

    def bounds(scores: list[list[int] | None]) -> np.ndarray:
        if same:
            return np.tile(np.array([_NONE + 1, -_NONE], dtype=np.int64), (len(scores), 1, 1))
        out = np.zeros((len(scores), windows, 2), dtype=np.int64)
        out[:, :, 0] = 1  # an empty window
        for i, own in enumerate(scores):
            for j, score in enumerate(own or []):
                out[i, j] = window_of(score, low, high)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, at, held = None, None, []

        def opened() -> Tile:
            ids, labels, vectors, scores = (sum((h[i] for h in held), []) for i in range(4))
            return Tile(np.array(ids, dtype=np.int64), labels, _matrix(pa.array(vectors, pa.list_(pa.int64()))),
                        bounds(scores), k, same)

        for batch in batches:
            for part in _runs(batch, _ROWS):
                number = part.column("tile")[0].as_py()
                if number != at:
                    if tile is not None:
                        yield tile.candidates()
                    tile, at, held = None, number, []
                if part.column("kind")[0].as_py() == 0:
                    held.append([part.column(c).to_pylist() for c in ("id", "label", "vector", "scores")])
                elif held or tile is not None:
                    if tile is None:
                        tile, held = opened(), []
                    tile.add(part.column("id").to_numpy(zero_copy_only=False), part.column("label").to_pylist(),
                             _matrix(part.column("vector")))
        if tile is not None:
            yield tile.candidates()

    return run


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the most whole score inside low % and high % of a score."""
    return -(-low * score // 100), high * score // 100


def _tiled(rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int], run) -> DataFrame:
    """Deal anchors and rows out to tiles, each anchor meeting each row in one of them, and stream each tile."""
    across, down = sizes
    left = anchors.withColumn("a", F.pmod(F.xxhash64("id"), F.lit(across))).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).withColumn("kind", F.lit(0))
    right = rows.withColumn("scores", F.lit(None).cast("array<long>")).withColumn(
        "r", F.pmod(F.xxhash64("id", F.lit("row")), F.lit(down))).withColumn(
        "a", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))).withColumn("kind", F.lit(1))
    both = left.unionByName(right).withColumn("tile", (F.col("a") * down + F.col("r")).cast("int"))
    dealt = both.select("tile", "kind", "id", "label", "vector", "scores").repartitionById(
        across * down, "tile").sortWithinPartitions("tile", "kind")
    return dealt.mapInArrow(run, _CANDIDATE_TYPES)


def _pairs(positives: int, negatives: int, low: int, high: int):
    """Read sorted pair keys: positives open their windows, later rows fall into those that are open."""

    def run(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
        anchor, opened = None, []
        for key, _ in keys:
            named, below, kind, row = struct.unpack(">QQBQ", key)
            score, row = (below ^ 0xFFFFFFFFFFFFFFFF) - _SIGN, row - _SIGN
            if named != anchor:
                anchor, opened = named, []
            if kind == 0:
                if len(opened) < positives:
                    opened.append([row, score, *window_of(score, low, high), 0])
                continue
            for window in opened:
                if window[2] <= score <= window[3] and window[4] < negatives:
                    window[4] += 1
                    yield anchor - _SIGN, window[0], window[4], row, window[1], score

    return run


def _by_anchor(key: bytes) -> int:
    return zlib.crc32(key[:8])


def mine_hard_negatives(vectors: DataFrame, anchors: Column, id_column: str = "vec_id", label_column: str = "label",
                        vector_column: str = "vector", positives: int = 5, negatives: int = 3, low: int = 50,
                        high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    ``vectors`` has whole-number ids, labels of any type and vectors of whole numbers; ``anchors`` says which
    rows are anchors. The score of two rows is their inner product. An anchor's positives are the first
    ``positives`` other rows of its label, by descending score, then id; the negatives of a positive are the
    first ``negatives`` rows of another label whose score lies within ``low`` and ``high`` % of the positive's.

    All rows meet all anchors in tiles: a task keeps a bounded number of anchors and streams rows past
    them. A first pass leaves the best rows of the anchor's label of each tile; their scores bound the windows of a second
    pass, which leaves the first rows of each window of each tile. No other pair can be part of a result. The
    pairs left become (anchor, descending score, positives first, id) keys, sorted in the shuffle; an iterator over the
    sorted keys opens the positives' windows and gives out negatives, holding one anchor's open windows only.
    Equal labels, however frequent, never meet in one task.

    Rows without an id, a label or a vector, or with a NULL component, take no part. Ids name rows: of several
    rows with one id the least (label, vector) stays, so repeated rows count once. Vectors of different length are compared
    as if the shorter one ended in zeros. Scores beyond 62 bits count as the largest. An empty table, no anchors or
    one label only give no rows. Columns not named are not read.
    """
    spark = vectors.sparkSession
    plain = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).cast("array<long>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    plain = plain.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
                         & F.forall("vector", lambda x: x.isNotNull()))
    rows = stored(plain.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("one"))
                  .select("id", "one.*"), "negatives-rows")
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"),
                    F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    if not sums["anchors"]:
        return spark.createDataFrame([], PAIRS)
    width, partitions = max(1, sums["width"]), int(spark.conf.get("spark.sql.shuffle.partitions"))
    across = -(-sums["anchors"] * width // ANCHOR_CELLS)
    down = max(-(-sums["n"] * width // ROW_CELLS), min(-(-partitions // across), -(-sums["n"] // LEAST_ROWS)))
    chosen = rows.filter("anchor").drop("anchor")
    rows = rows.drop("anchor")
    near = stored(_tiled(rows, chosen.withColumn("scores", F.lit(None).cast("array<long>")), (across, down),
                         _search(positives, 1, True, low, high)), "negatives-near")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    scores = near.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= positives).groupBy(
        F.col("anchor_id").alias("id")).agg(F.collect_list("score").alias("scores"))
    far = stored(_tiled(rows, chosen.join(scores, "id"), (across, down),
                        _search(negatives, positives, False, low, high)), "negatives-far")
    keys = near.select("key").unionByName(far.select("key")).rdd.map(lambda row: (bytes(row[0]), None))
    dealt = keys.repartitionAndSortWithinPartitions(max(partitions, across * down), _by_anchor)
    return spark.createDataFrame(dealt.mapPartitions(_pairs(positives, negatives, low, high)), PAIRS, verifySchema=False)
