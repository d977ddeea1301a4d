"""Nearest vectors by cosine: all rows against all queries in tiles, or only the rows of probed hash buckets.

Neither the index nor the queries pass through the driver, and only the best k rows per query leave a task."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.functions.numbers import fn_cosine_similarity
from wayline.operators.relational import filter_optional_param
from wayline.operators.windows import window_top_n_per_group

TOP_K = 8
FRAGMENT_BYTES = 32 << 20      # queries a task holds at a time
ROW_BYTES = 128 << 20          # index rows that stream past them in one task
LEAST_ROWS = 1024              # a tile is not cut finer than this to occupy more tasks
QUERY_SLICE = 256              # queries scored at once inside a task
ROW_SLICE = 4096               # rows scored at once
FIRST_ROWS = 512               # rows of a tile that give its queries their first bound
MOST_EXACT = 1 << 16           # pairs whose exact keys are taken at once
TASKS_PER_CORE = 4
_SCALE = 1 << 26               # unit vectors as whole numbers: their products stay below 2**53, so sums are exact

# the hash index: tables of sign patterns of random planes, and the patterns a query looks into
TABLES, BITS, PROBES = 4, 6, 16
MOST_CELLS = 1 << 16


def search_one(index: DataFrame, vector: list[float], k: int = TOP_K, city: str | None = None,
               vec_col: str = "embedding", id_col: str = "review_id") -> DataFrame:
    """Best k rows for one query vector: one narrow pass and a distributed top-k, ties by id."""
    rows = filter_optional_param(index, "city", city)
    query = F.array(*[F.lit(float(x)) for x in vector])
    scored = rows.withColumn("score", fn_cosine_similarity(F.col(vec_col), query))
    return scored.drop(vec_col).orderBy(F.col("score").desc_nulls_last(), F.col(id_col)).limit(k)


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.full_like(matrix, np.nan), where=norms > 0)


def _few_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their ids, without those that have k equal vectors before them: they tie with these everywhere."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    if not vectors.shape[1]:
        return ids[:k], vectors[:k]
    same = np.unique(vectors.view(np.dtype((np.void, vectors.strides[0]))).ravel(), return_inverse=True)[1]
    keep = np.sort(_first_of_each(same, np.argsort(same, kind="stable"), k))
    return ids[keep], vectors[keep]


def _first_of_each(group: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """The first k places of each group, from the places ordered by group."""
    sorted_group = group[order]
    starts = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < k]


class _Tile:
    """Best k rows so far for the queries of one tile; blocks of rows come one after another.

    The order key is the product of whole-number vectors: exact in any order of summation, so equal vectors
    tie in every block, and blocks, partitions and threads don't change the ranking. Single-precision products, with
    a margin above their error, tell which rows can be among a query's best k; keys and scores are taken for these only.

    A vector without a direction (zero, or not finite) has the lowest key with all others: of such rows, and of all rows for
    such a query, the k smallest ids count.
    """

    def __init__(self, qids: np.ndarray, vectors: np.ndarray, k: int):
        self.qids, self.k, self.unit = qids, k, _unit(vectors)
        self.good = ~np.isnan(self.unit).any(axis=1)
        self.asked = np.flatnonzero(self.good)
        self.coarse = self.unit[self.asked].astype(np.float32)
        # products of unit vectors in single precision are off by less than (width + 4) * 2**-23
        self.margin = (vectors.shape[1] + 16) * 2.0**-22
        self.ids = np.full((len(self.asked), k), np.iinfo(np.int64).max)
        self.keys = np.full((len(self.asked), k), -np.inf)
        self.scores = np.full((len(self.asked), k), np.nan)
        self.fresh, self.least, self.lame = True, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.least = np.sort(np.r_[self.least, ids])[:self.k]
        index = _unit(vectors)
        good = ~np.isnan(index).any(axis=1)
        self.lame = np.sort(np.r_[self.lame, ids[~good]])[:self.k]
        if not good.any() or not len(self.asked):
            return
        ids, index = _few_copies(ids[good], index[good], self.k)
        first = min(len(ids), max(FIRST_ROWS, self.k)) if self.fresh else 0     # they give the others a bound
        self.fresh = False
        for part in (slice(0, first), slice(first, None)):
            if len(ids[part]):
                self._block(ids[part], index[part])

    def _block(self, ids: np.ndarray, index: np.ndarray) -> None:
        coarse = np.ascontiguousarray(index.astype(np.float32).T)
        for start in range(0, len(self.asked), QUERY_SLICE):
            here = slice(start, start + QUERY_SLICE)
            near = self.coarse[here] @ coarse
            worst, last = self.keys[here, -1], self.ids[here, -1]
            low = worst / float(_SCALE) ** 2 - self.margin
            open_ = np.flatnonzero(worst == -np.inf)
            if len(open_) and len(ids) >= self.k:       # the block's own first k bound the rest
                at = len(ids) - self.k
                low[open_] = np.partition(near[open_], at, axis=1)[:, at] - 2 * self.margin
            q, r = np.divmod(np.flatnonzero(near >= low.astype(np.float32)[:, None]), len(ids))
            for at in range(0, len(q), MOST_EXACT):
                self._exact(start, q[at:at + MOST_EXACT], r[at:at + MOST_EXACT], worst, last, ids, index)

    def _exact(self, start: int, q, r, worst, last, ids: np.ndarray, index: np.ndarray) -> None:
        asked, rows = self.unit[self.asked[q + start]], index[r]
        keys = np.einsum("ij,ij->i", np.rint(asked * _SCALE), np.rint(rows * _SCALE))
        better = np.flatnonzero((keys > worst[q]) | ((keys == worst[q]) & (ids[r] < last[q])) | (worst[q] == -np.inf))
        if not len(better):
            return
        # the score itself: one pair after another, whatever the block
        scores = (rows[better] * asked[better]).cumsum(axis=1)[:, -1]
        q, r, keys = q[better] + start, r[better], keys[better]
        met = np.unique(q)
        group = np.r_[np.repeat(met, self.k), q]
        columns = (np.r_[self.ids[met].ravel(), ids[r]], np.r_[self.keys[met].ravel(), keys],
                   np.r_[self.scores[met].ravel(), scores])
        best = _first_of_each(group, np.lexsort((columns[0], -columns[1], group)), self.k)
        for held, column in zip((self.ids, self.keys, self.scores), columns):
            held[met] = column[best].reshape(len(met), self.k)

    def rows(self) -> pd.DataFrame:
        found = self.keys > -np.inf
        parts = [(np.repeat(self.qids[self.asked], found.sum(axis=1)), self.ids[found], self.keys[found], self.scores[found])]
        # rows without a direction fill what is left; a query without one gets the smallest ids
        room = self.k - found.sum(axis=1)
        for asked, ids, room in ((self.asked, self.lame, room), (np.flatnonzero(~self.good), self.least, self.k)):
            taken = np.minimum(room, len(ids)) * np.ones(len(asked), np.int64)
            place = np.arange(taken.sum()) - np.repeat(taken.cumsum() - taken, taken)
            parts.append((np.repeat(self.qids[asked], taken), ids[place], np.full(len(place), -np.inf),
                          np.full(len(place), np.nan)))
        return pd.DataFrame(dict(zip(("query_id", "id", "key", "score"), (np.concatenate(c) for c in zip(*parts)))))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def vector_search_topk(index: DataFrame, queries: DataFrame, k: int = TOP_K, city: str | None = None,
                       vec_col: str = "embedding", id_col: str = "review_id", query_id: str = "query_id",
                       query_vec: str = "query_vector", fragment_bytes: int = FRAGMENT_BYTES,
                       method: str = "exact", tables: int = TABLES, bits: int = BITS, probes: int = PROBES) -> DataFrame:
    """Best k index rows for each query: (query_id, id, score, rank), ties by id.

    ``exact`` scores every row for every query: blocks of queries and of rows are numbered, each pair of blocks is a
    tile, and a task holds a tile's queries (about ``fragment_bytes``) while its rows stream past. The work
    is rows times queries.

    ``lsh`` scores only the rows that share a bucket with a query in one of ``tables`` hash tables of ``bits`` random
    planes, for the ``probes`` buckets nearest to the query in each; scores and ranks of what it finds are exact. How much
    it saves depends on the vectors: where neighbours lie close, few probes find them. Independent random
    vectors have no close neighbours, and the default probes, chosen to find 0.9 of the neighbours even
    there, read two thirds of such a table. Build the index once with ``lsh_index`` where it is searched often.

    A task emits k rows per query, and a grouped first-k (pruned before its shuffle) gives the final answer.
    """
    rows = filter_optional_param(index, "city", city).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v")).filter("v is not null")
    asked = queries.select(F.col(query_id).cast("bigint").alias("id"), F.col(query_vec).alias("v")).filter(
        "v is not null")
    if method == "exact":
        return _search(rows, asked, k, fragment_bytes, 1)
    if method != "lsh":
        raise ValueError(f"unknown method {method}")
    return search_lsh(lsh_index(rows, tables, bits, "v", "id"), asked, k, "id", "v", fragment_bytes, tables, bits, probes)


def random_planes(count: int, width: int) -> np.ndarray:
    """Components of seeded planes, uniform in [-0.5, 0.5): 8 digits of an md5 of plane and place."""
    named = (f"plane|{p}|{j}" for p in range(count) for j in range(width))
    draws = [int(hashlib.md5(name.encode()).hexdigest()[:8], 16) for name in named]
    return np.array(draws, dtype=np.float64).reshape(count, width) / 2.0**32 - 0.5


def _buckets(tables: int, bits: int, probes: int):
    """Cells (table, sign pattern) of each vector: its own, or those with the least margins to cross."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes, codes = None, np.arange(1 << bits)
        signs = (codes[:, None] >> np.arange(bits)) & 1
        for frame in frames:
            for at in range(0, len(frame), QUERY_SLICE):
                part = frame.iloc[at:at + QUERY_SLICE]
                vectors = _matrix(part["v"])
                if planes is None or planes.shape[1] != vectors.shape[1]:
                    planes = random_planes(tables * bits, vectors.shape[1])
                margins = (vectors @ planes.T).reshape(len(part), tables, bits)
                if probes:
                    crossed = (margins[:, :, None, :] > 0) != (signs == 1)
                    cost = (crossed * np.abs(margins)[:, :, None, :]).sum(axis=3)
                    own = np.argsort(cost, axis=2, kind="stable")[:, :, :probes]
                else:
                    own = ((margins > 0) @ (1 << np.arange(bits)))[:, :, None]
                cells = (own + (np.arange(tables) << bits)[:, None]).reshape(len(part), -1)
                yield pd.DataFrame({"cells": list(cells), "id": part["id"].to_numpy(), "v": part["v"].to_numpy()})

    return run


def _in_cells(rows: DataFrame, tables: int, bits: int, probes: int) -> DataFrame:
    if tables << bits > MOST_CELLS:
        raise ValueError(f"at most {MOST_CELLS} buckets")
    kind = rows.schema["v"].dataType.simpleString()
    marked = rows.select("id", "v").mapInPandas(_buckets(tables, bits, probes), f"cells array<int>, id bigint, v {kind}")
    return marked.select(F.explode("cells").alias("cell"), "id", "v")


def lsh_index(index: DataFrame, tables: int = TABLES, bits: int = BITS, vec_col: str = "embedding",
              id_col: str = "review_id") -> DataFrame:
    """The index as a table (cell, id, v): every vector once for each hash table, under the bucket it falls into.

    A bucket is the pattern of signs towards ``bits`` seeded planes; nothing is fitted. NULL vectors are left
    out. Write it sorted or partitioned by ``cell`` to search it many times.
    """
    rows = index.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v")).filter("v is not null")
    return _in_cells(rows, tables, bits, 0)


def search_lsh(cells: DataFrame, queries: DataFrame, k: int = TOP_K, query_id: str = "query_id",
               query_vec: str = "query_vector", fragment_bytes: int = FRAGMENT_BYTES, tables: int = TABLES,
               bits: int = BITS, probes: int = PROBES) -> DataFrame:
    """Best k rows of the probed buckets of an ``lsh_index`` with the same ``tables`` and ``bits``."""
    asked = queries.select(F.col(query_id).cast("bigint").alias("id"), F.col(query_vec).alias("v")).filter(
        "v is not null")
    return _search(cells, _in_cells(asked, tables, bits, min(probes, 1 << bits)), k, fragment_bytes, tables)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(queries, wanted, found, recall) of an approximate result against the exact one."""
    hit = found.select("query_id", "id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query_id", "id"], "left").agg(
        F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("found")
    ).withColumn("recall", F.try_divide(F.col("found"), F.col("wanted")))


_FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("id", T.LongType()),
                       T.StructField("key", T.DoubleType()), T.StructField("score", T.DoubleType())])


def _search(rows: DataFrame, asked: DataFrame, k: int, fragment_bytes: int, copies: int) -> DataFrame:
    """Rows (cell, id, v) scored for the queries (cell, id, v) of their cell, or all for all without a ``cell``; a pair meets
    in at most ``copies`` cells."""
    plan, partitions = _tiles(rows, asked, fragment_bytes)
    at = (F.col("first") + F.col("a") * F.col("down") + F.col("r")).alias("tile")

    def block(count: str, salt: str):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(count))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    # vectors travel in single precision if both sides have it
    kinds = {df.schema["v"].dataType.simpleString() for df in (rows, asked)}
    vector = F.col("v").cast("array<float>" if kinds == {"array<float>"} else "array<double>").alias("v")
    left = _placed(asked, plan).withColumn("a", block("across", "query")).withColumn("r", every("down"))
    right = _placed(rows, plan).withColumn("r", block("down", "row")).withColumn("a", every("across"))
    both = left.select(at, F.lit(0).alias("kind"), "id", vector).unionByName(
        right.select(at, F.lit(1).alias("kind"), "id", vector))
    dealt = both.repartitionById(partitions, F.pmod("tile", F.lit(partitions)).cast("int")).sortWithinPartitions(
        "tile", "kind")
    partial = dealt.mapInPandas(_scorer(k), _FOUND)
    order = [F.col("key").desc_nulls_last(), F.col("id").asc()]
    best = window_top_n_per_group(partial, ["query_id"], order, k * copies, spread_by=["id"])
    if copies > 1:     # a pair met in several cells has one key and one score
        best = window_top_n_per_group(best.dropDuplicates(["query_id", "id"]), ["query_id"], order, k, spread_by=["id"])
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.select("query_id", "id", "score", "rank")


def _placed(df: DataFrame, plan: list[tuple]) -> DataFrame:
    """Rows with the tiles of their cell; rows without a ``cell`` are all in the only one."""
    names = ["first", "across", "down"]
    if "cell" not in df.columns:
        places = {name: F.lit(place).cast("long") for name, place in zip(names, plan[0][1:] if plan else (0, 0, 0))}
        return (df if plan else df.limit(0)).withColumns(places)
    # one row per cell that has both; there are at most MOST_CELLS
    tiles = df.sparkSession.createDataFrame(plan, "cell int, first long, across long, down long")
    return df.join(F.broadcast(tiles), "cell")


def _tiles(rows: DataFrame, asked: DataFrame, fragment_bytes: int) -> tuple[list[tuple], int]:
    """(cell, first, across, down): the blocks of queries and of rows of each cell, and the number of tasks."""
    spark = rows.sparkSession
    cell = F.col("cell") if "cell" in rows.columns else F.lit(0).alias("cell")
    held = rows.groupBy(cell).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).collect()
    wanted = dict(map(tuple, asked.groupBy(cell).agg(F.count(F.lit(1)).alias("m")).collect()))
    counts = [(*row, wanted[row["cell"]]) for row in held if row["cell"] in wanted]
    # every task gives k rows for each of its queries, so there are no more of them than keep the cores busy
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                     TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    plan, first, streams = [], 0, 0
    for cell, n, width, m in sorted(counts):
        size, share = max(1, width) * 8, -(-partitions // len(counts))
        # rows travel once per block of queries, results once per block of rows: as many of one as of the other
        across = max(-(-m // max(1, fragment_bytes // size)), min(math.isqrt(share), -(-m // QUERY_SLICE)))
        least = -(-n * size // ROW_BYTES)
        down = max(least, min(-(-share // across), -(-n // LEAST_ROWS)))
        plan.append((cell, first, across, down))
        first, streams = first + across * down, streams + across * least
    return plan, max(1, min(first, max(partitions, streams)))


def _scorer(k: int):
    """Frames arrive by tile, queries first: they are kept, the rows stream past them."""

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tile, held, found = None, [], None
        for frame in frames:
            for number, part in frame.groupby("tile", sort=True):
                if number != tile:
                    if found is not None:
                        yield found.rows()
                    tile, held, found = number, [], None
                asked = part["kind"].to_numpy() == 0
                if asked.any():
                    own = part[asked]
                    held.append((own["id"].to_numpy(), _matrix(own["v"])))
                others = part[~asked]
                if len(others) and held:
                    if found is None:
                        found = _Tile(*(np.concatenate(c) for c in zip(*held)), k)
                    for at in range(0, len(others), ROW_SLICE):
                        rows = others.iloc[at:at + ROW_SLICE]
                        found.add(rows["id"].to_numpy(), _matrix(rows["v"]))
        if found is not None:
            yield found.rows()

    return score


def rag_context(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Numbered "[i] (city, date) text" blocks per question; a question has at most k hits. Hits without
    text are left out of the block; a question without any text keeps its row with an empty block."""
    line = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] ("), F.col("city"), F.lit(", "),
                    F.col("review_date").cast("string"), F.lit(") "), F.col("comment_text"))
    grouped = hits.groupBy(query_id).agg(F.array_sort(F.collect_list(
        F.when(line.isNotNull(), F.struct(F.col("rank"), line.alias("line"))))).alias("lines"))
    return grouped.select(query_id, F.size("lines").alias("n_hits"),
                          F.concat_ws("\n\n", F.col("lines.line")).alias("context"))
