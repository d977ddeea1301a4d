"""Vector search in tiles and by hash buckets, beside plain products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayline.operators import vectors


def frames(spark, base, asked):
    index = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "review_id long, embedding array<float>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, query_vector array<float>")
    return index, queries


def clusters(rng, n, width, groups, spread):
    return rng.normal(size=(groups, width))[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, width))


def test_tiles_give_one_result(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base, asked = rng.normal(size=(3000, 16)), rng.normal(size=(50, 16))
    base[::3] = base[0]        # a vector that a third of the rows share
    index, queries = frames(spark, base, asked)
    want = [tuple(r) for r in vectors.vector_search_topk(index, queries, k=5).orderBy("query_id", "rank").collect()]
    assert len(want) == 250
    monkeypatch.setattr(vectors, "ROW_BYTES", 16 * 8 * 100)
    monkeypatch.setattr(vectors, "ROW_SLICE", 33)
    found = vectors.vector_search_topk(index, queries, k=5, fragment_bytes=16 * 8 * 7)
    assert [tuple(r) for r in found.orderBy("query_id", "rank").collect()] == want


def test_few_probes_find_close_neighbours(spark):
    rng = np.random.default_rng(4)
    base = clusters(rng, 4000, 32, 100, 0.15)
    index, queries = frames(spark, base, base[::40])
    exact = vectors.vector_search_topk(index, queries, k=5)
    cells = vectors.lsh_index(index, tables=4, bits=8).cache()
    few = vectors.search_lsh(cells, queries, 5, tables=4, bits=8, probes=8)
    got = vectors.recall(few, exact).first()
    assert (got["queries"], got["wanted"]) == (100, 500) and got["recall"] >= 0.95
    # what was scored: rows of probed buckets, far from all
    probed = vectors._in_cells(queries.select(F.col("query_id").alias("id"), F.col("query_vector").alias("v")), 4, 8, 8)
    met = cells.alias("r").join(probed.alias("q"), "cell").select("q.id", "r.id").distinct().count()
    assert met <= 0.25 * len(base) * 100
    # scores and ranks of what is found are those of the exact search
    both = few.join(exact, ["query_id", "id"]).select(few["score"], exact["score"], few["rank"], exact["rank"]).collect()
    assert all(r[0] == r[1] and r[2] <= r[3] for r in both)


def test_all_probes_are_exact(spark):
    rng = np.random.default_rng(5)
    index, queries = frames(spark, rng.normal(size=(300, 8)), rng.normal(size=(20, 8)))
    want = vectors.vector_search_topk(index, queries, k=4).orderBy("query_id", "rank").collect()
    got = vectors.vector_search_topk(index, queries, k=4, method="lsh", tables=2, bits=3, probes=8)
    assert got.orderBy("query_id", "rank").collect() == want


def test_search_of_little(spark):
    index, queries = frames(spark, np.ones((2, 3)), np.ones((1, 3)))
    for method in ("exact", "lsh"):
        assert vectors.vector_search_topk(index.limit(0), queries, method=method).count() == 0
        assert vectors.vector_search_topk(index, queries.limit(0), method=method).count() == 0
        nulls = index.withColumn("embedding", F.when(F.col("review_id") == 0, F.col("embedding")))
        assert [r["id"] for r in vectors.vector_search_topk(nulls, queries, method=method).collect()] == [0]
    with pytest.raises(ValueError):
        vectors.vector_search_topk(index, queries, method="other")
    with pytest.raises(ValueError):
        vectors.lsh_index(index, tables=64, bits=12)


def test_exact_keys_for_few_pairs(monkeypatch):
    rng = np.random.default_rng(6)
    base, asked = rng.normal(size=(20000, 16)), rng.normal(size=(100, 16))
    base[::3], asked[::4] = base[0], base[0]        # copies tie: the smallest ids count
    base[5], asked[7] = 0.0, 0.0
    tile, pairs, exact = vectors._Tile(np.arange(100), asked, 5), [], vectors._Tile._exact
    monkeypatch.setattr(vectors._Tile, "_exact", lambda self, start, q, *rest: (
        pairs.append(len(q)), exact(self, start, q, *rest)))
    for at in range(0, len(base), 4096):
        rows = rng.permutation(np.arange(at, min(at + 4096, len(base))))
        tile.add(rows, base[rows])
    assert sum(pairs) < 0.02 * len(base) * len(asked)
    found = tile.rows()
    keys = np.rint(vectors._unit(asked) * vectors._SCALE) @ np.rint(vectors._unit(base) * vectors._SCALE).T
    keys = np.where(np.isnan(keys), -np.inf, keys)
    for query, got in found.groupby("query_id"):
        assert sorted(got["id"]) == sorted(np.argsort(-keys[query], kind="stable")[:5]), query


def test_exact_search_moves_little(spark):
    rng = np.random.default_rng(8)
    index, queries = frames(spark, rng.normal(size=(3000, 8)), rng.normal(size=(10, 8)))
    plan = vectors.vector_search_topk(index, queries)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "array<double>" not in plan            # vectors given in single precision travel so
