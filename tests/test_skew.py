"""Operators against brute force, with one key that holds most of the rows."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayline.operators import ranking, relational, travel, vectors, windows

C = F.col


@pytest.fixture(scope="module")
def hot_rows():
    rng = random.Random(5)
    return [(i, None if i % 50 == 0 else "hot" if rng.random() < 0.6 else f"k{rng.randrange(20)}",
             rng.randrange(1000)) for i in range(5000)]


@pytest.fixture(scope="module")
def hot(spark, hot_rows):
    return spark.createDataFrame(hot_rows, "id long, k string, v long").repartition(7)


def by_key(rows):
    groups = defaultdict(list)
    for i, k, v in rows:
        groups[k].append((v, i))
    return {k: sorted(g) for k, g in groups.items()}


def test_rank_rows(spark, hot, hot_rows):
    got = {r["id"]: (r["rn"], r["cnt"]) for r in ranking.window_named_count(hot, ["k"], [C("v"), C("id")]).collect()}
    want = {i: (n, len(g)) for g in by_key(hot_rows).values() for n, (v, i) in enumerate(g, 1)}
    assert got == want


def test_global_ids(spark, hot, hot_rows):
    got = {r["id"]: r["row_id"] for r in ranking.window_row_number_id(hot, [C("v").desc(), C("id")]).collect()}
    order = sorted(hot_rows, key=lambda r: (-r[2], r[0]))
    assert got == {r[0]: n for n, r in enumerate(order, 1)}


def test_rank_rows_of_nothing(spark, hot):
    assert ranking.window_row_number_id(hot.filter("id < 0"), [C("id")]).count() == 0


def test_quantiles(spark, hot, hot_rows):
    got = {r["k"]: (r["med"], r["p97"]) for r in ranking.agg_median_quantile(
        hot, ["k"], "v", {"med": 0.5, "p97": 0.97}).collect()}
    for k, group in by_key(hot_rows).items():
        want = np.quantile([v for v, _ in group], [0.5, 0.97])
        assert got[k] == pytest.approx(tuple(want))


@pytest.mark.parametrize("n", [3, 1500])
def test_top_n(spark, hot, hot_rows, n):
    got = defaultdict(set)
    for r in windows.window_top_n_per_group(hot, ["k"], [C("v"), C("id")], n).collect():
        got[r["k"]].add(r["id"])
    assert got == {k: {i for _, i in g[:n]} for k, g in by_key(hot_rows).items()}


def test_forward_fill(spark):
    rng = random.Random(3)
    start, rows = dt.date(2023, 11, 20), []
    for key in ("a", "b"):
        rows += [(key, start + dt.timedelta(d), rng.choice([None, None, d])) for d in range(200)]
    df = spark.createDataFrame(rows, "k string, d date, v int").repartition(5)
    got = {(r["k"], r["d"]): r["v"] for r in windows.window_forward_fill(df, ["k"], "d", ["v"]).collect()}
    last = {}
    for key, day, value in rows:
        last[key] = value if value is not None else last.get(key)
        assert got[(key, day)] == last[key]


def test_nth_candidate_covers_all_requests(spark):
    requests = spark.createDataFrame([(i, "x" if i % 3 else "y") for i in range(300)], "rid long, g string")
    candidates = spark.createDataFrame([(f"c{i}", "x") for i in range(40)], "c string, g string")
    got = relational.join_nth_candidate(requests, candidates, ["g"], [C("c")], "rid", "s").collect()
    assert len(got) == 200 and len({r["c"] for r in got}) > 20
    report = travel.route_match(requests, candidates, ["g"], [C("c")], "rid", "s")[1].first()
    assert (report["requested"], report["matched"]) == (300, 200)


def test_null_tolerant_join(spark):
    left = spark.createDataFrame([(1, "c", "g"), (2, "c", None), (3, "d", "h"), (4, "e", "g")],
                                 "id int, city string, grp string")
    rules = spark.createDataFrame([("c", None, "m1"), ("c", "g", "m2"), ("d", "g", "m3")],
                                  "city string, grp string, metro string")
    got = sorted((r["id"], r["metro"]) for r in relational.join_null_tolerant_or(
        left, rules, "city", "grp", ["metro"]).select("id", "metro").collect() if r["metro"])
    rest = [r["id"] for r in relational.join_null_tolerant_or(left, rules, "city", "grp", ["metro"]).filter(
        "metro is null").collect()]
    assert got == [(1, "m1"), (1, "m2"), (2, "m1")] and sorted(rest) == [3, 4]


@pytest.mark.parametrize("fragment", [vectors.FRAGMENT_BYTES, 500])
def test_vector_search_in_fragments(spark, fragment):
    rng = np.random.default_rng(1)
    base, asked = rng.normal(size=(400, 8)), rng.normal(size=(30, 8))
    base[5] = 0.0
    index = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "review_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)],
                                    "query_id long, query_vector array<double>")
    got = defaultdict(list)
    for r in vectors.vector_search_topk(index.repartition(6), queries, k=4, fragment_bytes=fragment
                                        ).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["id"])
    norms = np.linalg.norm(base, axis=1)
    norms[5] = np.inf
    scores = asked @ base.T / norms / np.linalg.norm(asked, axis=1, keepdims=True)
    scores[:, 5] = -np.inf
    assert got == {i: np.argsort(-s, kind="stable")[:4].tolist() for i, s in enumerate(scores)}
    one = vectors.search_one(index, asked[0].tolist(), 4).collect()
    assert [r["review_id"] for r in one] == got[0]


def test_equal_vectors_rank_by_id_in_any_partitioning(spark):
    rng = np.random.default_rng(7)
    base = np.repeat(rng.normal(size=(40, 24)), 5, axis=0)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    index = spark.createDataFrame(rows, "review_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, rng.normal(size=24).tolist()) for i in range(25)],
                                    "query_id long, query_vector array<double>")
    alone = index.filter("review_id % 5 = 0").coalesce(1)
    shapes = [index.coalesce(1), index.repartition(3), index.repartition(17),
              alone.unionByName(index.filter("review_id % 5 > 0").repartition(4))]
    got = [[tuple(r) for r in vectors.vector_search_topk(s, queries, k=7).orderBy("query_id", "rank").collect()]
           for s in shapes]
    assert all(g == got[0] for g in got)
    for query in range(25):
        ids = [r[1] for r in got[0] if r[0] == query]
        assert ids[:5] == list(range(ids[0], ids[0] + 5)) and ids[0] % 5 == 0


def test_latest_snapshot_neither_shuffles_nor_sorts_the_big_side(spark):
    days = spark.range(2000).selectExpr("concat('c', id % 20) as city", "concat('d', id % 7) as snapshot", "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        latest = relational.join_latest_snapshot(days, ["city"], "snapshot")
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert latest.count() == sum(1 for i in range(2000) if i % 7 == 6)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_forward_fill_orders_ties(spark):
    rows = [("a", dt.date(2024, 1, 1), 2, None), ("a", dt.date(2024, 1, 1), 1, 5), ("a", dt.date(2024, 2, 1), 3, None),
            ("a", dt.date(2024, 2, 1), 4, 7), ("a", dt.date(2024, 3, 9), 0, None)]
    df = spark.createDataFrame(rows, "k string, d date, n int, v int")
    got = windows.window_forward_fill(df, ["k"], "d", ["v"], ["n"]).orderBy("d", "n").collect()
    assert [r["v"] for r in got] == [5, 5, 5, 7, 7]


def test_plans_prune_groups_before_the_shuffle(spark, small_dir):
    lines = spark.read.parquet(f"{small_dir}/lineitem.parquet")
    plan = windows.dedup_latest(lines, ["l_orderkey"], "l_shipdate")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    filtered = lines.filter("l_returnflag = 'R'").select("l_orderkey")
    text = filtered._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in text and "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text
