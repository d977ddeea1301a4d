"""Loads, merges and history: repeated runs, any order of batches, moved and vanished rows."""

import datetime as dt
import gzip
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.operators import checks, upsert
from wayline.session import ensure_checkpoint_dir
from wayline.sources import files, sinks
from wayline.streaming import ingest

C = F.col
TEXT = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "c")])


def day(n):
    return dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)


def write_gz(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8", newline="") as f:
        f.write(text)


def test_csv_layout(spark, tmp_path):
    write_gz(str(tmp_path / "x.csv.gz"), 'a,b,c\n1,"line one\nsays ""hi"", \\n",é\n2,,""\n')
    rows = [tuple(r) for r in files.scan_staged_csv(spark, str(tmp_path / "x.csv.gz"), TEXT).collect()]
    assert rows == [("1", 'line one\nsays "hi", \\n', "é"), ("2", None, None)]


@pytest.mark.parametrize("line", ["1,2", "1,2,3,4"])
def test_csv_wrong_column_count_is_an_error(spark, tmp_path, line):
    write_gz(str(tmp_path / "x.csv.gz"), f"a,b,c\n{line}\n")
    with pytest.raises(Exception):
        files.scan_staged_csv(spark, str(tmp_path / "x.csv.gz"), TEXT).collect()


def test_incremental_load(spark, tmp_path):
    src, target, history = (str(tmp_path / n) for n in ("src", "bronze", "history"))

    def load(n):
        return files.load_incremental_files(spark, src, target, history, TEXT, day(n))

    def newest():
        rows = files.read_bronze(spark, target, TEXT)
        from wayline.operators.windows import dedup_latest
        return {r["a"]: r["b"] for r in dedup_latest(rows, ["a"], "_loaded_at").collect()}

    write_gz(f"{src}/year=2024/one.csv.gz", "a,b,c\n1,x,\n2,y,\n")
    assert load(1) == 1 and load(2) == 0
    write_gz(f"{src}/year=2024/two.csv.gz", "a,b,c\n3,z,\n")
    write_gz(f"{src}/year=2024/one.csv.gz", "a,b,c\n1,changed,longer text\n2,y,\n")    # rewritten in place
    assert load(3) == 2 and newest() == {"1": "changed", "2": "y", "3": "z"}
    assert files.read_bronze(spark, target, TEXT).count() == 5
    # a load that wrote its rows but lost its history repeats without doubling them
    assert files.load_incremental_files(spark, src, target, str(tmp_path / "lost"), TEXT, day(3)) == 2
    assert files.read_bronze(spark, target, TEXT).count() == 5


def test_stream_ingest_exactly_once(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for number in (1, 2):
        write_gz(f"{src}/{number}.csv.gz", f"a,b,c\n{number},x,y\n")
        ingest.stream_ingest_files(spark, src, TEXT, out, state).awaitTermination()
        ingest.stream_ingest_files(spark, src, TEXT, out, state).awaitTermination()
        assert spark.read.parquet(out).count() == number


def test_layout_manifest_and_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "keep")], "id int, old string, extra string")
    row = files.csv_fixed_layout(df, {"id": "key", "old": "name", "missing": "gone"}, {"city": "x"}).first()
    assert row.asDict() == {"city": "x", "key": "1", "name": "", "gone": ""}
    old = spark.createDataFrame([("a/1", 5), ("b/1", 6)], "path string, rows long")
    new = spark.createDataFrame([("a/2", 7)], "path string, rows long")
    assert {tuple(r) for r in files.load_manifest(new, old, "a/").collect()} == {("a/2", 7), ("b/1", 6)}
    stays = spark.createDataFrame([(i, dt.datetime(2024, 1 + i % 2, 3), 'x,"\ny') for i in range(10)],
                                  "id int, at timestamp_ntz, note string")
    path = str(tmp_path / "out")
    got = {tuple(r) for r in sinks.sink_partitioned_csv(stays, "at", path).collect()}
    assert got == {("2024", "01", 5), ("2024", "02", 5)}
    names = [n for _, _, f in os.walk(path) for n in f if n.endswith(".csv.gz")]
    assert len(names) == 2 and os.path.isdir(f"{path}/year=2024/month=02")


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    for as_of, status in [(dt.datetime(2024, 2, 1), "pass"), (dt.datetime(2024, 3, 1), "warn")]:
        assert files.source_freshness({"x": df, "none": df.limit(0)}, "t", as_of).orderBy(
            "source_name").collect()[1]["status"] == status


batches = st.lists(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 30)), max_size=5), min_size=1, max_size=3)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches, st.randoms())
def test_any_batch_order_gives_the_same_table(spark, groups, rng):
    schema = "k int, ts int, v string"
    rows = [[(k, t, f"{k}-{t}") for k, t in g] for g in groups]
    want = {}
    for k, t, v in sorted(r for g in rows for r in g):
        want[k] = v
    rng.shuffle(rows)
    table = spark.createDataFrame([], schema)
    for group in rows:
        table = upsert.merge_newest(table, spark.createDataFrame(group, schema), ["k"], "ts")
    assert {r["k"]: r["v"] for r in table.collect()} == want


def test_merge_uses_high_water_and_adds_columns(spark):
    target = spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], "k int, ts int, v string")
    src = spark.createDataFrame([(1, 4, "late", 0), (2, 6, "new", 1), (3, 7, "more", 2), (3, 8, "last", 3)],
                                "k int, ts int, v string, extra int")
    got = {r["k"]: (r["v"], r["extra"]) for r in upsert.merge_upsert(target, src, ["k"], "ts").collect()}
    assert got == {1: ("a", None), 2: ("new", 1), 3: ("last", 3)}


def test_partitioned_merge(spark, tmp_path):
    path, schema = str(tmp_path / "fact"), "k int, d date, ts int, v string"

    def merge(rows, s=schema):
        return sinks.merge_into_partitions(spark.createDataFrame(rows, s), path, ["k"], "ts", "d")

    jan, feb = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    merge([(1, jan, 1, "a"), (2, feb, 1, "b"), (3, feb, 1, "c"), (4, None, 1, "n")])
    kept = sorted(os.listdir(f"{path}/_month=2024-02"))
    got = merge([(1, dt.date(2024, 3, 1), 2, "moved"), (1, jan, 1, "a")])     # the only January row moves to March
    assert {(r["k"], r["v"]) for r in got.collect()} == {(1, "moved"), (2, "b"), (3, "c"), (4, "n")}
    assert not os.path.exists(f"{path}/_month=2024-01") and sorted(os.listdir(f"{path}/_month=2024-02")) == kept
    got = merge([(2, feb, 0, "older"), (9, feb, 3, "new", 7)][1:], schema + ", extra int")
    assert {(r["k"], r["v"], r["extra"]) for r in got.collect()} == {
        (1, "moved", None), (2, "b", None), (3, "c", None), (4, "n", None), (9, "new", 7)}
    again = merge([(9, feb, 3, "new", 7), (2, feb, 0, "older", 1)], schema + ", extra int")
    assert again.count() == 5 and again.filter("k = 2").first()["v"] == "b"


def test_scd2(spark):
    schema = "k int, price int, name string"
    history = spark.createDataFrame([], schema + ", valid_from date, valid_to date")
    snaps = [(1, [(1, 10, "a"), (2, None, "b"), (3, 5, "c")]), (2, [(1, 10, "renamed"), (2, 7, "b")]),
             (2, [(1, 10, "renamed"), (2, 7, "b")]), (3, [(1, None, "z"), (2, 7, "b"), (3, 5, "c")])]
    for n, rows in snaps:
        history = upsert.scd2_snapshot(history, spark.createDataFrame(rows, schema), "k", ["price"],
                                       dt.date(2024, 1, n))
    got = sorted(((r["k"], r["price"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else None)
                  for r in history.collect()), key=str)
    assert got == sorted([(1, 10, 1, 3), (1, None, 3, None), (2, None, 1, 2), (2, 7, 2, None), (3, 5, 1, 2),
                          (3, 5, 3, None)], key=str)


def test_insert_only_never_updates(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    got = upsert.merge_insert_only(target, spark.createDataFrame([(1, "new"), (2, "n")], "k int, v string"), ["k"])
    assert {tuple(r) for r in got.collect()} == {(1, "old"), (2, "n")}


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "z", -1)], "k int, v string, n int")
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    assert checks.check_unique(df, "k").count() == 1 and checks.check_not_null(df, "k").count() == 1
    assert checks.check_accepted_values(df, "v", ["a", "b"]).first()["v"] == "z"
    assert checks.check_relationships(df, "v", parent, "id").count() == 1
    assert checks.check_accepted_range(df, "n", 0).count() == 1
    report = checks.run_checks({"u": (checks.check_unique(df, "k"), "warn"), "n": (df.limit(0), "error")})
    assert {r["check_name"]: r["status"] for r in report.collect()} == {"u": "warn", "n": "pass"}
    checks.assert_passed(report)
    with pytest.raises(AssertionError):
        checks.assert_passed(checks.run_checks({"u": (checks.check_unique(df, "k"), "error")}))
    one = checks.check_reconcile({"t": (df, "k", df)})
    assert one.first()["raw_ids"] == 1 and one.first()["fact_rows"] == 3


def test_checkpoint_folder_is_set_once(spark):
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


def test_merge_can_be_repeated_after_a_crash(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "fact"), "k int, d date, t int, v string"

    def merge(rows):
        return sinks.merge_into_partitions(spark.createDataFrame(rows, schema), path, ["k"], "t", "d")

    def rows():
        return sorted((r["k"], r["d"], r["v"]) for r in sinks.read_fact(spark, path).collect())

    merge([(1, dt.date(2024, 1, 5), 1, "a"), (2, dt.date(2024, 2, 5), 1, "b")])
    moved = [(1, dt.date(2024, 2, 9), 2, "c")]
    with monkeypatch.context() as broken:
        def stop(*_):
            raise RuntimeError("executor and driver lost")
        broken.setattr(sinks, "fact_partition_layout", stop)
        with pytest.raises(RuntimeError):
            merge(moved)
    assert sinks.read_mark(spark, path, "t").first()["t"] == 1  # so the batch is chosen again
    for _ in range(2):
        merge(moved)
        assert rows() == [(1, dt.date(2024, 2, 9), "c"), (2, dt.date(2024, 2, 5), "b")]
    assert sinks.read_mark(spark, path, "t").first()["t"] == 2
    tied = [(2, dt.date(2024, 2, 5), 3, v) for v in "xyz"]
    merge(tied)
    chosen = rows()
    merge(tied[::-1])
    assert rows() == chosen and len(chosen) == 2


def test_merge_with_the_date_in_the_key_reads_only_the_batch_months(spark, tmp_path):
    path, schema = str(tmp_path / "fact"), "k int, d date, t int, v string"
    for batch in ([(i, dt.date(2024, 1 + i, 1), 1, "a") for i in range(6)], [(2, dt.date(2024, 3, 1), 2, "b")]):
        sinks.merge_into_partitions(spark.createDataFrame(batch, schema), path, ["k"], "t", "d", date_in_key=True)
    got = {r["k"]: r["v"] for r in sinks.read_fact(spark, path).collect()}
    assert got == {0: "a", 1: "a", 2: "b", 3: "a", 4: "a", 5: "a"}
