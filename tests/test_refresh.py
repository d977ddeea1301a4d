"""Marts rebuilt by the months that merges touched."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from wayline.plans import refresh
from wayline.sources import sinks

SCHEMA = "k int, d date, city string, amount int, ts int"


@pytest.fixture
def lake(spark, tmp_path):
    fact, mart = str(tmp_path / "fact"), str(tmp_path / "mart")
    read = []

    def merge(rows):
        sinks.merge_into_partitions(spark.createDataFrame(rows, SCHEMA), fact, ["k"], "ts", "d")

    def make(names):
        def run(rows):
            read.append(rows.inputFiles())
            return rows.join(names, "city", "left").groupBy(F.trunc("d", "month").alias("month"), "name").agg(
                F.sum("amount").alias("amount"), F.countDistinct("k").alias("n"))
        return run

    def refreshed(names):
        table, months = refresh.refresh_months(spark, mart, fact, make(names), "month", [(names, ["city", "name"])])
        whole = make(names)(sinks.read_fact(spark, fact))
        assert table.columns == whole.columns
        assert sorted(map(str, table.collect())) == sorted(map(str, whole.collect()))
        return months

    return merge, refreshed, fact, mart, read


def day(month, n=5):
    return dt.date(2024, month, n)


def test_only_changed_months_are_rebuilt(spark, lake):
    merge, refreshed, fact, mart, read = lake
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "city string, name string")
    merge([(i, day(i % 6 + 1), "ab"[i % 2], i, 1) for i in range(60)] + [(90, None, "a", 7, 1)])
    assert refreshed(names) is None
    before = {m: sorted(os.listdir(f"{mart}/{m}")) for m in os.listdir(mart) if m.startswith("_month=")}
    assert len(before) == 7
    assert refreshed(names) == set()
    merge([(3, day(4, 20), "a", 1000, 2), (70, day(4), "b", 5, 2)])
    read.clear()
    assert refreshed(names) == {"2024-04"}
    after = {m: sorted(os.listdir(f"{mart}/{m}")) for m in before}
    assert [m for m in before if before[m] != after[m]] == ["_month=2024-04"]
    # the rows came from that month alone: the filter is on the folders
    chosen = sinks.read_months(spark, fact, ["2024-04"])
    scan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in scan or "PartitionFilters: [(_month" in scan
    # two merges before a refresh; a row that moves touches two months, and one of them is left empty
    merge([(90, day(2), "a", 7, 3)])
    merge([(71, day(6), None, 1, 3)])
    assert refreshed(names) == {"unknown", "2024-02", "2024-06"}
    assert not os.path.exists(f"{mart}/_month=unknown")


def test_a_changed_lookup_rebuilds_all(spark, lake):
    merge, refreshed, _, mart, _ = lake
    merge([(i, day(i % 3 + 1), "ab"[i % 2], i, 1) for i in range(30)])
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "city string, name string")
    assert refreshed(names) is None
    assert refreshed(names.orderBy(F.desc("city"))) == set()
    assert refreshed(spark.createDataFrame([("a", "A"), ("b", "new")], "city string, name string")) is None


def test_a_refresh_that_dies_is_repeated(spark, lake, monkeypatch):
    merge, refreshed, fact, mart, _ = lake
    names = spark.createDataFrame([("a", "A")], "city string, name string")
    merge([(1, day(1), "a", 1, 1), (2, day(2), "a", 2, 1)])
    assert refreshed(names) is None
    merge([(2, day(2), "a", 9, 2)])
    with monkeypatch.context() as patch:
        patch.setattr(refresh, "STATE_TYPES", "not a type")
        with pytest.raises(Exception):
            refreshed(names)
    assert refreshed(names) == {"2024-02"}


def test_many_merges_keep_their_months(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    for n in range(1, 6):
        sinks._note_changes(spark, path, {f"2024-{n:02}"}, keep=3)
    newest, months = sinks.changed_months(spark, path)
    assert newest == 5 and months == {f"2024-{n:02}" for n in range(1, 6)} and len(sinks._merges(spark, path)) == 3
    assert sinks.changed_months(spark, path, 4) == (5, {"2024-05"}) and sinks.changed_months(spark, path, 5) == (5, set())
