"""Tables made, checked and merged in parts."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

import wayline.workload.queries  # noqa: F401 - fills the registry
from wayline.plans import quality
from wayline.sources import parts, sinks
from wayline.workload import q_writes
from wayline.workload.registry import QUERIES
from wayline.workload.views import Inputs

ROWS = "k int, d date, v int, ts timestamp"


def day(month, number=1):
    return dt.date(2024, month, number)


def load(number):
    return dt.datetime(2024, 1, number)


def stored(df):
    return sorted(map(repr, df.select("k", "d", "v", "ts").collect()))


def files_below(folder):
    return [p for p in folder.rglob("*") if p.is_file()]


@pytest.mark.parametrize("buckets", [None, sinks.Buckets("v", 3)])
def test_a_batch_in_parts_merges_as_a_whole_one(spark, tmp_path, buckets):
    batches = [[(k % 50 if k % 9 else None, day(1 + k % 7), k, load(1 + k % 3)) for k in range(120)] + [(70, None, 1, load(1))],
               [(k, day(8), -k, load(9)) for k in range(0, 50, 2)] + [(None, day(9), 5, load(9)), (70, day(1), 2, load(9))],
               [(k, day(1), 0, load(1)) for k in range(5)] + [(99, None, 9, None)]]
    for batch in batches[:2 if buckets else 3]:
        rows = spark.createDataFrame(batch, ROWS)
        whole = sinks.merge_into_partitions(rows, str(tmp_path / "whole"), ["k"], "ts", "d", buckets=buckets)
        # rows of a key stand in different parts and months
        split = sinks.Parts(2, (rows.filter(F.pmod("v", F.lit(2)) == n) for n in range(2)))
        got = sinks.merge_into_partitions(split, str(tmp_path / "split"), ["k"], "ts", "d", buckets=buckets)
        assert stored(got) == stored(whole)
        assert sinks.changed_months(spark, str(tmp_path / "split")) == sinks.changed_months(spark, str(tmp_path / "whole"))
    names = [{p.name for p in (tmp_path / n).glob("_month=*")} for n in ("split", "whole")]
    assert names[0] == names[1]


def test_keys_that_hold_the_date_merge_in_parts(spark, tmp_path):
    for number in (1, 2):
        rows = spark.createDataFrame([(k, day(1 + k % 6), number, load(number)) for k in range(40)] * 2, ROWS)
        for name, src in (("whole", rows), ("split", sinks.Parts(2, [rows.filter(F.col("k") % 2 == n) for n in range(2)]))):
            sinks.merge_into_partitions(src, str(tmp_path / name), ["k"], "ts", "d", True)
    got = [stored(sinks.read_fact(spark, str(tmp_path / n))) for n in ("whole", "split")]
    assert got[0] == got[1] and len(got[0]) == 40


def test_a_key_is_in_one_part_whose_files_go_after_use(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(parts, "scratch_path", lambda spark, name: str(tmp_path / name))
    rows = spark.createDataFrame([(k % 40 if k % 11 else None, day(1), k, load(1)) for k in range(400)], ROWS)
    frames = [rows.filter(F.col("v") % 3 == n) for n in range(3)]
    seen, sizes = [], []
    for table in parts.deal_by_key(frames, F.col("k"), 5):
        seen.append([tuple(r) for r in table.collect()])
        sizes.append(len(files_below(tmp_path)))
    keys = [{r[0] for r in part} for part in seen]
    assert sum(map(len, keys)) == 41 and len(keys) > 1
    assert sorted(map(repr, sum(seen, []))) == sorted(map(repr, map(tuple, rows.collect())))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]
    assert not (tmp_path / "dealt").exists()
    empty = list(parts.deal_by_key([rows.limit(0)], F.col("k"), 5))
    assert [t.count() for t in empty] == [0] and empty[0].columns == rows.columns


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = local.getAllBlocks()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if "shuffle" in str(blocks.apply(i))}

    before = shuffles()
    rows = spark.range(5_000).select(F.col("id").cast("int").alias("k"), F.lit(day(1)).alias("d"),
                                     F.hash("id").alias("v"), F.lit(load(1)).alias("ts"))
    sinks.fact_partition_layout(rows, "d", str(tmp_path / "f"))
    for _ in range(50):     # files go beside the next work
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before
    assert all(".zstd." in p.name for p in (tmp_path / "f").rglob("part-*"))
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "snappy"


def test_models_in_parts_equal_whole_ones(spark, small_dir, monkeypatch):
    t = Inputs(spark, small_dir)
    assert t.parts("stg_flights").count == 1
    whole = {n: sorted(map(repr, t[n].collect())) for n in ("stg_reviews", "fct_flights")}
    counts = sorted(map(tuple, QUERIES["check_while_writing"](spark, small_dir).collect()))
    monkeypatch.setattr(parts, "PART_BYTES", 100_000)
    for name, rows in whole.items():
        made = t.parts(name)
        got = [list(map(repr, part.collect())) for part in made.frames]
        assert made.count > 1 and len(got) > 1
        assert sorted(sum(got, [])) == rows
    written = []
    monkeypatch.setattr(q_writes, "append_part", lambda df, path: written.append(path) or parts.append_part(df, path))
    assert sorted(map(tuple, QUERIES["check_while_writing"](spark, small_dir).collect())) == counts
    assert len(written) > 3 and len(set(written)) == 3
    rules = {r for n in ("stg_reviews", "stg_stay_bookings", "stg_flights") for r in quality.rule_counts(n)}
    assert {r for r, _ in counts} == rules
    stored_rows = spark.read.parquet(next(p for p in written if "stg_reviews" in p))
    assert sorted(map(repr, stored_rows.collect())) == whole["stg_reviews"]


def test_the_bucketed_layout_in_parts_gives_the_mart(spark, small_dir, monkeypatch):
    whole = sorted(map(repr, QUERIES["mart_traveler_disruption"](spark, small_dir).collect()))
    monkeypatch.setattr(parts, "PART_BYTES", 100_000)
    rounds = []
    monkeypatch.setattr(sinks, "fact_bucket_layout",
                        lambda *a, made=sinks.fact_bucket_layout: rounds.append(a[2]) or made(*a))
    assert sorted(map(repr, QUERIES["fact_bucket_layout"](spark, small_dir).collect())) == whole
    assert len(rounds) > 2 and len(set(rounds)) == 2
