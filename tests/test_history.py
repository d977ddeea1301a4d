"""Validity over many snapshots, batches merged once, loads that forget and pack."""

import datetime as dt
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.operators import upsert
from wayline.sources import files, sinks
from wayline.streaming import merge

TEXT = T.StructType([T.StructField(c, T.StringType()) for c in "ab"])


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def plain_history(snaps, check, history=()):
    """Plain dictionaries: (key, row, from, to) after each snapshot {key: row}."""
    closed = [h for h in history if h[3] is not None]
    held = {h[0]: (h[1], h[2]) for h in history if h[3] is None}
    for stamp, rows in snaps:
        for k in list(held):
            if k not in rows or any(rows[k][c] != held[k][0][c] for c in check):
                row, since = held.pop(k)
                closed.append((k, row, since, stamp))
        for k, row in rows.items():
            held.setdefault(k, (row, stamp))
    return sorted(closed + [(k, r, s, None) for k, (r, s) in held.items()], key=str)


def collected(df):
    return sorted(((r["k"], (r["price"], r["name"]), r["valid_from"], r["valid_to"]) for r in df.collect()), key=str)


def test_many_snapshots_beside_plain_steps(spark):
    draw = random.Random(11)
    schema = "k int, price int, name string, taken date"

    def snapshot(n):
        return {k: (draw.choice([1, 2, None]), f"n{n}") for k in [None, *range(40)] if draw.random() < 0.7}

    snaps = [(day(n), {} if n == 4 else snapshot(n)) for n in range(9)]
    stamped = spark.createDataFrame([(k, *row, s) for s, rows in snaps for k, row in rows.items()], schema)
    whole = upsert.scd2_snapshots(stamped, "k", ["price"], "taken", [s for s, _ in snaps])
    want = plain_history(snaps, [0])
    assert collected(whole) == want
    # in two runs, the second on the history of the first; the last snapshot again changes nothing
    early, late = [s for s, _ in snaps[:5]], [s for s, _ in snaps[5:]]
    history = upsert.scd2_snapshots(stamped, "k", ["price"], "taken", early)
    assert collected(history) == plain_history(snaps[:5], [0])
    history = upsert.scd2_snapshots(stamped, "k", ["price"], "taken", late, history)
    assert collected(history) == want
    last = stamped.filter(F.col("taken") == F.lit(day(8))).drop("taken")
    assert collected(upsert.scd2_snapshot(history, last, "k", ["price"], day(8))) == want
    assert upsert.scd2_snapshots(stamped.limit(0), "k", ["price"], "taken", early).count() == 0


def test_history_is_read_once_and_shuffled_once(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 3, "x", day(i % 4)) for i in range(200)], "k int, price int, name string, taken date")
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    upsert.scd2_snapshots(stored, "k", ["price"], "taken", [day(0)]).write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    df = upsert.scd2_snapshots(stored, "k", ["price"], "taken", [day(n) for n in range(1, 4)], history)
    plan = df._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert initial.count("FileScan parquet") == 2 and "Join" not in initial
    assert initial.count("Exchange hashpartitioning") == 1


def test_replayed_batches_are_skipped(spark, tmp_path):
    target, state = str(tmp_path / "fact"), str(tmp_path / "state")
    schema = "k int, d date, v string, t int"
    first = [(1, day(0), "a", 1), (2, day(40), "b", 1), (1, day(3), "c", 2)]
    args = (target, ["k"], "t", "d", state)

    def rows():
        return sorted(tuple(r) for r in sinks.read_fact(spark, target).select("k", "d", "v", "t").collect())

    assert merge.merge_batch(spark.createDataFrame(first, schema), 0, *args)
    want = rows()
    assert want == [(1, day(3), "c", 2), (2, day(40), "b", 1)]
    # a replay in another order is skipped, whatever it holds
    assert not merge.merge_batch(spark.createDataFrame(first[::-1], schema), 0, *args)
    assert not merge.merge_batch(spark.createDataFrame([(9, day(0), "z", 9)], schema), 0, *args)
    assert rows() == want
    # killed between the merge and its entry: the replay merges again and changes nothing
    second = spark.createDataFrame([(1, day(60), "d", 3), (3, day(0), "e", 1)], schema)
    sinks.merge_into_partitions(second, target, ["k"], "t", "d")
    after = rows()
    assert not merge.committed(spark, target, state, 1)
    assert merge.merge_batch(second.orderBy(F.desc("k")), 1, *args) and rows() == after
    assert not merge.merge_batch(second, 1, *args)
    # the same number of another stream is another batch
    assert merge.merge_batch(spark.createDataFrame([(4, day(0), "f", 1)], schema), 0, *args[:-1], state + "2")
    assert len(rows()) == 4
    ledger = merge.read_batches(spark, target)
    assert sorted((r["batch"], r["rows"]) for r in ledger.collect()) == [(0, 1), (0, 3), (1, 2)]


def test_stream_that_dies_after_its_merge(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "fact", "state"))
    schema = "k int, d date, v string, t int"
    spark.createDataFrame([(1, day(0), "a", 1), (2, day(1), "b", 1)], schema).write.parquet(source)
    calls = []

    def start(step):
        stream = spark.readStream.schema(schema).parquet(source)
        return merge.stream_merge_upsert(stream, target, ["k"], "t", "d", state, step)

    def dies(*args):
        calls.append(merge.merge_batch(*args))
        raise RuntimeError("killed before the stream's own commit")

    with pytest.raises(Exception):
        start(dies).awaitTermination()
    before = sorted(os.listdir(target))

    def again(*args):
        calls.append(merge.merge_batch(*args))
        return calls[-1]

    start(again).awaitTermination()
    assert calls == [True, False] and sorted(os.listdir(target)) == before
    assert sinks.read_fact(spark, target).count() == 2


def test_ledger_keeps_the_last_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "KEPT_BATCHES", 2)
    args = (str(tmp_path / "fact"), ["k"], "t", "d", "state")
    one = spark.createDataFrame([(1, day(0), 1)], "k int, d date, t int")
    assert [merge.merge_batch(one, n, *args) for n in (0, 1, 2, 0, 1)] == [True, True, True, False, False]
    assert merge.read_batches(spark, args[0]).count() == 2


def write_gz(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(text)


def at(n):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=n)


def dated(path, when):
    os.utime(path, (when.timestamp(), when.timestamp()))


def test_load_pattern_and_expiry(spark, tmp_path):
    src, target, history = (str(tmp_path / n) for n in ("src", "bronze", "history"))

    def load(n, **options):
        return files.load_incremental_files(spark, src, target, history, TEXT, at(n), **options)

    def count():
        return files.read_bronze(spark, target, TEXT).count()

    write_gz(f"{src}/one.csv.gz", "a,b\n1,x\n")
    (tmp_path / "src" / "README.txt").write_text("not a table")
    dated(f"{src}/one.csv.gz", at(0))
    assert load(0) == 1 and load(1) == 0 and count() == 1
    write_gz(f"{src}/two.csv.gz", "a,b\n2,y\n")
    dated(f"{src}/two.csv.gz", at(80))
    assert load(81) == 1 and count() == 2
    # the state of the first file is forgotten now, but it is too old to be loaded again
    assert [f.name for f in files.list_folders(spark, history) if "day" in f.name] == ["day=2024-03-22"]
    assert load(82) == 0 and count() == 2
    # an old file that arrives late can't be told from a forgotten one
    write_gz(f"{src}/three.csv.gz", "a,b\n3,z\n")
    dated(f"{src}/three.csv.gz", at(2))
    assert load(83) == 0
    assert load(83, pattern=".*three[.]csv[.]gz", load_uncertain=True) == 1 and count() == 3
    # in a table first loaded lately an old file is a new one
    assert files.load_incremental_files(spark, src, str(tmp_path / "b2"), str(tmp_path / "h2"), TEXT, at(90)) == 3


def parts(target):
    return [n for n in os.listdir(target) if n.startswith("_file_state=")]


def test_pack_raw(spark, tmp_path):
    src, target, history = (str(tmp_path / n) for n in ("src", "bronze", "history"))
    for i in range(30):
        write_gz(f"{src}/f{i}.csv.gz", f"a,b\n{i},x\n{i},y\n")

    def load(history_=history, n=1):
        return files.load_incremental_files(spark, src, target, history_, TEXT, at(n))

    def rows():
        return sorted(tuple(r) for r in files.read_bronze(spark, target, TEXT).collect())

    assert load() == 30 and len(parts(target)) == 30
    want = rows()
    assert files.pack_raw(spark, target, TEXT) == 30 and len(parts(target)) == 1 and rows() == want
    assert load() == 0 and files.pack_raw(spark, target, TEXT) == 0
    # a lost history does not load packed states twice
    assert load(str(tmp_path / "lost")) == 30 and rows() == want
    write_gz(f"{src}/f3.csv.gz", "a,b\n3,rewritten\n")
    assert load(n=2) == 1 and len(rows()) == 61
    assert files.pack_raw(spark, target, TEXT) == 2 and len(rows()) == 61 and len(parts(target)) == 1


@pytest.mark.parametrize("dies_at", ["before the note", "after the note", "half removed"])
def test_pack_that_dies_is_finished(spark, tmp_path, monkeypatch, dies_at):
    src, target, history = (str(tmp_path / n) for n in ("src", "bronze", "history"))
    for i in range(6):
        write_gz(f"{src}/f{i}.csv.gz", f"a,b\n{i},x\n")
    files.load_incremental_files(spark, src, target, history, TEXT, at(1))
    want = sorted(tuple(r) for r in files.read_bronze(spark, target, TEXT).collect())
    real, removed = files.remove_path, []
    if dies_at == "before the note":
        monkeypatch.setattr(files, "PACKED_TYPES", "not a type")
    elif dies_at == "after the note":
        finish, calls = files._finish_packing, []
        monkeypatch.setattr(files, "_finish_packing", lambda *a: calls.append(1) or (finish(*a) if len(calls) == 1 else 1 / 0))
    else:
        monkeypatch.setattr(files, "remove_path", lambda s, p: removed.append(p) or (real(s, p) if len(removed) < 3 else 1 / 0))
    with pytest.raises(Exception):
        files.pack_raw(spark, target, TEXT)
    monkeypatch.undo()
    files.pack_raw(spark, target, TEXT)
    assert sorted(tuple(r) for r in files.read_bronze(spark, target, TEXT).collect()) == want and len(parts(target)) == 1
    assert not os.listdir(f"{target}/_packing")
