"""Bucketed facts, rules counted while writing, policy views and named files."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from wayline.operators import enrichment, policies
from wayline.operators.relational import join_inner_equi
from wayline.plans import facts, marts, quality
from wayline.sources import files, sinks
from wayline.workload.views import Inputs

ROWS = "k int, g string, d date, v int, ts timestamp"


def day(month, number=1):
    return dt.date(2024, month, number)


def load(number):
    return dt.datetime(2024, 1, number)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, path):
    return sorted((r["k"], r["g"], r["d"], r["v"]) for r in sinks.read_fact(spark, path).collect())


def test_bucketed_fact_equals_the_plain_one_over_merges(spark, tmp_path):
    batches = [[(k, f"g{k % 5}" if k % 4 else None, day(1 + k % 3), k, load(1)) for k in range(60)],
               [(k, "moved", day(4), -k, load(2)) for k in range(0, 60, 3)],      # empties January
               [(k, "late", day(1), 0, load(1)) for k in range(5)] + [(99, None, None, 9, load(3))], []]
    for batch in batches:
        for name, buckets in (("plain", None), ("bucketed", sinks.Buckets("g", 5))):
            sinks.merge_into_partitions(spark.createDataFrame(batch, ROWS), str(tmp_path / name), ["k"], "ts", "d",
                                        buckets=buckets)
        assert stored(spark, str(tmp_path / "plain")) == stored(spark, str(tmp_path / "bucketed"))
    assert not (tmp_path / "bucketed" / "_month=2024-01").exists() or stored(spark, str(tmp_path / "bucketed"))
    wider = spark.createDataFrame([(7, "g", day(2), 1, load(9), "new")], ROWS + ", extra string")
    got = sinks.merge_into_partitions(wider, str(tmp_path / "bucketed"), ["k"], "ts", "d")
    assert got.filter("extra = 'new'").count() == 1 and got.filter("extra is null").count() == got.count() - 1
    with pytest.raises(ValueError, match="Buckets"):
        sinks.merge_into_partitions(wider, str(tmp_path / "bucketed"), ["k"], "ts", "d", buckets=sinks.Buckets("g", 6))
    with pytest.raises(ValueError, match="None"):
        sinks.merge_into_partitions(wider, str(tmp_path / "plain"), ["k"], "ts", "d", buckets=sinks.Buckets("g", 6))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_heavy_bucket_takes_several_files(spark, tmp_path):
    rows = spark.range(200_000).select(F.col("id").cast("int").alias("k"), F.lit("one").alias("g"),
                                       F.lit(day(1)).alias("d"), F.hash("id").alias("v"), F.lit(load(1)).alias("ts"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        got = sinks.merge_into_partitions(rows, str(tmp_path / "f"), ["k"], "ts", "d", buckets=sinks.Buckets("g", 4))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "f" / "_month=2024-01").glob("*.parquet"))) > 1
    assert got.count() == 200_000


def test_stored_facts_join_on_the_flight_without_a_shuffle(spark, small_dir, tmp_path):
    t = Inputs(spark, small_dir)
    names = ("fct_flights", "fct_flight_bookings")
    held = {}
    for kind, buckets in (("plain", {}), ("bucketed", facts.flight_buckets(12))):
        for name in names:
            key, date, date_in_key = facts.FACT_KEYS[name]
            held[kind, name] = sinks.merge_into_partitions(t[name], str(tmp_path / kind / name), [key], "_loaded_at", date,
                                                           date_in_key, buckets.get(name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {kind: marts.mart_traveler_disruption(held[kind, names[1]], held[kind, names[0]], t["airlines"])
               for kind in ("plain", "bucketed")}
        on_key = r"Exchange hashpartitioning\(flight_id#"
        assert len(re.findall(on_key, plan_of(got["plain"]))) == 2
        assert not re.findall(on_key, plan_of(got["bucketed"])) and "Bucketed: true" in plan_of(got["bucketed"])
        assert sorted(map(str, got["plain"].collect())) == sorted(map(str, got["bucketed"].collect()))
        joined = join_inner_equi(held["bucketed", names[1]].select("flight_id", "leg"),
                                 held["bucketed", names[0]].select("flight_id", "is_cancelled"), "flight_id")
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rules_counted_while_writing_save_the_scans(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, "completed", None), ("b", "u", "lost", None), (None, "u", None, None),
                                  ("a", "u", "cancelled", -1)], "a string, b string, c string, d int").select(
        F.col("a").alias("stay_booking_id"), F.col("b").alias("user_id"), F.col("c").alias("booking_status"),
        F.col("d").cast("decimal(12,2)").alias("total_amount_local"))
    observed, tables = {}, {}
    for name, df in (("stg_stay_bookings", rows), ("stg_users", spark.createDataFrame(
            [], "user_id string, email string, source_reviewer_id string"))):
        watched, seen = quality.observe_rules(name, df)
        watched.write.parquet(str(tmp_path / name))
        observed[name] = seen.get
        tables[name] = spark.read.parquet(str(tmp_path / name))
    plain, saving = quality.quality_report(tables), quality.quality_report(tables, observed)
    scans = [plan_of(r).count("FileScan") for r in (plain, saving)]      # before adaptive execution shows two plans
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, saving.collect()))
    failures = {r["check_name"]: r["failures"] for r in saving.collect()}
    assert failures["stg_stay_bookings.user_id not null"] == 1 and failures["stg_stay_bookings.booking_status allowed"] == 1
    assert failures["stg_stay_bookings.total_amount_local range"] == 1
    assert scans[1] == scans[0] - len(tables)
    # counts that lack a rule are not trusted
    part = {"stg_users": {"stg_users.user_id not null": 0}}
    assert plan_of(quality.quality_report(tables, part)).count("FileScan") == scans[0]
    same, none = quality.observe_rules("no rules", rows)
    assert none is None and same is rows


@pytest.fixture
def role(spark):
    yield lambda name: policies.set_role(spark, name)
    policies.set_role(spark)


def test_one_view_for_all_roles(spark, role):
    stays = spark.createDataFrame([(1, "completed", "a@b.c"), (2, "cancelled", None), (3, None, "x"), (4, "completed", "")],
                                  "id int, booking_status string, `e mail` string")
    first = policies.protected_view(stays, "p_stays", rows=policies.BOOKING_ROWS, masks={"e mail": "email"})
    assert first.count() == 0                                # no role yet
    text, seen = "select * from p_stays order by id", {}
    for name in ("SYSADMIN", "ANALYST_ROLE", "O'Brien"):
        role(name)
        seen[name] = [tuple(r) for r in spark.sql(text).collect()]
        rows = enrichment.row_access_filter(stays, name)
        want = enrichment.column_mask(rows, name, {"e mail": "email"})
        assert seen[name] == sorted(tuple(r) for r in want.collect())
    assert [len(s) for s in seen.values()] == [4, 2, 0]
    role("SYSADMIN")
    held = spark.table("p_stays")
    role("PUBLIC")
    assert held.count() == 4 and spark.table("p_stays").count() == 0      # a DataFrame keeps the role it was made in


def test_policies_reach_the_scan(spark, small_dir, role):
    orders = spark.read.parquet(f"{small_dir}/orders.parquet")
    policies.protected_view(orders, "p_orders", rows={"ANALYST_ROLE": "o_orderstatus = 'O'"})
    role("ANALYST_ROLE")
    assert "EqualTo(o_orderstatus,O)" in plan_of(spark.table("p_orders").select("o_orderkey"))
    role("nobody")
    assert "FileScan" not in plan_of(spark.table("p_orders"))              # not even opened
    with pytest.raises(ValueError, match="mask"):
        policies.protected_view(orders, "p_orders", masks={"o_clerk": "iris", "o_orderkey": "iris"})


def test_exported_files_carry_the_pattern(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1 + i % 3, 5)) for i in range(30)] + [(99, None)], "i int, at timestamp")
    name = "trips_{year}_{month}_{part:03d}.csv.gz"

    def names():
        return sorted(p.name for p in (tmp_path / "out").rglob("*.csv.gz") if not p.name.startswith("."))

    counts = sinks.sink_partitioned_csv(rows, "at", path, names=name)
    assert sum(r["row_count"] for r in counts.collect()) == 31
    assert names() == [f"trips_2024_0{m}_001.csv.gz" for m in (1, 2, 3)] + ["trips_unknown_unknown_001.csv.gz"]
    assert not (tmp_path / "out" / "_staging").exists()
    # a task that fails leaves the old files
    fails = rows.withColumn("i", F.when(F.col("i") == 7, F.raise_error(F.lit("stop"))).otherwise(F.col("i")))
    with pytest.raises(Exception, match="stop"):
        sinks.sink_partitioned_csv(fails, "at", path, names=name)
    assert len(names()) >= 4 and files.scan_staged_csv(spark, f"{path}/year=*/month=*", "i string, at string").count() == 31
    # the next export replaces them all
    sinks.sink_partitioned_csv(rows.filter("month(at) = 2"), "at", path, names=name)
    assert names() == ["trips_2024_02_001.csv.gz"]
    with pytest.raises(ValueError, match="part"):
        sinks.sink_partitioned_csv(rows, "at", path, names="x.csv.gz")
    assert names() == ["trips_2024_02_001.csv.gz"]
