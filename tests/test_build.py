"""The whole build over derived raw tables: twice, and in two loads."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from wayline.operators import enrichment
from wayline.operators.checks import assert_passed, check_reconcile
from wayline.plans import build as plan
from wayline.plans import load, review_jobs
from wayline.sources.schemas import RAW_COLUMNS
from wayline.workload.views import Inputs


@pytest.fixture(scope="module")
def built(spark, small_dir, tmp_path_factory):
    t = Inputs(spark, small_dir)
    raw = {}
    for name, columns in RAW_COLUMNS.items():
        df = t[f"raw_{name}"]
        kept = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns.split()]
        folder = str(tmp_path_factory.mktemp("raw") / name)
        df.select(*kept, "_source_file", F.col("_loaded_at").cast("timestamp").alias("_loaded_at")).write.parquet(folder)
        raw[name] = spark.read.parquet(folder)
    seeds = {n: t[n] for n in ("cities", "city_airports", "airlines", "airport_code_aliases")}
    seeds["fx_rates_daily"] = t["fx_rates"]
    span = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))

    def run(root, part=None):
        some = raw if part is None else {n: df.filter(part) for n, df in raw.items()}
        # the derived inputs break a few rules, see below; the report is stored all the same
        return plan.build(spark, root, some, seeds, dt.date(2025, 6, 30), t["enrichments"], span, stop=False)

    return run, raw, tmp_path_factory


def rows(df):
    return sorted(map(str, df.collect()))


def test_two_loads_give_the_tables_of_one(spark, built, small_dir):
    run, raw, tmp = built
    root = str(tmp.mktemp("split"))
    early = F.col("_loaded_at") < F.lit(dt.datetime(2024, 1, 15))
    run(root, early)
    tables = run(root)
    direct = Inputs(spark, small_dir)
    assert len(tables["dim_date"].collect()) == 366
    for name in ("fct_stay_bookings", "fct_flight_bookings"):
        drop = "_loaded_at"
        assert rows(tables[name].select(sorted(tables[name].columns)).drop(drop)) == rows(
            direct[name].select(sorted(direct[name].columns)).drop(drop))
    for name in ("mart_city_revenue", "mart_user_cohorts", "mart_review_insights"):
        assert rows(tables[name].select(sorted(tables[name].columns))) == rows(
            direct[name].select(sorted(direct[name].columns)))

    report = {r["check_name"]: r for r in tables["checks"].collect()}
    assert len(report) > 60 and report["facts reconcile with raw"]["status"] == "pass"
    with pytest.raises(AssertionError):
        assert_passed(tables["checks"])
    failed = {n for n, r in report.items() if r["status"] == "fail"}
    # known properties of the derived inputs: few suppliers at this size, one missing rate month
    assert all(r.endswith("parent") or r == "fct_stay_bookings.total_amount_usd not null" for r in failed), failed
    assert check_reconcile({"stays": (raw["stay_bookings"], "stay_booking_id", tables["fct_stay_bookings"]),
                            "legs": (raw["flight_bookings"], "flight_booking_id",
                                     tables["fct_flight_bookings"])}).count() == 0

    # the same listings twice: one open row each, none closed
    history = tables["listing_history"]
    assert history.filter("valid_to is null").count() == tables["stg_listings"].count() == history.count()

    # review jobs over the stored tables, twice
    rule = enrichment.word_rule(["anat"], ["there"], {"by": "location"}, ["late"])
    first = review_jobs.enrich_reviews(spark, root, tables, rule, 20)
    second = review_jobs.enrich_reviews(spark, root, tables, rule, 20)
    ids = [r["review_id"] for r in second.collect()]
    assert 0 < first.count() <= len(ids) == len(set(ids))
    for run_number in (1, 2):
        made = review_jobs.embed_reviews(spark, root, tables, enrichment.hashed_words(8), "hashed", 40,
                                         dt.datetime(2024, 1, run_number), 8)
        ids = [r["review_id"] for r in made.collect()]
        assert ids and len(ids) == len(set(ids))


def test_load_step(spark, tmp_path):
    import gzip
    import os
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    os.makedirs(f"{source}/countries")
    names = RAW_COLUMNS["countries"].split()
    for n in (1, 2):
        with gzip.open(f"{source}/countries/{n}.csv.gz", "wt") as f:
            f.write(",".join(names) + "\n" + ",".join(f"v{n}" for _ in names) + "\n")
    for day in (1, 2):
        raw = load.load_all(spark, source, root, dt.datetime(2024, 1, day), "open", ["countries", "users"])
        assert raw["countries"].count() == 2 and raw["users"].count() == 0
        manifest = load.read_version(spark, f"{root}/manifest").collect()
        assert sorted(r["rows"] for r in manifest) == [1, 1] and all(r["bytes"] > 0 for r in manifest)


def test_versions_survive_a_lost_write(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3):
        load.write_version(spark.range(n), path)
    spark.range(9).write.parquet(f"{path}/v=4")
    import os
    os.remove(f"{path}/v=4/_SUCCESS")  # a write that did not end
    assert load.read_version(spark, path).count() == 3
    assert load.write_version(spark.range(5), path).count() == 5


def test_staging_methods_stay_small_enough_to_be_compiled(spark, small_dir):
    from wayline.workload.views import Inputs
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("stg_flights", "fct_flights"):
            plan = Inputs(spark, small_dir)[name]._jdf.queryExecution()
            text = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000, (name, sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_text_without_a_digit_is_no_number(spark):
    from wayline.functions import casts
    texts = [None, "", "n/a", "-", ".", "12.00", " 7 ", "1e2", "+3", "٣", "99999999999", "-0.5", "NaN", "1x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", casts.cast_try_int(F.col("t")).alias("n"), casts.cast_numeric_flag(F.col("t")).alias("f"),
                      casts.cast_try_number(F.col("t"), 14, 2).alias("d"))
    want = rows.select("i", F.round(F.col("t").try_cast("decimal(10,2)"), 0).try_cast("int").alias("n"),
                       F.coalesce(F.col("t").try_cast("decimal(10,2)") == 1, F.lit(False)).alias("f"),
                       F.col("t").try_cast("decimal(14,2)").alias("d"))
    assert got.orderBy("i").collect() == want.orderBy("i").collect()
    assert "RLIKE" in got._jdf.queryExecution().toString().upper()
