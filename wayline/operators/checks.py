"""Data tests: each returns the failing rows or values; the report counts them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.operators.relational import join_scalar_subqueries


def check_unique(df: DataFrame, column: str) -> DataFrame:
    return check_unique_combination(df.filter(F.col(column).isNotNull()), [column])


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (df.filter(~F.col(column).isin(list(values))).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_rows")))


def check_relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent; NULL passes."""
    known = parent.select(F.col(parent_column).alias(column))
    return df.filter(F.col(column).isNotNull()).select(column).join(known, column, "left_anti")


def check_accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < F.lit(low))
    if high is not None:
        bad = bad | (F.col(column) > F.lit(high))
    return df.filter(bad)


def check_severity_warn(name: str, failures: DataFrame, severity: str = "warn") -> DataFrame:
    """One report row: how many failures, and whether they stop a build."""
    n = F.col("failures")
    status = F.when(n == 0, "pass").otherwise("warn" if severity == "warn" else "fail")
    return failures.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures", status.alias("status"))


def check_reconcile(pairs: Mapping[str, tuple[DataFrame, str, DataFrame]], only_failures: bool = True) -> DataFrame:
    """Distinct raw ids against fact rows; every id must arrive exactly once."""
    report = None
    for name, (raw, raw_id, fact) in pairs.items():
        ids = raw.agg(F.countDistinct(raw_id).alias("raw_ids"))
        rows = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
        one = join_scalar_subqueries([ids, rows]).withColumn("tbl", F.lit(name))
        report = one if report is None else report.unionByName(one)
    return report.filter(F.col("raw_ids") != F.col("fact_rows")) if only_failures else report


def run_checks(checks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One report over many tests: (name -> (failing rows, severity))."""
    report = None
    for name, (failures, severity) in checks.items():
        row = check_severity_warn(name, failures, severity)
        report = row if report is None else report.unionByName(row)
    return report


def assert_passed(report: DataFrame, on_fail: Callable[[str], None] | None = None) -> None:
    """Stop a build on failed tests of severity error; the report has one row per test."""
    failed = [r["check_name"] for r in report.filter(F.col("status") == "fail").collect()]
    if failed:
        if on_fail:
            on_fail(", ".join(failed))
        raise AssertionError("data tests failed: " + ", ".join(failed))
