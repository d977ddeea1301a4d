"""Registration of queries with their oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.workload.model_sql import MODEL_SQL
from wayline.workload.views import TABLES, VIEWS, Inputs, dependencies

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Result columns for comparison: exact decimals as doubles, arrays as joined text."""

    def plain(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.when(c.isNotNull(), F.concat_ws(",", c.cast("array<string>"))).alias(field.name)
        return c

    if any(isinstance(f.dataType, (T.DecimalType, T.ArrayType)) for f in df.schema.fields):
        return df.select(*[plain(f) for f in df.schema.fields])
    return df


def expand(sql: str) -> str:
    """Turn ``{name}`` into table names, with every derived table as a common table expression."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        if name in TABLES or name in parts:
            return
        text = MODEL_SQL.get(name) or VIEWS[name]
        for needed in dependencies(text):
            add(needed)
        parts[name] = text

    for name in dependencies(sql):
        add(name)

    def plain(text: str) -> str:
        for name in dependencies(text):
            text = text.replace("{" + name + "}", name)
        return text.strip()

    body = plain(sql)
    if not parts:
        return body
    ctes = ",\n".join(f"{name} as (\n{plain(text)}\n)" for name, text in parts.items())
    joint = ",\n" if body.lower().startswith("with ") else "\n"
    return f"with {ctes}{joint}{body[5:] if body.lower().startswith('with ') else body}"


def query(name: str, oracle: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under a key, with the statement that gives the same rows."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: present(fn(Inputs(spark, sf_dir)))
        if oracle:
            ORACLES[name] = expand(oracle)
        return fn

    return wrap
