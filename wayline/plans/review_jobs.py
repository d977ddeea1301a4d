"""Batch jobs over stored reviews: choose, run a model, validate, and add to the stored results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.operators import enrichment as job
from wayline.operators.upsert import merge_insert_only
from wayline.sources.schemas import EMBEDDING_TYPES, ENRICHMENT_TYPES
from wayline.sources.sinks import layer_path, read_version, write_version


def _stored(spark: SparkSession, path: str, types: str) -> DataFrame:
    held = read_version(spark, path)
    return spark.createDataFrame([], types) if held is None else held


def enrich_reviews(spark: SparkSession, root: str, tables: Mapping[str, DataFrame],
                   rule: Callable[[DataFrame], DataFrame], limit: int) -> DataFrame:
    """One run of the enrichment job; returns the stored records.

    ``rule`` classifies (review_id, comment_text), see ``word_rule`` and ``per_batch``. Records of ids that were
    not sent, or with unknown values, are dropped; ids of failed batches stay open, so the next run chooses
    them again; records once stored never change.
    """
    path = layer_path(root, "ai", "review_enrichments")
    done = _stored(spark, path, ENRICHMENT_TYPES)
    chosen = job.enrich_candidates(tables["fct_stay_bookings"], tables["stg_reviews"], tables["fct_flight_bookings"],
                                   done, limit).select("review_id", "comment_text").dropDuplicates(["review_id"])
    results = job.enrich_classify(chosen, rule)
    if "error" not in results.columns:
        results = results.withColumn("error", F.lit(None).cast("string"))
    good = job.enrich_validate(results.filter("error is null").drop("error"), chosen)
    fresh = job.enrich_failed_retry(good.withColumn("error", F.lit(None).cast("string")), done.limit(0))
    return write_version(merge_insert_only(done, fresh.select(*done.columns), ["review_id"]), path)


def embed_reviews(spark: SparkSession, root: str, tables: Mapping[str, DataFrame],
                  model: Callable, model_name: str, limit: int, at: dt.datetime, dim: int = 64) -> DataFrame:
    """One run of the embedding job; returns the stored vectors. Every city with listings gets an equal share;
    reviews that have a vector are not chosen again."""
    path = layer_path(root, "ai", "review_embeddings")
    done = _stored(spark, path, EMBEDDING_TYPES)
    enriched = _stored(spark, layer_path(root, "ai", "review_enrichments"), ENRICHMENT_TYPES)
    chosen = job.embed_candidates(tables["stg_reviews"], enriched, done, limit,
                                  job.city_count(tables["stg_listings"]))
    vectors = job.embed_batches(chosen, model, dim=dim).withColumns(
        {"model": F.lit(model_name), "embedded_at": F.lit(at).cast("timestamp")})
    return write_version(merge_insert_only(done, vectors.select(*done.columns), ["review_id"]), path)
