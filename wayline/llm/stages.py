"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame, over all rows of ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayline.llm import language, leaks, lines, mixing, neardup
from wayline.llm.common import fresh_names, row_key, table

#: A document goes if the regression of its language, which learned 1 for its texts and 0 for others, gives less than this; so do
#: those without a letter. The output does not depend on the number of languages. On the 51,282 documents of the
#: check's small tables the lowest clean ones, of three to five words, give 0.30 and half-and-half texts 0.37.
LEAST_LANGUAGE_OUTPUT = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; those without letters or of unclear language go.

    NULL, empty and letterless texts go, and so does everything if no document is labelled. Texts are read whole, however long;
    repeated rows get one verdict, so all stay or go. An empty table stays empty. Columns of any name stay as they are.
    """
    trains = language.remainder(F.col("doc_id"), 4) != 2
    model = language.fit_language_model(docs, trains)
    named, score, output = fresh_names(docs, "lang_pred", "score", "output")
    scored = language.predict_language(docs, model, docs.columns, as_names=(named, score, output))
    return scored.filter((F.col(named) != language.UNDETERMINED)
                         & (F.col(output) >= LEAST_LANGUAGE_OUTPUT)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs; n_chars follows the text.

    No row goes. NULL texts stay NULL, with n_chars NULL; rows equal in id and text lose the same lines. An empty table stays
    empty.
    """
    kept = lines.drop_recurring_lines(docs, counts=tuple(fresh_names(docs, "n_lines", "n_dropped")))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates.

    Repeated rows are one class, of which the first by (lang, source) stays; which class member stays does not depend on
    the order of rows. A text without words (NULL, empty) is a class of its own and stays. Columns of any name stay as they are.
    """
    own, kept_key, nth = fresh_names(docs, "own", "kept_key", "nth")
    kept = neardup.near_duplicate_classes(docs).filter("kept").select(F.col("key").alias(kept_key))
    joined = docs.withColumn(own, row_key(F.col("doc_id"), F.col("text"))).join(kept, F.col(own) == F.col(kept_key))
    first = Window.partitionBy(own).orderBy("lang", "source")
    return joined.withColumn(nth, F.row_number().over(first)).filter(F.col(nth) == 1).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; NULL and empty texts stay, equal rows stay or go together."""
    return leaks.drop_leaking(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each remaining document the mix takes, with the sources' targets.

    One row per row: NULL and empty texts take none, repeated rows are taken on their own, a NULL source is a source.
    """
    return mixing.mix_sources(docs)
