"""A review classifier fitted on labelled texts: a sparse linear model over the words of a text.

Words are hashed into a fixed number of cells, so neither a vocabulary nor a text reaches the driver; what does is the
model, classes times cells. Each step of the fit is one pass over the labelled rows, summed up in a tree.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.operators.enrichment import SENTIMENTS, word_rule

CELLS = 1 << 14
#: L1 weight for one row, and steps of the fit. The weight falls with the root of the rows, as chance agreement of a cell with
#: a label does: few rows give a model near the most frequent label, many rows one with some hundred cells
PENALTY, STEPS = 0.165, 40
_WORDS, _CELLS, _RAW, _SHARES, _PLACE = "_words", "_cells", "_raw", "_shares", "_place"


def fit_sentiment(labelled: DataFrame, cells: int = CELLS, penalty: float = PENALTY, steps: int = STEPS) -> PipelineModel:
    """Fit on ``comment_text`` and ``sentiment`` of all labelled rows.

    A NULL text is an empty one; rows without a known sentiment take no part, and a table without any is an
    error. Repeated rows weigh as often as they occur. Which words a text holds counts, not how often, so long texts
    don't outweigh short ones.
    """
    place = F.array_position(F.array(*[F.lit(s) for s in SENTIMENTS]), F.col("sentiment")) - 1
    rows = labelled.filter(F.col("sentiment").isin(SENTIMENTS)).select(
        F.coalesce("comment_text", F.lit("")).alias("comment_text"), place.cast("double").alias(_PLACE))
    n = rows.count()
    if n == 0:
        raise ValueError("there are no labelled rows")
    return Pipeline(stages=[
        RegexTokenizer(inputCol="comment_text", outputCol=_WORDS, pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol=_WORDS, outputCol=_CELLS, numFeatures=cells, binary=True),
        LogisticRegression(featuresCol=_CELLS, labelCol=_PLACE, predictionCol="_best", probabilityCol=_SHARES,
                           rawPredictionCol=_RAW, family="multinomial", regParam=penalty / n ** 0.5, elasticNetParam=1.0,
                           maxIter=steps)]).fit(rows)


def learned_rule(model: PipelineModel, topic_words: dict[str, str],
                 disruption: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """A rule for ``enrich_classify``: sentiment and score by the model, the rest of the record by words.

    The score is the probability of "positive" less that of "negative". A negative or mixed text is a complaint.
    """
    n_classes = model.stages[-1].numClasses

    def share(kind: str):
        place = SENTIMENTS.index(kind)
        return F.element_at(_SHARES, place + 1) if place < n_classes else F.lit(0.0)

    def classify(df: DataFrame) -> DataFrame:
        texts = df.select("review_id", F.coalesce("comment_text", F.lit("")).alias("comment_text"))
        judged = model.transform(texts).withColumn(_SHARES, vector_to_array(_SHARES))
        best = F.element_at(F.array(*[F.lit(s) for s in SENTIMENTS]), F.col("_best").cast("int") + 1)
        held = judged.select(F.struct("review_id", best.alias("sentiment"),
                                      F.round(share("positive") - share("negative"), 6).alias("score")).alias("review_id"),
                             "comment_text")
        # the verdict rides along in the id, so the word rule needs no join to be put beside it
        record = word_rule([], [], topic_words, disruption)(held)
        sentiment = F.col("review_id.sentiment")
        return record.withColumns({
            "sentiment": sentiment, "sentiment_score": F.col("review_id.score"),
            "complaint": F.when(sentiment.isin("negative", "mixed"), "negative wording"),
            "review_id": F.col("review_id.review_id")})

    return classify


def held_out_report(records: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row: labelled texts, those with a record whose sentiment and score are valid, those whose sentiment is the
    label, and the texts of the most frequent label (what a constant answer gets right).

    ``records`` holds ``review_id``, once each, ``found`` and ``sentiment_score``."""
    judged = labelled.select("review_id", "sentiment").join(records, "review_id", "left")
    valid = F.col("found").isin(SENTIMENTS) & F.col("sentiment_score").between(-1, 1)
    kinds = judged.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("judged"),
                                            F.count_if(F.col("found") == F.col("sentiment")).alias("right"))
    return kinds.agg(*[F.coalesce(total, F.lit(0)).alias(name) for name, total in (
        ("held_out", F.sum("n")), ("judged", F.sum("judged")), ("right", F.sum("right")), ("majority", F.max("n")))])
