"""The learned review classifier on labelled documents."""

import pytest
from pyspark.sql import functions as F

from wayline.operators import enrichment, review_model
from wayline.workload.views import Inputs


def test_held_out_accuracy_is_above_the_majority(spark):
    t = Inputs(spark, "/root/testdata/sf0.1")
    texts = t["documents"].select(F.col("doc_id").alias("review_id"), F.col("text").alias("comment_text"))
    rows = t["enrich_rows"].select("review_id", "sentiment").join(texts, "review_id")
    held = F.crc32(F.col("review_id").cast("string")) % 4 == 2
    model = review_model.fit_sentiment(rows.filter(~held))
    found = enrichment.enrich_classify(rows.filter(held), review_model.learned_rule(model, {}, []))
    got = review_model.held_out_report(found.withColumnRenamed("sentiment", "found"), rows.filter(held)).first()
    assert got["held_out"] == got["judged"] > 900
    assert got["right"] / got["held_out"] >= got["majority"] / got["held_out"] + 0.05
    weights = model.stages[-1].coefficientMatrix.toArray()
    assert (weights != 0).any(axis=0).sum() < 2000          # the model is sparse


def test_records_of_the_rule(spark):
    rows = spark.createDataFrame(
        [(i, "fine room by the sea" if i % 2 else "awful late noise", "positive" if i % 2 else "negative") for i in range(40)]
        + [(90, None, "positive"), (91, "fine", None), (92, "fine", "angry")],
        "review_id long, comment_text string, sentiment string")
    model = review_model.fit_sentiment(rows, cells=256, penalty=0.06)
    rule = review_model.learned_rule(model, {"sea": "location"}, ["late"])
    new = spark.createDataFrame([(1, "fine sea"), (2, "awful late"), (3, None), (3, None), (4, ""), (5, "fine " * 50_000)],
                                "review_id long, comment_text string").withColumn("_cells", F.lit("mine"))
    got = enrichment.enrich_classify(new, rule)
    assert got.columns == enrichment.enrich_classify(new, enrichment.word_rule([], [], {}, [])).columns
    by_id = {r["review_id"]: r for r in got.collect()}
    assert got.count() == 6 and by_id[1]["sentiment"] == "positive" == by_id[5]["sentiment"]
    assert by_id[1]["topics"] == ["location"] and by_id[1]["complaint"] is None and by_id[1]["sentiment_score"] > 0
    assert by_id[2]["sentiment"] == "negative" and by_id[2]["complaint"] and by_id[2]["mentions_travel_disruption"]
    assert by_id[3]["sentiment"] == by_id[4]["sentiment"]
    assert enrichment.enrich_classify(new.limit(0), rule).count() == 0
    with pytest.raises(ValueError, match="no labelled"):
        review_model.fit_sentiment(rows.filter("review_id > 90"))
