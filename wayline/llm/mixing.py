"""Mixing sources to target weights by capped water-filling; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.common import stored, word_count
from wayline.operators.ranking import rank_rows

#: Slices of the seeded order of a source; only one slice of each source is sorted row by row.
SLICES = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0,
                   max_epochs: float = 3.0) -> DataFrame:
    """Target of each source: ``share`` of all sizes dealt by weight, clamped at ``max_epochs`` times its size.

    ``sizes`` has one row per source: source, source_size. Sources take the weights in turn by code point
    order, NULL last. Water-filling: sources whose part lies above their cap are clamped, what is left is
    dealt by weight to the others, until no part is above. Each round is one aggregate over the sources;
    it ends because every round clamps at least one more source. If all are clamped, targets are the caps.
    """
    ranked = rank_rows(sizes, [], [F.col("source").asc_nulls_last()], rank="at")
    ladder = F.array(*[F.lit(float(w)) for w in weights])
    weighed = stored(ranked.select(
        "source", "source_size", (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"),
        F.get(ladder, ((F.col("at") - 1) % len(weights)).cast("int")).alias("weight")), "mix-sources")
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    # a source is clamped exactly if cap / weight lies at or below the level the rest is filled to
    level, clamped = -1.0, -1
    while True:
        state = weighed.agg(
            F.sum(F.when(F.col("cap") / F.col("weight") <= level, F.col("cap"))).alias("full"),
            F.sum(F.when(F.col("cap") / F.col("weight") <= level, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(F.col("cap") / F.col("weight") <= level, 1)).alias("n")).first()
        left, open_weight = total - (state.full or 0.0), state.open or 0.0
        if state.n == clamped or open_weight == 0.0:
            break
        clamped, level = state.n, left / open_weight
    target = F.when(F.col("cap") / F.col("weight") <= level, F.col("cap"))
    if open_weight:
        target = target.otherwise(F.lit(left) * F.col("weight") / F.lit(open_weight))
    else:
        target = F.col("cap")
    return weighed.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
                weights: Sequence[float] = (5, 2, 1), share: float = 1.0, max_epochs: float = 3.0,
                seed: str = "mix") -> DataFrame:
    """One row per document: how many of its words the mix takes (repeats counted).

    With r = target / size of the source, every document is taken floor(r) times whole. The fractional rest
    goes to the documents that come first in a seeded order: whole ones until the next would overshoot;
    that one is taken in part (its first words), so a source's taken words equal its target rounded down.
    The order is that of sha256(seed, id), so reruns agree. No document is taken more than ``max_epochs`` times.

    A NULL text has size 0, a NULL source is a source of its own (last in order), a NULL id hashes as empty.
    Repeated rows are ordinary rows. Other columns are not read. An empty table gives an empty table.

    Only per-source sums and one of 4096 slices of each source are ordered; a source holding most of the
    rows is never sorted in one task as a whole.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    sized = stored(docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
                               word_count(F.col(text_column)).alias("size"), F.substring(digest, 1, 16).alias("draw")),
                   "mix-sizes")
    slices = sized.groupBy("source", F.conv(F.substring("draw", 1, 3), 16, 10).cast("int").alias("slice")).agg(
        F.sum("size").alias("words"))
    slices = stored(slices, "mix-slices")
    targets = source_targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share,
                             max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = stored(targets.withColumn("epochs", whole.cast("long")).withColumn(
        "rest", F.floor("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    # the slice in which the rest runs out: at most 4096 rows for each source
    order = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    upto = slices.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    cuts = upto.alias("s").join(targets.alias("t"), same).filter(
        (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest"))).select(
        F.col("s.source").alias("source"), F.col("slice").alias("cut"), "before")
    plan = stored(targets.alias("t").join(cuts.alias("s"), same, "left").select(
        "t.source", "source_size", "target", "epochs", "rest", "cut", "before"), "mix-plan")
    rows = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        "doc_id", "d.source", "size", "draw", "source_size", "target", "epochs", "rest", "cut", "before",
        F.conv(F.substring("draw", 1, 3), 16, 10).cast("int").alias("slice"))
    rest = F.when(F.col("slice") < F.col("cut"), F.col("size")).otherwise(F.lit(0))
    clear = rows.filter(F.col("cut").isNull() | (F.col("slice") != F.col("cut"))).select(
        "doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + rest).alias("taken"))
    inside = Window.partitionBy("source").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = rows.filter(F.col("slice") == F.col("cut")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), room))).alias("taken"))
    return clear.unionByName(cut)
