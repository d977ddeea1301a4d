"""Line dedup by a log-template tree of fixed depth; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import WORD_GAP, fresh_names, join_counted, row_key, stored, word_count

#: What stands for a variable field in a template.
FIELD = "<*>"


#: Cells of the filter that picks the lines of open leaves from the scan; its size is bounded by this number.
LEAF_CELLS = 1 << 20


def plain_line(line: Column) -> Column:
    """The tokens of a line joined by one space, those with a digit as variable fields."""
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ") | line.rlike("[\\x09-\\x0D]")
    return _masked(F.when(odd, F.trim(F.regexp_replace(line, WORD_GAP, " "))).otherwise(line))


def _masked(line: Column) -> Column:
    return F.when(line.rlike("[0-9]"), F.regexp_replace(
        line, "[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*+", FIELD)).otherwise(line)


def _lines(docs: DataFrame, id_column: str, text_column: str, depth: int) -> DataFrame:
    """key, at, plain, words, leaf, line (hash) of every line.

    Lines are made plain inside the array, before it is laid out: what follows then reads a column instead of
    computing the line anew for every use.
    """
    plain = F.transform(F.split(F.coalesce(F.col(text_column), F.lit("")), "\n"), plain_line)
    rows = docs.select(row_key(F.col(id_column), F.col(text_column)).alias("key"),
                       F.posexplode(plain).alias("at", "plain")).filter("plain != ''")
    words = F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1
    return rows.select("key", "at", "plain", words.alias("words"),
                       F.xxhash64(words, F.substring_index("plain", " ", depth)).alias("leaf"),
                       F.xxhash64("plain").alias("line"))


def line_templates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = 3,
                   min_docs: int = 3, min_tokens: int = 3, similarity: float = 0.7) -> DataFrame:
    """Places of lines whose template recurs: key (hash of id and text), at (line number), words.

    The tree's levels are the token count and the first ``depth`` tokens, tokens with a digit counting as
    variable. In a leaf, a token is constant if at least ``min_docs`` documents of the leaf have it at that
    place; all others are variable fields. Lines get their template by that; if at least ``similarity`` of the
    tokens behind the leading ones are constant and ``min_docs`` documents share the template, it recurs. A
    line that recurs as it stands needs no generalising. Lines under ``min_tokens`` tokens never recur.

    Lines are counted as hashes, once per document. Only leaves that several different lines of enough
    documents share are open to generalising; a broadcast set of at most ``LEAF_CELLS`` hash cells picks their
    lines from the stored ones, which only then are spelled out, once each. Very frequent lines are joined by
    broadcasting their hashes.
    """
    lines = stored(_lines(docs, id_column, text_column, depth).filter(F.col("words") >= min_tokens), "lines")
    # one row per document and line
    once = lines.select("key", "leaf", "line", "words").distinct()
    counted = stored(once.groupBy("leaf", "line", "words").agg(F.count(F.lit(1)).alias("docs")), "line-counts")
    same = counted.filter(F.col("docs") >= min_docs).select("line", "docs")
    open_leaves = stored(counted.filter(F.col("words") > depth).groupBy("leaf").agg(
        F.sum("docs").alias("all"), F.count(F.lit(1)).alias("kinds"), F.min("docs").alias("least")).filter(
        (F.col("all") >= min_docs) & (F.col("kinds") > 1) & (F.col("least") < min_docs)).select("leaf"), "line-leaves")
    cell = F.pmod(F.col("leaf"), F.lit(LEAF_CELLS)).alias("cell")
    cells = open_leaves.select(cell).distinct()
    spelled = lines.filter(F.col("words") > depth).select("leaf", "line", "plain", cell).join(
        F.broadcast(cells), "cell", "left_semi")
    wanted = counted.join(open_leaves, "leaf", "left_semi").select("line", "docs")
    texts = stored(spelled.groupBy("line", "leaf").agg(F.first("plain").alias("plain")).join(wanted, "line").select(
        "line", "leaf", "docs", F.split("plain", " ").alias("tokens")), "line-texts")
    laid = texts.select("line", "leaf", "docs", F.posexplode("tokens").alias("place", "token"))
    constant = laid.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("n")).filter(F.col("n") >= min_docs)
    fixed = laid.join(constant.select("leaf", "place", "token"), ["leaf", "place", "token"]).groupBy("line").agg(
        F.sort_array(F.collect_list(F.struct("place", "token"))).alias("fixed"))
    known = texts.join(fixed, "line").select(
        "line", "leaf", "docs", F.size("tokens").alias("words"), F.xxhash64("fixed").alias("template"),
        F.size(F.filter("fixed", lambda f: f["place"] >= depth)).alias("same"))
    near = known.filter(F.col("same") >= F.lit(similarity) * (F.col("words") - depth))
    recurring = near.groupBy("leaf", "template").agg(F.sum("docs").alias("all")).filter(F.col("all") >= min_docs)
    similar = near.join(recurring, ["leaf", "template"]).select("line", "docs")
    flagged = stored(same.unionByName(similar).groupBy("line").agg(F.max("docs").alias("docs")), "line-flagged")
    return join_counted(lines.select("key", "at", "words", "line"), flagged, "line", "docs").select(
        "key", "at", "words")


def drop_recurring_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = 3,
                         min_docs: int = 3, min_tokens: int = 3, similarity: float = 0.7,
                         max_loss: float = 0.3, counts: tuple[str, str] = ("_n_lines", "_n_dropped")) -> DataFrame:
    """All columns of ``docs`` with the text lacking its recurring lines, plus two ``counts``: lines and dropped lines.

    Lines end at \\n. All lines with a recurring template go (see ``line_templates``), unless they hold more
    than ``max_loss`` of a document's words: such a document is a copy of others rather than a page with
    boilerplate, stays as it is and is left to document-level dedup.

    A NULL text stays NULL with one (empty) line. Rows equal in id and text are one document, met once, and lose the
    same lines. Other columns pass through, whatever their names; one named like a count is replaced. Empty tables give
    empty tables.
    """
    key = row_key(F.col(id_column), F.col(text_column))
    found = line_templates(docs, id_column, text_column, depth, min_docs, min_tokens, similarity)
    # equal rows share a key: their places are the same, hence the set; it is as long as the document's lines
    own, key_name, places_name, gone_name = fresh_names(docs, "own", "key", "places", "gone_at")
    places = found.groupBy(F.col("key").alias(key_name)).agg(
        F.collect_set(F.struct("at", "words")).alias(places_name))
    joined = docs.withColumn(own, key).join(places, F.col(own) == F.col(key_name), "left")
    body = F.coalesce(F.col(text_column), F.lit(""))
    gone = F.aggregate(places_name, F.lit(0), lambda total, p: total + p["words"])
    words = word_count(F.col(text_column))
    gone_at = F.when(F.col(places_name).isNotNull() & (gone <= F.lit(max_loss) * words),
                     F.transform(places_name, lambda p: p["at"]))
    kept = F.filter(F.split(body, "\n"), lambda x, i: ~F.array_contains(gone_name, i))
    return joined.withColumn(gone_name, gone_at).select(
        *[F.when(F.col(gone_name).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text_column)).alias(c)
          if c == text_column else F.col(f"`{c}`") for c in docs.columns if c not in counts],
        F.size(F.split(body, "\n")).cast("long").alias(counts[0]),
        F.coalesce(F.size(gone_name), F.lit(0)).cast("long").alias(counts[1]))
