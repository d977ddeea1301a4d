"""Benchmark decontamination: windows of typed templates, hash-joined, with a check of slot values."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.common import (arrow_batches, arrow_type, byte_texts, chunked, fresh_names, inside_texts, mix, row_key, slices, stored,
                                window_hashes, word_hashes)

#: Units that make a slot behind a number, and number words.
UNITS = ["mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles", "mg", "g", "kg",
         "gram", "grams", "kilogram", "kilograms", "ounce", "ounces", "pound", "pounds", "ton", "tons", "ml", "l",
         "liter", "liters", "litre", "litres", "gallon", "gallons", "second", "seconds", "minute", "minutes", "hour",
         "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "dollar", "dollars",
         "cent", "cents", "euro", "euros", "degree", "degrees", "meter", "meters", "metre", "metres", "kilometer",
         "kilometers", "kilometre", "kilometres", "mph", "kmh"]
NUMBER_WORDS = ["two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
                "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty",
                "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion"]
#: Words that open sentences and never are names there.
OPENERS = ["a", "an", "the", "this", "that", "these", "those", "it", "its", "he", "she", "they", "we", "you", "i", "his",
           "her", "their", "our", "my", "your", "how", "what", "which", "who", "whom", "whose", "when", "where", "why",
           "if", "then", "so", "and", "but", "or", "as", "at", "by", "for", "from", "in", "of", "on", "to", "with", "after",
           "before", "while", "during", "each", "every", "all", "both", "some", "there", "here", "is", "are", "was", "were",
           "do", "does", "did", "can", "could", "should", "would", "has", "have", "had", "one", "not", "no", "find", "let",
           "suppose", "given", "today", "yesterday", "tomorrow", "later", "also", "now", "assume", "calculate", "name"]
#: Types of slots by code; 0 is an ordinary word.
SLOTS = ["", "number", "name", "unit"]
FILTER_BITS = 1 << 23

_QUOTES = {ord(c): " " for c in "‘’“”–—…«» "}
_WORD_BYTE = np.array([chr(b).isalnum() or b >= 128 for b in range(128)] + [True] * 128)
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LOWER = np.array([97 <= b <= 122 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_STOP = np.array([b in b".!?\n:" for b in range(256)])
_IN_NUMBER = np.array([b in b",./" for b in range(256)])
_IN_WORDS = np.array([b in b" -" for b in range(256)])
_IN_NAME = np.array([b in b" -'" for b in range(256)])


def _bounds(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words as runs of letters, digits and non-ASCII bytes."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    gap = ~_WORD_BYTE[buffer]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([np.zeros(1, dtype=edge.dtype), edge])
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    counts = np.diff(np.searchsorted(edge[0::2], np.concatenate([[0], np.cumsum(sizes)])))
    return buffer, edge[0::2], edge[1::2], counts


def _any(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[ends] > sums[starts]


def _fixed_hashes(words: Sequence[str]) -> np.ndarray:
    buffer, starts, ends, _ = _bounds([w.encode() for w in words])
    return np.sort(word_hashes(buffer, starts, ends))


def _typed(texts: Sequence[bytes], common: np.ndarray | None) -> tuple:
    """(lower-case buffer, starts, ends, words per text, hashes, slots, whether a word goes on with the slot before)."""
    plain = [t.decode().translate(_QUOTES) for t in texts]
    lowered = [t.lower().encode() for t in plain]
    buffer, starts, ends, counts = _bounds(lowered)
    literal = word_hashes(buffer, starts, ends)
    slots = np.zeros(len(starts), dtype=np.int8)
    gap = np.zeros(len(starts), dtype=np.uint8)  # the byte between a word and the one before, if it is a single one
    gap[1:] = np.where(starts[1:] - ends[:-1] == 1, buffer[ends[:-1]], 0)
    shown, s, e, same = _bounds([t.encode() for t in plain])
    if len(s) == len(starts) and (same == counts).all():  # lower-casing may add marks, but never splits words
        opens = np.ones(len(s), dtype=bool)
        opens[1:] = _any(_STOP[shown], e[:-1], s[1:])
        capital = _UPPER[shown[s]] & _any(_LOWER[shown], s, e)
        text = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
        here = mix(literal + text * np.uint64(0x9E3779B97F4A7C15))
        named = np.zeros(len(s), dtype=bool)
        first = np.flatnonzero(capital & opens)
        named[first] = np.isin(here[first], here[capital & ~opens])
        if common is not None:
            named[first] |= ~np.isin(literal[first], common)
        named &= ~np.isin(literal, _fixed_hashes(OPENERS))
        slots[capital & (~opens | named)] = 2
    number = _any(_DIGIT[buffer], starts, ends)
    spoken = np.isin(literal, _fixed_hashes(NUMBER_WORDS))
    # twenty-one; one alone is an ordinary word
    one = np.isin(literal, _fixed_hashes(["one"])) & (gap == 45)
    spoken[1:] |= one[1:] & spoken[:-1]
    slots[number | spoken] = 1
    after = np.concatenate([[False], (number | spoken)[:-1]]) if len(number) else number
    slots[np.isin(literal, _fixed_hashes(UNITS)) & after] = 3
    goes_on = np.zeros(len(starts), dtype=bool)
    if len(starts):
        digit_ends = _DIGIT[buffer[ends[:-1] - 1]] & _DIGIT[buffer[starts[1:]]]
        goes_on[1:] = ((slots[1:] == 1) & (slots[:-1] == 1) & ((_IN_NUMBER[gap[1:]] & digit_ends)
                                                               | (_IN_WORDS[gap[1:]] & spoken[1:])))
        goes_on[1:] |= (slots[1:] == 2) & (slots[:-1] == 2) & _IN_NAME[gap[1:]]
    return buffer, starts, ends, counts, literal, slots, goes_on


def canonical(texts: Sequence[bytes], common: np.ndarray | None = None) -> tuple:
    """Words and template tokens of some texts: (lower-case buffer, starts, ends, words per text, word hashes,
    first word of each token, tokens per text, token hashes, token slots).

    A number is a word with a digit, with its parts behind , . or /, or a run of number words. A unit is a unit word
    right behind a number. A name is a run of capitalised words with a lower-case letter; one that opens a text,
    line or sentence counts if the text also has it capitalised elsewhere or ``common`` (hashes of lower-case words)
    lacks it, and it is none of ``OPENERS``. Each of them is one token, like every other word.
    """
    buffer, starts, ends, counts, literal, slots, goes_on = _typed(texts, common)
    first = np.flatnonzero(~goes_on)
    token_counts = np.diff(np.searchsorted(first, np.concatenate([[0], np.cumsum(counts)])))
    marks = mix(np.arange(1, len(SLOTS) + 1, dtype=np.uint64))
    slots = slots[first]
    template = np.where(slots > 0, marks[slots], literal[first])
    return buffer, starts, ends, counts, literal, first, token_counts, template, slots


def _filter_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes % np.uint64(FILTER_BITS)).astype(np.int64), (hashes >> np.uint64(40)).astype(np.int64) % FILTER_BITS


def _window_rows(columns: int, sizes: Sequence[int], common: Broadcast, wanted: Broadcast | None, schema: pa.Schema):
    """Windows of the texts (last column): (..., at, upto, place, size, kind, hash, window, values, names, words, long).

    ``at`` and ``upto`` count words, ``place`` and ``size`` the tokens of the kind; ``long`` is the text's length in
    these. With a filter only windows it may contain are spelled out. A window without slots has one kind only; one
    with less than a quarter of ordinary words is no template.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, dtype=np.uint8) if wanted is not None else None

        def rows() -> Iterator[tuple]:
            for batch in slices(batches):
                keys = list(zip(*(batch.column(i).to_pylist() for i in range(columns))))
                texts = byte_texts(batch.column(columns))
                for a, b in chunked(texts):
                    buffer, starts, ends, counts, literal, first, tokens, template, slots = canonical(
                        texts[a:b], common.value)
                    data = buffer.tobytes()
                    words_at = np.concatenate([[0], np.cumsum(counts)])
                    last = np.append(first[1:], len(starts))  # the word behind each token
                    filled = np.concatenate([[0], np.cumsum(slots > 0)])
                    for size, kind in ((s, k) for s in sizes for k in ("literal", "template")):
                        hashed, lengths = (literal, counts) if kind == "literal" else (template, tokens)
                        if len(hashed) < size:
                            continue
                        hashes = window_hashes(hashed, size)
                        chosen = inside_texts(lengths, size, len(hashed))[:len(hashes)]
                        if kind == "template":
                            n = filled[size:] - filled[:-size]
                            chosen = chosen & (n > 0) & (4 * n <= 3 * size)
                        if bits is not None:
                            one, two = _filter_places(hashes)
                            chosen = chosen & ((bits[one >> 3] >> (one & 7).astype(np.uint8)) & 1 == 1)
                            chosen &= (bits[two >> 3] >> (two & 7).astype(np.uint8)) & 1 == 1
                        found = np.flatnonzero(chosen)
                        offsets = np.concatenate([[0], np.cumsum(lengths)])
                        owner = np.searchsorted(offsets, found, side="right") - 1
                        for i, text in zip(found.tolist(), owner.tolist()):
                            base = int(words_at[text])
                            if kind == "literal":
                                at, upto, types = i, i + size, [0] * size
                                spelled = [data[starts[j]:ends[j]].decode() for j in range(i, i + size)]
                            else:
                                at, upto, types = int(first[i]), int(last[i + size - 1]), slots[i:i + size].tolist()
                                spelled = [data[starts[j]:ends[j]].decode() for j in first[i:i + size].tolist()]
                            whole = [" ".join(data[starts[j]:ends[j]].decode() for j in range(first[i + k], last[i + k]))
                                     if t == 1 else w if t else None for k, (w, t) in enumerate(zip(spelled, types))]
                            shape = [f"<{SLOTS[t]}>" if t else w for w, t in zip(spelled, types)]
                            yield (*keys[a + text], at - base, upto - base, i - int(offsets[text]), size, kind,
                                   int(hashes[i].astype(np.int64)), " ".join(shape), whole, [t == 2 for t in types],
                                   int(counts[text]), int(lengths[text]))

        yield from arrow_batches(rows(), schema)

    return run


_WINDOW = ("at long, upto long, place long, size long, kind string, hash long, window string, values array<string>, "
           "names array<boolean>, words long, long long")
_WINDOW_ARROW = [("at", pa.int64()), ("upto", pa.int64()), ("place", pa.int64()), ("size", pa.int64()),
                 ("kind", pa.string()), ("hash", pa.int64()), ("window", pa.string()),
                 ("values", pa.list_(pa.string())), ("names", pa.list_(pa.bool_())), ("words", pa.int64()),
                 ("long", pa.int64())]


def _lower_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the words that begin with a lower-case letter."""
    for batch in batches:
        buffer, starts, ends, _ = _bounds([t.decode().translate(_QUOTES).encode() for t in byte_texts(batch.column(0))])
        hashes = word_hashes(buffer, starts, ends)[_LOWER[buffer[starts]]]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes).astype(np.int64))], names=["hash"])


def _lengths(common: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, counts, _, _, tokens, _, _ = canonical(byte_texts(batch.column(0)), common.value)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([counts, tokens]), pa.int64())], names=["words"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               item_column: str = "item_id", item_text_column: str = "text", window: int = 8, share: float = 0.5,
               enough: int = 30, min_words: int = 3) -> DataFrame:
    """Documents holding benchmark items, literally or with other numbers, names and units.

    One row per document and item: key (hash of id and text), doc_id, item_id, matched_words, item_words,
    n_slots. Words are runs of letters and digits, in lower case; punctuation is ignored. Windows of ``window``
    words are compared literally, and windows of as many tokens as templates whose numbers, names and units are one
    typed placeholder each, of any number of words. An
    item shorter than a window is one window; below ``min_words`` words it can't be told from chance and is
    left out. Windows at one offset (in tokens) between document and item belong together; if a name of the item
    stands against two names of the document there, or the other way round, the templates only look alike and do
    not count. Windows less than two windows apart in the document make a region, whatever their offsets; what
    counts are the item's distinct words matched in it, and no more than words of the document. A document leaks
    an item if ``share`` of the item's words match in a region, or ``enough`` of them.

    NULL texts match nothing. Repeated rows of documents share a key and give one row per item; repeated items
    likewise. NULL ids are allowed; other columns are not read; empty tables give empty tables.

    A Bloom filter of fixed size (1 MB) over the benchmark's windows lets tasks drop all other windows of a
    document before anything is spelled out or joined; a benchmark of any size only makes it less selective.
    """
    spark = docs.sparkSession
    item_texts = benchmark.select(F.coalesce(F.col(item_text_column), F.lit("")))
    # the benchmark's vocabulary
    common = spark.sparkContext.broadcast(np.array([r.hash for r in item_texts.mapInArrow(
        _lower_words, "hash long").distinct().collect()], dtype=np.int64).view(np.uint64))
    item_words = item_texts.mapInArrow(_lengths(common), "words long")
    short = [r.words for r in item_words.filter((F.col("words") >= min_words) & (F.col("words") < window))
             .distinct().collect()]
    sizes = sorted({window, *short})
    kind = benchmark.schema[item_column].dataType.simpleString()
    items = benchmark.select(F.col(item_column).alias("item_id"), F.col(item_text_column).alias("text")).mapInArrow(
        _window_rows(1, sizes, common, None, pa.schema([("item_id", arrow_type(benchmark, item_column)), *_WINDOW_ARROW])),
        f"item_id {kind}, {_WINDOW}")
    items = stored(items.filter((F.col("long") == F.col("size")) | (F.col("size") == window)).distinct(),
                   "benchmark-windows")
    # the filter's bits as at most 131,072 words of 64 bits
    place = F.explode(F.array(F.pmod(F.expr("hash & 8388607"), FILTER_BITS),
                              F.pmod(F.shiftrightunsigned("hash", 40), FILTER_BITS)))
    cells = items.select(place.alias("place")).groupBy(F.floor(F.col("place") / 64).cast("int").alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for row in cells:
        bits[row.cell] = row.bits
    id_type = docs.schema[id_column].dataType.simpleString()
    ready = docs.select(row_key(F.col(id_column), F.col(text_column)).alias("key"), F.col(id_column).alias("doc_id"),
                        F.col(text_column).alias("text"))
    found = ready.mapInArrow(
        _window_rows(2, sizes, common, spark.sparkContext.broadcast(bits.tobytes()),
                     pa.schema([("key", pa.binary()), ("doc_id", arrow_type(docs, id_column)), *_WINDOW_ARROW])),
        f"key binary, doc_id {id_type}, {_WINDOW}")
    d, i = found.alias("d"), items.alias("i")
    pairs = stored(d.join(i, (F.col("d.hash") == F.col("i.hash")) & (F.col("d.window") == F.col("i.window"))
                          & (F.col("d.kind") == F.col("i.kind"))).select(
        "d.key", "d.doc_id", "i.item_id", (F.col("d.place") - F.col("i.place")).alias("shift"), F.col("i.at").alias("at"),
        F.col("i.upto").alias("upto"), F.col("d.at").alias("doc_at"), F.col("d.upto").alias("doc_upto"),
        F.col("i.words").alias("item_words"),
        F.arrays_zip(F.col("i.values").alias("was"), F.col("d.values").alias("now"), F.col("i.names").alias("name")).alias(
            "values")), "leak-windows")
    place_of = ["key", "doc_id", "item_id", "shift"]
    filled = pairs.select(*place_of, F.explode("values").alias("v")).filter("v.was is not null").select(
        *place_of, F.col("v.was").alias("was"), F.col("v.now").alias("now"), F.col("v.name").alias("name")).distinct()
    slots = filled.groupBy(*place_of).agg(
        F.count(F.lit(1)).alias("n_slots"), F.count_if("name").alias("n_names"),
        F.count_distinct(F.when(F.col("name"), F.col("was"))).alias("was"),
        F.count_distinct(F.when(F.col("name"), F.col("now"))).alias("now"))
    # one name against one name: as many pairs as names on either side; numbers and units may be equal by accident
    odd = (F.col("n_names") != F.col("was")) | (F.col("n_names") != F.col("now"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in place_of]
    literal = F.forall("values", lambda v: v["was"].isNull())
    kept = pairs.alias("p").join(slots.alias("s"), same, "left").filter(
        F.coalesce(~odd, F.lit(True)) | literal).select("p.*", F.coalesce("n_slots", F.lit(0)).alias("n_slots"))
    place_of = ["key", "doc_id", "item_id"]

    def before(*by: str) -> Window:
        return Window.partitionBy(*place_of, *by[:-2]).orderBy(*by[-2:]).rowsBetween(Window.unboundedPreceding, -1)

    def fresh(at: str, upto: str) -> Column:
        """Words that no window before, in order of place, has covered."""
        covered = F.coalesce(F.max(upto).over(before("region", at, upto)), F.lit(0))
        return F.greatest(F.col(upto) - F.greatest(F.col(at), covered), F.lit(0))

    # a word put in breaks at most the windows over it, so parts of one copy are less than two windows apart
    far = F.col("doc_at") - F.max("doc_upto").over(before("doc_at", "doc_upto")) > 2 * window
    along = Window.partitionBy(*place_of).orderBy("doc_at", "doc_upto", "at", "upto", "shift").rowsBetween(
        Window.unboundedPreceding, 0)
    regions = kept.withColumn("opens", F.coalesce(far, F.lit(False)).cast("int")).withColumn(
        "region", F.sum("opens").over(along))
    matched = regions.withColumn("new", fresh("at", "upto")).withColumn("doc_new", fresh("doc_at", "doc_upto")).groupBy(
        *place_of, "region").agg(F.sum("new").alias("item_side"), F.sum("doc_new").alias("doc_side"), F.max("item_words").alias(
            "item_words"), F.max("n_slots").alias("n_slots"))
    # longer numbers or names make the document's side the longer one, repeated phrases in the item the item's
    matched = matched.withColumn("matched_words", F.least("item_side", "doc_side"))
    leaks = matched.filter((F.col("matched_words") >= F.lit(share) * F.col("item_words"))
                           | (F.col("matched_words") >= enough))
    return leaks.groupBy("key", "doc_id", "item_id").agg(
        F.max("matched_words").alias("matched_words"), F.max("item_words").alias("item_words"),
        F.max("n_slots").cast("long").alias("n_slots"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 **options) -> DataFrame:
    """All columns of the documents that hold no benchmark item, whatever their names.

    Rows equal in id and text stay or go together; NULL and empty texts stay.
    """
    own, leak = fresh_names(docs, "own", "leak")
    leaks = find_leaks(docs, benchmark, id_column, text_column, **options).select(F.col("key").alias(leak)).distinct()
    keyed = docs.withColumn(own, row_key(F.col(id_column), F.col(text_column)))
    return keyed.join(leaks, F.col(own) == F.col(leak), "left_anti").drop(own)
