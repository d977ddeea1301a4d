"""Language ID: blended-spectrum presence kernels, Nystrom landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.common import mix, slices, stored

UNDETERMINED = "und"
#: Ids of the blended spectrum: 1-, 2- and 3-grams of code points, hashed; 0 is the gap alone.
SPECTRUM = 1 << 24
#: Code points whose n-grams are looked at together, and distinct n-grams of a text that are merged together.
_BLOCK_CHARS, _MERGE = 1 << 16, 1 << 20
#: A matrix product takes so many texts and n-grams at a time.
_TEXTS, _GRAMS = 128, 8192


@dataclass
class LanguageModel:
    """What a worker needs to score texts; its size is bounded by the landmarks and their n-grams."""

    languages: list[str]
    classes: np.ndarray  # 1 for every code point that is a letter
    grams: np.ndarray  # sorted ids of the n-grams that occur in landmarks
    landmarks: np.ndarray  # presence of those n-grams, one row per landmark
    sizes: np.ndarray  # n-grams present in each landmark
    dual: np.ndarray  # one column of coefficients per language

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """Kernel of texts, given as distinct ids, with every landmark."""
        sizes = np.array([max(len(ids), 1) for ids in texts], dtype=np.float64)
        return shared_grams(texts, self.grams, self.landmarks) / np.sqrt(np.outer(sizes, self.sizes))


def remainder(id_column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(id_column.cast("string").cast("binary")) % divisor


def letter_classes(letters: list[int] | None = None) -> np.ndarray:
    """1 for the code points that count as letters, all of the world if none are given."""
    classes = np.zeros(0x110000, dtype=np.uint8)
    classes[[c for c in range(0x110000) if chr(c).isalpha()] if letters is None else letters] = 1
    return classes


def symbol_blocks(text: str, classes: np.ndarray, size: int = 0) -> Iterator[np.ndarray]:
    """Letters of a text as code points, runs of other characters as one gap (0) at either side of a word.

    Comes in blocks of bounded length, each beginning with the last two symbols of the one before, so that no n-gram is cut.
    """
    tail, size = np.zeros(1, dtype=np.uint64), size or _BLOCK_CHARS
    for at in range(0, len(text), size):
        # letter by letter: the small final sigma depends on its neighbours, which may lie in another block
        piece = text[at:at + size].lower().replace("\u03c2", "\u03c3")
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        symbols = np.concatenate([tail, points.astype(np.uint64) * classes[points]])
        gap = symbols == 0
        gap[1:] &= gap[:-1]
        gap[:len(tail)] = False
        symbols = symbols[~gap]
        yield symbols
        tail = symbols[-2:]
    if tail[-1] != 0:
        yield np.append(tail, np.uint64(0))


def spectrum_ids(symbols: np.ndarray) -> np.ndarray:
    """Ids of all 1-, 2- and 3-grams in a row, with repeats; a code point has 21 bits."""
    two = (symbols[:-1] << np.uint64(21)) | symbols[1:]
    three = (two[:-1] << np.uint64(21)) | symbols[2:]
    grams = np.concatenate([symbols, two + np.uint64(1 << 62), three + np.uint64(1 << 63)])
    ids = np.maximum((mix(grams) >> np.uint64(40)).astype(np.int32), 1)
    ids[:len(symbols)][symbols == 0] = 0
    return ids


def sorted_distinct(ids: np.ndarray) -> np.ndarray:
    ids = np.sort(ids)
    first = np.ones(len(ids), dtype=bool)
    np.not_equal(ids[1:], ids[:-1], out=first[1:])
    return ids[first]


def distinct_ids(text: str, classes: np.ndarray) -> np.ndarray:
    """Sorted ids of the n-grams present in a whole text, once each; empty if it has no letter."""
    parts, held = [], 0
    for symbols in symbol_blocks(text, classes):
        parts.append(sorted_distinct(spectrum_ids(symbols)))
        held += len(parts[-1])
        if held > _MERGE and len(parts) > 1:
            parts = [sorted_distinct(np.concatenate(parts))]
            held = len(parts[0])
    ids = parts[0] if len(parts) == 1 else sorted_distinct(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.int32)
    return ids[1:] if len(ids) and ids[0] == 0 else ids


def shared_grams(texts: list[np.ndarray], grams: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Number of n-grams that each text shares with each landmark: products of presence matrices, block by block."""
    places = []
    for ids in texts:
        at = np.searchsorted(grams, ids)
        at[at == len(grams)] = 0
        places.append(at[grams[at] == ids] if len(grams) else at[:0])
    shared = np.zeros((len(texts), len(landmarks)), dtype=np.float64)
    for first in range(0, len(grams), _GRAMS):
        block = landmarks[:, first:first + _GRAMS].astype(np.float32)
        presence = np.zeros((len(texts), block.shape[1]), dtype=np.float32)
        for i, at in enumerate(places):
            a, b = np.searchsorted(at, [first, first + _GRAMS])
            presence[i, at[a:b] - first] = 1
        shared += presence @ block.T
    return shared


def _spectra(classes: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], _TEXTS):
                out = [distinct_ids(text.as_py(), classes.value).astype("<i4").tobytes() for text in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())],
                                                 names=["lang", "draw", "grams"])

    return run


def _normal_equations(model: Broadcast, root: Broadcast):
    """Sums over the sample's rows of a task: features' products with themselves and with the wanted outputs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, count, total, wanted = LanguageModel(**model.value), 0, 0, 0
        code = {lang: i for i, lang in enumerate(m.languages)}
        for batch in batches:
            for part in slices([batch], _TEXTS):
                texts = [np.frombuffer(g.as_py(), "<i4") for g in part.column(1)]
                features = m.kernel(texts) @ root.value
                target = np.zeros((len(texts), len(code)))
                target[np.arange(len(texts)), [code[lang] for lang in part.column(0).to_pylist()]] = 1
                total, wanted, count = total + features.T @ features, wanted + features.T @ target, count + len(texts)
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()),
                                              pa.array([wanted.tobytes()], pa.binary())], names=["total", "wanted"])

    return run


def labelled_sample(docs: DataFrame, trains: Column, per_language: int, most: int, most_bytes: int, id_column: str,
                    text_column: str, lang_column: str) -> DataFrame:
    """A seeded sample of labelled texts: (lang, draw, text), equal numbers per language as far as they go."""
    docs = docs.filter(F.octet_length(text_column) <= most_bytes)
    known = docs.filter(trains & F.col(lang_column).isNotNull()).select(
        F.col(lang_column).alias("lang"), F.col(id_column).cast("string").alias("doc"),
        F.xxhash64(F.lit("language"), F.col(id_column).cast("string")).alias("draw"))
    sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    languages = sizes.count()
    if languages > most:
        raise ValueError(f"more than {most} languages")
    each = max(1, min(per_language, most // max(1, languages)))
    # the least draws lie below a share of all draws with room to spare, so few rows are ranked at any size
    share = F.lit(2.0 * each + 50) / F.col("n")
    low = known.join(F.broadcast(sizes), "lang").filter(F.col("draw") / F.lit(2.0**64) + 0.5 <= share)
    in_language = Window.partitionBy("lang").orderBy("draw", "doc")
    drawn = stored(low.withColumn("at", F.row_number().over(in_language)).filter(F.col("at") <= each)
                   .select("lang", "doc", "draw").distinct(), "language-sample")
    texts = docs.select(F.col(lang_column).alias("lang"), F.col(id_column).cast("string").alias("doc"),
                        F.col(text_column).alias("text"))
    # the sample is at most ``most`` rows (or one per language)
    return stored(texts.join(F.broadcast(drawn), ["lang", "doc"]).groupBy("lang", "doc", "draw").agg(
        F.min("text").alias("text")).select("lang", "draw", "text"), "language-texts")


def fit_language_model(docs: DataFrame, trains: Column, id_column: str = "doc_id", text_column: str = "text",
                       lang_column: str = "lang", per_language: int = 300, landmarks: int = 192, most: int = 20_000,
                       ridge: float = 1e-2, most_bytes: int = 1 << 18) -> LanguageModel | None:
    """Fit on at most ``per_language`` labelled texts of each language and ``most`` in all (seeded by id), of texts of
    at most ``most_bytes`` each.

    Texts become the sets of 1- to 3-grams of their letters, of any script; the kernel of two texts is the number of n-grams
    both have, over the square root of the product of their numbers. Some of the sample (``landmarks`` in all,
    one per language at least) span the Nystrom features; ridge regression gives each language against
    the rest. None if nothing is labelled. The landmarks' n-grams reach the driver, and of the other texts only
    the sums of the normal equations, one pair of matrices per task.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, trains, per_language, most, most_bytes, id_column, text_column, lang_column)
    classes = letter_classes()
    spectra = stored(sample.select("lang", "draw", "text").mapInArrow(
        _spectra(spark.sparkContext.broadcast(classes)), "lang string, draw long, grams binary")
        .filter(F.octet_length("grams") > 0), "language-spectra")
    languages = sorted(r[0] for r in spectra.select("lang").distinct().collect())
    if not languages:
        return None
    in_language = Window.partitionBy("lang").orderBy("draw")
    chosen = spectra.withColumn("at", F.row_number().over(in_language)).filter(
        F.col("at") <= max(1, landmarks // len(languages))).orderBy("lang", "draw").select("grams").collect()
    chosen = [np.frombuffer(bytes(r[0]), "<i4") for r in chosen]
    grams = np.unique(np.concatenate(chosen))
    marked = np.zeros((len(chosen), len(grams)), dtype=np.uint8)
    for i, ids in enumerate(chosen):
        marked[i, np.searchsorted(grams, ids)] = 1
    model = LanguageModel(languages, classes, grams, marked, np.array([len(ids) for ids in chosen], dtype=np.float64),
                          np.zeros((len(chosen), len(languages))))
    values, vectors = np.linalg.eigh(model.kernel(chosen))
    root = vectors * (1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    sums = spectra.select("lang", "grams").mapInArrow(
        _normal_equations(spark.sparkContext.broadcast(vars(model)), spark.sparkContext.broadcast(root)),
        "total binary, wanted binary").collect()
    # in a fixed order: a sum of doubles depends on it
    sums = sorted((bytes(r.total), bytes(r.wanted)) for r in sums)
    total = np.sum([np.frombuffer(t) for t, _ in sums], axis=0).reshape(len(chosen), -1)
    wanted = np.sum([np.frombuffer(w) for _, w in sums], axis=0).reshape(len(chosen), -1)
    model.dual = root @ np.linalg.solve(total + ridge * np.eye(len(chosen)), wanted)
    return model


def _predict(model: Broadcast, extra: int, text_at: int):
    """Append (lang_pred, score, output) to the first ``extra`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(**model.value)
        for part in slices(batches, _TEXTS):
            texts = [distinct_ids(text.as_py() or "", m.classes) for text in part.column(text_at)]
            lettered = np.array([len(ids) > 0 for ids in texts])
            values = np.where(lettered[:, None], np.maximum(m.kernel(texts) @ m.dual, 0), 0)
            best = values.argmax(axis=1)
            top = values[np.arange(len(best)), best]
            score = np.clip(top / np.maximum(values.sum(axis=1), 1e-12), 0, 1)
            names = [m.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), lettered.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:extra], pa.array(names), pa.array(score), pa.array(top)],
                names=[*part.schema.names[:extra], "lang", "score", "output"])

    return run


def predict_language(docs: DataFrame, model: LanguageModel | None, keep: list[str], text_column: str = "text",
                     as_names: tuple[str, str, str] = ("lang_pred", "score", "output")) -> DataFrame:
    """The columns ``keep`` with the predicted language, its score and its output, from the whole text alone.

    The output is that of the language's regression, which learned 1 for its texts and 0 for others; it does not depend on the
    number of languages. The score is its share of all positive outputs. A NULL text, one without letters, and any text
    when nothing was learned are ``und`` with score and output 0. Ties go to the first name. Columns not in ``keep``
    are not read.
    """
    if model is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias(as_names[0]), F.lit(0.0).alias(as_names[1]),
                           F.lit(0.0).alias(as_names[2]))
    types = [docs.schema[c].dataType.simpleString() for c in keep]
    ddl = ", ".join([*[f"c{i} {t}" for i, t in enumerate(types)], "lang string, score double, output double"])
    passed = keep if text_column in keep else [*keep, text_column]  # the text goes through once
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(passed)])
    scored = rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(vars(model)), len(keep),
                                      passed.index(text_column)), ddl)
    return scored.toDF(*keep, *as_names)


def identify_languages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       lang_column: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    The model is fitted on labelled rows whose id's crc32 modulo 4 is not 2; rows with remainder 2 are held
    out. A row with a NULL id is neither trained on nor held out. Repeated rows get equal results. Empty tables
    give empty tables; extra columns are not read.
    """
    part = remainder(F.col(id_column), 4)
    model = fit_language_model(docs, part != 2, id_column, text_column, lang_column)
    ready = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(part == 2, F.lit(False)).alias("held_out"),
                        F.col(text_column).alias("text"))
    return predict_language(ready, model, ["doc_id", "held_out"]).drop("output")
