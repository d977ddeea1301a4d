"""Fill-in-middle over seekable compressed frames: a cut unpacks the frames it falls into and no others."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import arrow_type

#: Code points of a frame.
FRAME_CHARS = 1 << 16
#: The marks in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"

_FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])
_FRAME_TYPE = "array<struct<units: bigint, chars: bigint, data: binary>>"
_BATCH_BYTES = 8 << 20


class Press:
    """One compressor and one decompressor for a task."""

    def __init__(self, level: int = 1):
        self._in, self._out = zstandard.ZstdCompressor(level=level), zstandard.ZstdDecompressor()
        self.marks = [self.pack(mark.encode()) for mark in MARKS]

    def pack(self, data: bytes) -> bytes:
        return self._in.compress(data)

    def unpack(self, data: bytes) -> bytes:
        return self._out.decompress(data)


def frames_of(press: Press, text: str, frame_chars: int = FRAME_CHARS) -> tuple[list[tuple[int, int, bytes]], int]:
    """Frames of a text, each with the line ends and code points before it, and the number of lines."""
    frames, ends = [], 0
    for at in range(0, len(text), frame_chars):
        piece = text[at:at + frame_chars]
        frames.append((ends, at, press.pack(piece.encode())))
        ends += piece.count("\n")
    return frames, ends + (text[-1:] not in ("", "\n"))


def _batches(rows: Iterable[tuple[list, list[tuple]]], fields: list[pa.Field], frame: pa.StructType) -> Iterator[pa.RecordBatch]:
    """Rows of plain values and a list of frames, as batches of bounded size."""
    schema = pa.schema([*fields, pa.field("frames", pa.list_(frame))])

    def batch(values: list[list], frames: list[tuple], sizes: list[int]) -> pa.RecordBatch:
        columns = list(zip(*frames)) if frames else [[] for _ in frame]
        inner = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, frame)], fields=list(frame))
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.RecordBatch.from_arrays([*[pa.array(c, f.type) for c, f in zip(zip(*values), fields)],
                                           pa.ListArray.from_arrays(ends, inner).cast(pa.list_(frame))], schema=schema)

    values, frames, sizes, held = [], [], [], 0
    for row, own in rows:
        values.append(row)
        frames.extend(own)
        sizes.append(len(own))
        held += 200 + sum(len(f[-1]) for f in own)
        if held > _BATCH_BYTES:
            yield batch(values, frames, sizes)
            values, frames, sizes, held = [], [], [], 0
    if values:
        yield batch(values, frames, sizes)


def _write(id_field: pa.Field, frame_chars: int):
    fields = [id_field, pa.field("n", pa.int64()), pa.field("chars", pa.int64()), pa.field("marked", pa.bool_())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[tuple]]]:
        press = Press()
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                frames, n = frames_of(press, text, frame_chars)
                yield [key, n, len(text), any(mark in text for mark in MARKS)], frames

    return lambda batches: _batches(rows(batches), fields, _FRAME)


def write_frames(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 frame_chars: int = FRAME_CHARS) -> DataFrame:
    """Every text as independent zstandard frames: (doc_id, n, chars, marked, frames).

    A frame holds at most ``frame_chars`` code points and says how many line ends (``units``) and code points
    (``chars``) lie before it, so that a line is found by unpacking one frame. ``n`` is the number of lines,
    ``marked`` says whether the text holds one of the marks. Rows stay where they are. NULL texts are empty and have no
    frame; ids of any type, NULL or repeated, stay as they are; columns not named are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return plain.mapInArrow(_write(pa.field("doc_id", arrow_type(docs, id_column)), frame_chars),
                            f"doc_id {kind}, n long, chars long, marked boolean, frames {_FRAME_TYPE}")


def plan_cuts(framed: DataFrame, seed: int = 7, fim_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """Add form, first and last: the seeded cuts of each document, in lines.

    The draws are the 8-digit groups of a sha256 of seed and id (NULL: no digits), so reruns agree and equal ids have equal
    draws. Empty and marked texts, and those beyond ``fim_percent``, are plain.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    hashed = framed.withColumn("hash", F.sha2(name, 256))

    def draw(i: int) -> Column:
        return F.conv(F.substring("hash", 8 * i + 1, 8), 16, 10).cast("long")

    cuts = [draw(i) % (F.col("n") + 1) for i in range(2)]
    form = (F.when((F.col("chars") == 0) | F.col("marked") | (draw(2) % 100 >= fim_percent), PLAIN)
            .when(draw(3) % 100 < spm_percent, SPM).otherwise(PSM))
    return hashed.select("doc_id", "n", "chars", form.alias("form"), F.least(*cuts).alias("first"),
                         F.greatest(*cuts).alias("last"), "frames")


def find_cut(press: Press, frames: list[dict], n: int, chars: int, cut: int) -> tuple[int, int, int, bytes]:
    """Where the first ``cut`` lines end: frame number, bytes of that frame before it, code points before it,
    and the frame unpacked (no bytes if the cut lies between frames)."""
    if cut == 0:
        return 0, 0, 0, b""
    if cut == n:
        return len(frames), 0, chars, b""
    at = bisect.bisect_left(frames, cut, key=lambda f: f["units"]) - 1
    data = press.unpack(frames[at]["data"])
    line = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10)[cut - frames[at]["units"] - 1]
    end = int(line) + 1
    return at, end, frames[at]["chars"] + len(data[:end].decode()), data


def span_frames(press: Press, frames: list[dict], first: tuple[int, int, int, bytes],
                last: tuple[int, int, int, bytes]) -> list[bytes]:
    """The compressed frames of the text between two cuts: whole frames as they are, cut ones packed anew."""
    (a, skip, _, head), (b, end, _, tail) = first, last
    if a == b:
        return [press.pack(tail[skip:end])] if end > skip else []
    out = []
    if skip:
        if skip < len(head):
            out.append(press.pack(head[skip:]))
        a += 1
    out += [f["data"] for f in frames[a:b]]
    if end:
        out.append(press.pack(tail[:end]))
    return out


def _transform(id_field: pa.Field):
    fields = [id_field, pa.field("n", pa.int64()), pa.field("form", pa.string()), pa.field("prefix_chars", pa.int64()),
              pa.field("middle_chars", pa.int64())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[tuple]]]:
        press = Press()
        for batch in batches:
            plain = [batch.column(i).to_pylist() for i in range(6)]
            for key, n, chars, form, first, last, value in zip(*plain, batch.column(6)):
                frames = value.as_py()
                if form == PLAIN:
                    yield [key, n, form, None, None], [(f["data"],) for f in frames]
                    continue
                start, end = (0, 0, 0, b""), (len(frames), 0, chars, b"")
                one = find_cut(press, frames, n, chars, first)
                two = find_cut(press, frames, n, chars, last)
                parts = [span_frames(press, frames, a, b) for a, b in ((start, one), (two, end), (one, two))]
                order = (0, 1, 2) if form == PSM else (1, 0, 2)
                out = [data for i in order for data in (press.marks[i], *parts[i])]
                yield [key, n, form, one[2], two[2] - one[2]], [(data,) for data in out]

    return lambda batches: _batches(rows(batches), fields, pa.struct([("data", pa.binary())]))


def transform_middle(planned: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, frames): the frames of each output, in its order.

    psm is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, spm is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, plain the text
    itself (no counts). A mark is a frame of its own; no cut text holds a mark. Frames that no cut falls into are
    passed on as they are.
    """
    kind = planned.schema["doc_id"].dataType.simpleString()
    return planned.mapInArrow(
        _transform(pa.field("doc_id", arrow_type(planned, "doc_id"))),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, frames array<struct<data: binary>>")


def restored_order(unpacked: Iterable[bytes], form: str) -> list[int]:
    """Places of the frames that give the text back, found by the marks of the output."""
    places = {mark: [] for mark in MARKS}
    own = places[PREFIX]
    for i, data in enumerate(unpacked):
        mark = data.decode() if form != PLAIN and len(data) == 3 else ""
        if mark in places:
            own = places[mark]
        else:
            own.append(i)
    return [*places[PREFIX], *places[MIDDLE], *places[SUFFIX]]


def _read(id_field: pa.Field, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = Press()
        for batch in batches:
            at, held, out = 0, 0, []
            for form, value in zip(batch.column(1).to_pylist(), batch.column(2)):
                frames = [f["data"] for f in value.as_py()]
                if texts:
                    whole = b"".join(map(press.unpack, frames)).decode()
                    out.append((whole,))
                    held += len(whole)
                else:
                    told, again = hashlib.sha256(), hashlib.sha256()

                    def stream() -> Iterator[bytes]:
                        for frame in frames:
                            data = press.unpack(frame)
                            told.update(data)
                            yield data

                    for i in restored_order(stream(), form):
                        again.update(press.unpack(frames[i]))
                    out.append((told.hexdigest(), again.hexdigest()))
                if held > _BATCH_BYTES or at + len(out) == batch.num_rows:
                    columns = [pa.array(c, pa.string()) for c in zip(*out)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(out)), *columns],
                                                     names=["doc_id", "one", "two"][:1 + len(columns)])
                    at, held, out = at + len(out), 0, []

    return run


def output_texts(transformed: DataFrame) -> DataFrame:
    """(doc_id, output) of every document: the transformed text as one string."""
    kind = transformed.schema["doc_id"].dataType.simpleString()
    return transformed.select("doc_id", "form", "frames").mapInArrow(
        _read(pa.field("doc_id", arrow_type(transformed, "doc_id")), True), f"doc_id {kind}, output string")


def _digests(id_field: pa.Field):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _read(id_field, False)
        for batch in batches:
            slim = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(5)],
                                              names=["doc_id", "form", "frames"])
            for got in read(iter([slim])):
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(5)], got.column(1), got.column(2)],
                                                 names=names)

    return run


def middle_digests(transformed: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256).

    The frames of an output are streamed in order for its digest; their marks then give the order in which
    the same frames are the text again. One unpacked frame is in memory at a time.
    """
    kind = transformed.schema["doc_id"].dataType.simpleString()
    return transformed.mapInArrow(
        _digests(pa.field("doc_id", arrow_type(transformed, "doc_id"))),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
        "restored_sha256 string")
