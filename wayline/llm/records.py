"""Token ids in length-delimited binary records with masked checksums, and an offset index beside them."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayline.llm.common import arrow_batches

#: The record layout. A length (8 bytes), its masked checksum (4), the payload, its masked checksum (4); a checksum
#: is rotated right by 15 bits and a constant is added. The checksum is CRC-32, as in zlib. All numbers are
#: little-endian.
LENGTH, CHECK, MASK = "<Q", "<I", 0xA282EAD8
#: Payload: bytes of a token id, bytes of the document's id (-1: none), number of token ids; then the two themselves.
HEAD = "<BiQ"
#: A file holds the records of about so many bytes of text.
FILE_TEXT_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
MAX_VOCABULARY_BYTES = 16 << 20
#: Words whose ids a worker keeps (twice, with those of the generation before), and the longest of them.
KEPT_WORDS, KEPT_LETTERS = 1 << 18, 48
PIECE_CHARS = 1 << 20


def masked(data: bytes) -> bytes:
    crc = zlib.crc32(data)
    return struct.pack(CHECK, (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF)


def framed(payload: bytes) -> bytes:
    """One record of the file."""
    size = struct.pack(LENGTH, len(payload))
    return b"".join([size, masked(size), payload, masked(payload)])


#: An empty record, which readers skip; it ends every block, as a line end would.
EMPTY = framed(b"")


def read_record(data: bytes | memoryview, at: int, name: str = "") -> tuple[bytes, int]:
    """The payload of the record at a place and the place behind it; ValueError if a checksum differs."""
    size = bytes(data[at:at + 8])
    if len(size) < 8 or bytes(data[at + 8:at + 12]) != masked(size):
        raise ValueError(f"bad record length at byte {at} of {name}")
    start, n = at + 12, struct.unpack(LENGTH, size)[0]
    payload = bytes(data[start:start + n])
    if len(payload) < n or bytes(data[start + n:start + n + 4]) != masked(payload):
        raise ValueError(f"bad record at byte {at} of {name}")
    return payload, start + n + 4


def pack_sequence(key: str | None, ids: bytes, width: int) -> bytes:
    name = b"" if key is None else key.encode()
    return struct.pack(HEAD, width, -1 if key is None else len(name), len(ids) // width) + name + ids


def unpack_sequence(payload: bytes) -> tuple[str | None, np.ndarray]:
    width, named, n = struct.unpack_from(HEAD, payload)
    start = struct.calcsize(HEAD)
    at = start + max(named, 0)
    key = None if named < 0 else payload[start:at].decode()
    return key, np.frombuffer(payload, dtype=f"<u{width}", count=n, offset=at)


def load_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """A tokenizer file's bytes for the workers; a file above 16 MB is refused."""
    rows = spark.read.format("binaryFile").load(path).select("length", "content").collect()
    if len(rows) != 1 or rows[0].length > MAX_VOCABULARY_BYTES:
        raise ValueError("the tokenizer must be one file of at most 16 MB")
    return spark.sparkContext.broadcast(bytes(rows[0].content))


class Words(dict):
    """Token ids of words as bytes; words met lately are kept, in two generations of bounded size.

    The library encodes each new word. A word of plain letters, with or without punctuation behind it, goes straight to the
    tokenizer's model: the normal form of each letter is asked of the library once, and such a run of letters is one
    piece to the model. All other words pass through the whole tokenizer.
    """

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(data.decode())
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.older, self.runs, self.older_runs = {}, {}, {}
        self.letters = self._plain_letters()
        known = "".join(map(chr, self.letters))
        self.plain = re.compile(f"([{known}]+)([!-&(-/:;=-@\\[-`{{-~]*)") if known else None

    def _plain_letters(self) -> dict[int, str]:
        """Letters below 0x250 that are one letter in normal form, and what the model reads for each; none if the
        tokenizer has no normal form or no splitting rule to ask, or takes a run of them apart."""
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is None or split is None:
            return {}
        found = {}
        for c in filter(str.isalpha, map(chr, range(0x250))):
            one = normal.normalize_str(c)
            pieces = split.pre_tokenize_str(one)
            if len(one) == 1 and one.isalpha() and len(pieces) == 1:
                found[ord(c)] = pieces[0][0]
        every = "".join(map(chr, found))
        whole = [p for p, _ in split.pre_tokenize_str(normal.normalize_str(f"{every}, {every}"))]
        return found if whole[:1] == ["".join(found.values())] and len(whole) == 3 else {}

    def _encode(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype=f"<u{self.width}").tobytes()

    def _run(self, letters: str) -> bytes:
        known = letters.translate(self.letters)
        ids = self.runs.get(known)
        if ids is None:
            ids = self.older_runs.get(known)
            if ids is None:
                ids = b"".join([t.id.to_bytes(self.width, "little") for t in self.tokenizer.model.tokenize(known)])
            if len(self.runs) >= KEPT_WORDS:
                self.older_runs, self.runs = self.runs, {}
            self.runs[known] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if not word:
                ids = b""
            elif len(word) > KEPT_LETTERS:
                return self._encode(word)
            else:
                plain = self.plain and self.plain.fullmatch(word)
                ids = self._run(plain[1]) + self[plain[2]] if plain else self._encode(word)
        if len(self) >= KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        """Ids of a whole text, word by word, some MB of words at a time."""
        text = text.replace("\n", " ")
        out, at = [], 0
        while at < len(text):
            end = len(text) if at + PIECE_CHARS >= len(text) else text.find(" ", at + PIECE_CHARS)
            end = len(text) if end < 0 else end
            out.append(b"".join(map(self.__getitem__, text[at:end].split(" "))))
            at = end + 1
        return b"".join(out)

    def whole(self, text: str) -> bytes:
        """Ids of a text encoded at once."""
        return self._encode(text)


def _words(tokenizer: Broadcast) -> Words:
    """Built once in a worker process and kept with the broadcast, which stays there when a task ends."""
    words = getattr(tokenizer, "words", None)
    if words is None:
        words = tokenizer.words = Words(tokenizer.value)
    return words


def _blocks(tokenizer: Broadcast, end_id: int, by_word: bool):
    schema = pa.schema([("value", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes]]:
        words, held, size = _words(tokenizer), [], 0
        end = np.array([end_id], dtype=f"<u{words.width}").tobytes()
        encode = words.text if by_word else words.whole
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                record = framed(pack_sequence(key, encode(text.as_py() or "") + end, words.width))
                held.append(record)
                size += len(record)
                if size >= BLOCK_BYTES:
                    yield (b"".join(held),)
                    held, size = [], 0
        if held:
            yield (b"".join(held),)

    return lambda batches: arrow_batches(rows(batches), schema, limit=4 << 20)


def write_records(docs: DataFrame, path: str, tokenizer: Broadcast, id_column: str = "doc_id", text_column: str = "text",
                  end_id: int = 1, by_word: bool = True) -> None:
    """Write the token ids of every whole text, each closed by ``end_id``, as records in ascending order of ids.

    Files in order of their names, and records in a file, follow the ids (NULL first), then a hash of the text; a
    NULL text is an empty one. A record holds the id as text and the token ids in 2 or 4 bytes each. Repeated rows
    are records of their own. An empty table writes no record. Columns not named are not read.

    With ``by_word`` words between blanks are encoded one by one and kept for reuse, which gives the ids of the
    whole text for a tokenizer that never joins text across a blank and drops blanks; else each text is
    encoded at once. Rows are dealt out by ranges of (id, text hash, place read), so that one id, however frequent, spans
    many files; a file holds the records of some MB of text. The sink is Spark's text writer over bytes, whose
    separator is an empty record: lost tasks leave nothing behind.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    size = plain.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_TEXT_BYTES))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("nth").asc()]
    dealt = plain.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(
        files, *order).sortWithinPartitions(*order)
    blocks = dealt.select(F.col("id").cast("string"), "text").mapInArrow(
        _blocks(tokenizer, end_id, by_word), "value binary")
    (blocks.select(F.col("value").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").option("compression", "none").text(path))


_ENTRY = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("id", pa.string()),
                    ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
ENTRY_TYPES = "file string, offset long, length long, id string, before long, n_tokens long, ids_crc32 long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, at, before = memoryview(content.as_buffer()), 0, 0
                while at < len(data):
                    payload, behind = read_record(data, at, path)
                    if payload:
                        key, ids = unpack_sequence(payload)
                        yield path, at, behind - at, key, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())
                        before += len(ids)
                    at = behind

    yield from arrow_batches(rows(), _ENTRY)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def write_index(spark: SparkSession, path: str, index: str) -> DataFrame:
    """Read all records of the files, check them, and write the offset index: one row per record.

    (file, offset, length, id, start, n_tokens, ids_crc32): where the record lies, the document's id as text, the token
    ids in all records before it, its own, and their CRC-32 as 32-bit numbers. Files are read one at a time in a task; the
    sums before a file come from one row per file. A damaged record raises an error that names its place.
    """
    entries = f"{index}/entries"
    _files(spark, path).mapInArrow(_scan, ENTRY_TYPES).write.mode("overwrite").parquet(entries)
    scanned = spark.read.schema(ENTRY_TYPES).parquet(entries)
    sums = scanned.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return scanned.join(sums, "file").select(
        "file", "offset", "length", "id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("place", pa.int64()), ("id", pa.string()), ("ids", pa.list_(pa.int64()))])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path, content, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = memoryview(content.as_buffer())
                for entry in wanted.as_py():
                    key, ids = unpack_sequence(read_record(data, entry["offset"], path)[0])
                    yield entry["place"], key, ids.astype(np.int64)

    yield from arrow_batches(rows(), schema)


def read_at(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    """(place, id, ids) of the records that ``entries`` (file, offset, place) name, in order of ``place``.

    For shuffled reads: give index rows a random or seeded ``place``. A file is read once whatever the number of its
    records; the offsets of a file, fewer than its records, meet its bytes in one row.
    """
    wanted = entries.groupBy(F.col("file").alias("path")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("offset").cast("long").alias("offset"), F.col("place").cast("long").alias("place")))).alias("wanted"))
    found = _files(spark, path).join(wanted, "path").mapInArrow(_pick, "place long, id string, ids array<long>")
    return found.orderBy("place")
