"""Chat formatting at token level: segments are encoded apart, reserved ids spliced in, masks summed up."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import arrow_type

#: Where the public vocabulary of the default tokenizer lies; a parameter of every function below.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the public splitting pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Control strings; their reserved ids follow the vocabulary in this order.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]"]
#: The control string that opens the text of each known role; any other role is spelled out after [ROLE].
OPENERS = {"user": "[INST]", "assistant": "[/INST]", "system": "[SYS]"}
MAX_VOCABULARY_BYTES = 16 << 20

#: A control string, with any number of backslashes behind its first character.
CONTROL_PATTERN = r"([<\[])(\\*)(/?(?:s>|(?:INST|SYS|ROLE)\]))"
_CONTROL = re.compile(CONTROL_PATTERN)
_ESCAPED = re.compile(CONTROL_PATTERN.replace(r"(\\*)", r"\\(\\*)"))


def escape(text: str) -> str:
    """Put one more backslash into every control string, so that none is left and ``unescape`` undoes it."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class Codec:
    """A public vocabulary plus the reserved ids; one per worker process."""

    def __init__(self, vocabulary: bytes):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.base = max(ranks.values()) + 1
        self.ids = {text: self.base + i for i, text in enumerate(CONTROL)}

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: Sequence[int]) -> str:
        return self.encoding.decode_bytes(ids).decode("utf-8")


def _codec(vocabulary: Broadcast, kept: dict = {}) -> Codec:  # noqa: B006 - built once in each worker
    data = vocabulary.value
    key = (len(data), hash(data))
    if key not in kept:
        kept[key] = Codec(data)
    return kept[key]


def assemble(codec: Codec, role: str, text: str) -> tuple[list[int], np.ndarray]:
    """Token ids and loss mask of one turn.

    The segments are encoded apart and joined by reserved ids, so no text can yield a reserved id. The mask
    is the running sum of +1 at the start and -1 at the end of what is learned: an assistant's text.
    """
    ids = codec.ids
    opener = OPENERS.get(role)
    head = [ids["<s>"], ids[opener]] if opener else [
        ids["<s>"], ids["[ROLE]"], *codec.encode(escape(role)), ids["[/ROLE]"]]
    content = codec.encode(escape(text))
    tokens = [*head, *content, ids["</s>"]]
    steps = np.zeros(len(tokens) + 1, dtype=np.int8)
    if role == "assistant":
        steps[len(head)] += 1
        steps[len(head) + len(content)] -= 1
    return tokens, np.cumsum(steps[:-1], dtype=np.int8)


def parse(codec: Codec, tokens: Sequence[int], mask: np.ndarray) -> tuple[str, str, str, list[str]]:
    """(role, text, rendered text, texts under the mask), read from a turn's tokens alone."""
    names = {v: k for k, v in codec.ids.items()}
    ids = np.asarray(tokens)
    marks = np.flatnonzero(ids >= codec.base)
    pieces, at = [], 0
    for m in marks.tolist():
        pieces.append(codec.decode(ids[at:m].tolist()))
        at = m + 1
    reserved = [names[int(ids[m])] for m in marks]
    rendered = "".join(p + c for p, c in zip(pieces, reserved))
    if reserved[1] == "[ROLE]":
        role, text = unescape(pieces[2]), unescape(pieces[3])
    else:
        role = next(r for r, opener in OPENERS.items() if opener == reserved[1])
        text = unescape(pieces[2])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    learned = [unescape(codec.decode(ids[a:b].tolist())) for a, b in zip(edges[0::2], edges[1::2])]
    return role, text, rendered, learned


def _encode_rows(vocabulary: Broadcast, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codec = _codec(vocabulary)
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                made = [assemble(codec, r or "", t or "")
                        for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([
                    part.column("conv_id"), part.column("turn"), part.column("order_text"),
                    pa.array([m[0] for m in made], pa.list_(pa.int32())),
                    pa.array([m[1] for m in made], pa.list_(pa.int8()))], schema=schema)

    return run


def _place_turns(schema: pa.Schema):
    """Sorted turns get their number and first token's place in the conversation, by running sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conv, seq, start = False, None, 0, 0
        for batch in batches:
            lengths = batch.column("tokens").value_lengths().to_pylist()
            seqs, starts = [], []
            for c, n in zip(batch.column("conv_id").to_pylist(), lengths):
                if not started or c != conv:
                    started, conv, seq, start = True, c, 0, 0
                seqs.append(seq)
                starts.append(start)
                seq, start = seq + 1, start + n
            yield pa.RecordBatch.from_arrays([
                batch.column("conv_id"), batch.column("turn"), pa.array(seqs, pa.int64()),
                pa.array(starts, pa.int64()), batch.column("tokens"), batch.column("loss_mask")], schema=schema)

    return run


def load_vocabulary(spark, path: str) -> Broadcast:
    """The vocabulary's bytes for the workers; a file above 16 MB is refused."""
    rows = spark.read.format("binaryFile").load(path).select("length", "content").collect()
    if len(rows) != 1 or rows[0].length > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary must be one file of at most 16 MB")
    return spark.sparkContext.broadcast(bytes(rows[0].content))


def format_conversations(turns: DataFrame, vocabulary: Broadcast, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """Training tokens of every turn: conv_id, turn, seq, token_start, tokens, loss_mask.

    A turn reads ``<s>`` opener text ``</s>``, opener being [INST] for user, [/INST] for assistant, [SYS] for
    system and [ROLE]name[/ROLE] for any other role (NULL: an empty name). Control strings occurring in texts
    or role names are escaped reversibly. ``seq`` and ``token_start`` (the turn's first token in its
    conversation) are running sums; joining the tokens of a conversation in order of ``seq`` gives its
    sequence, and the masks likewise.

    NULL texts are empty. A NULL conv_id is a conversation of its own. Turns are ordered by turn (NULL first),
    then role, then text, so ties and repeated rows have one order and each stays a turn. Extra columns are
    not read. Partitions hold whole conversations in order.

    Texts are encoded where they are read; only then tokens are dealt by conversation, sorted (spilling if
    need be) and streamed, so a huge conversation never stands in memory as a whole.
    """
    id_type = turns.schema[conv].dataType.simpleString()
    turn_type = turns.schema[turn].dataType.simpleString()
    id_arrow, turn_arrow = arrow_type(turns, conv), arrow_type(turns, turn)
    plain = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                         F.col(text).alias("text"),
                         F.concat_ws("\n", F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))).alias("order_text"))
    encoded = plain.mapInArrow(
        _encode_rows(vocabulary, pa.schema([
            ("conv_id", id_arrow), ("turn", turn_arrow), ("order_text", pa.string()),
            ("tokens", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8()))])),
        f"conv_id {id_type}, turn {turn_type}, order_text string, tokens array<int>, loss_mask array<tinyint>")
    dealt = encoded.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "order_text").drop("order_text")
    return dealt.mapInArrow(
        _place_turns(pa.schema([
            ("conv_id", id_arrow), ("turn", turn_arrow), ("seq", pa.int64()), ("token_start", pa.int64()),
            ("tokens", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8()))])),
        f"conv_id {id_type}, turn {turn_type}, seq long, token_start long, tokens array<int>, loss_mask array<tinyint>")


def _digests(vocabulary: Broadcast, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def done() -> tuple:
            turns, all_turns, chars, loss, rendered, tokens = state
            return conv, turns, all_turns.hexdigest(), chars, loss.hexdigest(), rendered, tokens

        out = []
        for batch in batches:
            codec = _codec(vocabulary)
            masks = batch.column("loss_mask")
            flat = masks.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(masks.value_lengths().to_numpy(zero_copy_only=False))
            for i, (c, seq, tokens) in enumerate(zip(batch.column("conv_id").to_pylist(),
                                                     batch.column("seq").to_pylist(),
                                                     batch.column("tokens").to_pylist())):
                if seq == 0:
                    if state:
                        out.append(done())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text, rendered, learned = parse(codec, tokens, flat[ends[i] - len(tokens):ends[i]])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                for piece in learned:
                    state[2] += len(piece)
                    state[3].update(piece.encode())
                state[4] += len(rendered)
                state[5] += len(tokens)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(done(), schema)], schema=schema)

    return run


def conversation_digests(formatted: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """Digests of each conversation, read back from the tokens and masks of ``format_conversations``.

    Relies on its order of rows. Texts under the mask are unescaped run by run, as joining first could make
    an escape out of two texts. One running state per conversation, no matter how many turns it has.
    """
    field = formatted.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", arrow_type(formatted, "conv_id")), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("n_tokens", pa.int64())])
    return formatted.mapInArrow(_digests(vocabulary, schema),
                                f"conv_id {field}, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long, n_tokens long")
