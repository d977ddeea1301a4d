"""Hard negatives, fill-in-middle and token records beside brute force, on hard cases and on the given tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayline.llm import middle, negatives, queries, records
from wayline.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# hard negatives

def brute_negatives(rows, anchors, positives=5, negatives_=3, low=50, high=95):
    """Plain loops over (id, label, vector); ids name rows, the least (label, vector) of an id stays."""
    own = {}
    for i, label, vector in rows:
        if i is not None and label is not None and vector is not None and None not in vector:
            own[i] = min(own.get(i, (str(label), vector)), (str(label), vector))
    out = []
    for a in sorted(i for i in own if i in anchors):
        scored = sorted((-sum(x * y for x, y in zip(own[a][1], v)), i, label == own[a][0])
                        for i, (label, v) in own.items() if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            found = [(i, -t) for t, i, same in scored if not same and low * -s <= 100 * -t <= high * -s]
            out += [(a, p, n + 1, i, -s, t) for n, (i, t) in enumerate(found[:negatives_])]
    return sorted(out)


def mined(spark, rows, anchors, **more):
    df = spark.createDataFrame([(*r, "k", 0) for r in rows], "vec_id long, label int, vector array<long>, key string, tile int")
    return sorted(tuple(r) for r in negatives.mine_hard_negatives(df, F.col("vec_id").isin(anchors), **more).collect())


def test_negatives_beside_loops(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(i, draw.choice([0, 0, 0, 1, 2]), [draw.randint(-3, 6) for _ in range(4)]) for i in range(-40, 400)]
    rows += [(400 + i, i % 2, [2, 2, 2, 2]) for i in range(200)]        # ties: one very common vector
    rows += [(700, None, [1, 1, 1, 1]), (701, 1, None), (702, 1, [1, None, 1, 1]), (None, 1, [3, 3, 3, 3]),
             (703, 1, []), (704, 0, [5]), (5, 1, [9, 9, 9, 9]), (5, 1, [9, 9, 9, 9])]
    anchors = [*range(-40, 600, 25), 700, 703]
    want = brute_negatives(rows, set(anchors))
    assert want and mined(spark, rows, anchors) == want
    # many small tiles
    monkeypatch.setattr(negatives, "ANCHOR_CELLS", 40)
    monkeypatch.setattr(negatives, "ROW_CELLS", 500)
    monkeypatch.setattr(negatives, "_ROWS", 7)
    assert mined(spark, rows, anchors) == want
    assert mined(spark, rows, anchors, positives=2, negatives=9, low=0, high=100) == brute_negatives(
        rows, set(anchors), 2, 9, 0, 100)


def test_negatives_of_little(spark):
    assert mined(spark, [], [1]) == []
    assert mined(spark, [(1, 0, [1]), (2, 0, [1])], [1]) == []
    assert mined(spark, [(1, 0, [1]), (2, 0, [2]), (3, 1, [1])], []) == []
    assert mined(spark, [(1, 0, [1]), (2, 0, [0]), (3, 1, [0])], [1]) == [(1, 2, 1, 3, 0, 0)]


def test_scores_are_exact_beyond_doubles():
    big = np.array([[1 << 30, 3, -1]], dtype=np.int64)
    assert negatives.pair_scores(big, big)[0, 0] == (1 << 60) + 10
    assert negatives.pair_scores(big * 4, big * 4)[0, 0] == (1 << 62) - 1
    scores = np.array([[(1 << 60) + 1, 1 << 60, (1 << 60) + 1, 5]])
    assert sorted(negatives.first_of(scores, np.array([[True, True, True, False]]), 2)[0]) == [0, 2]


def test_usable_and_quantised(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None],), (None,), ([],)],
                               "v array<float>")
    got = df.select(negatives.usable(F.col("v")), negatives.quantised(F.col("v"))).collect()
    assert [r[0] for r in got] == [True, False, False, False, False, True]
    assert got[0][1] == [128, -1]


# fill-in-middle

def brute_middle(key, text, seed=7, fim=100, spm=50):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    name = "" if key is None else str(key)
    h = [int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in middle.MARKS) or h[2] % 100 >= fim:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


HARD_TEXTS = ["a\nb\nc", "", None, "\n", "\n\n\n", "é\n😀\nlast", "no line", "has <P> in it\nx", "split mark <\nP>\n", "x\r\ny\r\n",
              "long line " * 3000 + "\nend", "<S>", "\n".join(f"line {i} 😀" for i in range(3000)), "abc\n" * 7, "<M\n>a\n"]


@pytest.mark.parametrize("frame_chars", [1, 3, 64, middle.FRAME_CHARS])
def test_middle_beside_strings(spark, frame_chars):
    texts = [t if frame_chars > 3 or t is None else t[:200] for t in HARD_TEXTS]
    rows = [(i % 97, t, "x", 1) for i, t in enumerate(texts * 4)] + [(None, "a\nb\n", "x", 1), (0, texts[0], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, frames string, n int")
    framed = middle.write_frames(docs, frame_chars=frame_chars).cache()
    if frame_chars > 3:
        assert max(framed.select(F.size("frames")).collect())[0] >= (1 if frame_chars > 64 else 400)
    got, outputs = [], []
    for options in ({}, {"seed": 3, "fim_percent": 40, "spm_percent": 10}):
        made = middle.transform_middle(middle.plan_cuts(framed, **options))
        got += [tuple(r) for r in middle.middle_digests(made).collect()]
        outputs += [tuple(r) for r in middle.output_texts(made).collect()]
    want = [(k, brute_middle(k, t, *o), t) for o in ((), (3, 40, 10)) for k, t, *_ in rows]
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted(got, key=str) == sorted([(k, *w[:4], sha(w[4]), sha(t)) for k, w, t in want], key=str)
    assert sorted(outputs, key=str) == sorted([(k, w[4]) for k, w, _ in want], key=str)
    framed.unpersist()


def test_only_cut_frames_are_unpacked():
    class Counting(middle.Press):
        opened = 0

        def unpack(self, data):
            self.opened += 1
            return super().unpack(data)

    press, text = Counting(), "".join(f"line {i}\n" for i in range(10_000))
    frames, n = middle.frames_of(press, text, 1000)
    frames = [dict(zip(("units", "chars", "data"), f)) for f in frames]
    one, two = (middle.find_cut(press, frames, n, len(text), cut) for cut in (1234, 8765))
    assert press.opened == 2 and len(frames) > 80
    parts = middle.span_frames(press, frames, one, two)
    assert press.opened == 2
    assert b"".join(map(press.unpack, parts)).decode() == "".join(f"line {i}\n" for i in range(1234, 8765))
    assert one[2] == len("".join(f"line {i}\n" for i in range(1234)))


def test_middle_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert middle.middle_digests(middle.transform_middle(middle.plan_cuts(middle.write_frames(docs)))).count() == 0


# token records

@pytest.fixture(scope="module")
def words():
    return records.Words(open(TOKENIZER, "rb").read())


@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]),
                                  st.sampled_from(" \n\tabcAÉé'sßΣςİ̇́ \x1c 123.,<|endoftext|>")), max_size=60))
@settings(max_examples=600, deadline=None)
def test_words_give_the_ids_of_the_text(words, text):
    assert words.text(text) == words.whole(text)


@given(st.lists(st.text(alphabet="aBéÉßÄſĲŉǅɏzµªİIi.,:!-<>|'sT1\u0301", max_size=7), max_size=9))
@settings(max_examples=600, deadline=None)
def test_plain_words_give_the_ids_of_the_text(words, parts):
    text = " ".join(parts)
    assert words.text(text) == words.whole(text)


def test_words_of_tokenizers_without_plain_letters():
    import tokenizers
    bare = tokenizers.Tokenizer(tokenizers.models.WordLevel({"a": 0, "b": 1, "u": 2}, unk_token="u"))
    bare.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    made = records.Words(bare.to_str().encode())
    assert not made.letters and made.text("a b c a") == made.whole("a b c a") == bytes([0, 0, 1, 0, 2, 0, 0, 0])


def test_words_in_pieces(words, monkeypatch):
    text = " ".join(f"Wort{i}\n're it's" for i in range(500)) + " <|endoftext|> "
    whole = words.whole(text)
    monkeypatch.setattr(records, "PIECE_CHARS", 50)
    monkeypatch.setattr(records, "KEPT_WORDS", 10)
    assert words.text(text) == whole


def test_record_checks():
    data = records.framed(b"one") + records.EMPTY + records.framed(b"three")
    one, at = records.read_record(data, 0)
    empty, at = records.read_record(data, at)
    three, at = records.read_record(data, at)
    assert (one, empty, three, at) == (b"one", b"", b"three", len(data))
    for i in range(len(data)):
        bad = data[:i] + bytes([data[i] ^ 1]) + data[i + 1:]
        with pytest.raises(ValueError):
            at = 0
            while at < len(bad):
                _, at = records.read_record(bad, at)
    with pytest.raises(ValueError):
        records.read_record(data[:-1], len(data) - len(records.framed(b"three")))
    # the masked checksum of the empty string, by hand
    assert records.masked(b"") == (0xA282EAD8).to_bytes(4, "little")


def check_records(spark, docs, rows, **options):
    tokenizer = records.load_tokenizer(spark, TOKENIZER)
    path = scratch_path(spark, "records-test")
    records.write_records(docs, path, tokenizer, **options)
    index = records.write_index(spark, path, scratch_path(spark, "records-index"))
    got = index.orderBy("start").collect()
    plain = Tokenizer.from_file(TOKENIZER)
    ids = {}
    for key, text in rows:
        own = [*plain.encode(text or "", add_special_tokens=False).ids, options.get("end_id", 1)]
        ids.setdefault(None if key is None else str(key), []).append(own)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    order = [None if r.id is None else int(r.id) for r in got]
    assert order == sorted((k for k, _ in rows), key=lambda k: (k is not None, k))
    crc = lambda own: zlib.crc32(np.array(own, dtype="<u4").tobytes())
    assert sorted((str(r.id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(k), len(own), crc(own)) for k, v in ids.items() for own in v)
    assert [(r.file, r.offset) for r in got] == sorted((r.file, r.offset) for r in got)
    return path, index, ids


def test_records_hard_cases(spark, monkeypatch):
    rows = [(3, "b c"), (1, None), (2, ""), (None, "Zürich 12"), (-5, " \n\t "), (3, "b c"), (3, "a"), (2**60, "x" * 5000),
            (10, "word " * 30_000), (4, "<|endoftext|> tail"), *[(7, "same")] * 300]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, nth int")
    monkeypatch.setattr(records, "BLOCK_BYTES", 500)
    path, index, ids = check_records(spark, docs, rows)
    assert index.select("file").distinct().count() > 2
    # shuffled reads
    drawn = index.withColumn("place", F.xxhash64("file", "offset")).filter("offset % 3 != 1")
    picked = records.read_at(spark, path, drawn).collect()
    assert [r.place for r in picked] == sorted(r.place for r in picked) and len(picked) == drawn.count()
    assert all(list(r.ids) in ids[r.id] for r in picked)
    empty = docs.limit(0)
    check_records(spark, empty, [])


def test_records_of_whole_texts(spark):
    rows = [(i, f"Text {i} it's\nabout {i * i}") for i in range(50)]
    check_records(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows, by_word=False, end_id=49407)


def test_token_records_query(spark, small_dir):
    rows = pq.read_table(f"{small_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    plain, at, want = Tokenizer.from_file(TOKENIZER), 0, []
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    got = queries.QUERIES["op13_token_records"](spark, small_dir).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
