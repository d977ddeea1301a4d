"""The text operators on the given tables beside SQL, and on small hard cases beside plain Python."""

import collections
import hashlib
import math
import os
import re
import zlib

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayline.llm import chat, common, exact, language, leaks, lines, mixing, neardup, passages, queries, scoring, warc
from wayline.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node string, at string"


@pytest.fixture(scope="module")
def tables(small_dir):
    con = duckdb.connect()
    for name in ["documents", "pages", "benchmark", "labels", "conversations", "embeddings"]:
        con.execute(f"create view {name} as select * from '{small_dir}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def hard(spark):
    """NULLs, empty, long and repeated texts, ties, repeated rows and columns named like inner ones."""
    prose = " ".join(f"word{i} of text" for i in range(60))
    long = " ".join(f"far{i} out" for i in range(40_000))
    rows = [(1, prose, "en", "a"), (2, prose.replace(" ", "\t \n"), "en", None), (3, None, None, "b"),
            (4, "", "de", "b"), (5, " \n\t ", "de", "b"), (6, long, "en", "a"), (7, "kurz", "de", "c"),
            (7, "kurz", "de", "c"), (None, prose, None, None), (None, None, None, None), (9, "!!! 123", "en", "a"),
            (10, prose + " and one more end", "en", "d"), (11, "kurz", None, "c")]
    return spark.createDataFrame([(*r, 0, "k", "n", "t") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def cell(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, small_dir, tables, name):
    df = queries.QUERIES[name](spark, small_dir)
    want = tables.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = sorted(repr([cell(r[c]) for c in columns]) for r in df.collect())
    place = [want.columns.index(c) for c in columns]
    assert got == sorted(repr([cell(r[i]) for i in place]) for r in want.fetchall())


# chat formatting

@given(st.text(alphabet="<s>[/INSTROLEYu\\]", max_size=40))
def test_escape_is_reversible_and_hides_control(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    assert not any(control in safe for control in chat.CONTROL)


def test_chat_hard_cases(spark):
    turns = [(1, 0, "user", "<s>hi</s>"), (1, 1, "assistant", "<"), (1, 2, "assistant", "\\/s> ok"),
             (1, 2, "assistant", "\\/s> ok"), (2, None, None, None), (None, 3, "tool [ROLE]", "x" * 50_000),
             (2, 5, "assistant", ""), (2, 1, "system", "déjà 😀")]
    df = spark.createDataFrame([(*t, "k") for t in turns], "conv_id long, turn long, role string, text string, seq string")
    vocabulary = chat.load_vocabulary(spark, chat.VOCABULARY)
    formatted = chat.format_conversations(df, vocabulary)
    rows = formatted.collect()
    assert len(rows) == len(turns)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.conv_id].append(r)
    for part in by.values():
        at = 0
        for seq, r in enumerate(sorted(part, key=lambda r: r.seq)):
            assert (r.seq, r.token_start) == (seq, at) and len(r.tokens) == len(r.loss_mask)
            at += len(r.tokens)
    got = {r.conv_id: r for r in chat.conversation_digests(formatted, vocabulary).collect()}
    for conv in [1, 2, None]:
        own = sorted([t for t in turns if t[0] == conv],
                     key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        told = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        learned = "".join(t[3] or "" for t in own if t[2] == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv].loss_chars == len(learned)
    assert chat.conversation_digests(chat.format_conversations(df.limit(0), vocabulary), vocabulary).count() == 0


# archives

def test_archives_hard_cases(spark):
    big = "<p>" + "é" * 800
    pages = [(1, "u", big), (2, None, big), (5, "u\r\nx", big), (5, "u", big), (None, "u", big), (3, "u", None),
             (4, "u", ""), (6, "u", "small"), (7, "u", "small"), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 200)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    got = sorted((r.page_id or -1, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest)
                 for r in warc.archive_round_trip(df).collect())
    want = []
    for page, _, html in pages:
        data = (html or "").encode()
        revisit = html == big and page != 5
        want.append((page or -1, "revisit" if revisit else "response", 5 if revisit else None, len(data),
                     hashlib.sha1(data).hexdigest()))
    assert got == sorted(want)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_salvage_recovers_later_records():
    def record(i, zipped):
        data = warc.record_bytes("response", f"urn:page:{i}", "u", b"body %d" % i * 50, warc.sha1_name(b""))
        return warc.gzip_member(data) if zipped else data

    for zipped in [True, False]:
        good = [record(i, zipped) for i in range(5)]
        broken = bytearray(good[1])
        broken[len(broken) // 2] ^= 0xFF
        data = b"".join([good[0], bytes(broken), good[2], b"junk between", good[3], good[4][:-9]])
        found = list(warc.salvage(data))
        kept = [f[3]["warc-record-id"] for f in found if f[0] == "record"]
        assert kept == ["<urn:page:0>", "<urn:page:2>", "<urn:page:3>"]
        gaps = [(f[1], f[2]) for f in found if f[0] == "gap"]
        sizes = [len(x) for x in good]
        assert gaps == [(sizes[0], len(broken)), (sum(sizes[:3]), 12), (sum(sizes[:4]) + 12, sizes[4] - 9)]
        assert sum(f[2] for f in found) == len(data)
    assert list(warc.salvage(b"")) == []


def test_salvage_goes_on_inside_a_member():
    import random
    draw = random.Random(4)

    def record(i):
        block = bytes(draw.choice(b"abcdefghijklmnopqrstuvwxyz ") for _ in range(3000))
        return warc.record_bytes("response", f"urn:page:{i}", "u", block, warc.sha1_name(b""))

    def kept(data):
        found = list(warc.salvage(data))
        return ([int(f[3]["warc-record-id"].strip("<>").split(":")[-1]) for f in found if f[0] == "record"],
                sum(f[0] == "gap" for f in found))

    plain = [record(i) for i in range(20)]
    wrong = plain[4][:-40] + b"#" + plain[4][-39:]
    short = re.sub(rb"Content-Length: 3000", b"Content-Length: 2990", plain[5])
    whole = warc.gzip_member(b"".join([*plain[:4], wrong, short, *plain[6:]]))
    assert kept(whole) == ([*range(4), *range(6, 20)], 1)
    member, after = warc.gzip_member(b"".join(plain)), warc.gzip_member(record(99))
    ids, gaps = kept(member[:len(member) * 6 // 10] + after)
    assert ids[:10] == list(range(10)) and ids[-1] == 99 and ids == sorted(set(ids)) and gaps == 1
    bad = bytearray(member)
    bad[len(bad) // 2:len(bad) // 2 + 40] = b"\xff" * 40
    ids, gaps = kept(bytes(bad) + after)
    assert ids[:9] == list(range(9)) and ids[-1] == 99 and gaps == 1 and len(ids) < 21


def test_foreign_digests_are_read_by_their_label(tmp_path, spark):
    import base64
    payload, rows = b"some payload", []
    for name in ["md5", "sha1", "sha256", "sha-512"]:
        own = hashlib.new(name.replace("-", ""), payload).digest()
        rows += [f"{name}:{own.hex()}", f"{name.upper()}:{own.hex().upper()}", f"{name}:{base64.b32encode(own).decode().lower()}"]
    rows += ["blake9:zz", "none"]
    bad = ["md5:" + "0" * 32, "sha256:" + "0" * 64, "sha1:" + "0" * 40]
    data = b""
    for i, digest in enumerate([*rows, *bad]):
        one = warc.record_bytes("resource", f"urn:page:{i}", "u", payload, digest).replace(b"application/http; msgtype=response",
                                                                                        b"text/plain")
        data += re.sub(rb"WARC-Block-Digest: [^\r]*", b"WARC-Block-Digest: " + digest.encode() if i % 2 else b"X: y", one)
    (tmp_path / "a.warc").write_bytes(data)
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert {r.record_id for r in got if r.kind == "record"} == {f"urn:page:{i}" for i in range(len(rows))}
    assert any(r.kind == "gap" for r in got)


def test_damaged_files_are_read_by_spark(spark, tmp_path):
    good = warc.gzip_member(warc.record_bytes("response", "urn:page:1", "u", b"H\r\n\r\nx", warc.sha1_name(b"x")))
    (tmp_path / "a.warc.gz").write_bytes(b"\x1f\x8b\x08 no" + good + warc.EMPTY_MEMBER + good[:-3])
    (tmp_path / "b.warc").write_bytes(b"")
    kinds = collections.Counter(r.kind for r in warc.read_archives(spark, str(tmp_path)).collect())
    assert kinds == {"gap": 2, "record": 1}


# benchmark leaks

def test_leaks_by_template(spark):
    items = [(1, "A farmer named Alice has 12 apples and gives 5 kg to Bob before Alice walks 3 miles home today."),
             (2, "short one here"), (3, None), (4, "two words")]
    text = items[0][1]
    other = "So a farmer named Carol has 40 apples and gives 7 kg to Dave before Carol walks 9 miles home today. Fine."
    mixed = other.replace("Carol walks", "Erin walks")  # the same name stands for two
    docs = [(1, f"Before that. {text} After that."), (2, text.upper()), (3, other), (4, mixed), (5, None), (6, ""),
            (7, "short one here"), (8, "nothing of the kind stands in this text at all, whatever one may think"),
            (None, text), (1, f"Before that. {text} After that.")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, window string")
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, window string")
    found = leaks.find_leaks(df, bench)
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (None, 1), (7, 2)}
    assert got[(3, 1)].n_slots >= 5 and got[(1, 1)].matched_words == got[(1, 1)].item_words
    assert sorted(r.doc_id for r in leaks.drop_leaking(df, bench).collect()) == [4, 5, 6, 8]
    assert leaks.find_leaks(df.limit(0), bench).count() == 0
    assert leaks.find_leaks(df, bench.limit(0)).count() == 0


def test_leaks_with_longer_numbers_names_and_openers(spark):
    items = [(1, "Tom has 12 apples. Tom gives 5 of them to Ann. Tom then buys 3 more apples. How many apples does Tom have?"),
             (2, "A shop sells 12 pens and 15 books for 30 dollars on one day and earns 45 dollars on the next.")]
    docs = [(1, "Sarah has 40 apples. Sarah gives 7 of them to Joe. Sarah then buys 8 more apples. How many apples does "
                "Sarah have?"),
            (2, "A shop sells 1,200 pens and 2,500 books for 1,450 dollars on one day and earns 2,200.50 dollars on the "
                "next."),
            (3, "Mary Jane has twenty-one apples. Mary Jane gives 2.5 of them to Joe Smith. Mary Jane then buys 3 more "
                "apples. How many apples does Mary Jane have?"),
            (4, "A shop opens at nine and closes at five on every day but the last one of the week.")]
    found = leaks.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.matched_words, r.item_words) for r in found.collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 1)}
    assert all(m == n for m, n in got.values())


def test_leaks_over_insertions_and_equal_values(spark):
    item = [f"{a}{b}" for a in ("ba", "de", "fi", "go", "ku") for b in ("lan", "mer", "nos", "pit", "rus", "tev")]
    short = "the small van holds 12 crates of bread and the large van holds 12 crates of fruit every morning"
    items = [(1, " ".join(item)), (2, short)]
    put_in = [*item[:10], "xx", *item[10:20], "yy", *item[20:]]
    apart = [*item[:10], *[f"far{c}" for c in "abcdefghijklmnopqrstuvwxyz"], *item[10:14]]
    twice = [*item[:8], *["so"] * 40, *item[:8]]
    docs = [(1, " ".join(put_in)), (2, " ".join(apart)), (3, " ".join(twice)),
            (4, short.replace("12", "40", 1).replace("12", "7"))]
    found = leaks.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.matched_words for r in found.collect()}
    assert got == {(1, 1): 30, (4, 2): len(short.split())}


def test_leaks_beside_plain_windows(spark, small_dir, tables):
    def plain(text):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())

    items = {i: plain(t) for i, t in tables.sql("select item_id, text from benchmark").fetchall()}
    want = set()
    for doc, text in tables.sql("select doc_id, text from documents").fetchall():
        joined = " " + " ".join(plain(text)) + " "
        want |= {(doc, i) for i, w in items.items() if " " + " ".join(w) + " " in joined}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op3_benchmark_leaks"](spark, small_dir).collect()}
    assert want and want <= got and len(got) <= len(want) + 1


# passages

def plain_passages(texts, n):
    split = [words(t) for t in texts]
    seen = collections.Counter(tuple(w[i:i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone.update(range(i, i + n))
        out.append(" ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def test_passages_hard_cases(spark, hard, empty):
    got = passages.drop_repeated_passages(hard).collect()
    rows = hard.select("doc_id", "text").collect()
    want = plain_passages([r.text for r in rows], 35)
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(
        (r.doc_id or -1, len(words(r.text)), len(words(r.text)) - len(words(k)), k) for r, k in zip(rows, want))
    assert passages.drop_repeated_passages(empty).count() == 0


def test_passages_small_alphabet(spark):
    import random
    draw = random.Random(3)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randrange(60))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for n in [3, 9, 12]:
        got = {r.doc_id: r.kept_text for r in passages.drop_repeated_passages(df, n).collect()}
        assert [got[i] for i in range(len(texts))] == plain_passages(texts, n)


# lines

def test_lines_hard_cases(spark, hard, empty):
    kept = lines.drop_recurring_lines(hard)
    assert kept.columns == [*hard.columns, "_n_lines", "_n_dropped"]
    assert kept.count() == hard.count() and kept.filter("_n_dropped > 0").count() == 0
    assert lines.drop_recurring_lines(empty).count() == 0


def test_line_templates_generalise(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"

    def body(i, j):
        return " ".join(f"{w}{letters[i]}{letters[j]}" for w in "own line of this text and no other one".split())

    rows = []
    for i in range(8):
        own = "\n".join(body(i, j) for j in range(12))
        noise = ["red", "green", "blue", "white", "black", "grey", "pink", "teal"][i]
        rows.append((i, f"Copyright {2000 + i} by the makers\n{own}\nPage was last seen in {noise} by our crawler today"))
    rows += [(20, "All rights reserved\n" * 3 + body(20, 20)), (21, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lines.drop_recurring_lines(df).collect()}
    for i in range(8):
        assert got[i]._n_dropped == 2 and got[i].text == "\n".join(body(i, j) for j in range(12))
    assert got[20]._n_dropped == 0 and got[21].text is None  # lines repeated inside one document only stay


# exact

def test_exact_hard_cases(spark, hard, empty):
    got = exact.exact_dedup(hard).collect()
    assert len(got) == hard.count()
    groups = collections.defaultdict(list)
    for r in got:
        groups[r.text_sha256].append(r)
    for part in groups.values():
        ids = [r.doc_id for r in part if r.doc_id is not None]
        assert sum(r.kept for r in part) == 1
        assert {r.keep_id for r in part} == {min(ids, default=None)} and {r.group_size for r in part} == {len(part)}
    by = {r.doc_id: r for r in got}
    assert by[2].keep_id == 1 and by[4].keep_id == 3 and by[5].keep_id == 5 and by[11].keep_id == 7
    assert exact.exact_dedup(empty).count() == 0


def test_filter_lets_repeats_through_and_few_others(spark):
    df = spark.range(20_000).select(F.unhex(F.sha2((F.col("id") % 19_000).cast("string"), 256)).alias("sha"))
    bits, segments = exact.repeat_filter(df, 20_000)
    set_bits = sum(b.bit_count() for b in bits)
    assert segments == 1 and 3 * 1000 * 0.9 < set_bits < exact.SEGMENT_BITS * 0.1


# language

def test_language_held_out_accuracy(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/../sf0.01/documents.parquet")
    rows = language.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def plain_grams(text, letters=str.isalpha):
    told = "".join(c if letters(c) else " " for c in "".join(c.lower() for c in text).replace("\u03c2", "\u03c3"))
    padded = " " + " ".join(told.split()) + " "
    return {padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)} - {" "}


def test_language_kernel_is_shared_grams(monkeypatch):
    import numpy as np
    classes = language.letter_classes([ord(c) for c in "abcdefghijklmnopqrstuvwxyz"])
    texts = ["The cat, sat!", "a cat", "x", "xx xx", "12 ab 34", "ab", "", "...", "long words and gaps  " * 30]
    for block in (1, 2, 5, 1 << 16):
        monkeypatch.setattr(language, "_BLOCK_CHARS", block)
        for a in texts:
            for b in texts:
                one, two = (language.distinct_ids(t, classes) for t in (a, b))
                lower = [plain_grams(t, lambda c: c in "abcdefghijklmnopqrstuvwxyz") if t.strip(".") else set()
                         for t in (a, b)]
                assert len(one) == len(lower[0])
                assert len(np.intersect1d(one, two)) == len(lower[0] & lower[1])
                got = language.shared_grams([two], one, np.ones((1, len(one)), dtype=np.uint8))
                assert got[0, 0] == len(lower[0] & lower[1])


def test_language_beside_direct_kernel_ridge(spark):
    """With every text as a landmark the features span all, so the outputs are those of plain kernel ridge regression."""
    import random

    import numpy as np
    draw = random.Random(3)
    stems = {"xx": "abcdeé", "yy": "fgaßσς", "zz": "жзабвdc"}
    rows = [(i, " ".join("".join(draw.choice(stems[lang]) for _ in range(draw.randrange(1, 6))) for _ in range(12)), lang)
            for i, lang in enumerate(sorted(stems) * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_language_model(docs, F.col("doc_id") < 45, landmarks=60, ridge=0.1)
    sets = [plain_grams(t) for _, t, _ in rows]
    kernel = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets[:45]] for a in sets])
    wanted = np.array([[float(lang == name) for name in sorted(stems)] for _, _, lang in rows[:45]])
    direct = np.maximum(kernel @ np.linalg.solve(kernel[:45] + 0.1 * np.eye(45), wanted), 0)
    got = {r.doc_id: r for r in language.predict_language(docs, model, ["doc_id"]).collect()}
    for i, values in enumerate(direct):
        best = values.max()
        assert got[i].lang_pred == sorted(stems)[values.argmax()]
        assert abs(got[i].score - best / values.sum()) < 1e-4 and abs(got[i].output - best) < 1e-4


def test_language_of_a_very_long_text_takes_little_memory(tmp_path):
    """One text of 16 million code points in a process of its own."""
    import subprocess
    import sys
    code = """
import random, resource
from wayline.llm import language
words = ["".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyzéü", k=6)) for i in range(5000)]
text = " ".join(words * 460)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = language.distinct_ids(text, language.letter_classes())
print(len(text), len(found), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, check=True).stdout
    size, found, mb = map(int, out.split())
    assert size > 16_000_000 and found > 1000 and mb < 150


def test_language_tells_many_scripts_apart(spark):
    import random
    draw = random.Random(8)
    # frequent letters of two scripts fill what few classes there could be; the rare ones hold other languages
    alphabets = {"l1": (97, 26), "l2": (0x430, 32), "l3": (0x3B1, 17), "l4": (0x5D0, 22), "l5": (0x10D0, 30),
                 "l6": (0xAC00, 300), "l7": (0x4E00, 300), "l8": (0x3042, 60), "l9": (0x905, 40)}
    rows = []
    for lang, (first, n) in alphabets.items():
        letters = [c for c in map(chr, range(first, first + n)) if c.isalpha()]
        for i in range(40):
            words_ = ["".join(draw.choice(letters) for _ in range(draw.randrange(2, 7))) for _ in range(60)]
            rows.append((len(rows), " ".join(words_), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify_languages(docs).collect()}
    held = [(got[i].lang_pred, lang) for i, _, lang in rows if got[i].held_out]
    assert len(held) > 50 and all(a == b for a, b in held)
    assert min(r.score for r in got.values()) > 0.3


def test_language_hard_cases(hard, empty):
    got = language.identify_languages(hard).collect()
    assert len(got) == hard.count()
    assert all((r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 9) or (r.doc_id is None and r.score == 0)) for r in got)
    assert language.identify_languages(empty).count() == 0
    unlabelled = hard.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify_languages(unlabelled).collect()} == {"und"}


# near-duplicates

def shingles(text):
    w = words((text or "").lower())
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_near_duplicates_beside_all_pairs(spark, small_dir, tables):
    rows = neardup.near_duplicate_classes(spark.read.parquet(f"{small_dir}/documents.parquet")).collect()
    docs = dict(tables.sql("select doc_id, text from documents").fetchall())
    sets = {i: shingles(t) for i, t in docs.items()}
    owner = {i: i for i in sets}

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                owner[root(b)] = root(a)
    assert {r.doc_id: r.class_id for r in rows} == {
        i: min(j for j in ids if root(j) == root(i)) for i in ids}
    assert sum(r.kept for r in rows) == len({root(i) for i in ids})


def test_samples_estimate_weighted_jaccard():
    import numpy as np
    draws = neardup.mix(np.arange(4 * neardup.DRAWS, dtype=np.uint64) * np.uint64(neardup._STEP))
    logs = np.log((draws >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54).reshape(4, -1)
    weights = neardup.Weights(np.zeros((2, neardup.CELLS), np.uint8), np.ones(64),
                              (-logs[0] - logs[1]).astype(np.float32), np.log(-logs[2] - logs[3]).astype(np.float32))
    items = neardup.mix(np.arange(1, 401, dtype=np.uint64)) >> np.uint64(16)
    a, b = np.arange(400) < 300, np.arange(400) >= 60
    wa, wb = np.where(np.arange(400) % 3 == 0, 3.0, 1.0), np.where(np.arange(400) % 3 == 0, 1.0, 1.0)
    text = np.concatenate([np.zeros(a.sum(), int), np.ones(b.sum(), int)])
    _, samples = neardup.consistent_samples(text, np.concatenate([items[a], items[b]]),
                                            np.concatenate([wa[a], wb[b]]), 600, weights)
    x, y = np.where(a, wa, 0), np.where(b, wb, 0)
    true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((samples[0] == samples[1]).mean() - true) < 5 * math.sqrt(true * (1 - true) / 600)


def test_near_duplicates_hard_cases(spark, hard, empty):
    rows = neardup.near_duplicate_classes(hard).collect()
    assert len(rows) == hard.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert {by[i][0].class_id for i in (1, 2, 10)} == {1} and by[1][0].class_size == 4
    assert by[11][0].class_id == 7 and sum(r.kept for r in by[7]) == 1
    assert all(by[i][0].kept and by[i][0].class_size == 1 for i in (3, 4, 5, 6, 9))
    assert neardup.near_duplicate_classes(empty).count() == 0


# scoring

def test_scores_beside_plain_counts(spark, hard, empty):
    def part(i):
        return zlib.crc32(str(i).encode()) % 7

    rows = hard.select("doc_id", "text").collect()
    division = language.remainder(F.col("doc_id"), 7)
    got = scoring.score_texts(hard, division != 2, division == 2).collect()
    assert len(got) == len(rows)

    def tokens(text):
        return [*words((text or "").translate({c: c + 32 for c in range(65, 91)})), None]

    counts = collections.Counter(
        t for r in rows if r.doc_id is not None and part(r.doc_id) != 2 for t in tokens(r.text))
    total, kinds = sum(counts.values()), len(counts)
    want = sorted((r.doc_id or -1, len(tokens(r.text)), sum(counts[t] > 0 for t in tokens(r.text)), total,
                   round(sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens(r.text)), 4))
                  for r in rows)
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.held_out == (r.doc_id is not None and part(r.doc_id) == 2) and r.score < 0 for r in got)
    assert scoring.score_texts(empty, division != 2, division == 2).count() == 0


def test_scores_count_pairs_met_once_and_keep_every_level(spark):
    rows = [(i, f"w{i} v{i} x{i % 7} y{i % 5}") for i in range(400)]
    learn = [*rows, (1000, "w1 v1"), (1001, "w1 v2"), (1002, "w3 v9 x2 y4")]
    df = spark.createDataFrame(learn, "doc_id long, text string")
    got = {r.doc_id: r.score for r in scoring.score_texts(df, F.col("doc_id") < 1000, F.col("doc_id") >= 1000).collect()}
    singles, pairs = collections.Counter(), collections.Counter()
    for _, text in rows:
        line = [*text.split(), None]
        singles.update(line)
        pairs.update(zip([None, *line[:-1]], line))
    total, kinds = sum(singles.values()), len(singles)

    def plain(text):
        score = 0
        line = [*text.split(), None]
        for a, b in zip([None, *line[:-1]], line):
            n = pairs[a, b]
            seen = min(1.5 * 2 ** (n.bit_length() - 1) - 0.5 if n else 0, singles[a], singles[b])
            single = (singles[b] + 1) / (total + kinds + 1)
            score += math.log10(0.8 * single + 0.2 * seen / singles[a] if singles[a] else single)
        return score

    exact = sum(abs(got[i] - plain(t)) < 1e-6 for i, t in learn)
    assert exact >= 0.98 * len(learn)  # the filter may take a few pairs for met ones or a level higher
    assert got[1000] > got[1001] + 0.5


def test_count_filter_levels(spark, small_dir):
    import numpy as np
    draw = np.random.default_rng(5)
    pairs = np.unique(scoring.mix(np.arange(1, 6001, dtype=np.uint64)) >> np.uint64(16))
    levels = draw.integers(2, 6, len(pairs))
    buckets = 12
    rows = []
    owner = scoring.bucket_of(pairs, 48, buckets)
    for b in range(buckets):
        for level in range(2, 6):
            own = pairs[(owner == b) & (levels == level)]
            rows.append((b, level, len(own), bytearray(scoring.pack_counts(own, np.zeros(0, dtype=np.int64)))))
    grams = spark.createDataFrame(rows, "bucket long, level long, n long, data binary")
    found = scoring.build_filter(grams, buckets, 2, 1 << 20)
    got = found.levels(pairs)
    assert (got >= levels).all() and (got == levels).mean() > 0.97
    others = scoring.mix(np.arange(10_000, 16_000, dtype=np.uint64)) >> np.uint64(16)
    assert (found.levels(others) == 0).mean() > 0.97


# mixing

def test_mix_hard_cases(hard, empty):
    rows = mixing.mix_sources(hard).collect()
    assert len(rows) == hard.count()
    sources = {}
    for r in hard.select("source", "text").collect():
        sources[r.source] = sources.get(r.source, 0) + len(words(r.text))
    names = [*sorted(s for s in sources if s is not None), None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, clamped = sum(sources.values()), set()
    while True:
        rest = total - sum(3 * sources[s] for s in clamped)
        open_weight = sum(weights[s] for s in names if s not in clamped)
        above = {s for s in names if s not in clamped and rest * weights[s] / open_weight >= 3 * sources[s]}
        if not above:
            break
        clamped |= above
    target = {s: 3.0 * sources[s] if s in clamped else rest * weights[s] / open_weight for s in names}
    assert {(r.source_size, round(r.target, 6)) for r in rows} == {(sources[s], round(target[s], 6)) for s in names}
    taken = collections.Counter()
    for r in rows:
        taken[(r.source_size, round(r.target, 6))] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert all(0 <= t - n < 1 + 1e-6 for (_, t), n in taken.items())
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_sources(hard).collect()))
    assert mixing.mix_sources(empty).count() == 0


# the pipeline

def test_pipeline_stages(spark, small_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = common.stored(stage(spark, docs, small_dir), f"test-{name}")
        assert docs.columns == before.columns
        counts.append(docs.count())
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "near_dedup":
            again = neardup.near_duplicate_classes(before).collect()
            assert ids == {r.doc_id for r in again if r.kept}
        if name == "decontamination":
            bench = spark.read.parquet(f"{small_dir}/benchmark.parquet")
            gone = {r.doc_id for r in leaks.find_leaks(before, bench).collect()}
            assert ids == {r.doc_id for r in before.select("doc_id").collect()} - gone and gone
    assert counts == sorted(counts, reverse=True) and counts[-1] >= 0.7 * counts[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small_dir)
    assert last.count() == counts[-1]


def test_language_stage_keeps_columns_of_any_name(spark):
    rows = [(i, "the cat sat on the mat" if i % 2 else "der Hund lag auf dem Teppich", "en" if i % 2 else "de", i)
            for i in range(40)] + [(40, "12 !!", "en", 40), (41, None, "de", 41), (42, "the cat sat", "en", 42)] * 2
    docs = spark.createDataFrame([(*r, *r[3:] * 3) for r in rows],
                                 "doc_id long, text string, lang string, score int, lang_pred int, Output int, _score int")
    from wayline.llm import stages
    got = [tuple(r) for r in stages.language_id(spark, docs, "").collect()]
    assert sorted(got) == sorted((*r, *r[3:] * 3) for r in rows if r[0] not in (40, 41))


def test_stages_leave_columns_of_any_name(spark, small_dir):
    import corpus_pipeline
    names = ["own", "_own", "key", "_key", "places", "_places", "gone_at", "_gone_at", "kept", "_kept", "kept_key", "nth",
             "_nth", "leak", "_leak", "_n_lines", "n_lines", "_n_dropped", "_score", "score", "_lang_pred", "item_id"]
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    marked = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = sorted(map(tuple, stage(spark, docs, small_dir).collect()), key=str)
        got = stage(spark, marked, small_dir).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == plain, name
        assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names), name


def test_equal_rows_lose_the_same_lines(spark):
    """Rows equal in id and text are one document: they don't make a line recur, and they share a verdict."""
    shared, own = "a line that several of them share", "other words of a document, " * 9
    twice = spark.createDataFrame([(1, f"{own}\n{shared}"), (1, f"{own}\n{shared}"), (2, f"{own[3:]}\n{shared}")],
                                  "doc_id long, text string")
    assert [r._n_dropped for r in lines.drop_recurring_lines(twice).collect()] == [0, 0, 0]
    thrice = twice.unionByName(spark.createDataFrame([(3, f"{own[6:]}\n{shared}")], twice.schema))
    assert [r._n_dropped for r in lines.drop_recurring_lines(thrice).collect()] == [1, 1, 1, 1]


def test_pipeline_stages_on_hard_and_empty_tables(spark, small_dir, hard, empty):
    import corpus_pipeline
    for table in (hard, empty):
        docs = table.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, small_dir), f"test-{name}")
        assert docs.count() <= table.count()


def test_scratch_is_the_named_folder(spark):
    assert os.path.basename(scratch_path(spark, "x")).startswith("x-")


def test_cell_links_join_what_exact_pairs_join():
    import random

    import numpy as np
    draw = random.Random(11)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]

    def edited(n):
        w = list(base)
        for _ in range(n):
            w[draw.randrange(len(w))] = f"x{draw.randrange(10**6)}"
        return " ".join(w).encode()

    texts = [edited(n) for n in [0, 1, 2, 3, 4, 5, 6, 8, 10, 14] * 4] + [b"a b a b a b a b a b a", b"a b a b a b a b a b a b"]
    weights = neardup.Weights(np.zeros((2, neardup.CELLS), np.uint8), np.ones(64), np.ones(1), np.ones(1))

    def counted(text):
        w = text.split()
        return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))

    sets = [counted(t) for t in texts]
    owner = list(range(len(texts)))

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            if (sets[a] & sets[b]).total() >= 0.8 * (sets[a] | sets[b]).total():
                owner[root(a)] = root(b)
    want = collections.Counter(root(i) for i in range(len(texts)))
    every = np.arange(len(texts))
    links = list(neardup.cell_links(texts, every.tolist(), every, every, weights, 0.8))
    assert len(links) == len(texts) - len(want) and all(root(a) == root(b) for a, b in links)
    # texts already of one component give no links
    assert not list(neardup.cell_links(texts, [7] * len(texts), every, every, weights, 0.8))
