"""The registered queries of the text operators and their statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm import (
    chat,
    exact,
    language,
    leaks,
    lines,
    middle,
    mixing,
    neardup,
    negatives,
    passages,
    records,
    scoring,
    warc,
)
from wayline.llm.common import stored, table
from wayline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return wrap


@query("op1_chat_format", r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown as (
    select *, regexp_replace(text, '([<\[])(\\*)(/?(?:s>|(?:INST|SYS|ROLE)\]))', '\1\\\2\3', 'g') as safe,
        regexp_replace(role, '([<\[])(\\*)(/?(?:s>|(?:INST|SYS|ROLE)\]))', '\1\\\2\3', 'g') as safe_role,
        row_number() over (partition by conv_id order by turn, role, text) as place from turns)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
    sum(7 + length(safe) + case role when 'user' then 6 when 'assistant' then 7 when 'system' then 5
        else 13 + length(safe_role) end)::bigint as formatted_chars
from shown group by conv_id""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)],
                                  "conv_id long, turn long, role string, text string")
    vocabulary = chat.load_vocabulary(spark, chat.VOCABULARY)
    formatted = chat.format_conversations(turns.unionByName(extra), vocabulary)
    return chat.conversation_digests(formatted, vocabulary).drop("n_tokens")


@query("op2_warc_salvage", """
with payloads as (
    select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes,
        sha1(coalesce(html, '')) as payload_digest from pages),
firsts as (
    select *, max(page_id) over (partition by payload_digest) as first_id from payloads)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id <> first_id then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id <> first_id then first_id end as refers_to
from firsts""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query("op3_benchmark_leaks")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("key")


@query("op4_repeated_passages", r"""
with listed as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
windows as (
    select doc_id, t.pos, array_to_string(words[t.pos:t.pos + 34], ' ') as passage
    from listed, unnest(generate_series(1, len(words) - 34)) as t(pos)),
repeated as (select passage from windows group by passage having count(*) > 1),
covered as (
    select distinct doc_id, pos + k.i as place
    from windows join repeated using (passage), range(35) as k(i)),
placed as (
    select doc_id, t.place, words[t.place] as word from listed, unnest(generate_series(1, len(words))) as t(place)),
kept as (
    select p.doc_id, count(c.place) as n_removed,
        string_agg(p.word, ' ' order by p.place) filter (c.place is null) as kept_text
    from placed p left join covered c on p.doc_id = c.doc_id and p.place = c.place group by p.doc_id)
select l.doc_id, len(l.words)::bigint as n_words, coalesce(k.n_removed, 0)::bigint as n_removed,
    sha256(coalesce(k.kept_text, '')) as kept_sha256
from listed l left join kept k on l.doc_id = k.doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.drop_repeated_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_line_templates", r"""
with based as (
    select doc_id, coalesce(text, '') as body, string_split(coalesce(text, ''), chr(10)) as listed,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_words
    from documents),
lines as (
    select doc_id, t.pos, list_transform(regexp_extract_all(listed[t.pos], '[^\x20\x09-\x0D]+'),
        lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end) as tokens
    from based, unnest(generate_series(1, len(listed))) as t(pos)),
leafed as (
    select *, len(tokens) as words, struct_pack(n := len(tokens), lead := tokens[1:3]) as leaf
    from lines where len(tokens) >= 3),
counted as (
    select leaf, tokens, words, count(distinct doc_id) as docs from leafed group by leaf, tokens, words),
open_leaves as (
    select leaf from counted where words > 3 group by leaf
    having sum(docs) >= 3 and count(*) > 1 and min(docs) < 3),
texts as (select c.* from counted c where leaf in (select leaf from open_leaves)),
laid as (
    select leaf, tokens, docs, t.place, tokens[t.place] as token
    from texts, unnest(generate_series(1, words)) as t(place)),
constant as (select leaf, place, token from laid group by leaf, place, token having sum(docs) >= 3),
fixed as (
    select l.leaf, l.tokens, any_value(l.docs) as docs, count(*) filter (l.place > 3) as behind,
        list(struct_pack(place := l.place, token := l.token) order by l.place) as template
    from laid l join constant c on l.leaf = c.leaf and l.place = c.place and l.token = c.token
    group by l.leaf, l.tokens),
near as (select * from fixed where behind >= 0.7 * (len(tokens) - 3)),
recurring as (select leaf, template from near group by leaf, template having sum(docs) >= 3),
flagged as (
    select tokens from counted where docs >= 3
    union select n.tokens from near n join recurring r on n.leaf = r.leaf and n.template = r.template),
gone as (select l.doc_id, l.pos, l.words from leafed l where l.tokens in (select tokens from flagged)),
chosen as (
    select b.doc_id, list(g.pos) as places
    from based b join gone g on b.doc_id = g.doc_id
    group by b.doc_id having sum(g.words) <= 0.3 * any_value(b.n_words))
select b.doc_id, len(b.listed)::bigint as n_lines, coalesce(len(c.places), 0)::bigint as n_dropped,
    sha256(case when c.places is null then b.body else array_to_string(
        list_transform(list_filter(generate_series(1, len(b.listed)), lambda i: not list_contains(c.places, i)),
            lambda i: b.listed[i]), chr(10)) end) as kept_sha256
from based b left join chosen c on b.doc_id = c.doc_id""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op6_exact_dedup", r"""
with hashed as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
    from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = min(doc_id) over same as kept, text_sha256
from hashed window same as (partition by text_sha256)""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(table(spark, sf_dir, "documents"))


@query("op8_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_classes(table(spark, sf_dir, "documents")).drop("key")


@query("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = language.remainder(F.col("doc_id"), 7)
    return scoring.score_texts(table(spark, sf_dir, "documents"), part != 2, part == 2)


@query("op10_source_mix", r"""
with recursive sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        substr(sha256('mix:' || coalesce(doc_id::varchar, '')), 1, 16) as draw
    from documents),
sources as (
    select source, sum(size)::bigint as source_size, 3.0::double * sum(size) as cap,
        [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
    from sized group by source),
ordered as (
    select *, (select sum(source_size) from sources)::double as total,
        coalesce(sum(cap) over before, 0.0) as caps_before, coalesce(sum(weight) over before, 0.0) as weight_before,
        (select sum(weight) from sources) as weights
    from sources
    window before as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
filled as (
    select *, cap / weight <= (total - caps_before) / (weights - weight_before) as clamped from ordered),
level as (
    select any_value(total) - coalesce(sum(cap) filter (clamped), 0.0) as room,
        sum(weight) filter (not clamped) as open_weight from filled),
targets as (
    select source, source_size, case when clamped then cap else room * weight / open_weight end as target
    from filled, level),
epochs as (
    select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from targets),
placed as (
    select s.doc_id, s.size, e.source_size, e.target, e.whole,
        floor(e.target)::bigint - e.whole * e.source_size as rest,
        coalesce(sum(s.size) over (partition by s.source order by s.draw, s.doc_id, s.size
            rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from sized s join epochs e on s.source is not distinct from e.source)
select doc_id, size, source_size, target,
    (whole * size + greatest(0, least(size, rest - before)))::bigint as taken
from placed""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor(256 * x::double) for x in embedding] as v
    from embeddings
    where label is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (
    select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same,
        list_inner_product(a.v, r.v)::bigint as score
    from rows a join rows r on a.vec_id <> r.vec_id where a.vec_id % 50 = 0),
positives as (
    select anchor_id, id as positive_id, score as positive_score from pairs where same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
found as (
    select anchor_id, positive_id, id as negative_id, positive_score, score as negative_score,
        row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank
    from positives join pairs using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from found where rank <= 3""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(negatives.usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    ready = rows.select("vec_id", label.alias("label"), negatives.quantised(F.col("embedding")).alias("vector"))
    return negatives.mine_hard_negatives(ready, F.col("vec_id") % 50 == 0)


@query("op12_fill_in_middle", r"""
with lines as (
    select doc_id, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
        sha256('7:' || coalesce(doc_id::varchar, '')) as h
    from documents),
draws as (
    select *, len(units)::bigint as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
        ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
    from lines),
cuts as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
            or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form
    from draws),
parts as (
    select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle,
        array_to_string(units[b + 1:], '') as suffix
    from cuts)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from parts""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = stored(middle.write_frames(table(spark, sf_dir, "documents")), "text-frames")
    return middle.middle_digests(middle.transform_middle(middle.plan_cuts(framed)))


@query("op13_token_records")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tokenizer = records.load_tokenizer(spark, public_tokenizers.path("word_bpe_49k.json"))
    path = scratch_path(spark, "token-records")
    records.write_records(docs, path, tokenizer)
    index = records.write_index(spark, path, scratch_path(spark, "token-index"))
    return index.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "start", "n_tokens", "ids_crc32",
                        F.element_at(F.split("file", "/"), -1).alias("file"), "offset")
