"""Queries: review jobs, vectors, statement guard and access rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import enrichment as job
from wayline.operators import policies, review_model, vectors
from wayline.sources.files import spread_small_scan
from wayline.workload.registry import query

_HASH = "cast('0x' || substr(md5(cast({0} as varchar) || '||42'), 1, 15) as bigint)"


@query("enrich_candidates", f"""
with todo as (
  select review_id, comment_text from {{stg_reviews}} anti join {{enrichments}} using (review_id)
  where comment_length >= 30 and comment_length <= 2000),
outbound as (select distinct stay_booking_id, true as flown from {{fct_legs_exact}} where leg = 'outbound'),
stays as (
  select review_id, stay_booking_id, coalesce(flown, false) as with_flight
  from {{fct_stay_exact}} left join outbound using (stay_booking_id) where is_cancelled = false),
drawn as (
  select *, row_number() over (partition by with_flight order by {_HASH.format('review_id')}, review_id,
    stay_booking_id) as turn
  from stays join todo using (review_id)),
ranked as (
  select *, row_number() over (order by case when with_flight then 0 else 1 end, turn) as place
  from drawn where turn <= case when with_flight then 100 else 200 end)
select review_id, stay_booking_id, comment_text, with_flight from ranked where place <= 200""")
def _(t):
    return job.enrich_candidates(t["fct_stay_bookings"], t["stg_reviews"], t["fct_flight_bookings"],
                                 t["enrichments"], 200)


@query("enrich_batch_payload", """
with n as (select review_id, comment_text, row_number() over (order by review_id) as n from {stg_reviews}
           where comment_text is not null)
select (n - 1) // 25 as batch_id, cast(count(*) as integer) as n_reviews,
  md5(string_agg('review_id: ' || cast(review_id as varchar) || chr(10) || 'text: ' || comment_text,
                 chr(10) || chr(10) order by n)) as payload_md5 from n group by 1""")
def _(t):
    batches = job.enrich_batch_payload(t["stg_reviews"])
    return batches.select("batch_id", "n_reviews", F.md5("payload").alias("payload_md5"))


_GOOD, _BAD, _LATE = ["anat", "inthe", "le", "la"], ["there", "of", "de"], ["late", "delay", "an"]
_TOPIC_WORDS = {"by": "location", "et": "location", "with": "value", "un": "comfort"}


def _hits(words: list[str]) -> str:
    return f"len(list_filter(w, lambda x: x in ({', '.join(repr(x) for x in words)})))"


@query("enrich_classify", f"""
with s as (select doc_id as review_id, string_split_regex(lower(text), '[^a-z]+') as w from {{documents}}),
h as (select review_id, w, {_hits(_GOOD)} as p, {_hits(_BAD)} as q, {_hits(_LATE)} > 0 as late from s)
select review_id, 'en' as language,
  case when p > 0 and q > 0 then 'mixed' when p > 0 then 'positive' when q > 0 then 'negative' else 'neutral' end
    as sentiment,
  case when p + q = 0 then 0 else cast(p - q as double) / (p + q) end as sentiment_score,
  array_to_string(list_filter([case when list_contains(w, 'by') or list_contains(w, 'et') then 'location' end,
    case when list_contains(w, 'with') then 'value' end, case when list_contains(w, 'un') then 'comfort' end],
    lambda x: x is not null), ',') as topics,
  case when q > 0 then 'negative wording' end as complaint, late as mentions_travel_disruption,
  null::varchar as summary_en from h""")
def _(t):
    reviews = t["documents"].select(F.col("doc_id").alias("review_id"), F.col("text").alias("comment_text"))
    return job.enrich_classify(spread_small_scan(reviews, ["review_id"]), job.word_rule(_GOOD, _BAD, _TOPIC_WORDS, _LATE))


@query("enrich_classify_learned", """
select count(*) as held_out, count(*) as judged from {labels} l join {documents} d on d.doc_id = l.doc_id
where l.doc_id % 4 = 2""")
def _(t):
    texts = t["documents"].select(F.col("doc_id").alias("review_id"), F.col("text").alias("comment_text"))
    rows = t["enrich_rows"].select("review_id", "sentiment").join(texts, "review_id")
    held = F.col("review_id") % 4 == 2
    rule = review_model.learned_rule(review_model.fit_sentiment(rows.filter(~held)), _TOPIC_WORDS, _LATE)
    records = job.enrich_classify(rows.filter(held), rule).select(
        "review_id", F.col("sentiment").alias("found"), "sentiment_score")
    return review_model.held_out_report(records, rows.filter(held)).select("held_out", "judged")


@query("enrich_validate", """
with r as (select review_id, language || '-verylongtag' as language,
    case when review_id % 11 = 0 then 'angry' else sentiment end as sentiment, sentiment_score * 2 as s,
    list_filter(list_concat(topics, ['weather', 'safety', 'noise']), lambda x: x in ('cleanliness', 'location',
      'host_communication', 'check_in', 'value', 'comfort', 'noise', 'amenities', 'accuracy', 'safety', 'transport',
      'neighbourhood', 'other')) as kept from {enrichments})
select review_id, left(language, 8) as language, sentiment, least(greatest(s, -1), 1) as sentiment_score,
  case when review_id % 2 = 0 then 'other' else array_to_string(kept[1:3], ',') end as topics
from r where sentiment <> 'angry' and review_id in (select doc_id from {documents} where lang <> 'de')""")
def _(t):
    even = F.col("review_id") % 2 == 0
    records = t["enrichments"].select(
        "review_id", F.concat("language", F.lit("-verylongtag")).alias("language"),
        F.when(F.col("review_id") % 11 == 0, "angry").otherwise(F.col("sentiment")).alias("sentiment"),
        (F.col("sentiment_score") * 2).alias("sentiment_score"),
        F.when(even, F.array(F.lit("weather"))).otherwise(
            F.concat("topics", F.array(*[F.lit(x) for x in ("weather", "safety", "noise")]))).alias("topics"))
    sent = t["documents"].filter("lang <> 'de'").select(F.col("doc_id").alias("review_id"))
    return job.enrich_validate(records, sent)


@query("enrich_failed_retry", """
select doc_id as review_id, quality from {labels} union all
select doc_id, 7 from {documents} where doc_id % 5 > 0 and doc_id not in (select doc_id from {labels})""")
def _(t):
    results = t["documents"].select(
        F.col("doc_id").alias("review_id"), F.lit(7).alias("quality"),
        F.when(F.col("doc_id") % 5 == 0, "timed out").alias("error"))
    # a second record of every third id, later in order
    again = results.filter("review_id % 3 = 0").withColumn("quality", F.lit(8))
    return job.enrich_failed_retry(results.unionByName(again), t["labels"].select(
        F.col("doc_id").alias("review_id"), "quality"), [F.col("quality")])


@query("embed_candidates", f"""
with quota as (select greatest(1, 300 // count(distinct city)) as each from {{stg_listings}}),
recent as (
  select review_id, listing_id, city, review_date, comment_text from {{stg_reviews}}
  where comment_length >= 40 and comment_length <= 2000 and review_date >= date '2019-01-01'),
todo as (
  select r.* from recent r anti join (select vec_id as review_id from {{embeddings}}) using (review_id)),
known as (select distinct review_id, 0 as late from {{enrichments}}),
placed as (
  select t.*, rank() over (partition by city order by coalesce(late, 1), {_HASH.format('t.review_id')}, t.review_id)
    as place
  from todo t left join known using (review_id))
select p.review_id, p.listing_id, p.city, p.review_date, p.comment_text from placed p, quota where place <= each""")
def _(t):
    embedded = t["embeddings"].select(F.col("vec_id").alias("review_id"))
    return job.embed_candidates(t["stg_reviews"], t["enrichments"], embedded, 300, job.city_count(t["stg_listings"]))


@query("embed_batches", """
with w as (select doc_id, md5(unnest(list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f\\v]+'),
                                                 lambda x: x <> ''))) as h from {documents}),
cells as (select doc_id, cast('0x' || substr(h, 15, 2) as integer) % 64 as cell,
            sum(case when cast('0x' || substr(h, 6, 1) as integer) % 2 = 1 then 1 else -1 end) as v from w group by all),
agg as (select doc_id, count(*) filter (v <> 0) as filled, sqrt(cast(sum(v * v) as double)) as norm,
          max(v) as top, min(v) as low, max(cell) filter (v <> 0) as last_cell from cells group by 1)
select d.doc_id, 64 as dims, coalesce(filled, 0) as filled,
  round(coalesce(greatest(top, case when filled < 64 then 0 end) / norm, 0), 4) as top,
  round(coalesce(least(low, case when filled < 64 then 0 end) / norm, 0), 4) as low
from {documents} d left join agg using (doc_id)""")
def _(t):
    reviews = t["documents"].select("doc_id", F.col("text").alias("comment_text"))
    done = job.embed_batches(spread_small_scan(reviews, ["doc_id"]), job.hashed_words(64))
    v = F.col("embedding")
    return done.select("doc_id", F.size(v).alias("dims"), F.size(F.filter(v, lambda x: x != 0)).cast("bigint").alias(
        "filled"), F.round(F.array_max(v).cast("double"), 4).alias("top"),
        F.round(F.array_min(v).cast("double"), 4).alias("low"))


_SCORED = """
scored as (select q.vec_id as query_id, i.vec_id as id,
    list_cosine_similarity(cast(q.embedding as double[]), cast(i.embedding as double[])) as score
  from {embeddings} q, {embeddings} i),
hits as (select query_id, id, score, row_number() over (partition by query_id order by score desc, id) as rank
         from scored qualify rank <= 8)"""


def _search(t, **options):
    index = t["embeddings"].select(F.col("vec_id").alias("review_id"), "embedding")
    asked = t["embeddings"].select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return vectors.vector_search_topk(index, asked, **options)


@query("vector_search_topk", f"""
with {_SCORED} select query_id, id, round(score, 6) as score, cast(rank as integer) as rank from hits""")
def _(t):
    return _search(t).withColumn("score", F.round("score", 6))


@query("vector_search_lsh", """
with planes as (
  select p, list(('0x' || substr(md5('plane|' || p || '|' || j), 1, 8))::bigint / 4294967296.0::double - 0.5 order by j) as w
  from range(24) a(p), range(64) b(j) group by p),
margins as (
  select vec_id, p // 6 as tbl, p % 6 as bit, list_inner_product(w, cast(embedding as double[])) as margin
  from {embeddings}, planes),
owned as (
  select vec_id, tbl, sum(case when margin > 0 then (1::bigint << bit::bigint) else 0 end)::bigint as code
  from margins group by 1, 2),
probed as (
  select vec_id, tbl, code from (
    select vec_id, tbl, code, sum(case when (margin > 0) <> (((code >> bit::bigint) & 1) = 1) then abs(margin) else 0 end) as cost
    from margins, range(64) c(code) group by 1, 2, 3)
  qualify row_number() over (partition by vec_id, tbl order by cost, code) <= 16),
near as (
  select distinct p.vec_id as query_id, o.vec_id as id from probed p join owned o using (tbl, code)),
scored as (
  select query_id, id, list_cosine_similarity(cast(q.embedding as double[]), cast(i.embedding as double[])) as score
  from near join {embeddings} q on q.vec_id = query_id join {embeddings} i on i.vec_id = id)
select query_id, id, round(score, 6) as score,
  cast(row_number() over (partition by query_id order by score desc, id) as integer) as rank
from scored qualify rank <= 8""")
def _(t):
    return _search(t, method="lsh").withColumn("score", F.round("score", 6))


@query("vector_search_recall", """
select count(*) as queries, count(*) * 8 as wanted, true as enough from {embeddings}""")
def _(t):
    measured = vectors.recall(_search(t, method="lsh"), _search(t))
    return measured.select("queries", "wanted", (F.col("recall") >= 0.9).alias("enough"))


@query("rag_context", f"""
with {_SCORED},
lines as (select query_id, rank, '[' || cast(rank as varchar) || '] (' || city || ', ' || cast(review_date as varchar)
            || ') ' || comment_text as line from hits left join {{stg_reviews}} r on r.review_id = hits.id)
select query_id, cast(count(line) as integer) as n_hits,
  md5(coalesce(string_agg(line, chr(10) || chr(10) order by rank), '')) as context_md5 from lines group by 1""")
def _(t):
    texts = t["stg_reviews"].select("review_id", "city", "review_date", "comment_text")
    found = _search(t).withColumnRenamed("id", "review_id").join(texts, "review_id", "left")
    return vectors.rag_context(found).select("query_id", "n_hits", F.md5("context").alias("context_md5"))


_STATEMENTS = """
case doc_id % 8
  when 0 then '  SELECT * from t where note = ''' || replace(text, '''', '''''') || '''; '
  when 1 then 'with x as (select 1) select ' || text
  when 2 then 'select 1; drop table t'
  when 3 then 'Update t set a = 1'
  when 4 then 'select a from b where c = ''x;delete'' order by 1;;'
  when 5 then text
  when 6 then 'SELECT created_at, listing from sets'
  else 'selectx from y' end"""
# the same statements with Spark's way of writing a quote inside a string
_SPARK_STATEMENTS = """
case doc_id % 8
  when 0 then concat("  SELECT * from t where note = '", replace(text, "'", "''"), "'; ")
  when 1 then concat("with x as (select 1) select ", text)
  when 2 then "select 1; drop table t"
  when 3 then "Update t set a = 1"
  when 4 then "select a from b where c = 'x;delete' order by 1;;"
  when 5 then text
  when 6 then "SELECT created_at, listing from sets"
  else "selectx from y" end"""
_WORDS = "|".join(job.FORBIDDEN_WORDS)


@query("sql_guard_batch", f"""
with s as (select doc_id, {_STATEMENTS} as stmt from {{documents}}),
b as (select doc_id, regexp_replace(regexp_replace(regexp_replace(stmt, '^\\s+|\\s+$', '', 'g'), ';+$', ''),
        '^\\s+|\\s+$', '', 'g') as body from s),
c as (select *, regexp_replace(body, '''(?:[^'']|'''')*''', '''''', 'g') as bare from b),
r as (select *, case when contains(bare, ';') then 'several_statements'
    when not regexp_matches(bare, '^(select|with)\\b', 'i') then 'not_a_read'
    when regexp_matches(bare, '\\b({_WORDS})\\b', 'i') then
      'write_word:' || upper(regexp_extract(bare, '\\b({_WORDS})\\b', 1, 'i')) end as reason from c)
select doc_id, reason, reason is null as ok, case when reason is null then md5(body) end as statement_md5 from r""")
def _(t):
    rows = t["documents"].select("doc_id", F.expr(_SPARK_STATEMENTS).alias("stmt"))
    return job.sql_guard_batch(rows, "stmt").select("doc_id", "reason", "ok", F.md5("statement").alias("statement_md5"))


@query("row_access_filter", """
select 'ANALYST_ROLE' as role, booking_status, count(*) as n from {raw_stay_bookings}
where booking_status = 'completed' group by all union all
select 'SYSADMIN', booking_status, count(*) from {raw_stay_bookings} group by all""")
def _(t):
    seen = None
    for role in ("ANALYST_ROLE", "SYSADMIN", "GUEST_ROLE"):
        part = job.row_access_filter(t["raw_stay_bookings"], role).groupBy(
            F.lit(role).alias("role"), "booking_status").agg(F.count(F.lit(1)).alias("n"))
        seen = part if seen is None else seen.unionByName(part)
    return seen


@query("column_mask", """
select 'ANALYST_ROLE' as role, user_id, '***@' || split_part(email, '@', 2) as email, '***-***-****' as phone
from {raw_users} union all
select 'DBT_ROLE', user_id, email, source_reviewer_id from {raw_users}""")
def _(t):
    users = t["raw_users"].select("user_id", "email", F.col("source_reviewer_id").alias("phone"))
    kinds = {"email": "email", "phone": "phone"}
    return job.column_mask(users, "ANALYST_ROLE", kinds).select(F.lit("ANALYST_ROLE").alias("role"), "*").unionByName(
        job.column_mask(users, "DBT_ROLE", kinds).select(F.lit("DBT_ROLE").alias("role"), "*"))


@query("row_access_policy", """
select 'ANALYST_ROLE' as role, booking_status, count(*) as n from {raw_stay_bookings}
where booking_status = 'completed' group by all union all
select 'SYSADMIN', booking_status, count(*) from {raw_stay_bookings} group by all""")
def _(t):
    policies.protected_view(t["raw_stay_bookings"], "stays_by_role", rows=policies.BOOKING_ROWS)
    seen = None
    for role in ("ANALYST_ROLE", "SYSADMIN", "GUEST_ROLE"):
        policies.set_role(t.spark, role)
        part = t.spark.sql("select session.wayline_role as role, booking_status, count(*) as n from stays_by_role group by 2")
        seen = part if seen is None else seen.unionByName(part)
    policies.set_role(t.spark)
    return seen


@query("column_mask_policy", """
select 'ANALYST_ROLE' as role, user_id, '***@' || split_part(email, '@', 2) as email, '***-***-****' as phone
from {raw_users} union all
select 'DBT_ROLE', user_id, email, source_reviewer_id from {raw_users}""")
def _(t):
    users = t["raw_users"].select("user_id", "email", F.col("source_reviewer_id").alias("phone"))
    policies.protected_view(users, "users_by_role", masks={"email": "email", "phone": "phone"})
    seen = None
    for role in ("ANALYST_ROLE", "DBT_ROLE"):
        policies.set_role(t.spark, role)
        part = t.spark.sql("select session.wayline_role as role, * from users_by_role")
        seen = part if seen is None else seen.unionByName(part)
    policies.set_role(t.spark)
    return seen
