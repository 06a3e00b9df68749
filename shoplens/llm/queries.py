"""The operators applied to whole test tables, and SQL with the same results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.llm import (
    chat, decontaminate, divergence, embeddings, html_text, importance, language, language_model,
    minhash, packing, suffix_dedup, token_files, topk,
)
from shoplens.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# a conversation whose texts contain the control strings
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    log = chat.log_of_turns(turns.unionByName(probe))
    return chat.digests(chat.read_back(chat.render(chat.reconstruct(log))))


CHAT_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized as (
  select *, replace(replace(replace(text, '\', '\s'), '</turn>', '\e'), '### ', '\h') as escaped,
    replace(replace(replace(replace(role, '\', '\s'), '</turn>', '\e'), '### ', '\h'), chr(10), '\n')
      as escaped_role
  from rows
), folded as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as whole,
    coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as learnt,
    sum(4 + length(escaped_role) + 2 + length(escaped) + 8) as formatted_chars
  from sized group by conv_id
)
select conv_id, n_turns, sha256(whole) as turns_sha256, cast(length(learnt) as bigint) as loss_chars,
  sha256(learnt) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars
from folded
"""

def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    texts = pages.select("page_id", "url", html_text.extract("html").alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def _doc_hash(modulus: int):
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (_doc_hash(5) == 0).alias("held_out")
    )
    filters = language.fit(docs.filter(~F.col("held_out")))
    return language.identify(docs.drop("lang"), filters).drop("text")


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, n_words=3, least=(85, 100))


MINHASH_SQL = r"""
with recursive doc_words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, w[k:k + 2] as shingle
  from doc_words, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as t(k) where len(w) > 0
), sizes as (select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), links as (
  select a, b from shared s join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * s.n >= 85 * (x.n + y.n - s.n)
), reached as (
  select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a
), parts as (select a, least(a, min(b)) as component from reached group by a
)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(component, d.doc_id) as component_id,
  d.doc_id = coalesce(component, d.doc_id) as kept
from documents d left join sizes s on s.doc_id = d.doc_id left join parts on a = d.doc_id
"""


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.9)


EMBEDDING_SQL = """
with recursive usable as (
  select vec_id, embedding::double[] as x from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda v: v is null or isnan(v) or isinf(v))) = 0
    and len(list_filter(embedding, lambda v: v <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.vec_id <> b.vec_id
    and len(a.x) = len(b.x)
  where list_cosine_similarity(a.x, b.x) >= 0.9
), reached as (
  select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a
), parts as (select a, least(a, min(b)) as component_id from reached group by a
), counted as (select a, count(*) as n_links from links group by a)
select vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, vec_id) as component_id,
  vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join parts on parts.a = vec_id left join counted on counted.a = vec_id
"""


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.find_leaks(docs, items, window=10)
    as_strings = F.array_sort(F.col("item_ids").cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"]).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(as_strings, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


DECONTAMINATION_SQL = r"""
with doc_words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), item_words as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), phrases as (
  select distinct item_id, least(len(w), 10) as n, w[k:k + least(len(w), 10) - 1] as phrase
  from item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(k) where len(w) > 0
), lengths as (select distinct n from phrases
), doc_runs as (
  select doc_id, k, n, w[k:k + n - 1] as phrase
  from doc_words, lengths, unnest(range(1, len(w) - n + 2)) as t(k)
), hits as (
  select doc_id, k, r.n, item_id from doc_runs r join phrases p on r.n = p.n and r.phrase = p.phrase
), covered as (
  select doc_id, count(distinct place) as n_hit
  from (select distinct doc_id, k, n from hits), unnest(range(k, k + n)) as t(place) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct doc_id, item_id from hits) group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join covered c on c.doc_id = d.doc_id left join items i on i.doc_id = d.doc_id
"""


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    token_files.write(_table(spark, sf_dir, "documents"), path, end_id=2)
    return token_files.read_documents(spark, path)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), capacity=4096, end_id=1)


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", (_doc_hash(7) != 2).alias("train")
    )
    return language_model.score(docs).withColumn("held_out", _doc_hash(7) == 2)


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), width=50)
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["length"])
        .alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SUFFIX_SQL = """
with bytes as (
  select doc_id, encode(coalesce(text, '')) as b, octet_length(encode(coalesce(text, ''))) as n
  from documents
), windows as (
  select doc_id, p, b[p:p + 49] as string
  from bytes, unnest(range(1, n - 48)) as t(p)
), firsts as (select string, min(doc_id) as doc_id from windows group by string
), repeated as (
  select w.doc_id, w.p,
    coalesce(w.p > 50 + lag(w.p) over (partition by w.doc_id order by w.p), false) as apart
  from windows w join firsts f on w.string = f.string and w.doc_id > f.doc_id
), numbered as (
  select doc_id, p, count_if(apart) over (partition by doc_id order by p) as run from repeated
), spans as (
  select doc_id, run, min(p) as low, max(p) + 49 as high from numbered group by doc_id, run
), edges as (
  select doc_id, low, coalesce(lag(high) over (partition by doc_id order by low), 0) + 1 as from_
  from spans union all
  select d.doc_id, d.n + 1, coalesce(max(high), 0) + 1 from bytes d left join spans s
    on s.doc_id = d.doc_id group by d.doc_id, d.n
), kept as (
  select e.doc_id, string_agg(case when low > from_ then hex(b[from_:low - 1]) else '' end, ''
                              order by from_) as digits
  from edges e join bytes d on d.doc_id = e.doc_id group by e.doc_id
), removed as (
  select doc_id, sum(high - low + 1) as n_removed, count(*) as n_spans from spans group by doc_id
)
select d.doc_id, cast(d.n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans, sha256(from_hex(digits)) as kept_sha256
from bytes d join kept k on k.doc_id = d.doc_id left join removed r on r.doc_id = d.doc_id
"""


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return importance.draw(docs, target).drop("n_words")


IMPORTANCE_SQL = r"""
with crc_table as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i)) as t
), texts as (
  select 's' as part, row_number() over () as r, doc_id, text from documents
  union all select 't', row_number() over (), null, text from benchmark
), words as (
  select part, r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts
), features as (
  select part, r, unnest(w) as feature from words
  union all
  select part, r, w[k] || ' ' || w[k + 1] from words, unnest(range(1, len(w))) as u(k)
), hashed as (
  select feature, xor(4294967295, list_reduce(
    list_transform(range(1, octet_length(encode(feature)) + 1),
                   lambda i: ('0x' || hex(encode(feature)[i:i]))::bigint),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), 4294967295)) % 10000 as bucket
  from (select distinct feature from features), crc_table
), placed as (select part, r, bucket from features join hashed using (feature)
), counts as (
  select bucket, count_if(part = 's')::double as s, count_if(part = 't')::double as t
  from placed group by bucket
), totals as (select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from counts
), gains as (
  select bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::bigint
    as gain
  from counts, totals
), weights as (
  select r, count(*) as n_features, floor(sum(gain) / count(*))::bigint as weight
  from placed join gains using (bucket) where part = 's' group by r
), scored as (
  select w.r, doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features,
    coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
      / 4294967296)))::bigint as score
  from words w left join weights x on x.r = w.r where part = 's'
), ranked as (
  select r, row_number() over (order by score desc, doc_id nulls last) as rank,
    25 * count(*) over () // 100 as drawn
  from scored where n_words >= 20
)
select doc_id, n_features, weight, score, case when rank <= drawn then rank end as rank
from scored left join ranked using (r)
"""


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), every=20, k=20)


TOP_K_SQL = """
with usable as (
  select row_number() over () as r, vec_id,
    list_transform(embedding::double[], lambda x: floor(64 * x)) as t
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda v: v is null or isnan(v) or isinf(v))) = 0
), width as (select coalesce(max(len(t)), 0) as n from usable
), padded as (select r, vec_id, list_resize(t, n, 0) as t from usable, width
), scored as (
  select q.r, q.vec_id as query_id, c.vec_id,
    cast(list_inner_product(q.t, c.t) as bigint) as score
  from padded q join padded c on q.r <> c.r where q.vec_id % 20 = 0
), ranked as (
  select query_id, vec_id, score,
    cast(row_number() over (partition by r order by score desc, vec_id) as int) as rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), least=3, ranks=200)


DIVERGENCE_SQL = r"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), occurrences as (select r, lang, source, unnest(w) as term from docs
), kept as (
  select lang, term, count(*) as n from occurrences group by lang, term
  having count(distinct r) >= 3
), langs as (
  select lang, count(*)::hugeint as v, sum(n)::hugeint as total from kept group by lang
), groups as (select distinct lang, source from docs
), held as (
  select g.lang, g.source, k.term, k.n as lang_n, coalesce(o.n, 0) as n
  from groups g join kept k on k.lang = g.lang
  left join (select lang, source, term, count(*) as n from occurrences group by all) o
    on o.lang = g.lang and o.source = g.source and o.term = k.term
), totals as (
  select lang, source, sum(n)::hugeint as total from held group by lang, source
), shares as (
  select h.lang, h.source, h.term, h.n,
    1 + 1000000000 * (h.n + 1)::hugeint // (t.total + l.v) as p,
    1 + 1000000000 * (h.lang_n + 1)::hugeint // (l.total + l.v) as q
  from held h join totals t on t.lang = h.lang and t.source = h.source join langs l on l.lang = h.lang
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item,
    sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source
  union all
  select a.lang, a.source, 'pair', b.source, 0
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  where a.lang not in (select lang from langs)
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint
  from shares where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (
    partition by lang, source, part order by value desc, item) as int) as rank
  from found
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200
"""


QUERIES = {
    "op1_chat_formatting": chat_formatting,
    "op2_embedding_near_dedup": embedding_near_dedup,
    "op3_lm_scoring": lm_scoring,
    "op4_html_extraction": html_extraction,
    "op5_benchmark_decontamination": benchmark_decontamination,
    "op6_token_output": token_output,
    "op7_best_fit_packing": best_fit_packing,
    "op8_language_id": language_id,
    "op9_suffix_array_dedup": suffix_array_dedup,
    "op10_minhash_near_dedup": minhash_near_dedup,
    "op11_importance_resampling": importance_resampling,
    "op12_exact_top_k": exact_top_k,
    "op13_source_divergence": source_divergence,
}

ORACLES = {
    "op1_chat_formatting": CHAT_SQL,
    "op2_embedding_near_dedup": EMBEDDING_SQL,
    "op5_benchmark_decontamination": DECONTAMINATION_SQL,
    "op9_suffix_array_dedup": SUFFIX_SQL,
    "op10_minhash_near_dedup": MINHASH_SQL,
    "op11_importance_resampling": IMPORTANCE_SQL,
    "op12_exact_top_k": TOP_K_SQL,
    "op13_source_divergence": DIVERGENCE_SQL,
}
