"""One query per corpus operator, over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from leafmill.llm import (
    bpe,
    chat,
    embed_dedup,
    filter_audit,
    hard_negatives,
    html_text,
    langid,
    mixing,
    near_dup,
    quality,
    token_counts,
    top_k,
    toxicity,
)
from leafmill.llm.common import table
from leafmill.plans.registry import query

_CHAT_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, n, r, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(n, r)
),
r as (
  select *, '### ' || replace(replace(replace(role, '%', '%25'), ':', '%3A'), chr(10), '%0A') || ': '
    || regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g') || chr(10) || '</turn>' || chr(10) as shown
  from t
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(shown))::bigint as formatted_chars
from r group by conv_id
"""


@query("op4_chat_format", _CHAT_SQL)
def op4_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(chat.events_of_turns(turns.unionByName(chat.probe(spark)))))


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_bpe_round_trip")
def op8_bpe_round_trip(spark, sf_dir):
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_NEAR_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
  from words
),
shingles as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
  select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach as (select doc_id as a, doc_id as b from sets union select r.a, l.b from reach r join links l on r.b = l.a),
least_id as (select a, min(b) as component_id from reach group by a)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept
from sets join least_id on a = doc_id
"""


@query("op5_minmax_near_dup", _NEAR_SQL)
def op5_minmax_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), n=4)


@query("op3_weak_quality")
def op3_weak_quality(spark, sf_dir):
    judged = quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


@query("op9_byte_gru_language")
def op9_byte_gru_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


_VECTOR_SQL = """
with recursive sound as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
  select a.vec_id as a, b.vec_id as b from sound a join sound b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.95
),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on r.b = l.a),
least_id as (select a, min(b) as component_id from reach group by a),
counted as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings join least_id on least_id.a = vec_id left join counted on counted.a = vec_id
"""


@query("op2_cell_vector_dedup", _VECTOR_SQL)
def op2_cell_vector_dedup(spark, sf_dir):
    return embed_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op1_counterfactual_toxicity")
def op1_counterfactual_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.judge_toxicity(documents, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


@query("op10_host_consensus_text")
def op10_host_consensus_text(spark, sf_dir):
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


@query("op7_soft_mixing")
def op7_soft_mixing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    labelled = mixing.labelled_sample(documents, table(spark, sf_dir, "labels"), "lang")
    return mixing.mix(documents.select("doc_id", "text"), labelled)


def _whole_sql(factor: int, more: str = "vec_id") -> str:
    return f"""
v as (
  select {more}, list_transform(embedding, lambda x: floor({factor} * x::double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)"""


_TOP_K_SQL = f"""
with {_whole_sql(64)},
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0
),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""


@query("op11_mtree_top_k", _TOP_K_SQL)
def op11_mtree_top_k(spark, sf_dir):
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=64)


_AUDIT_SQL = r"""
with m as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') as w
  from documents
),
f as (
  select part, doc_id, case when len(w) < 50 then 'A' else '' end || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
    || case when 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as failed
  from m
),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1),
p as (
  select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from f left join l using (doc_id) group by 1, 2
),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from x a, x b, x c, x d, x e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
r as (
  select p.*, filter_order,
    coalesce(list_min(list_filter([1, 2, 3, 4, 5], lambda i: contains(failed, substr(filter_order, i, 1)))), 6) as gone
  from p, o
),
s as (
  select part, filter_order, step, substr(filter_order, step, 1) as letter,
    coalesce(sum(n) filter (gone > step), 0) as kept, coalesce(sum(n) filter (gone = step), 0) as removed,
    coalesce(sum(n) filter (gone < step and contains(failed, substr(filter_order, step, 1))), 0) as redundant,
    coalesce(sum(n) filter (failed = substr(filter_order, step, 1)), 0) as unique_fails,
    coalesce(sum(good) filter (gone = step), 0) as good_lost, coalesce(sum(toxic) filter (gone = step), 0) as toxic_lost
  from r, (select unnest([1, 2, 3, 4, 5])::int as step) group by 1, 2, 3
)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint as shapley
from s
"""


@query("op12_min_plus_audit", _AUDIT_SQL)
def op12_min_plus_audit(spark, sf_dir):
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_NEGATIVES_SQL = f"""
with {_whole_sql(256, "vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label")},
s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.e, c.e)::bigint as score
  from v a join v c on a.vec_id <> c.vec_id and len(a.e) = len(c.e) where a.vec_id % 100 = 0 and a.label is not null and c.label is not null
),
p as (
  select *, row_number() over (partition by anchor_id order by score desc, vec_id) as n from s where same
),
r as (
  select anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
    row_number() over (partition by anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank
  from p join s using (anchor_id) where p.n <= 5 and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from r where rank <= 10
"""


@query("op13_four_russians_negatives", _NEGATIVES_SQL)
def op13_four_russians_negatives(spark, sf_dir):
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", noisy)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
