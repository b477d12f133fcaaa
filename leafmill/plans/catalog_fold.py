"""The fold over conversations and over line items with repeated and missing chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators.fold import first_arrivals, fold_batch, fold_totals, incomplete_flyers
from leafmill.plans import standins
from leafmill.plans.registry import query

CONVERSATION_FLYERS = """
with t as (
  select conv_id, turn, role, length(text) as len, len(string_split(text, chr(10))) as lines,
         date '2024-01-01' + (length(text) % 366)::int as day, {cached} as cached,
         case when role = 'system' then 'sys-' || conv_id end as pid,
         case when role = 'user' then length(text) / 4.0::double end as la,
         case when role = 'user' then length(text) / -2.0::double end as lo
  from conversations
)
select conv_id::varchar as checksum,
  'flyer://conversations/' || conv_id as url, conv_id || '.json' as filename,
  arg_min(struct_pack(v := pid), turn) filter (where pid is not null or la is not null).v as place_id,
  arg_min(struct_pack(v := la), turn) filter (where pid is not null or la is not null).v as lat,
  arg_min(struct_pack(v := lo), turn) filter (where pid is not null or la is not null).v as lon,
  arg_min(role || '-' || turn, turn) filter (where role = 'assistant') as place_name,
  arg_min(role || '-' || turn, turn) filter (where turn >= 2) as address,
  (max(turn) + 1)::int as chunk_total, count(distinct turn)::int as chunks_seen,
  strftime(max(case when turn = 0 then day end), '%Y-%m-%d') as validity_from,
  strftime(max(case when turn = 0 then day + 7 end), '%Y-%m-%d') as validity_to,
  sum(lines)::bigint as offers_count,
  sum(case when role = 'assistant' then 0 else len end)::bigint as ai_input_tokens,
  coalesce(sum(cached), 0)::bigint as ai_cached_tokens,
  sum(case when role = 'assistant' then len else 0 end)::bigint as ai_output_tokens,
  sum(len / 8.0::double) as processing_time_seconds
from t group by conv_id having count(distinct turn) = max(turn) + 1
"""

CACHED_NULLS = "case when role = 'user' then len(string_split(text, chr(10))) end"


def cached_with_nulls():
    return F.when(F.col("role") == "user", F.size(F.split("text", "\n", -1)))


@query("fold_batch", CONVERSATION_FLYERS.format(cached="len(string_split(text, chr(10)))"))
def conversations(spark, sf_dir):
    return fold_batch(standins.conversation_chunks(spark, sf_dir)).drop("copies")


@query("fold_null_counters", CONVERSATION_FLYERS.format(cached=CACHED_NULLS))
def null_counters(spark, sf_dir):
    chunks = standins.conversation_chunks(spark, sf_dir, cached_with_nulls())
    return fold_batch(chunks).drop("copies")


@query(
    "fold_stamped",
    "select conv_id::varchar as checksum, true as stamped, 1::bigint as stamps from conversations group by 1",
)
def stamped(spark, sf_dir):
    """Every flyer gets the same processing time within one run."""
    rows = fold_batch(standins.conversation_chunks(spark, sf_dir)).withColumn("processed_at", F.current_timestamp())
    stamps = rows.agg(F.count_distinct("processed_at").alias("n")).scalar()
    return rows.select("checksum", F.col("processed_at").isNotNull().alias("stamped"), stamps.alias("stamps"))


_FIRST_LINES = """
with ranked as (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) as rn
  from lineitem
), first as (select *, l_linenumber - 1 as n from ranked where rn = 1)
"""


@query(
    "fold_messy",
    _FIRST_LINES + """
select l_orderkey::varchar as checksum, max(l_linenumber)::int as chunk_total,
  strftime(max(case when n = 0 then l_shipdate end), '%Y-%m-%d') as validity_from,
  sum(l_quantity)::bigint as offers_count, sum(l_partkey)::bigint as ai_input_tokens,
  coalesce(sum(case when l_returnflag = 'R' then l_suppkey end), 0)::bigint as ai_cached_tokens,
  sum(l_quantity / 8.0::double) as processing_time_seconds
from first group by 1 having count(*) = max(l_linenumber)""",
)
def messy(spark, sf_dir):
    flyers = fold_batch(standins.line_chunks(spark, sf_dir), "arrival")
    return flyers.select(
        "checksum", "chunk_total", "validity_from", "offers_count", "ai_input_tokens", "ai_cached_tokens",
        "processing_time_seconds",
    )


@query(
    "fold_incomplete",
    """select l_orderkey::varchar as checksum, count(distinct l_linenumber)::int as chunks_seen,
  max(l_linenumber)::int as chunk_total
from lineitem group by 1 having count(distinct l_linenumber) <> max(l_linenumber)""",
)
def incomplete(spark, sf_dir):
    return incomplete_flyers(standins.line_chunks(spark, sf_dir), "arrival")


@query(
    "fold_source_precedence",
    _FIRST_LINES + """
select l_orderkey::varchar as checksum,
  arg_min(struct_pack(v := case when s_acctbal >= 5000 then s_name end), n) filter (where s_acctbal >= 5000).v as place_id,
  arg_min(struct_pack(v := s_acctbal), n) filter (where s_acctbal >= 5000).v as lat,
  arg_min(struct_pack(v := case when s_acctbal >= 7000 then s_acctbal end), n) filter (where s_acctbal >= 5000).v as lon,
  arg_min(s_name, n) filter (where s_acctbal between 2000 and 8000) as place_name,
  arg_min(s_name, n) filter (where s_acctbal < 3000) as address
from first left join supplier on l_suppkey = s_suppkey group by 1""",
)
def source_precedence(spark, sf_dir):
    """The place of the lowest chunk that has one, whatever was announced with the others."""
    folded = fold_totals(first_arrivals(standins.line_chunks(spark, sf_dir), "arrival"))
    return folded.select("checksum", "place_id", "lat", "lon", "place_name", "address")
