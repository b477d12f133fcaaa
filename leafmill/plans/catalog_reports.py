"""Dashboard reports over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators.fold import fold_batch
from leafmill.operators.ingest import place_lists, propagate_places
from leafmill.plans import dashboards, standins
from leafmill.plans.registry import query

_OFFERS = "select l_orderkey, p_type, p_brand, p_retailprice from lineitem join part on l_partkey = p_partkey"


@query(
    "q_top_categories",
    f"select p_type as category, count(*) as n from ({_OFFERS}) group by 1 order by n desc, category limit 10",
)
def top_categories(spark, sf_dir):
    return dashboards.top_categories(standins.offers(spark, sf_dir))


@query(
    "q_top_types",
    f"select p_brand as type, count(*) as n from ({_OFFERS}) group by 1 order by n desc, type limit 10",
)
def top_types(spark, sf_dir):
    return dashboards.top_types(standins.offers(spark, sf_dir))


_BY_PLACE = """
with place as (
  select distinct l_orderkey, n_name as place
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  where n_name <> 'NATION_7'
), counted as (
  select place, count(*) as n from lineitem left join place using (l_orderkey) group by 1
)
select place, n, round(100.0 * n / sum(n) over (), 4) as share from counted
"""


@query("q_offers_by_place", _BY_PLACE)
def offers_by_place(spark, sf_dir):
    places = standins.sightings(spark, sf_dir).select("checksum", F.col("entry.name").alias("place_name"))
    return dashboards.offers_by_place(standins.offers(spark, sf_dir), places)


@query("q_offers_by_source", _BY_PLACE)
def offers_by_source(spark, sf_dir):
    flyers = place_lists(standins.sightings(spark, sf_dir), F.struct("arrival", "place_id"))
    return dashboards.offers_by_source(propagate_places(standins.offers(spark, sf_dir), flyers))


@query("q_flyer_count", "select count(*) as flyers from orders")
def flyer_count(spark, sf_dir):
    return dashboards.flyer_count(standins.flyers(spark, sf_dir))


_FLYERS = """(
  select o_orderkey, coalesce(n, 0) as offers_count
  from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) on o_orderkey = l_orderkey
)"""


@query("q_avg_offers", f"select avg(offers_count) as avg_offers from {_FLYERS}")
def avg_offers(spark, sf_dir):
    return dashboards.average_offers(standins.flyers(spark, sf_dir))


@query("q_total_offers", f"select cast(sum(offers_count) as bigint) as total_offers from {_FLYERS}")
def total_offers(spark, sf_dir):
    return dashboards.total_offers(standins.flyers(spark, sf_dir))


_CONVERSATIONS = """(
  select conv_id, sum(length(text) / 8.0::double) as seconds,
         sum(case when role = 'assistant' then 0 else length(text) end) as tokens_in,
         sum(case when role = 'assistant' then length(text) else 0 end) as tokens_out
  from conversations group by 1 having count(distinct turn) = max(turn) + 1
)"""


@query("q_avg_seconds", f"select avg(seconds) as avg_seconds from {_CONVERSATIONS}")
def avg_seconds(spark, sf_dir):
    return dashboards.average_seconds(fold_batch(standins.conversation_chunks(spark, sf_dir)))


@query("q_avg_tokens_in", f"select avg(tokens_in) as avg_tokens_in from {_CONVERSATIONS}")
def avg_tokens_in(spark, sf_dir):
    return dashboards.average_input_tokens(fold_batch(standins.conversation_chunks(spark, sf_dir)))


@query("q_avg_tokens_out", f"select avg(tokens_out) as avg_tokens_out from {_CONVERSATIONS}")
def avg_tokens_out(spark, sf_dir):
    return dashboards.average_output_tokens(fold_batch(standins.conversation_chunks(spark, sf_dir)))


@query(
    "q_price_buckets",
    f"""select floor(p_retailprice / 5.0) * 5.0::double as bucket, count(*) as n from ({_OFFERS})
        group by 1 having count(*) > 5 order by 1""",
)
def price_buckets(spark, sf_dir):
    return dashboards.price_buckets(standins.offers(spark, sf_dir))


@query(
    "q_price_buckets_parts",
    """select floor(p_retailprice / 5.0) * 5.0::double as bucket, count(*) as n from part
       group by 1 having count(*) > 5 order by 1""",
)
def price_buckets_parts(spark, sf_dir):
    parts = standins.table(spark, sf_dir, "part").select(F.col("p_retailprice").alias("price"))
    return dashboards.price_buckets(parts)


def _histogram_sql(unit: str) -> str:
    return f"""
with span as (select min(o_orderdate) as low, max(o_orderdate) as high from orders),
     axis as (select {unit} as unit, low, high from span),
     spine as (
       select unnest(generate_series(
         date_trunc(unit, low)::timestamp, high,
         case unit when 'year' then interval 1 year when 'month' then interval 1 month
                   when 'week' then interval 7 day when 'day' then interval 1 day
                   when 'hour' then interval 1 hour when 'minute' then interval 1 minute
                   else interval 1 second end)) as bucket
       from axis
     ),
     counts as (select date_trunc(unit, o_orderdate)::timestamp as bucket, count(*) as n from orders, axis group by 1)
select strftime(bucket, '%Y-%m-%d %H:%M:%S') as bucket, nullif(n, 0)::double as n
from spine left join counts using (bucket)
"""


_AUTO_UNIT = """case
  when epoch(high) - epoch(low) < 100 then 'second'
  when epoch(high) - epoch(low) < 6000 then 'minute'
  when epoch(high) - epoch(low) < 360000 then 'hour'
  when epoch(high) - epoch(low) < 8640000 then 'day'
  when epoch(high) - epoch(low) < 60480000 then 'week'
  when epoch(high) - epoch(low) < 259200000 then 'month'
  else 'year' end"""


def _histogram(spark, sf_dir, unit=None):
    buckets = dashboards.date_histogram(standins.flyers(spark, sf_dir), unit=unit)
    return buckets.select(F.date_format("bucket", "yyyy-MM-dd HH:mm:ss").alias("bucket"), F.col("n").cast("double"))


@query("q_start_date_histogram", _histogram_sql(_AUTO_UNIT))
def start_date_histogram(spark, sf_dir):
    return _histogram(spark, sf_dir)


@query("q_start_date_histogram_daily", _histogram_sql("'day'"))
def start_date_histogram_daily(spark, sf_dir):
    return _histogram(spark, sf_dir, "day")
