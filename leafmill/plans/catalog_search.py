"""Search operators over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import text as texts
from leafmill.functions.geo import EARTH_RADIUS_KM
from leafmill.operators import search
from leafmill.plans import standins
from leafmill.plans.registry import query
from leafmill.session import scratch_dir


@query("facet", "select p_brand, p_type, count(*) as n from part group by 1, 2")
def facet(spark, sf_dir):
    return search.facet(standins.table(spark, sf_dir, "part"), "p_brand", "p_type")


@query(
    "exact_match",
    "select p_partkey, p_name from part where p_type = 'PROMO' and p_brand = 'Brand#4'",
)
def exact_match(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "part")
    return search.exact_match(rows, p_type="PROMO", p_brand="Brand#4").select("p_partkey", "p_name")


@query(
    "numeric_range",
    "select p_partkey, p_retailprice from part where p_retailprice between 910.5 and 950.0",
)
def numeric_range(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "part")
    return search.numeric_range(rows, "p_retailprice", 910.5, 950.0).select("p_partkey", "p_retailprice")


_VALIDITY = """v as (
  select l_orderkey, l_linenumber, o_orderdate as f, l_shipdate as t from lineitem join orders on l_orderkey = o_orderkey
)"""


def _validity(spark, sf_dir):
    orders = standins.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("validity_from"))
    lines = standins.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("validity_to")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query(
    "valid_on_day",
    f"with {_VALIDITY} select l_orderkey, l_linenumber from v where f <= date '1998-07-01' and t >= date '1998-07-01'",
)
def valid_on_day(spark, sf_dir):
    day = F.lit("1998-07-01").cast("timestamp_ntz")
    return search.valid_on(_validity(spark, sf_dir), day).select("l_orderkey", "l_linenumber")


@query(
    "valid_per_day",
    f"""with {_VALIDITY}, days as (select distinct o_orderdate::date as day from orders)
select strftime(day, '%Y-%m-%d') as day, count(l_orderkey) as n
from days left join v on f::date <= day and t::date >= day group by 1""",
)
def valid_per_day(spark, sf_dir):
    days = standins.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("day"))
    counts = search.valid_per_day(_validity(spark, sf_dir), days)
    return counts.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


_SHOPS = """shop as (
  select s_suppkey, s_acctbal / 150.0::double as lat, ((s_suppkey * 37) % 360 - 180)::double as lon from supplier
)"""
_KM = (
    f"2 * {EARTH_RADIUS_KM}::double * asin(sqrt(least(1.0::double, pow(sin(radians({{b}}lat - {{a}}lat) / 2), 2)"
    " + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lon - {a}lon) / 2), 2))))"
)


def _shops(spark, sf_dir):
    return standins.table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_acctbal") / 150.0).alias("lat"),
        ((F.col("s_suppkey") * 37) % 360 - 180).cast("double").alias("lon"),
    )


@query(
    "geo_within",
    f"""with {_SHOPS}, point as (select 41.9::double as lat, 12.5::double as lon)
select s_suppkey, round({_KM.format(a="shop.", b="point.")}, 3) as km
from shop, point where {_KM.format(a="shop.", b="point.")} <= 4000""",
)
def geo_within(spark, sf_dir):
    found = search.within_km(_shops(spark, sf_dir), 41.9, 12.5, 4000.0)
    return found.select("s_suppkey", F.round("km", 3).alias("km"))


@query(
    "geo_near_points",
    f"""with {_SHOPS}, point as (
  select n_nationkey, (n_nationkey * 6 - 70)::double as lat, (n_nationkey * 15 - 180)::double as lon from nation
)
select s_suppkey, n_nationkey, round({_KM.format(a="shop.", b="point.")}, 3) as km
from shop, point where {_KM.format(a="shop.", b="point.")} <= 1500""",
)
def geo_near_points(spark, sf_dir):
    points = standins.table(spark, sf_dir, "nation").select(
        "n_nationkey",
        (F.col("n_nationkey") * 6 - 70).cast("double").alias("point_lat"),
        (F.col("n_nationkey") * 15 - 180).cast("double").alias("point_lon"),
    )
    found = search.near_points(_shops(spark, sf_dir), points, 1500.0)
    return found.select("s_suppkey", "n_nationkey", F.round("km", 3).alias("km"))


def _terms_sql(table: str, key: str) -> str:
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in texts.ITALIAN_STOP_WORDS)
    elided, suffix = texts.ELIDED.replace("'", "''"), texts.SUFFIX
    token = texts.TOKEN.replace("'", "''")
    return f"""(
  select {key}, case when length(w) >= 6
      then regexp_replace(translate(w, '{texts.ACCENTED}', '{texts.PLAIN}'), '{suffix}', '\\1') else w end as term
  from (select {key}, regexp_replace(unnest(regexp_extract_all(lower(text), '{token}')), '{elided}', '') as w from {table})
  where w <> '' and w not in ({stop})
)"""


def _rank_sql() -> str:
    return f"""
with dt as {_terms_sql("documents", "doc_id")},
     qt as {_terms_sql("benchmark", "item_id")},
     len as (select d.doc_id, count(dt.term) as length from documents d left join dt using (doc_id) group by 1),
     stats as (select count(*) as docs, avg(length) as mean_length from len),
     asked as (select item_id, term, count(*) as weight from qt group by 1, 2),
     tf as (select doc_id, term, count(*) as tf from dt where term in (select term from asked) group by 1, 2),
     idf as (select term, ln(1 + (docs - count(*) + 0.5::double) / (count(*) + 0.5::double)) as idf from tf, stats group by term, docs),
     scored as (
       select item_id, doc_id, sum(cast(weight * idf * (tf * (1.2::double + 1)
         / (tf + 1.2::double * (1 - 0.75::double + 0.75::double * length / mean_length))) as decimal(18,6))) as score
       from tf join asked using (term) join idf using (term) join len using (doc_id), stats group by 1, 2
     ),
     ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored)
select item_id as query_id, rank::int as rank, doc_id, score::double as score from ranked where rank <= 10
"""


@query("text_rank", _rank_sql)
def text_rank(spark, sf_dir):
    """The ten best documents for every benchmark text, whole texts on both sides."""
    stop_words = list(texts.ITALIAN_STOP_WORDS)
    documents = standins.table(spark, sf_dir, "documents")
    index = search.store_index(documents, stop_words, scratch_dir(spark, "terms"))
    queries = standins.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    n_docs = documents.agg(F.count("*").alias("n")).scalar()
    return search.text_rank(index, n_docs, queries, 10, stop_words)


_KNN_SQL = """with e as (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings),
c as (select label, i, avg(x) as x from e group by 1, 2),
q as (select label, list(x order by i) as v from c group by 1),
s as (
  select q.label, vec_id, round(list_cosine_similarity(v, embedding::double[]), 6) as similarity from q, embeddings
)
select label::bigint as query_id, row_number() over (partition by label order by similarity desc, vec_id)::int as rank,
  vec_id as row_id, similarity
from s qualify rank <= 5"""


@query("knn_exact", _KNN_SQL)
def knn_exact(spark, sf_dir):
    """The five vectors nearest to the mean of every label."""
    return search.nearest(standins.table(spark, sf_dir, "embeddings"), _label_means(spark, sf_dir), 5, row_id="vec_id")


@query("knn_cells", _KNN_SQL)
def knn_cells(spark, sf_dir):
    """As ``knn_exact``, from vectors stored by cell; with every cell probed the answer is exact."""
    index = search.store_cells(standins.table(spark, sf_dir, "embeddings"), scratch_dir(spark, "cells"), 16, row_id="vec_id")
    return search.nearest_in_cells(index, _label_means(spark, sf_dir), 5, probes=16)


def _label_means(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "embeddings")
    spread = rows.select("label", F.posexplode("embedding").alias("i", "x"))
    mean = spread.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return mean.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("query_vector")
    )
