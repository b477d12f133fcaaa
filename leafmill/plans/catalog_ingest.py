"""Intake operators over the documents: duplicates, routes, places, queue content."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions.chunks import content_matches
from leafmill.functions.places import as_list, flatten_place, has_place, place_entry, searchable_place
from leafmill.operators import ingest
from leafmill.operators.chunking import acquire
from leafmill.plans import standins
from leafmill.plans.registry import query

_MSG = "msg as (select doc_id as arrival, sha256(text) as checksum, source as place_id, lang from documents)"
_STORED = "stored as (select distinct m.checksum, m.place_id from msg m join labels l on l.doc_id = m.arrival)"


@query(
    "ingest_route",
    f"""with {_MSG}
select arrival as doc_id,
       case when row_number() over (partition by checksum order by arrival) = 1 then 'new'
            when row_number() over (partition by checksum, place_id order by arrival) = 1 then 'merge'
            else 'drop' end as route
from msg""",
)
def route(spark, sf_dir):
    routed = ingest.route(standins.messages(spark, sf_dir))
    return routed.select(F.col("arrival").alias("doc_id"), "route")


@query(
    "ingest_route_stored",
    f"""with {_MSG}, {_STORED}
select arrival as doc_id,
       case when checksum not in (select checksum from stored)
                 and row_number() over (partition by checksum order by arrival) = 1 then 'new'
            when (checksum, place_id) not in (select (checksum, place_id) from stored)
                 and row_number() over (partition by checksum, place_id order by arrival) = 1 then 'merge'
            else 'drop' end as route
from msg""",
)
def route_stored(spark, sf_dir):
    stored = standins.stored_messages(spark, sf_dir)
    places = stored.select("checksum", F.col("source.placeId").alias("place_id")).distinct()
    routed = ingest.route(standins.messages(spark, sf_dir), stored.select("checksum").distinct(), places)
    return routed.select(F.col("arrival").alias("doc_id"), "route")


@query(
    "ingest_new_only",
    f"""with {_MSG}, {_STORED}
select checksum, min(arrival) as doc_id, arg_min(place_id, arrival) as place_id
from msg where checksum not in (select checksum from stored) group by 1""",
)
def new_only(spark, sf_dir):
    stored = standins.stored_messages(spark, sf_dir).select("checksum").distinct()
    new = ingest.new_flyers(standins.messages(spark, sf_dir), stored)
    return new.select("checksum", F.col("arrival").alias("doc_id"), F.col("source.placeId").alias("place_id"))


@query(
    "ingest_known_only",
    f"""with {_MSG}, {_STORED}
select arrival as doc_id, checksum from msg where checksum in (select checksum from stored)""",
)
def known_only(spark, sf_dir):
    messages = standins.messages(spark, sf_dir)
    stored = ingest.known_among(standins.stored_messages(spark, sf_dir), messages, "checksum")
    return ingest.known(messages, stored).select(F.col("arrival").alias("doc_id"), "checksum")


def _stored_flyers(spark, sf_dir):
    return ingest.place_lists(ingest.new_places(standins.stored_messages(spark, sf_dir)))


_LISTS = """firsts as (
  select checksum, place_id, min(arrival) as first_at from {rows} group by 1, 2
), lists as (
  select checksum, string_agg(place_id, '|' order by first_at) as places, count(*) as n_places
  from firsts group by 1
)"""


@query(
    "ingest_lookup",
    f"""with {_MSG}, kept as (select m.* from msg m join labels l on l.doc_id = m.arrival),
{_LISTS.format(rows="kept")}
select m.arrival as doc_id, (l.checksum is not null)::int as hits, l.places
from msg m left join lists l using (checksum)""",
)
def lookup(spark, sf_dir):
    found = ingest.lookup_stored(standins.messages(spark, sf_dir), _stored_flyers(spark, sf_dir))
    return found.select(
        F.col("arrival").alias("doc_id"), "hits", F.array_join("sources.placeId", "|").alias("places")
    )


@query(
    "ingest_has_place",
    f"""with {_MSG}, {_STORED}
select arrival as doc_id, (checksum, place_id) in (select (checksum, place_id) from stored) as has_place from msg""",
)
def place_membership(spark, sf_dir):
    found = ingest.lookup_stored(standins.messages(spark, sf_dir), _stored_flyers(spark, sf_dir))
    return found.select(
        F.col("arrival").alias("doc_id"), has_place(F.col("sources"), F.col("source.placeId")).alias("has_place")
    )


@query(
    "ingest_place_entry",
    """select s_suppkey,
  case when s_acctbal >= 0 then s_name end as place_id,
  case when s_acctbal >= 1000 and s_acctbal < 9000 then s_acctbal / 100.0::double end as lat,
  case when s_acctbal >= 1000 and s_acctbal < 9000 then n_nationkey::double end as lon,
  case when s_acctbal >= 3000 and s_acctbal < 8000 then n_name end as place_name,
  case when s_acctbal >= 2000 then 'Via ' || n_name end as address
from supplier join nation on s_nationkey = n_nationkey""",
)
def entry(spark, sf_dir):
    entries = standins.shop_places(spark, sf_dir).select("s_suppkey", place_entry(F.col("source")).alias("entry"))
    flat = flatten_place(F.col("entry"))
    return entries.select("s_suppkey", *[column.alias(name) for name, column in flat.items()])


@query(
    "place_as_list",
    """select s_suppkey, (s_acctbal >= 0)::int as n, case when s_acctbal >= 0 then s_name end as first_id
from supplier join nation on s_nationkey = n_nationkey""",
)
def scalar_to_list(spark, sf_dir):
    rows = standins.shop_places(spark, sf_dir).select("s_suppkey", as_list(place_entry(F.col("source"))).alias("l"))
    return rows.select("s_suppkey", F.size("l").alias("n"), F.try_element_at("l", F.lit(1))["placeId"].alias("first_id"))


@query(
    "place_searchable",
    """select s_suppkey, case when s_acctbal >= 0 then 'location,name,placeId' end as fields
from supplier join nation on s_nationkey = n_nationkey""",
)
def searchable(spark, sf_dir):
    entry_ = place_entry(F.col("source"))
    rows = standins.shop_places(spark, sf_dir).select("s_suppkey", searchable_place(entry_).alias("p"))
    names = ",".join(sorted(rows.schema["p"].dataType.fieldNames()))
    return rows.select("s_suppkey", F.when(F.col("p").isNotNull(), F.lit(names)).alias("fields"))


@query(
    "ingest_merge_places",
    f"""with {_MSG}, kept as (select m.* from msg m join labels l on l.doc_id = m.arrival),
s as (select checksum, place_id, min(arrival) as first_at, 0 as late from kept group by 1, 2),
a as (select checksum, place_id, min(arrival) as first_at, 1 as late from msg group by 1, 2),
u as (select * from s union all select * from a where (checksum, place_id) not in (select (checksum, place_id) from s))
select checksum, string_agg(place_id, '|' order by late, first_at) as places, count(*) as n_places
from u group by 1""",
)
def merge(spark, sf_dir):
    arriving = ingest.new_places(standins.messages(spark, sf_dir))
    merged = ingest.merge_places(_stored_flyers(spark, sf_dir), arriving)
    return merged.select(
        "checksum", F.array_join("sources.placeId", "|").alias("places"),
        F.size("sources").cast("bigint").alias("n_places"),
    )


@query(
    "ingest_propagate_places",
    f"""with {_MSG}, {_LISTS.format(rows="msg")}
select m.arrival as doc_id, l.places from msg m left join lists l using (checksum)""",
)
def propagate(spark, sf_dir):
    messages = standins.messages(spark, sf_dir)
    offers = messages.select("arrival", F.col("checksum").alias("flyer_checksum"))
    flyers = ingest.place_lists(ingest.new_places(messages))
    spread = ingest.propagate_places(offers, flyers)
    return spread.select(F.col("arrival").alias("doc_id"), F.array_join("sources.placeId", "|").alias("places"))


def _announced(spark, sf_dir):
    """Messages where toxic documents announce another hash, and poor ones a dead url."""
    labels = standins.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "arrival")
    rows = standins.messages(spark, sf_dir).join(labels, "arrival", "left")
    wrong = F.coalesce(F.col("toxic") == 1, F.lit(False))
    dead = F.coalesce(F.col("quality") == 0, F.lit(False))
    return rows.withColumns(
        {
            "checksum": F.when(wrong, F.sha2(F.col("filename").cast("binary"), 256)).otherwise(F.col("checksum")),
            "url": F.when(dead, F.concat("url", F.lit("/gone"))).otherwise(F.col("url")),
        }
    )


@query(
    "acquire_content",
    """select d.doc_id, case when l.quality = 0 then 'missing' when l.toxic = 1 then 'checksum mismatch' else 'ok' end
  as fetch_status, case when l.quality = 0 then null else strlen(d.text)::double end as n_bytes
from documents d left join labels l using (doc_id)""",
)
def acquire_content(spark, sf_dir):
    fetched = acquire(_announced(spark, sf_dir), standins.content(spark, sf_dir))
    return fetched.select(
        F.col("arrival").alias("doc_id"), "fetch_status", F.octet_length("content").cast("double").alias("n_bytes")
    )


@query(
    "integrity_check",
    """select d.doc_id, coalesce(l.toxic, 0) <> 1 as intact from documents d left join labels l using (doc_id)""",
)
def integrity(spark, sf_dir):
    labels = standins.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    rows = standins.table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    text = F.col("text").cast("binary")
    wrong = F.coalesce(F.col("toxic") == 1, F.lit(False))
    expected = F.when(wrong, F.sha2(F.col("lang").cast("binary"), 256)).otherwise(F.upper(F.sha2(text, 256)))
    return rows.select("doc_id", content_matches(text, expected).alias("intact"))
