"""Parsing, dates, texts, chunking and the rule reader over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import dates, packs, text as texts
from leafmill.functions.binding import add_stages
from leafmill.operators.chunking import split_chunks, spread
from leafmill.operators.extraction import Retry, extract_json, extract_with, split_valid
from leafmill.operators.embedding import HashingEmbedder, attach_vectors, embed_offers, embed_texts
from leafmill.operators.offers import explode_offers, offer_rows
from leafmill.plans import standins
from leafmill.plans.registry import query
from leafmill.schemas import CHUNK_RESULT, OFFER
from leafmill.sources.messages import parse_messages

# --- parsing ----------------------------------------------------------------------------


@query(
    "json_parse",
    """select event_id,
  case when event_type = 'error' then null else event_type end as filename,
  case when event_type = 'error' then null else value::varchar end as url,
  case when event_type in ('error', 'view') then null else user_id::varchar end as place_id,
  case when event_type in ('error', 'view') then null else value end as lat
from events""",
)
def json_parse(spark, sf_dir):
    """Malformed rows, a missing object, an extra field, and a number where text is expected."""
    source = F.when(F.col("event_type") == "view", "").otherwise(
        F.concat(F.lit(',"source":{"placeId":"'), "user_id", F.lit('","location":{"lat":'), "value", F.lit("}}"))
    )
    body = F.concat(
        F.lit('{"filename":"'), "event_type", F.lit('","url":'), "value", F.lit(',"props":'), "props", source, F.lit("}")
    )
    raw = standins.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("?"), body)).otherwise(body)
        .cast("binary").alias("value"),
    )
    parsed = parse_messages(raw)
    return parsed.select(
        "event_id", "filename", "url", F.col("source.placeId").alias("place_id"),
        F.col("source.location.lat").alias("lat"),
    )


@query(
    "json_props",
    "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
)
def json_props(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "events")
    return rows.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(
    "extractor_json",
    """select event_id,
  case when event_type = 'error' then null else strftime(ts, '%Y-%m-%d') end as validity_from,
  case when event_type = 'error' then null else user_id::double end as ai_input_tokens,
  case when event_type in ('click', 'view') then 1 when event_type = 'error' then null else 0 end::double as valid_offers,
  case when event_type in ('click', 'view', 'error') then null else 'category unknown' end as reject
from events""",
)
def extractor_json(spark, sf_dir):
    """Extractor answers as JSON text, forced into the contract and checked."""
    category = F.when(F.col("event_type").isin("click", "view"), "Bevande").otherwise("Dispensa")
    answer = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd").alias("validity_from"),
            F.date_format("ts", "yyyy-MM-dd").alias("validity_to"),
            F.col("user_id").alias("ai_input_tokens"),
            F.array(F.struct(F.col("event_type").alias("name"), category.alias("category"), F.col("value").alias("price")))
            .alias("offers_data"),
        )
    )
    rows = standins.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("?"), answer)).otherwise(answer).alias("json")
    )
    checked = split_valid(extract_json(rows))
    return checked.select(
        "event_id", "validity_from", F.col("ai_input_tokens").cast("double"),
        F.when(F.col("offers_data").isNotNull(), F.size("offers_data")).cast("double").alias("valid_offers"),
        F.try_element_at("rejected_offers", F.lit(1))["reason"].alias("reject"),
    )


@query(
    "timestamps_mixed",
    """select event_id, case event_type
    when 'error' then null
    else strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%g') end as at
from events""",
)
def timestamps_mixed(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    written = (
        F.when(F.col("event_type") == "error", "soon")
        .when(F.col("event_type").isin("click", "view"), F.date_format(ts, dates.ISO_MILLIS))
        .otherwise(F.unix_millis(ts).cast("string"))
    )
    rows = standins.table(spark, sf_dir, "events").select("event_id", dates.mixed_timestamp(written).alias("at"))
    return rows.select("event_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSS").alias("at"))


# --- dates ------------------------------------------------------------------------------


def _month_name(date):
    names = F.array(*[F.lit(m) for m in dates.ITALIAN_MONTHS])
    return F.element_at(names, F.month(date))


_DATE_SQL = """with o as (
  select o_orderkey, o_orderdate::date as d, split_part(o_orderpriority, '-', 1) as p from orders
)
select o_orderkey,
  case when p = '5' then null when p = '4' then strftime(date_trunc('month', d)::date, '%Y-%m-%dT00:00:00.000Z')
       else strftime(d, '%Y-%m-%dT00:00:00.000Z') end as first,
  case when p = '5' then null when p = '4' then strftime(last_day(d), '%Y-%m-%dT00:00:00.000Z')
       else strftime(d, '%Y-%m-%dT00:00:00.000Z') end as last,
  case when p = '4' then strftime(date_trunc('month', d)::date, '%Y-%m-%dT00:00:00.000Z')
       else strftime(d, '%Y-%m-%dT00:00:00.000Z') end as resolved
from o"""


@query("date_normalise", _DATE_SQL)
def date_normalise(spark, sf_dir):
    """Order dates printed in five ways; one of them lacks the year."""
    date, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    month = _month_name(date)
    written = (
        F.when(priority.startswith("1"), F.date_format(date, "yyyy-MM-dd"))
        .when(priority.startswith("2"), F.date_format(date, " dd/MM/yyyy"))
        .when(priority.startswith("3"), F.concat_ws(" ", F.dayofmonth(date), F.initcap(month), F.year(date)))
        .when(priority.startswith("4"), F.concat_ws(" ", F.upper(month), F.year(date)))
        .otherwise(F.concat_ws(" ", F.dayofmonth(date), month))
    )
    rows = standins.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", written.alias("written"))
    w = F.col("written")
    return rows.select(
        "o_orderkey",
        dates.iso_millis(dates.normalize_date(w, "first")).alias("first"),
        dates.iso_millis(dates.normalize_date(w, "last")).alias("last"),
        dates.iso_millis(dates.resolve_day(w, F.col("o_orderdate"))).alias("resolved"),
    )


@query(
    "offer_dates",
    """select l_orderkey, l_linenumber,
  case when l_returnflag <> 'N' then strftime(l_shipdate, '%Y-%m-%d') end as validity_from,
  case when l_returnflag <> 'N' then strftime(l_shipdate + interval 3 day, '%Y-%m-%d') end as validity_to
from lineitem""",
)
def offer_dates(spark, sf_dir):
    """Own dates of an offer, only where the text states them; the year comes from the context."""
    start, end = F.col("l_shipdate"), F.date_add("l_shipdate", 3)
    named = F.concat(
        F.lit("Valida dal "), F.dayofmonth(start), F.lit(" "), _month_name(start),
        F.lit(" al "), F.dayofmonth(end), F.lit(" "), _month_name(end),
    )
    written = (
        F.when(F.col("l_returnflag") == "A", named)
        .when(F.col("l_returnflag") == "R", F.concat(
            F.lit("Offerta valida dal "), F.date_format(start, "dd/MM"), F.lit(" al "), F.date_format(end, "dd/MM")))
        .otherwise("Fino ad esaurimento scorte")
    )
    rows = standins.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", written.alias("written")
    )
    rows = spread(rows, keys=("l_orderkey", "l_linenumber"))
    read, m = add_stages(rows, {"line": F.col("written"), "as_of": F.col("l_shipdate")}, dates.SPAN_STAGES, "_span_")
    return read.select(
        "l_orderkey", "l_linenumber",
        F.date_format(m["start"], "yyyy-MM-dd").alias("validity_from"),
        F.date_format(m["end"], "yyyy-MM-dd").alias("validity_to"),
    )


# --- texts ------------------------------------------------------------------------------


@query(
    "embed_text",
    "select p_partkey, p_name || '. ' || coalesce(nullif(p_type, 'ECONOMY'), 'None') || '.' as text from part",
)
def embed_text(spark, sf_dir):
    kind = F.nullif(F.col("p_type"), F.lit("ECONOMY"))
    return standins.table(spark, sf_dir, "part").select(
        "p_partkey", texts.embeddable_text(F.col("p_name"), kind).alias("text")
    )


@query(
    "blank_text",
    """select p_partkey, p_size >= 5 and p_type not in ('ECONOMY', 'PROMO') as usable from part""",
)
def blank_text(spark, sf_dir):
    """A list of texts is usable only when none is null or blank."""
    items = F.array(
        F.col("p_name"),
        F.when(F.col("p_size") < 5, "  ").otherwise(F.col("p_brand")),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_type")),
    )
    items = F.when(F.col("p_type") == "PROMO", F.array().cast("array<string>")).otherwise(items)
    return standins.table(spark, sf_dir, "part").select("p_partkey", texts.all_present(items).alias("usable"))


_LABELS = {
    "LARGE": "Bevande", "STANDARD": "Dispensa secca", "ECONOMY": "Dispensa",
    "PROMO": "Prodotti per l'infanzia", "MEDIUM": None, "SMALL": "bevande",
}


@query(
    "category_check",
    """select p_partkey, p_type in ('LARGE', 'STANDARD', 'PROMO') as known from part""",
)
def category_check(spark, sf_dir):
    pairs = [F.lit(x) for pair in _LABELS.items() for x in pair]
    label = F.try_element_at(F.create_map(*pairs), F.col("p_type"))
    return standins.table(spark, sf_dir, "part").select("p_partkey", texts.known_category(label).alias("known"))


@query(
    "required_fields",
    """select l_orderkey, l_linenumber,
  case when l_returnflag = 'R' then 'name missing' when p_type = 'ECONOMY' then 'category missing'
       when p_type = 'SMALL' then 'category unknown' end as offer_reason,
  case when l_linestatus = 'O' then 'validity_to missing' end as flyer_reason
from lineitem join part on l_partkey = p_partkey""",
)
def required_fields(spark, sf_dir):
    part = standins.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    rows = standins.table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    label = F.when(F.col("p_type") == "SMALL", "Salumi").when(F.col("p_type") != "ECONOMY", "Bevande")
    offer = F.struct(F.when(F.col("l_returnflag") != "R", F.col("p_name")).alias("name"), label.alias("category"))
    end = F.when(F.col("l_linestatus") != "O", F.col("l_shipdate"))
    return rows.select(
        "l_orderkey", "l_linenumber",
        texts.offer_reject_reason(offer).alias("offer_reason"),
        texts.flyer_reject_reason(F.col("l_shipdate"), end, F.array(offer)).alias("flyer_reason"),
    )


@query(
    "raw_keyword",
    "select doc_id, case when length(text) <= 256 then text end as keyword from documents",
)
def raw_keyword(spark, sf_dir):
    return standins.table(spark, sf_dir, "documents").select("doc_id", texts.raw_keyword(F.col("text")).alias("keyword"))


# --- chunking ---------------------------------------------------------------------------


@query(
    "chunk_split",
    """with p as (select doc_id, string_split(text, chr(10)) as pages from documents),
c as (select doc_id, pages, unnest(range(0, ((len(pages) + 4) // 5)::bigint)) as n from p)
select doc_id, n::int as chunk_n, ((len(pages) + 4) // 5)::int as chunk_total,
       len(pages[n * 5 + 1 : n * 5 + 5])::int as n_pages,
       sha256(array_to_string(pages[n * 5 + 1 : n * 5 + 5], chr(10))) as chunk_sha
from c""",
)
def chunk_split(spark, sf_dir):
    documents = standins.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    chunks = split_chunks(documents)
    return chunks.select(
        "doc_id", "chunk_n", "chunk_total", F.size("chunk").alias("n_pages"),
        F.sha2(F.array_join("chunk", "\n"), 256).alias("chunk_sha"),
    )


@query(
    "chunk_numbering",
    """with p as (select doc_id, len(list_filter(string_split(text, chr(10)), lambda x: length(x) > 200)) as n from documents)
select doc_id, unnest(range(0, ((n + 4) // 5)::bigint))::int as chunk_n, ((n + 4) // 5)::int as chunk_total
from p where n > 0""",
)
def chunk_numbering(spark, sf_dir):
    """Only long lines count as pages here, so that some documents have none and vanish."""
    pages = F.filter(F.split("text", "\n", -1), lambda page: F.length(page) > 200)
    chunks = split_chunks(standins.table(spark, sf_dir, "documents").select("doc_id", "text"), pages)
    return chunks.select("doc_id", "chunk_n", "chunk_total")


# --- offers out of chunk results ----------------------------------------------------------


@query(
    "offers_flatten",
    """with o as (
  select l_orderkey, l_linenumber, 0 as offer_n, l_extendedprice as price,
         case when l_returnflag = 'A' then strftime(l_shipdate, '%Y-%m-%d') end as own
  from lineitem where l_returnflag <> 'N'
  union all
  select l_orderkey, l_linenumber, 1, l_quantity, null from lineitem where l_returnflag = 'R'
)
select l_orderkey::varchar as flyer_checksum, l_linenumber as chunk_n, offer_n, cast(price as float)::double as price,
       coalesce(own, strftime(o_orderdate, '%Y-%m-%d')) as validity_from, own as validity_from_raw
from o join orders on l_orderkey = o_orderkey""",
)
def offers_flatten(spark, sf_dir):
    """Chunks with no, one or two nested offers; own dates win over those of the flyer."""
    lines = standins.table(spark, sf_dir, "lineitem")
    own = F.when(F.col("l_returnflag") == "A", F.date_format("l_shipdate", "yyyy-MM-dd"))

    def offer(name, price, start):
        parts = {"name": F.lit(name), "price": price, "category": F.lit("Bevande"), "validity_from": start}
        return F.struct(
            *[parts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OFFER.fields]
        )

    first = offer("line", F.col("l_extendedprice"), own)
    second = offer("pack", F.col("l_quantity"), F.lit(None))
    nested = (
        F.when(F.col("l_returnflag") == "A", F.array(first))
        .when(F.col("l_returnflag") == "R", F.array(first, second))
        .otherwise(F.array().cast(packs.offers_type()))
    )
    results = lines.select(
        F.col("l_orderkey").cast("string").alias("checksum"), F.col("l_linenumber").alias("chunk_n"),
        nested.alias("offers_data"),
    )
    flyers = standins.flyers(spark, sf_dir).withColumn("validity_to", F.lit(None).cast("timestamp"))
    rows = offer_rows(explode_offers(results), flyers)
    return rows.select(
        "flyer_checksum", "chunk_n", "offer_n", F.col("price").cast("double").alias("price"),
        F.date_format("validity_from", "yyyy-MM-dd").alias("validity_from"), "validity_from_raw",
    )


# --- the rule reader ----------------------------------------------------------------------


def _euro(column):
    return F.regexp_replace(F.format_string("%.2f", column), r"\.", ",")


@query(
    "pack_arithmetic",
    """select l_orderkey, l_linenumber, l_extendedprice as price,
  case l_returnflag when 'R' then l_quantity / l_linenumber else l_quantity end as quantity,
  case l_returnflag when 'A' then l_linenumber * l_quantity else l_quantity end as total_quantity,
  case l_returnflag when 'N' then 1.0::double else l_linenumber::double end as count,
  case l_returnflag when 'R' then 'kg' else 'g' end as uom
from lineitem""",
)
def pack_arithmetic(spark, sf_dir):
    n, q, price = F.col("l_linenumber"), F.col("l_quantity").cast("int"), _euro(F.col("l_extendedprice"))
    written = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("Mozzarella "), n, F.lit("x"), q, F.lit("g - "), price, F.lit("€")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("Tranci "), n, F.lit("pz, "), q, F.lit("kg - €"), price))
        .otherwise(F.concat(F.lit("Passata "), q, F.lit(" g - "), price, F.lit(" €")))
    )
    rows = standins.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", written.alias("written"))
    rows = spread(rows, keys=("l_orderkey", "l_linenumber", "written"))
    return packs.add_pack(rows, F.col("written")).drop("written", "notes")


@query(
    "promo_price",
    """select l_orderkey, l_linenumber,
  round(round(1 + l_discount + l_tax, 2) * l_linenumber, 2) as price, l_quantity as quantity,
  l_quantity * (l_linenumber + 1) as total_quantity, l_linenumber + 1.0::double as count, 'vasetto' as uom,
  'Acquista ' || (l_linenumber + 1) || ', ne paghi ' || l_linenumber as notes
from lineitem""",
)
def promo_price(spark, sf_dir):
    m, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    unit = _euro(F.round(1 + F.col("l_discount") + F.col("l_tax"), 2))
    written = F.concat(
        F.lit("Yogurt Cremoso "), q, F.lit(" g - "), m + 1, F.lit("x"), m, F.lit(" (prendi "), m + 1,
        F.lit(", paghi "), m, F.lit(") - €"), unit, F.lit(" a vasetto"),
    )
    lines = standins.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    rows = spread(lines, keys=("l_orderkey", "l_linenumber")).select("l_orderkey", "l_linenumber", written.alias("written"))
    return packs.add_pack(rows, F.col("written")).drop("written")


@query(
    "per_kg_price",
    """select p_partkey, p_retailprice as price, 1.0::double as quantity, 1.0::double as total_quantity,
  null::double as count, 'kg' as uom,
  case when p_type <> 'SMALL' then 'Circa ' || p_size || 'g' end as notes, p_name as name
from part""",
)
def per_kg_price(spark, sf_dir):
    written = F.when(
        F.col("p_type") == "SMALL", F.concat("p_name", F.lit(" - "), _euro(F.col("p_retailprice")), F.lit("€/kg"))
    ).otherwise(
        F.concat("p_name", F.lit(" (circa "), "p_size", F.lit(" g) al kg €"), _euro(F.col("p_retailprice")))
    )
    rows = standins.table(spark, sf_dir, "part").select("p_partkey", written.alias("written"))
    w = F.col("written")
    return packs.add_pack(rows, w).withColumn("name", packs.base_name(w)).drop("written")


@query(
    "final_price_notes",
    """select p_partkey, p_retailprice as price, 1.0::double as count,
  case when p_type = 'PROMO' then 'Valido solo con carta fedeltà' end as notes
from part""",
)
def final_price_notes(spark, sf_dir):
    low, high = _euro(F.col("p_retailprice")), _euro(F.col("p_retailprice") * 2)
    head = F.concat("p_name", F.lit(" "), "p_size", F.lit("g - "))
    written = (
        F.when(F.col("p_type") == "PROMO", F.concat(head, low, F.lit("€ (con carta fidelity) - Prezzo normale "), high, F.lit("€")))
        .when(F.col("p_type") == "LARGE", F.concat(head, F.lit("SCONTO 50% - da "), high, F.lit("€ a "), low, F.lit("€")))
        .otherwise(F.concat(head, low, F.lit(" cad. - al kg Euro "), high))
    )
    rows = standins.table(spark, sf_dir, "part").select("p_partkey", written.alias("written"))
    w = F.col("written")
    return rows.select("p_partkey", packs.pack_and_notes(w).alias("p")).select(
        "p_partkey", "p.price", "p.count", "p.notes"
    )


@query(
    "split_products",
    """select p_partkey, unnest([p_name, split_part(p_name, ' ', 1) || ' ' || p_type, 'red ' || p_brand]) as name
from part""",
)
def split_products(spark, sf_dir):
    """A one-word alternative replaces the last word, a longer one stands alone."""
    written = F.concat("p_name", F.lit(" / "), "p_type", F.lit("/red "), "p_brand")
    rows = standins.table(spark, sf_dir, "part").select("p_partkey", written.alias("written"))
    return rows.select("p_partkey", F.explode(packs.product_names(F.col("written"))).alias("name"))


@query(
    "rule_offers",
    """select p_partkey, unnest(case when p_type = 'PROMO' then [] else [p_name, split_part(p_name, ' ', 1) || ' extra'] end)
         as name,
       cast(p_retailprice as float)::double as price, p_size::double as quantity,
       '2025-06-28T00:00:00.000Z' as validity_from
from part""",
)
def rule_offers(spark, sf_dir):
    """The whole line reader; travel vouchers are out of scope and give nothing."""
    written = F.concat(
        "p_name", F.lit(" / extra "), "p_size", F.lit("g - "), _euro(F.col("p_retailprice")),
        F.lit("€ - valida dal 28/06 al 30/06"),
        F.when(F.col("p_type") == "PROMO", " con buono viaggio").otherwise(""),
    )
    parts = spread(standins.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice"), keys=("p_partkey",))
    rows = parts.select("p_partkey", written.alias("written"))
    as_of = F.lit("2025-06-20").cast("date")
    read = packs.read_lines(rows, F.col("written"), as_of, F.lit("Dispensa secca"))
    return read.select(
        "p_partkey", "offer.name", F.col("offer.price").cast("double").alias("price"),
        F.col("offer.quantity").cast("double").alias("quantity"), "offer.validity_from",
    )


# --- plugged-in extraction ------------------------------------------------------------------

_TITLE = r"<title>([^<]*)</title>"
_LANG = r"<html[^>]* lang=\"([a-z]+)\""


def _page_fields(html: str) -> dict:
    """A stand-in for an extractor service: one offer per page, named by its title."""
    import re

    title = re.search(_TITLE, html)
    lang = re.search(_LANG, html)
    offers = [{"name": title.group(1), "category": "Giochi"}] if title else []
    return {
        "ai_model": lang.group(1) if lang else None,
        "ai_input_tokens": len(html),
        "processing_time_seconds": 0.0,
        "offers_data": [{f.name: None for f in OFFER.fields} | offer for offer in offers],
    }


@query(
    "extract_pages",
    rf"""select page_id, nullif(regexp_extract(html, '{_LANG}', 1), '') as lang, length(html) as tokens_in,
  case when regexp_matches(html, '{_TITLE}') then 1 else 0 end::bigint as offers_count,
  case when regexp_matches(html, '{_TITLE}') then regexp_extract(html, '{_TITLE}', 1) end as name,
  1 as attempts, null::varchar as error
from pages""",
)
def extract_pages(spark, sf_dir):
    """A Python extractor behind ``mapInPandas``, one call per chunk."""
    pages = standins.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("chunk"))
    results = extract_with(pages, _page_fields, retry=Retry(attempts=1), schema=CHUNK_RESULT)
    return results.select(
        "page_id", F.col("ai_model").alias("lang"), F.col("ai_input_tokens").alias("tokens_in"), "offers_count",
        F.try_element_at("offers_data", F.lit(1))["name"].alias("name"), "attempts", "error",
    )


@query(
    "extract_pages_rules",
    rf"""select page_id, nullif(regexp_extract(html, '{_LANG}', 1), '') as lang,
  nullif(regexp_extract(html, '{_TITLE}', 1), '') as title,
  not regexp_matches(regexp_extract(html, '{_TITLE}', 1), '(?i)(?:the|la) ') as in_scope
from pages""",
)
def extract_pages_rules(spark, sf_dir):
    """The same fields by expressions, and a scope rule with its own word list."""
    title = F.regexp_extract("html", _TITLE, 1)
    return standins.table(spark, sf_dir, "pages").select(
        "page_id",
        F.nullif(F.regexp_extract("html", _LANG, 1), F.lit("")).alias("lang"),
        F.nullif(title, F.lit("")).alias("title"),
        packs.in_scope(title, "(?i)(?:the|la) ").alias("in_scope"),
    )


def _failing(html: str) -> dict:
    if ' lang="de"' in html:
        raise ValueError("no German")
    return _page_fields(html)


@query(
    "extract_retry",
    """select page_id, case when contains(html, ' lang="de"') then 3 else 1 end as attempts,
  case when contains(html, ' lang="de"') then 'ValueError: no German' end as error
from pages""",
)
def extract_retry(spark, sf_dir):
    """Chunks that keep failing end as rows with the reason; the others are not held up."""
    pages = standins.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("chunk"))
    results = extract_with(pages, _failing, retry=Retry(attempts=3, first_delay=0.0))
    return results.select("page_id", "attempts", "error")


# --- embeddings -----------------------------------------------------------------------------

_DIMS = 64


@query(
    "embed_offers",
    f"""with w as (
  select p_partkey, unnest(regexp_extract_all(lower(p_name || '. ' || p_type || '.'), '[\\p{{L}}\\p{{N}}]+')) as word
  from part
), s as (
  select p_partkey, (cast('0x' || substr(sha256(word), 1, 6) as bigint) % {_DIMS})::int as slot, count(*) as c
  from w group by 1, 2
)
select p_partkey, slot, round((c / sqrt(sum(c * c) over (partition by p_partkey)))::float::double, 5) as value from s""",
)
def embed(spark, sf_dir):
    parts = standins.table(spark, sf_dir, "part")
    text = texts.embeddable_text(F.col("p_name"), F.col("p_type"))
    vectors = parts.select("p_partkey", embed_texts(text, HashingEmbedder(_DIMS)).alias("v"))
    slots = vectors.select("p_partkey", F.posexplode("v").alias("slot", "value")).filter("value != 0")
    return slots.select("p_partkey", "slot", F.round(F.col("value").cast("double"), 5).alias("value"))


@query(
    "embed_chunks",
    """select p_partkey, case when p_type = 'SMALL' then 0 else 2 end as n_vectors,
  case when p_type = 'SMALL' then null else 1.0::double end as norm
from part""",
)
def embed_chunks(spark, sf_dir):
    """Vectors inside nested offers; a chunk with a blank text gets none."""
    name = F.when(F.col("p_type") == "SMALL", " ").otherwise(F.col("p_name"))

    def offer(name_, kind):
        parts = {"name": name_, "type": kind, "category": F.lit("Giochi")}
        return F.struct(*[parts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OFFER.fields])

    chunks = standins.table(spark, sf_dir, "part").select(
        "p_partkey", F.array(offer(F.col("p_name"), F.col("p_type")), offer(name, F.col("p_brand"))).alias("offers_data")
    )
    # The text of an offer is never blank ("name. type."), so blankness is tested on the names.
    usable = texts.all_present(F.col("offers_data.name"))
    good = embed_offers(chunks.filter(usable), HashingEmbedder(_DIMS))
    rows = good.unionByName(chunks.filter(~usable))
    vectors = F.filter("offers_data.embeddings", lambda v: v.isNotNull())
    squares = F.aggregate(
        F.try_element_at(vectors, F.lit(1)), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return rows.select("p_partkey", F.size(vectors).alias("n_vectors"), F.round(squares, 5).alias("norm"))


@query(
    "attach_vectors",
    """with n as (select p_partkey, p_name, p_brand, p_type, least(p_size, 5) as have from part)
select p_partkey, i::int as offer_n, case when i < have then i + 0.5::double end as first
from (select p_partkey, have, unnest(range(0, 3)) as i from n)""",
)
def attach(spark, sf_dir):
    """As many vectors as the part is large, up to five, for three offers."""
    names = F.array("p_name", "p_brand", "p_type")
    offers = F.transform(names, lambda name: F.struct(name.alias("name"), F.lit(None).cast("array<float>").alias("embeddings")))
    vectors = F.transform(
        F.sequence(F.lit(1), F.least(F.col("p_size"), F.lit(5))), lambda i: F.array((i - 0.5).cast("float"))
    )
    rows = standins.table(spark, sf_dir, "part").select(
        "p_partkey", F.posexplode(attach_vectors(offers, vectors)).alias("offer_n", "offer")
    )
    return rows.select(
        "p_partkey", "offer_n", F.try_element_at("offer.embeddings", F.lit(1)).cast("double").alias("first")
    )
