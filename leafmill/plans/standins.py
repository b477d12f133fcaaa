"""Flyers, offers, chunks and messages made from the general test tables.

Only the mapping is here; every operator that is tried on them is the library's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafmill.functions.places import place
from leafmill.schemas import FLYERS, FOLD_INPUT, PLACE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def fields(rows: DataFrame, schema, **columns: Column) -> DataFrame:
    """The columns of a schema; those not given are null."""
    return rows.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


# --- messages and content: documents ---------------------------------------------------


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is announced by its source: ``arrival`` is the document id."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("arrival"),
        F.format_string("doc-%d.txt", "doc_id").alias("filename"),
        F.format_string("flyer://documents/%d", "doc_id").alias("url"),
        F.sha2("text", 256).alias("checksum"),
        place(F.col("source"), F.concat(F.lit("Shop "), "source"), F.col("lang"), null("double"), null("double"))
        .alias("source"),
    )


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.format_string("flyer://documents/%d", "doc_id").alias("url"),
        F.col("text").cast("binary").alias("content"),
    )


def stored_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The announcements already stored: those of the labelled documents."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("arrival"))
    return messages(spark, sf_dir).join(labels, "arrival", "left_semi")


# --- offers and flyers: lineitem and orders --------------------------------------------


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("flyer_checksum"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("type"),
        F.col("p_retailprice").alias("price"),
    )


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``checksum, place_id, entry, arrival``: a flyer is seen in every supplier's nation.

    One nation has no name. Repeated sightings are reduced to the first.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    shops = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    seen = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    first = (
        seen.join(shops, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("l_orderkey").cast("string").alias("checksum"), "s_nationkey", "n_name")
        .agg(F.min("l_linenumber").alias("arrival"))
    )
    name = F.when(F.col("n_name") != "NATION_7", F.col("n_name"))
    place_id = F.col("s_nationkey").cast("string")
    entry = place(place_id, name, null("string"), null("double"), null("double"))
    return first.select("checksum", place_id.alias("place_id"), entry.alias("entry"), "arrival")


def flyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "orders").join(
        counts, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    ).select(
        F.col("o_orderkey").cast("string").alias("checksum"),
        F.coalesce("n", F.lit(0)).alias("offers_count"),
        F.col("o_orderdate").alias("validity_from"),
    )


# --- chunk results: conversations and lineitem -----------------------------------------


def with_total(rows: DataFrame, key: str, number: str) -> DataFrame:
    """Rows with ``chunk_total``, one more than the highest number of their key."""
    totals = rows.groupBy(key).agg((F.max(number) + 1).cast("int").alias("chunk_total"))
    return rows.join(totals, key)


def conversation_chunks(spark: SparkSession, sf_dir: str, cached: Column | None = None) -> DataFrame:
    """One chunk per turn, in the shape the fold reads."""
    turns = with_total(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    length, role = F.length("text"), F.col("role")
    lines = F.size(F.split("text", "\n", -1))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (length % 366).cast("int"))
    return fields(
        turns,
        FOLD_INPUT,
        checksum=F.col("conv_id"),
        chunk_n=F.col("turn"),
        chunk_total=F.col("chunk_total"),
        url=F.concat(F.lit("flyer://conversations/"), F.col("conv_id")),
        filename=F.concat(F.col("conv_id"), F.lit(".json")),
        place_id=F.when(role == "system", F.concat(F.lit("sys-"), F.col("conv_id"))),
        lat=F.when(role == "user", length / 4.0),
        lon=F.when(role == "user", length / -2.0),
        place_name=F.when(role == "assistant", F.concat(role, F.lit("-"), F.col("turn"))),
        address=F.when(F.col("turn") >= 2, F.concat(role, F.lit("-"), F.col("turn"))),
        validity_from=F.date_format(day, "yyyy-MM-dd"),
        validity_to=F.date_format(F.date_add(day, 7), "yyyy-MM-dd"),
        offers_count=lines,
        ai_input_tokens=F.when(role == "assistant", 0).otherwise(length),
        ai_cached_tokens=lines if cached is None else cached,
        ai_output_tokens=F.when(role == "assistant", length).otherwise(0),
        processing_time_seconds=length / 8.0,
    )


def line_arrival() -> Column:
    """A full order over line items, so that the first of several is a fact of the data."""
    return F.struct(
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    )


def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chunk per line item, with repeated and missing numbers, and its ``arrival``."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    lines = table(spark, sf_dir, "lineitem").withColumn("chunk_n", F.col("l_linenumber") - 1)
    lines = with_total(lines, "l_orderkey", "chunk_n").join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left"
    )
    balance = F.col("s_acctbal")
    columns = {
        "checksum": F.col("l_orderkey"),
        "chunk_n": F.col("chunk_n"),
        "chunk_total": F.col("chunk_total"),
        "url": F.concat(F.lit("flyer://orders/"), F.col("l_orderkey")),
        "filename": F.col("l_orderkey"),
        "place_id": F.when(balance >= 5000, F.col("s_name")),
        "lat": F.when(balance >= 5000, balance),
        "lon": F.when(balance >= 7000, balance),
        "place_name": F.when(balance.between(2000, 8000), F.col("s_name")),
        "address": F.when(balance < 3000, F.col("s_name")),
        "validity_from": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "validity_to": F.date_format(F.date_add("l_shipdate", 7), "yyyy-MM-dd"),
        "offers_count": F.col("l_quantity"),
        "ai_input_tokens": F.col("l_partkey"),
        "ai_cached_tokens": F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")),
        "ai_output_tokens": F.col("l_suppkey"),
        "processing_time_seconds": F.col("l_quantity") / 8.0,
    }
    wanted = [columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FOLD_INPUT.fields]
    return lines.select(*wanted, line_arrival().alias("arrival"))


def shop_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as raw places, with the holes that real messages have."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    balance = F.col("s_acctbal")
    source = F.struct(
        F.when(balance >= 0, F.col("s_name")).alias("placeId"),
        F.struct(
            F.when(balance < 9000, balance / 100.0).alias("lat"),
            F.when(balance >= 1000, F.col("n_nationkey").cast("double")).alias("lon"),
        ).alias("location"),
        F.when(balance < 3000, "  ").when(balance < 8000, F.col("n_name")).alias("name"),
        F.when(balance < 2000, "").otherwise(F.concat(F.lit("Via "), F.col("n_name"))).alias("address"),
    )
    return rows.select("s_suppkey", source.cast(PLACE).alias("source"))


def flyer_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two writes of the flyer table: all orders, then those with lines, counted."""
    first = fields(
        table(spark, sf_dir, "orders"), FLYERS,
        checksum=F.col("o_orderkey"), offers_count=F.lit(0), processing_time_seconds=F.col("o_totalprice"),
    )
    counts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")
    )
    second = fields(
        counts, FLYERS,
        checksum=F.col("l_orderkey"), offers_count=F.col("n"), processing_time_seconds=F.col("quantity"),
    )
    return first, second
