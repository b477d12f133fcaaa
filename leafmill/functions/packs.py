"""Reading one Italian offer line: price, pack arithmetic, promotions, notes.

A rule reader for the plain-text cases. It is the deterministic default where no
model is plugged in; wording that needs the picture on the page is out of its reach.

The rules are stages, each computing named values from those before it. As columns of a
table (``add_pack``, ``read_lines``) a stage is one projection in generated code; as one
expression (``pack``, ``read_offers``) the values travel in structs, for lines inside arrays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.functions.binding import Known, Stage, add_stages, first_match, in_stages, mentions
from leafmill.functions.dates import ISO_MILLIS, SPAN, SPAN_STAGES, UNTIL
from leafmill.schemas import OFFER

# Patterns of the offer language, for lower-case text.
NUMBER = r"(\d+(?:[.,]\d+)?)"
UNIT = r"(kg|gr?|mg|lt?|cl|ml)\b"
AMOUNT = r"(?:\d{1,3}(?:\.\d{3})+(?:,\d{1,2})?|\d+(?:[.,]\d{1,2})?)"
PRICE = r"(?:€|euro)\s*" + AMOUNT + "|" + AMOUNT + r"\s*(?:€|euro)"
EACH = "(" + AMOUNT + r")\s*(?:€|euro)?\s*cad\b"
BARE_PRICE = (
    r"(?<![\d.,/])(?:\d{1,3}(?:\.\d{3})+|\d+),\d{2}(?![\d.,/])(?!\s*(?:%|[x×]|(?:kg|gr?|mg|lt?|cl|ml|cm|mm|mt?|pz|pezzi|w)\b))"
)
USUAL_PRICE = r"prezzo normale\s*(?:(?:€|euro)\s*" + AMOUNT + r"|" + AMOUNT + r"\s*(?:€|euro)?)"
THOUSANDS = r"^\d{1,3}(?:\.\d{3})+(?:,\d+)?$"
DISCOUNT = r"\bscont[oi]\b|\d\s*%"
PER_KG = r"/\s*kg\b|\bal\s+kg\b"
LOYALTY = r"\bcarta\s+(?:fidelity|fedelt)"
MULTI_PACK = r"\b(\d+)\s*x\s*" + NUMBER + r"\s*" + UNIT
N_FOR_M = r"\b(\d+)\s*x\s*(\d+)\b(?!\s*(?:kg|gr?|mg|lt?|cl|ml)\b|[.,]\d)"
N_PLUS_M = r"\b(\d+)\s*\+\s*(\d+)\s*(?:in\s+)?(?:gratis|omaggio)\b"
PIECES_TOTAL = r"\b(\d+)\s*(?:pz|pezzi)\b\.?\s*,?\s*" + NUMBER + r"\s*" + UNIT
PIECES = r"\b(\d+)\s*(?:pz|pezzi)\b"
SINGLE = r"\b" + NUMBER + r"\s*" + UNIT
PORTION = r"(?:€\s*\d+(?:[.,]\d+)?|\d+(?:[.,]\d+)?\s*€)\s+a\s+(\p{L}+)"
VALIDITY = r"\(?\b(?:offerta\s+)?(?:valid[ao]\s+)?(?:" + SPAN + "|" + UNTIL + r")\)?"
ABOUT = r"\((circa\s+[^)]+)\)"
SERVICES = r"(?i)\b(?:abbonament[oi]|(?<!\bda )viaggio?|vacanz[ae]|crocier[ae]|polizz[ae]|assicurazion[ei])\b"

# Words without which a pattern above cannot match.
EURO_WORDS, PIECE_WORDS, X_WORDS, KG_WORDS, PLUS_WORDS = ("€", "euro"), ("pz", "pezzi"), ("x",), ("kg",), ("+",)
UNIT_LETTERS = ("g", "l")

# Texts of notes.
NOTE_LOYALTY = "Valido solo con carta fedeltà"


def offers_type() -> str:
    return f"array<{OFFER.simpleString()}>"


def number(text: Column) -> Column:
    """Decimal number with a comma or a point; null when it is none."""
    return F.regexp_replace(text, ",", ".").try_cast("double")


def amount(text: Column) -> Column:
    """A sum of money: as ``number``, and a point before each three digits is no decimal point."""
    plain = F.when(text.rlike(THOUSANDS), F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    return number(plain)


def in_scope(text: Column, services: str = SERVICES) -> Column:
    """Physical products only: texts that sell a service are out."""
    return ~F.coalesce(text.rlike(services), F.lit(False))


def _lower(m: Known) -> Known:
    return {"text": F.lower(m["line"])}


def _payable(m: Known) -> Known:
    usual = F.regexp_replace(m["text"], USUAL_PRICE, "")
    return {"payable": F.when(m["text"].contains("prezzo normale"), usual).otherwise(m["text"])}


def _search(m: Known) -> Known:
    text = m["text"]

    def last(pattern: str) -> Column:
        return F.try_element_at(F.regexp_extract_all(m["payable"], F.lit(pattern), F.lit(0)), F.lit(-1))

    return {
        "each": first_match(text, EACH, ("cad",)),
        "priced": F.when(mentions(text, EURO_WORDS), last(PRICE)),
        "bare": F.when(text.contains(",") & ~mentions(text, (*EURO_WORDS, "cad")), last(BARE_PRICE)),
        "says_per_kg": mentions(text, KG_WORDS) & text.rlike(PER_KG),
        "n_for_m": first_match(text, N_FOR_M, X_WORDS),
        "n_plus_m": first_match(text, N_PLUS_M, PLUS_WORDS),
        "portion": first_match(text, PORTION, (" a ",), 1),
        "multi": first_match(text, MULTI_PACK, X_WORDS),
        "total": first_match(text, PIECES_TOTAL, PIECE_WORDS),
        "pieces": first_match(text, PIECES, PIECE_WORDS, 1).try_cast("double"),
        "one": first_match(text, SINGLE, UNIT_LETTERS),
        "loyalty": text.contains("carta") & text.rlike(LOYALTY),
        "about": first_match(text, ABOUT, ("(circa",), 1),
    }


def _cut(m: Known) -> Known:
    """Groups are read off the matches: the whole line is searched once per pattern."""

    def part(match: str, pattern: str, group: int) -> Column:
        return F.when(m[match] != "", F.regexp_extract(m[match], pattern, group))

    return {
        "money": F.coalesce(
            part("each", EACH, 1), F.regexp_replace(m["priced"], r"[^\d.,]", ""), m["bare"]
        ),
        "per_kg": m["says_per_kg"] & (m["each"] == ""),
        "buy_n": part("n_for_m", N_FOR_M, 1).try_cast("int"),
        "pay_n": part("n_for_m", N_FOR_M, 2).try_cast("int"),
        "paid": part("n_plus_m", N_PLUS_M, 1).try_cast("int"),
        "free": part("n_plus_m", N_PLUS_M, 2).try_cast("int"),
        "pack_n": part("multi", MULTI_PACK, 1).try_cast("double"),
        "pack_q": number(part("multi", MULTI_PACK, 2)),
        "pack_u": part("multi", MULTI_PACK, 3),
        "total_n": part("total", PIECES_TOTAL, 1).try_cast("double"),
        "total_q": number(part("total", PIECES_TOTAL, 2)),
        "total_u": part("total", PIECES_TOTAL, 3),
        "one_q": number(part("one", SINGLE, 1)),
        "one_u": part("one", SINGLE, 2),
    }


def _count(m: Known) -> Known:
    is_n_for_m = m["buy_n"] > m["pay_n"]
    return {
        "price": amount(m["money"]),
        "buy": F.when(is_n_for_m, m["buy_n"]).otherwise(m["paid"] + m["free"]),
        "pay": F.when(is_n_for_m, m["pay_n"]).otherwise(m["paid"]),
    }


# From ``line`` to all that is known of it.
READING: tuple[Stage, ...] = (_lower, _payable, _search, _cut, _count)


def _pack_of(m: Known) -> Column:
    none, one = F.lit(None).cast("double"), F.lit(1.0)

    def result(price: Column, quantity: Column, total: Column, count: Column, uom: Column) -> Column:
        return F.struct(
            price.alias("price"), quantity.alias("quantity"), total.alias("total_quantity"),
            count.alias("count"), uom.alias("uom"),
        )

    price = m["price"]
    return (
        F.when(m["per_kg"], result(price, one, one, none, F.lit("kg")))
        .when(
            m["buy"] > m["pay"],
            result(
                F.round(price * m["pay"], 2), m["one_q"], m["one_q"] * m["buy"], m["buy"].cast("double"),
                F.coalesce(F.when(m["portion"] != "", m["portion"]), m["one_u"]),
            ),
        )
        .when(
            m["pack_n"].isNotNull(),
            result(price, m["pack_q"], m["pack_n"] * m["pack_q"], m["pack_n"], m["pack_u"]),
        )
        .when(
            m["total_n"].isNotNull(),
            result(price, F.try_divide(m["total_q"], m["total_n"]), m["total_q"], m["total_n"], m["total_u"]),
        )
        .when(m["pieces"].isNotNull(), result(price, none, none, m["pieces"], F.lit("pezzi")))
        .when(m["one_q"].isNotNull(), result(price, m["one_q"], m["one_q"], one, m["one_u"]))
        .otherwise(result(price, none, none, none, F.lit(None).cast("string")))
    )


def _notes_of(m: Known) -> Column:
    promo = F.when(
        m["buy"] > m["pay"],
        F.concat(F.lit("Acquista "), m["buy"].cast("string"), F.lit(", ne paghi "), m["pay"].cast("string")),
    )
    loyalty = F.when(m["loyalty"], F.lit(NOTE_LOYALTY))
    about = F.concat(F.upper(F.substring(m["about"], 1, 1)), F.regexp_replace(m["about"], "^.", ""))
    about = F.regexp_replace(about, r"(\d)\s+(\p{L}+)$", "$1$2")
    about = F.when(m["about"] != "", about)
    # Null when there is none: the first that holds opens the text.
    any_note = promo.isNotNull() | loyalty.isNotNull() | about.isNotNull()
    return F.when(any_note, F.concat_ws("; ", promo, loyalty, about))


PACK_FIELDS = ("price", "quantity", "total_quantity", "count", "uom")


def _packed(m: Known) -> Known:
    return {"pack": _pack_of(m), "notes": _notes_of(m)}


def _both(m: Known) -> Column:
    return F.struct(*[m["pack"][n].alias(n) for n in PACK_FIELDS], m["notes"].alias("notes"))


def final_price(text: Column) -> Column:
    """The price to pay: the one per piece if named, else the last that is not the usual one."""
    return in_stages({"line": text}, READING, lambda m: m["price"])


def pack(text: Column) -> Column:
    """``struct<price, quantity, total_quantity, count, uom>`` of one offer text."""
    return in_stages({"line": text}, READING, _pack_of)


def notes(text: Column) -> Column:
    """Conditions worth keeping: promotion, loyalty card, approximate weight."""
    return in_stages({"line": text}, READING, _notes_of)


def pack_and_notes(text: Column) -> Column:
    """Both of the above in one struct, from one reading of the text."""
    return in_stages({"line": text}, (*READING, _packed), _both)


def add_pack(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with price, quantity, total_quantity, count, uom and notes of a text column."""
    read, m = add_stages(rows, {"line": text}, (*READING, _packed), "_line_")
    return read.select(*[rows[c] for c in rows.columns], *[m["pack"][n].alias(n) for n in PACK_FIELDS], m["notes"].alias("notes"))


def _product_parts(m: Known) -> Known:
    return {"parts": F.split(m["name"], r"\s*/\s*")}


def _product_head(m: Known) -> Known:
    return {"head": F.regexp_replace(m["parts"][0], r"\s*\S+$", "")}


def _product_names(m: Known) -> Column:
    def named(part: Column, i: Column) -> Column:
        joined = F.concat(m["head"], F.lit(" "), part)
        return F.when((i > 0) & ~part.contains(" ") & (m["head"] != ""), joined).otherwise(part)

    return F.transform(m["parts"], named)


PRODUCTS: tuple[Stage, ...] = (_product_parts, _product_head)


def product_names(name: Column) -> Column:
    """One name per product of "A b / c": a one-word alternative replaces the last word."""
    return in_stages({"name": name}, PRODUCTS, _product_names)


def _name_head(m: Known) -> Known:
    return {"name_head": F.regexp_extract(m["line"], r"^(.*?)(?:\s+[-–]\s|$)", 1)}


def _name(m: Known) -> Known:
    rest = m["name_head"]
    stripped = (ABOUT, VALIDITY, PIECES_TOTAL, MULTI_PACK, N_FOR_M, N_PLUS_M, EACH + r"\.?", PRICE, BARE_PRICE, PER_KG, PIECES, SINGLE)
    for pattern in stripped:
        rest = F.regexp_replace(rest, "(?i)" + pattern, "")
    rest = F.regexp_replace(rest, r"\s{2,}", " ")
    # A name without digits and brackets has nothing to strip.
    bare = F.when(m["name_head"].rlike(r"\d|\("), rest).otherwise(m["name_head"])
    return {"name": F.trim(F.regexp_replace(bare, r"[\s,.;:(/-]+$", ""))}


NAMING: tuple[Stage, ...] = (_name_head, _name)


def base_name(text: Column) -> Column:
    """The product name: what comes before the first dash, without packs, prices and dates."""
    return in_stages({"line": text}, NAMING, lambda m: m["name"])


def _is_offer(m: Known) -> Known:
    return {"discount": F.coalesce(m["text"].rlike(DISCOUNT), F.lit(False)), "in_scope": in_scope(m["line"])}


def _offers_of(category: Column) -> Callable[[Known], Column]:
    def offers(m: Known) -> Column:
        def offer(name: Column) -> Column:
            return F.struct(
                name.alias("name"),
                *[m["pack"][n].alias(n) for n in PACK_FIELDS],
                category.alias("category"),
                F.lit(None).cast("string").alias("type"),
                m["notes"].alias("notes"),
                F.date_format(m["start"], ISO_MILLIS).alias("validity_from"),
                F.date_format(m["end"], ISO_MILLIS).alias("validity_to"),
                F.lit(None).cast("array<float>").alias("embeddings"),
            )

        found = F.transform(_product_names(m), offer).cast(offers_type())
        priced = m["pack"]["price"].isNotNull() | m["discount"]
        keep = m["in_scope"] & priced & (F.length(m["name"]) > 0)
        return F.when(keep, found).otherwise(F.array().cast(offers_type()))

    return offers


OFFER_STAGES: tuple[Stage, ...] = (*READING, _packed, _is_offer, *SPAN_STAGES, *NAMING, *PRODUCTS)


def read_offers(text: Column, as_of: Column, category: Column) -> Column:
    """All offers named by one line, as ``array<offer>``; none out of scope.

    A line is an offer when it has a price or a discount; the price of a mere discount is null.
    ``type`` is left null: it comes from a table of terms (``operators.types``).
    """
    low = F.lower(text)
    worth = mentions(low, (*EURO_WORDS, "cad", ",", "%")) | low.rlike(DISCOUNT)
    read = in_stages({"line": text, "as_of": as_of}, OFFER_STAGES, _offers_of(category))
    return F.when(worth, read).otherwise(F.array().cast(offers_type()))


def read_lines(rows: DataFrame, text: Column, as_of: Column, category: Column) -> DataFrame:
    """One row per offer: the columns of ``rows``, ``offer_n`` and ``offer``, what ``read_offers`` gives.

    The explosion is an outer one, filtered after it: for an inner one Spark would push the test
    for offers below the stages, with all of them written into it.
    """
    read, m = add_stages(rows, {"line": text, "as_of": as_of}, OFFER_STAGES, "_line_")
    offers = F.posexplode_outer(_offers_of(category)(m)).alias("offer_n", "offer")
    return read.select(*[rows[c] for c in rows.columns], offers).filter("offer is not null")
