"""Offer texts: what is embedded, what is valid, and Italian search terms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The closed set of product categories.
CATEGORIES = (
    "Bevande",
    "Latticini e uova",
    "Carne e salumi",
    "Pesce e surgelati",
    "Frutta e verdura",
    "Dispensa secca",
    "Snack e dolci",
    "Cura della casa",
    "Cura della persona",
    "Prodotti per l'infanzia",
    "Giochi",
    "Elettrodomestici",
    "Abbigliamento",
    "Decorazioni per la casa",
)

# Longest text that gets a raw keyword twin.
KEYWORD_MAX_CHARS = 256

# Elided Italian articles and prepositions.
ELISIONS = (
    "c", "l", "all", "dall", "dell", "nell", "sull", "coll", "pell", "gl", "agl", "dagl",
    "degl", "negl", "sugl", "un", "m", "t", "s", "v", "d",
)

# Italian function words that a search ignores. The forms of avere, essere, fare
# and stare follow from stems and endings.
_FUNCTION_WORDS = (
    "ad al allo ai agli all agl alla alle con col coi da dal dallo dai dagli dall dagl dalla dalle di del dello dei "
    "degli dell degl della delle in nel nello nei negli nell negl nella nelle su sul sullo sui sugli sull sugl sulla "
    "sulle per tra contro io tu lui lei noi voi loro mio mia miei mie tuo tua tuoi tue suo sua suoi sue nostro nostra "
    "nostri nostre vostro vostra vostri vostre mi ti ci vi lo la li le gli ne il un uno una ma ed se perché anche come "
    "dov dove che chi cui non più quale quanto quanti quanta quante quello quelli quella quelle questo questi questa "
    "queste si tutto tutti a c e i l o"
)
_IRREGULAR_FORMS = (
    "ho hai ha abbiamo avete hanno ebbi ebbe ebbero avendo avuto avuta avuti avute sono sei è siamo siete fui fosti fu "
    "fummo foste furono fossi fosse fossimo fossero ero eri era eravamo eravate erano essendo faccio fai facciamo fanno "
    "feci fece fecero facendo sto stai sta stiamo stanno stetti stette stettero stando"
)
_VERB_FORMS = (
    (("avr", "sar", "far", "star"), ("ò", "ai", "à", "emo", "ete", "anno", "ei", "esti", "ebbe", "emmo", "este", "ebbero")),
    (("avev", "facev", "stav"), ("o", "i", "a", "amo", "ate", "ano")),
    (("av", "fac", "st"), ("esti", "emmo", "este", "essi", "esse", "essimo", "essero")),
    (("abbi", "si", "facci", "sti"), ("a", "ate", "ano")),
)
ITALIAN_STOP_WORDS = tuple(
    dict.fromkeys(
        _FUNCTION_WORDS.split()
        + _IRREGULAR_FORMS.split()
        + [stem_ + ending for stems, endings in _VERB_FORMS for stem_ in stems for ending in endings]
    )
)

# A search token, the elided head of one, and the light Italian suffixes
# (words of six letters or more lose a final vowel, or -he -ie -hi -ii -ia -io).
TOKEN = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"
ELIDED = r"^(?:" + "|".join(ELISIONS) + r")['’]"
SUFFIX = r"^(.{4,}?)(?:[hi]e|[hi]i|ia|io|[aeio])$"
ACCENTED, PLAIN = "àáâäòóôöèéêëùúûüìíîï", "aaaaooooeeeeuuuuiiii"


def embeddable_text(name: Column, type_: Column) -> Column:
    """``name. type.``, with the word None for a missing part."""
    none = F.lit("None")
    return F.concat(F.coalesce(name, none), F.lit(". "), F.coalesce(type_, none), F.lit("."))


def is_present(text: Column) -> Column:
    return F.coalesce(F.length(F.trim(text)) > 0, F.lit(False))


def all_present(texts: Column) -> Column:
    """True when the array has items and none is null or blank."""
    return F.coalesce((F.size(texts) > 0) & F.forall(texts, is_present), F.lit(False))


def known_category(category: Column, allowed: tuple[str, ...] = CATEGORIES) -> Column:
    return F.coalesce(category.isin(*allowed), F.lit(False))


def offer_reject_reason(offer: Column, allowed: tuple[str, ...] = CATEGORIES) -> Column:
    """Null for a valid offer, else the first rule it breaks."""
    return (
        F.when(offer["name"].isNull(), "name missing")
        .when(offer["category"].isNull(), "category missing")
        .when(~known_category(offer["category"], allowed), "category unknown")
    )


def flyer_reject_reason(validity_from: Column, validity_to: Column, offers: Column) -> Column:
    """Null for valid extractor output of one chunk, else the first rule it breaks."""
    return (
        F.when(validity_from.isNull(), "validity_from missing")
        .when(validity_to.isNull(), "validity_to missing")
        .when(offers.isNull(), "offers missing")
    )


def raw_keyword(text: Column) -> Column:
    """The unanalysed twin of a text field; over-long values have none."""
    return F.when(F.length(text) <= KEYWORD_MAX_CHARS, text)


def words(text: Column) -> Column:
    """Lower-case words of a text, elided articles still on them."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def without_elision(word: Column) -> Column:
    return F.when(word.rlike("['’]"), F.regexp_replace(word, ELIDED, "")).otherwise(word)


def stem(word: Column) -> Column:
    """Light Italian stem: accents folded, plural and gender endings dropped."""
    folded = F.translate(word, ACCENTED, PLAIN)
    return F.when(F.length(word) >= 6, F.regexp_replace(folded, SUFFIX, "$1")).otherwise(word)
