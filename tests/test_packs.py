"""Worked examples of the offer language."""

import pytest
from pyspark.sql import functions as F

from leafmill.functions import packs

AS_OF = "2025-06-20"

CASES = [
    ("Olio extravergine 750 ml - SCONTO 20% - da 9,90€ a 7,92€",
     [dict(name="Olio extravergine", price=7.92, quantity=750, total_quantity=750, count=1, uom="ml", notes=None)]),
    ("Capsule per macchina - Prezzo Speciale 6.40€ - Scatola da 30 pezzi - Offerta valida dal 02/07 al 05/07",
     [dict(name="Capsule per macchina", price=6.40, quantity=None, total_quantity=None, count=30, uom="pezzi",
           validity_from="2025-07-02T00:00:00.000Z", validity_to="2025-07-05T00:00:00.000Z")]),
    ("Tonno al naturale 120 g - 4x3 (prendi 4, paghi 3) - €1,50 a scatola",
     [dict(name="Tonno al naturale", price=4.50, quantity=120, total_quantity=480, count=4, uom="scatola",
           notes="Acquista 4, ne paghi 3")]),
    ("Riso carnaroli 1kg - 3.10€ (con carta fidelity) - Prezzo normale 4.20€",
     [dict(name="Riso carnaroli", price=3.10, quantity=1, total_quantity=1, count=1, uom="kg",
           notes="Valido solo con carta fedeltà")]),
    ("Uva da tavola Bianca / Rossa - 2,60€/kg",
     [dict(name="Uva da tavola Bianca", price=2.60, quantity=1, total_quantity=1, count=None, uom="kg"),
      dict(name="Uva da tavola Rossa", price=2.60, quantity=1, total_quantity=1, count=None, uom="kg")]),
    ("Budino alla vaniglia 4x110g - 1,99€ - Valido dal 3 al 9 luglio",
     [dict(name="Budino alla vaniglia", price=1.99, quantity=110, total_quantity=440, count=4, uom="g",
           validity_from="2025-07-03T00:00:00.000Z", validity_to="2025-07-09T00:00:00.000Z")]),
    ("Filetti di merluzzo 2pz, 0.9kg - €8,50",
     [dict(name="Filetti di merluzzo", price=8.50, quantity=0.45, total_quantity=0.9, count=2, uom="kg")]),
    ("Pecorino stagionato (circa 300 g) al kg €17,80",
     [dict(name="Pecorino stagionato", price=17.8, quantity=1, total_quantity=1, count=None, uom="kg",
           notes="Circa 300g")]),
    ("Lavatrice slim - 1.249,00€", [dict(name="Lavatrice slim", price=1249.0)]),
    ("Cucina a gas - € 2.450", [dict(name="Cucina a gas", price=2450.0)]),
    ("Salsiccia 400 g 3,15 cad.", [dict(price=3.15, quantity=400, uom="g")]),
    ("Sconto 25% su tutte le birre", [dict(price=None)]),
    ("Cuscino da viaggio - 7,90€", [dict(name="Cuscino da viaggio", price=7.90)]),
    ("Latte 1 lt 0,99", [dict(name="Latte", price=0.99, quantity=1, uom="lt")]),
    ("Burger 200 g 2,29 cad.", [dict(name="Burger", price=2.29, quantity=200, uom="g")]),
    ("Shampoo 250 ml 1+1 gratis 3,20€",
     [dict(name="Shampoo", price=3.20, quantity=250, total_quantity=500, count=2, notes="Acquista 2, ne paghi 1")]),
    ("Pesche gialle 1,89 fino al 30/06",
     [dict(name="Pesche gialle", price=1.89, validity_from=None, validity_to="2025-06-30T00:00:00.000Z")]),
    ("Gelato 500 g - 2,49€ - dall'8 all'11 luglio",
     [dict(name="Gelato", validity_from="2025-07-08T00:00:00.000Z", validity_to="2025-07-11T00:00:00.000Z")]),
    ("Tenda 2,50 m - 19,00€", [dict(price=19.0)]),
    ("Corda 2,50 mt", []),
    ("Abbonamento alla palestra - 39,00€", []),
    ("Viaggio a Parigi - 299,00€", []),
    ("Aperti anche la domenica", []),
    ("", []),
]


@pytest.fixture(scope="module")
def read(spark):
    """Both forms of the reader over all lines at once, as ``{line: (of the table, of the column)}``."""
    # The texts are a column of data here, not literals, so that nothing is folded away.
    rows = spark.createDataFrame([(text,) for text, _ in CASES], "line string")
    as_of, category = F.lit(AS_OF).cast("date"), F.lit("Bevande")
    one = packs.read_offers(F.col("line"), as_of, category)
    found = {r["line"]: ([], r["o"]) for r in rows.select("line", one.alias("o")).collect()}
    for r in packs.read_lines(rows, F.col("line"), as_of, category).orderBy("offer_n").collect():
        found[r["line"]][0].append(r["offer"])
    return found


@pytest.mark.parametrize(("text", "expected"), CASES)
def test_line(read, text, expected):
    of_table, of_column = read[text]
    assert of_table == of_column
    found = [o.asDict() for o in of_column]
    assert len(found) == len(expected)
    for offer, wanted in zip(found, expected):
        for field, value in wanted.items():
            if isinstance(value, float):
                assert offer[field] == pytest.approx(value, rel=1e-6), field
            else:
                assert offer[field] == value, field


def test_price_per_piece_wins_over_price_per_kg(spark):
    row = spark.createDataFrame([("Cotoletta 150 g 1,95 cad. - al kg Euro 13,00",)], "t string")
    pack = row.select(packs.pack(F.col("t")).alias("p")).first()["p"]
    assert (pack["price"], pack["quantity"], pack["uom"]) == (1.95, 150.0, "g")


def test_null_text(spark):
    row = spark.createDataFrame([(None,)], "t string")
    offers = packs.read_offers(F.col("t"), F.lit(AS_OF).cast("date"), F.lit("Bevande"))
    assert row.select(offers.alias("o")).first()["o"] == []


def _largest_method(frame) -> int:
    stages = frame._jdf.queryExecution().debug().codegenToSeq()
    return max((stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length())), default=0)


def test_no_method_of_the_line_reader_is_too_large_to_be_compiled(spark):
    """HotSpot leaves methods of over 8,000 bytes to its interpreter."""
    rows = spark.range(8).selectExpr("id", "concat('Passata ', id, '00g - 1,20€') as line")
    assert _largest_method(packs.add_pack(rows, F.col("line"))) <= 8_000
    read = packs.read_lines(rows, F.col("line"), F.lit("2025-06-20").cast("date"), F.lit("Dispensa secca"))
    assert _largest_method(read) <= 8_000
    assert read.count() == 8
