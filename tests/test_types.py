"""Product types by the longest term in a name."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafmill.operators import types
from leafmill.operators.types import types_of, with_types

# Names as they are read off the worked examples of the offer language, and their types.
TERMS = [
    ("passata di pomodoro", "passata di pomodoro"), ("passata", "passata"), ("pomodoro", "pomodoro"), ("Pannolini", "pannolini"),
    ("yogurt", "yogurt"), ("caffè", "caffè"), ("caffè macinato", "caffè macinato"), ("prosciutto", "prosciutto"),
    ("prosciutto cotto", "prosciutto cotto"), ("prosciutto crudo", "prosciutto crudo"), ("mozzarella", "mozzarella"),
    ("pizza", "pizza"), ("cotolette soia", "cotolette di soia"), ("nuggets soia", "nuggets di soia"),
    ("burger soia", "burger di soia"), ("burger alle verdure", "burger alle verdure"), ("latte", "latte"), ("provola", "provola"),
    ("pane", "pane"), ("vino", "vino b"), ("vino", "vino a"), ("  ", "nulla"), ("sale", None),
]
EXAMPLES = {
    "Passata di Pomodoro": "passata di pomodoro",
    "Pannolini Baby Comfort Maxi": "pannolini",
    "Yogurt Cremoso Frutta": "yogurt",
    "Caffè Macinato": "caffè macinato",
    "San Daniele Prosciutto Cotto": "prosciutto cotto",
    "San Daniele Prosciutto Crudo": "prosciutto crudo",
    "Mozzarella Santa Lucia": "mozzarella",
    "Tranci di Pizza Surgelata": "pizza",
    "Cotolette soia": "cotolette di soia",
    "Nuggets soia": "nuggets di soia",
    "Burger soia": "burger di soia",
    "Burger alle verdure": "burger alle verdure",
    "Ragusa latte provola": "provola",
    "VINO-rosso": "vino a",
    "Vino e pane": "vino a",
    "Sale fino": None,
    "Impianto": None,
    "": None,
    "?!": None,
    None: None,
}


def _terms(spark):
    return spark.createDataFrame(TERMS, "term string, type string")


def test_examples(spark):
    rows = spark.createDataFrame([(n, None, 1) for n in EXAMPLES] * 2, "name string, type string, n int")
    got = with_types(rows, _terms(spark))
    assert got.columns == ["name", "type", "n"]
    assert sorted(got.collect(), key=str) == sorted([(n, t, 1) for n, t in EXAMPLES.items()] * 2, key=str)


def test_a_stated_type_stays_and_empty_tables(spark):
    rows = spark.createDataFrame([("pane bianco", "altro"), ("pane bianco", None)], "name string, type string")
    assert sorted(r["type"] for r in with_types(rows, _terms(spark)).collect()) == ["altro", "pane"]
    none = _terms(spark).limit(0)
    assert sorted(str(r["type"]) for r in with_types(rows, none).collect()) == ["None", "altro"]
    assert with_types(rows.limit(0), _terms(spark)).count() == 0


def test_a_very_long_name_and_no_cross_join(spark):
    rows = spark.createDataFrame([("x " * 20_000 + "prosciutto cotto",)], "name string")
    found = types_of(rows, _terms(spark))
    assert [r["type"] for r in found.collect()] == ["prosciutto cotto"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_runs_of_words_are_never_broadcast(spark):
    """However small Spark takes the exploded runs for, they must not all go through the driver."""
    names = spark.range(200).selectExpr("concat('pane ', id, repeat(' vino', 50)) as name")
    terms = spark.range(20_000).selectExpr("concat('voce ', id) as term", "'voce' as type")
    found = types_of(names, terms)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def _typed_in_chunks(spark, rows, terms):
    """``name, type`` pairs of offers in chunks of three, looked up chunk-wise."""
    chunks = [(i // 3, 7, rows[i : i + 3]) for i in range(0, len(rows), 3)] + [(1_000, 7, []), (1_001, 7, None)]
    chunks = spark.createDataFrame(chunks, "a int, b int, offers_data array<struct<name string, type string>>").repartition(3)
    with types.types_in_chunks(chunks, terms, "a", "b") as found:
        filled = chunks.join(found, ["a", "b"], "left").select(types.fill_types(F.col("offers_data"), F.col("types")).alias("o"))
        return sorted(((r["name"], r["type"]) for r in filled.selectExpr("inline(o)").collect()), key=str)


@pytest.mark.parametrize("group_words", [1, 1 << 19])
def test_chunks_get_the_types_of_with_types_without_a_join_of_runs(spark, monkeypatch, group_words):
    monkeypatch.setattr(types, "GROUP_WORDS", group_words)
    rows = [(n, None) for n in EXAMPLES] * 2 + [("pane bianco", "altro"), ("pane bianco", None), (None, "altro"), ("x " * 20_000 + "prosciutto cotto", None)]
    flat = with_types(spark.createDataFrame(rows, "name string, type string"), _terms(spark)).collect()
    monkeypatch.setattr(types, "types_of", None)  # the way of the runs: not needed here
    assert _typed_in_chunks(spark, rows, _terms(spark)) == sorted(((r["name"], r["type"]) for r in flat), key=str)
    untyped = _typed_in_chunks(spark, rows, _terms(spark).limit(0))
    assert [t for _, t in untyped if t] == ["altro", "altro"] and len(untyped) == len(rows)


def test_names_that_the_filter_misleads_are_looked_up_by_all_runs(spark, monkeypatch):
    """With a filter that lets all pass, the best run is the whole name or its longest part, mostly no term."""
    rows = [(n, None) for n in EXAMPLES] + [("pane e vino rosso", None)] * 4
    want = sorted(((n, "pane" if n == "pane e vino rosso" else EXAMPLES[n]) for n, _ in rows), key=str)
    monkeypatch.setattr(types, "TermFilter", lambda listed, n: type("All", (), {"may_be": staticmethod(lambda h: np.arange(len(h)))}))
    for few in (0, 100_000):
        monkeypatch.setattr(types, "FEW_NAMES", few)
        assert _typed_in_chunks(spark, rows, _terms(spark)) == want


def test_two_readings_of_one_chunk_get_their_own_types(spark):
    chunk = "a int, offers_data array<struct<name string, type string>>"
    chunks = spark.createDataFrame([(1, [("pane", None)]), (1, [("latte", None)]), (1, [("pane", None)])], chunk)
    with types.types_in_chunks(chunks, _terms(spark), "a") as found:
        assert [r["types"] for r in found.select(F.map_values("types").alias("types")).collect()] in ([["pane", "latte"]], [["latte", "pane"]])


def test_the_filter_is_of_bounded_size_and_finds_all_terms(spark, monkeypatch):
    monkeypatch.setattr(types, "MOST_BITS", 1 << 17)
    listed = spark.range(9_000).selectExpr("case when id % 2 = 0 then concat('voce ', id) else concat('a', id) end as term", "'t' as type")
    known = types.TermFilter(listed, 9_000)
    assert known.words.nbytes * 8 == 1 << 17
    parts = pa.array([["voce", str(i)] if i % 2 == 0 else ["a" + str(i)] for i in range(9_000)])
    some, found = types.best_runs(parts, 2, known)
    assert len(some) == 9_000 and found[:3] == ["voce 0", "a1", "voce 2"]
