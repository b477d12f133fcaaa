"""The pipeline: what each stage drops, columns between stages, and the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from leafmill.llm import bpe

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    first = base.orderBy("doc_id").filter("length(text) > 900 and lang = 'en' and text not rlike '[#|]|(!!)'").limit(1).collect()[0]["text"]
    words = first.split()
    rows = [(9001, first, "en", "p", 1), (9002, " ".join(w if i != 7 else "zzz" for i, w in enumerate(words)), "en", "p", 1), (9003, None, "en", "p", 1), (9004, "12 34 !!", "en", "p", 1), (9005, first, None, None, None)]
    return base.union(spark.createDataFrame(rows, base.schema))


def test_stages_one_after_the_other(spark, docs):
    stages = dict(pipeline.STAGES)
    named = stages["language ID"](spark, docs, SF).cache()
    assert named.columns == COLUMNS
    gone = {r["doc_id"] for r in docs.join(named, "doc_id", "left_anti").collect()}
    assert {9003, 9004} <= gone and len(gone) < 6
    good = stages["quality rules"](spark, named, SF).cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(named.filter("size(split(text, ' ')) > 25"), "doc_id")
    left = labels.join(good.select("doc_id").distinct(), "doc_id", "left_semi")
    assert left.filter("quality = 1").count() > 0.95 * labels.filter("quality = 1").count()
    single = stages["MinHash near-dedup"](spark, good, SF).cache()
    assert single.columns == COLUMNS
    left = {r["doc_id"] for r in single.collect()}
    assert not {9001, 9002, 9005} & left and single.count() == len(left)
    mixed = stages["mixing sources to target weights"](spark, single, SF).cache()
    assert mixed.columns == COLUMNS and 0.3 * single.count() < mixed.count() < 3 * single.count()
    coded = stages["BPE encoding and decoding"](spark, mixed, SF)
    model = bpe.WordBpe(pipeline.public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in coded.limit(20).collect():
        assert list(r["ids"]) == model.encode(texts[r["doc_id"]])
    assert coded.count() == mixed.count()
    for frame in (named, good, single, mixed):
        frame.unpersist()


def test_empty_and_repeated_rows(spark, docs):
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
    twice = docs.filter("doc_id < 6").union(docs.filter("doc_id < 6"))
    assert dict(pipeline.STAGES)["MinHash near-dedup"](spark, twice, SF).groupBy("doc_id").count().filter("count > 1").count() == 0


def test_registered_queries():
    names = entry.queries()
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and 4 <= len(pipeline.STAGES) <= 5


def test_run_gives_the_last_stage(spark):
    out = pipeline.run(spark, SF)
    assert {"doc_id", "n_tokens", "ids"} <= set(out.columns)
    assert out.filter(F.size("ids") != F.col("n_tokens")).count() == 0 and out.count() > 50
