"""A corpus pipeline of five stages over ``documents``, each of them one of the operators of ``leafmill.llm``.

``STAGES`` lists them; a stage takes the documents that the one before kept. ``run`` writes every
stage's documents to the shared scratch folder and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.llm import bpe, langid, mixing, near_dup, quality
from leafmill.llm.common import crc_mod, stored, table

# A text whose positions favour no language by so much is rejected.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts in a known language; the network learns from rows whose crc32 of the id is no multiple of 5."""
    model = langid.train(docs.filter(crc_mod(F.col("doc_id"), 5) != 0))
    found = langid.predict(docs, model, docs.columns)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(known).select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that pass the base rules and are good by the weighed votes of all rules."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: five-word shingles, similarity of 0.8 or more."""
    return near_dup.keep_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say; languages are the domains, the root of their shares the target."""
    labelled = mixing.labelled_sample(docs, table(spark, sf_dir, "labels"), "lang")
    return mixing.sample(docs, mixing.mix(docs.select("doc_id", "text"), labelled))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the decoded text's digest of every row."""
    coded = bpe.bpe_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), payload=True)
    return coded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", bpe_tokens),
]

# A trained network, expectation-maximisation and BPE merges are no SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{i + 1}")
    return docs
