"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns documents; the last returns their token ids.

1. language: documents without a language go: no letter; under ``LEAST_KNOWN`` of the letters in scripts of learned languages;
   or, from ``LEAST_LETTERS`` letters on (fewer are no evidence), trigrams under the floor.  Text mixed of learned languages stays.
2. near duplicates: shingles of five words, similarity 0.8; one document of each group stays.
3. repeated passages: bytes covered by a string of 200 bytes that starts elsewhere too go, documents stay.
4. mix: documents in whole repeats and parts, so that sources reach their targets; a document may be two rows.
5. token ids: byte-level BPE, decoded again.

Each stage defines null, empty, long and repeated rows in its operator; other columns pass
through unchanged whatever their names (n_chars follows the text).  An empty table passes all stages empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import bpe, language, mixing, near_dup, suffix_dedup
from retailflow.llm.queries import tokenizer_file, tokenizer_pattern
from retailflow.llm.shared import table, written

LEAST_KNOWN = 0.5
LEAST_LETTERS = 30


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.learn(docs.select("doc_id", "text", "lang"), evidence=True)
    found = language.identify(docs.select(F.struct("*").alias("row"), "text"), model, evidence=True)
    fits = (F.col("evidence.letters") < LEAST_LETTERS) | (F.col("evidence.fit") >= 0)
    return found.where((F.col("lang_pred") != "und") & (F.col("evidence.known") >= LEAST_KNOWN) & fits).select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cleaned(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern(), with_ids=True)


STAGES = [("language", in_a_language), ("near duplicates", without_near_duplicates), ("repeated passages", without_repeats),
          ("mix", mix), ("token ids", token_ids)]

#: SQL cannot express the classifier, the suffix arrays or the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
