"""Small awkward tables for the tests of this folder."""

import functools
import os
import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not mounted")
#: Names that operators use for their own columns.
CLASHES = ["_id", "_hash", "_row", "text_hash", "size", "target", "score", "lang_pred", "spans", "node", "component", "kept", "host", "page", "data", "slot2"]

rng = random.Random(11)
SYLLABLES = ["ba", "ne", "ti", "lo", "mu", "ra", "se", "do", "vi", "ke"]


def word():
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(n):
    return " ".join(word() for _ in range(n))


PASSAGE = prose(60)
BASE = prose(120)


@functools.cache
def messy_rows():
    near = BASE.split()
    near[50] = "changed"
    long_ = prose(30_000)
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "word", "en", "b", 4), (5, "word", "en", "b", 4),
        (6, BASE, "en", "a", len(BASE)), (7, BASE, "en", "a", len(BASE)), (7, BASE, "en", "a", len(BASE)), (8, " ".join(near), "de", "b", 9),
        (9, prose(40) + "\n" + PASSAGE + "\n" + prose(40), "de", None, 9), (10, prose(40) + "\n" + PASSAGE, "fr", "c", 9),
        (11, long_, "fr", "c", len(long_)), (12, "你好 мир café naïve \U0001f600 12 345", None, "c", 9),
        (13, "1234 5678 !!! ???", "en", "d", 9), (None, "no id here at all", "en", "d", 9), (None, "no id here at all", "en", "d", 9), (14, "WORD", "en", "é", 4),
        (15, "a" * 700, "en", "a", 700), (16, "nul \x00 and \x1c control \x1f characters   space", "en", "a", 9), (17, "<|endoftext|> 'S we'll DON'T", "en", "a", 9)]


def messy(spark):
    """The awkward rows, with columns whose names clash with operators' own."""
    df = spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA).withColumns({c: F.lit(c) for c in CLASHES})


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def texts_of(spark, sf=SF):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
