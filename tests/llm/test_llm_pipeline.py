"""The pipeline's stages one after the other."""

import hashlib
import random

from llm_data import SCHEMA, SF, empty, messy, needs_tables

import corpus_pipeline
from retailflow.llm.shared import written


def through(spark, docs):
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], SF), "stage"))
    return tables


def test_awkward_rows(spark):
    docs = messy(spark)
    tables = through(spark, docs)
    assert all(t.columns == docs.columns for t in tables[:-1])
    first = {r.doc_id for r in tables[1].collect()}
    assert first & {1, 2, 3, 13} == set() and {4, 6, 9, 12, 17, None} <= first
    second = sorted((r.doc_id for r in tables[2].collect()), key=repr)
    assert second == sorted([4, 6, 9, 10, 11, 12, None, 15, 16, 17], key=repr)
    assert tables[3].count() == tables[2].count()
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"} == set(tables[5].columns) and tables[5].count() == tables[4].count()
    texts = {hashlib.sha256(r.text.encode()).hexdigest() for r in tables[4].collect()}
    assert {r.decoded_sha256 for r in tables[5].collect()} == texts


def test_no_rows(spark):
    assert [t.count() for t in through(spark, empty(spark))] == [0] * 6


def test_language_stage_rejects_what_is_in_no_learned_language(spark):
    """Four languages: the greatest share of a text is never under 1/4, so junk and unlearned scripts must show otherwise."""
    rng = random.Random(5)
    words = {"en": "the house and the river are with us when they have been there", "de": "der hund und die katze sind nicht über das grüne feld gelaufen",
             "fr": "les enfants sont dans la maison avec une petite fleur rouge", "es": "los perros corren por el campo cuando llega la noche oscura"}
    prose = lambda lang, n=30: " ".join(rng.choice(words[lang].split()) for _ in range(n))
    junk = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(30))
    good = [(i, prose(lang), lang) for i, lang in enumerate(list(words) * 40)] + [(1000 + i, prose(lang), None) for i, lang in enumerate(words)]
    good += [(1010, " ".join(map(prose, words)), None), (1011, "the", None), (1012, prose("en") + " мир 你好", None)]
    bad = [(2000 + i, junk(), None) for i in range(5)] + [(2010, "это не только слова но и предложения", None), (2011, "αβγ δεζ", None),
           (2012, "the " + "слова " * 20, None), (2013, "1234 !!!", None), (2014, None, None)]
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in good + bad], SCHEMA).repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.in_a_language(spark, docs, SF).collect()}
    assert kept == {i for i, _, _ in good}


@needs_tables
def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and [n for n, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "repeated passages", "mix", "token ids"]
