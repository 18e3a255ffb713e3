"""Language identification of whole texts, with the spans of mixed-language ones.

Words are runs of letters of one script.  The script narrows a word to the languages written in it (as learned);
a model of letter trigrams, one per language, scores it under each; Viterbi over the words of a text then finds the
best labelling when every change of language costs ``SWITCH`` nats.  A text's language is the one that
holds most of its letters, its score is that share.

Learning.  Trigrams are counted in ``BUCKETS`` hash buckets, so a model has a fixed size per language.  They come
from a sample of about ``FIT_DOCS`` documents per language, taken by the hash of doc_id (all, if a language has
fewer); nothing else is sampled.  Null languages teach nothing.  Only text and language are learned from.

Cases.  Null text, or text without a letter: ``und``, score 0, no spans.  Words of a script that no language was
seen in fit every language and follow their neighbours; if all words do, the most frequent language stands, with
score 1 / languages.  ``evidence`` says whether a text is in the learned languages at all, whatever their number: the
share of its letters in scripts some language was learned in, and how far its trigrams score above a floor, per symbol.
A language's floor is a quarter of the way up from its labelled texts with their letters in another order to the texts
themselves, each scored by what the others teach; a language whose trigrams don't tell these apart has no floor.  Without anything to learn from everything is ``und``.  Ties go to the language that sorts
first.  Repeated rows, null ids and other columns pass through.  Texts are whole, of any length.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ready, tidy

BUCKETS = 1 << 16
FIT_DOCS = 4000
SWITCH = 8.0
#: A language is written in a script if that has this share of its letters.
SCRIPT_SHARE = 0.02
#: Where a language's floor lies between its texts in another order (0) and its texts (1).
FLOOR = 0.25
#: Bytes of text handled at once in a task.
AT_ONCE = 1 << 20

# Scripts and the code point ranges of their letters.
SCRIPTS = [
    ("Latin", [(0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)]),
    ("Greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("Cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("Armenian", [(0x530, 0x58F)]),
    ("Hebrew", [(0x590, 0x5FF)]),
    ("Arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("Devanagari", [(0x900, 0x97F)]),
    ("Bengali", [(0x980, 0x9FF)]),
    ("Gurmukhi", [(0xA00, 0xA7F)]),
    ("Gujarati", [(0xA80, 0xAFF)]),
    ("Tamil", [(0xB80, 0xBFF)]),
    ("Telugu", [(0xC00, 0xC7F)]),
    ("Kannada", [(0xC80, 0xCFF)]),
    ("Malayalam", [(0xD00, 0xD7F)]),
    ("Sinhala", [(0xD80, 0xDFF)]),
    ("Thai", [(0xE00, 0xE7F)]),
    ("Lao", [(0xE80, 0xEFF)]),
    ("Tibetan", [(0xF00, 0xFFF)]),
    ("Myanmar", [(0x1000, 0x109F)]),
    ("Georgian", [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)]),
    ("Ethiopic", [(0x1200, 0x139F)]),
    ("Khmer", [(0x1780, 0x17FF)]),
    ("Kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)]),
    ("Hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)]),
    ("Han", [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]),
]
OTHER = len(SCRIPTS) + 1

_tables: list[np.ndarray] = []


def letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: number of its script (0: no letter), and its lower-case code point."""
    if not _tables:
        is_letter = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)
        script = np.full(0x110000, OTHER, np.uint8)
        for number, (_, ranges) in enumerate(SCRIPTS, 1):
            for lo, hi in ranges:
                script[lo: hi + 1] = number
        lower = np.arange(0x110000, dtype=np.uint32)
        for i in range(0x20000):
            if len(low := chr(i).lower()) == 1:
                lower[i] = ord(low)
        _tables.extend([np.where(is_letter, script, 0).astype(np.uint8), lower])
    return _tables[0], _tables[1]


class Words:
    """Words of some texts, and the trigram buckets of all of them."""

    def __init__(self, texts: list[str]):
        script, lower = letters()
        # a space after each text ends its last word
        points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        kind = script[points]
        points = lower[points]
        self.text_ends = np.cumsum([len(t) + 1 for t in texts])
        before = np.concatenate([[0], kind[:-1]])
        inside = kind > 0
        starts = inside & (kind != before)
        # a word's symbols: its letters and its end; the end's place is that of the next character
        self.start = np.flatnonzero(starts)
        runs = np.flatnonzero(inside & (np.concatenate([kind[1:], [0]]) != kind))
        self.stop = runs + 1
        self.script = kind[self.start]
        size = self.stop - self.start + 1
        self.first = np.cumsum(size) - size  # of each word's symbols
        at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(self.first - self.start, size)
        place = at - np.repeat(self.start, size)
        last = place == np.repeat(size - 1, size)
        c0 = np.where(last, 0, points[np.minimum(at, len(points) - 1)]).astype(np.uint64)
        c1 = np.concatenate([[0], c0[:-1]]).astype(np.uint64)
        c1[place == 0] = 1
        c2 = np.concatenate([[0], c1[:-1]]).astype(np.uint64)
        c2[place == 0] = 1
        code = (c2 * np.uint64(0x9E3779B97F4A7C15)) ^ (c1 * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c0 * np.uint64(0x165667B19E3779F9))
        code ^= code >> np.uint64(29)
        self.bucket = ((code * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)
        self.size = size
        self.text = np.searchsorted(self.text_ends, self.start, "right")


class Model:
    """Log-probabilities of trigram buckets per language, and the languages of each script."""

    def __init__(self, langs: list[str], grams: np.ndarray, scripts: np.ndarray, documents: np.ndarray):
        """``grams`` [language, bucket], ``scripts`` [language, script], ``documents`` [language] are counts."""
        self.langs = langs
        if not langs:
            return
        total = grams.sum(1, keepdims=True)
        self.log = np.log((grams + 0.5) / (total + 0.5 * BUCKETS)).astype(np.float32).T.copy()
        share = scripts / np.maximum(1, scripts.sum(1, keepdims=True))
        self.allowed = (share >= SCRIPT_SHARE).T  # [script, language]
        self.common = int(documents.argmax())
        self.floor = np.full(len(langs), -np.inf)

    def word_scores(self, words: Words) -> np.ndarray:
        got = np.empty((len(words.start), len(self.langs)), np.float32)
        for i in range(len(self.langs)):
            got[:, i] = np.add.reduceat(self.log[:, i][words.bucket], words.first) if len(words.start) else 0
        allowed = self.allowed[words.script]
        known = allowed.any(1)
        got[~known] = 0
        got[known[:, None] & ~allowed] -= 1e4
        return got


def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word; text i has ``count[i]`` words from ``first[i]`` on.  All texts go forward in step."""
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    kind = np.min_scalar_type(max(0, scores.shape[1] - 1))  # of a label
    back = np.zeros(scores.shape, kind)
    own = np.arange(scores.shape[1], dtype=kind)
    value = scores[first[count > 0]].astype(np.float64)
    ends = np.empty((len(first), scores.shape[1]))
    live = len(value)
    for t in range(1, int(count.max(initial=0)) + 1):
        now = int(np.searchsorted(-count, -t, "left"))  # texts with more than t words
        if now < live:
            ends[now:live] = value[now:live]
            value, live = value[:now], now
        if not live:
            break
        best = value.argmax(1)
        jump = value[np.arange(live), best] - switch
        stay = value >= jump[:, None]
        at = first[:live] + t
        back[at] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, jump[:, None]) + scores[at]
        value -= value.max(1, keepdims=True)
    label = np.zeros(len(scores), kind)
    some = int((count > 0).sum())
    state = ends[:some].argmax(1).astype(kind)
    label[first[:some] + count[:some] - 1] = state
    for t in range(int(count.max(initial=0)) - 1, 0, -1):
        now = int(np.searchsorted(-count, -t, "left"))
        at = first[:now] + t
        label[at - 1] = back[at, label[at]]
    return label


def reordered(texts: list[str]) -> list[str]:
    """The texts with their letters in another order, which depends on the number of letters alone; the rest stays in place."""
    script, _ = letters()
    out = []
    for text in texts:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).copy()
        at = np.flatnonzero(script[points])
        points[at] = points[np.random.default_rng(len(at)).permutation(at)]
        out.append(points.tobytes().decode("utf-32-le"))
    return out


def predict(model: Model, texts: list[str], evidence: bool = False) -> tuple[list, ...]:
    """Language, score and spans (start, stop in code points, language) of every text; with ``evidence`` also (letters, known, fit).

    ``known`` is the share of letters in learned scripts, ``fit`` the mean of the symbols of these words above the floor (0 without any).
    """
    n = len(texts)
    if not model.langs:
        return (["und"] * n, [0.0] * n, [[] for _ in texts], *[[{"letters": 0, "known": 0.0, "fit": 0.0}] * n] * evidence)
    words = Words(texts)
    scores = model.word_scores(words)
    count = np.bincount(words.text, minlength=n)
    first = np.cumsum(count) - count
    label = viterbi(scores, first, count)
    k = len(model.langs)
    weight = np.bincount(words.text * k + label, words.size - 1, n * k).reshape(n, k)
    known = np.bincount(words.text, model.allowed[words.script].any(1), n) > 0
    total = weight.sum(1)
    pick = weight.argmax(1)
    share = weight[np.arange(n), pick] / np.maximum(1, total)
    langs = [("und" if not t else model.langs[p] if k else model.langs[model.common]) for t, p, k in zip(total, pick, known)]
    score = [0.0 if not t else float(s) if k else 1 / len(model.langs) for t, s, k in zip(total, share, known)]
    # runs of one label in one text
    new = np.ones(len(label), bool)
    new[1:] = (label[1:] != label[:-1]) | (words.text[1:] != words.text[:-1])
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(label)]]) - 1 if len(heads) else heads
    base = np.concatenate([[0], words.text_ends[:-1]])
    spans: list[list[dict]] = [[] for _ in texts]
    for h, t in zip(heads.tolist(), tails.tolist()):
        i = int(words.text[h])
        spans[i].append({"start": int(words.start[h] - base[i]), "stop": int(words.stop[t] - base[i]), "lang": model.langs[label[h]]})
    for i, k in enumerate(known):
        if total[i] and not k:
            spans[i] = [s | {"lang": model.langs[model.common]} for s in spans[i]]
    if not evidence:
        return langs, score, spans
    # words of unlearned scripts say nothing about trigrams
    learned = model.allowed[words.script].any(1)
    size, above = words.size * learned, np.zeros(len(label))
    at = np.flatnonzero(learned)
    above[at] = scores[at, label[at]] - model.floor[label[at]] * size[at]
    symbols = np.bincount(words.text, size, n)
    seen = np.bincount(words.text, (words.size - 1) * learned, n) / np.maximum(1, total)
    fit = np.bincount(words.text, above, n) / np.maximum(1, symbols)
    return langs, score, spans, [{"letters": int(t), "known": float(s), "fit": float(f)} for t, s, f in zip(total, seen, fit)]


def slices(texts: pa.Array):
    """(from, to, texts) of about AT_ONCE bytes; null is the empty text."""
    size, lo = 0, 0
    for i in range(len(texts)):
        size += len(texts[i].as_buffer()) if texts[i].is_valid else 0
        if size >= AT_ONCE:
            yield lo, i + 1, [t or "" for t in texts[lo: i + 1].to_pylist()]
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts), [t or "" for t in texts[lo:].to_pylist()]


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def sample_limit(wanted: int, there: int) -> int:
    """Greatest of the 64-bit hashes that ``wanted`` of ``there`` rows have, about; at least one in 2^64 rows, all where there are no more."""
    return (1 << 63) - 1 if there <= wanted else (wanted << 64) // there - (1 << 63)


def learn(documents: DataFrame, fit_docs: int = FIT_DOCS, evidence: bool = False) -> Model:
    """A model from the documents (doc_id, text, lang) it is given; with ``evidence`` also the languages' floors."""
    spark = ready(documents.sparkSession)
    labelled = documents.where(F.col("lang").isNotNull())
    # one row per language
    counts = dict(sorted((r["lang"], r["n"]) for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()))
    langs = list(counts)
    if not langs:
        return Model([], np.empty(0), np.empty(0), np.empty(0))
    limit = F.coalesce(*[F.when(F.col("lang") == l, sample_limit(fit_docs, n)) for l, n in counts.items()])
    sample = labelled.where(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))) <= limit).select("lang", "text")
    number = {l: i for i, l in enumerate(langs)}

    def count(batches):
        grams = np.zeros((len(langs), BUCKETS), np.int64)
        scripts = np.zeros((len(langs), OTHER + 1), np.int64)
        for batch in batches:
            for lo, hi, texts in slices(batch.column(1)):
                words = Words(texts)
                lang = np.array([number[l] for l in batch.column(0)[lo:hi].to_pylist()])[words.text] if len(words.start) else np.empty(0, int)
                grams += np.bincount(np.repeat(lang, words.size) * BUCKETS + words.bucket, minlength=grams.size).reshape(grams.shape)
                scripts += np.bincount(lang * (OTHER + 1) + words.script, words.size - 1, scripts.size).astype(np.int64).reshape(scripts.shape)
        both = np.concatenate([grams, scripts], 1)
        lang, key = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(key, pa.int32()), pa.array(both[lang, key], pa.int64())], ["lang", "key", "n"])

    def score(batches):
        total = model.grams.sum(1)
        for batch in batches:
            for lo, hi, texts in slices(batch.column(1)):
                lang = np.array([number[l] for l in batch.column(0)[lo:hi].to_pylist()])
                words, other = Words(texts), Words(reordered(texts))
                of = np.repeat(words.text, words.size)
                # without the text's own trigrams
                _, back, own = np.unique(of * BUCKETS + words.bucket, return_inverse=True, return_counts=True)
                left = model.grams[lang[of], words.bucket] - own[back.ravel()]
                rest = total[lang] - np.bincount(of, minlength=len(texts))
                inside = np.log((left + 0.5) / (rest[of] + 0.5 * BUCKETS))
                to = np.repeat(lang[other.text], other.size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(langs)), pa.int32()), *(pa.array(np.bincount(at, by, len(langs)).astype(float)) for at, by in (
                        (lang[of], inside), (lang[of], None), (to, model.log[other.bucket, to]), (to, None)))], ["lang", "inside", "n", "outside", "m"])

    # at most BUCKETS rows per language
    rows = sample.mapInArrow(tidy(count), "lang int, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros((len(langs), BUCKETS + OTHER + 1), np.int64)
    both[np.asarray(rows["lang"]), np.asarray(rows["key"])] = np.asarray(rows["n"])
    model = Model(langs, both[:, :BUCKETS], both[:, BUCKETS:], np.array(list(counts.values())))
    if evidence:
        model.grams = both[:, :BUCKETS]
        # one row per language
        for r in sample.mapInArrow(tidy(score), "lang int, inside double, n double, outside double, m double").groupBy("lang").agg(*[F.sum(c).alias(c) for c in ("inside", "n", "outside", "m")]).collect():
            if r["n"] and (inside := r["inside"] / r["n"]) > (outside := r["outside"] / r["m"]):
                model.floor[r["lang"]] = outside + FLOOR * (inside - outside)
        del model.grams  # not sent to the tasks of identify
    return model


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("lang", T.StringType())]))


EVIDENCE = T.StructType([T.StructField("letters", T.LongType()), T.StructField("known", T.DoubleType()), T.StructField("fit", T.DoubleType())])


def identify(documents: DataFrame, model: Model, evidence: bool = False) -> DataFrame:
    """``documents`` with lang_pred, score, spans and, if asked for, evidence (columns of these names are replaced).  No shuffle."""
    held = ready(documents.sparkSession).sparkContext.broadcast(model)  # BUCKETS numbers per language
    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)] + [T.StructField("evidence", EVIDENCE)] * evidence
    kept = documents.drop(*(f.name for f in more))
    schema = T.StructType([*kept.schema.fields, *more])
    kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())])),
             pa.struct([("letters", pa.int64()), ("known", pa.float64()), ("fit", pa.float64())])]

    def run(batches):
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                got = predict(held.value, texts, evidence)
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns), *(pa.array(g, k) for g, k in zip(got, kinds))],
                                                 [*batch.schema.names, *(f.name for f in more)])

    return kept.mapInArrow(tidy(run), schema)


