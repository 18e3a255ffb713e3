"""Spelling variants: words one edit apart, found by sorting the rotations of terminator-marked words.

A word w gets a terminator and is turned: the rotation that starts behind its character i reads ``rest, terminator, beginning``
and ends in that very character.  Without its last character it is a prefix which every word shares that differs from w at i alone, and the
whole rotation of the word that lacks the character.  So each rotation is two rows: (prefix, last character) and (whole rotation, nothing).  Rows
are range partitioned and sorted by prefix, a group is one run of equal prefixes, and one scan sees replacements (several last
characters) and insertions or deletions (nothing beside a last character).  A group holds one row per letter of the alphabet at most,
whatever the corpus holds, and is reported as one line per member (how many neighbours, the best of them), never as pairs.

A replacement is met in one group only.  A deletion inside a run of equal letters is met once per letter of the run; it is counted
at the run's first letter.

Forms: the near word of the largest count (ties: first in code-point order) if that is at least ``ratio`` times the word's own.  Counts grow by that
factor along a chain of forms, so it is short and has no circle; roots are found by doubling the links until none changes.

Cases.  Null and empty texts have no words; a null doc_id is an empty text in the hash.  Very long texts are cut into runs
inside the JVM as any other.  Repeated rows count each time.  Words are counted inside map tasks before any shuffle.  An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ready, tidy, written

#: Fixed by the contract: letters of a run, the divisor of planted misspellings.
LETTERS = "a-zÀ-ÿ"
MISSPELT = 199
END = "$"

MEMBER = "word string, n long, n_near long, near string, near_n long"


def runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word): every run of letters in whole texts, A-Z lower-cased, misspelt where the contract says so."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    run = F.explode(F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]+"), 0))
    key = F.coalesce(F.col(key).cast("string"), F.lit(""))
    h = F.crc32(F.concat_ws(":", "key", "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return (df.select(key.alias("key"), run.alias("run")).withColumn("h", h)
            .select(F.when(F.col("h") % MISSPELT == 0, cut).otherwise(F.col("run")).alias("word")))


def counted(words: DataFrame, least_length: int, least_n: int) -> DataFrame:
    """(word, n): the words of ``least_length`` code points that occur ``least_n`` times."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def rotations(vocabulary: DataFrame) -> DataFrame:
    """(prefix, last, first_of_run, word, n): both rows of every rotation."""
    length = F.length("word")

    def turned(i: Column) -> Column:  # the word from code point i on, the terminator, the word before i
        return F.concat(F.substr("word", i + 1), F.lit(END), F.substr("word", F.lit(1), i))

    def edited(i: Column) -> Column:  # as turned behind i, without the character i itself
        return F.concat(F.substr("word", i + 2), F.lit(END), F.substr("word", F.lit(1), i))

    def letter(i: Column) -> Column:
        return F.substr("word", i + 1, F.lit(1))
    whole = F.transform(F.sequence(F.lit(0), length), lambda i: F.struct(
        turned(i).alias("prefix"), F.lit("").alias("last"), F.lit(True).alias("first_of_run")))
    less = F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.struct(
        edited(i).alias("prefix"), letter(i).alias("last"), ((i == 0) | (letter(i) != F.substr("word", F.greatest(i, F.lit(1)), F.lit(1)))).alias("first_of_run")))
    return vocabulary.select("word", "n", F.explode(F.concat(whole, less)).alias("r")).select("r.*", "word", "n")


def _before(member: tuple) -> tuple:
    """Order of members: most frequent first, then by code points."""
    return -member[3], member[2]


def _group(members: list[tuple]) -> list[tuple]:
    """(word, n, n_near, near, near_n) of the members (last, first_of_run, word, n) of a run of equal prefixes."""
    lacking = next((m for m in members if not m[0]), None)  # the word without the edited character
    having = [m for m in members if m[0]]
    best = sorted(having, key=_before)[:2]
    out = []
    for m in having:
        near = [x for x in best if x is not m][:1] + ([lacking] if lacking and m[1] else [])
        if near:
            first = min(near, key=_before)
            out.append((m[2], m[3], len(having) - 1 + bool(lacking and m[1]), first[2], first[3]))
    deleted = [m for m in having if m[1]]
    if lacking and deleted:
        first = min(deleted, key=_before)
        out.append((lacking[2], lacking[3], len(deleted), first[2], first[3]))
    return out


def _scan(batches):
    """Runs of equal prefixes of a sorted part; the last run of a batch waits for the next."""
    prefix, members = None, []

    def table(lines):
        columns = list(zip(*lines)) or [()] * 5
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                               names=["word", "n", "n_near", "near", "near_n"])
    for batch in batches:
        lines = []
        for key, *member in zip(*(c.to_pylist() for c in batch.columns)):
            if key != prefix:
                if len(members) > 1:
                    lines += _group(members)
                prefix, members = key, []
            members.append(member)
        yield table(lines)
    if len(members) > 1:
        yield table(_group(members))


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): words with at least one word one edit apart, and the most frequent of these."""
    # one partition holds all rows of a prefix; sampling for the ranges reads the written vocabulary again
    ordered = rotations(vocabulary).repartitionByRange("prefix").sortWithinPartitions("prefix", "last")
    best = F.min(F.struct((-F.col("near_n")).alias("down"), "near"))
    return (ordered.mapInArrow(tidy(_scan), MEMBER).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.down")).alias("near_n")))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form reached.  Links double their reach each turn, until none changes."""
    links = written(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = written(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        if stepped.where("moved").isEmpty():
            return stepped.select("word", "root")
        links = stepped.drop("moved")


def variants(df: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6, least_n: int = 5, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    ready(df.sparkSession)
    vocabulary = written(counted(runs(df, key, text), least_length, least_n), "spelling-words")
    near = written(neighbours(vocabulary), "spelling-near")
    words = vocabulary.join(near, "word", "left")
    formed = words.where(F.col("near_n") >= ratio * F.col("n")).select("word", F.col("near").alias("form"), F.col("near_n").alias("form_n"))
    formed = written(formed, "spelling-forms")
    return (words.drop("near", "near_n").join(formed, "word", "left").join(roots(formed), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
