"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

A source's words, in shards dealt by the documents' hash and there in order of doc_id, are cut into blocks of
``BLOCK`` words (the last of a shard may be shorter).  Blocks go to sources by highest quotients of target / (2 taken + 1), a source's blocks then to its
shards in the same way (by their blocks), which gives whole quotas that add up exactly.  A shard takes every block
``quota // blocks`` times and, once more, the ``quota % blocks`` blocks that come first in a seeded permutation of
the block numbers.  So no document is taken more than twice and any part of the result can be computed again.

Targets.  Sources in code point order, null last, weigh 3, 1, 2, repeating; they share ``share`` times all words;
a target stops at ``most`` times the source's words, the excess is shared again by weight.

Only one row per source reaches the driver.  A shard's window holds about ``SHARD_WORDS`` words of all sources
(beyond ``MOST_SHARDS`` shards, more), whatever one source's size.

Cases.  Null text has no words and gets taken = 0.  Null source is a source.  Null doc_ids come first in their
shard.  Repeated rows stay rows, each with its own place.  Equal quotients go to the earlier source or shard.  An
empty table stays empty.  Other columns are kept by ``mixed`` and not read by ``mix``.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from fractions import Fraction
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import tidy, written

BLOCK = 64
SHARD_WORDS = 1 << 17
MOST_SHARDS = 1 << 16
WEIGHTS = (3, 1, 2)


def targets(sizes: list[int], weights: list[int], share: Fraction = Fraction(3, 2), most: int = 2) -> list[Fraction]:
    """Each source's words: by weight, none above ``most`` times its size."""
    out: list[Fraction | None] = [None] * len(sizes)
    left = share * sum(sizes)
    while True:
        open_ = [i for i, t in enumerate(out) if t is None]
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] > most * sizes[i] * total]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            return out
        for i in over:
            out[i] = Fraction(most * sizes[i])
        left -= sum(most * sizes[i] for i in over)


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients votes / (2 seats + 1), none above its cap; ties to the earlier.

    The quotients above a limit are counted by formula and the limit is halved in, so the work does not grow with
    the seats; the last few seats go one by one.
    """
    votes, caps = np.asarray(votes, float), np.asarray(caps, np.int64)
    caps = np.where(votes > 0, caps, 0)
    if seats <= 0 or seats >= caps.sum():
        return caps * (seats > 0)

    def above(limit):
        return np.minimum(caps, np.floor(votes / limit / 2 + 0.5)).astype(np.int64)

    lo, hi = 0.0, float(votes.max()) + 1.0  # above(hi) takes none, a limit near 0 every seat there is
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if above(mid).sum() > seats else (lo, mid)
    out = above(hi)
    heap = [(-votes[i] / (2 * out[i] + 1), i) for i in np.flatnonzero((votes > 0) & (out < caps))]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def permutation(n: int, seed: str) -> tuple[int, int]:
    """(a, b): block j of n comes at place (a * j + b) % n; a is prime to n and near the golden section of it."""
    number = int.from_bytes(hashlib.md5(seed.encode()).digest()[:8], "big")
    a = max(1, int(n * 0.6180339887498949) + number % max(1, n // 16)) % n or 1
    while gcd(a, n) != 1:
        a = a % n + 1
    return a, number // 65_537 % n


def with_sizes(documents: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, source, the text's hash and number of words, and the ``whole`` row as a struct."""
    rows = documents.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("_hash"),
                            F.struct(*(documents.columns if whole else ["text"])).alias("_row"))
    names = ["doc_id", "source", "_hash", *["_row"] * whole]
    schema = rows.select(*names).schema.add("size", "long")

    def run(batches):
        for batch in batches:
            text = batch.column("_row").field("text")
            sizes = [len(t.as_buffer().to_pybytes().split()) if t.is_valid else 0 for t in text]  # bytes split at 09-0D and 20
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sizes, pa.int64())], [*names, "size"])

    return rows.mapInArrow(tidy(run), schema)


def _quotas(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_shard").reset_index(drop=True)
        source, blocks = int(pdf["_src"].iloc[0]), pdf["_n"].to_numpy()
        quota = sainte_lague(blocks, int(pdf["quota"].iloc[0]), 2 * blocks)
        rows = []
        for shard, n, q in zip(pdf["_shard"].tolist(), blocks.tolist(), quota.tolist()):
            n = max(n, 1)
            rows.append((source, shard, n, q // n, q % n, *permutation(n, f"{seed}/{source}/{shard}")))
        return pd.DataFrame(rows, columns=["_src", "_shard", "_n", "_base", "_rest", "_a", "_b"])
    return run


def _planned(rows: DataFrame, sized: DataFrame, seed: int) -> DataFrame:
    """``rows`` (source, doc_id, _hash, size, ...) with their source's numbers, their shard's quota and their first word in it."""
    spark = sized.sparkSession
    # one row per source reaches the driver
    sizes = {r["source"]: int(r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = targets([sizes[s] for s in order], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(order))]) if order else []
    shards = max(1, min(MOST_SHARDS, sum(sizes.values()) // SHARD_WORDS))
    sources = spark.createDataFrame([(s, i, sizes[s], float(t)) for i, (s, t) in enumerate(zip(order, want))], "_source string, _src int, source_size long, target double")

    def numbered(df):
        return (df.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                .withColumn("_shard", F.pmod(F.xxhash64("doc_id", "_hash"), F.lit(shards)).cast("int")))

    words = numbered(sized).groupBy("_src", "_shard").agg(F.ceil(F.sum("size") / BLOCK).alias("_n"))
    blocks = {r["_src"]: int(r["n"]) for r in words.groupBy("_src").agg(F.sum("_n").alias("n")).collect()}
    # a source's target in blocks of its own mean size (the last of a shard is shorter)
    votes = np.array([float(t) * blocks[i] / max(1, sizes[s]) for i, (s, t) in enumerate(zip(order, want))])
    seats = sainte_lague(votes, round(votes.sum()), np.array([2 * blocks[i] for i in range(len(order))], np.int64)) if order else []
    quotas = (words.join(spark.createDataFrame([(i, int(q)) for i, q in enumerate(seats)], "_src int, quota long"), "_src")
              .groupBy("_src").applyInPandas(_quotas(seed), "_src int, _shard int, _n long, _base long, _rest long, _a long, _b long"))
    place = Window.partitionBy("_src", "_shard").orderBy("doc_id", "_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = numbered(rows).withColumn("_from", F.coalesce(F.sum("size").over(place), F.lit(0)))
    return placed.join(quotas, ["_src", "_shard"])


def _chosen(block):
    return F.pmod(block * F.col("_a") + F.col("_b"), F.col("_n")) < F.col("_rest")


def mix(documents: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target (its source's), taken: words the mix takes of the document, repeats counted."""
    sized = written(with_sizes(documents), "mix")
    rows = _planned(sized, sized, seed)
    last = F.col("_from") + F.col("size")
    overlap = F.aggregate(
        F.sequence(F.floor(F.col("_from") / BLOCK), F.floor((last - 1) / BLOCK)), F.lit(0).cast("long"),
        lambda acc, j: acc + F.when(_chosen(j), F.least(last, (j + 1) * BLOCK) - F.greatest(F.col("_from"), j * BLOCK)).otherwise(0))
    taken = F.when(F.col("size") == 0, F.lit(0).cast("long")).otherwise(F.col("_base") * F.col("size") + overlap)
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def taken_part(text: str, start: int, n: int, rest: int, a: int, b: int) -> str:
    """The words of the chosen blocks of a document whose first word is number ``start`` in its shard, as they stand in the text."""
    spans = [m.start() for m in _WORD.finditer(text)]
    out, size = [], len(spans)
    spans.append(len(text))
    for j in range(start // BLOCK, (start + size - 1) // BLOCK + 1 if size else 0):
        if (j * a + b) % n < rest:
            out.append(text[spans[max(0, j * BLOCK - start)]: spans[min(size, (j + 1) * BLOCK - start)]])
    return "".join(out)


def mixed(documents: DataFrame, seed: int = 7) -> DataFrame:
    """The mix as documents: a row for every whole repeat, and a row with the words taken once more, if any.

    Columns as in ``documents``; ``n_chars``, if there, follows the text.
    """
    sized = written(with_sizes(documents), "mix")
    rows = _planned(with_sizes(documents, whole=True), sized, seed).select("_row", "_from", "_n", "_base", "_rest", "_a", "_b")
    schema = documents.schema

    def run(batches):
        for batch in batches:
            fields = batch.schema.field("_row").type
            kept = pa.schema([fields.field(i) for i in range(fields.num_fields)])
            for i in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(i, 64).to_pylist():
                    row, text = r["_row"], r["_row"]["text"] or ""
                    if not _WORD.search(text):
                        continue
                    out += [row] * r["_base"]
                    if part := taken_part(text, r["_from"], r["_n"], r["_rest"], r["_a"], r["_b"]):
                        out.append(row | {"text": part} | ({"n_chars": len(part)} if "n_chars" in row else {}))
                if out:
                    yield pa.RecordBatch.from_pylist(out, kept)

    return rows.mapInArrow(tidy(run), schema)
