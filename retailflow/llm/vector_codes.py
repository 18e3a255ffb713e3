"""Vector codes: parts of whole-number vectors replaced by the index of their nearest codebook entry, found by equal-average search.

A component x becomes floor(``scale`` * x); vectors are cut into ``parts`` equal consecutive parts and each position has a
codebook of ``entries`` vectors.  By Cauchy and Schwarz the squared difference of two component sums, over the number of
components, is never above their squared distance.  So entries are sorted by their sum, a part starts at its own sum and goes
outward in both directions, and a direction ends where that quotient is strictly above the best distance found: at
equality an entry of a lower index could still tie.  Vectors of a batch are searched in blocks of neighbouring sums, so that a step
is one matrix product; every vector keeps its own end.  All distances are whole numbers, exact.

Codebooks are fitted on all rows: a round assigns every part inside map tasks, each task emits one sum per codebook component,
Spark adds them up, and ``entries`` times the vector's length sums come to the driver, whatever the number of rows.

Cases.  Vectors that are null or hold null or non-finite components are dropped.  Vectors shorter than the longest end in zeros, as
does every vector where the length is no multiple of ``parts``; empty vectors are all zeros.  Components are held within +-``limit``, the
largest at which a squared distance surely fits 64 bits (+-2^27 at 64 components); label sums beyond 64 bits end at the largest long.
Rows of null id take part, as seeds only after all others; equal ids are seeds in the order of their vectors; repeated rows
are rows of their own.  With fewer rows than entries the codebook is as long as there are rows.  Null labels are one label.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .shared import ready, tidy, written

BLOCK = 64  # vectors of neighbouring sums searched side by side
STEP = 16  # entries a direction takes at once
LONGEST = 2 ** 63 - 1


class Codebook:
    """Entries of one part position in the order of their sums."""

    def __init__(self, entries: np.ndarray):
        self.sums = entries.sum(1)
        self.order = np.argsort(self.sums, kind="stable")
        self.sums = self.sums[self.order]
        self.entries = entries[self.order]
        self.looked = 0  # distances computed, for tests

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (lowest of equals) and the squared distance of every row."""
        peak = max(int(np.abs(parts).max(initial=0)), int(np.abs(self.entries).max(initial=0)))
        kind = np.float64 if 4 * parts.shape[1] * peak ** 2 < 2 ** 53 else np.int64  # both exact; the first has fast products
        x, entries = parts.astype(kind), self.entries.astype(kind)
        squares, own = (entries ** 2).sum(1), (x ** 2).sum(1)
        sums = parts.sum(1)
        best, at = np.full(len(x), LONGEST, np.int64), np.full(len(x), len(entries), np.int64)
        by_sum = np.argsort(sums, kind="stable")
        for i in range(0, len(x), BLOCK):
            self._block(by_sum[i:i + BLOCK], x, entries, squares, own, sums, best, at)
        return at, best

    def _look(self, rows, lo, hi, x, entries, squares, own, best, at):
        if not len(rows) or lo >= hi:
            return
        self.looked += len(rows) * (hi - lo)
        d = (own[rows, None] + squares[None, lo:hi] - 2 * (x[rows] @ entries[lo:hi].T)).astype(np.int64)
        least = d.min(1)
        index = np.where(d == least[:, None], self.order[None, lo:hi], len(entries)).min(1)
        better = (least < best[rows]) | ((least == best[rows]) & (index < at[rows]))
        best[rows[better]], at[rows[better]] = least[better], index[better]

    def _block(self, rows, x, entries, squares, own, sums, best, at):
        n, dim = len(entries), x.shape[1]
        lo, hi = np.searchsorted(self.sums, [sums[rows[0]], sums[rows[-1]]])
        lo, hi = max(0, min(lo, n - 1) - 1), min(n, hi + 1)
        self._look(rows, lo, hi, x, entries, squares, own, best, at)
        left, right = rows, rows
        while True:
            left = left[self._open(sums[left] - self.sums[lo - 1], best[left], dim)] if lo else rows[:0]
            right = right[self._open(self.sums[hi] - sums[right], best[right], dim)] if hi < n else rows[:0]
            if not len(left) and not len(right):
                return
            down, up = max(0, lo - STEP), min(n, hi + STEP)
            self._look(left, down, lo, x, entries, squares, own, best, at)
            self._look(right, hi, up, x, entries, squares, own, best, at)
            lo, hi = down if len(left) else lo, up if len(right) else hi

    @staticmethod
    def _open(gap: np.ndarray, best: np.ndarray, dim: int) -> np.ndarray:
        """Rows for which gap^2 / dim does not strictly exceed the best distance (whole numbers: gap^2 // dim > best says the same)."""
        return ~((gap > 0) & ((gap * gap + dim - 1) // max(dim, 1) > best))


def limit(dim: int) -> int:
    return math.isqrt(2 ** 62 // max(dim, 1)) // 2


def whole_rows(df: DataFrame, key: str, vector: str, label: str, scale: int, parts: int) -> tuple[DataFrame, int]:
    """(id, label, v): kept rows with whole components, written once; components of a vector."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), x.alias("v")).where(F.coalesce(finite, F.lit(False)))
    dim = int(kept.agg(F.max(F.size("v"))).first()[0] or 0)
    dim = -(-dim // parts) * parts
    most = limit(dim)
    as_whole = F.transform("v", lambda c: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(c * scale))).cast("int"))
    return written(kept.withColumn("v", as_whole), "vector-codes-rows"), dim


def _cut(column: pa.ChunkedArray, dim: int, parts: int) -> list[np.ndarray]:
    return np.split(V.matrix(column, dim).astype(np.int64), parts, 1)


def _totals(rows: DataFrame, books: list[np.ndarray], dim: int) -> DataFrame:
    """(part, entry, at, total): sums by component, and the count at -1, added up inside tasks first."""
    def run(batches):
        search = [Codebook(b) for b in books]
        sums = np.zeros((len(books), len(books[0]), dim // len(books) + 1), np.int64)
        for batch in batches:
            for p, x in enumerate(_cut(pa.chunked_array([batch.column("v")]), dim, len(books))):
                near, _ = search[p].nearest(x)
                np.add.at(sums[p], near, np.concatenate([np.ones((len(x), 1), np.int64), x], 1))
        part, entry = np.nonzero(sums[:, :, 0])
        width = sums.shape[2]
        yield pa.record_batch({"part": np.repeat(part, width).astype(np.int32), "entry": np.repeat(entry, width).astype(np.int32),
                               "at": np.tile(np.arange(-1, width - 1, dtype=np.int32), len(part)), "total": sums[part, entry].ravel()})
    found = rows.select("v").mapInArrow(tidy(run), "part int, entry int, at int, total long")
    return found.groupBy("part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))


def fit(rows: DataFrame, dim: int, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """The codebook of each part position."""
    seeds = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()
    books = _cut(seeds["v"], dim, parts)
    for _ in range(rounds if seeds.num_rows else 0):
        sums = {(r.part, r.entry, r.at): int(r.total) for r in _totals(rows, books, dim).toLocalIterator()}
        for (part, entry, at), total in sums.items():
            if at >= 0:
                books[part][entry, at] = total // sums[part, entry, -1]
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()


def encode(rows: DataFrame, books: list[np.ndarray], dim: int) -> DataFrame:
    """id, label, code (binary, one byte a part), error of every row."""
    def run(batches):
        search = [Codebook(b) for b in books]
        for batch in batches:
            found = [search[p].nearest(x) for p, x in enumerate(_cut(pa.chunked_array([batch.column("v")]), dim, len(books)))]
            codes = np.stack([at for at, _ in found], 1).astype(np.uint8)
            yield pa.record_batch({"id": batch.column("id"), "label": batch.column("label"),
                                   "code": pa.array([c.tobytes() for c in codes], pa.binary()), "error": np.sum([d for _, d in found], 0, np.int64)})
    label = dict(rows.dtypes)["label"]
    return rows.mapInArrow(tidy(run), f"id long, label {label}, code binary, error long")


def decode(codes: DataFrame, books: list[np.ndarray], scale: int = 1024) -> DataFrame:
    """The columns of ``codes`` and ``vector``: the entries the code names, divided by ``scale``."""
    entries = [[[c / scale for c in e] for e in b.tolist()] for b in books]

    def part(p):
        byte = F.conv(F.hex(F.expr(f"substring(code, {p + 1}, 1)")), 16, 10).cast("int")
        return F.get(F.lit(entries[p]), byte)
    return codes.withColumn("vector", F.concat(*[part(p) for p in range(len(books))]))


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 1024, parts: int = 4,
             entries: int = 256, rounds: int = 4) -> DataFrame:
    """``key``, code (hex, two digits a part), error, label_error, codebooks_sha256 of every kept row."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte a part: 1 to 256 entries")
    spark = ready(df.sparkSession)
    rows, dim = whole_rows(df, key, vector, label, scale, parts)
    books = fit(rows, dim, parts, entries, rounds)
    if not len(books[0]):
        return spark.createDataFrame([], f"{key} long, code string, error long, label_error long, codebooks_sha256 string")
    coded = written(encode(rows, books, dim), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(20,0)"))
    labels = coded.groupBy("label").agg(F.least(total, F.lit(LONGEST).cast("decimal(30,0)")).cast("long").alias("label_error"))
    a, b = coded.alias("a"), labels.alias("b")
    return (a.join(b, F.col("a.label").eqNullSafe(F.col("b.label")))
            .select(F.col("id").alias(key), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
