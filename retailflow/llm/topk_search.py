"""Exact top-k search by inner product with a pivot-distance index.

Vectors become whole numbers, floor(``scale`` * x).  One more component, sqrt(M^2 - |x|^2) with M the greatest
norm, gives all the same norm, so the largest inner product is the smallest Euclidean distance.  The index keys a
vector by its nearest pivot and the distance to it, and holds each shard's vectors in that order: a run of rows is
an annulus of its pivot.  A query starts at the annuli that hold its own distance and expands from there; for an
annulus [lo, hi] of pivot p nothing is nearer than max(lo - d(q, p), d(q, p) - hi), so it stops at annuli whose bound
is above its k-th distance.  Scores are whole and exact.

Pivots come from a sample of ``PIVOT_SAMPLE`` rows (a bound on the fit only; every row is indexed).

Cases.  Null ids, null vectors and vectors with null or non-finite components take no part.  A shorter vector ends in
zeros.  Ties go to the smaller id; repeated rows of one id are one query each and all are candidates of others, a
repeated query (same id and vector) is answered once.  With fewer candidates than k all are returned; an empty
table, or one without queries, gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .shared import ready, written

SHARD = 4096
ANNULUS = 256
PIVOTS = 16
PIVOT_SAMPLE = 2048


def _pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Far-apart rows of the sample: each next pivot is the row farthest from those before."""
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)):
        at = int(gap.argmax())
        if gap[at] <= 0:
            break
        chosen.append(at)
        gap = np.minimum(gap, ((sample - sample[at]) ** 2).sum(1))
    return sample[chosen]


def _raised(x: np.ndarray, square: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0, square - (x ** 2).sum(1)))[:, None]], 1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None] - 2 * a @ b.T))


def build_shard(ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, square: float) -> bytes:
    d = _distances(_raised(x, square), pivots)
    near = d.argmin(1)
    far = d[np.arange(len(x)), near]
    order = np.lexsort((ids, far, near))
    return V.packed(ids=ids[order], x=x[order].astype(np.int64), pivot=near[order], far=far[order])


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2 ** 53:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    return q @ x.T


def search_shard(payload: bytes, asked: np.ndarray, q: np.ndarray, pivots: np.ndarray, square: float, k: int):
    index = V.unpacked(payload)
    ids, x, pivot, far = index["ids"], index["x"], index["pivot"], index["far"]
    whole = q.astype(np.int64)
    to = _distances(np.concatenate([q, np.zeros((len(q), 1))], 1), pivots)
    norm = (q ** 2).sum(1)
    # annuli: runs of at most ANNULUS rows of one pivot
    starts = [i for p in np.unique(pivot) for i in range(*np.searchsorted(pivot, [p, p + 1]), ANNULUS)]
    stops = [min(i + ANNULUS, int(np.searchsorted(pivot, pivot[i], "right"))) for i in starts]
    bounds = np.stack([np.maximum(0, np.maximum(far[lo] - to[:, pivot[lo]], to[:, pivot[lo]] - far[hi - 1])) for lo, hi in zip(starts, stops)], 1)
    at, got, scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    limit = np.full(len(q), np.inf)  # distance of the k-th best so far
    slack = 1e-6 * (1 + np.sqrt(norm + square))
    for a in np.argsort(bounds.mean(0), kind="stable"):
        active = np.flatnonzero(bounds[:, a] <= limit + slack)
        if not len(active):
            continue
        rows = slice(starts[a], stops[a])
        s = _scores(whole[active], x[rows])
        least = np.where(np.isinf(limit[active]), np.iinfo(np.int64).min, np.floor((norm[active] + square - limit[active] ** 2) / 2 - 1e-3 * (1 + norm[active])))
        other = asked[active][:, None] != ids[rows][None]
        if s.shape[1] > k:  # rows of the query's own id, however many, take no place among the best
            least = np.maximum(least, np.partition(np.where(other, s, np.iinfo(np.int64).min), -k, 1)[:, -k])
        i, j = np.nonzero((s >= least[:, None]) & other)
        at, got, scores = np.concatenate([at, active[i]]), np.concatenate([got, ids[rows][j]]), np.concatenate([scores, s[i, j]])
        keep = V.top(at, got, scores, k)
        at, got, scores = at[keep], got[keep], scores[keep]
        full = np.bincount(at, minlength=len(q)) >= k
        last = np.searchsorted(at, np.arange(len(q)), "right") - 1
        limit[full] = np.sqrt(np.maximum(0, norm[full] + square - 2 * scores[last[full]]))
    return at, got, scores


def search(df: DataFrame, asked: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest whole inner products of every row where ``asked`` holds (of column ``id``)."""
    ready(df.sparkSession)
    rows = V.usable(df, key, vector).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    rows = written(rows, "topk-rows")
    n, n_queries, dim = V.counted(rows, asked)
    if not n_queries:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    square = float(rows.select(F.max(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))).first()[0])
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).toArrow()
    pivots = _pivots(_raised(V.matrix(sample["v"], dim), square), PIVOTS)
    n_shards = -(-n // SHARD)
    index = written(V.shards(rows, n_shards, dim, lambda ids, x: build_shard(ids, x, pivots, square)), "topk-index")
    queries = rows.where(asked).dropDuplicates()
    return V.nearest(index, n_shards, queries, n_queries, dim, k, "long",
                     lambda payload, ids, q: search_shard(payload, ids, q, pivots, square, k))
