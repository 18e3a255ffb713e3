"""What the two vector searches share: usable rows, shards, and query blocks against index shards.

A search of n / 50 queries against n rows is a product by its contract.  It runs in blocks: an index shard is one row
(``SHARD`` vectors or so), a query block is one row, and every pair of them is one group of two rows.  Rows are
dealt to shards by the hash of their id, so equal or crowded vectors never gather in one shard.
"""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): rows that have an id and a vector of finite components (none null)."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))


def bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(payload: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(payload), allow_pickle=False) as got:
        return {k: got[k] for k in got.files}


def matrix(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors as rows; a shorter one ends in zeros."""
    out = np.zeros((len(lists), dim))
    at = 0
    for chunk in lists.chunks:
        sizes = np.diff(np.asarray(chunk.offsets))
        flat = np.asarray(chunk.flatten(), float)
        rows = np.repeat(np.arange(len(chunk)), sizes)
        out[at + rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        at += len(chunk)
    return out


def shards(rows: DataFrame, n: int, dim: int, build: Callable[[np.ndarray, np.ndarray], bytes]) -> DataFrame:
    """(shard, payload): ``build(ids, vectors)`` of every shard."""
    def run(key, group):
        order = np.argsort(ids := np.asarray(group["id"]), kind="stable")
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()),
                         "payload": pa.array([build(ids[order], matrix(group["v"], dim)[order])], pa.binary())})
    return rows.withColumn("shard", bucket(n)).groupBy("shard").applyInArrow(run, "shard int, payload binary")


def nearest(index: DataFrame, n_shards: int, queries: DataFrame, n_queries: int, dim: int, k: int, score: str,
            search: Callable[[bytes, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """query_id, rank, vec_id, score.  ``search(payload, ids, vectors)`` gives (query number, id, score) of a block's best in a shard."""
    blocks = max(1, -(-n_queries // QUERY_BLOCK))

    def block(key, group):
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                         "queries": pa.array([packed(ids=np.asarray(group["id"]), vectors=matrix(group["v"], dim))], pa.binary())})

    def pair(index_side, query_side):
        found = [pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], kind)})]
        for payload in index_side["payload"]:
            for q in query_side["queries"]:
                own = unpacked(q.as_py())
                at, ids, scores = search(payload.as_py(), own["ids"], own["vectors"])
                found.append(pa.table({"query_id": pa.array(own["ids"][at], pa.int64()), "vec_id": pa.array(ids, pa.int64()),
                                       "score": pa.array(scores).cast(kind)}))
        return pa.concat_tables(found)

    kind = {"long": pa.int64(), "double": pa.float64()}[score]
    asked = (queries.withColumn("block", bucket(blocks)).groupBy("block").applyInArrow(block, "block int, queries binary")
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))))
    there = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = there.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        pair, f"query_id long, vec_id long, score {score}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def counted(rows: DataFrame, asked: Column) -> tuple[int, int, int]:
    """Rows, queries, components of the longest vector."""
    got = rows.agg(F.count("*"), F.count_if(asked), F.max(F.size("v"))).first()
    return int(got[0]), int(got[1]), int(got[2] or 0)


def top(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` of every query number: score down, id up."""
    order = np.lexsort((ids, -scores, at))
    first = np.searchsorted(at[order], at[order])
    return order[np.arange(len(order)) - first < k]
