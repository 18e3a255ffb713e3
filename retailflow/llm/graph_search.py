"""Approximate nearest neighbours by cosine on robust-pruned directed graphs, one per shard.

Build.  Rows enter the graph in batches.  A greedy search from the entry node proposes neighbours for each row of the
batch; robust pruning takes the nearest proposal, drops those that it covers (``ALPHA`` times their distance to
it is at most their distance to the row) and goes on, so the ``DEGREE`` edges kept are near and point in different
directions.  Each edge is entered the other way too; nodes with too many are pruned again.  A second pass over all
rows, on the finished graph, repairs early choices.

Search.  Each shard's graph is searched with a beam for every query of a block at once; the best of all shards
are merged.  Scores are cosines in double precision of the original vectors.  Equal directions are one node that
lists its ids in order, so copies cost nothing and ties go to the smaller id.

Every row is indexed; nothing is sampled.  Recall on the test tables is in the README.

Cases.  Null ids, null, zero and empty vectors and vectors with null or non-finite components take no part.  A shorter
vector ends in zeros.  Repeated rows are candidates each; a repeated query is answered once.  Fewer candidates
than k: all that are found.  An empty table, or one without queries, gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .shared import ready, written

SHARD = 8192
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.2
EXPAND = 4
BATCH = 512


def _units(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x ** 2).sum(1))[:, None]).astype(np.float32)


def beam_search(graph: np.ndarray, x: np.ndarray, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best nodes met for every query and their cosines (-inf where there is none), best first."""
    n = len(q)
    nodes = np.full((n, beam), -1, np.int32)
    near = np.full((n, beam), -np.inf, np.float32)
    done = np.ones((n, beam), bool)
    seen = np.zeros((n, len(x) + 1), bool)
    seen[:, -1] = True  # the place of "no edge", which is node -1
    nodes[:, 0], near[:, 0], done[:, 0], seen[:, entry] = entry, q @ x[entry], False, True
    while True:
        live = np.flatnonzero(~done.all(1))
        if not len(live):
            return nodes, near
        # the first EXPAND nodes of each beam that are not expanded yet
        pick = np.argsort(done[live], 1, kind="stable")[:, :EXPAND]
        at = live[:, None]
        new = ~done[at, pick]
        done[at, pick] = True
        ahead = graph[np.where(new, nodes[at, pick], -1)].reshape(len(live), -1)  # the last row of the graph has no edges
        ahead[seen[at, ahead]] = -1
        seen[at, ahead] = True
        # a node proposed twice in one step counts once
        ahead.sort(1)
        ahead[:, 1:][ahead[:, 1:] == ahead[:, :-1]] = -1
        score = np.einsum("bd,brd->br", q[live], x[ahead])
        score[ahead < 0] = -np.inf
        all_near = np.concatenate([near[live], score], 1)
        best = np.argpartition(-all_near, beam - 1, 1)[:, :beam]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(all_near, best, 1), 1, kind="stable"), 1)
        near[live] = np.take_along_axis(all_near, best, 1)
        nodes[live] = np.take_along_axis(np.concatenate([nodes[live], ahead], 1), best, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ahead < 0], 1), best, 1)


def robust_prune(x: np.ndarray, at: np.ndarray, proposed: np.ndarray) -> np.ndarray:
    """Out-edges of the nodes ``at`` from their proposals (-1: none), -1 where fewer remain."""
    proposed = np.sort(proposed, 1)
    proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
    proposed[proposed == at[:, None]] = -1
    away = 2 - 2 * np.einsum("bd,bcd->bc", x[at], x[proposed])
    away[proposed < 0] = np.inf
    order = np.argsort(away, 1, kind="stable")[:, : 3 * DEGREE]
    proposed, away = np.take_along_axis(proposed, order, 1), np.take_along_axis(away, order, 1)
    own = x[proposed]
    between = 2 - 2 * np.matmul(own, own.transpose(0, 2, 1))
    out = np.full((len(at), DEGREE), -1, np.int32)
    alive = np.isfinite(away)
    line = np.arange(len(at))
    for slot in range(DEGREE):
        first = alive.argmax(1)
        has = alive[line, first]
        if not has.any():
            break
        out[has, slot] = proposed[has, first[has]]
        alive &= ~(has[:, None] & (ALPHA * between[line, first] <= away))
        alive[line, first] = False
    return out


def build_graph(x: np.ndarray) -> tuple[np.ndarray, int]:
    """(out-edges, entry node) over unit vectors; the last row of the edges belongs to no node and is empty."""
    n = len(x)
    graph = np.full((n + 1, DEGREE), -1, np.int32)
    entry = int((x @ x.mean(0)).argmax())
    rng = np.random.default_rng(n)
    for turn in range(2):
        order = rng.permutation(n).astype(np.int32)
        if turn == 0:
            order = np.concatenate([[entry], order[order != entry]]).astype(np.int32)
        lo = 0
        while lo < n:
            # first batches are small: a row only finds rows that are in the graph
            size = BATCH if turn else min(BATCH, max(1, lo))
            batch = order[lo: lo + size]
            lo += size
            found, _ = beam_search(graph, x, entry, x[batch], BUILD_BEAM)
            graph[batch] = robust_prune(x, batch, np.concatenate([found, graph[batch]], 1))
            _enter_back(graph, x, batch)
    return graph, entry


def _enter_back(graph: np.ndarray, x: np.ndarray, batch: np.ndarray) -> None:
    """Enter the batch's edges the other way."""
    heads = graph[batch].ravel()
    tails = np.repeat(batch, DEGREE)
    heads, tails = heads[heads >= 0], tails[heads >= 0]
    order = np.argsort(heads, kind="stable")
    heads, tails = heads[order], tails[order]
    nodes, start, counts = np.unique(heads, return_index=True, return_counts=True)
    for most in (DEGREE, int(counts.max(initial=0))):  # nodes met seldom and often: tables of fitting width
        some = (counts <= DEGREE) if most == DEGREE else (counts > DEGREE)
        if not some.any():
            continue
        at, take = nodes[some], start[some][:, None] + np.arange(most)[None]
        new = np.where(np.arange(most)[None] < counts[some][:, None], tails[np.minimum(take, len(tails) - 1)], -1)
        both = np.concatenate([graph[at], new.astype(np.int32)], 1)
        both.sort(1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        both = -np.sort(-both, 1)  # edges first
        crowded = both[:, DEGREE] >= 0
        graph[at[~crowded]] = both[~crowded, :DEGREE]
        if crowded.any():
            graph[at[crowded]] = robust_prune(x, at[crowded], both[crowded])


def build_shard(ids: np.ndarray, x: np.ndarray) -> bytes:
    unit = _units(x)
    nodes, first, node = np.unique(unit, axis=0, return_index=True, return_inverse=True)
    order = np.argsort(node.ravel(), kind="stable")  # ids ascending in each node
    graph, entry = build_graph(nodes)
    return V.packed(ids=ids[order], x=x[order], starts=np.searchsorted(node.ravel()[order], np.arange(len(nodes) + 1)),
                    nodes=nodes, graph=graph, entry=np.array([entry]))


def _own(ids: np.ndarray, starts: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Query number * nodes + node of every node that holds rows of the query's own id, ascending, and how many it holds."""
    n_nodes = len(starts) - 1
    node = np.repeat(np.arange(n_nodes), np.diff(starts))
    order = np.argsort(ids, kind="stable")
    lo, hi = (np.searchsorted(ids[order], asked, side) for side in ("left", "right"))
    size = hi - lo
    place = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.unique(np.repeat(np.arange(len(asked)), size) * n_nodes + node[order[place]], return_counts=True)


def search_shard(payload: bytes, asked: np.ndarray, q: np.ndarray, k: int):
    index = V.unpacked(payload)
    nodes, starts, ids, x = index["nodes"], index["starts"], index["ids"], index["x"]
    own, n_own = _own(ids, starts, asked)
    nodes_own = np.bincount(own // len(nodes), minlength=len(q))
    unit, beam = _units(q), max(SEARCH_BEAM, 2 * k)
    ats, found = [], []
    # queries whose id has several nodes: the beam has room for these besides
    for some in (np.flatnonzero(nodes_own <= 1), np.flatnonzero(nodes_own > 1)):
        if not len(some):
            continue
        wide = beam + (int(nodes_own[some].max()) if nodes_own[some[0]] > 1 else 0)
        node, near = beam_search(index["graph"], nodes, int(index["entry"][0]), unit[some], wide)
        row, place = np.nonzero(np.isfinite(near))
        ats.append(some[row])
        found.append(node[row, place])
    at, node = np.concatenate(ats), np.concatenate(found).astype(np.int64)
    # the query's own rows in each node; the best 4 k nodes that hold others
    key = at * len(nodes) + node
    place = np.minimum(np.searchsorted(own, key), max(0, len(own) - 1))
    mine = np.where(own[place] == key, n_own[place], 0) if len(own) else np.zeros(len(key), np.int64)
    others = starts[node + 1] - starts[node] - mine > 0
    at, node, mine = at[others], node[others], mine[others]
    order = np.argsort(at, kind="stable")
    first = np.searchsorted(at[order], at[order])
    order = order[np.arange(len(order)) - first < 4 * k]
    at, node, mine = at[order], node[order], mine[order]
    # the first k ids of a node are enough, besides the query's own
    sizes = np.minimum(starts[node + 1] - starts[node], k + mine)
    at = np.repeat(at, sizes)
    row = np.repeat(starts[node], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    other = ids[row] != asked[at]
    at, row = at[other], row[other]
    length = np.sqrt((q ** 2).sum(1))
    cosine = np.einsum("bd,bd->b", q[at], x[row]) / (length[at] * np.sqrt((x[row] ** 2).sum(1)))
    keep = V.top(at, ids[row], cosine, k)
    return at[keep], ids[row[keep]], cosine[keep]


def search(df: DataFrame, asked: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found by cosine of every row where ``asked`` holds (of column ``id``)."""
    ready(df.sparkSession)
    rows = V.usable(df, key, vector).where(F.exists("v", lambda x: x != 0))
    n, n_queries, dim = V.counted(rows, asked)
    if not n_queries:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n_shards = -(-n // SHARD)
    index = written(V.shards(rows, n_shards, dim, build_shard), "graph-index")
    queries = rows.where(asked).dropDuplicates()
    return V.nearest(index, n_shards, queries, n_queries, dim, k, "double", lambda payload, ids, q: search_shard(payload, ids, q, k))
