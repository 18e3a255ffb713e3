"""Vector searches beside brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import SF, as_rows, needs_tables
from retailflow.llm import graph_search, queries, topk_search
from retailflow.llm import vectors as V

NAN, INF = float("nan"), float("inf")


def awkward():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist(), 1) for i in range(90)]
    rows += [(200 + i, rows[0][1], 1) for i in range(40)]  # copies: ties
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 6, 1), (303, [NAN] + [1.0] * 5, 1), (304, [INF] + [1.0] * 5, 1), (305, [None] + [1.0] * 5, 1),
             (306, [1.0, 2.0], 1), (None, [1.0] * 6, 1), (20, rows[20][1], 1), (400, [1e-30] * 6, 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)


def brute(rows, mod, k, cosine):
    use = [(i, np.array((list(v) + [0.0] * 6)[:6])) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if cosine:
        use = [(i, v) for i, v in use if v.any()]
    else:
        use = [(i, np.floor(64 * v)) for i, v in use]
    out = set()
    for i, v in use:
        if i % mod == 0:
            scores = [(float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))) if cosine else int(v @ w), j) for j, w in use if j != i]
            for r, (s, j) in enumerate(sorted(scores, key=lambda x: (-round(x[0], 12), x[1]))[:k], 1):
                out.add((i, r, j, round(s, 9)))
    return out


def got(df):
    return {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect()}


@pytest.fixture(autouse=True)
def small_shards(monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD", 40)
    monkeypatch.setattr(topk_search, "ANNULUS", 8)
    monkeypatch.setattr(graph_search, "SHARD", 60)
    monkeypatch.setattr(V, "QUERY_BLOCK", 4)


def test_topk_of_awkward_rows(spark):
    assert got(topk_search.search(frame(spark, awkward()), F.col("id") % 20 == 0, 20)) == brute(awkward(), 20, 20, False)


def test_neighbours_of_awkward_rows(spark):
    """Shards of this size are searched wholly by the beam, so even the ties must be right."""
    assert got(graph_search.search(frame(spark, awkward()), F.col("id") % 20 == 0, 5)) == brute(awkward(), 20, 5, True)


def test_repeated_ids_take_no_place_in_an_annulus(monkeypatch):
    """One annulus of 200 rows; the query's id three times, with the largest products."""
    monkeypatch.setattr(topk_search, "ANNULUS", 256)
    rng = np.random.default_rng(7)
    x = np.floor(64 * (rng.normal(size=(200, 6)) * 0.1 + 1))
    ids = np.arange(200)
    ids[[20, 21, 22]] = 20
    x[[20, 21, 22]] = 200
    square = float((x ** 2).sum(1).max())
    pivots = topk_search._raised(x[:1], square)
    at, found, scores = topk_search.search_shard(topk_search.build_shard(ids, x, pivots, square), np.array([20]), x[20:21], pivots, square, 20)
    best = sorted((-int(x[20] @ v), i) for i, v in zip(ids.tolist(), x) if i != 20)[:20]
    assert len(at) == 20 and sorted(zip((-scores).tolist(), found.tolist())) == best


def test_repeated_ids_take_no_place_among_copies():
    """30 copies of one vector, the query's id eight of them and the smallest; another id has 300 nodes of its own beside it."""
    rng = np.random.default_rng(8)
    v, w = rng.normal(size=6), rng.normal(size=6)
    near = w + rng.normal(size=(300, 6)) * 1e-3
    ids = np.concatenate([[20] * 8, 100 + np.arange(22), [40] * 300, 200 + np.arange(50)])
    x = np.concatenate([np.repeat(v[None], 30, 0), near, w + rng.normal(size=(50, 6)) * 0.5])
    at, found, scores = graph_search.search_shard(graph_search.build_shard(ids, x), np.array([20, 40]), np.stack([v, w]), 5)
    assert found[at == 0].tolist() == [100, 101, 102, 103, 104] and np.allclose(scores[at == 0], 1)
    assert len(found[at == 1]) == 5 and 40 not in found[at == 1]


@pytest.mark.parametrize("search", [topk_search.search, graph_search.search])
def test_few_or_no_rows(spark, search):
    asked = F.col("id") % 20 == 0
    assert search(frame(spark, []), asked, 5).collect() == []
    assert search(frame(spark, [(1, [1.0], 1), (2, [2.0], 1)]), asked, 5).collect() == []
    assert search(frame(spark, [(20, [1.0], 1)]), asked, 5).collect() == []
    assert [(r.query_id, r["rank"], r.vec_id) for r in search(frame(spark, [(20, [1.0], 1), (1, [1.0], 1)]), asked, 5).collect()] == [(20, 1, 1)]


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2 ** 20 + i), float(3 * i - 2 ** 21)], 1) for i in range(60)]
    want = {}
    for i in range(0, 60, 20):
        q = [int(np.floor(64 * x)) for x in rows[i][1]]
        scores = [(sum(a * int(np.floor(64 * x)) for a, x in zip(q, v)), j) for j, v, _ in rows if j != i]
        want[i] = sorted(scores, key=lambda x: (-x[0], x[1]))[:20]
    for r in topk_search.search(frame(spark, rows), F.col("id") % 20 == 0, 20).collect():
        assert want[r.query_id][r["rank"] - 1] == (r.score, r.vec_id)


def test_bounds_stop_at_far_annuli():
    """With separate clusters the k best are found without a look at most annuli, and are the right ones."""
    rng = np.random.default_rng(2)
    x = np.floor(64 * (rng.normal(size=(400, 8)) * 0.05 + np.repeat(np.eye(8) * 5, 50, 0)))
    square = float((x ** 2).sum(1).max())
    pivots = topk_search._pivots(topk_search._raised(x, square), 8)
    payload = topk_search.build_shard(np.arange(400), x, pivots, square)
    looked = []
    whole = topk_search._scores
    try:
        topk_search._scores = lambda q, y: looked.append(len(q) * len(y)) or whole(q, y)
        at, ids, scores = topk_search.search_shard(payload, np.arange(0, 400, 50), x[::50], pivots, square, 5)
    finally:
        topk_search._scores = whole
    for n, q in enumerate(range(0, 400, 50)):
        best = sorted(((-int(x[q] @ x[j]), j) for j in range(400) if j != q))[:5]
        assert sorted(zip((-scores[at == n]).tolist(), ids[at == n].tolist())) == best
    assert sum(looked) < 8 * 400 / 2


def test_graph_recall_on_a_large_shard():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 32))
    payload = graph_search.build_shard(np.arange(3000), x)
    at, ids, _ = graph_search.search_shard(payload, np.arange(100), x[:100], 5)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit[:100] @ unit.T
    near[np.arange(100), np.arange(100)] = -9
    best = np.argsort(-near, 1)[:, :5]
    assert sum(len(set(best[i]) & set(ids[at == i])) for i in range(100)) >= 0.9 * 500
    graph = V.unpacked(payload)["graph"]
    assert graph.shape[1] == graph_search.DEGREE and (graph[:-1] != np.arange(3000)[:, None]).all()


@needs_tables
def test_op3_recall_and_scores(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = n = 0
    found = queries.op3(spark, SF).collect()
    for q in ids[ids % 50 == 0]:
        near = unit @ unit[ids == q][0]
        near[ids == q] = -9
        best = ids[np.lexsort((ids, -near))[:5]].tolist()
        mine = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and all(abs(near[ids == m[1]][0] - m[2]) < 1e-12 for m in mine)
        hit, n = hit + len({m[1] for m in mine} & set(best)), n + len(best)
    assert hit >= 0.9 * n


@needs_tables
def test_op8(spark):
    from oracle import compare, connect
    assert compare(queries.op8(spark, SF), connect(SF), queries.SQL["op8_pivot_topk"]) is None
    assert len(as_rows(queries.op8(spark, SF))) > 0
