"""Apportionment, mixing and lookup-table sharding."""

import heapq
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import gcd

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_data import SF, as_rows, empty, messy, messy_rows, needs_tables
from retailflow.llm import mixing, queries, sharding


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 12)), min_size=1, max_size=8), st.integers(0, 60))
@settings(max_examples=300, deadline=None)
def test_seats_go_to_the_highest_quotients(parties, seats):
    votes, caps = [v for v, _ in parties], [c for _, c in parties]
    want, heap = [0] * len(votes), [(-v / 1, i) for i, v in enumerate(votes) if v and caps[i]]
    heapq.heapify(heap)
    for _ in range(seats):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        want[i] += 1
        if want[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * want[i] + 1), i))
    assert mixing.sainte_lague(np.array(votes), seats, np.array(caps)).tolist() == want


def test_targets():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == [200, Fraction(250, 3), Fraction(500, 3)]
    assert mixing.targets([10, 1000], [3, 1]) == [20, 1495]
    assert mixing.targets([0, 6], [3, 1]) == [0, 9]
    assert mixing.targets([0], [3]) == [0]


@given(st.integers(1, 3000), st.text(max_size=5))
@settings(max_examples=100, deadline=None)
def test_permutations(n, seed):
    a, b = mixing.permutation(n, seed)
    assert gcd(a, n) == 1 and sorted((a * j + b) % n for j in range(n)) == list(range(n))


def check_mix(rows, got):
    """``rows`` (doc_id, text, source), ``got`` (doc_id, size, source_size, target, taken)."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, mixing.targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))])))
    expected = Counter((d, len(words(t)), sizes[s], float(want[s])) for d, t, s in rows)
    assert Counter((r.doc_id, r.size, r.source_size, r.target) for r in got) == expected
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    of = {(d, len(words(t))): s for d, t, s in rows}
    taken = Counter()
    for r in got:
        taken[of[r.doc_id, r.size]] += r.taken
    for s in order:
        assert abs(taken[s] - want[s]) <= max(2 * mixing.BLOCK, 0.02 * want[s]), (s, taken[s], float(want[s]))


def test_mix_of_awkward_rows(spark):
    rows = [(r[0], r[1], r[3]) for r in messy_rows()]
    got = mixing.mix(messy(spark)).collect()
    check_mix(rows, got)
    assert as_rows(mixing.mix(messy(spark).repartition(7))) == sorted((tuple(r) for r in got), key=repr)
    assert mixing.mix(empty(spark)).collect() == []


def test_mix_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 3000)
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 200))), rng.choice(["x"] * 5 + ["y", "z", None])) for i in range(600)]
    check_mix(rows, mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_mixed_texts_hold_the_words_taken(spark):
    docs = messy(spark).where("doc_id <> 7")
    taken = {(r.doc_id, r.size): r.taken for r in mixing.mix(docs).collect()}
    found, out = defaultdict(int), mixing.mixed(docs)
    assert out.columns == docs.columns
    by_id = {r[0]: r[1] for r in messy_rows()}
    for r in out.collect():
        assert r.text in by_id[r.doc_id] or words(r.text) and set(words(r.text)) <= set(words(by_id[r.doc_id]))
        found[r.doc_id] += len(words(r.text))
    for (doc_id, _), n in taken.items():
        if doc_id is not None:
            assert found[doc_id] == n
    assert mixing.mixed(empty(spark)).collect() == []


@needs_tables
def test_op6(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    check_mix(rows, queries.op6(spark, SF).collect())


# Sharding

def plain_fill(names, slots):
    order = [[(sharding._number(f"offset/{s}") + j * (sharding._number(f"skip/{s}") % (slots - 1) + 1)) % slots for j in range(slots)] for s in names]
    owner, place = [None] * slots, [0] * len(names)
    while None in owner:
        for i in range(len(names)):
            while place[i] < slots and owner[order[i][place[i]]] is not None:
                place[i] += 1
            if place[i] < slots:
                owner[order[i][place[i]]] = i
    return owner


def test_table_is_filled_in_turns():
    names = [f"s{i}" for i in range(7)]
    assert sharding.fill(names, slots=211).tolist() == plain_fill(names, 211)
    counts = np.bincount(sharding.fill(names))
    assert counts.max() - counts.min() <= 1


def test_a_shard_more_moves_few_slots_and_weights_count():
    before, after = sharding.fill([f"s{i}" for i in range(20)]), sharding.fill([f"s{i}" for i in range(21)])
    moved = (before != after) & (after != 20)
    assert moved.mean() < 0.1
    counts = np.bincount(sharding.fill(["a", "b"], [3.0, 1.0]))
    assert abs(counts[0] / counts[1] - 3) < 0.01


@pytest.mark.parametrize("shards, weights, slots", [([], None, 7), (["a"], None, 8), (["a"], [0.0], 7)])
def test_wrong_tables(shards, weights, slots):
    with pytest.raises(ValueError):
        sharding.fill(shards, weights, slots)


def test_place_of_awkward_rows(spark):
    import hashlib
    owner = sharding.fill(queries.SHARDS)
    out = sharding.place(messy(spark), F.col("doc_id"), queries.SHARDS)
    assert out.columns == [*messy(spark).columns, "slot", "shard"] and out.count() == len(messy_rows())
    for r in out.collect():
        slot = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, queries.SHARDS[owner[slot]])
    assert sharding.place(empty(spark), F.col("doc_id"), queries.SHARDS).collect() == []


@needs_tables
def test_op5(spark):
    got = queries.op5(spark, SF)
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert len(got.collect()) == spark.read.parquet(f"{SF}/documents.parquet").count()
