"""Suffix-array and MinHash deduplication beside brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from llm_data import BASE, PASSAGE, SCHEMA, SF, as_rows, empty, messy, messy_rows, needs_tables, prose, texts_of
from oracle import compare, connect
from retailflow.llm import near_dup, queries, suffix_dedup
from retailflow.llm.components import components
from retailflow.llm.shingles import shingle_set, words


# Suffix arrays

@pytest.mark.parametrize("seed", range(60))
def test_suffixes_in_order_with_their_common_prefixes(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab\0c" if seed % 2 else b"ab") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 6))] + [b"a" * 50] * (seed % 3)
    depth = rng.choice([8, 9, 16, 20])
    text, ends = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([len(s) for s in strings])
    start = np.concatenate([[0], ends[:-1]])
    wanted = {int(b) + i: s[i: i + depth] for b, s in zip(start, strings) for i in range(len(s) - depth + 1) if rng.random() < 0.7}
    if not wanted:
        return
    order, common = suffix_dedup.suffix_order(text, ends, np.array(list(wanted)), depth)
    keys = [wanted[i] for i in order.tolist()]
    assert sorted(order.tolist()) == sorted(wanted) and keys == sorted(keys)
    for a, b, n in zip(keys, keys[1:], common[1:].tolist()):
        assert n == next((i for i in range(depth) if a[i] != b[i]), depth)


def test_every_window_has_one_anchor_and_equal_windows_the_same():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abcdefgh ") for _ in range(900)) for _ in range(3)]
    texts.append(texts[0][100:600])
    ends = np.cumsum([len(t) for t in texts])
    first, last, gram = suffix_dedup.anchors(np.frombuffer(b"".join(texts), np.uint8), ends)
    seen, joined = {}, b"".join(texts)
    for a, b, g in zip(first.tolist(), last.tolist(), gram.tolist()):
        for i in range(a, b + 1):
            assert seen.setdefault(joined[i: i + 200], g) == g
    assert sum((last - first + 1).tolist()) == sum(len(t) - 199 for t in texts)


def test_texts_in_pieces_hold_every_window_once(monkeypatch):
    import pyarrow as pa
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcde ") for _ in range(n)) for n in (5000, 150, 0, 1203, 200, 1199)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(7), pa.int64()), pa.array([0] * 7, pa.int32())], ["text", "_id", "_hash"])

    def windows():
        out = {}
        for got in suffix_dedup._found([batch]):
            for r in got.to_pylist():
                for i in range(r["lo"], r["lo"] + r["more"] + 1):
                    assert (r["_id"], i) not in out
                    out[r["_id"], i] = r["gram"]
        return out
    whole = windows()
    monkeypatch.setattr(suffix_dedup, "AT_ONCE", 1000)
    assert windows() == whole and len(whole) == sum(max(0, len(t or "") - 199) for t in texts)


def brute_repeats(rows):
    count = {}
    for _, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - 199):
            count[raw[i: i + 200]] = count.get(raw[i: i + 200], 0) + 1
    for doc_id, text in rows:
        raw, runs = (text or "").encode(), []
        for i in range(len(raw) - 199):
            if count[raw[i: i + 200]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + 200
                else:
                    runs.append([i, i + 200])
        kept = b"".join(raw[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), len(raw)]))
        yield doc_id, len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest()


def test_repeats_of_awkward_rows(spark):
    assert as_rows(suffix_dedup.repeats(messy(spark))) == sorted(brute_repeats([(r[0], r[1]) for r in messy_rows()]), key=repr)
    assert suffix_dedup.repeats(empty(spark)).collect() == []


def test_repeats_with_crowded_anchors(spark, monkeypatch):
    """Anchors of more contexts than CROWD are split; the result is the same."""
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    rows = [(i, prose(20) + " " + PASSAGE + " " + prose(20)) for i in range(30)] + [(99, prose(2000)), (100, "x" * 5000), (101, BASE + BASE)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(suffix_dedup.repeats(df)) == sorted(brute_repeats(rows), key=repr)


@pytest.mark.parametrize("crowd", [3, 20])
def test_no_sort_holds_more_of_an_anchor_than_crowd(spark, monkeypatch, crowd):
    """A passage's tail before different texts: its last window is in every context, which sends all of them to one part."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rows = [(i, prose(20) + " " + PASSAGE + " " + prose(20)) for i in range(30)] + [(99, BASE + BASE)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sort = suffix_dedup._sort

    def counted(batches):
        count = {}
        for batch in batches:
            for gram in batch.column("gram").to_pylist():
                count[gram] = count.get(gram, 0) + 1
                assert count[gram] <= crowd
            yield batch
    monkeypatch.setattr(suffix_dedup, "_sort", lambda batches: sort(counted(batches)))
    assert as_rows(suffix_dedup.repeats(df)) == sorted(brute_repeats(rows), key=repr)


@pytest.mark.parametrize("crowd", [3, 4096])
def test_many_equal_rows(spark, monkeypatch, crowd):
    """Thousands of rows of one id (none) and text cost what one costs; near crowds they count once."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    text = prose(300)
    few = [(i, prose(20) + " " + text[:900] + " " + prose(20)) for i in range(12)] + [(50, BASE + " end"), (51, prose(100))]
    df = spark.createDataFrame(few, "doc_id long, text string").union(spark.range(10_000).select(F.lit(None).cast("long"), F.lit(text)))
    got = suffix_dedup.repeats(df)
    want = dict((r[0], r) for r in brute_repeats([*few, (None, text), (None, text)]))
    assert got.groupBy(*got.columns).count().filter("doc_id IS NULL").collect() == [(*want[None], 10_000)]
    assert as_rows(got.filter("doc_id IS NOT NULL")) == sorted((r for i, r in want.items() if i is not None), key=repr)


def test_crowded_windows_beside_unique_strings(spark, monkeypatch):
    """Contexts that agree far to one side, or to both, or only in their middle; windows are cut at either end of a text."""
    monkeypatch.setattr(suffix_dedup, "CROWD", 2)
    core = PASSAGE[:260]
    rows = [(i, core[i % 40:] + chr(97 + i % 5) * (i % 7) + prose(5 + i % 30)) for i in range(40)]
    rows += [(100 + i, prose(i % 30) + core[: 200 + i]) for i in range(40)] + [(200 + i, core[30:230 + i]) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(suffix_dedup.repeats(df)) == sorted(brute_repeats(rows), key=repr)


def test_texts_without_ids_are_known_by_the_whole_hash(spark):
    """Two texts without an id whose hashes agree in 32 bits; only one repeats anything."""
    def low(text):  # Spark's xxhash64 % 2^31, with the sign of the hash
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        return h % (1 << 31) if h < 1 << 63 else -(((1 << 64) - h) % (1 << 31))
    clean = " ".join(f"{i * i * i}" for i in range(100))
    met = {low(t): t for t in (f"{PASSAGE} {i}" for i in range(300_000))}
    other, text = next((met[h], t) for t in (f"{i} {clean}" for i in range(300_000)) if (h := low(t)) in met)
    rows = [(None, other), (None, text), (1, "once more " + PASSAGE)]
    got = as_rows(suffix_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted(brute_repeats(rows), key=repr) and sum(r[2] == 0 for r in got) == 1


def test_cleaned_keeps_rows_and_other_columns(spark):
    got = suffix_dedup.cleaned(messy(spark)).drop("n_chars")
    assert got.columns == [c for c in messy(spark).columns if c != "n_chars"] and got.count() == len(messy_rows())
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] is None and texts[6] == "" and PASSAGE not in texts[9] and texts[4] == "word"
    assert suffix_dedup.cleaned(empty(spark)).collect() == []


@needs_tables
def test_op2(spark):
    got = queries.op2(spark, SF).persist()
    assert as_rows(got) == sorted(brute_repeats(texts_of(spark)), key=repr)
    assert compare(got, connect(SF), queries.SQL["op2_suffix_dedup"]) is None


# Near-duplicates

def brute_set(text, n):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    n = min(n, len(w))
    return frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute_near(rows, n, percent=80):
    sets = [brute_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), (c := least.get(find(i)) if sets[i] else d), d == c) for i, (d, _) in enumerate(rows)]


def result(df):
    return as_rows(df.select("doc_id", "n_shingles", "component_id", "kept"))


def test_word_hashes_and_sets():
    assert len(words(b" \t")) == 0 and len(words(b"a\x0bb\x00c d")) == 3
    assert words(b"AbC")[0] == words(b"abc")[0] != words("Ábc".encode())[0]
    assert words("É".encode())[0] != words("é".encode())[0]  # only A-Z are lowered
    for text in ("one", "one two", "one two three one two three", "", "a b a b a b"):
        assert len(shingle_set(text.encode(), 2)) == len(brute_set(text, 2))
    assert len(words(b"x" * 5000 + b" y")) == 2


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    all_ = rng.integers(0, 1 << 63, 3000, np.uint64)
    a, b = all_[:2000], all_[500:2500]  # 1500 of 2500
    x, y = (np.array(near_dup.planes(near_dup.minima(s))).view(np.uint64) for s in (a, b))
    differ = sum(int((x[i] ^ y[i]) | (x[i + 2] ^ y[i + 2])).bit_count() for i in range(2))
    assert abs(((1 - differ / near_dup.HASHES) - 0.25) / 0.75 - 0.6) < 0.2
    assert 0.54 < near_dup.least_estimate(80) < 0.56


def test_shared_counts_and_connecting_links():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    assert near_dup.shared_counts(sets[:10], sets[10:]).tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[10:]] for a in sets[:10]]
    for density in (0.01, 0.05, 0.3, 1.0):
        linked = rng.random((40, 50)) < density

        def groups(edges):
            parent = list(range(90))

            def find(i):
                while parent[i] != i:
                    i = parent[i]
                return i
            for i, j in edges:
                parent[find(i)] = find(40 + j)
            return [[find(i) == find(j) for j in range(90)] for i in range(90)]
        some = near_dup.connecting(linked)
        assert all(linked[i, j] for i, j in some) and len(some) < 90 and groups(some) == groups(zip(*np.nonzero(linked)))


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_of_awkward_rows(spark, n):
    assert result(near_dup.near_duplicates(messy(spark), n)) == sorted(brute_near([(r[0], r[1]) for r in messy_rows()], n), key=repr)


@pytest.mark.parametrize("part", [1024, 5])
def test_near_duplicates_in_chains_and_crowds(spark, monkeypatch, part):
    """A chain whose ends are unlike, one big group of near copies, exact copies, small unlike texts; buckets whole and in parts."""
    monkeypatch.setattr(near_dup, "PART", part)
    rng = random.Random(8)
    base, rows = prose(60).split(), []
    for i in range(25):
        rows.append((100 + i, " ".join(base)))
        base[2 * i] = f"new{i}"
    crowd = prose(80).split()
    for i in range(60):
        w = list(crowd)
        w[rng.randrange(80)] = f"edit{i}"
        rows.append((300 + i, " ".join(w)))
    rows += [(400 + i, prose(rng.randint(1, 6))) for i in range(60)] + [(500 + i, "the same text again") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(near_dup.near_duplicates(df, 2)) == sorted(brute_near(rows, 2), key=repr)


def test_unlike_classes_leave_their_part_before_texts_come():
    """5,000 classes of one bucket that share boilerplate only, one pair of them alike."""
    import pyarrow as pa
    rng = np.random.default_rng(8)
    common = rng.integers(1, 1 << 62, 100, np.uint64)
    sets = [np.concatenate([common, rng.integers(1, 1 << 62, 300, np.uint64)]) for _ in range(5000)]
    sets[4321] = np.concatenate([sets[17][:395], rng.integers(1, 1 << 62, 5, np.uint64)])
    signs = np.array([near_dup.planes(near_dup.minima(s)) for s in sets])
    likely = near_dup.likely_pairs(signs[10:20], signs, 80)
    x, y = signs[17].view(np.uint64), signs[4321].view(np.uint64)
    differ = sum(bin(int((x[i] ^ y[i]) | (x[i + 2] ^ y[i + 2]))).count("1") for i in range(2))
    assert ((1 - differ / 128) - 0.25) / 0.75 > 0.8 and set(np.flatnonzero(likely[7]).tolist()) == {17, 4321} and likely.sum() == 11
    name = lambda i: i.to_bytes(4, "big")
    rows = [(1, name(i), name(i), signs[i].tolist(), i < 2000) for i in range(5000)] + [(2, name(0), name(0), signs[0].tolist(), True)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[lo: lo + 999]]) for c in range(5)], ["part", "node", "component", "signature", "is_left"])
               for lo in range(0, len(rows), 999)]
    got = [r for b in near_dup._likely(80)(batches) for r in b.to_pylist()]
    assert sorted((r["part"], r["node"], r["is_left"]) for r in got) == [(1, name(17), True), (1, name(4321), False)]


@pytest.mark.parametrize("part", [1024, 40])
def test_near_duplicates_among_boilerplate(spark, monkeypatch, part):
    """Buckets full of classes that share two fifths of their words; a few of them have an edited copy."""
    monkeypatch.setattr(near_dup, "PART", part)
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    common = " ".join(word() for _ in range(60))
    rows = [(i, common + " " + " ".join(word() for _ in range(90))) for i in range(200)]
    rows += [(1000 + i, rows[i][1][:-7] + " " + word()) for i in range(0, 200, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(near_dup.near_duplicates(df, 2)) == sorted(brute_near(rows, 2), key=repr)


def test_near_duplicates_of_no_rows(spark):
    assert near_dup.near_duplicates(empty(spark)).collect() == []


def test_one_of_each(spark):
    got = near_dup.one_of_each(messy(spark))
    ids = sorted((r.doc_id for r in got.collect()), key=repr)
    assert got.columns == messy(spark).columns
    assert ids == sorted([1, 2, 3, 4, 6, 9, 10, 11, 12, 13, None, 15, 16, 17], key=repr)
    assert near_dup.one_of_each(empty(spark)).collect() == []


def test_one_of_each_keeps_every_row_without_words(spark):
    rows = [(None, None), (None, None), (None, ""), (None, ""), (1, " \t\x0b"), (1, " \t\x0b"), (None, "some words"), (None, "some words"), (2, "\x00"), (3, "\u00a0")]
    got = near_dup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert as_rows(got) == sorted(rows[:7] + rows[8:], key=repr)


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(5, 5), (1, 0)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {i: 200 for i in range(200, 207)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@needs_tables
def test_op7(spark):
    got = queries.op7(spark, SF).persist()
    assert result(got) == sorted(brute_near(texts_of(spark), 2), key=repr)
    assert compare(got, connect(SF), queries.SQL["op7_near_duplicates"]) is None


def test_texts_are_dealt_once_with_or_without_crowds(spark, monkeypatch, tmp_path):
    """Crowded anchors take their contexts from the exchange that all contexts share: no other job moves the texts."""
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    rows = [(i, prose(20) + " " + PASSAGE + " " + prose(20)) for i in range(30)] + [(99, BASE + BASE)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    moved = []
    monkeypatch.setattr(suffix_dedup, "written", lambda frame, name, write=suffix_dedup.written: (moved.append(frame), write(frame, name))[1])
    out = suffix_dedup.repeats(df)
    assert as_rows(out) == sorted(brute_repeats(rows), key=repr)
    assert [f.columns for f in moved if "_row" in f._jdf.queryExecution().analyzed().toString() and "Join" in f._jdf.queryExecution().analyzed().toString()] == []
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    exchanges = [line for line in plan.splitlines() if " Exchange " in line and "hashpartitioning(_id" in line]
    assert len(exchanges) == 3, plan  # texts, what is asked of them, runs
