"""Vector codes and spelling variants beside brute force."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_data import SF, as_rows, empty, messy, messy_rows, needs_tables
from retailflow.llm import queries, spelling, vector_codes

NAN, INF = float("nan"), float("inf")


def vectors():
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * 0.1).tolist(), i % 3) for i in range(60)]
    rows += [(100 + i, rows[i % 4][1], None) for i in range(30)]  # copies: ties between entries
    rows += [(7, rows[9][1], 1), (7, rows[8][1], 1), (200, None, 1), (201, [NAN] * 8, 1), (202, [INF] + [0.0] * 7, 2), (203, [None] + [0.0] * 7, 2),
             (204, [0.5, -0.5], 2), (205, [], 2), (None, rows[3][1], None), (206, [1e30] * 8, 9), (206, [-1e300] * 8, 9), (207, [0.0] * 8, 0)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(c) for c in ("id", "v", "code", "error", "part", "a")})


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    most = vector_codes.limit(dim)
    ints = [(i, [max(-most, min(most, int(np.floor(x * 1024)))) for x in v] + [0] * (dim - len(v)), l, len(v)) for i, v, l in kept]
    ints.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1][:r[3]]))
    w = dim // parts
    cut = [[r[1][p * w:(p + 1) * w] for p in range(parts)] for r in ints]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[near(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else e for n, e in enumerate(books[p])]
    found = [(r, [near(c[p], books[p]) for p in range(parts)]) for r, c in zip(ints, cut)]
    by_label = Counter()
    for r, ns in found:
        by_label[r[2]] += sum(d for d, _ in ns)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{n:02x}" for _, n in ns), sum(d for d, _ in ns), min(by_label[r[2]], 2 ** 63 - 1), sha) for r, ns in found), key=repr)


@pytest.mark.parametrize("entries", [1, 20, 256])
def test_codes_of_awkward_vectors(spark, entries, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 7)
    monkeypatch.setattr(vector_codes, "STEP", 2)
    assert as_rows(vector_codes.compress(frame(spark, vectors()), entries=entries)) == brute_codes(vectors(), entries=entries)


def test_codes_of_few_or_no_vectors(spark):
    for rows in ([], vectors()[:1], [(1, None, 2)], [(1, [], 2)], [(None, [1.0, 2.0, 3.0, 4.0, 5.0], None)] * 3):
        assert as_rows(vector_codes.compress(frame(spark, rows))) == (brute_codes(rows) if any(r[1] is not None for r in rows) else [])


def test_nearest_is_exact_and_stops_early():
    rng = np.random.default_rng(6)
    entries = (np.repeat(np.arange(-64, 64)[:, None] * 40, 6, 1) + rng.integers(-3, 4, (128, 6))).repeat(2, 0)  # every entry twice: ties
    parts = entries[rng.integers(0, 256, 3000)] + rng.integers(-20, 21, (3000, 6))
    book = vector_codes.Codebook(entries)
    at, d = book.nearest(parts)
    whole = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert (d == whole.min(1)).all() and (at == whole.argmin(1)).all()
    assert book.looked < 0.3 * whole.size


def test_large_components_stay_exact():
    rng = np.random.default_rng(9)
    most = vector_codes.limit(8)
    entries, parts = (rng.integers(-most, most, (n, 2)) for n in (50, 40))
    at, d = vector_codes.Codebook(entries).nearest(parts)
    whole = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)) for e in entries] for x in parts]
    assert d.tolist() == [min(w) for w in whole] and at.tolist() == [w.index(min(w)) for w in whole]


def test_decoded_vectors_are_near(spark):
    rows = vectors()[:60]
    whole, dim = vector_codes.whole_rows(frame(spark, rows), "vec_id", "embedding", "label", 1024, 4)
    books = vector_codes.fit(whole, dim, 4, 256, 4)
    for r in vector_codes.decode(vector_codes.encode(whole, books, dim), books).collect():
        assert abs(sum((a - b) ** 2 for a, b in zip(r.vector, [np.floor(x * 1024) / 1024 for x in rows[r.id][1]])) * 1024 ** 2 - r.error) < 1e-3


@needs_tables
@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_spelling_variants"])
def test_queries(spark, name):
    from oracle import compare, connect
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) is None


def brute_words(rows, least_length=6, least_n=5, ratio=5):
    count = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            count[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    words = {w: n for w, n in count.items() if len(w) >= least_length and n >= least_n}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    close = defaultdict(list)
    for a, b in itertools.combinations(words, 2):
        if near(a, b):
            close[a].append(b)
            close[b].append(a)
    form = {}
    for w in words:
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n, len(close[w]), words.get(form[w])) for w, n in words.items()), key=repr)


def variants_of(words):
    return [(i, " ".join([w] * n), None, None, None) for i, (w, n) in enumerate(words)]


#: chains of forms, ties of counts, runs of equal letters, an insertion at either end, letters beyond ASCII, a word with the sign ÷
PLANTED = [("receive", 650), ("recieve", 120), ("recive", 130), ("recife", 25), ("recifes", 5), ("receve", 20), ("receeve", 6), ("receivee", 7), ("xreceive", 5), ("aabbaa", 9), ("aabbaaa", 60), ("aaabbaa", 60),
           ("aabba", 50), ("aabbab", 9), ("große", 70), ("großee", 70), ("größee", 9), ("groß÷e", 5), ("naïves", 30), ("naives", 5), ("lonely", 5), ("RECEIVE", 3)]


def test_variants_of_planted_words(spark):
    rows = variants_of(PLANTED)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = as_rows(spelling.variants(df))
    assert got == brute_words(rows)
    assert {"recieve", "receve"} & {r[0] for r in got if r[1]} and any(r[1] != r[2] for r in got if r[1])


@pytest.mark.parametrize("least", [1, 2])
def test_variants_of_messy_rows(spark, least):
    assert as_rows(spelling.variants(messy(spark), least_length=3 + least, least_n=least, ratio=2)) == brute_words(messy_rows(), 3 + least, least, 2)


def test_variants_of_nothing(spark):
    assert spelling.variants(empty(spark)).collect() == []
    assert spelling.variants(messy(spark), least_n=10 ** 6).collect() == []


def test_groups_do_not_break_at_batches():
    """A run of equal prefixes that batches cut anywhere gives the same lines."""
    import pyarrow as pa
    rows = [("bc$a", "", True, "abc", 5), ("bc$a", "x", True, "axbc", 9), ("bc$a", "y", True, "aybc", 9), ("zz", "q", True, "q", 1), ("zzz", "", True, "w", 1), ("zzz", "a", False, "wa", 1)]

    def lines(cuts):
        batches = [pa.record_batch([pa.array(c) for c in zip(*rows[a:b])], names=["prefix", "last", "first_of_run", "word", "n"]) for a, b in itertools.pairwise([0, *cuts, len(rows)])]
        return sorted(tuple(r.values()) for b in spelling._scan(batches) for r in b.to_pylist())
    whole = lines([])
    assert whole == [("abc", 5, 2, "axbc", 9), ("axbc", 9, 2, "aybc", 9), ("aybc", 9, 2, "axbc", 9)]
    assert all(lines([a, b]) == whole for a, b in itertools.combinations(range(1, len(rows)), 2))
