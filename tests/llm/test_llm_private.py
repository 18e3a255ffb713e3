"""Personal data: base spans beside the plain patterns, the bootstrap beside one over dictionaries."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_data import SF, empty, messy, messy_rows, needs_tables, texts_of
from retailflow.llm import private_data as P
from retailflow.llm import queries

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def fits(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return (True, all(int(p) <= 255 for p in text.split(".")) if kind == 1 else False, 16 <= len(digits) <= 19 and luhn(digits), 8 <= len(digits) <= 15)[kind]


def plain_base(text):
    return [[m.span() for m in re.finditer(form, text) if fits(kind, m.group())] for kind, form in enumerate(PLAIN)]


def spelt(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def brute(rows, turns=P.TURNS):
    """The same graph and turns over dictionaries."""
    base = [plain_base(t or "") for _, t in rows]
    each = [[(k, a, b, True) for k, of in enumerate(spans) for a, b in of] + [(*s, False) for s in P.loose(t or "", spans)] for (_, t), spans in zip(rows, base)]
    values, may, seeds = defaultdict(set), defaultdict(set), set()
    for (_, t), ms in zip(rows, each):
        for k, a, b, seed in ms:
            v = P.value(k, t[a:b])
            if seed:
                seeds.add((v, k))
            for p in P.patterns(t, a, b, k):
                values[p].add(v)
                may[p, v].add(k)
    score = {}
    for _ in range(turns):
        sure = {}
        for p, vs in values.items():
            for k in range(4):
                support = sum(1.0 if (v, k) in seeds else round(score.get((v, k), 0), 12) for v in vs)
                if support >= P.SUPPORT and support / (len(vs) + 1) >= P.TRUST:
                    sure[p, k] = support / (len(vs) + 1)
        doubt = defaultdict(lambda: 1.0)
        for (p, k), c in sure.items():
            for v in values[p]:
                if k in may[p, v] and (v, k) not in seeds:
                    doubt[v, k] *= 1 - c
        score = {key: 1 - d for key, d in doubt.items() if 1 - d >= P.TRUST - 1e-12}
    out = []
    for (i, t), spans, ms in zip(rows, base, each):
        fixed = [(k, a, b) for k, of in enumerate(spans) for a, b in of]
        more = []
        found = [(k, a, b, 1.0 if (P.value(k, t[a:b]), k) in seeds else round(score.get((P.value(k, t[a:b]), k), 0), 9)) for k, a, b, seed in ms if not seed]
        for k, a, b, s in sorted(found, key=lambda m: (-m[3], m[1] - m[2], m[1], m[0])):
            if s and all(b <= lo or hi <= a for _, lo, hi in more):
                more.append((k, a, b))
        out.append((i, *(len(s) for s in spans), hashlib.sha256(spelt(fixed).encode()).hexdigest(), spelt(fixed + more), len(more)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


PIECES = ["a@b.c", "x.y+z%@host-1.example.com", "@", ".", "..", "-", " ", "\n", "+1 (017) 555-7713", "+49 30 1234567", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "1.2.3.4",
          "255.255.255.256", "10.0.0.1.5", "007.1.1.1", "1", "22", "999999999999999999999", "word", "é", "９", "me (at) host (dot) org", "(", ")", "fe80::1:2:3", "192[.]168[.]0[.]1", "\U0001f600", "a@b", "%"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES) | st.text("019+. -()@a", max_size=6), max_size=14).map("".join))
def test_base_is_the_plain_patterns(text):
    assert P.base(text) == plain_base(text)
    spans = [s for kind in P.base(text) for s in kind]
    assert all(text[a:b] and all(b <= lo or hi <= a for lo, hi in spans) for _, a, b in P.loose(text, P.base(text)))


@pytest.mark.parametrize("text", ["a" * 300_000, "9" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "9 " * 150_000, "+1" + " " * 300_000, "a." * 150_000, "f:" * 150_000,
                                  "(at)" * 75_000, "a@b." * 75_000, "[dot]a" * 50_000, "(1" * 150_000, " " * 300_000])
def test_time_is_linear(text):
    import time
    start = time.process_time()
    P.mentions(text)
    assert time.process_time() - start < 20


def planted():
    """Seeds behind "write to", one spelling only contexts can tell, and what it tells in turn."""
    rng = random.Random(3)
    rows = [(i, f"please write to us at user{i}@mail.example.com or call the desk at +1 (20{i % 10}) 555-01{i:02d} today") for i in range(12)]
    rows += [(100, "please write to us at hidden (at) mail (dot) example (dot) com or call"), (101, "hidden (at) mail (dot) example (dot) com sits elsewhere"),
             (102, "the desk at 0205 5550199 today"), (103, "she paid 4155550123 units for it"), (104, "nothing here at all"), (105, "user3 [at] mail [dot] example [dot] com"),
             (106, "+1 (963) 555-1408 4111111111111111 end"), (None, "please write to us at who (at) x (dot) y or"), (None, "please write to us at who (at) x (dot) y or"), (107, None), (108, "")]
    for i in range(20):  # cards in unlike contexts: only their shape is common
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        rows.append((200 + i, f"w{chr(97 + i)} {digits + next(c for c in '0123456789' if luhn(digits + c))} v{chr(97 + i)}"))
    rows.append((300, "x 1234567890123456 y"))
    return rows


def test_contexts_find_what_forms_miss(spark):
    found = got(P.find(frame(spark, planted())))
    assert found == brute(planted())
    added = {r[0]: r[7] for r in found}
    spans = {r[0]: r[6] for r in found}
    assert added[100] == added[101] == added[105] == 1 and "email:22:" in spans[100] and spans[101].startswith("email:0:")
    assert added[102] == 1 and added[103] == added[104] == added[300] == 0
    assert spans[106] == "card:18:34,phone:0:17"


def test_turns_reach_further(spark):
    """A pattern none of whose values is a seed is believed once its values are found by another one."""
    rows = [(i, f"mail box {i}ab@x.example.com") for i in range(8)]
    rows += [(20 + i, f"mail box {w} (at) x.org") for i, w in enumerate("klmnopqrstuv")] + [(40 + i, f"ping him via {w} (at) x.org now") for i, w in enumerate("klmnopqrstuv")]
    rows += [(60, "ping him via last (at) x.org now")]
    few = {r[0]: r[7] for r in got(P.find(frame(spark, rows)))}
    assert few[60] == 0  # half of the box's values are not seeds: not believed
    rows += [(100 + i, f"mail box {i}cd@x.example.com") for i in range(100)]
    found = got(P.find(frame(spark, rows)))
    assert found == brute(rows) and {r[0]: r[7] for r in found}[60] == 1


def test_messy_rows(spark):
    rows = [(r[0], r[1]) for r in messy_rows()]
    assert got(P.find(messy(spark))) == brute(rows)
    assert P.find(empty(spark)).collect() == []


@needs_tables
def test_op13(spark):
    assert got(queries.op13(spark, SF)) == brute(texts_of(spark))
