"""Personal data: fixed forms, and what a bootstrap over their contexts finds beyond them.

Base spans (``base``) are e-mail addresses, IP addresses, card and phone numbers of the fixed forms.  Their values are the seeds.
Everything of a looser form (``loose``: "name (at) host", a card number with other separators, a phone number without its
country sign, an IPv6 address ...) is a candidate, nothing more; whether it is personal data is left to its contexts.

A lexical pattern is the words beside a mention (three or two on the left, two on the right, or one on each side), or the
outer shape of a card or phone number (digits as d, with its check sum), which finds numbers that run into another one.  Patterns and
values are the two sides of a graph whose edge says that a value occurred in a pattern, however often.  Each turn
scores both sides:

- a pattern's confidence for a kind is the summed score of its values of that kind over the count of all its values plus one
  (a value of another kind, or one not known yet, speaks against it); patterns under ``SUPPORT`` or ``TRUST`` are not believed;
- a candidate's score is 1 - product(1 - confidence) over believed patterns; candidates under ``TRUST`` are not found yet.

Seeds score 1, in whatever spelling they come back.  What one turn finds supports further patterns in the next, ``TURNS`` times or until nothing new is found.  At the end all
mentions of found values become spans, unless they overlap a base span or a better found one.  The graph is tables: edges are
distinct (pattern, value) rows, turns are joins and sums; nothing but one count a turn reaches the driver.

Cases.  Null and empty texts have no spans, null ids stay.  Texts are searched whole, in time linear in their length; a pattern's words are taken
from ``REACH`` code points beside the mention.  Repeated rows have a result row each and count once as evidence.  Ties
of overlapping found spans go to the higher score, then the longer, the earlier, the kind listed first.  An empty table gives no
rows.  Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ready, tidy, written

KINDS = ("email", "ip", "card", "phone")
REACH = 64
SUPPORT = 3.0
TRUST = 0.75
TURNS = 4
SLICE = 1 << 20  # code points of text a task turns into Python strings at once

# Fixed forms of the contract.  Quantifiers are possessive, and a number is not tried from its inner digits, where that
# cannot change the leftmost match: time stays linear in the text.
SIGN = re.compile("@")
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

# Looser forms: candidates.
LOOSE_SIGN = re.compile(r"\s?(?:[@＠]|[\[({]\s?(?:at|AT|@)\s?[\])}])\s?")
LOOSE_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|．|\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?)[A-Za-z0-9-]++)*+")
LOOSE_IP = re.compile(r"(?<![\w.:])(?:[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)|\s?[\[(]dot[\])]\s?)[0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7})(?![\w:])")
LOOSE_CARD = re.compile(r"(?<!\w)[0-9](?:[\x20./_-]?[0-9]){11,18}(?!\w)")
LOOSE_PHONE = re.compile(r"(?<![\w+])\+?\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?!\w)")
BRACKETED_DOT = re.compile(r"\s?(?:[\[({]\s?(?:dot|DOT|\.)\s?[\])}]|．)\s?")
DIGIT = re.compile("[0-9]")
TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str, sign: re.Pattern, host: re.Pattern):
    """Spans around every sign: the longest local part before it, from the last span or sign on, and the host behind it."""
    least = 0
    while at := sign.search(text, least):
        start = least + len(text[least:at.start()].rstrip(LOCAL))
        behind = host.match(text, at.end()) if start < at.start() else None
        if behind:
            yield start, behind.end()
        least = behind.end() if behind else at.end()


def base(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind of ``KINDS``: leftmost, not overlapping within their kind; a match that fails its test is passed over."""
    ips = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    cards = [m.span() for m in CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := only_digits(m.group())) <= 19 and luhn(d)]
    phones = [m.span() for m in PHONE.finditer(text) if 8 <= len(only_digits(m.group())) <= 15]
    return [list(_emails(text, SIGN, HOST)), ips, cards, phones]


def loose(text: str, taken: list[list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of candidates that overlap no span of ``taken``."""
    spans = sorted(s for kind in taken for s in kind)
    found = [(0, *s) for s in _emails(text, LOOSE_SIGN, LOOSE_HOST)]
    found += [(kind, *m.span()) for kind, form in ((1, LOOSE_IP), (2, LOOSE_CARD), (3, LOOSE_PHONE)) for m in form.finditer(text)]
    found.sort(key=lambda s: s[1])
    out, at, reach = [], 0, 0
    for kind, start, end in found:  # both lists by start: spans that begin before this one's start reach as far as ``reach``
        while at < len(spans) and spans[at][0] <= start:
            reach = max(reach, spans[at][1])
            at += 1
        if reach <= start and (at == len(spans) or spans[at][0] >= end):
            out.append((kind, start, end))
    return out


def value(kind: int, text: str) -> str:
    """What makes two mentions the same identifier, however they are spelt."""
    if kind > 1:
        return only_digits(text)
    return BRACKETED_DOT.sub(".", LOOSE_SIGN.sub("@", text) if kind == 0 else text).lower()


def patterns(text: str, start: int, end: int, kind: int) -> list[str]:
    """Lexical patterns of a mention: marked word sequences (one without a word of letters is none), the shape of a number."""
    left = [w.lower() for w in TOKEN.findall(text[max(0, start - REACH):start])][-3:]
    right = [w.lower() for w in TOKEN.findall(text[end:end + REACH])][:2]
    ways = [("l3", left) if len(left) == 3 else None, ("l2", left[-2:]) if len(left) > 1 else None,
            ("r2", right) if len(right) == 2 else None, ("lr", [left[-1], right[0]]) if left and right else None]
    found = [f"{name} {' '.join(words)}" for name, words in filter(None, ways) if any(w.isalpha() for w in words)]
    if kind >= KINDS.index("card"):
        number = text[start:end]
        found.append(f"{KINDS[kind]} {DIGIT.sub('d', number)}" + " sum" * (kind == KINDS.index("card") and luhn(only_digits(number))))
    return found


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
MENTION = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string()), ("seed", pa.bool_()),
                     ("patterns", pa.list_(pa.string()))])
FOUND = ("id long, base array<struct<kind:int,start:int,stop:int>>, "
         "mentions array<struct<kind:int,start:int,stop:int,value:string,seed:boolean,patterns:array<string>>>")


def mentions(text: str) -> tuple[list[tuple], list[tuple]]:
    """Base spans, and all mentions with their contexts."""
    spans = base(text)
    fixed = [(kind, *s) for kind, of_kind in enumerate(spans) for s in of_kind]
    return fixed, [(kind, lo, hi, value(kind, text[lo:hi]), seed, patterns(text, lo, hi, kind))
                   for seed, some in ((True, fixed), (False, loose(text, spans))) for kind, lo, hi in some]


def _read(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        lo = size = 0
        for hi in range(1, len(batch) + 1):
            size += len(texts[hi - 1].as_buffer() or b"")
            if size >= SLICE or hi == len(batch):
                got = [mentions(t) if t else ([], []) for t in texts[lo:hi].to_pylist()]
                yield pa.record_batch({"id": ids[lo:hi], "base": pa.array([[dict(zip(("kind", "start", "stop"), s)) for s in b] for b, _ in got], pa.list_(SPAN)),
                                       "mentions": pa.array([[dict(zip(("kind", "start", "stop", "value", "seed", "patterns"), m)) for m in ms] for _, ms in got], pa.list_(MENTION))})
                lo, size = hi, 0


def _bit(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(1 << k) for k in range(len(KINDS))]), kind + 1)


def _has(bits: str, kind: Column) -> Column:
    return F.coalesce(F.col(bits).bitwiseAND(_bit(kind)) != 0, F.lit(False))


def _edges(found: DataFrame) -> DataFrame:
    """(value, pattern, may, known): distinct, with one bit per kind the value may be of, and is a seed of."""
    m = found.select(F.explode("mentions").alias("m")).select("m.*")
    seeds = m.where("seed").groupBy("value").agg(F.bit_or(_bit(F.col("kind"))).alias("known"))
    return (m.select("value", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "value")
            .agg(F.bit_or(_bit(F.col("kind"))).alias("may")).join(seeds, "value", "left"))


def _believed(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that pass, given the scores (value, kind, score) of found values."""
    of_value = scores.groupBy("value").agg(*[F.max(F.when(F.col("kind") == k, F.col("score"))).alias(f"s{k}") for k in range(len(KINDS))])
    scored = edges.join(of_value, "value", "left")
    exact = "decimal(24,12)"  # sums of any order are equal
    support = [F.sum(F.when(_has("known", F.lit(k)), F.lit(1).cast(exact)).otherwise(F.coalesce(f"s{k}", F.lit(0)).cast(exact))).cast("double").alias(f"s{k}")
               for k in range(len(KINDS))]
    by_pattern = scored.groupBy("pattern").agg(F.count("*").alias("values"), *support)
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"s{k}").alias("support"), (F.col(f"s{k}") / (F.col("values") + 1)).alias("confidence")) for k in range(len(KINDS))]))
    return by_pattern.select("pattern", kinds.alias("k")).select("pattern", "k.*").where((F.col("support") >= SUPPORT) & (F.col("confidence") >= TRUST)).drop("support")


def _scored(edges: DataFrame, believed: DataFrame) -> DataFrame:
    """(value, kind, score) of candidates that believed patterns speak for."""
    doubt = F.sum(F.ln(1 - F.col("confidence")).cast("decimal(24,12)")).cast("double")
    unsure = edges.where(F.col("may") != F.coalesce("known", F.lit(0)))  # seeds are many and need no score
    kept = unsure.join(believed, "pattern").where(_has("may", F.col("kind")) & ~_has("known", F.col("kind")))
    return kept.groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score")).where(F.col("score") >= TRUST)


def bootstrap(found: DataFrame, turns: int = TURNS) -> DataFrame:
    """(value, kind, score) of the identifiers the turns discover beside the seeds."""
    edges = written(_edges(found), "private-edges")
    scores = found.sparkSession.createDataFrame([], "value string, kind int, score double")
    known = 0
    for _ in range(turns):
        scores = written(_scored(edges, _believed(edges, scores)), "private-scores")
        n = scores.count()
        if n == known:  # found values only grow: equal counts are equal sets
            break
        known = n
    return scores


def _spelt(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{stop}" for kind, start, stop in sorted(spans))


def chosen(added: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Found spans that overlap no better one."""
    starts: list[int] = []
    out: list[tuple[int, int, int]] = []  # by start, as ``starts``
    for kind, start, stop, _ in sorted(added, key=lambda s: (-s[3], s[1] - s[2], s[1], s[0])):
        at = bisect.bisect_left(starts, start)
        if (at == 0 or out[at - 1][2] <= start) and (at == len(out) or stop <= starts[at]):
            starts.insert(at, start)
            out.insert(at, (kind, start, stop))
    return out


def _report(batches):
    for batch in batches:
        rows = []
        for spans, added in zip(batch.column("base").to_pylist(), batch.column("added").to_pylist()):
            spans = [(s["kind"], s["start"], s["stop"]) for s in spans]
            more = chosen([(a["kind"], a["start"], a["stop"], a["score"]) for a in added or ()])
            count = [sum(s[0] == k for s in spans) for k in range(len(KINDS))]
            rows.append((*count, hashlib.sha256(_spelt(spans).encode()).hexdigest(), _spelt(spans + more), len(more)))
        columns = list(zip(*rows)) or [()] * 7
        yield pa.record_batch([batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]))],
                              names=["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])


def find(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added of every row."""
    ready(documents.sparkSession)
    found = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(tidy(_read), FOUND)
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "private-found")  # written once: row numbers stay
    each = found.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    seeds = each.where("seed").select("value", "kind", F.lit(1.0).alias("score")).distinct()
    added = each.where("not seed").join(seeds.union(bootstrap(found)), ["value", "kind"]).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "stop", "score")).alias("added"))
    return (found.select("row", "id", "base").join(added, "row", "left").select("id", "base", "added")
            .mapInArrow(tidy(_report), "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
            .withColumnRenamed("id", key))
