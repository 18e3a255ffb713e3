"""Repeated byte strings by suffix arrays: every byte covered by a string of ``LENGTH`` bytes that starts anywhere else too.

Which suffixes meet.  Each window of LENGTH bytes is given the anchor it holds: of its strings of ``GRAM`` bytes the one
with the least hash, the leftmost of equals.  That depends on the window's bytes alone, so equal windows have equal
anchors, and windows in a row share one.  A row per anchor, about every ninetieth byte, says which windows of which
document it holds and hashes its context, the bytes of all those windows.  Windows whose anchor occurs once cannot
repeat.  The contexts of the other anchors, each different one once with whether it occurs more often, are dealt to
tasks by anchor, and their suffixes are sorted there.  No task sees a document's other bytes, and no suffix
travels alone.

Suffix array.  Two stages.  A suffix smaller than its successor (by its first byte that differs from the next) is
sorted directly, by words of eight bytes, ties by the words behind.  Then the buckets of first bytes are scanned from
the smallest: the suffix that starts one byte before a scanned one, if greater than it, goes to the next
place of its own bucket.  A bucket is complete when its turn comes, so numpy scans it whole; runs of one byte take a
turn per byte.  Adjacent common prefixes follow; a window repeats if that with a neighbour reaches LENGTH, or if
its context occurs more than once.

Hot anchors.  Equal contexts are one row before any group is formed.  The contexts of an anchor with more than ``CROWD`` different
ones (the end of a passage in very many documents) do not meet in a task: growing strings to either side of the anchor are counted
by digest, and only windows that no unique one of these lies in are counted themselves.

Cases.  Null text is the empty text.  Matches are of bytes (they may begin inside a character), never cross
documents and are judged on the input.  A text shorter than LENGTH loses nothing.  Repeated rows repeat each
other wholly; however many rows of one id and text there are, their runs are kept once.  Null doc_ids are ids like others.  Other columns are kept by ``cleaned`` and not read by ``repeats``.
An empty table stays empty.  Contexts are compared by two 64-bit hashes, windows by their bytes, those of crowded anchors by 128-bit digest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ready, tidy, written
from .shingles import mixed

LENGTH = 200
GRAM = 24
CROWD = 4096
#: Bytes by which the strings around a crowded anchor grow.
STEP = 16
#: Bytes handled at once in a task.
AT_ONCE = 1 << 20
NO_ID = -(1 << 63)  # stands for a null doc_id in keys

_bytes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


# Anchors

def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    return key if have == width else np.minimum(key[: len(key) - (width - have)], key[width - have:])


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position."""
    one = _bytes[data]
    factor = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
    two = one[:-1] * factor[0] + one[1:]
    four = two[:-2] * factor[1] + two[2:]
    eight = four[:-4] * factor[2] + four[4:]
    sixteen = eight[:-8] * factor[3] + eight[8:]
    n = len(data) - GRAM + 1
    return mixed(sixteen[:n] * factor[4] + eight[16: 16 + n])


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, hash of the anchor) of every anchor in texts that end at ``ends``; at most 2^24 bytes."""
    if len(data) < length:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
    gram = _grams(data)
    place = np.arange(len(gram), dtype=np.uint64)
    least = _least((gram & ~np.uint64(0xFFFFFF)) | place, length - GRAM + 1)
    start = np.arange(len(least))
    end = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)]
    window = start[start + length <= end]
    anchor = (least[window] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(window) else np.empty(0, np.int64)
    last = np.concatenate([new[1:], [len(window)]]) - 1 if len(window) else new
    return window[new], window[last], gram[anchor[new]]


def _pieces(batch: pa.RecordBatch):
    """(rows, first byte of each in its text, bytes joined, their ends): texts in pieces of bounded size.

    A text longer than AT_ONCE comes in pieces that overlap by LENGTH - 1 bytes, so every window is in one piece.
    """
    rows, shift, held, size = [], [], [], 0
    for i, text in enumerate(batch.column("text")):
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        for at in range(0, max(1, len(raw) - LENGTH + 1), AT_ONCE):
            piece = raw[at: at + AT_ONCE + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            rows.append(i)
            shift.append(at)
            held.append(piece)
            size += len(piece)
            if size >= AT_ONCE:
                yield rows, shift, b"".join(held), np.cumsum([len(p) for p in held])
                rows, shift, held, size = [], [], [], 0
    if rows:
        yield rows, shift, b"".join(held), np.cumsum([len(p) for p in held])


def _found(batches):
    """Anchors of the texts with the document, place and context hash of each."""
    for batch in batches:
        for rows, shift, joined, ends in _pieces(batch):
            first, last, gram = anchors(np.frombuffer(joined, np.uint8), ends)
            view = memoryview(joined)
            context = np.fromiter((xxhash.xxh3_64_intdigest(view[a: b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())), np.uint64, len(first))
            which = np.searchsorted(ends, first, "right")
            row = pa.array(np.array(rows)[which])
            lo = first - np.concatenate([[0], ends[:-1]])[which] + np.array(shift)[which]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), batch.column("_id").take(row), batch.column("_hash").take(row),
                 pa.array(lo.astype(np.int32)), pa.array((last - first).astype(np.int32))], ["gram", "context", "_id", "_hash", "lo", "more"])


# Suffix array

def suffix_order(text: np.ndarray, ends: np.ndarray, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes ``wanted`` sorted by their first ``depth`` bytes, common prefixes of neighbours).

    ``text`` holds strings that end at ``ends``; a suffix ends with its string.  The order of suffixes equal up to
    ``depth`` is left open, prefixes are counted up to ``depth``.
    """
    n = len(text)
    last = np.zeros(n, bool)
    last[ends - 1] = True
    # smaller than its successor: decided by the first byte that differs from the next; a string's last byte is greater
    ahead = np.concatenate([text[1:], [0]])
    differs = last | (text != ahead)
    at = np.flatnonzero(differs)
    small = np.repeat((text[at] < ahead[at]) & ~last[at], np.diff(at, prepend=-1))
    # the suffixes to place: those wanted and, behind a greater one, all up to the next smaller
    placed = np.zeros(n, bool)
    placed[wanted] = True
    edge = placed & ~small & ~last
    while (step := np.flatnonzero(edge)).size:
        edge = np.zeros(n, bool)
        step = step[~placed[step + 1]] + 1
        placed[step] = True
        edge[step] = ~small[step] & ~last[step]
    words = _words(text, ends)
    room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)  # bytes to the string's end

    def word(i, k):
        return np.where(room[i] > 8 * k, words[np.minimum(i + 8 * k, n - 1)], 0)

    # first stage: sort by the first word, then ties by the words behind
    direct = np.flatnonzero(placed & small)
    key = words[direct]
    order = np.argsort(key)
    direct, key = direct[order], key[order]
    tied, group = np.arange(len(direct)), np.zeros(len(direct), np.int64)  # places in ``direct`` and the ties they belong to
    for k in range(1, -(-depth // 8) + 1):
        same = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        still = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(tied) else np.empty(0, bool)
        group = np.cumsum(~np.concatenate([[False], same]))[still] if len(tied) else group
        tied = tied[still]
        if not len(tied) or 8 * k >= depth:
            break
        key = word(direct[tied], k)
        order = np.lexsort((key, group))
        direct[tied], key = direct[tied[order]], key[order]
    # second stage: scan the buckets of first bytes
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    closed = np.flatnonzero(placed & ~small & last)  # a lone last byte is the least of its bucket
    for c in np.unique(text[closed]).tolist():
        waiting[c].append(closed[text[closed] == c])
    out = []
    for c in range(256):
        bucket = list(waiting[c])
        run = np.concatenate(bucket) if bucket else np.empty(0, np.int64)
        while len(run):  # greater suffixes of the same bucket, one byte longer each turn
            run = _before(run, text, placed, small, last)
            run = run[text[run] == c]
            bucket.append(run)
        bucket.append(direct[bounds[c]: bounds[c + 1]])
        bucket = np.concatenate(bucket)
        out.append(bucket)
        ahead_of = _before(bucket, text, placed, small, last)
        ahead_of = ahead_of[text[ahead_of] > c]
        if len(ahead_of):
            byte = text[ahead_of]
            order = np.argsort(byte, kind="stable")
            ahead_of, byte = ahead_of[order], byte[order]
            cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
            for part in np.split(ahead_of, cuts):
                waiting[text[part[0]]].append(part)
    mine = np.zeros(n, bool)
    mine[wanted] = True
    order = np.concatenate(out)
    order = order[mine[order]]
    return order, _common(order, word, depth)


def _before(at: np.ndarray, text: np.ndarray, placed: np.ndarray, small: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The placed greater suffixes that start one byte before, in order."""
    at = at[at > 0] - 1
    return at[placed[at] & ~small[at] & ~last[at]]


def _words(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number, zeros behind a string's end."""
    n = len(text)
    out = np.zeros(n, np.uint64)
    wide = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)
    for i in range(8):
        out |= np.where(room > i, wide[i: i + n], np.uint64(0)) << np.uint64(56 - 8 * i)
    return out


def _common(order: np.ndarray, word, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it (0 for the first), at most ``depth``."""
    out = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for k in range(-(-depth // 8)):
        differ = word(order[at], k) ^ word(order[at - 1], k)
        done = differ != 0
        # equal leading bytes of a word: from its highest bit that differs
        high = np.frexp((differ[done] >> np.uint64(11)).astype(float))[1]
        bits = np.where(differ[done] >> np.uint64(11) > 0, high + 11, np.where(differ[done] > 255, 9, 1))
        out[at[done]] = 8 * k + (64 - bits) // 8
        at = at[~done]
        if not len(at):
            break
    out[at] = depth
    return np.minimum(out, depth)


# The operator

def _cut(batches):
    """(gram, context, many, crowd, bytes) of the contexts asked for; of neighbouring rows of one document only the first gives them."""
    before = None
    for batch in batches:
        for text, asked, *document in zip(_text(batch), batch.column("asked"), batch.column("_id").to_pylist(), batch.column("_hash").to_pylist()):
            if asked.is_valid and document != before:
                before = document
                raw = text.as_buffer()
                for a in asked.as_py():
                    yield a["gram"], a["context"], a["many"], a["crowd"], raw[a["lo"]: a["lo"] + a["more"] + LENGTH].to_pybytes()


def _contexts(batches):
    """The bytes of the contexts asked for, a row per context."""
    kinds, names = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()], ["gram", "context", "many", "crowd", "content"]
    out, size = [], 0
    for row in _cut(batches):
        out.append(row)
        size += len(row[-1])
        if size >= AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)


def _where(crowd: bool, run):
    """``run`` on the contexts of crowded anchors, or on the others."""
    def some(batches):
        return run(b.filter(pc.equal(b.column("crowd"), crowd)).select(["gram", "context", "many", "content"]) for b in batches)
    return some


def _all(batches):
    yield from batches


def _anchor(content: bytes, gram: int) -> int:
    """Where the anchor lies in a context: all its windows hold it, it is the first of its hash there."""
    more = len(content) - LENGTH
    keys = _grams(np.frombuffer(content, np.uint8)[more: LENGTH]).view(np.int64)
    return more + int(np.flatnonzero(keys == gram)[0])


def _probes(batches):
    """(gram, context, side, step, high, low): digests of the anchor with its next, and with its last, ``STEP`` bytes, twice as many, and so on."""
    for batch in batches:
        out, n, side, step = [], [], [], []
        for gram, content in zip(batch.column("gram").to_pylist(), batch.column("content").to_pylist()):
            at = _anchor(content, gram)
            right = [content[at: at + GRAM + STEP * k] for k in range(1, (len(content) - at - GRAM) // STEP + 1)]
            left = [content[at - STEP * k: at + GRAM] for k in range(1, at // STEP + 1)]
            out += [xxhash.xxh3_128_digest(x) for x in right + left]
            n.append(len(right) + len(left))
            side += [0] * len(right) + [1] * len(left)
            step += [*range(1, len(right) + 1), *range(1, len(left) + 1)]
        yield _digests(batch, n, out, [("side", pa.array(side, pa.int32())), ("step", pa.array(step, pa.int32()))])


def _windows(batches):
    """(gram, context, many, start, high, low): the windows that no unique probe lies in, with their 128-bit digests."""
    for batch in batches:
        out, n, start = [], [], []
        for gram, content, right, left in zip(*(batch.column(c).to_pylist() for c in ("gram", "content", "right", "left"))):
            at, lo, hi = _anchor(content, gram), 0, len(content) - LENGTH
            if left is not None:  # less than left * STEP bytes before the anchor
                lo = max(lo, at - STEP * left + 1)
            if right is not None:  # less than right * STEP bytes behind it
                hi = min(hi, at + GRAM - LENGTH + STEP * right - 1)
            places = range(lo, hi + 1)
            out += [xxhash.xxh3_128_digest(content[i: i + LENGTH]) for i in places]
            n.append(len(places))
            start += places
        yield _digests(batch, n, out, [("start", pa.array(start, pa.int32()))], ["gram", "context", "many"])


def _digests(batch, n: list[int], digests: list[bytes], more: list[tuple], keys=("gram", "context")) -> pa.RecordBatch:
    take = pa.array(np.repeat(np.arange(len(n)), n))
    digest = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    named = [(k, batch.column(k).take(take)) for k in keys] + more + [("high", pa.array(digest[:, 0].copy())), ("low", pa.array(digest[:, 1].copy()))]
    return pa.RecordBatch.from_arrays([c for _, c in named], [k for k, _ in named])


def _runs(batches):
    """Runs of the windows that repeat, of rows (gram, context, starts in order)."""
    for batch in batches:
        row, first, last = [], [], []
        for i, starts in enumerate(batch.column("starts")):
            at = np.asarray(starts.values)
            new = np.flatnonzero(np.diff(at) > 1) + 1
            first.append(at[np.concatenate([[0], new])])
            last.append(at[np.concatenate([new - 1, [len(at) - 1]])])
            row.append(np.full(len(new) + 1, i))
        if row:
            take = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays([batch.column("gram").take(take), batch.column("context").take(take),
                                              pa.array(np.concatenate(first), pa.int32()), pa.array(np.concatenate(last), pa.int32())], ["gram", "context", "first", "last"])


def _repeated(rows: list[tuple]) -> pa.RecordBatch:
    """Runs of windows that repeat, of rows (gram, context, many, content) of whole anchors."""
    ends = np.cumsum([len(r[3]) for r in rows])
    text = np.frombuffer(b"".join([r[3] for r in rows]), np.uint8)
    base = np.concatenate([[0], ends[:-1]])
    edge = np.zeros(len(text) + 1, np.int64)  # windows: +1 where a context's begin, -1 behind the last
    np.add.at(edge, base, 1)
    np.add.at(edge, ends - LENGTH + 1, -1)
    wanted = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    order, common = suffix_order(text, ends, wanted, LENGTH)
    hit = np.zeros(len(text), bool)
    pair = np.flatnonzero(common >= LENGTH)
    hit[order[pair]] = hit[order[pair - 1]] = True
    which = np.searchsorted(ends, wanted, "right")
    found = hit[wanted] | np.array([r[2] for r in rows])[which]
    at, which = wanted[found], which[found]
    if not len(at):
        first = last = np.empty(0, np.int64)
    else:
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (which[1:] != which[:-1])])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]]) - 1
    row = which[first]
    gram, context = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
    return pa.RecordBatch.from_arrays([pa.array(gram[row]), pa.array(context[row]), pa.array((at[first] - base[row]).astype(np.int32)), pa.array((at[last] - base[row]).astype(np.int32))],
                                      ["gram", "context", "first", "last"])


def _sort(batches):
    """Suffix arrays of whole anchors (rows come in their order), as many at once as AT_ONCE bytes hold."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "context", "many", "content"))):
            if held and row[:2] == held[-1][:2]:  # cut more than once from rows of one document
                continue
            if size >= AT_ONCE and row[0] != held[-1][0]:
                yield _repeated(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield _repeated(held)


def removed(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows from ``first`` to ``last`` cover."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["first"], s["last"] + LENGTH) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    stops = [0, *(hi for _, hi in runs)]
    return b"".join(raw[a:b] for a, b in zip(stops, [*(lo for lo, _ in runs), len(raw)]))


def _marked(documents: DataFrame) -> DataFrame:
    """``documents`` (a struct _row with the text, keys _id and _hash) with ``spans``: runs (first, last) of windows that repeat."""
    key = ["_id", "_hash"]
    text = F.col("_row.text").alias("text")
    # anchors are found once; where a hash occurs is told from the table
    rows = written(documents.select(*key, text).mapInArrow(tidy(_found), "gram long, context long, _id long, _hash long, lo int, more int"), "anchors")
    grams = rows.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    live = written(rows.join(grams, "gram", "left_semi"), "live")
    contexts = written(live.groupBy("gram", "context").agg(
        (F.count("*") > 1).alias("many"), *[F.first(c).alias(c) for c in (*key, "lo", "more")]), "contexts")
    crowds = written(contexts.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("gram", F.lit(True).alias("crowd")), "crowds")
    flagged = contexts.join(crowds, "gram", "left").withColumn("crowd", F.coalesce("crowd", F.lit(False)))
    asked = flagged.groupBy(*key).agg(F.collect_list(F.struct("gram", "context", "many", "crowd", "lo", "more")).alias("asked"))
    # left joins on both uses of the documents: they share one exchange of the texts; contexts are cut and dealt once, by anchor, or one by one
    dealt = (documents.join(asked, key, "left").mapInArrow(tidy(_contexts), "gram long, context long, many boolean, crowd boolean, content binary")
             .repartition("gram", F.when(F.col("crowd"), F.col("context"))))
    found = dealt.sortWithinPartitions("gram", "context").mapInArrow(tidy(_where(False, _sort)), "gram long, context long, first int, last int")
    if not crowds.isEmpty():
        cut = dealt.mapInArrow(tidy(_where(True, _all)), "gram long, context long, many boolean, content binary")
        found = found.union(_of_crowds(cut.dropDuplicates(["gram", "context"]), flagged.where("crowd")))
    # repeated rows of one document have the same runs
    spans = (found.join(live, ["gram", "context"])
             .groupBy(*key).agg(F.collect_set(F.struct((F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last"))).alias("spans")))
    return documents.join(spans, key, "left")


def _of_crowds(cut: DataFrame, contexts: DataFrame) -> DataFrame:
    """Runs of windows that repeat in the contexts of crowded anchors (``cut``: with their bytes), no anchor's contexts gather in a task.

    A string around the anchor that only one context has makes all windows around it unique.  So contexts are probed a few
    bytes at a time to either side, and only the windows between the first unique probes are counted, by digest.
    Nothing is written between: the texts' and the contexts' exchanges are shared with what is not crowded.
    """
    window, probe = ["gram", "high", "low"], ["gram", "side", "step", "high", "low"]
    held = [F.min("context").alias("context"), F.max("context").alias("other")]
    unique = cut.mapInArrow(tidy(_probes), "gram long, context long, side int, step int, high long, low long").groupBy(*probe).agg(*held).where("context = other")
    limits = unique.groupBy("gram", "context").agg(F.min(F.when(F.col("side") == 0, F.col("step"))).alias("right"), F.min(F.when(F.col("side") == 1, F.col("step"))).alias("left"))
    windows = cut.join(limits, ["gram", "context"], "left").mapInArrow(tidy(_windows), "gram long, context long, many boolean, start int, high long, low long")
    twice = windows.groupBy(*window).agg(*held).where("context <> other").select(*window)
    runs = (windows.where("NOT many").join(twice, window, "left_semi").groupBy("gram", "context").agg(F.sort_array(F.collect_set("start")).alias("starts"))
            .mapInArrow(tidy(_runs), "gram long, context long, first int, last int"))
    return runs.union(contexts.where("many").select("gram", "context", F.lit(0).alias("first"), F.col("more").alias("last")))


def _with_keys(documents: DataFrame, keep: list[str]) -> DataFrame:
    ready(documents.sparkSession)
    return documents.select(F.struct(*keep).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
                            F.xxhash64("text").alias("_hash"))


def _text(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("_row").field("text")


def _raw(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (doc_id, text)."""
    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(_text(batch), batch.column("spans")):
                raw, runs = _raw(text), removed(spans.as_py())
                out.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept_bytes(raw, runs)).hexdigest()))
            ids = [None if i == NO_ID else i for i in batch.column("_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array([r[i] for r in out], k) for i, k in enumerate([pa.int64()] * 3 + [pa.string()]))],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return _marked(_with_keys(documents, ["text"])).mapInArrow(tidy(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cleaned(documents: DataFrame) -> DataFrame:
    """``documents`` without the repeated bytes; a character cut in two goes.  ``n_chars``, if there, follows the text."""
    def run(batches):
        for batch in batches:
            texts = [None if not t.is_valid else kept_bytes(_raw(t), removed(s.as_py())).decode(errors="ignore") if s.is_valid else t.as_py()
                     for t, s in zip(_text(batch), batch.column("spans"))]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())], ["_row", "_left"])

    rows = _with_keys(documents, documents.columns)
    left = _marked(rows).mapInArrow(tidy(run), T.StructType([rows.schema["_row"], T.StructField("_left", T.StringType())]))
    new = {"text": F.col("_left"), "n_chars": F.length("_left")}
    return left.select(*(new[f.name].cast(f.dataType).alias(f.name) if f.name in new else F.col("_row")[f.name].alias(f.name) for f in documents.schema.fields))
