"""Byte-level BPE encoding and decoding with a rank queue over a hierarchical bitmap.

Merging always takes the adjacent pair of lowest rank, the leftmost of equals.  Pairs wait in buckets, one per
rank, that hold positions of a doubly linked list of parts; a bitmap of three levels of 64-bit words marks the
buckets that are not empty, so find-first-set in three words gives the next rank.  A merge does not search the
queue for the pairs it ends: their entries are stale (the position's current rank differs) and skipped when met.
Every merge costs constant time, also in a pre-token of a million bytes.

Pre-tokens are independent, so all new pre-tokens of a batch share one list and one queue: one step takes a bucket
and merges, with numpy, the leftmost valid entry of every pre-token in it; further entries of a pre-token wait for
the next step, because the merge may have made a pair of lower rank there.  A very long pre-token has a queue of
its own (``merge_long``).

Cases.  Null text is the empty text: no ids, empty bytes.  Repeated rows, null ids and ties keep their rows, other
columns are not read, an empty table stays empty.  Text is whole, of any length.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ready, tidy

#: Pre-tokens of more bytes get a queue of their own.
LONG = 400
#: Entries of a worker's table of encoded pieces; beyond it the table starts anew.  No result depends on it.
KNOWN_PIECES = 200_000

# A piece: white space and what follows up to the next white space.  No pre-token begins in one piece and ends in the next.
_PIECE = re.compile(r"\s*\S+|\s+")


class Bitmap:
    """Set of small whole numbers with find-first-set over three levels of 64-bit words."""

    def __init__(self, size: int):
        self.low = [0] * (-(-size // 64))
        self.mid = [0] * (-(-len(self.low) // 64))
        self.top = 0

    def add(self, i: int) -> None:
        self.low[i >> 6] |= 1 << (i & 63)
        self.mid[i >> 12] |= 1 << (i >> 6 & 63)
        self.top |= 1 << (i >> 12)

    def discard(self, i: int) -> None:
        self.low[i >> 6] &= ~(1 << (i & 63))
        if not self.low[i >> 6]:
            self.mid[i >> 12] &= ~(1 << (i >> 6 & 63))
            if not self.mid[i >> 12]:
                self.top &= ~(1 << (i >> 12))

    def first(self) -> int:
        """Smallest member, -1 if there is none."""
        if not self.top:
            return -1
        t = (self.top & -self.top).bit_length() - 1
        m = t << 6 | ((w := self.mid[t]) & -w).bit_length() - 1
        return m << 6 | ((w := self.low[m]) & -w).bit_length() - 1


class Vocabulary:
    """Ranks of byte strings, the rank of every pair of parts that joins to one, and the bytes of every id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.size = max(self.ranks.values()) + 1
        self.bytes = [b""] * self.size
        for b, r in self.ranks.items():
            self.bytes[r] = b
        self.pairs: dict[tuple[int, int], int] = {}
        for b, r in self.ranks.items():
            for cut in range(1, len(b)):
                left, right = self.ranks.get(b[:cut]), self.ranks.get(b[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = r
        keys = np.array([a * self.size + b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], np.array(list(self.pairs.values()), np.int32)[order]
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.joined = np.frombuffer(b"".join(self.bytes), np.uint8)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the two parts don't join."""
        want = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.key_ranks[at], np.int32(-1))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, a million ids at a time."""
        out = []
        for i in range(0, len(ids), 1 << 20):
            some = ids[i: i + (1 << 20)]
            n = self.lengths[some]
            ends = np.cumsum(n)
            out.append(self.joined[np.repeat(self.starts[some] - ends + n, n) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


def merge_long(vocabulary: Vocabulary, token: bytes) -> list[int]:
    """Ids of one pre-token by a queue of its own."""
    pairs, n = vocabulary.pairs, len(token)
    part = vocabulary.byte_ids[np.frombuffer(token, np.uint8)].tolist()
    after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
    rank = [pairs.get((part[i], part[i + 1]), -1) for i in range(n - 1)] + [-1]
    buckets: dict[int, list[int]] = {}
    waiting = Bitmap(vocabulary.size)

    def push(r, i):
        if r not in buckets:
            buckets[r] = []
            waiting.add(r)
        heapq.heappush(buckets[r], i)

    for i, r in enumerate(rank):
        if r >= 0:
            if r not in buckets:
                buckets[r] = []
                waiting.add(r)
            buckets[r].append(i)  # ascending, hence a heap
    while (r := waiting.first()) >= 0:
        bucket = buckets[r]
        i = heapq.heappop(bucket)
        if not bucket:
            del buckets[r]
            waiting.discard(r)
        if rank[i] != r:
            continue  # stale
        j = after[i]
        part[i], rank[j] = r, -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
        rank[i] = pairs.get((r, part[k]), -1) if k >= 0 else -1
        if rank[i] >= 0:
            push(rank[i], i)
        if (h := before[i]) >= 0:
            rank[h] = pairs.get((part[h], r), -1)
            if rank[h] >= 0:
                push(rank[h], h)
    out, i = [], 0
    while i >= 0:
        out.append(part[i])
        i = after[i]
    return out


def merge_many(vocabulary: Vocabulary, tokens: list[bytes]) -> list[np.ndarray]:
    """Ids of every pre-token (none empty), all merged in one queue."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    ends = np.cumsum(sizes)
    n = int(ends[-1])
    part = vocabulary.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
    token = np.repeat(np.arange(len(tokens)), sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1] = -1
    before[ends - sizes] = -1
    rank = np.full(n, -1, np.int32)
    inner = np.flatnonzero(after >= 0)
    rank[inner] = vocabulary.pair_ranks(part[inner], part[inner + 1])
    alive = np.ones(n, bool)
    buckets: dict[int, list[np.ndarray]] = {}
    waiting = Bitmap(vocabulary.size)

    def push(at: np.ndarray) -> None:
        at = at[rank[at] >= 0]
        if not len(at):
            return
        r = rank[at]
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        lows = [0, *cuts.tolist()]
        for lo, hi, x in zip(lows, [*lows[1:], len(r)], r[lows].tolist()):
            if x in buckets:
                buckets[x].append(at[lo:hi])
            else:
                buckets[x] = [at[lo:hi]]
                waiting.add(x)

    push(inner)
    while (r := waiting.first()) >= 0:
        held = buckets.pop(r)
        at = np.unique(np.concatenate(held)) if len(held) > 1 else held[0]
        at = at[rank[at] == r]  # the rest is stale
        if len(at) > 1:
            first = np.empty(len(at), bool)
            first[0] = True
            np.not_equal(token[at[1:]], token[at[:-1]], out=first[1:])
            if first.all():
                waiting.discard(r)
            else:
                buckets[r] = [at[~first]]
                at = at[first]
        else:
            waiting.discard(r)
            if not len(at):
                continue
        gone = after[at]
        alive[gone] = False
        rank[gone] = -1
        part[at] = r
        after[at] = behind = after[gone]
        has = behind >= 0
        rank[at] = -1
        left, right = at[has], behind[has]
        before[right] = left
        rank[left] = vocabulary.pair_ranks(part[left], part[right])
        ahead = before[at]
        has = ahead >= 0
        there = ahead[has]
        rank[there] = vocabulary.pair_ranks(part[there], part[at[has]])
        push(np.concatenate([left, there]))
    ids = part[alive].astype("<u4")
    kept = np.add.reduceat(alive, ends - sizes, dtype=np.int64)
    return np.split(ids, np.cumsum(kept)[:-1])


class Encoder:
    """Texts to ids; remembers the ids of pieces it has met."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def tokens(self, pre_tokens: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian unsigned 32-bit integers."""
        whole = self.vocabulary.ranks
        short = [t for t in pre_tokens if t not in whole and len(t) <= LONG]
        merged = iter(merge_many(self.vocabulary, short) if short else ())
        return [np.array([whole[t]], "<u4").tobytes() if t in whole else
                next(merged).tobytes() if len(t) <= LONG else
                np.array(merge_long(self.vocabulary, t), "<u4").tobytes() for t in pre_tokens]

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces and remember them."""
        split = {p: [t.encode() for t in self.split(p)] for p in pieces}
        distinct = list({t for ts in split.values() for t in ts})
        ids = dict(zip(distinct, self.tokens(distinct)))
        for p, ts in split.items():
            self.known[p] = b"".join([ids[t] for t in ts])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        # four control characters are white space to Python and not to the pattern; such texts are one piece
        seen: dict[str, str] = {}
        cut = []
        for t in texts:
            ps = _PIECE.findall(t) if not any(c in t for c in "\x1c\x1d\x1e\x1f") else [t] if t else []
            cut.append(list(map(seen.setdefault, ps, ps)))  # equal pieces are one string while the batch is held
        if len(self.known) + len(seen) > KNOWN_PIECES:
            self.known.clear()
        new = seen.keys() - self.known.keys()
        del seen
        self.learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, ps)) for ps in cut]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder of a rank file."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


#: Bytes of text encoded at once in a task.
AT_ONCE = 4 << 20


def _texts(batch: pa.RecordBatch, column: int, at_once: int | None = None):
    """Slices of the column of about ``at_once`` (AT_ONCE) bytes, as lists of texts."""
    texts, size, lo = batch.column(column), 0, 0
    for i in range(len(texts)):
        size += len(texts[i].as_buffer()) if texts[i].is_valid else 0
        if size >= (at_once or AT_ONCE):
            yield lo, i + 1, [t or "" for t in texts[lo: i + 1].to_pylist()]
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts), [t or "" for t in texts[lo:].to_pylist()]


def encode(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and the ids of the whole text; no shuffle."""
    def run(batches):
        for batch in batches:
            for lo, hi, texts in _texts(batch, 1):
                raw = encoder(ranks, pattern).encode_batch(texts)
                ids = [np.frombuffer(r, "<u4").astype(np.int32) for r in raw]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    ready(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of the ids; no shuffle."""
    def run(batches):
        for batch in batches:
            vocabulary = encoder(ranks, pattern).vocabulary
            lists = batch.column(1)
            out = [vocabulary.decode(np.asarray(x.values)) if x.is_valid and len(x) else b"" for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "content"])
    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, content binary")


def round_trip(documents: DataFrame, ranks: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, number of ids, sha256 of the ids (little-endian unsigned 32-bit) and of the bytes they decode to; the ids, if asked for."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches):
        for batch in batches:
            for lo, hi, texts in _texts(batch, 1, AT_ONCE // 2 if with_ids else None):  # ids are held and written too
                own = encoder(ranks, pattern)
                raw = own.encode_batch(texts)
                back = [hashlib.sha256(own.vocabulary.decode(np.frombuffer(r, "<u4")) if r else b"").hexdigest() for r in raw]
                out = [batch.column(0).slice(lo, hi - lo), pa.array([len(r) // 4 for r in raw], pa.int64()),
                       pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()), pa.array(back, pa.string())]
                if with_ids:
                    ends = np.cumsum([0, *(len(r) // 4 for r in raw)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<i4"))))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(out)])

    ready(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), schema)
