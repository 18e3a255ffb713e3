"""Token-ID / binary output: token ids of whole documents, bit-packed at fixed width, in files ordered by document.

File format.  A Parquet folder whose rows are blocks of at most ``BLOCK`` ids.  A block's ``payload`` holds its
ids at the smallest width that fits the vocabulary: 64 ids take ``bits`` little-endian 64-bit words, the id in
lane j starts at bit j * bits of its group.  The place of any id follows from its number by arithmetic, so a
reader unpacks whole groups with numpy or picks single ids.  ``docs`` lists the documents that overlap the block
with their first id and length, both counted in the shard.  Shards (range partitions of doc_id) follow
``doc_id``; a shard's first id in the corpus is the sum of the shards before it.

Cases.  Null text is the empty text, a document always has the end id, so every row owns ids.  The text of a special token
is that token, as in the library's own state.  Null doc_ids come first, rows of one doc_id (however many, in as many shards as they need) follow
a hash of their texts, repeated rows stay rows.  A document longer than a
block spans several.  Other columns are not read.  An empty table makes no blocks and reads back as no rows.
"""

from __future__ import annotations

import codecs
import functools
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import ready, shared_folder, tidy

BLOCK = 65_536
#: Bytes of text encoded together.
SLICE = 4 << 20
#: Bytes of a worker's table of encoded words (``ENTRY`` is what an entry takes besides its text and ids); beyond it the
#: older half goes.  No result depends on it.
KNOWN_BYTES = 96 << 20
ENTRY = 200
#: Bytes of a worker's table of numbered pieces; beyond it those go that came in one slice only.  No result depends on it.
PIECES_BYTES = 12 << 20
#: Pieces split or laid out together.
PORTION = 8_192

LATIN_END = 0x250
#: Pieces that the tokenizer encodes itself: beyond Latin script, or perhaps with a special token.
ODD = f"[^\\x00-\\x{{{LATIN_END - 1:x}}}]|<\\|"


def _lowered(category: str) -> str:
    """Characters of a general category that Latin text has after lowering, some of them beyond ``LATIN_END``."""
    return "".join(sorted(c for c in {c for i in range(LATIN_END) for c in chr(i).lower()} if unicodedata.category(c).startswith(category)))


#: The tokenizer's pattern, for lowered pieces of Latin script that a line end follows.
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^\n{0}{1}]+|\n".format(_lowered("L"), _lowered("N")))
#: Halves of characters, which Python's strings can hold and no table's text can.
SURROGATE = re.compile("[\ud800-\udfff]")
#: What stands for the line end between ids.
MARK = 0xFFFFFFFF
#: Bytes as letters, as byte-level tokenizers write them: printable ones are themselves, the rest follow from 256 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = "".join(chr(b if b in _PLAIN else 256 + b - sum(p < b for p in _PLAIN)) for b in range(256))

BLOCK_SCHEMA = ("shard int, block int, first_id long, n_ids int, bits int, payload binary, "
                "docs array<struct<doc_id: long, first_id: long, n_ids: long>>")


# Packing

def width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    groups = -(-len(ids) // 64)
    lanes = np.zeros(groups * 64, "<u8")
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(groups, 64)
    words = np.zeros((groups, bits), "<u8")
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of a payload; touches only the groups they lie in."""
    first, last = start // 64, -(-stop // 64)
    words = np.frombuffer(payload, "<u8")[first * bits: last * bits].reshape(-1, bits)
    mask = np.uint64((1 << bits) - 1)
    lanes = np.empty((len(words), 64), "<u8")
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        got = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            got = got | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, lane] = got & mask
    return lanes.reshape(-1)[start - first * 64: stop - first * 64].astype("<u4")


# Encoding

class Pieces:
    """Token ids of text, by way of its distinct pieces.

    The tokenizer drops white space and never looks across it, so a text's ids are those of its pieces.  The pieces of many texts are
    found and numbered by Arrow, together with those known from texts before, so that only new ones are encoded, and numpy lays the
    ids out.  New pieces of Latin script are lowered and split in portions by the tokenizer's own pattern, and words not met before
    reach the model as they are; normaliser and splitter are left out for them.  All else, and what may hold a special token, goes
    through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.words: dict[str, bytes] = {}
        self.held = 0
        self.start_anew()

    def whole(self, text: str) -> bytes:
        if not text.isascii():
            text = SURROGATE.sub("\ufffd", text)
        return _raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    # Words

    def learn(self, found: list[str]) -> None:
        """Encode those of the lowered pre-tokens that are not remembered, and remember them; line ends are the ``MARK``."""
        if self.held > KNOWN_BYTES:
            self.words = dict(islice(self.words.items(), len(self.words) // 2, None))
            self.held = sum(map(len, self.words)) + sum(map(len, self.words.values())) + ENTRY * len(self.words)
        new = list(set(found).difference(self.words, "\n"))
        if new:
            spelt = codecs.charmap_decode("\n".join(new).encode(), "strict", BYTE_LETTERS)[0].split(BYTE_LETTERS[ord("\n")])
            raws = [_raw([t.id for t in tokens]) for tokens in map(self.model.tokenize, spelt)]
            self.words.update(zip(new, raws))
            self.held += sum(map(len, new)) + sum(map(len, raws)) + ENTRY * len(new)
        self.words["\n"] = _raw([MARK])

    # Pieces

    def start_anew(self) -> None:
        """No piece is known.  ``ids[start:start + size]`` are those of the piece in the same place of ``known``, ``used`` counts its slices."""
        self.known = pa.array([], pa.large_string())
        self.start, self.size, self.used = (np.empty(0, np.int64) for _ in range(3))
        self.ids = np.empty(0, np.uint32)

    def full(self) -> bool:
        return sum(x.nbytes for x in (self.known, self.start, self.size, self.used, self.ids)) > PIECES_BYTES

    def make_room(self) -> None:
        """Keep the pieces that came again."""
        keep = np.flatnonzero(self.used > 1)
        ids, ends = self.laid_out(keep)
        self.known = self.known.take(pa.array(keep))
        self.start, self.size, self.ids, self.used = ends[:-1], self.size[keep], ids, np.zeros(len(keep), np.int64)
        if self.full():
            self.start_anew()

    def laid_out(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in these places one after the other, and where each begins, with the end of all."""
        ends = np.zeros(len(at) + 1, np.int64)
        np.cumsum(self.size[at], out=ends[1:])
        ids = np.empty(ends[-1], np.uint32)
        for lo in range(0, len(at), PORTION):
            some, to = at[lo:lo + PORTION], ends[lo:lo + PORTION + 1]
            ids[to[0]:to[-1]] = self.ids[np.arange(to[0], to[-1]) + np.repeat(self.start[some] - to[:-1], self.size[some])]
        return ids, ends

    def add(self, pieces: pa.Array) -> None:
        """Encode new pieces: ids of those of Latin script first, then of the odd ones."""
        odd = pc.match_substring_regex(pieces, ODD)
        latin = pieces.filter(pc.invert(odd))
        ids, sizes = [], []
        for lo in range(0, len(latin), PORTION):
            portion = latin.slice(lo, PORTION).cast(pa.string())
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(portion)], pa.int32()), portion), "\n")[0].as_py()
            found = SPLIT.findall(text.lower() + "\n")
            self.learn(found)
            got = np.frombuffer(b"".join(map(self.words.__getitem__, found)), "<u4")
            mark = got == MARK
            ids.append(got[~mark])
            sizes.append(np.diff(np.flatnonzero(mark), prepend=-1) - 1)
        raws = list(map(self.whole, pieces.filter(odd).to_pylist()))
        ids.append(np.frombuffer(b"".join(raws), "<u4"))
        sizes.append(np.array([len(r) // 4 for r in raws], np.int64))
        place = len(self.size) + np.argsort(np.asarray(odd), kind="stable")
        size, ends = np.concatenate(sizes), len(self.ids) + np.cumsum(np.concatenate(sizes))
        self.start, self.size, self.used = (np.concatenate([x, np.zeros(len(pieces), np.int64)]) for x in (self.start, self.size, self.used))
        self.start[place], self.size[place] = ends - size, size
        self.ids = np.concatenate([self.ids, *ids])

    def numbered(self, pieces: pa.Array) -> np.ndarray:
        """The places of all pieces in the table, which has them all then."""
        if self.full():
            self.make_room()
        had = len(self.known)
        coded = pa.concat_arrays([self.known, pieces]).dictionary_encode()
        if len(coded.dictionary) > had:
            self.add(coded.dictionary.slice(had))
            self.known = coded.dictionary
        at = np.asarray(coded.indices.slice(had))
        self.used += np.bincount(at, minlength=len(self.used)) > 0
        return at

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (nulls are empty) one after the other, and how many each has."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")  # the table and the pieces of a slice may pass 2 GB together
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():  # the splitter's white space, not the tokenizer's
            raws = [self.whole(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(raws), "<u4"), np.array([len(r) // 4 for r in raws], np.int64)
        split = pc.utf8_split_whitespace(texts)
        ids, ends = self.laid_out(self.numbered(split.flatten()))
        places = np.asarray(split.offsets, np.int64)
        places -= places[0]
        return ids, ends[places[1:]] - ends[places[:-1]]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([SURROGATE.sub("\ufffd", text)], pa.string()))[0].astype("<u4").tobytes()


@functools.cache
def _packer(size: int) -> struct.Struct:
    return struct.Struct(f"<{size}I")


def _raw(ids: list[int]) -> bytes:
    return _packer(len(ids)).pack(*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}I", *ids)


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's tokenizer with its table of known pieces."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def _encoded(table: Pieces, batch: pa.RecordBatch, end: bytes) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids and the end id) of each row; about ``SLICE`` bytes of text are encoded together."""
    texts = batch.column(1)
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    slices = np.cumsum(sizes) // SLICE
    for lo, hi in zip(first := np.flatnonzero(np.diff(slices, prepend=-1)), [*first[1:], len(texts)]):
        ids, n = table.encode_all(texts.slice(lo, hi - lo))
        raw, ends = ids.astype("<u4").tobytes(), 4 * np.concatenate([[0], np.cumsum(n)])
        for i, doc_id in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
            yield doc_id, raw[ends[i]:ends[i + 1]] + end


def _blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        bits = width(max(table.vocabulary, end_id + 1))
        end = np.array([end_id], "<u4").tobytes()
        shard = TaskContext.get().partitionId()
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()),
                            ("bits", pa.int32()), ("payload", pa.binary()),
                            ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64())])))])
        held, docs, first, block, seen = bytearray(), [], 0, 0, 0  # raw ids from id ``first`` on, documents among them

        def row(size: int):
            ids = np.frombuffer(bytes(held[: 4 * size]), "<u4")
            return pa.RecordBatch.from_pylist([{"shard": shard, "block": block, "first_id": first, "n_ids": size, "bits": bits,
                                                "payload": pack(ids, bits), "docs": [d for d in docs if d["first_id"] < first + size]}], schema)

        for batch in batches:
            for doc_id, raw in _encoded(table, batch, end):
                docs.append({"doc_id": doc_id, "first_id": seen, "n_ids": len(raw) // 4})
                seen += len(raw) // 4
                held += raw
                while len(held) >= 4 * BLOCK:
                    yield row(BLOCK)
                    del held[: 4 * BLOCK]
                    first, block = first + BLOCK, block + 1
                    docs = [d for d in docs if d["first_id"] + d["n_ids"] > first]
        if held:
            yield row(len(held) // 4)

    return run


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Encode ``documents`` (doc_id, text) and write the files to ``path``.  One shuffle, of the texts, by ranges of doc_id."""
    ready(documents.sparkSession)
    ordered = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .withColumn("text_hash", F.xxhash64("text")).repartitionByRange("doc_id", "text_hash")  # rows of one id are many ranges too
               .sortWithinPartitions("doc_id", "text_hash", "text").select("doc_id", "text"))
    ordered.mapInArrow(tidy(_blocks(tokenizer, end_id)), BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)


# Reading

def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return ready(spark).read.schema(BLOCK_SCHEMA).parquet(path)


def _segments(fn, kind: pa.DataType):
    """Per block and document: the document's place and ``fn`` of its ids in the block."""
    def run(batches):
        for batch in batches:
            docs = batch.column("docs")
            row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(docs)))
            doc_id, first, n = (pc.struct_field(docs.flatten(), name) for name in ("doc_id", "first_id", "n_ids"))
            start, size = (np.asarray(batch.column(name), np.int64) for name in ("first_id", "n_ids"))
            lo = np.maximum(first, start[row])
            hi = np.minimum(np.add(first, n), (start + size)[row])
            values, now = [], -1
            for k, a, b in zip(row.tolist(), (lo - start[row]).tolist(), (hi - start[row]).tolist()):
                if k != now:
                    ids, now = unpack(batch.column("payload")[k].as_py(), batch.column("bits")[k].as_py(), 0, int(size[k])), k
                values.append(fn(ids[a:b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard").take(pa.array(row)), doc_id, first, n, pa.array(lo - np.asarray(first)), pa.array(hi - lo), pa.array(values, kind)],
                ["shard", "doc_id", "first_id", "n_ids", "at", "size", "value"])
    return run


def _documents(blocks: DataFrame, fn, kind: pa.DataType, sql_kind: str) -> DataFrame:
    """One row per document: its first id in the corpus and its segments in order."""
    parts = blocks.mapInArrow(tidy(_segments(fn, kind)), "shard int, doc_id long, first_id long, n_ids long, at long, size long, value " + sql_kind)
    docs = parts.groupBy("shard", "first_id").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_ids").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("at", "size", "value"))).alias("segments"))
    # one row per shard
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    return docs.join(before, "shard").withColumn("start", F.col("before") + F.col("first_id"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids of every document."""
    docs = _documents(read_blocks(spark, path), lambda ids: ids.astype("<i8").tolist(), pa.list_(pa.int64()), "array<long>")
    return docs.select("doc_id", "start", "n_tokens", F.flatten(F.col("segments.value")).alias("ids"))


def _apply(matrix: list[int], value: int) -> int:
    out, i = 0, 0
    while value:
        if value & 1:
            out ^= matrix[i]
        value, i = value >> 1, i + 1
    return out


@functools.cache
def _zeros(power: int) -> list[int]:
    """What 2 ** ``power`` zero bits do to a crc32, as a matrix."""
    if power == 0:
        return [0xEDB88320] + [1 << i for i in range(31)]
    half = _zeros(power - 1)
    return [_apply(half, x) for x in half]


def combine_crc32(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings joined, from theirs and the second's length: shift the first by ``size`` zero bytes."""
    for i in range(size.bit_length()):
        if size >> i & 1:
            first = _apply(_zeros(i + 3), first)
    return first ^ second


def _joined_crc(batches):
    for batch in batches:
        segments = batch.column("segments")
        places = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(segments), np.int64))])
        sizes, values = (np.asarray(pc.struct_field(segments.flatten(), name)) for name in ("size", "value"))
        out = values[places[:-1]]
        for i in np.flatnonzero(np.diff(places) > 1).tolist():
            crc = int(out[i])
            for k in range(places[i] + 1, places[i + 1]):
                crc = combine_crc32(crc, int(values[k]), 4 * int(sizes[k]))
            out[i] = crc
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(out, pa.int64())],
                                         ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of a document's ids as little-endian unsigned 32-bit integers, from the files."""
    docs = _documents(read_blocks(spark, path), lambda ids: zlib.crc32(ids.tobytes()), pa.int64(), "long")
    return docs.select("doc_id", "start", "n_tokens", "segments").mapInArrow(tidy(_joined_crc), "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_of(spark: SparkSession, documents: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the files to a new shared folder and return the digests read back from them."""
    path = shared_folder(spark, "tokens")
    write_tokens(documents, path, tokenizer, end_id)
    return digests(spark, path)
