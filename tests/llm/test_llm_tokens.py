"""Token files and byte-level BPE beside the public libraries."""

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from llm_data import SF, empty, messy, messy_rows, needs_tables, rng, texts_of
from retailflow.llm import bpe, queries, token_file

TOKENIZER = queries.tokenizer_file("word_bpe_49k.json")
RANKS, PATTERN = queries.tokenizer_file("byte_bpe_multi_50k.tiktoken"), queries.tokenizer_pattern()


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def byte_tokenizer():
    import tiktoken
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(st.lists(st.integers(0, 2 ** 17 - 1), max_size=400), st.integers(17, 32), st.data())
@settings(max_examples=60, deadline=None)
def test_packed_ids_come_back_from_any_place(ids, bits, data):
    packed = token_file.pack(np.array(ids, np.uint32), bits)
    lo = data.draw(st.integers(0, len(ids)))
    hi = data.draw(st.integers(lo, len(ids)))
    assert token_file.unpack(packed, bits, lo, hi).tolist() == ids[lo:hi]
    assert len(packed) == -(-len(ids) // 64) * bits * 8


def test_width():
    assert [token_file.width(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


@given(st.binary(max_size=300), st.binary(max_size=300))
@settings(max_examples=60, deadline=None)
def test_crc32_of_joined_parts(a, b):
    assert token_file.combine_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_pieces_encode_as_the_whole_text(text):
    table = token_file.pieces(TOKENIZER)
    assert table.encode(text) == table.whole(text)


#: Special tokens whole, glued and torn, letters that grow when lowered, marks beside them, contractions, combining marks.
AWKWARD = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "endoftext", "İ", "İ.", ".", ",", "ß", "ŉ", "ª", "²", "½", "'s", "'LL", "'", "e\u0301", "\u0307", "ǅ", "ﬁ", "Ω", "A", "z", "9", "_", "*",
           " ", "\n", "\u0085", "\u00a0", "\u200b", "\x1c", "\x00", "é", "Ÿ", "好", "\U0001f600"]


@given(st.lists(st.sampled_from(AWKWARD) | st.characters(max_codepoint=0x24F) | st.characters(), max_size=14).map("".join))
@settings(max_examples=1500, deadline=None)
def test_awkward_pieces_encode_as_the_whole_text(text):
    table = token_file.pieces(TOKENIZER)
    assert table.encode(text) == table.whole(text)


def test_halves_of_characters_are_replaced():
    table = token_file.pieces(TOKENIZER)
    for text in ("\ud800", "a\udfff b", "好\ud83d"):
        assert table.encode(text) == table.whole(text) == table.whole(text.encode("utf-16", "surrogatepass").decode("utf-16", "replace"))


def test_special_tokens_are_themselves(word_tokenizer):
    assert word_tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == np.frombuffer(token_file.pieces(TOKENIZER).encode("a <|endoftext|> b"), "<u4").tolist()
    assert len(token_file.pieces(TOKENIZER).encode("a <|endoftext|> b")) == 12


def test_known_pieces_start_anew(monkeypatch):
    monkeypatch.setattr(token_file, "KNOWN_BYTES", 3000)
    table = token_file.Pieces(TOKENIZER)
    texts = [f"Word{chr(97 + i % 26)} über{chr(97 + i % 7)}, x{i}" for i in range(200)]
    assert all(table.encode(t) == table.whole(t) for t in texts) and len(table.words) < 30
    ids, n = table.encode_all(__import__('pyarrow').array([*texts, None, '', 'a\x1cb']))
    assert ids.astype('<u4').tobytes() == b''.join(table.whole(t) for t in [*texts, 'a\x1cb']) and n[-3:-1].tolist() == [0, 0]


def test_pieces_of_texts_before_are_not_encoded_again():
    table, sent = token_file.Pieces(TOKENIZER), []
    library = table.whole
    table.whole = lambda text: sent.append(text) or library(text)
    first = pa.array(["好 Word, été", "Ω 好 word"])
    ids = [table.encode_all(texts) for texts in (first, pa.array(["word 好", None, "Ω"]), first)]
    assert sorted(sent) == ["Ω", "好"]
    assert ids[0][0].tolist() == ids[2][0].tolist() and ids[1][1].tolist()[1] == 0


def test_small_tables_change_no_ids(monkeypatch):
    """Pieces that came once go, the rest stay, and when these are too many as well the table starts anew."""
    monkeypatch.setattr(token_file, "KNOWN_BYTES", 3000)
    monkeypatch.setattr(token_file, "PORTION", 3)
    words = ["the", "The,", "don't", "好", "<|endoftext|>", "x9", "über", "a\u0301", "İ.", "²"] + [f"w{chr(97 + i)}{chr(98 + i % 5)};" for i in range(20)]
    for room in (0, 400, 1500, 1 << 20):
        monkeypatch.setattr(token_file, "PIECES_BYTES", room)
        table = token_file.Pieces(TOKENIZER)
        for i in range(60):
            texts = [" ".join(rng.choice(words if j % 2 else words[:6]) for _ in range(rng.randint(0, 9))) for j in range(4)]
            ids, n = table.encode_all(pa.array([*texts, None]))
            want = [table.whole(t) for t in texts]
            assert ids.astype("<u4").tobytes() == b"".join(want) and n.tolist() == [*(len(w) // 4 for w in want), 0]
            assert len(table.known) == len(set(table.known.to_pylist())) == len(table.start) == len(table.size) == len(table.used)


def test_documents_of_many_blocks(spark, word_tokenizer, tmp_path, monkeypatch):
    """Segments of a document over many blocks, and blocks of many documents, join to the crc32 of all its ids."""
    monkeypatch.setattr(token_file, "BLOCK", 70)
    rows = [(i, " ".join(f"word{k % 7} x" for k in range(40 * (i % 5)))) for i in range(30)]
    path = str(tmp_path / "tokens")
    token_file.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, TOKENIZER)
    assert sorted(tuple(r) for r in token_file.digests(spark, path).collect()) == [w[:4] for w in expected_files(rows, word_tokenizer)]


def expected_files(rows, tokenizer, end=1):
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        yield doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()
        start += len(ids)


def test_token_files_of_awkward_rows(spark, word_tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK", 1000)  # long documents span blocks
    path = str(tmp_path / "tokens")
    token_file.write_tokens(messy(spark), path, TOKENIZER)
    want = sorted(expected_files([(r[0], r[1]) for r in messy_rows()], word_tokenizer), key=repr)
    assert sorted((tuple(r) for r in token_file.digests(spark, path).collect()), key=repr) == [w[:4] for w in want]
    assert sorted(((r.doc_id, r.start, r.n_tokens, list(r.ids)) for r in token_file.read_ids(spark, path).collect()), key=repr) == \
        sorted(((w[0], w[1], w[2], w[4]) for w in want), key=repr)


def test_token_files_of_no_rows(spark):
    assert token_file.tokens_of(spark, empty(spark), TOKENIZER).collect() == []


@needs_tables
def test_op1(spark, word_tokenizer):
    got = sorted(tuple(r) for r in queries.op1(spark, SF).collect())
    assert got == sorted(w[:4] for w in expected_files(texts_of(spark), word_tokenizer))


@given(st.lists(st.integers(0, 50_255), max_size=60), st.lists(st.integers(0, 50_255), max_size=30))
@settings(max_examples=100, deadline=None)
def test_bitmap_finds_the_least(add, drop):
    bitmap, have = bpe.Bitmap(50_256), set()
    for i in add:
        bitmap.add(i)
        have.add(i)
    for i in drop:
        if i in have:
            bitmap.discard(i)
            have.discard(i)
        assert bitmap.first() == min(have, default=-1)


@given(st.text(alphabet=st.one_of(st.sampled_from("ab ab' \n\t'sS1.,-éß  \x1c\x85"), st.characters()), max_size=120))
@settings(max_examples=400, deadline=None)
def test_bpe_equals_the_library(text):
    own = bpe.encoder(RANKS, PATTERN)
    import tiktoken
    lib = test_bpe_equals_the_library.__dict__.setdefault("lib", tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.vocabulary.ranks, special_tokens={}))
    try:
        raw = text.encode()
    except UnicodeEncodeError:
        return
    got = np.frombuffer(own.encode_batch([text])[0], "<u4")
    assert got.tolist() == lib.encode_ordinary(text)
    assert own.vocabulary.decode(got) == raw


def test_one_queue_and_a_queue_of_its_own_agree(byte_tokenizer):
    own = bpe.encoder(RANKS, PATTERN)
    tokens = [bytes(rng.choice(b"aabcdest ") for _ in range(rng.randint(1, 60))) for _ in range(500)] + [b"a" * 300, "éè".encode() * 70]
    for t, ids in zip(tokens, bpe.merge_many(own.vocabulary, tokens)):
        assert ids.tolist() == bpe.merge_long(own.vocabulary, t)


def test_very_long_pre_tokens(byte_tokenizer):
    own = bpe.encoder(RANKS, PATTERN)
    for text in ("a" * 20_000, "abcde" * 5_000, "".join(rng.choice("etaoin") for _ in range(20_000)), " " * 5_000):
        assert np.frombuffer(own.encode_batch([text])[0], "<u4").tolist() == byte_tokenizer.encode_ordinary(text)


def digests(rows, lib):
    for doc_id, text in rows:
        ids = np.array(lib.encode_ordinary(text or ""), "<u4")
        yield doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_round_trip_of_awkward_rows(spark, byte_tokenizer):
    want = sorted(digests([(r[0], r[1]) for r in messy_rows()], byte_tokenizer), key=repr)
    assert sorted((tuple(r) for r in bpe.round_trip(messy(spark), RANKS, PATTERN).collect()), key=repr) == want
    assert bpe.round_trip(empty(spark), RANKS, PATTERN, with_ids=True).collect() == []
    encoded = bpe.encode(messy(spark), RANKS, PATTERN)
    back = bpe.decode(encoded, RANKS, PATTERN)
    assert sorted(((r.doc_id, bytes(r.content)) for r in back.collect()), key=repr) == sorted(((r[0], (r[1] or "").encode()) for r in messy_rows()), key=repr)


@needs_tables
def test_op9(spark, byte_tokenizer):
    assert sorted(tuple(r) for r in queries.op9(spark, SF).collect()) == sorted(digests(texts_of(spark), byte_tokenizer))


def test_equal_pieces_of_a_batch_are_held_once():
    """A worker holds the words of a batch as often as they differ, not as often as they occur."""
    import tracemalloc
    own = bpe.encoder(RANKS, PATTERN)
    texts = [" surroundings" * 2000] * 100
    own.encode_batch(texts[:1])
    tracemalloc.start()
    try:
        ids = own.encode_batch(texts)
        assert tracemalloc.get_traced_memory()[1] < 6e6  # 13 MB as a string per word
    finally:
        tracemalloc.stop()
    assert len(set(ids)) == 1


def test_batches_that_reach_a_worker_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        df = spark.range(40).selectExpr("id AS doc_id", "repeat('ab c ', 100000) AS text").coalesce(1)
        assert bpe.round_trip(df, RANKS, PATTERN).select("decoded_sha256").distinct().count() == 1
        held = df.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in bs), "n long").collect()
        assert max(r.n for r in held) < 10e6 and sum(r.n for r in held) > 20e6 - 1e6
    finally:
        spark.conf.set(key, before)
