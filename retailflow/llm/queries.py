"""The operators of this package as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, graph_search, html_text, language, mixing, near_dup, private_data, sharding, spelling, suffix_dedup, token_file,
               topk_search, vector_codes)
from .shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@query("op1_token_file")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.tokens_of(spark, table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op2_suffix_dedup", r"""
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
bytes AS (SELECT doc_id, raw, octet_length(raw)::BIGINT AS n FROM docs),
windows AS (SELECT doc_id, i, raw[i + 1:i + 200] AS x FROM (SELECT doc_id, raw, unnest(range(0, n - 199)) AS i FROM bytes)),
often AS (SELECT x FROM windows GROUP BY x HAVING count(*) > 1),
starts AS (SELECT doc_id, i, i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) > 200 AS is_new FROM windows JOIN often USING (x)),
numbered AS (SELECT doc_id, i, sum(is_new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts),
runs AS (SELECT doc_id, run, min(i) AS lo, max(i) + 200 AS hi FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS a, lo AS b FROM runs
  UNION ALL SELECT bytes.doc_id, coalesce(max(hi), 0), any_value(n) FROM bytes LEFT JOIN runs USING (doc_id) GROUP BY bytes.doc_id),
kept AS (SELECT doc_id, string_agg(hex(raw[a + 1:b]), '' ORDER BY a) AS h FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id),
totals AS (SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM bytes LEFT JOIN totals USING (doc_id) JOIN kept USING (doc_id)
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


@query("op3_graph_neighbours")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


@query("op4_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language.remainder(F.col("doc_id")) == 0
    model = language.learn(docs.where(~held_out))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")


SHARDS = [f"shard-{i:03d}" for i in range(64)]


@query("op5_lookup_table_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"), SHARDS)


@query("op6_source_mix")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op7_near_duplicates", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(list_zip(w[:-2], w[2:]), lambda z: z[1] || ' ' || z[2]) END)) AS s FROM words),
classes AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT node, n, unnest(s) AS x FROM classes),
links AS (
  SELECT a.node AS a, b.node AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT node, node AS least FROM classes UNION SELECT ways.b, reach.least FROM reach JOIN ways ON ways.a = reach.node),
found AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(found.component_id, sets.doc_id) AS component_id, sets.doc_id = coalesce(found.component_id, sets.doc_id) AS kept
FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN found ON found.node = classes.node
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), n_words=2).select("doc_id", "n_shingles", "component_id", "kept")


@query("op8_pivot_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT query_id, rank::int AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 20
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern())


@query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Lloyd's rounds in SQL: all distances of every round."""
    steps = [f"""
kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
width AS (SELECT (max(len(v)) // {parts})::BIGINT AS w FROM kept),
cut AS (SELECT row, vec_id, label, p, v[p * w + 1:(p + 1) * w] AS x FROM kept, width, range({parts}) AS r(p)),
book0 AS (SELECT p, row - 1 AS e, x AS c FROM cut WHERE row <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (SELECT row, p, min(d) AS d, arg_min(e, d * 1000 + e) AS e FROM (
  SELECT row, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM cut JOIN book{i} USING (p)) GROUP BY row, p)""")
        if i < rounds:
            steps.append(f"""
mean{i} AS (SELECT p, e, list(m ORDER BY j) AS c FROM (
  SELECT p, e, j, floor(sum(x[j]) / count(*))::BIGINT AS m FROM near{i} JOIN cut USING (row, p), width, range(1, w + 1) AS t(j) GROUP BY p, e, j) GROUP BY p, e),
book{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{i}.c, book{i}.c) AS c FROM book{i} LEFT JOIN mean{i} USING (p, e))""")
    return "WITH" + ",".join(steps) + f""",
coded AS (SELECT row, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY row)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (row)"""


@query("op11_vector_codes", _codes_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@query("op12_spelling_variants", r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END, i::BIGINT) AS c FROM range(256) AS r(i))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
each AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS k, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(1, len(hex(encode(k))), 2), lambda i: ('0x' || hex(encode(k))[i:i + 1])::BIGINT),
    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM each, crc),
spelt AS (SELECT CASE WHEN h % 199 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM words),
masks AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS less FROM places),
pairs AS (
  SELECT a.word, b.word AS near FROM masks a JOIN masks b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT word, less FROM masks WHERE less IN (SELECT word FROM words)
  UNION SELECT less, word FROM masks WHERE less IN (SELECT word FROM words)),
best AS (
  SELECT pairs.word, count(*) AS n_near, arg_max(near, (ranked.n, -ranked.rank)) AS near, max(ranked.n) AS near_n
  FROM pairs JOIN (SELECT word, n, row_number() OVER (ORDER BY word) AS rank FROM words) AS ranked ON ranked.word = pairs.near GROUP BY pairs.word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM forms UNION SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL),
ends AS (SELECT chain.word, root FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op13_private_data")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.find(table(spark, sf_dir, "documents"))
