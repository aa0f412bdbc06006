"""The operators as named queries over the given tables, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (
    alignment, convtrie, exactdedup, language, mixing, nndescent, packing, simhash, suffixtree, syncmers, tokencount, tokenstore, urls)
from shelfwise.llm.common import documents, prepared
from shelfwise.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


@query("op1_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


@query("op4_suffix_tree_scores")
def suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(documents(spark, sf_dir))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix-1' || coalesce(CAST(doc_id AS VARCHAR), '')) AS tie
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * CAST(sum(size) AS DOUBLE) AS most,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, CAST(1.5 AS DOUBLE) * sum(source_size::DOUBLE) OVER () AS whole,
    coalesce(sum(most) OVER w, 0) AS stopped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight
  FROM sources
  WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT coalesce(max((whole - stopped) / open_weight), 0) AS l FROM levels),
goals AS (
  SELECT source, source_size, CASE WHEN most <= l * weight THEN most ELSE l * weight END AS target,
    CASE WHEN source_size = 0 THEN 0.0::DOUBLE WHEN most <= l * weight THEN 2.0::DOUBLE ELSE l * weight / source_size END AS rate
  FROM sources CROSS JOIN level),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, tie, doc_id NULLS LAST) AS place,
    CAST('0x' || substr(md5('mix-1' || coalesce('=' || source, '-')), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM sized)
SELECT p.doc_id, p.source, p.size, g.source_size, g.target,
  CAST(floor(p.place::DOUBLE * g.rate + u) - floor((p.place - 1)::DOUBLE * g.rate + u) AS BIGINT) AS copies,
  CAST(floor(p.place::DOUBLE * g.rate + u) - floor((p.place - 1)::DOUBLE * g.rate + u) AS BIGINT) * p.size AS taken
FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source
"""


VECTORS_SQL = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT r.vec_id, (SELECT count(*) FROM links l WHERE l.a = r.vec_id) AS n_links,
  min(r.other) AS component_id, r.vec_id = min(r.other) AS kept
FROM reached r GROUP BY r.vec_id
"""


@query("op5_nn_descent", VECTORS_SQL)
def nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.link(table(spark, sf_dir, "embeddings"))


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; the folder is the installed package's."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencount.count_tokens(documents(spark, sf_dir), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


@query("op7_token_store")
def token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = tokenstore.write(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return store.read(store.keys())


@query("op6_source_mixing", MIX_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


@query("op8_closed_syncmers")
def closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare(documents(spark, sf_dir))


@query("op9_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op10_url_filters")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


EXACT_SQL = """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
same AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM normal JOIN same USING (t)
"""


@query("op13_exact_dedup", EXACT_SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.duplicates(spark, f"{sf_dir}/documents.parquet")


# crc32 is spelled out: eight shifts for each digit.
TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, count(*) AS size,
    xor(4294967295, list_reduce([4294967295] || flatten([[ord(x), 0, 0, 0, 0, 0, 0, 0]::BIGINT[] FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
      lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1)))) % 6 AS h
  FROM turns GROUP BY conv_id),
convs AS (
  SELECT i.*, least(i.h, coalesce(b.size, 0)) AS taken FROM ids i LEFT JOIN ids b ON i.base = b.conv_id),
rebuilt AS (
  SELECT c.conv_id, t.place AS depth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL SELECT c.conv_id, t.place - c.h + c.taken, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
paths AS (
  SELECT conv_id, depth, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, [] FROM ids),
nodes AS (SELECT path, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs FROM paths GROUP BY path),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce((n.n_convs - 1) * length(n.path[n.depth].text), 0) AS own,
    (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND list_slice(c.path, 1, n.depth) = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = list_slice(n.path, 1, n.depth - 1)),
sums AS (
  SELECT list_slice(path, 1, d) AS path, sum(own) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM linked) GROUP BY 1),
lasts AS (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id),
ended AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM lasts GROUP BY path)
SELECT l.conv_id, CAST(l.depth AS BIGINT) AS depth, l.parent_conv_id, l.n_convs, l.n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM linked l JOIN sums s ON s.path = l.path LEFT JOIN ended e ON e.path = l.path
"""


@query("op11_conversation_trie", TRIE_SQL)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.trie(table(spark, sf_dir, "conversations"))


@query("op12_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.compare(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
