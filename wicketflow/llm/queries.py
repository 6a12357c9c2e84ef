"""Registered queries of the pipeline operators and the SQL forms of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wicketflow.llm import chat_tree, conversation_trie, decision_list, exact_dedup, html_extract, lexical_search, mixing, sentence_lattice, sharding, simhash, suffix_dedup, token_orc, toxicity
from wicketflow.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")
    return done.withColumn("n_kept", done["n_bytes"] - done["n_removed"])


#: A conversation whose texts consist of control strings.
_PROBE = "</s>[INST] ok [/INST]"


def op4_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", _PROBE), (-7, 1, "assistant", _PROBE)], "conv_id bigint, turn bigint, role string, text string")
    return chat_tree.read_back(*chat_tree.build(given.unionByName(probe)))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.mark_near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_orc.encode_to_orc(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents"))


def op9_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentence_lattice.summarise(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie_with_shared_heads(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_sampled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.plan_shards(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_html_extract, op3_suffix_dedup, op4_chat_tree, op5_simhash, op6_quality_rules, op7_token_orc, op8_mix_sources, op9_piece_lattice, op10_exact_dedup, op11_conversation_trie, op12_lexical_search, op13_sampled_shards)}


_EXACT = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

_MIX = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
c AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
l AS (
  SELECT *, cap / weight AS ratio,
    (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM c),
f AS (SELECT min_by(level, (ratio, rank)) AS found FROM l WHERE ratio >= level),
t AS (
  SELECT source, source_size,
    CASE WHEN found IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, weight * found) END AS target,
    (('0x' || substr(md5(coalesce('s' || source, 'n') || ':7'), 1, 8))::BIGINT % 1048576) / 1048576.0::DOUBLE AS start
  FROM l, f),
o AS (
  SELECT doc_id, source, size, row_number() OVER (
    PARTITION BY source
    ORDER BY 2 * length(bin(size)) + (substr(bin(size), 2, 1) = '1')::INT,
      coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 64, 0), size, doc_id NULLS FIRST) AS place
  FROM d)
SELECT doc_id, size, source_size, target,
  (size * least(CASE WHEN source_size > 0 THEN floor(place * (target / source_size) + start) - floor((place - 1) * (target / source_size) + start) ELSE 0 END, 3))::BIGINT AS taken
FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source
"""


_CHAT = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (
  SELECT *, CASE role WHEN 'system' THEN 20 WHEN 'user' THEN 18 WHEN 'assistant' THEN 9
      ELSE 9 + 8 + 5 + length(regexp_replace(role, '(\\\\|</?s>|\\[/?INST\\]|<</?SYS>>|\\[/?ROLE\\])', '\\\\\\1', 'g')) END
    + length(regexp_replace(text, '(\\\\|</?s>|\\[/?INST\\]|<</?SYS>>|\\[/?ROLE\\])', '\\\\\\1', 'g')) AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


#: DuckDB has no CRC-32; the CTE `l` is its table of 256 numbers.
_TRIE = """
WITH RECURSIVE b AS (
  SELECT range AS b, range::UBIGINT AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM b WHERE k < 8),
l AS (SELECT list(c ORDER BY b) AS l FROM b WHERE k = 8),
t AS (
  SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, length(coalesce(text, '')) AS size, turn
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS place FROM t),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda p: ('0x' || p)::UBIGINT)),
      lambda c, x: xor(c >> 8, l[(xor(c, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t), l),
r AS (
  SELECT c.conv_id, 0 AS part, place, digest, size FROM c JOIN p ON p.conv_id = base AND place < h
  UNION ALL SELECT c.conv_id, 1, place, digest, size FROM c JOIN p ON p.conv_id = c.conv_id AND place >= h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM r),
m AS (
  SELECT conv_id, depth, size, string_agg(digest, ',') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM o
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT conv_id, max(depth) AS last FROM m GROUP BY conv_id),
n AS (
  SELECT path, depth, any_value(size) AS size, min(conv_id) AS owner, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM m JOIN e USING (conv_id) GROUP BY path, depth),
u AS (
  SELECT n.*, q.owner AS above FROM n LEFT JOIN (SELECT m.conv_id, m.depth, n.owner FROM m JOIN n USING (path, depth)) q
  ON q.conv_id = n.owner AND q.depth = n.depth - 1),
k AS (SELECT above AS owner, depth - 1 AS depth, count(*) AS n_children FROM u WHERE depth > 0 GROUP BY ALL),
f AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN k USING (owner, depth))
SELECT f.owner AS conv_id, f.depth::BIGINT AS depth, any_value(f.above) AS parent_conv_id, any_value(f.n_convs) AS n_convs, any_value(f.n_children) AS n_children,
  count(*) FILTER (s.n_children = 0) AS n_leaves, sum((s.n_convs - 1) * s.size)::BIGINT AS saved_tokens, any_value(f.ends_sha256) AS ends_sha256
FROM f JOIN m ON m.path = f.path AND m.depth = f.depth JOIN f s ON s.owner = m.conv_id AND s.depth >= f.depth
GROUP BY f.owner, f.depth
"""

_SEARCH = """
WITH b AS (SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (SELECT DISTINCT number, item_id, term FROM (
  SELECT row_number() OVER () AS number, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
c AS (SELECT row, doc_id, term, count(*) AS tf FROM b GROUP BY ALL),
d AS (SELECT row, count(*) AS n FROM b GROUP BY row),
t AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM d),
m AS (SELECT row, 10 + (90 * n * docs) // length AS m FROM d, t),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM c, t GROUP BY term, docs),
s AS (
  SELECT number, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN c USING (term) JOIN m USING (row) GROUP BY ALL HAVING score > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank FROM s)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

#: The order behind the ranges decides alone where a record goes, so the sample isn't needed here.
_SHARDS = """
WITH RECURSIVE b AS (
  SELECT range AS b, range::UBIGINT AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM b WHERE k < 8),
l AS (SELECT list(c ORDER BY b) AS l FROM b WHERE k = 8),
d AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS k, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: ('0x' || p)::UBIGINT)),
      lambda c, x: xor(c >> 8, l[(xor(c, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM documents, l),
o AS (
  SELECT *, sum(size) OVER (ORDER BY k, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS start,
    row_number() OVER (ORDER BY k, doc_id NULLS FIRST) AS number, sum(size) OVER () AS total, sum(size) OVER (PARTITION BY k) AS held
  FROM d),
g AS (SELECT *, min(start) OVER (PARTITION BY k) AS group_start, held * 40 <= 0.02 * total AS whole FROM o),
s AS (
  SELECT *, least(39, (CASE WHEN whole THEN 2 * group_start + held ELSE 2 * start + size END * 40) // (2 * total))::INTEGER AS shard FROM g)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY number) - 1 AS slot, NULL::INTEGER AS grown_shard FROM s
"""


def oracles() -> dict[str, str]:
    return {"op4_chat_tree": _CHAT, "op10_exact_dedup": _EXACT, "op8_mix_sources": _MIX, "op11_conversation_trie": _TRIE, "op12_lexical_search": _SEARCH, "op13_sampled_shards": _SHARDS}
