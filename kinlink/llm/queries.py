"""The registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, chat, decontaminate, langid, licenses, neardup, sharding, token_counts, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _vocabulary("byte_bpe_50k.json")
    encoded = bpe.encode_documents(_table(spark, sf_dir, "documents"), path, decode=True)
    return bpe.with_digests(encoded).drop("ids", "decoded")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify_languages(docs, langid.learn_profiles(docs))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), n_shards=24)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), k=20)


def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_conversations(_table(spark, sf_dir, "conversations"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


OP8_SQL = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         coalesce(CAST(floor(turn / 256.0) AS BIGINT), -1) AS part,
         md5(length(coalesce(role, 'unknown')) || ':' || coalesce(role, 'unknown') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
chains AS (
  SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS whole, count(*) AS n_turns
  FROM turns GROUP BY conv_id),
proper AS (
  SELECT DISTINCT whole[1:k] AS prefix
  FROM (SELECT whole, unnest(range(1, n_turns)) AS k FROM chains)),
kept AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS copies, whole
  FROM chains WHERE NOT EXISTS (SELECT 1 FROM proper WHERE proper.prefix = chains.whole)
  GROUP BY whole, n_turns)
SELECT conv_id, part, kept.n_turns AS n_turns, copies,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), ''
                  ORDER BY turn NULLS FIRST, digest) AS text
FROM turns JOIN kept USING (conv_id)
GROUP BY conv_id, part, kept.n_turns, copies
"""

#: CRC-32 of every distinct text and id, byte by byte; the table comes from its polynomial.
CRC_SQL = r"""
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
crc AS MATERIALIZED (
  SELECT s, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
              list_transform(regexp_extract_all(hex(encode(s)), '..'), lambda h: ('0x' || h)::BIGINT)),
              lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS crc
  FROM (SELECT DISTINCT coalesce(text, '') AS s FROM documents UNION SELECT doc_id::VARCHAR FROM documents
        WHERE doc_id IS NOT NULL), crc_table)"""

OP3_SQL = f"""
WITH {CRC_SQL},
sized AS (
  SELECT doc_id, coalesce(text, '') AS s, md5(coalesce(text, '')) AS digest, octet_length(encode(coalesce(text, ''))) + 8 AS size
  FROM documents),
salted AS (
  SELECT sized.*, b.crc AS text_crc32, coalesce(i.crc % 256, 0) AS cell
  FROM sized JOIN crc b ON b.s = sized.s LEFT JOIN crc i ON i.s = doc_id::VARCHAR),
laid AS (
  SELECT *, row_number() OVER (ORDER BY digest, cell, doc_id NULLS FIRST) AS place,
         sum(size) OVER (ORDER BY digest, cell, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS byte,
         sum(size) OVER (PARTITION BY digest) AS group_bytes, sum(size) OVER () AS total
  FROM salted),
cut AS (
  SELECT *, least(((CASE WHEN group_bytes * 24 <= total * 0.05::DOUBLE THEN min(byte) OVER (PARTITION BY digest) ELSE byte END)
                   * 24) // total, 23) AS shard
  FROM laid)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INT AS grown_shard
FROM cut
"""

OP6_SQL = """
WITH valid AS (
  SELECT DISTINCT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.id AS query_id, c.id AS vec_id, max(list_reduce(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]), lambda x, y: x + y)) AS score
  FROM valid q JOIN valid c ON q.id <> c.id WHERE q.id % 20 = 0
    AND len(q.v) = (SELECT mode(len(v)) FROM valid) AND len(c.v) = len(q.v) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

#: Links between all different texts whose sizes allow them, and all that can be reached over them.
OP9_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT DISTINCT coalesce(text, '') AS s FROM documents),
split AS (
  SELECT s, regexp_extract_all(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x20\x09-\x0D]+') AS w FROM texts),
shingled AS (
  SELECT s, CASE WHEN len(w) < 2 THEN w
                 ELSE list_distinct(list_transform(list_zip(w[:len(w) - 1], w[2:]), lambda x: x[1] || ' ' || x[2])) END AS g FROM split),
classes AS MATERIALIZED (
  SELECT min(doc_id) AS node, any_value(g) AS g, len(any_value(g)) AS n
  FROM documents JOIN shingled ON shingled.s = coalesce(text, '') GROUP BY shingled.s),
held AS (SELECT element, count(*) AS m FROM (SELECT unnest(g) AS element FROM classes) GROUP BY element),
posts AS MATERIALIZED (
  SELECT node, n, element, row_number() OVER (PARTITION BY node ORDER BY m, element) AS place
  FROM (SELECT node, n, unnest(g) AS element FROM classes) JOIN held USING (element)),
-- Sets at 0.8 or more share one of the rarest fifth of each, and one more.
early AS (SELECT node, n, element FROM posts WHERE 5 * (place - 1) <= n),
meets AS (
  SELECT DISTINCT a.node AS a, b.node AS b FROM early a JOIN early b ON a.element = b.element AND a.node < b.node
  WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
edges AS MATERIALIZED (
  SELECT a, b FROM (SELECT a, b, x.n + y.n AS n, len(list_intersect(x.g, y.g)) AS m
                    FROM meets JOIN classes x ON x.node = a JOIN classes y ON y.node = b)
  WHERE 100 * m >= 80 * (n - m)),
sides AS MATERIALIZED (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (
  SELECT node, node AS other FROM classes UNION SELECT reach.node, sides.b FROM reach JOIN sides ON sides.a = reach.other),
labels AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, n::BIGINT AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id,
       CASE WHEN n = 0 THEN true ELSE doc_id = component_id END AS kept
FROM documents
JOIN (SELECT shingled.s, min(doc_id) AS node FROM documents JOIN shingled ON shingled.s = coalesce(text, '') GROUP BY shingled.s) named
  ON named.s = coalesce(text, '')
JOIN classes USING (node) JOIN labels USING (node)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_language": op2_language,
        "op3_shards": op3_shards,
        "op4_token_counts": op4_token_counts,
        "op5_licenses": op5_licenses,
        "op6_ann": op6_ann,
        "op7_leaks": op7_leaks,
        "op8_chat": op8_chat,
        "op9_neardup": op9_neardup,
        "op10_toxicity": op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_shards": OP3_SQL, "op6_ann": OP6_SQL, "op8_chat": OP8_SQL, "op9_neardup": OP9_SQL}
