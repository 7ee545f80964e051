"""Query op11: the prefix trie of rebuilt conversations."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import trie
from paddock.llm.common import read
from paddock.llm.registry import query

SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)),
    4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS own, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= h
  UNION ALL SELECT c.conv_id, 1, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > h),
s AS (
  SELECT conv_id, length(text) AS size, row_number() OVER w AS depth, md5(string_agg(md5(role || chr(0) || text), '') OVER w) AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)),
m AS (
  SELECT conv_id, depth, size, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), '') AS up,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM s
  UNION ALL SELECT conv_id, 0, 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM r) FROM c),
n AS (
  SELECT node, depth, min(conv_id) AS conv_id, any_value(up) AS up, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY node, depth),
k AS (SELECT up AS node, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
z AS (SELECT a.node AS top, b.node FROM m a JOIN m b ON a.conv_id = b.conv_id AND a.depth <= b.depth GROUP BY ALL),
u AS (
  SELECT top AS node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
  FROM z JOIN n ON n.node = z.node LEFT JOIN k ON k.node = z.node GROUP BY top)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens, n.ends_sha256
FROM n JOIN u USING (node) LEFT JOIN k USING (node) LEFT JOIN n p ON p.node = n.up
"""


@query("op11_prefix_trie", SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(read(spark, sf_dir, "conversations"))
