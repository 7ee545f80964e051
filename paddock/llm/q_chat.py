"""Query op1: every conversation from every participant's side."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import chat
from paddock.llm.common import read
from paddock.llm.registry import query

SQL = r"""
WITH m AS (
  SELECT conv_id, turn, role, replace(coalesce(text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS body FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system'),
e AS (
  SELECT m.conv_id, perspective, turn, role, body, coalesce(role = perspective, false) AS own,
         '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
                                ELSE 'user' || coalesce(' name=' || role, '') END || chr(10) AS head
  FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (
    PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, role NULLS LAST, body
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM e),
q AS (SELECT *, start // 32768 AS part FROM o),
r AS (SELECT *, start - min(start) OVER (PARTITION BY conv_id, perspective, part) + length(head) AS a FROM q)
SELECT conv_id, perspective, part, count(*) AS n_messages, string_agg(head || body, '' ORDER BY start) AS text,
       coalesce(string_agg(a || ':' || (a + length(body) - 1), ',' ORDER BY start) FILTER (own), '') AS masks,
       coalesce(sum(length(body) - 1) FILTER (own), 0)::BIGINT AS n_masked
FROM r GROUP BY ALL
"""


@query("op1_chat_rotation", SQL)
def op1_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(read(spark, sf_dir, "conversations"))
