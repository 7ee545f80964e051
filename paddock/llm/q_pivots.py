"""Query op3: exact top 10 by integer inner product for every hundredth vector."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import pivots
from paddock.llm.common import read
from paddock.llm.registry import query

SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op3_pivot_topk", SQL)
def op3_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
