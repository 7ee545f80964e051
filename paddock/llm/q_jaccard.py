"""Query op8: components of documents linked by shingle Jaccard of 0.8 or more."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import jaccard
from paddock.llm.common import read
from paddock.llm.registry import query


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM d),
e AS (SELECT doc_id, unnest(g) AS g, len(g) AS n FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, max(a.n) + max(b.n) AS n
      FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p WHERE 100 * c >= 80 * (n - c)),
both_ways AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT r.doc_id, b.y FROM r JOIN both_ways b ON r.c = b.x)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, min(r.c) AS component_id
FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.g
"""


@query("op8_ngram_jaccard", SQL)
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))
