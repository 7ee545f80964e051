"""Query op12: the ten best documents of each benchmark item."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import maxsketch
from paddock.llm.common import read
from paddock.llm.registry import query

SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT i, item_id, unnest(t) AS term FROM i),
e AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM e WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term, n_docs),
x AS (
  SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term), s GROUP BY i, item_id, r, doc_id),
y AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM y WHERE rank <= 10
"""


@query("op12_lexical_search", SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxsketch.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
