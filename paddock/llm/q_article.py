"""Query op9: main text of every page."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import article
from paddock.llm.common import read
from paddock.llm.registry import query


@query("op9_html_extract")
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article.extract(read(spark, sf_dir, "pages"), article.train(), keep=["page_id", "url"])
