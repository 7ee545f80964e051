"""Query op10: benchmark items that documents hold."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import decontaminate
from paddock.llm.common import read
from paddock.llm.registry import query


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
