"""Query op2: language of every document."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import langid
from paddock.llm.common import crc_mod, read
from paddock.llm.registry import query


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows that are not held out, predicts all whole texts."""
    docs = read(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 5) == 0)
    learn = docs.filter("not held_out")
    profiles = langid.train(learn)
    return langid.predict(docs, profiles, keep=["doc_id", "held_out"])
