"""Query op4: secrets in every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import secrets
from paddock.llm.common import read
from paddock.llm.registry import query


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.samples(docs)))
    number = lambda r: F.size(F.filter("found", lambda x: x["rank"] == r)).cast("long")
    base = F.filter("found", lambda x: x["rank"] < 3)
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("found")).alias("spans"))
