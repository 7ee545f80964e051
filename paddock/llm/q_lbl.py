"""Query op5: log-bilinear model scores of every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import lbl
from paddock.llm.common import crc_mod, read
from paddock.llm.registry import query


@query("op5_lm_score")
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = (read(spark, sf_dir, "documents").select("doc_id", "text")
            .withColumn("held_out", crc_mod("doc_id", 7) == 2))
    out, counts = lbl.train_and_score(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(counts.n).cast("long").alias("train_tokens"),
                      "base_score", "score")
