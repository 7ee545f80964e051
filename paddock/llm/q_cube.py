"""Query op7: mix all documents to the sources' target sizes."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import cube
from paddock.llm.common import read
from paddock.llm.registry import query


@query("op7_cube_mix")
def op7_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.mix(read(spark, sf_dir, "documents"), keep=["doc_id"])
