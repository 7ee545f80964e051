"""Incremental ingest of landed race JSON with Structured Streaming.

The collector lands one folder of race records per day. Instead of listing and
diffing folders, a file-source stream picks up every new file exactly once
(progress lives in the checkpoint folder, which must be shared storage on a
cluster: it defaults to a folder under ``spark.checkpoint.dir``). Each
micro-batch stores its race records (chunks) in a partition of its own, which a
retried batch overwrites; ``landed_races`` reads the table and adds up the
chunks of a race with the batch reader's function, whichever batches they came
in. ``availableNow`` processes what has landed and stops, which suits a
scheduled daily job; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import ensure_checkpoint_dir
from paddock.sources.landing import RACE_SCHEMA, flatten_races


def landed_races(spark: SparkSession, table: str) -> DataFrame:
    """Flat race rows of the table that the stream writes."""
    return flatten_races(spark.read.schema(RACE_SCHEMA).parquet(table))


def ingest_landed_races(spark: SparkSession, landing: str, table: str,
                        checkpoint: str | None = None, available_now: bool = True,
                        max_files_per_trigger: int = 5000):
    """Start the stream; returns the StreamingQuery (``awaitTermination`` it).

    ``max_files_per_trigger`` sizes the batches and does not change the result.
    """
    checkpoint = checkpoint or ensure_checkpoint_dir(spark).rstrip("/") + "/streams/landed-races"
    src = (spark.readStream.schema(RACE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
           .json(landing))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_batch", F.lit(batch_id))           # the scan packs small files already
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_batch").parquet(table))

    w = src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
