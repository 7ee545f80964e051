"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import ensure_checkpoint_dir, scratch_dir

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(column: str, mod: int) -> Column:
    """crc32 of the column as text, modulo ``mod`` (a null counts as empty text)."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % mod


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Cuts the lineage: later stages read the files, so a lost executor costs no
    recomputation, and every reader sees the same rows.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
