"""Readers for the driver's parquet tables.

Reads are lazy; Catalyst prunes columns and pushes filters into the parquet
scan, so callers select what they need right after ``table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, MapType, StructType

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_READERS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reader of one driver table; reused within a session (the schema is read once)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    key = (id(spark), sf_dir.rstrip("/"), name)
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _READERS[key]


_V1_LIST = "spark.sql.sources.useV1SourceList"


def counted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet folder to be counted only: where every column is flat, counts of rows
    and of non-null values come from the file footers, and no data page is read.

    (Spark pushes such aggregates down to its second parquet reader, which is chosen
    while the frame is made; a nested column's footer counts its elements, not its
    rows, so folders with one are read as usual.)
    """
    reader = spark.read.schema(schema)
    if any(isinstance(f.dataType, ArrayType | MapType | StructType) for f in schema):
        return reader.parquet(path)
    before = spark.conf.get(_V1_LIST)
    spark.conf.set(_V1_LIST, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return reader.parquet(path)
    finally:
        spark.conf.set(_V1_LIST, before)


def counted_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, to be counted only (see ``counted``)."""
    return counted(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", table(spark, sf_dir, name).schema)
