"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import stored

SALTS = 16


def salted_join(left: DataFrame, right: DataFrame, key: str, other: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` with ``right`` unique in it: each row of ``right`` is
    copied to ``SALTS`` partitions, so a hot key of ``left`` is spread by a hash
    of its ``other`` column."""
    many = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return (left.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(SALTS)))
                .join(many, [key, "_salt"], how).drop("_salt"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node of its component.

    Large star: every node points its larger neighbours to its smallest one.
    Small star: a node points its smaller neighbours, and itself, there. Rounds
    repeat until the edge table stays the same, which takes about the square of
    the logarithm of the component size at most. A round's table is written, so
    lineage stays short.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (salted_join(both, low, "u", "v").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = salted_join(large, low, "u", "v")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = stored(small, "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
