"""Landed JSON payloads: race details, horse pages, jockey pages.

Collectors land one JSON record per race (with its ``entries`` array) and one
per entity page (with its ``results`` array), partitioned by date. The
readers are schema'd JSON scans + ``explode``; the date range prunes
partitions. Arrays are written in chunks of at most ``chunk`` elements so no
single record grows with a hot race or entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.operators.sequence import desc, with_position

# The fields of the landed payloads.
ENTRY_SCHEMA = ("horse_id string, horse_name string, jockey_id string, odds double, "
                "finish_position int, weight int")
RACE_SCHEMA = (f"race_id string, race_name string, race_number int, course string, distance int, "
               f"track_type string, track_condition string, weather string, grade string, chunk int, "
               f"entries array<struct<{ENTRY_SCHEMA}>>, race_date date")
RESULT_SCHEMA = ("race_id string, race_date date, course string, distance int, finish_position int, "
                 "weight double, jockey_id string, horse_id string, ln int")
RESULT_COLUMNS = [f.split()[0] for f in RESULT_SCHEMA.split(", ")]
PAGE_SCHEMA = f"entity_id string, chunk int, results array<struct<{RESULT_SCHEMA}>>, page_date date"


# -- A6, A7 ------------------------------------------------------------------
def read_races(spark: SparkSession, path: str, date_from=None, date_to=None) -> DataFrame:
    """Flat race rows from landed race JSON over an inclusive date range.

    Missing text fields default to '', missing numbers to 0; ``num_entries``
    is the number of entries (0 when the payload has no entry list); records
    with an empty race id are skipped. Chunks of one race are summed.
    """
    r = spark.read.schema(RACE_SCHEMA).json(path)
    if date_from is not None:
        r = r.filter(F.col("race_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        r = r.filter(F.col("race_date") <= F.lit(date_to).cast("date"))
    return flatten_races(r)


def flatten_races(r: DataFrame) -> DataFrame:
    """Race records (possibly several chunks per race) -> one flat row per race."""
    r = r.filter(F.col("race_id").isNotNull() & (F.col("race_id") != ""))
    n = F.when(F.col("entries").isNull(), F.lit(0)).otherwise(F.size("entries"))
    g = r.groupBy("race_id", "race_date").agg(
        *[F.max(c).alias(c) for c in ("race_name", "race_number", "course", "distance", "track_type",
                                      "track_condition", "weather", "grade")],
        F.sum(n).cast("int").alias("num_entries"))
    return g.select("race_id", "race_date",
                    *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("race_name", "course")],
                    *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("race_number", "distance")],
                    *[F.coalesce(F.col(c), F.lit("")).alias(c)
                      for c in ("track_type", "track_condition", "weather", "grade")],
                    "num_entries")


# -- A8 ----------------------------------------------------------------------
def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Flatten entity pages: one row per listed result, with the entity id."""
    p = spark.read.schema(PAGE_SCHEMA).json(path)
    return p.select("entity_id", F.explode("results").alias("r")).select("entity_id", "r.*")


def horse_results(spark: SparkSession, path: str, limit: int = 10) -> DataFrame:
    """At most ``limit`` latest results per horse (newest first order)."""
    x = read_pages(spark, path).withColumnRenamed("entity_id", "page_horse_id")
    # the limit cuts rows before the shuffle, in every input partition
    newest = Window.partitionBy("page_horse_id").orderBy(F.col("race_date").desc(), F.col("race_id").desc(), F.col("ln").desc(),
                                                         F.col("finish_position"))
    return x.withColumn("_k", F.row_number().over(newest)).filter(F.col("_k") <= limit).drop("_k", "horse_id").withColumnRenamed("page_horse_id", "horse_id")


# -- A9 ----------------------------------------------------------------------
def jockey_results(spark: SparkSession, path: str, requested: DataFrame, year: int | None = None) -> DataFrame:
    """Results of the requested jockeys (each once), optionally one year only.

    ``requested`` holds jockey ids (e.g. the entries of the races collected);
    it is reduced to distinct ids and used as a semi-join filter.
    """
    x = read_pages(spark, path).withColumnRenamed("entity_id", "page_jockey_id")
    if year is not None:
        x = x.filter(F.year("race_date") == year)
    ids = requested.select(F.col("jockey_id").alias("page_jockey_id")).distinct()
    return x.join(ids, "page_jockey_id", "left_semi").drop("jockey_id") \
            .withColumnRenamed("page_jockey_id", "jockey_id")


# -- landing writers (collector side) ----------------------------------------
def land_races(entries: DataFrame, path: str, chunk: int = 500) -> None:
    """Write one JSON record per (race, chunk of entries), partitioned by date."""
    e = entries.withColumn("chunk", F.floor((F.col("finish_position") - 1) / chunk).cast("int"))
    head = F.struct(
        "race_date",
        F.when(F.col("race_id") % 7 != 0, F.concat(F.lit("R"), F.col("race_id").cast("string"))).alias("race_name"),
        (F.col("race_id") % 12 + 1).cast("int").alias("race_number"), "course",
        F.when(F.col("race_id") % 11 != 0, F.col("distance")).alias("distance"),
        "track_type", "track_condition", "weather", "grade")
    # the race's own columns are those of its winner, which is in one chunk: handed to the others by race
    arr = e.filter(F.col("race_id").isNotNull()).groupBy("race_id", "chunk").agg(
        F.collect_list(F.struct(
            F.col("horse_id").cast("string").alias("horse_id"),
            F.concat(F.lit("ホース"), F.col("horse_id").cast("string")).alias("horse_name"),
            F.col("jockey_id").cast("string").alias("jockey_id"), F.col("odds"),
            F.col("finish_position"), F.col("weight").cast("int").alias("weight"))).alias("entries"),
        F.collect_list(F.when(F.col("finish_position") == 1, head)).alias("_heads"))
    heads = F.flatten(F.collect_list("_heads").over(Window.partitionBy("race_id")))
    rec = arr.withColumn("_heads", heads).withColumn("_head", F.explode("_heads")).select("race_id", "chunk", "entries", "_head.*").select(
        F.when(F.col("race_id") % 89 == 0, F.lit("")).otherwise(F.col("race_id").cast("string")).alias("race_id"),
        "race_name", "race_number", "course", "distance", "track_type", "track_condition", "weather", "grade",
        "chunk", F.when(F.col("race_id") % 53 != 0, F.col("entries")).alias("entries"), "race_date")
    rec.hint("rebalance", "race_date").write.mode("overwrite").partitionBy("race_date").json(path)


def land_pages(entries: DataFrame, path: str, entity: str, chunk: int = 500) -> None:
    """Write entity pages: results newest first, in chunks, partitioned by the
    date of the page's newest result. Pages repeat their field names in every
    result, so their files are compressed; a file is what one task of the
    rebalanced shuffle writes of a date, so no reader gets a large one whole."""
    order = [desc("race_date"), desc("race_id"), desc("ln")]
    e = with_position(entries, [entity], order, name="_k")
    e = e.withColumn("chunk", F.floor(F.col("_k") / chunk).cast("int"))
    # the two shuffles move the columns as they are, without the entity that the page names; texts are made at last
    kept = [c for c in ("race_id", "race_date", "course", "distance", "finish_position", "weight", "jockey_id", "horse_id", "ln") if c != entity]
    g = e.groupBy(F.col(entity).alias("_entity"), "chunk").agg(
        F.sort_array(F.collect_list(F.struct("_k", *kept))).alias("_rs"), F.max("race_date").alias("page_date"))
    kinds = {"race_id": "string", "distance": "int", "weight": "double", "jockey_id": "string", "horse_id": "string", "ln": "int"}

    def result(s):
        own = {c: s[c] if c != entity else F.col("_entity") for c in [*kept, entity]}
        return F.struct(*[own[c].cast(kinds[c]).alias(c) if c in kinds else own[c].alias(c) for c in RESULT_COLUMNS])

    g.hint("rebalance", "page_date").select(
        F.col("_entity").cast("string").alias("entity_id"), "chunk", F.transform("_rs", result).alias("results"), "page_date") \
     .write.mode("overwrite").option("compression", "gzip").partitionBy("page_date").json(path)

