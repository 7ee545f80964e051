"""Corpus pipeline over ``documents``: each stage is one operator of ``paddock.llm``.

1. language ID: documents without a letter go, and those whose best cosine is
   below ``MIN_SCORE * n / (n + HALF)`` for n characters: they resemble no language
   that the labelled documents show. Short texts have low cosines, so the bound
   rises with the length; if no document has a label, all that have a letter stay.
2. n-gram Jaccard join: of every component of linked rows one stays, that of the
   smallest id, or one without an id if no row has one.
3. benchmark decontamination: documents that hold a benchmark item go.
4. secret scans: documents stay, secrets in their text are masked and n_chars
   follows the text.
5. mixing: documents that the mix takes stay, with the number of copies.

Every stage keeps all columns of ``documents`` and works on all rows it gets.
Null and empty texts go in stage 1; null ids, sources and languages are values
like others. Repeated rows are copies of each other: stage 2 keeps one. Empty
tables give empty results. Further columns of any name are carried along under
private names; one named like a column that stage 5 makes is replaced by it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import cube, decontaminate, jaccard, langid, secrets
from paddock.llm.common import read, stored
from paddock.llm.registry import prepare

MIN_SCORE, HALF = 0.1, 200
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def carrying(stage: Callable) -> Callable:
    """The stage with further columns under names that meet no other."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {f"further_{i}": c for i, c in enumerate(docs.columns) if c not in COLUMNS}
        own = {c: k for k, c in names.items()}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(own.get(c, c)) for c in docs.columns]), sf_dir)
        made = {c.lower() for c in out.columns}
        return out.select(*[F.col(c).alias(names.get(c, c)) for c in out.columns if names.get(c, "").lower() not in made])
    return run


@carrying
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    profiles = langid.train(docs)
    lettered = docs.filter(F.col("text").rlike(r"\p{L}"))
    if not profiles.langs:
        return lettered
    unlike = F.col("score") * (F.length("text") + HALF) < MIN_SCORE * F.length("text")
    return langid.predict(lettered, profiles).filter(~unlike).select(docs.columns)


@carrying
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard.keep_one(docs)


@carrying
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


@carrying
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    masked = secrets.redact(docs, secrets.train(secrets.samples(docs)))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


@carrying
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return cube.mix(docs).filter("copies > 0")


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("secret scans", secret_scan),
          ("mixing sources", source_mix)]
#: The stages train models, join by similarity and sample; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
