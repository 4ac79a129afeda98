"""A training corpus from ``documents``: language, exact copies, near copies, benchmark leaks, mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.common import lower_ascii, ready, row_key, stored, table, without
from tallyloom.llm.decontaminate import decontaminate
from tallyloom.llm.exact_dedup import exact_dedup
from tallyloom.llm.language_id import UNKNOWN, identify_language
from tallyloom.llm.mixing import mix
from tallyloom.llm.near_dedup import near_duplicates
from tallyloom.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, mix_levels

# Below this mean probability no language is named; clean text, mixed languages included, lies well above.
LEAST_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those in which no language prevails; a null ``lang`` becomes the predicted one."""
    ready(spark)
    key = row_key(F.col("doc_id"), F.col("text"))
    marked = docs.withColumns({"row": key, "unlabelled": F.col("lang").isNull()})
    labelled = stored(identify_language(marked, keep=("row", "unlabelled")), "languages")
    rejected = labelled.filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < LEAST_SCORE))
    clear = without(docs, rejected, {"row": key})
    named = labelled.filter("unlabelled").select(F.col("row").alias("__row"), F.col("lang_pred").alias("__lang")).distinct()
    if named.isEmpty():
        return clear
    filled = clear.filter("lang IS NULL").withColumn("__key", key).join(named, F.col("__key") == F.col("__row")).withColumn("lang", F.col("__lang"))
    return clear.filter("lang IS NOT NULL").unionByName(filled.select(*docs.columns))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    ready(spark)
    dropped = exact_dedup(docs).filter("NOT kept").select("doc_id", "text_sha256")
    sha = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)
    return without(docs, dropped, {"doc_id": F.col("doc_id"), "text_sha256": sha})


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 percent of their five-word shingles the one with the least doc_id stays."""
    ready(spark)
    dropped = near_duplicates(docs, width=5, percent=80).filter("NOT kept")
    return without(docs, dropped, {"doc_id": F.col("doc_id"), "text_hash": F.unhex(F.md5(F.col("text").cast("binary")))})


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 percent of a benchmark item's five-word shingles go."""
    return decontaminate(docs, table(ready(spark), sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture and how often each is read: doc_id, domain, lang, source, tokens, quota, copies."""
    ready(spark)
    return mix(docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED).filter("copies > 0")


STAGES = [("language", language), ("exact", exact), ("near", near), ("leaks", leaks), ("mixture", mixture)]
# Language identification is learned, which SQL cannot express; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
