"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontaminate, linededup, mixing, neardup, quality
from weftline.llm.queries import LINE_WORDS, QUALITY_THRESHOLD, TARGETS
from weftline.plans.runtime import materialize, read_table, spread


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    Null and empty texts are scored like others; rows that repeat an id are scored by their text.
    """
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model, QUALITY_THRESHOLD)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated line runs; those that consisted of such runs alone go.

    Where lines went, ``n_chars`` is the length of what is left.
    """
    out = linededup.drop_repeated_lines(docs, LINE_WORDS)
    out = out.where((F.col("n_deleted") == 0) | F.col("text").rlike(linededup.WORD))
    columns = [
        F.when(F.col("n_deleted") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c == "n_chars"
        else F.col(c)
        for c in docs.columns
    ]
    return out.select(columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on five-word shingles, that with the smallest id.

    Texts without words (null, empty) and rows with a null id stay.
    """
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; texts without words hold none and stay."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights, with the probability they were kept with.

    Texts without words have no weight and are drawn at their cell's rate; unknown or null
    sources, languages and topics fall under the rest.
    """
    return mixing.sample_mix(docs, TARGETS)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The classifier is no SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each stage's rows written to the shared folder and read again."""
    docs = spread(read_table(spark, sf_dir, "documents"))
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
