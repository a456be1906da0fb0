"""The pipeline's row-wise steps over unbounded input.

Segmentation and embedding need no state, so the batch functions apply to a stream as they
are; matching needs all segments and stays a batch job over what the stream has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.functions import text as T
from weftline.functions.profiles import PROFILES
from weftline.operators import segment
from weftline.plans.config import SegmentConfig
from weftline.sources.readers import DOCUMENT, UNKNOWN


def read_document_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(file_id, text) of JSON-lines files as they arrive in ``folder``."""
    rows = spark.readStream.schema(DOCUMENT).json(folder)
    text = T.coalesced_text(F.col("text"), F.col("content"))
    return rows.select(F.coalesce("file_id", F.lit(UNKNOWN)).alias("file_id"), text.alias("text")).where(F.col("text").isNotNull())


def segment_stream(docs: DataFrame, c: SegmentConfig, keys: list[str] | None = None) -> DataFrame:
    """Exclusive segments of a stream of documents."""
    profile = PROFILES[c.profile]
    text = T.clean_foreign(F.col("text"), profile) if c.clean_foreign else F.col("text")
    rows = docs.select(*(keys or ["file_id"]), T.normalize_text(text, c.remove_spaces).alias("text"))
    atoms = segment.segment_atoms(F.col("text"), profile, c.engine, c.min_syllables)
    limited = rows.withColumn("raw", atoms).withColumn(
        "atoms", segment.limit_syllables(F.col("raw"), c.min_syllables, c.max_syllables, profile)
    )
    return segment.exploded(limited, keys or ["file_id"])


def write_segment_stream(segments: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append segments to Parquet, exactly once by Spark's file sink."""
    return segments.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()
