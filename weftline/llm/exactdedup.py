"""Exact deduplication by sorting contents.

Rows are range-partitioned on the leading bytes of the normalised text (Spark samples the
splitters), each partition is sorted externally so that equal texts become neighbours, and
a streaming pass compares the full text of neighbours.  Texts so frequent that they would
fill partitions of their own are counted first and pre-aggregated before their shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.llm.common import ascii_lower, without_ids
from weftline.plans.runtime import materialize, shuffle_partitions

#: Leading characters that the range splitters see; the rest is ordered by hash, then in full.
HEAD_CHARS = 32
#: A text is hot if it holds more than 1 / (HOT_SHARE * partitions) of the rows.
HOT_SHARE = 8


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min"
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  Of equal
    texts the row with the smallest (``keep="min"``) or largest (``"max"``) id stays.
    Null ids never win against others; of rows that repeat the winning id one is kept.
    Other columns of ``docs`` are ignored, so their names can't clash; an empty table gives
    an empty result.  Texts of any length are compared in full.
    """
    spark = docs.sparkSession
    best = {"min": F.min, "max": F.max}[keep]
    parts = shuffle_partitions(spark)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"),
    ).withColumn("mix", F.xxhash64("norm"))
    # Normalised once; what follows reads the columns it needs.
    rows = materialize(rows, "normalised")
    most = max(1.0, rows.count() / (HOT_SHARE * parts))
    # More rows than `most` each: at most HOT_SHARE * partitions such keys can exist, so this
    # table of (8 byte, flag) rows may be broadcast at any input size.
    hot = F.broadcast(
        rows.groupBy("mix").count().where(F.col("count") > most).select("mix", F.lit(True).alias("hot"))
    )
    cold = rows.join(hot, "mix", "left_anti")
    order = F.col("doc_id").asc_nulls_last() if keep == "min" else F.col("doc_id").desc_nulls_last()
    same = W.partitionBy("head", "mix", "norm")
    cold = (
        cold.withColumn("head", F.substring("norm", 1, HEAD_CHARS))
        .repartitionByRange("head", "mix")
        .select(
            "doc_id",
            best("doc_id").over(same).alias("keep_id"),
            F.count(F.lit(1)).over(same).alias("group_size"),
            (F.row_number().over(same.orderBy(order)) == 1).alias("kept"),
            F.sha2("norm", 256).alias("text_sha256"),
        )
    )
    hot_rows = rows.join(hot, "mix", "left_semi")
    # The aggregate compares the full texts, each map task sends one row per text.
    totals = (
        hot_rows.groupBy("norm")
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256"))
    )
    again = W.partitionBy("text_sha256", "doc_id").orderBy("doc_id")
    hot_rows = (
        hot_rows.select("doc_id", F.sha2("norm", 256).alias("text_sha256"))
        .join(F.broadcast(totals), "text_sha256")  # as many rows as hot texts, see above
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(again) == 1)).alias("kept"),
            "text_sha256",
        )
    )
    return cold.unionByName(hot_rows)


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min"
) -> DataFrame:
    """``docs`` without the rows whose text another row, which stays, has as well.

    Rows are matched by id, so ids should be unique: a row goes if any row with its id goes.
    """
    lost = exact_duplicates(docs, id_col, text_col, keep).where(~F.col("kept")).select("doc_id")
    return without_ids(docs, id_col, lost)
