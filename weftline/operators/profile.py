"""Profiles of input tables, one aggregation pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.profiles import TIBETAN, ScriptProfile
from weftline.functions.text import strip

LONG = 350


def input_profile(docs: DataFrame, text: Column, metadata: dict[str, Column] | None = None, profile: ScriptProfile = TIBETAN) -> DataFrame:
    """One row: total, empty texts, texts without the first delimiter and long ones among them.

    ``metadata`` adds ``missing_<name>``, the rows where a column is null or blank.
    """
    body = strip(F.coalesce(text, F.lit("")))
    bare = (body != "") & ~body.contains(profile.delimiters[0])
    blank = lambda c: F.coalesce(strip(c), F.lit("")) == ""
    return docs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(body == "").alias("empty_text"),
        F.count_if(bare).alias("no_delimiter"),
        F.count_if(bare & (F.length(body) > LONG)).alias("long_no_delimiter"),
        *[F.count_if(blank(c)).alias(f"missing_{n}") for n, c in (metadata or {}).items()],
    )


def jsonl_profile(lines: DataFrame) -> DataFrame:
    """Profile of the raw lines of a JSON-lines file, invalid and blank lines included."""
    schema = "text string, metadata struct<file_path:string,title:string>"
    rows = lines.select(strip(F.col("value")).alias("v")).withColumn("d", F.from_json("v", schema))
    return input_profile(
        rows, F.col("d.text"),
        {"metadata": F.to_json("d.metadata"), "file_path": F.col("d.metadata.file_path"), "title": F.col("d.metadata.title")},
    )


def segments_per_line(segments: DataFrame, line: str = "line_number") -> DataFrame:
    return segments.groupBy(line).agg(F.count(F.lit(1)).alias("num_segments"))


def line_range(segments: DataFrame, line: str = "line_number") -> DataFrame:
    return segments.agg(F.min(line).alias("first_line"), F.max(line).alias("last_line"), F.countDistinct(line).alias("num_lines"))


def largest_regions(regions: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest regions by cells."""
    cells = (F.col("end_a") - F.col("start_a")).cast("long") * (F.col("end_b") - F.col("start_b"))
    return regions.withColumn("cells", cells).orderBy(F.col("cells").desc(), "file_a", "file_b", "region").limit(n)
