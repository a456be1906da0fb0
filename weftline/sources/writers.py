"""Writers: segments, vectors, matches and review tables."""

from __future__ import annotations

import html
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as st

from weftline.functions.text import sanitize_text


def segment_folder(base: str, overlapping: bool, single_lines: bool) -> str:
    """Where segments go, by mode and layout."""
    return f"{base.rstrip('/')}/{'overlapping' if overlapping else 'exclusive'}/{'Single_Lines' if single_lines else 'Full_Files'}"


def _clean_strings(df: DataFrame) -> DataFrame:
    return df.select(
        [sanitize_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, st.StringType) else F.col(f.name) for f in df.schema]
    )


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", rows_per_file: int | None = None, mode: str = "overwrite") -> None:
    """CSV with header, control characters removed; files of at most ``rows_per_file`` rows."""
    writer = _clean_strings(df).write.mode(mode).option("header", True).option("escape", '"').option("encoding", encoding)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def read_csv(spark, path: str, schema: str, encoding: str = "UTF-8") -> DataFrame:
    """What :func:`write_csv` wrote; wide encodings need the line separator spelled out."""
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("encoding", encoding)
    return (reader.option("lineSep", "\n") if encoding.upper() != "UTF-8" else reader.option("multiLine", True)).csv(path)


def write_segments(df: DataFrame, base: str, overlapping: bool = False, single_lines: bool = False) -> str:
    """Segments as CSV, in one folder or one folder per source line."""
    path = segment_folder(base, overlapping, single_lines)
    df = _clean_strings(df)
    if single_lines:
        df = df.repartition("Source_Line_Number").sortWithinPartitions("Source_Line_Number", "Sentence_Order")
        df.write.mode("overwrite").option("header", True).option("escape", '"').partitionBy("Source_Line_Number").csv(path)
    else:
        ordered = df.repartitionByRange("Source_Line_Number", "Sentence_Order").sortWithinPartitions("Source_Line_Number", "Sentence_Order")
        ordered.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_vectors(df: DataFrame, path: str, mode: str = "combined", skip_existing: bool = False) -> DataFrame:
    """Segments with vectors as Parquet: ``combined``, ``per_file`` or ``per_line``; the summary.

    The summary has num_segments and, by line, the range of lines.  With ``skip_existing`` a
    folder that is there already stays as it is.
    """
    by = {"combined": None, "per_file": "Source_File", "per_line": "Source_Line_Number"}[mode]
    writer = (df if by is None else df.repartition(by)).write.mode("ignore" if skip_existing else "overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return vector_summary(df.sparkSession.read.parquet(path), by)


def write_missing_vectors(
    segments: DataFrame, embed: Callable[[DataFrame], DataFrame], path: str, by: str = "Source_Line_Number", files_per_commit: int = 1000
) -> DataFrame:
    """Vectors of the corpus files that ``path`` doesn't hold yet; the summary of all.

    What is there is the manifest: its values of ``by`` leave the segments before they are
    encoded.  The rest is written ``files_per_commit`` files at a time, a folder each, so a run
    that was killed has kept what it had committed and the next goes on from there.
    """
    spark = segments.sparkSession
    if _exists(spark, path):
        segments = segments.join(spark.read.parquet(path).select(F.col(by).cast(segments.schema[by].dataType)).distinct(), by, "left_anti")
    groups = -(-segments.select(by).distinct().count() // files_per_commit)
    for g in range(groups):
        part = segments.where(F.pmod(F.xxhash64(by), F.lit(groups)) == g)
        embed(part).repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return vector_summary(spark.read.parquet(path), by)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def vector_summary(df: DataFrame, by: str | None = None) -> DataFrame:
    """Counts of segments: all, or per value of ``by``."""
    if by:
        return df.groupBy(by).agg(F.count(F.lit(1)).alias("num_segments")).orderBy(by)
    lines = [F.min("Source_Line_Number").alias("first_line"), F.max("Source_Line_Number").alias("last_line"),
             F.countDistinct("Source_Line_Number").alias("num_lines")] if "Source_Line_Number" in df.columns else []
    return df.agg(F.count(F.lit(1)).alias("num_segments"), *lines)


TEXT_COLUMNS = ("text_tibetan_a", "text_tibetan_b", "parallel_a", "parallel_b")


def write_matches(df: DataFrame, path: str, form: str = "parquet", include_text: bool = True, rows_per_file: int | None = None, encoding: str = "UTF-8") -> None:
    """Matches as csv, parquet or json, in files of bounded length; reading the folder joins them."""
    df = df if include_text else df.drop(*TEXT_COLUMNS)
    if form == "csv":
        write_csv(df, path, encoding, rows_per_file)
        return
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    {"parquet": writer.parquet, "json": writer.json}[form](path)


def write_alignments(df: DataFrame, path: str) -> None:
    """Alignment matches as CSV by file_a, file_b, start_a: range-sorted files in order."""
    df.orderBy("file_a", "file_b", "start_a").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Documents as JSON lines."""
    df.write.mode("overwrite").json(path)


def review_html(rows: DataFrame) -> Iterator[str]:
    """Lines of an HTML review document, a table per pair; ``rows`` come from ``review_rows``.

    Rows stream through the driver a partition at a time.
    """
    pair = None
    yield "<!DOCTYPE html><meta charset='utf-8'>"
    for r in rows.orderBy("file_a", "file_b", "number").toLocalIterator():
        if pair != (r.file_a, r.file_b):
            if pair:
                yield "</table>"
            pair = (r.file_a, r.file_b)
            yield f"<h2>{html.escape(str(r.file_a))} / {html.escape(str(r.file_b))}</h2><table><tr><th>#<th>A<th>B"
        yield f"<tr><td>{r.number}<td>{html.escape(r.text_a)}<td>{html.escape(r.text_b)}"
    if pair:
        yield "</table>"


def purge(spark, paths: list[str], dry_run: bool = True) -> list[str]:
    """Outputs that exist below ``paths``; deleted unless ``dry_run``.  ``.gitkeep`` files stay."""
    jvm, conf, found = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        for status in fs.listStatus(p) if fs.exists(p) else []:
            if status.getPath().getName() != ".gitkeep":
                found.append(status.getPath().toString())
                if not dry_run:
                    fs.delete(status.getPath(), True)
    return found


def write_transliterated(texts: DataFrame, path: str) -> None:
    """(name, text) transliterated to Wylie, a text folder per name."""
    from weftline.functions.translit import ewts

    texts.select("name", ewts(F.col("text")).alias("text")).write.mode("overwrite").partitionBy("name").text(path)
