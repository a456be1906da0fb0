"""Readers: documents, segments, matches and text folders to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.functions.text import coalesced_text, strip
from weftline.plans.runtime import materialize, prefix_sums

DOCUMENT = "text string, content string, file_id string, metadata struct<file_name:string,file_path:string,title:string>"
UNKNOWN = "Unknown_Source"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_number, value, path, path_line) of text files; numbers count all physical lines from 1.

    ``path_line`` counts within a file and ``line_number`` over all files in the order of their
    paths, so it is unique over a folder, the same in every run, and for one file the same as
    ``path_line``.  Nothing is sorted as a whole: a line's number is the lines of earlier files, plus
    those of the file's earlier splits, plus its place in its own.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("i"), "value",
    )
    lines = materialize(lines, "lines")
    splits = lines.groupBy("path", "at").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("first"))
    earlier = W.partitionBy("path").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    splits = materialize(splits.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "splits")
    files = prefix_sums(splits.groupBy("path").agg(F.sum("n").alias("count")), "path").select("path", "before")
    splits = splits.join(files, "path").select("path", "at", "first", "earlier", "before")
    own = F.col("earlier") + F.col("i") - F.col("first") + 1
    return lines.join(splits, ["path", "at"]).select((F.col("before") + own).alias("line_number"), "value", "path", own.alias("path_line"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(line_number, text, file_id, metadata) of a JSON-lines file, or of all files of a folder.

    Blank lines, invalid JSON, records that aren't objects and records without text are left
    out; line numbers count them and go on over the files of a folder.  ``text`` falls back to ``content``.
    """
    lines = numbered_lines(spark, path).withColumn("value", strip(F.col("value"))).where("value <> ''")
    rows = lines.select("line_number", F.from_json("value", DOCUMENT).alias("d"))
    return (
        rows.select("line_number", coalesced_text(F.col("d.text"), F.col("d.content")).alias("text"),
                    F.coalesce("d.file_id", F.lit(UNKNOWN)).alias("file_id"), "d.metadata")
        .where(F.col("text").isNotNull())
    )


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


SEGMENTS = (
    "Segmented_Text string, Segmented_Text_EWTS string, Length int, File_ID string, File_ID_Tibetan string, "
    "Source_Line_Number bigint, Sentence_Order int, Start_Index int, End_Index int"
)


def read_segments(spark: SparkSession, folder: str, max_segments: int | None = None, schema: str | None = SEGMENTS) -> DataFrame:
    """Segment rows of all CSV files of a folder with ``Source_File``, the file's name."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("pathGlobFilter", "*.csv")
    df = (reader.schema(schema) if schema else reader).csv(folder)
    df = df.withColumn("Source_File", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
    if max_segments is None:
        return df
    return df.orderBy("Source_File", "Source_Line_Number", "Sentence_Order").limit(max_segments)


def read_matches(spark: SparkSession, path: str, form: str = "parquet", schema: str | None = None) -> DataFrame:
    """Matches of a csv, parquet or json file or of a folder of chunks."""
    reader = spark.read.schema(schema) if schema else spark.read
    if form == "csv":
        return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if form == "json":
        return reader.option("multiLine", True).json(path)
    if form == "parquet":
        return reader.parquet(path)
    raise ValueError(f"format {form!r} is none of csv, parquet, json")


def read_texts(spark: SparkSession, folder: str, prefix: str = "", recursive: bool = False) -> DataFrame:
    """(name, text) of the .txt files of a folder, whole; names are paths below it after ``prefix``."""
    df = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=recursive)
    path = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    base = folder.rstrip("/").split("://")[-1]
    name = F.substring_index(path, base + "/", -1) if recursive else F.regexp_extract(path, r"([^/]+)$", 1)
    return df.select(F.concat(F.lit(prefix), name).alias("name"), F.col("value").alias("text"))


def query_and_corpus(spark: SparkSession, queries: str, corpus: str) -> tuple[DataFrame, DataFrame]:
    """Texts to compare and the corpus to compare them with, named ``poc/...`` and ``corpus/...``."""
    return read_texts(spark, queries, "poc/"), read_texts(spark, corpus, "corpus/", recursive=True)


def texts_as_documents(texts: DataFrame) -> DataFrame:
    """Document records of text files: ``text``, and ``file_id``, the name without extension."""
    return texts.select("text", F.regexp_replace("name", r"\.txt$", "").alias("file_id"))


def corpus_files(segments: DataFrame) -> DataFrame:
    """The catalogue of corpus files: source_file_id, source_line_number, num_segments, by id."""
    line = F.col("Source_Line_Number")
    return (
        segments.groupBy(F.concat(F.lit("line_"), F.lpad(line.cast("string"), 6, "0")).alias("source_file_id"), line.alias("source_line_number"))
        .agg(F.count(F.lit(1)).alias("num_segments"))
        .orderBy("source_file_id")
    )


def read_vectors(spark: SparkSession, path: str, lines: list[int] | None = None) -> DataFrame:
    """Segments with vectors as ``write_vectors`` left them; only those of the corpus files ``lines`` if given.

    Of a folder per line only the folders asked for are read, of others the filter reaches the scan.
    """
    df = spark.read.parquet(path)
    return df if lines is None else df.where(F.col("Source_Line_Number").isin(lines))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def numbered(df: DataFrame, partition: list[str], order: list[str], name: str = "number") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*partition).orderBy(*order)))
