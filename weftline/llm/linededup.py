"""Removal of repeated line runs by winnowing over line hashes.

A run is a stretch of consecutive lines of at least ``min_words`` words.  From every line
starts one forward window, the shortest stretch that reaches ``min_words``, and at every
line ends one backward window.  The smallest line hash of a window is its fingerprint:
equal windows have equal minima, so every repeated run shares a fingerprint, while most
windows of a corpus fall away because their minimum occurs at one position only.

Windows whose fingerprint is shared are then compared by content: first by the hashes of their
lines, then by the SHA-256 of their text.  A match grows forwards through the windows that start
in it and backwards through those that end in it: each line of a repeated run lies in a forward
window from the run's start or in a backward window that ends at the line, both inside the run,
so together they cover the maximal run exactly.  Growing each pair of positions by itself would
make the pairs of a fingerprint, the square of its occurrences; windows of equal content meet in
one group whose rows are combined before the shuffle.  All occurrences but the first, by document
id and line, are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.llm.common import fresh
from weftline.plans.runtime import Scratch, bounded_broadcast

WORD = r"[^\x20\x09-\x0D]+"
KEY = ["doc_id", "tkey"]
#: Bytes of a pair of hashes in a broadcast table, and the most such a table may take.
KEY_BYTES, KEY_LIMIT = 100, 96 << 20


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tkey and lines of hashes: one row per distinct document with words.

    Rows that agree in id and text are one document, hence the hash of the text in the key.
    """
    line = lambda x: F.struct(
        F.xxhash64(x).alias("h"), F.xxhash64(F.lit(7), x).alias("g"), F.regexp_count(x, F.lit(WORD)).alias("w")
    )
    text = F.col(text_col)
    return (
        docs.where(text.isNotNull())
        .select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text).alias("tkey"),
            F.transform(F.split(text, "\n", -1), line).alias("lines"),
        )
        .dropDuplicates(KEY)
    )


def _windows(documents: DataFrame, min_words: int) -> DataFrame:
    """All windows: doc_id, tkey, start, end, fingerprint (fh, fg) and content (ch, cg).

    Runs in the partitions that ``_documents`` made; lines without words are skipped.
    """
    lines = (
        documents.select(*KEY, F.posexplode("lines").alias("pos", "l"))
        .select(*KEY, "pos", "l.h", "l.g", "l.w")
        .where("w > 0")
    )
    by_pos = W.partitionBy(*KEY).orderBy("pos")
    lines = lines.withColumn("upto", F.sum("w").over(by_pos)).withColumn("before", F.col("upto") - F.col("w"))
    ahead = W.partitionBy(*KEY).orderBy("before").rangeBetween(0, min_words - 1)
    back = W.partitionBy(*KEY).orderBy("upto").rangeBetween(-(min_words - 1), 0)

    def window(over):
        held = F.collect_list(F.struct("h", "g")).over(over)
        return F.struct(
            F.min("pos").over(over).alias("start"),
            F.max("pos").over(over).alias("end"),
            F.sum("w").over(over).alias("words"),
            F.min(F.struct("h", "g")).over(over).alias("f"),
            F.xxhash64(held).alias("ch"),
            F.xxhash64(F.lit(7), held).alias("cg"),
        )

    both = lines.withColumn("a", window(ahead)).withColumn("b", window(back))
    once = F.when(
        (F.col("a.start") == F.col("b.start")) & (F.col("a.end") == F.col("b.end")), F.array("a")
    ).otherwise(F.array("a", "b"))
    return (
        both.select(*KEY, F.explode(once).alias("x"))
        .where(F.col("x.words") >= min_words)
        .select(
            *KEY, "x.start", "x.end", F.col("x.f.h").alias("fh"), F.col("x.f.g").alias("fg"), "x.ch", "x.cg"
        )
    )


def repeated_lines(
    docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, tkey and ``ranges``, the (start, end) of repeated windows, of documents with any.

    Lines count from 0.  ``tkey`` is ``xxhash64`` of the text.
    """
    with Scratch(docs.sparkSession) as scratch:
        windows = scratch.write(_windows(_documents(docs, id_col, text_col), min_words), "line-windows")
        # Fingerprints that windows of different content or place share.  Equal windows in one
        # place are one row; overlapping windows of a document may share a minimum, which only
        # lets them through to the comparison of contents.
        shared = windows.groupBy("fh", "fg").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fh", "fg")
        shared = bounded_broadcast(scratch.write(shared, "fingerprints"), KEY_BYTES, KEY_LIMIT)
        candidates = scratch.write(windows.join(shared, ["fh", "fg"], "left_semi").drop("fh", "fg"), "candidates")
        alike = candidates.groupBy("ch", "cg").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("ch", "cg")
        alike = bounded_broadcast(scratch.write(alike, "contents"), KEY_BYTES, KEY_LIMIT)
        repeated = candidates.join(alike, ["ch", "cg"], "left_semi").groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
        repeated = scratch.write(repeated, "repeated")
        digests = scratch.write(_digests(docs, repeated, id_col, text_col), "digests")
        first = digests.groupBy("digest").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        later = digests.join(first, "digest").where(~F.struct(*PLACE).eqNullSafe(F.col("first")))
        ranges = later.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
        return scratch.write(ranges, "line-ranges", keep=True)


PLACE = (*KEY, "start", "end")


def _digests(docs: DataFrame, repeated: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tkey, start, end and ``digest``, the SHA-256 of the window's lines with words.

    Windows whose hashes agree are compared by this digest of their text.
    """
    size = F.size("ranges") * 8 + 64
    both = _with_ranges(docs, bounded_broadcast(repeated, size), id_col, text_col)
    # Lines without words become null and array_join skips them.
    line = F.transform(F.split(text_col, "\n", -1), lambda x: F.when(x.rlike(WORD), x))
    both = both.select("doc_id", "tkey", line.alias("lines"), "ranges").dropDuplicates(KEY)
    text = lambda r: F.array_join(F.slice(F.col("lines"), r["start"] + 1, r["end"] - r["start"] + 1), "\n")
    windows = F.transform("ranges", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.sha2(text(r), 256).alias("digest")))
    return both.select(*KEY, F.explode(windows).alias("w")).select(*KEY, "w.*")


def _with_ranges(docs: DataFrame, ranges: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tkey, the text and the ranges of the documents that have some."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col)).where(F.col(text_col).isNotNull())
    return source.join(ranges, source["id"].eqNullSafe(ranges["doc_id"]) & (F.xxhash64(text_col) == ranges["tkey"]))


def drop_repeated_lines(
    docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with cleaned text and n_lines, n_deleted, deleted_lines (positions from 0).

    All columns of ``docs`` stay.  A null text stays null and has no lines; an empty text is
    one empty line.  Lines without words don't count in comparisons; inside a repeated window
    they go with it, elsewhere they stay.  Rows that repeat an id with the same text are one document
    and are cleaned alike.  Null ids come first in
    the order of documents.
    """
    ranges = repeated_lines(docs, min_words, id_col, text_col)
    deleted = F.flatten(F.transform("ranges", lambda r: F.sequence(r["start"], r["end"])))
    doc, hashed, gone = fresh(docs, "id"), fresh(docs, "tkey"), fresh(docs, "gone")
    edits = ranges.select(
        F.col("doc_id").alias(doc), F.col("tkey").alias(hashed), F.array_sort(F.array_distinct(deleted)).alias(gone)
    )
    edits = bounded_broadcast(edits, F.size(gone) * 4 + 64)
    text = docs[text_col]
    out = docs.join(edits, docs[id_col].eqNullSafe(edits[doc]) & (F.xxhash64(text) == edits[hashed]), "left")
    # The lambda binds the split lines once; indexing them is then constant time.
    held = F.array(F.struct(F.split(text, "\n", -1).alias("lines"), F.col(gone).alias("gone")))
    none = F.array().cast("array<int>")
    kept = F.transform(
        held,
        lambda s: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(s["lines"]) - 1), F.coalesce(s["gone"], none)),
                lambda i: F.get(s["lines"], i),
            ),
            "\n",
        ),
    )[0]
    cleaned = F.when(F.col(gone).isNull(), text).otherwise(kept)
    own = [docs[c] for c in docs.columns if c != text_col]
    out = out.select(
        *own,
        cleaned.alias(text_col),
        F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit("\n")) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_deleted"),
        F.coalesce(F.array_join(gone, ","), F.lit("")).alias("deleted_lines"),
    )
    return out
