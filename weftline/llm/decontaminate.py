"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the windows of ``window`` consecutive words of each benchmark item.  The
search alphabet is the word: a table keyed by blocks of two words tells how far the search
position may move without missing a pattern, a block that ends some pattern selects a small
bucket of patterns, and these are compared word by word with the document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import without_ids
from weftline.plans.runtime import materialize, small_batches

WINDOW = 10
SPANS = "array<struct<s:int,e:int>>"
ARROW_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
#: Patterns of so many bytes at most are searched at a time; a larger benchmark takes
#: several passes over each batch of documents, with a searcher per block of items.
BLOCK_BYTES = 64 << 20

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """UTF-8 words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


@dataclass
class WuManber:
    """Patterns of ``length`` words, each with the ids of the items that hold it."""

    length: int
    patterns: dict[tuple[bytes, ...], set[str]] = field(default_factory=dict)
    shift: dict = field(default_factory=dict)
    bucket: dict = field(default_factory=dict)

    def add(self, pattern: tuple[bytes, ...], item: str) -> None:
        self.patterns.setdefault(pattern, set()).add(item)

    def freeze(self) -> WuManber:
        """Build the tables.  Blocks are two words, or one where patterns have one word."""
        m, b = self.length, min(2, self.length)
        for p in self.patterns:
            for end in range(b, m + 1):
                block = p[end - b : end]
                self.shift[block] = min(self.shift.get(block, m - b + 1), m - end)
            self.bucket.setdefault(p[m - b :], {}).setdefault(p[0], []).append(p)
        return self

    def find(self, ws: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, item ids) of every occurrence, in order."""
        m, b, n = self.length, min(2, self.length), len(ws)
        shift, bucket, patterns = self.shift, self.bucket, self.patterns
        far, at = m - b + 1, m
        if b == 1:
            for i, w in enumerate(ws):
                if (w,) in patterns:
                    yield i, patterns[(w,)]
            return
        while at <= n:
            block = (ws[at - 2], ws[at - 1])
            step = shift.get(block, far)
            if step:
                at += step
                continue
            start = at - m
            for p in bucket[block].get(ws[start], ()):
                if tuple(ws[start:at]) == p:
                    yield start, patterns[p]
            at += 1


def searchers(items: Iterable[tuple[str, str | None]], window: int = WINDOW) -> list[WuManber]:
    """One searcher per pattern length: ``window``, and less for items of fewer words."""
    by_length: dict[int, WuManber] = {}
    for item, text in items:
        ws = words(text)
        m = min(window, len(ws))
        for i in range(len(ws) - m + 1 if m else 0):
            by_length.setdefault(m, WuManber(m)).add(tuple(ws[i : i + m]), item)
    return [s.freeze() for s in by_length.values()]


def scan(text: str | None, tables: list[WuManber]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged hit ranges [start, end) in words, and ids of items found."""
    ws = words(text)
    spans, found = [], set()
    for table in tables:
        for start, items in table.find(ws):
            spans.append((start, start + table.length))
            found |= items
    return len(ws), merge(spans), found


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges in order, those that touch or overlap joined."""
    merged: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[tuple[str, str]], bool]]:
    """(block, last): the benchmark in blocks of bounded size, one at a time on the driver; at least one."""
    block, held = [], 0
    rows = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(item_col).cast("string"), text_col, F.octet_length(text_col)
    )
    for item, text, size in rows.toLocalIterator():
        if block and held + size > block_bytes:
            yield block, False
            block, held = [], 0
        block.append((item, text))
        held += size
    yield block, True


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items, spans, contaminated.

    ``items`` are the ids, as sorted strings, of items with an occurring window; ``spans``
    the hit word ranges "start:end", comma-joined.  Null and empty texts have no words and
    no hits, on either side; items with a null id are ignored, repeated items count once per
    id.  Other columns are ignored.  An empty benchmark hits nothing.

    The benchmark travels with the tasks, at most ``block_bytes`` of it at a time (a longer item
    is a block of its own).  A larger one is searched in as many passes, the hits so far written
    to the shared folder between them, so driver and tasks hold one block whatever its size.
    """
    small_batches(docs.sparkSession)
    none = F.array().cast(SPANS), F.array().cast("array<string>")
    found = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
        none[0].alias("spans"), none[1].alias("items"),
    )
    schema = found.schema
    for block, last in _blocks(benchmark, item_col, item_text_col, block_bytes):
        found = found.mapInArrow(_scanner(block, window), schema)
        found = found if last else materialize(found, "hits")
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.array_sort("items").alias("items"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["s"], x["e"])), ",").alias("spans"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _scanner(block: list[tuple[str, str]], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = searchers(block, window)
        for batch in batches:
            counts, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
            for text, (old_spans, old_items) in zip(batch.column("text").to_pylist(), before, strict=True):
                n, hit, found = scan(text, tables)
                counts.append(n)
                hit = merge([*hit, *((x["s"], x["e"]) for x in old_spans)])
                spans.append([{"s": s, "e": e} for s, e in hit])
                items.append(sorted(found.union(old_items)))
            arrays = [pa.array(counts, pa.int64()), pa.array(spans, ARROW_SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), *arrays],
                names=["doc_id", "text", "n_words", "spans", "items"],
            )

    return run


def items_digest(items: list[str]) -> str:
    """SHA-256 of the sorted, comma-joined ids, as in the query's ``items_sha256``."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that hold a window of any benchmark item; other rows whole.

    Rows are matched by id.  Rows that share an id with a contaminated row go as well; a
    null id goes if any row with a null id is contaminated.
    """
    bad = contamination(docs, benchmark, id_col=id_col, **options).where("contaminated")
    return without_ids(docs, id_col, bad.select("doc_id"))
