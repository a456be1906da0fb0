"""Term divergence between the sources of each language.

Terms are counted by language and source inside the tasks.  A pair of sources is compared over
all kept terms without making a row for each: terms that many sources hold (heavy) go into
dense tiles, blocks of sources by chunks of terms.  Every term starts from what two sources
without it give; the tiles correct that for heavy terms, a histogram of each source's counts
for light ones, and the pairs of posting lists for light terms that both sources hold.  The
partial sums are whole numbers and add up exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.plans.runtime import bounded_broadcast, materialize, small_batches

#: Bytes of a text as terms see it: A-Z lower-cased, other ASCII but a-z as space.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Entries that a task counts before it passes them on: about 60 MB.
HELD = 300_000
#: Bytes that a row of a language or source takes at most where such tables are measured.
LANG_BYTES = 256
#: In a task's counters, one document more; counts below are occurrences.
_DOC = 1 << 44


@dataclass(frozen=True)
class DivergenceParams:
    """``heavy_share``: the share of a language's sources above which a term is heavy."""

    least_docs: int = 10
    scale: int = 1_000_000_000
    top_terms: int = 10
    heavy_share: float = 0.25
    #: Sources of a tile's side, heavy terms of a tile, and light postings of a group.
    block: int = 128
    terms: int = 2048
    postings: int = 250_000


def _names(lang_col: str, source_col: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, count, docs): occurrences and documents, from whole texts; null is ''."""
    small_batches(docs.sparkSession)
    texts = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    source = docs.select(*_names(lang_col, source_col), texts)

    def flush(held: dict[tuple[str, str], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for (lang, src), terms in held.items():
            n = len(terms)
            packed = np.fromiter(terms.values(), np.int64, n)
            columns = [
                pa.array([lang] * n, pa.string()), pa.array([src] * n, pa.string()), pa.array(list(terms), pa.binary()).cast(pa.string()),
                pa.array(packed & (_DOC - 1)), pa.array(packed // _DOC),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "count", "docs"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        size = 0
        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for key, text in zip(keys, batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                terms = held.setdefault(key, {})
                size -= len(terms)
                get = terms.get
                for term, n in Counter(text.translate(_TERMS).split()).items():
                    terms[term] = get(term, 0) + n + _DOC
                size += len(terms)
                if size > HELD:
                    yield from flush(held)
                    size = 0
        yield from flush(held)

    return source.mapInArrow(run, "lang string, source string, term string, count long, docs long")


def _share(count: Column, total: Column, kept: Column, scale: int) -> Column:
    """``1 + floor(scale * (count + 2) / (total + 2 * kept))`` in decimals, so that no count overflows."""
    exact = F.lit(scale).cast("decimal(10,0)") * (count + F.lit(2)).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", exact, (total + F.lit(2) * kept).cast("decimal(20,0)"))


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / (p + q))``; shares are at most 10^9 + 1, so the square fits in 64 bits."""
    d = p - q
    return d * d // (p + q)


def _counted(docs: DataFrame, p: DivergenceParams, lang_col: str, source_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The groups, and the kept terms of each.

    groups: lang, source, g (number within the language), n_groups, p0 (share of a term without
    occurrences, null if the language keeps no term), kept, heavy_terms, light_rows (of the
    language).  postings: lang, source, g, term, p, q, p0, heavy.
    """
    counts = term_counts(docs, lang_col, source_col, text_col)
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    same = W.partitionBy("lang", "term")  # a row for each source at most
    kept = counts.select(
        "lang", "source", "term", "count",
        F.sum("docs").over(same).alias("docs"),
        F.sum("count").over(same).alias("all"),
        F.count(F.lit(1)).over(same).alias("held"),
        (F.min("source").over(same) == F.col("source")).alias("first"),
    ).where(F.col("docs") >= p.least_docs)
    kept = materialize(kept, "kept-terms")
    named = docs.select(*_names(lang_col, source_col)).distinct()
    # A row for each language: sent to every executor where these are few, so a large one isn't one task.
    sources = bounded_broadcast(materialize(named.groupBy("lang").agg(F.count(F.lit(1)).alias("n_groups")), "languages"), LANG_BYTES)
    heavy = F.col("held") > p.heavy_share * F.col("n_groups")
    kept = kept.join(sources, "lang").withColumn("heavy", heavy)
    langs = kept.groupBy("lang").agg(
        F.sum("count").alias("lang_total"), F.count_if("first").alias("kept"),
        F.count_if(F.col("first") & F.col("heavy")).alias("heavy_terms"), F.count_if(~F.col("heavy")).alias("light_rows"),
    )
    langs = bounded_broadcast(materialize(langs, "language-sums"), LANG_BYTES)
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = named.join(totals, ["lang", "source"], "left").join(sources, "lang").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "lang_total", "kept", "heavy_terms", "light_rows"])
    groups = groups.withColumn("g", F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1)
    groups = groups.withColumn("p0", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"), p.scale)))
    groups = materialize(groups, "groups")
    by_group = bounded_broadcast(groups, LANG_BYTES)
    postings = kept.drop("n_groups", "heavy").join(by_group, ["lang", "source"]).select(
        "lang", "source", "g", "term", "p0", "n_groups",
        _share(F.col("count"), F.col("total"), F.col("kept"), p.scale).alias("p"),
        _share(F.col("all"), F.col("lang_total"), F.col("kept"), p.scale).alias("q"),
        heavy.alias("heavy"), "heavy_terms", "light_rows",
    )
    return groups, materialize(postings, "postings")


def _tiles(rows: DataFrame, p: DivergenceParams) -> DataFrame:
    """``rows`` once for each tile (i, j) of source blocks, i <= j, that the source of g belongs to."""
    blocks, own = F.ceil(F.col("n_groups") / p.block).cast("int"), F.floor(F.col("g") / p.block).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))


_SUMS = pa.schema([("lang", pa.string()), ("g", pa.int32()), ("h", pa.int32()), ("value", pa.int64())])


def _sums(lang: str | None, g: np.ndarray, h: np.ndarray, value: np.ndarray) -> pa.Table:
    return pa.table([pa.array([lang] * len(g), pa.string()), pa.array(g, pa.int32()), pa.array(h, pa.int32()), pa.array(value, pa.int64())], schema=_SUMS)


def _upper(lang: str, left: np.ndarray, right: np.ndarray, value: np.ndarray) -> pa.Table:
    """The cells of a tile whose first source comes before the second."""
    at = np.nonzero(left[:, None] < right[None])
    return _sums(lang, left[at[0]], right[at[1]], value[at])


def _columns(group: pa.Table, *names: str) -> list[np.ndarray]:
    return [group.column(n).to_numpy() for n in names]


def dense_sums(groups: DataFrame, postings: DataFrame, p: DivergenceParams) -> DataFrame:
    """What the heavy terms change, in a matrix of terms by sources for each tile and chunk of terms.

    A term that no source of the tile has changes nothing and isn't in its matrix.
    """
    chunks = F.ceil(F.col("heavy_terms") / p.terms).cast("int")
    heavy = postings.where("heavy").select("lang", "g", "n_groups", "term", "p", F.pmod(F.xxhash64("term"), chunks).cast("int").alias("chunk"))
    lacking = groups.where("heavy_terms > 0").select(
        "lang", "g", "n_groups", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")
    )
    rows = _tiles(heavy.unionByName(lacking), p).select("lang", "chunk", "i", "j", "own", "g", "term", "p")

    def run(group: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _SUMS.empty_table()
        terms = group.column("term").combine_chunks().dictionary_encode()
        g, own, share = _columns(group, "g", "own", "p")
        t = terms.indices.fill_null(-1).to_numpy()
        base = t < 0
        ids = np.sort(g[base])
        table = np.empty((len(terms.dictionary), len(ids)), np.int64)
        none = share[base][np.argsort(g[base])]
        table[:] = none
        table[t[~base], np.searchsorted(ids, g[~base])] = share[~base]
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        block = np.empty(len(ids), np.int32)
        block[np.searchsorted(ids, g)] = own
        a, b = table[:, block == i], table[:, block == j]
        total = -len(table) * gap(none[block == i][:, None], none[block == j][None])
        step = max(1, (1 << 21) // max(1, total.size))
        for at in range(0, len(table), step):
            total += gap(a[at : at + step, :, None], b[at : at + step, None, :]).sum(axis=0)
        return _upper(group.column("lang")[0].as_py(), ids[block == i], ids[block == j], total)

    return rows.groupBy("lang", "chunk", "i", "j").applyInArrow(run, "lang string, g int, h int, value long")


def base_sums(groups: DataFrame, postings: DataFrame, p: DivergenceParams) -> DataFrame:
    """Sums as if no source had a heavy term and no light term two sources: a row for every pair.

    Where neither source has the term the gap is that of the two shares without occurrences.  Each
    source's light terms replace it, by a histogram of their shares.
    """
    shares = postings.where(~F.col("heavy")).groupBy("lang", "g", "n_groups", "p").agg(F.count(F.lit(1)).alias("times"))
    none = groups.select("lang", "g", "n_groups", F.coalesce("p0", F.lit(1)).alias("p"), F.col("kept").alias("times"))
    rows = _tiles(shares.withColumn("has", F.lit(True)).unionByName(none.withColumn("has", F.lit(False))), p)

    def run(group: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _SUMS.empty_table()
        g, own, share, times, has = _columns(group, "g", "own", "p", "times", "has")
        order = np.argsort(g[~has])
        ids, block, none, kept = (x[~has][order] for x in (g, own, share, times))
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        neither = gap(none[a][:, None], none[b][None])
        total = neither * kept[:1]

        def replaced(rows_: np.ndarray, cols: np.ndarray, neither_: np.ndarray) -> np.ndarray:
            """For each source of a block, its light terms against sources of the other without them."""
            out = np.zeros(neither_.shape, np.int64)
            for k, at in enumerate(rows_):
                mine = has & (g == ids[at])
                if mine.any():
                    more = gap(share[mine][:, None], none[cols][None]) - neither_[k][None]
                    out[k] = (more * times[mine][:, None]).sum(axis=0)
            return out

        total = total + replaced(a, b, neither) + replaced(b, a, neither.T).T
        return _upper(group.column("lang")[0].as_py(), ids[a], ids[b], total)

    return rows.select("lang", "i", "j", "own", "g", "p", "times", "has").groupBy("lang", "i", "j").applyInArrow(run, "lang string, g int, h int, value long")


def posting_sums(postings: DataFrame, p: DivergenceParams) -> DataFrame:
    """Corrections for the light terms that both sources have, from pairs of their short posting lists."""
    buckets = F.ceil(F.col("light_rows") / p.postings).cast("int")
    rows = postings.where(~F.col("heavy")).select("lang", F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), "g", "term", "p", "p0")

    def run(group: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _SUMS.empty_table()
        t = group.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        g, share, none = _columns(group, "g", "p", "p0")
        order = np.lexsort((g, t))
        t, g, share, none = (x[order] for x in (t, g, share, none))
        width = int(g.max()) + 1
        sums = (np.empty(0, np.int64), np.empty(0, np.int64))
        shift = 1
        while True:
            first = np.flatnonzero(t[shift:] == t[:-shift]) if shift < len(t) else []
            if not len(first):
                break
            x, y = first, first + shift
            both = gap(share[x], share[y]) - gap(share[x], none[y]) - gap(none[x], share[y]) + gap(none[x], none[y])
            keys, at = np.unique(np.concatenate([sums[0], g[x].astype(np.int64) * width + g[y]]), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, at, np.concatenate([sums[1], both]))
            sums = (keys, total)
            shift += 1
        return _sums(group.column("lang")[0].as_py(), sums[0] // width, sums[0] % width, sums[1])

    return rows.groupBy("lang", "bucket").applyInArrow(run, "lang string, g int, h int, value long")


def source_divergence(
    docs: DataFrame,
    params: DivergenceParams | None = None,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source's terms are from the others'.

    Part ``pair``: every other source of the language, with the sum of the gaps of all kept terms.
    Part ``term``: the terms that the source uses more than its language does, with their gap,
    the ``top_terms`` largest.  Ranks count from 1 by value, descending, then by item.

    Null text, lang and source count as ''.  Sources without terms have pairs like others; a
    language that keeps no term gives pairs of value 0, and one of a single source none.  Rows
    that repeat an id or a text count each.  Whole texts count; other columns are ignored; an
    empty table gives an empty result.
    """
    p = params or DivergenceParams()
    groups, postings = _counted(docs, p, lang_col, source_col, text_col)
    parts = [dense_sums(groups, postings, p), base_sums(groups, postings, p), posting_sums(postings, p)]
    sums = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value"))
    name = lambda key, as_: groups.select("lang", F.col("g").alias(key), F.col("source").alias(as_))
    pairs = both.join(name("g", "source"), ["lang", "g"]).join(name("h", "item"), ["lang", "h"])
    gaps = postings.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    ranked = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(ranked)
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", "rank"]
    pairs = pairs.withColumn("rank", rank).select(columns("pair"))
    gaps = gaps.withColumn("rank", rank).where(F.col("rank") <= p.top_terms).select(columns("term"))
    return pairs.unionByName(gaps)
