"""Near-duplicate detection with SetSketch registers.

Every distinct shingle of a document draws one exponential value per register, in ascending
order, and a register holds the truncated, exponentially spaced level of the smallest value
it saw.  Registers of two sets merge by maximum, and they agree about as often as the sets
overlap.  Bands of registers propose pairs; the numbers of registers that are larger, smaller
and equal give the likelihood of each Jaccard similarity, and pairs whose most likely
similarity is far below the threshold go; the rest are confirmed on the full shingle sets.

Documents with equal shingle sets are one class from the start.  In a few rounds every class
is tried with one leader of its buckets, the same class in every bucket as far as buckets share
members, and components follow: a group of near copies makes one pair for each member and
round.  Then every pair of classes of a bucket that is still in different components is tried,
block against block inside a task, which answers only with the links that join components.
Pairs within one component can't change the result, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import fresh, without_ids
from weftline.llm.components import connected_components
from weftline.plans.runtime import Scratch, bounded_broadcast, materialize, small_batches

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_U = np.uint64
#: Word hashes that a Python worker keeps: about 30 MB.
WORD_CACHE = 150_000


@dataclass(frozen=True)
class SketchParams:
    """``registers`` is prime, so that a stride visits them all; ``bands * rows`` of them band.

    At similarity 0.8 a pair shares no band with probability (1 - 0.8^6)^35, 2 in 100,000.
    """

    shingle: int = 5
    threshold: int = 80  # per cent
    registers: int = 211
    bands: int = 35
    rows: int = 6
    base: float = 1.001
    rate: float = 20.0
    limit: int = 65534
    #: Pairs are confirmed on full sets if their most likely similarity is at least the
    #: threshold less this, five standard errors of the estimate.
    margin: float = 0.15


def words(text: str | None) -> list[bytes]:
    """UTF-8 words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(ws: list[bytes], size: int, seen: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than ``size`` make one.

    ``seen`` caches word hashes between calls.
    """
    if not ws:
        return np.empty(0, np.uint64)
    if len(seen) > WORD_CACHE:
        seen.clear()
    ids = np.empty(len(ws), np.uint64)
    for i, w in enumerate(ws):
        h = seen.get(w)
        if h is None:
            h = seen[w] = xxhash.xxh3_64_intdigest(w)
        ids[i] = h
    k = min(size, len(ws))
    h = np.full(len(ws) - k + 1, k, np.uint64)
    for j in range(k):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + ids[j : len(ws) - k + 1 + j])
    return np.unique(h)


def registers(hashes: np.ndarray, p: SketchParams) -> np.ndarray:
    """SetSketch registers (uint16) of a set of 64-bit hashes.

    Element d visits the registers in the order start + j * stride; its j-th value is the
    (j-1)-th plus an exponential gap of rate ``rate * (m + 1 - j)``, so the m values are those
    of m independent exponentials in ascending order.  An element stops once its value exceeds
    the largest minimum: later ones change nothing.
    """
    m = p.registers
    least = np.full(m, np.inf)
    start = (_mix(hashes + _U(1)) % _U(m)).astype(np.int64)
    stride = (_mix(hashes + _U(2)) % _U(m - 1)).astype(np.int64) + 1
    key, value = _mix(hashes + _U(3)), np.zeros(len(hashes))
    j = 0
    while j < m and len(key):
        step = min(m - j, 8 if len(key) > 100 else 32 if len(key) > 20 else m)
        js = np.arange(j, j + step)
        u = _mix(key[:, None] + (js.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15)[None]) >> _U(11)
        gaps = -np.log((u.astype(np.float64) + 0.5) * 2.0**-53) / (p.rate * (m - js))
        values = value[:, None] + np.cumsum(gaps, axis=1)
        at = (start[:, None] + js * stride[:, None]) % m
        order = np.argsort(values, axis=None)[::-1]  # the smallest is written last
        fresh = np.full(m, np.inf)
        fresh[at.ravel()[order]] = values.ravel()[order]
        least = np.minimum(least, fresh)
        value = values[:, -1]
        alive = value < least.max()
        key, value, start, stride = key[alive], value[alive], start[alive], stride[alive]
        j += step
    level = np.floor(1.0 - np.log(least) / np.log(p.base))
    return np.clip(level, 0, p.limit + 1).astype(np.uint16)


def band_keys(regs: np.ndarray, p: SketchParams) -> np.ndarray:
    """One 64-bit key per band, over its number and its register values; the last axis holds registers."""
    table = regs[..., : p.bands * p.rows].astype(np.uint64).reshape(*regs.shape[:-1], p.bands, p.rows)
    h = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64), table.shape[:-1])
    for j in range(p.rows):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + table[..., j])
    return h.view(np.int64)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate_jaccard(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, p: SketchParams) -> np.ndarray:
    """Most likely similarity of pairs from their register comparisons and set sizes.

    ``larger`` and ``smaller`` count registers where a's level is above or below b's.  With
    shares u, v of the sizes a level is above with probability q(u - v J), below with
    q(v - u J), where q(x) = -log_base(1 - x (base - 1) / base).  The likelihood is maximised
    over a grid of 401 similarities from 0 to the largest that the sizes allow.
    """
    u = (n_a / (n_a + n_b))[:, None]
    v = 1.0 - u
    grid = np.linspace(0, 1, 401)[None] * np.minimum(u / v, v / u)

    def q(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (p.base - 1) / p.base) / np.log(p.base)

    above, below = q(u - v * grid), q(v - u * grid)
    tiny = 1e-12
    ll = (
        larger[:, None] * np.log(above + tiny)
        + smaller[:, None] * np.log(below + tiny)
        + equal[:, None] * np.log(np.clip(1 - above - below, tiny, 1))
    )
    return grid[np.arange(len(grid)), ll.argmax(axis=1)]


def sketches(docs: DataFrame, p: SketchParams, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (set size), class (digest of the set), regs, bands; the last three null without words."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            n, cls, regs, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(words(text), p.shingle, seen)
                n.append(len(s))
                if len(s):
                    r = registers(s, p)
                    cls.append(xxhash.xxh3_128_digest(s.tobytes()))
                    regs.append(r.tobytes())
                    bands.append(band_keys(r, p))
                else:
                    cls.append(None), regs.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                    pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "class", "regs", "bands"],
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, n long, class binary, regs binary, bands array<long>")


@dataclass
class _Classes:
    """Arrow columns of a table of classes as arrays: digests, sizes, registers and full sets."""

    cls: list[bytes]
    n: np.ndarray
    regs: np.ndarray
    sets: list[np.ndarray]

    @staticmethod
    def of(table: pa.Table | pa.RecordBatch, suffix: str = "") -> _Classes:
        cls, regs, sets = (table.column(c + suffix).to_pylist() for c in ("class", "regs", "hashes"))
        return _Classes(
            cls,
            table.column("n" + suffix).to_numpy(zero_copy_only=False).astype(float),
            np.frombuffer(b"".join(regs), np.uint16).reshape(len(regs), -1),
            [np.frombuffer(s, np.uint64) for s in sets],
        )


def _likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, p: SketchParams) -> np.ndarray:
    """Which rows of two register arrays belong to pairs that are to be confirmed on full sets."""
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    keep = estimate_jaccard(larger, smaller, b.shape[1] - larger - smaller, na, nb, p) >= p.threshold / 100 - p.margin
    return keep & (100 * np.minimum(na, nb) >= p.threshold * np.maximum(na, nb))  # exact bound


def _linked(x: np.ndarray, y: np.ndarray, p: SketchParams) -> bool:
    """``100 * intersection >= threshold * union``, on full sets."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= p.threshold * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, near: DataFrame, p: SketchParams) -> DataFrame:
    """Pairs (a, b), by the 64-bit handles of classes, that are likely and link on their full sets.

    ``pairs`` holds a few rows for each class, so both joins make a row for each pair.
    """
    side = lambda x: near.select(F.col("handle").alias(x), *[F.col(c).alias(c + x) for c in ("class", "n", "regs", "hashes")])
    both = pairs.join(side("a"), "a").join(side("b"), "b").drop("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _Classes.of(batch, "a"), _Classes.of(batch, "b")
            keep = _likely(x.regs, y.regs, x.n, y.n, p)
            keep = [bool(k) and _linked(s, t, p) for k, s, t in zip(keep, x.sets, y.sets, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("classa").filter(pa.array(keep)), batch.column("classb").filter(pa.array(keep))], names=["a", "b"]
            )

    return both.mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, params: SketchParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents link if the Jaccard similarity of their shingle sets is at least the threshold;
    ``component_id`` is the smallest id that links reach.  Texts without words (null, empty,
    white space) link with nothing.  Rows that repeat an id with other text link like other
    documents; rows that repeat id and text get equal results.  Null ids are never the
    smallest.  Other columns are ignored; an empty table gives an empty result.
    """
    p = params or SketchParams()
    small_batches(docs.sparkSession)
    with Scratch(docs.sparkSession) as scratch:
        sketch = scratch.write(sketches(docs, p, id_col, text_col), "sketches", keep=True)
        buckets = scratch.write(_buckets(sketch), "buckets")
        near = scratch.write(_near(docs, sketch, buckets, p, id_col, text_col), "near")
        placed = buckets.select("key", "class", "handle", "n").withColumn("root", F.col("class"))
        found, root = None, None
        for salt in range(LEADER_ROUNDS):
            pairs = _first_leaders(buckets) if salt == 0 else _leaders(placed, salt)
            links = scratch.write(_confirmed(pairs, near, p), f"links-{salt}")
            found = links if found is None else found.unionByName(links)
            root = connected_components(found, scratch=scratch)
            placed = scratch.write(_open_buckets(placed, root), f"open-{salt}")
        found = found.unionByName(scratch.write(_block_links(placed, near, p), "links-blocks"))
        root = scratch.write(connected_components(found, scratch=scratch), "roots", keep=True)
    return _resolved(sketch, root)


#: Rounds in which every class is tried with one leader.
LEADER_ROUNDS = 3


def _buckets(sketch: DataFrame) -> DataFrame:
    """(key, class, handle, n, low) of band buckets with more than one class.

    ``handle`` is a 64-bit hash of the class and ``low`` the least of the bucket: its first
    leader, the same class in every bucket that holds it.  Copies are combined before the
    shuffle, and what is shuffled is two handles for each key of a partition.
    """
    members = sketch.where(F.col("class").isNotNull()).select(
        "class", F.xxhash64("class").alias("handle"), "n", F.explode("bands").alias("key")
    )
    mixed = members.groupBy("key").agg(F.min("handle").alias("low"), F.max("handle").alias("high")).where("low <> high")
    mixed = bounded_broadcast(materialize(mixed.select("key", "low"), "mixed"), 40)
    return members.join(mixed, "key").groupBy("key", "class", "handle", "n").agg(F.min("low").alias("low"))


def _near(docs: DataFrame, sketch: DataFrame, buckets: DataFrame, p: SketchParams, id_col: str, text_col: str) -> DataFrame:
    """One row for each class in a bucket: class, handle, n, regs and ``hashes``, its full set.

    Each class is represented by one document.  Ids may repeat with other text, so the class
    is computed again and must agree.
    """
    wanted = buckets.select("class").distinct()
    chosen = (
        sketch.where(F.col("class").isNotNull()).join(wanted, "class", "left_semi")
        .groupBy("class").agg(F.min("doc_id").alias("least"))
    )
    chosen = bounded_broadcast(materialize(chosen, "chosen"), 64)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = source.join(chosen, source["doc_id"].eqNullSafe(chosen["least"])).select("class", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            cls, n, regs, hashes = [], [], [], []
            for c, t in zip(batch.column("class").to_pylist(), batch.column("text").to_pylist(), strict=True):
                s = shingle_set(words(t), p.shingle, seen)
                if xxhash.xxh3_128_digest(s.tobytes()) == c:
                    cls.append(c), n.append(len(s)), hashes.append(s.tobytes()), regs.append(registers(s, p).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(regs, pa.binary()), pa.array(hashes, pa.binary())],
                names=["class", "n", "regs", "hashes"],
            )

    rows = both.mapInArrow(run, "class binary, n long, regs binary, hashes binary").dropDuplicates(["class"])
    return rows.withColumn("handle", F.xxhash64("class"))


def _first_leaders(buckets: DataFrame) -> DataFrame:
    """Pairs (a, b) of handles: each class with the least of its buckets' leaders."""
    return buckets.where("handle <> low").groupBy(F.col("handle").alias("a")).agg(F.min("low").alias("b"))


def _leaders(placed: DataFrame, salt: int) -> DataFrame:
    """Pairs (a, b) of handles: each class of an open bucket with one leader of another component.

    A bucket's leader is the class with the least salted hash, so mostly one of the bucket's
    largest component, whose members then make no pair.
    """
    drawn = F.struct(F.xxhash64(F.lit(salt), "handle").alias("drawn"), "handle", "root")
    first = placed.groupBy("key").agg(F.min(drawn).alias("leader"))
    other = placed.join(first, "key").where(F.col("root") != F.col("leader.root"))
    return other.groupBy(F.col("handle").alias("a")).agg(F.min("leader").alias("leader")).select("a", F.col("leader.handle").alias("b"))


def _open_buckets(placed: DataFrame, root: DataFrame) -> DataFrame:
    """(key, class, handle, n, root) of the buckets that span more than one component."""
    label = root.select(F.col("node").alias("class"), F.col("root").alias("label"))
    placed = placed.drop("root").join(label, "class", "left").select(
        "key", "class", "handle", "n", F.coalesce("label", "class").alias("root")
    )
    code = F.xxhash64("root")
    keys = placed.groupBy("key").agg(F.min(code).alias("r0"), F.max(code).alias("r1")).where("r0 <> r1").select("key")
    return placed.join(keys, "key", "left_semi")


#: Members of a block, and shingles of all their sets together.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22


def _block_links(placed: DataFrame, near: DataFrame, p: SketchParams) -> DataFrame:
    """(a, b): links between components inside a bucket, from all of its pairs of classes.

    A bucket's largest component and the rest are dealt into blocks of about ``BLOCK`` members
    or ``BLOCK_SHINGLES`` shingles, whichever makes more.  Each block of the rest meets itself, the
    others of the rest and each block of the largest component in a group, so a group holds two
    blocks whatever the bucket's size, and a component with a few classes beside it is sent once.
    Small buckets share groups.  Pairs are tried in the first band that both classes share.
    """
    per = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    per = per.groupBy("key").agg(F.max(F.struct("c", "root", "w")).alias("top"), F.sum("c").alias("members"), F.sum("w").alias("weight"))
    rows = placed.join(per, "key")
    all_ = placed.agg(F.count(F.lit(1)).alias("c"), F.coalesce(F.sum("n"), F.lit(0)).alias("w")).first()
    bins = max(1, all_["c"] // BLOCK, all_["w"] // BLOCK_SHINGLES)
    large, main = (F.col("members") > BLOCK) | (F.col("weight") > BLOCK_SHINGLES), F.col("root") == F.col("top.root")
    blocks = lambda c, w: F.greatest(F.ceil(c / BLOCK), F.ceil(w / BLOCK_SHINGLES)).cast("int")
    rest_blocks = blocks(F.col("members") - F.col("top.c"), F.col("weight") - F.col("top.w"))
    main_blocks = blocks(F.col("top.c"), F.col("top.w"))
    rows = rows.select(
        "key", "class", "root", large.alias("large"),
        F.when(large, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(bins))).alias("place"),
        F.when(large, rest_blocks).otherwise(1).alias("rests"),
        F.when(large, rest_blocks + main_blocks).otherwise(1).alias("blocks"),
        F.when(~large, 0).when(main, rest_blocks + F.pmod(F.xxhash64("class"), main_blocks))
        .otherwise(F.pmod(F.xxhash64("class"), rest_blocks)).cast("int").alias("own"),
    )
    last = F.when(F.col("own") < F.col("rests"), F.col("blocks")).otherwise(F.col("rests")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.select(
        "key", "class", "root", "large", "place", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    rows = rows.join(near.select("class", "n", "regs", "hashes"), "class")

    def run(group: pa.Table) -> pa.Table:
        out: list[tuple[bytes, bytes]] = []
        if group.num_rows:
            keys = group.column("key").to_numpy()
            i, j, own = group.column("i")[0].as_py(), group.column("j")[0].as_py(), group.column("own").to_numpy()
            component = group.column("root").combine_chunks().dictionary_encode().indices.to_numpy().copy()
            members = _Classes.of(group)
            bands = band_keys(members.regs, p)
            order = np.argsort(keys, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
                first = int(np.flatnonzero(bands[at[0]] == keys[at[0]])[0])
                out += _bucket_links(members, at[own[at] == i], at[own[at] == j], bands[:, :first], component, p)
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return rows.groupBy("large", "place", "i", "j").applyInArrow(run, "a binary, b binary")


def _bucket_links(m: _Classes, x: np.ndarray, y: np.ndarray, before: np.ndarray, component: np.ndarray, p: SketchParams) -> list[tuple[bytes, bytes]]:
    """Links between the members ``x`` and ``y`` of one bucket.

    ``before`` holds the keys of the bands before the bucket's, whose pairs are tried there;
    ``component`` is updated by the links.
    """
    out = []
    same = np.array_equal(x, y)
    for place, k in enumerate(x.tolist()):
        with_ = y[place + 1 :] if same else y
        n = m.n[with_]
        open_ = (component[with_] != component[k]) & (100 * np.minimum(m.n[k], n) >= p.threshold * np.maximum(m.n[k], n))
        with_ = with_[open_ & ~(before[with_] == before[k]).any(axis=1)]
        if len(with_):
            with_ = with_[_likely(m.regs[k][None], m.regs[with_], np.full(len(with_), m.n[k]), m.n[with_], p)]
        for o in with_.tolist():
            if component[k] == component[o]:
                continue
            if _linked(m.sets[k], m.sets[o], p):
                out.append((m.cls[k], m.cls[o]))
                component[component == component[o]] = component[k]
    return out


def _resolved(sketch: DataFrame, root: DataFrame) -> DataFrame:
    """The result rows, from the classes' roots."""
    slim = sketch.select("doc_id", "n", "class")
    least = slim.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    by_root = (
        least.join(root, least["class"] == root["node"])
        .groupBy("root").agg(F.min("least").alias("component"))
    )
    linked = root.join(by_root, "root").select(F.col("node").alias("class"), "component")
    least = least.join(linked, "class", "left").select("class", F.coalesce("component", "least").alias("component"))
    return (
        slim.join(least, "class", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(
    docs: DataFrame, params: SketchParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id, and all else.

    Rows that repeat an id and its text are one document: one of them stays.  Rows with a null id stay.
    """
    result = materialize(near_duplicates(docs, params, id_col, text_col), "near-duplicates")
    out = without_ids(docs, id_col, result.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id"))
    twice = result.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
    name = fresh(docs, "twice")
    twice = bounded_broadcast(materialize(twice.select(F.col("doc_id").alias(name)), "repeated-ids"), 32)
    if twice.isEmpty():
        return out
    again = out.join(twice, out[id_col] == F.col(name), "left_semi").dropDuplicates([id_col, text_col])
    return out.join(twice, out[id_col] == F.col(name), "left_anti").unionByName(again)
