"""Near-duplicate detection with SimHash fingerprints and a binary trie self-join.

The fingerprints of all documents, each once, form a binary trie.  Pairs of its nodes are
walked together from the root: a pair splits into the pairs of its children, adds up the bits
in which the two prefixes differ, and goes as soon as these exceed the budget.  The upper part
of the walk is a DataFrame of node pairs, joined against node sizes four levels at a time;
a pair whose two nodes are both small enough is finished inside a task, on the sorted
fingerprints below each node, level by level with arrays.  However dense a part of the trie
is, its nodes are split until they are small, so no task depends on the size of a group.

Only distinct fingerprints are joined, and a task answers with a spanning forest of its links,
so exact copies and dense groups make no quadratic output.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.components import connected_components
from weftline.llm.neardup import words
from weftline.plans.runtime import Scratch, materialize, small_batches

SEED = 42
#: Shingles that are hashed at a time.
HASHED = 1 << 16
#: Levels of the trie that one DataFrame step descends.
STEP = 4
#: Fingerprints below a node up to which a task takes it whole.
NODE = 1 << 14
#: Pairs of leaves that a task compares, and node pairs that it holds in a level, at a time.
LEAF_PAIRS, FRONTIER = 64, 1 << 18

#: For every byte, its bits as eight counters of a byte each, the highest bit first.
_LANES = np.packbits(np.zeros((256, 64), np.uint8), axis=1).view(np.uint64).ravel().copy()
_LANES[:] = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set, the highest bit first."""
    counts = np.zeros(64, np.int64)
    bytes_ = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    starts = np.arange(0, len(hashes), 255)  # a counter of a byte holds 255
    for k in range(8):
        if len(starts):
            sums = np.add.reduceat(_LANES[bytes_[:, k]], starts)
            counts[8 * k : 8 * k + 8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, size: int = 3) -> int:
    """SimHash of the text's shingles, repeats included; 0 without words.

    A bit is set if it is set in more than half of the shingles' XXH64 hashes.
    """
    ws = words(text)
    if not ws:
        return 0
    k = min(size, len(ws))
    joined = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = (ends - np.fromiter(map(len, ws), np.int64, len(ws)))[: len(ws) - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHED):
        part = zip(starts[at : at + HASHED], ends[at : at + HASHED], strict=True)
        hashes = [digest(joined[i:j], SEED) for i, j in part]
        counts += bit_counts(np.array(hashes, np.uint64))
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed 64-bit number."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp long")


def _split(x: np.ndarray, lo: np.ndarray, bit: int) -> np.ndarray:
    """Where the fingerprints of each node, which starts at ``lo``, begin to have ``bit`` set."""
    ones = np.uint64(1) << np.uint64(bit)
    return np.searchsorted(x, x[lo] & ~(ones - np.uint64(1)) | ones)


def joined_nodes(a: np.ndarray, b: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in a, place in b) of fingerprints that differ in at most ``budget`` bits after ``depth``.

    Both are sorted and distinct and each shares its leading ``depth`` bits.  ``a is b`` joins a
    node with itself, each pair once.  Node pairs are walked depth first, ``FRONTIER`` at a time.
    """
    below = np.uint64((1 << (64 - depth)) - 1)
    one = lambda v: np.array([v])
    todo = [(depth, one(0), one(len(a)), one(0), one(len(b)), one(0))]
    while todo:
        at, alo, ahi, blo, bhi, bits = todo.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            todo += [(at, *(x[s] for x in (alo, ahi, blo, bhi, bits))) for s in (slice(half), slice(half, None))]
            continue
        small = (ahi - alo) * (bhi - blo) <= LEAF_PAIRS
        if at == 64:
            small[:] = True
        if small.any():
            na, nb = (ahi - alo)[small], (bhi - blo)[small]
            n = na * nb
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i = np.repeat(alo[small], n) + k // np.repeat(nb, n)
            j = np.repeat(blo[small], n) + k % np.repeat(nb, n)
            near = np.bitwise_count((a[i] ^ b[j]) & below) <= budget
            if a is b:
                near &= i < j
            if near.any():
                yield i[near], j[near]
        alo, ahi, blo, bhi, bits = (x[~small] for x in (alo, ahi, blo, bhi, bits))
        if not len(alo):
            continue
        amid, bmid = _split(a, alo, 63 - at), _split(b, blo, 63 - at)
        amid, bmid = np.clip(amid, alo, ahi), np.clip(bmid, blo, bhi)
        children = [(alo, amid, blo, bmid, bits), (amid, ahi, bmid, bhi, bits), (alo, amid, bmid, bhi, bits + 1)]
        other = (amid, ahi, blo, bmid, bits + 1)
        if a is b:  # of a node with itself the mixed pair comes once
            twice = alo != blo
            other = tuple(x[twice] for x in other)
        whole = [np.concatenate(c) for c in zip(*children, other, strict=True)]
        keep = (whole[1] > whole[0]) & (whole[3] > whole[2]) & (whole[4] <= budget)
        todo.append((at + 1, *(x[keep] for x in whole)))


def _forest(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give every place the smallest label that the links reach; ``label`` holds places."""
    while True:
        lx, ly = label[x], label[y]
        apart = lx != ly
        if not apart.any():
            return
        x, y, lx, ly = x[apart], y[apart], lx[apart], ly[apart]
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def node_links(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two nodes, or inside one where ``b`` is None."""
    other = a if b is None else b
    both = a if b is None else np.concatenate([a, b])
    label = np.arange(len(both))
    shift = 0 if b is None else len(a)
    for i, j in joined_nodes(a, other, depth, budget):
        _forest(label, i, j + shift)
    apart = np.flatnonzero(label != np.arange(len(both)))
    return both[apart], both[label[apart]]


def _prefix(depth: int, fp: str = "fp"):
    """The leading ``depth`` bits of a fingerprint."""
    return F.shiftrightunsigned(F.col(fp), 64 - depth) if depth else F.lit(0).cast("long")


def node_pairs(fps: DataFrame, scratch: Scratch, budget: int, node: int) -> DataFrame:
    """(depth, a, b, bits): node pairs that cover every pair within the budget, no node above ``node``.

    ``a`` and ``b`` are prefixes, a <= b, and differ in ``bits``.
    """
    spark = fps.sparkSession
    schema = "depth int, a long, b long, bits int"
    open_ = spark.createDataFrame([(0, 0, 0, 0)], schema)
    closed = None
    large = fps.count() > node
    if not large:
        return open_
    masks = [sum(1 << x for x in c) for n in range(min(budget, STEP) + 1) for c in combinations(range(STEP), n)]
    for depth in range(STEP, 65, STEP):
        sizes = scratch.write(fps.groupBy(_prefix(depth).alias("p")).count(), f"nodes-{depth}")
        child = F.explode(F.sequence(F.lit(0), F.lit((1 << STEP) - 1)))
        down = open_.withColumn("x", child).withColumn("m", F.explode(F.array([F.lit(m) for m in masks])))
        down = down.select(
            F.lit(depth).alias("depth"),
            F.shiftleft("a", STEP).bitwiseOR(F.col("x").cast("long")).alias("a"),
            F.shiftleft("b", STEP).bitwiseOR(F.col("x").bitwiseXOR(F.col("m")).cast("long")).alias("b"),
            (F.col("bits") + F.bit_count("m")).cast("int").alias("bits"),
        ).where((F.col("bits") <= budget) & (F.expr("a <= b") if depth < 64 else F.lit(True)))
        side = lambda c: sizes.select(F.col("p").alias(c), F.col("count").alias(f"n{c}"))  # noqa: E731, B023
        down = scratch.write(down.join(side("a"), "a").join(side("b"), "b"), f"pairs-{depth}")
        wide = (F.col("na") > node) | (F.col("nb") > node)
        done = down.where(~wide).select("depth", "a", "b", "bits")
        closed = done if closed is None else closed.unionByName(done)
        open_ = down.where(wide).select("depth", "a", "b", "bits")
        if open_.isEmpty():
            break
    return scratch.write(closed, "closed")


def linked_fingerprints(fps: DataFrame, scratch: Scratch, budget: int = 2, node: int = NODE) -> DataFrame:
    """(a, b): links of distinct fingerprints that differ in at most ``budget`` bits, a forest of each node pair."""
    pairs = node_pairs(fps, scratch, budget, node)
    depths = [r.depth for r in pairs.select("depth").distinct().collect()]  # 16 at most
    leaves = None
    for depth in depths:
        used = pairs.where(F.col("depth") == depth)
        used = used.select(F.explode(F.array("a", "b")).alias("p")).distinct()
        # A closed node holds ``node`` fingerprints at most.
        held = fps.withColumn("p", _prefix(depth)).join(used, "p", "left_semi").groupBy("p").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
        held = held.withColumn("depth", F.lit(depth))
        leaves = held if leaves is None else leaves.unionByName(held)
    leaves = scratch.write(leaves, "leaves")
    side = lambda c: leaves.select("depth", F.col("p").alias(c), F.col("fps").alias(f"fps_{c}"))
    both = pairs.join(side("a"), ["depth", "a"]).join(side("b"), ["depth", "b"])
    both = both.select("depth", "bits", (F.col("a") == F.col("b")).alias("own"), "fps_a", F.when(F.col("a") != F.col("b"), F.col("fps_b")).alias("fps_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(np.empty(0, np.uint64), np.empty(0, np.uint64))]
            for depth, bits, own, xs, ys in zip(*batch.columns, strict=True):
                a = np.sort(xs.values.to_numpy().view(np.uint64))
                b = None if own.as_py() else np.sort(ys.values.to_numpy().view(np.uint64))
                out.append(node_links(a, b, depth.as_py(), budget - bits.as_py()))
            columns = [pa.array(np.concatenate(c).view(np.int64)) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def simhash_duplicates(
    docs: DataFrame, budget: int = 2, size: int = 3, id_col: str = "doc_id", text_col: str = "text", node: int = NODE
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link if they differ in at most ``budget`` bits; ``component_id`` is the smallest
    id that links reach.  Null, empty and blank texts have fingerprint zero and link like
    others; texts of fewer words than ``size`` are one shingle.  Texts of any length are taken
    whole.  Rows that repeat an id or a text are rows of their own; null ids are never the
    smallest, and a component of null ids alone has a null id.  Other columns are ignored; an
    empty table gives an empty result.
    """
    small_batches(docs.sparkSession, 64)
    with Scratch(docs.sparkSession) as scratch:
        prints = scratch.write(fingerprints(docs, size, id_col, text_col), "fingerprints", keep=True)
        least = scratch.write(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "least", keep=True)
        links = scratch.write(linked_fingerprints(least.select("fp"), scratch, budget, node), "links")
        root = scratch.write(connected_components(links, scratch=scratch), "roots", keep=True)
    own = least.join(root, least["fp"] == root["node"], "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root"))
    lowest = own.groupBy("root").agg(F.min("least").alias("component_id"))
    # Documents alone in their component answer for themselves, so few fingerprints are joined.
    shared = own.join(lowest, "root").where((F.col("rows") > 1) | ~F.col("least").eqNullSafe(F.col("component_id")))
    shared = materialize(shared.select("fp", "component_id"), "components")
    return prints.join(shared.withColumn("found", F.lit(True)), "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
