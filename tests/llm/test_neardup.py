from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.cases import SCHEMA, frame, rows
from weftline.llm import neardup
from weftline.llm.components import connected_components
from weftline.llm.neardup import SketchParams

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    ws = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(FOLD)) if w]
    k = min(k, len(ws))
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if ws else set()


def brute(data, k, threshold=80):
    """(id, set size, smallest id reachable) of each row, by all pairs."""
    sets = [(r[0], shingles(r[1], k)) for r in data]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(sets):
        if d is not None:
            groups[find(i)].append(d)
    return [(d, len(s), min(groups[find(i)], default=None)) for i, (d, s) in enumerate(sets)]


order = lambda rows: sorted(rows, key=str)


@pytest.mark.parametrize("k", [2, 5])
def test_cases(spark, k):
    got = neardup.near_duplicates(frame(spark), SketchParams(shingle=k)).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute(rows(), k))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = neardup.drop_near_duplicates(frame(spark), SketchParams(shingle=k))
    assert left.columns == frame(spark).columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(1) == 1 and ids.count(3) == 0 and ids.count(4) == 1


@pytest.mark.parametrize(("k", "rounds", "block", "shingles"), [(5, 3, 1024, 1 << 22), (2, 1, 8, 1 << 22), (2, 1, 1024, 700)])
def test_chains_and_groups(spark, monkeypatch, k, rounds, block, shingles):
    """Drifting edits, so that ends of a chain aren't similar, and a large group of near copies.

    Buckets share a group or go block against block, by members or by shingles.
    """
    monkeypatch.setattr(neardup, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", shingles)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    data, base = [], [word() for _ in range(80)]
    for i in range(40):  # each link changes two words more
        base = list(base)
        base[(2 * i) % 80] = word()
        data.append((100 + i, " ".join(base)))
    hub = [word() for _ in range(120)]
    for i in range(80):
        near = list(hub)
        near[rng.randrange(120)] = word()
        data.append((500 + i, " ".join(near)))
    data += [(900 + i, " ".join(word() for _ in range(60))) for i in range(30)]
    data = [(*r, "en", "s", 1, "", "", "", "") for r in data]
    got = neardup.near_duplicates(frame(spark, data), SketchParams(shingle=k)).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute(data, k))


def test_long_half_similar_texts(spark):
    """Long texts that are nearly similar enough and never link make no rows for their pairs."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    base = [word() for _ in range(6000)]
    data = []
    for i in range(60):
        near = list(base)
        for at in rng.sample(range(6000), 480):  # about 0.73 of the pairs of words stay shared
            near[at] = word()
        data.append((i, " ".join(near), "en", "s", 1, "", "", "", ""))
    data += [(100 + i, data[i][1] + " more", *data[i][2:]) for i in range(3)]
    docs = frame(spark, data)
    p = SketchParams(shingle=2)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, p).collect()}
    assert got == {i: i for i in range(60)} | {100 + i: i for i in range(3)}


def test_null_ids_stay(spark):
    """A repeated id elsewhere doesn't merge rows without an id."""
    left = neardup.drop_near_duplicates(frame(spark))
    assert sum(r.doc_id is None for r in left.collect()) == sum(r[0] is None for r in rows())
    data = [(None, "one two three four five six", *["x"] * 2, 1, *["x"] * 4)] * 2 + [(7, "a b c", *["x"] * 2, 1, *["x"] * 4)] * 2
    assert sorted(str(r.doc_id) for r in neardup.drop_near_duplicates(frame(spark, data)).collect()) == ["7", "None", "None"]


def test_empty(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registers_merge_and_estimate():
    p = SketchParams()
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
    for share in (0.2, 0.5, 0.8, 0.95):
        n = len(a)
        common = round(2 * n * share / (1 + share))
        b = np.concatenate([a[:common], rng.integers(0, 2**63, n - common).astype(np.uint64)])
        ra, rb = neardup.registers(np.unique(a), p), neardup.registers(np.unique(b), p)
        union = neardup.registers(np.unique(np.concatenate([a, b])), p)
        assert (neardup.merge_registers(ra, rb) == union).all()
        counts = [np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([(ra == rb).sum()])]
        sizes = np.array([float(n)])
        assert abs(neardup.estimate_jaccard(*counts, sizes, sizes, p)[0] - share) < 0.15


def test_registers_do_not_depend_on_early_stops():
    """An element's later values may be skipped only if they change nothing."""
    p = SketchParams()
    h = np.unique(np.random.default_rng(2).integers(0, 2**63, 400).astype(np.uint64))
    single = [neardup.registers(h[i : i + 1], p) for i in range(len(h))]
    assert (np.maximum.reduce(single) == neardup.registers(h, p)).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (5, 6), (6, 7), (20, 21), (20, 22), (20, 23)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 8, 9: 8, 20: 20, 21: 20, 22: 20, 23: 20}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
