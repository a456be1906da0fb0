from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.cases import SCHEMA, frame, rows
from weftline.llm import simhash as S
from weftline.plans.runtime import Scratch

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, k=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    k = min(k, len(ws))
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + k]).encode(), 42) for i in range(len(ws) - k + 1)] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(data, budget=2):
    """(id, fingerprint, smallest id reachable) of each row, by all pairs."""
    prints = [plain(r[1]) for r in data]
    return list(zip([r[0] for r in data], [f"{x:016x}" for x in prints], components([r[0] for r in data], prints, budget)))


def components(ids, prints, budget):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(prints):
        for j, y in enumerate(prints[:i]):
            if (x ^ y).bit_count() <= budget:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, d in enumerate(ids):
        if d is not None:
            groups[find(i)].append(d)
    return [min(groups[find(i)], default=None) for i in range(len(ids))]


order = lambda x: sorted(map(tuple, x), key=str)


def test_cases(spark):
    data = rows()
    assert order(S.simhash_duplicates(frame(spark)).collect()) == order(brute(data))
    assert S.simhash_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("node", [S.NODE, 6])
def test_near_texts(spark, node):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    data = []
    for g in range(12):
        base = [word() for _ in range(rng.randrange(1, 300))]
        for k in range(5):
            near = list(base)
            near[rng.randrange(len(near))] = word()
            data.append((100 * g + k, " ".join(base if k == 4 else near)))
    full = [(*r, "en", "s", 1, "", "", "", "") for r in data]
    assert order(S.simhash_duplicates(frame(spark, full), node=node).collect()) == order(brute(data))


def clustered(seed, n=400):
    """Random fingerprints, chains of single flips and a dense ball, so that the trie is uneven."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    x = rng.getrandbits(64)
    for _ in range(60):
        x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        out.add(x)
    hub = rng.getrandbits(64)
    for _ in range(200):
        out.add(hub ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return sorted(out | {0, 1, 2**64 - 1, 2**63})


@pytest.mark.parametrize("seed", range(4))
def test_trie_join_finds_every_pair(monkeypatch, seed):
    x = np.array(clustered(seed), np.uint64)
    monkeypatch.setattr(S, "LEAF_PAIRS", 3)
    monkeypatch.setattr(S, "FRONTIER", 50)
    for budget in (0, 1, 2, 3):
        want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if (int(x[i]) ^ int(x[j])).bit_count() <= budget}
        got = [(int(i), int(j)) for a, b in S.joined_nodes(x, x, 0, budget) for i, j in zip(a, b)]
        assert len(got) == len(set(got)) and {tuple(sorted(p)) for p in got} == want


@pytest.mark.parametrize(("seed", "node", "budget"), [(1, 40, 2), (2, 5, 2), (3, 1, 2), (4, 30, 1), (5, 10, 3)])
def test_links_for_any_node_size(spark, seed, node, budget):
    """Node pairs that end at different depths, down to single fingerprints."""
    from weftline.llm.components import connected_components

    prints = clustered(seed)
    fps = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in prints], "fp long")
    with Scratch(spark) as scratch:
        links = scratch.write(S.linked_fingerprints(fps, scratch, budget, node), "links")
        root = {r.node: r.root for r in connected_components(links).collect()}
    signed = [int(np.uint64(x).astype(np.int64)) for x in prints]
    assert [root.get(x, x) for x in signed] == components(signed, prints, budget)


def test_fingerprint_of_long_text(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(3000))
    want = plain(text)
    assert S.fingerprint(text) == want
    monkeypatch.setattr(S, "HASHED", 100)
    assert S.fingerprint(text) == want


def test_bit_counts():
    h = np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64)
    assert S.bit_counts(h).tolist() == [sum(int(x) >> b & 1 for x in h) for b in range(63, -1, -1)]
    assert S.bit_counts(h[:0]).tolist() == [0] * 64
