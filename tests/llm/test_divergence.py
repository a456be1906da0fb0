from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import SCHEMA, frame, rows
from weftline.llm import divergence as D

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data, least=10, top=10):
    """All terms of all pairs, with Python's whole numbers."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))) for lang, source, text in data]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for l, _, ws in docs if l == lang for t in set(ws))
        kept = sorted(t for t, n in seen.items() if n >= least)
        sources = sorted({s for l, s, _ in docs if l == lang})
        count = {s: Counter(t for l, x, ws in docs if (l, x) == (lang, s) for t in ws if t in set(kept)) for s in sources}
        total = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: share(count[s]) for s in sources}, share(total)
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def made(seed, n_sources=9):
    rng = random.Random(seed)
    vocabulary = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}é" for i in range(80)]
    data = []
    for i in range(400):
        s = 0 if rng.random() < 0.4 else rng.randrange(n_sources)  # a hot source
        words = [rng.choice(vocabulary if rng.random() < 0.3 else vocabulary[(7 * s) % 60 : (7 * s) % 60 + 20]) for _ in range(rng.randrange(30))]
        data.append(("en" if rng.random() < 0.7 else None, f"s{s}", " ".join(words).title()))
    data += [("xx", f"s{s}", "rare") for s in range(4)]  # keeps no term
    data += [("en", "quiet", None), ("en", None, "123 !"), ("yy", "alone", "word")] + [("zz", "alone", "word Word")] * 12
    return data


PARAMS = [D.DivergenceParams(), D.DivergenceParams(heavy_share=0.5, block=2, terms=5, postings=7), D.DivergenceParams(heavy_share=1.0, postings=20), D.DivergenceParams(heavy_share=0.0, block=3)]


@pytest.mark.parametrize("params", PARAMS)
def test_against_brute_force(spark, params):
    """Many tiles, many groups of postings, all terms light and all terms heavy."""
    data = made(1)
    docs = spark.createDataFrame(data, "lang string, source string, text string")
    got = sorted(map(tuple, D.source_divergence(docs, params).collect()))
    assert got == brute(data)
    assert any(r[4] == 0 for r in got) and {r[2] for r in got} == {"pair", "term"}


def test_cases(spark):
    data = [(r[2], r[3], r[1]) for r in rows()]
    for least in (1, 2, 10):
        got = D.source_divergence(frame(spark), D.DivergenceParams(least_docs=least))
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == brute(data, least)
    assert D.source_divergence(spark.createDataFrame([], SCHEMA)).collect() == []


def test_counts_passed_on_early(spark, monkeypatch):
    monkeypatch.setattr(D, "HELD", 5)
    data = made(2)
    docs = spark.createDataFrame(data, "lang string, source string, text string")
    assert sorted(map(tuple, D.source_divergence(docs).collect())) == brute(data)


def test_large_counts_are_exact():
    """Squares of the largest shares fit in 64 bits."""
    p, q = np.array([10**9 + 1, 10**9 + 1, 1]), np.array([1, 10**9 + 1, 10**9 + 1])
    assert D.gap(p, q).tolist() == [(int(a) - int(b)) ** 2 // (int(a) + int(b)) for a, b in zip(p, q)]
