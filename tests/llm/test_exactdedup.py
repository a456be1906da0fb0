from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from tests.llm.cases import SCHEMA, frame, rows
from weftline.llm import exactdedup

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data, keep):
    groups = defaultdict(list)
    for r in data:
        groups[(r[1] or "").translate(FOLD)].append(r[0])
    best = {"min": min, "max": max}[keep]
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        winner = best(known) if known else None
        first = True
        for i in ids:
            out.append((i, winner, len(ids), i == winner and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and i != winner
    return out


order = lambda rows: sorted(rows, key=str)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_cases(spark, keep):
    got = [tuple(r) for r in exactdedup.exact_duplicates(frame(spark), keep=keep).collect()]
    assert order(got) == order(brute(rows(), keep))


def test_hot_group(spark):
    """A text that holds a third of all rows takes the pre-aggregated path."""
    data = [(i, "Hot text" if i % 3 == 0 else f"text {i}", "en", "s", 1, "", "", "", "") for i in range(3000)]
    got = [tuple(r) for r in exactdedup.exact_duplicates(frame(spark, data), keep="max").collect()]
    assert order(got) == order(brute(data, "max"))
    left = exactdedup.drop_exact_duplicates(frame(spark, data), keep="max")
    assert left.columns == frame(spark).columns and left.count() == 2001


def test_empty(spark):
    assert exactdedup.exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
