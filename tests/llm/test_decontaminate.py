from __future__ import annotations

import random
import re

import pytest

from tests.llm.cases import PROSE, SCHEMA, frame, rows
from weftline.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window):
    ws, hit, found = split(text), set(), set()
    for item, body in items:
        iw = split(body)
        m = min(window, len(iw))
        for i in range(len(iw) - m + 1 if m else 0):
            for at in range(len(ws) - m + 1):
                if ws[at : at + m] == iw[i : i + m]:
                    hit |= set(range(at, at + m))
                    found.add(item)
    return len(ws), len(hit), sorted(found)


def test_random(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(str(i), text(n)) for i, n in enumerate([0, 1, 2, 3, 5, 9, 12, 4])]
    tables = D.searchers(items, 4)
    for _ in range(300):
        t = text(rng.randrange(0, 25))
        n, spans, found = D.scan(t, tables)
        assert (n, sum(e - s for s, e in spans), sorted(found)) == brute(t, items, 4)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_cases(spark, block):
    items = [(7, "Came last spring, the FLOOD."), (8, PROSE), (8, PROSE), (9, None), (10, ""), (None, PROSE), (11, "word"), (12, "x x x x x x x x x x x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(frame(spark), bench, block_bytes=block).collect()
    known = [(str(i), t) for i, t in items if i is not None]
    want = sorted(((r[0], *brute(r[1], known, 10)) for r in rows()), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in got), key=str) == want
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in got)
    clean = D.drop_contaminated(frame(spark), bench)
    assert clean.columns == frame(spark).columns
    assert {r.doc_id for r in clean.collect()} == {4, 5, 6, 9, 12, 13, 11} - {r[0] for r in want if r[2]}


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(spark.createDataFrame([], SCHEMA), none).count() == 0
    assert D.contamination(frame(spark), none).where("contaminated").count() == 0
