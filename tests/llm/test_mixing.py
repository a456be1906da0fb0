from __future__ import annotations

from collections import defaultdict

import pytest

from tests.llm.cases import SCHEMA, frame
from weftline.llm import mixing

TARGETS = mixing.MixTargets(source={"s0": 1.0, "s1": 1.0, "*": 2.0}, lang={"en": 3.0, "*": 1.0}, topic={}, keep=0.4, rounds=40)


def data():
    out = []
    for i in range(4000):
        source = "s0" if i % 3 == 0 else f"s{1 + i % 4}"  # a third of all rows has one source
        out.append((i, "w " * (1 + i % 7), "en" if i % 5 else None, source, 1, "", "", "", ""))
    return out


def rake(cells, t):
    w = dict(cells)
    for _ in range(t.rounds):
        for k, target in ((0, t.source), (1, t.lang)):
            held, total = defaultdict(float), sum(target.values())
            for c, x in w.items():
                held[c[k]] += x
            w = {c: x * target.get(c[k], 0) / total / held[c[k]] if held[c[k]] else 0 for c, x in w.items()}
    return w


def test_probabilities(spark):
    rows = mixing.mix_documents(frame(spark, data()), TARGETS).collect()
    assert len(rows) == 4000
    cells = defaultdict(float)
    for r in rows:
        cells[r.source, r.lang] += r.n_tokens
    w = rake(cells, TARGETS)
    got = {(r.source, r.lang): r.probability for r in rows}
    # One factor for all unsaturated cells, saturated ones at 1, the expected size as wanted.
    factors = [got[c] * cells[c] / w[c] for c in cells if got[c] < 1]
    assert max(factors) - min(factors) < 1e-6 * max(factors)
    assert all(max(factors) * w[c] / cells[c] >= 1 - 1e-9 for c in cells if got[c] == 1)
    assert abs(sum(got[c] * cells[c] for c in cells) - 0.4 * sum(cells.values())) < 1e-6 * sum(cells.values())
    kept = defaultdict(float)
    for r in rows:
        kept[r.source] += r.n_tokens * r.kept
    share = {k: v / sum(kept.values()) for k, v in kept.items()}
    if all(p < 1 for p in got.values()):
        assert abs(share["s0"] - 0.25) < 0.05 and abs(share["*"] - 0.5) < 0.05


def test_sample_equals_decisions(spark):
    docs = frame(spark, data())
    kept = {r.doc_id for r in mixing.mix_documents(docs, TARGETS).where("kept").collect()}
    sample = mixing.sample_mix(docs, TARGETS)
    assert {r.doc_id for r in sample.collect()} == kept and sample.columns == [*docs.columns, "mix_probability"]


@pytest.mark.parametrize("targets", [TARGETS, mixing.MixTargets(), mixing.MixTargets(source={"absent": 1.0})])
def test_edges(spark, targets):
    assert mixing.mix_documents(spark.createDataFrame([], SCHEMA), targets).count() == 0
    assert mixing.sample_mix(spark.createDataFrame([], SCHEMA), targets).count() == 0
    rows = mixing.mix_documents(frame(spark), targets).collect()
    assert len(rows) == len(__import__("tests.llm.cases", fromlist=["rows"]).rows())
    assert all(0 <= r.probability <= 1 for r in rows)


def test_topics_and_bounds(spark):
    words = {"a": "stone river", "b": "river tree"}
    texts = ["STONE, stone! tree", "river", "the tree-house", "", None, "x" * 50_000, "stones rivers", "tree river stone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r.topic for r in mixing.keyword_topic(docs, docs["text"], "topic", words).orderBy("doc_id").collect()]
    assert got == ["a", "a", "b", "general", "general", "general", "general", "a"]
    with pytest.raises(ValueError, match="cells"):
        mixing.MixTargets(source={str(i): 1.0 for i in range(60)}, lang={str(i): 1.0 for i in range(60)})
