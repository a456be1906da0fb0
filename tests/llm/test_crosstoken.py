from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from tests.llm.cases import SCHEMA, frame, rows
from weftline.llm import crosstoken as C

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")

FILES = C.Tokenizers.read()


@pytest.fixture(scope="module")
def aligner():
    return C.Aligner(FILES)


def brute(aligner, data):
    """Rows by cutting at shared offsets, one tokenizer call a text, one loop over all links."""
    found = []
    for i, text in data:
        a = aligner.encode_a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = aligner.encode_b.encode(text or "")
        xs, ys = [aligner.a[t] for t in a], [aligner.b[t] for t in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(xs) != whole or b"".join(ys) != whole:
            found.append((i, [], [], "", []))
            continue
        ends = lambda parts: [sum(map(len, parts[: k + 1])) for k in range(len(parts))]
        ea, eb = ends(xs), ends(ys)
        cuts, i0, j0, groups, links = sorted(set(ea) & set(eb)), 0, 0, [], []
        for c in cuts:
            m, n = ea.index(c) + 1, eb.index(c) + 1
            groups.append(",".join(map(str, a[i0:m])) + "|" + ",".join(map(str, b[j0:n])))
            i0, j0 = m, n
        links = [(x, y) for x, p in zip(a, ea) for y, q in zip(b, eb) if p == q]
        found.append((i, a, b, ";".join(groups), links))
    count = Counter(x for r in found for x in r[4])
    most = {y: max(n for (_, z), n in count.items() if z == y) for _, y in count}
    return [
        (i, len(a), len(b), g.count("|") if a else 0, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
         hashlib.sha256(g.encode()).hexdigest() if a else "")
        for i, a, b, g, links in found
    ]


TEXTS = [
    (1, "The licence isn't  valid\n\n\tin 1,234 countries."), (2, "naïve café — 日本語 😀😀"), (3, "▁ is a mark, so is <0x41>"),
    (4, "<|endoftext|> and <s> are plain </s>"), (5, " leading and trailing "), (6, ""), (7, None), (8, "The licence isn't valid"),
    (9, "a"), (10, "\x00\x01\r\n"), (11, "    deep\n        code()\n"), (12, "|12;3,4|"),
]
order = lambda x: sorted(map(tuple, x), key=str)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("count_bytes", [C.COUNT_BYTES, 0])
def test_against_brute_force(spark, aligner, count_bytes):
    rng = random.Random(3)
    alphabet = "aabcdeenst   .,'\n é日12ÅnT"
    data = TEXTS + [(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))) for k in range(40)]
    data += [(100, data[-1][1])]  # an id twice
    got = C.alignment_rows(spark.createDataFrame(data, "doc_id long, text string"), FILES, count_bytes=count_bytes)
    assert got.columns == COLUMNS
    assert order(got.collect()) == order(brute(aligner, data))


def test_cases(spark, aligner):
    data = [r[:2] for r in rows() if r[0] not in (10, 12)]  # brute force is quadratic
    got = C.alignment_rows(frame(spark, [r for r in rows() if r[0] not in (10, 12)]), FILES)
    assert order(got.collect()) == order(brute(aligner, data))
    assert C.alignment_rows(frame(spark), FILES).count() == len(rows())
    assert C.alignment_rows(spark.createDataFrame([], SCHEMA), FILES).collect() == []


def test_groups_round_trip(aligner):
    """Groups written out hold all tokens in order, and both sides of each have equal bytes."""
    for found, (_, text) in zip(aligner.align([t for _, t in TEXTS]), TEXTS, strict=True):
        if found is None:
            assert not text or "▁" in text
            continue
        sides = [[[int(t) for t in side.split(",")] for side in g.split("|")] for g in found.text().split(";")]
        for a, b in sides:
            assert b"".join(aligner.a[t] for t in a) == b"".join(aligner.b[t] for t in b)
        assert b"".join(aligner.a[t] for a, _ in sides for t in a) == b" " + text.encode()


@pytest.mark.parametrize(("a", "b", "want"), [
    ([b"ab", b"c"], [b"a", b"bc"], "0,1|0,1"), ([b"ab", b"c"], [b"ab", b"c"], "0|0;1|1"),
    ([b"abcdef"], [b"a", b"bcd", b"ef"], "0|0,1,2"), ([b"a", b"bc", b"d"], [b"ab", b"cd"], "0,1,2|0,1"),
    ([b"ab"], [b"ax"], None), ([b"ab"], [b"a"], None), ([b"a"], [b"a", b"b"], None), ([b"a", b"b"], [b"a"], None), ([], [], ""),
])
def test_transducer(a, b, want):
    t = C.Transducer(a, b)
    for _ in range(2):  # with and without memory
        found = t.groups(list(range(len(a))), list(range(len(b))))
        assert (found and found.text()) == (want if found else None) and (found is None) == (want is None)


def test_transducer_forgets(monkeypatch, aligner):
    monkeypatch.setattr(C, "TRANSITIONS", 3)
    t = C.Transducer([b"ab", b"c"], [b"a", b"bc"])
    assert [t.groups([0, 1], [0, 1]).text() for _ in range(9)] == ["0,1|0,1"] * 9


def test_task_counts_in_parts(spark, aligner, monkeypatch):
    """Counts passed on before the end of a task add up."""
    data = TEXTS * 3
    docs = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    whole = C.pair_counts(C.align_tokens(docs, FILES)).collect()
    count = Counter()
    for found in aligner.align([t for _, t in data]):
        count.update(found.codes if found else [])
    assert {r["pair"]: r["count"] for r in whole} == count


def test_ranks_encode_like_merges(aligner):
    """Plain texts go through the ranked library, others as a whole; both equal the tokenizer's own ids."""
    assert aligner.ranked is not None
    rng = random.Random(9)
    pieces = ["the", " a", "'s", "'LL", "don't", "  ", "\n", "\t", "1999", ",", "...", "é", "ß", "Ünder", "=>", "<|endoftext|>", " ", "x" * 40, "_", "—", "日", "\x1c", "\u00a0", "½"]
    texts = [" " + "".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(400)]
    assert any(C._PLAIN.fullmatch(t) for t in texts) and not all(C._PLAIN.fullmatch(t) for t in texts)
    assert aligner.ids_a(texts) == [aligner.encode_a.encode(t, add_special_tokens=False).ids for t in texts]
    assert aligner.ids_a([]) == []
