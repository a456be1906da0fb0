from __future__ import annotations

import random
import re

from tests.llm.cases import SCHEMA, frame, rows
from weftline.llm import linededup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(data, least):
    """Deleted lines by document: every run of lines with enough words that occurs earlier.

    Documents come by id, null ids first; those that agree in id and text are one.
    """
    return within_and_across(data, least)


def test_cases(spark):
    out = linededup.drop_repeated_lines(frame(spark), 10)
    assert out.columns[: len(frame(spark).columns)] != [] and set(frame(spark).columns) <= set(out.columns)
    want = brute(rows(), 10)
    got = out.select("doc_id", "text", "n_lines", "n_deleted", "deleted_lines").collect()
    assert len(got) == len(rows())
    assert sum(r.text is None for r in got) == 2
    assert {r.doc_id for r in got if r.n_deleted} == {d for (d, _), g in want.items() if g}


def documents(seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdef") for _ in range(rng.choice([1, 3, 6, 12]))) for _ in range(12)]
    return [(i, "\n".join(rng.choice([*pool, "", " "]) for _ in range(rng.randrange(1, 14)))) for i in range(25)]


def test_random_runs(spark):
    """Runs inside and across documents, against all runs by brute force."""
    for seed in (1, 2):
        data = [(i, t, "en", "s", 1, "", "", "", "") for i, t in documents(seed)]
        want = {d: g for (d, _), g in within_and_across(data, 10).items()}
        got = linededup.drop_repeated_lines(frame(spark, data), 10).collect()
        for r in got:
            original = dict(documents(seed))[r.doc_id].split("\n")
            gone = [int(k) for k in r.deleted_lines.split(",") if k]
            assert [k for k in gone if original[k].strip()] == want[r.doc_id]
            assert all(want[r.doc_id][0] < k < want[r.doc_id][-1] for k in set(gone) - set(want[r.doc_id]))
            assert r.text == "\n".join(x for k, x in enumerate(original) if k not in gone) and r.n_deleted == len(gone)
            assert r.n_lines == len(original)


def within_and_across(data, least):
    """As ``brute``, with repeats inside a document: all runs by place, the first stays."""
    docs = sorted({(r[0], r[1]) for r in data if r[1] is not None}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    first, runs = {}, []
    for d, t in docs:
        ls = [(k, x, len(WORDS.findall(x))) for k, x in enumerate(t.split("\n")) if WORDS.search(x)]
        for i in range(len(ls)):
            for j in range(i, len(ls)):
                if sum(w for _, _, w in ls[i : j + 1]) >= least:
                    run = tuple(x for _, x, _ in ls[i : j + 1])
                    first.setdefault(run, (d, i))
                    runs.append(((d, t), run, i, [k for k, _, _ in ls[i : j + 1]]))
    gone = {d: set() for d in docs}
    for d, run, i, where in runs:
        if first[run] != (d[0], i):
            gone[d] |= set(where)
    return {d: sorted(g) for d, g in gone.items()}


def test_empty(spark):
    out = linededup.drop_repeated_lines(spark.createDataFrame([], SCHEMA), 10)
    assert out.count() == 0
