"""Rows that every operator has to take: nulls, empties, long texts, ties, repeats, odd columns."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class string, key string, kept string, `__lost` string"
PROSE = "The river kept its course through the old town while nobody on the bridge said a word about the flood that came last spring"


def rows():
    texts = [
        (1, PROSE), (2, PROSE.upper()), (3, PROSE), (3, PROSE), (4, None), (5, ""), (6, "  \n\t "), (7, "word"), (8, "Word"), (9, "a\nb\n\nc"),
        (10, "x " * 60_000), (None, PROSE), (None, None), (11, PROSE.replace("bridge", "pier")), (12, "é" * 5000 + " ¼ \U0001f600"), (13, "\x00\x1c null"),
    ]
    return [(i, t, "en" if (i or 0) % 2 else None, f"s{(i or 0) % 3}", len(t) if t else None, "c", "k", "y", "l") for i, t in texts]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
