from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.functions import tokens as K
from weftline.functions import vectors as V
from weftline.functions.profiles import EWTS_PARTICLES, LATIN, TIBETAN
from weftline.functions.translit import to_ewts


def values(spark, rows, make, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_sanitize_and_clean(spark):
    assert values(spark, ["a\x00b\x0bc\td\n", None, ""], T.sanitize_text) == ["abc\td\n", None, ""]
    assert values(spark, ["ཀ a1/_  ཁ\x1f", "abc", " ཀ  "], T.clean_foreign) == ["ཀ ཁ", "", "ཀ"]
    assert values(spark, ['a<b>:"c|?*.txt', "dir.d/x", "n.tar.gz"], T.sanitize_filename) == ["a_b___c___", "dir.d_x", "n.tar"]


def test_tibetan_spaces(spark):
    rows = ["ཀ ཁ ག", "ཀཀ  ཁཁ ། x   y", "a ་ b"]
    assert values(spark, rows, T.remove_script_spaces) == ["ཀཁ ག", "ཀཀཁཁ། x y", "a་ b"]
    assert values(spark, ["a _ b / c"], T.normalize_spaces) == ["a_b/c"]


def test_words(spark):
    rows = ["ཀ་ཁ་ག།", "ཀ་ཁ་།", "ཀ", "", "ཀ་ཁ  "]
    assert values(spark, rows, T.last_word) == ["ག", "", "ཀ", "", "ཁ"]
    assert values(spark, rows, T.syllable_count) == [2, 2, 0, 0, 1]
    assert values(spark, ["a.b!!c", ""], lambda c: T.split_parts(c, LATIN)) == [["a", ".", "b", "!!", "c"], []]
    assert values(spark, ["།", "།།", "།།།།", "༎", "༔༔", "༔"], T.is_strong) == [False, False, True, True, True, False]
    assert values(spark, ["a/b  c", "", "/"], T.transliterated_tokens) == [["a", "b", "c"], [], []]
    assert values(spark, ["3_8", "x"], T.segment_position) == [7, 0]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_token_distance_and_overlap(spark):
    pairs = [([], []), (["a"], []), ("k x y".split(), "k z y".split()), ("a b a b".split(), "b a".split()), (list("abcdef") * 20, list("badcfe") * 21)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a array<string>, b array<string>")
    got = df.select(
        "i", K.token_levenshtein(F.col("a"), F.col("b")).alias("d"), K.jaccard(F.col("a"), F.col("b")).alias("j"),
        K.jaccard(K.bigrams(F.col("a")), K.bigrams(F.col("b"))).alias("g"),
    ).orderBy("i").collect()
    for r, (a, b) in zip(got, pairs, strict=True):
        union = set(a) | set(b)
        ga, gb = (set(zip(x, x[1:])) for x in (a, b))
        assert r.d == edit_distance(a, b)
        assert r.j == (len(set(a) & set(b)) / len(union) if union else 0)
        assert abs(r.g - (len(ga & gb) / len(ga | gb) if ga | gb else 0)) < 1e-12


def test_particles(spark):
    assert len(set(EWTS_PARTICLES.split())) == 227
    assert values(spark, [["sangs", "kyi", "rgyas", "la", "sangs"]], K.content_tokens, "array<string>") == [["sangs", "rgyas", "sangs"]]


def test_vectors(spark):
    assert values(spark, [[3.0, 4.0], [0.0, 0.0]], V.l2_normalize, "array<float>") == [[0.6, 0.8], [0.0, 0.0]]
    pooled = values(spark, [[[1.0, 2.0], [3.0, 6.0]]], lambda c: V.mean_pool(c, F.array(F.lit(1.0), F.lit(0.0))), "array<array<double>>")
    assert pooled == [[1.0, 2.0]]


def test_ewts():
    assert to_ewts("བོད་ཡིག") == "bod yig"
    assert to_ewts("སངས་རྒྱས།") == "sangs rgyas/"
    assert to_ewts("བཀྲ་ཤིས་བདེ་ལེགས།") == "bkra shis bde legs/"
    assert to_ewts("abc 12") == "abc 12"
    assert to_ewts("༡༢") == "12"
    assert to_ewts(None) is None and to_ewts("") == ""


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="ཀཁ།༎༔་ ab", max_size=40))
def test_parts_rebuild_the_text(text):
    marks = re.escape(TIBETAN.delimiters)
    assert "".join(re.findall(f"[{marks}]+|[^{marks}]+", text)) == text


def test_clean_foreign_for_any_white_space(spark):
    """Runs of letters that go and of white space of all kinds, against Python; single spaces aren't replaced."""
    texts = ["", " ", "\t", "a\tb", "a   b", "　a1 2b\n", "1 2 3", " x  y  z ", "ཀaཀཀ b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [" ".join(re.sub(r"[^a-zA-Z\s]", "", t).split()) for t in texts]
    cleaned = T.clean_foreign(F.col("t"), LATIN)
    assert [r[0] for r in df.select(cleaned).collect()] == want
    assert "{2,}" in df.select(cleaned)._jdf.queryExecution().optimizedPlan().toString()
