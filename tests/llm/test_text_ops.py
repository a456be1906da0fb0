"""PII, quality, licenses, HTML and secrets: units, cases and brute force."""

from __future__ import annotations

import math
import random
import re
import textwrap
import time
import zlib
from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest

from tests.llm.cases import SCHEMA, frame, rows
from weftline.llm import html_text, licenses, pii, quality, secrets

KEY = b"k"


# --- PII ---------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 7, 100, 365, 1000])
def test_feistel_is_a_permutation(size):
    images = [pii.feistel(x, size, KEY, b"t") for x in range(size)]
    assert sorted(images) == list(range(size))
    assert [pii.unfeistel(y, size, KEY, b"t") for y in images] == list(range(size))


def test_large_domains_and_keys():
    n = 26**40
    y = pii.feistel(12345, n, KEY, b"t")
    assert 0 <= y < n and pii.unfeistel(y, n, KEY, b"t") == 12345 and pii.feistel(12345, n, b"other", b"t") != y


def test_formats_stay_valid():
    text = (
        "mail jane.doe42@Mail7.example.com or JANE.DOE42@mail7.example.com, call +1 (017) 555-7713, card 4111 1111 1111 1111 / "
        "4111111111111111, not 4111111111111112, host 152.143.123.131 but 300.1.1.1, ssn 123-45-6789 not 000-12-3456, "
        "born 1999-02-28 or 28/02/1999, not 2023-02-30, iban DE89 3704 0044 0532 0130 00"
    )
    new, found = pii.pseudonymise(text, KEY)
    assert Counter(k for k, *_ in found) == {"email": 2, "phone": 1, "card": 2, "ipv4": 1, "ssn": 1, "date": 2, "iban": 1}
    assert all(text[s:e] not in new for _, s, e, _ in found)
    assert "4111111111111112" in new and "300.1.1.1" in new and "2023-02-30" in new and "000-12-3456" in new
    by = {k: [n for kind, _, _, n in found if kind == k] for k in pii.KINDS}
    assert by["email"][0].lower() == by["email"][1].lower() and by["email"][0].endswith(".com")
    assert by["card"][0].replace(" ", "") == by["card"][1] and pii.luhn_digit(by["card"][1][:-1]) == by["card"][1][-1]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", by["phone"][0])
    y, m, d = by["date"][0].split("-")
    assert by["date"][1] == f"{d}/{m}/{y}"
    again, found2 = pii.pseudonymise(new, KEY)
    assert [k for k, *_ in found2] == [k for k, *_ in found]  # pseudonyms validate like originals


def test_overshooting_and_national_forms():
    ibans = ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "PL61 1090 1014 0000 0712 1981 2874", "FR14 2004 1010 0505 0001 3M02 606"]
    for v in [*ibans, *(x.replace(" ", "") for x in ibans)]:
        for text in (f"{v} BIC CAIXESBB", f"{v} IBAN", f"AB13 {v}, 12"):
            new, found = pii.pseudonymise(text, KEY)
            assert [(k, text[s:e]) for k, s, e, _ in found] == [("iban", v)], text
            assert [x[0] for x in pii.find_pii(new, KEY)] == ["iban"]
    for v in (
        "01 23 45 67 89", "01.23.45.67.89", "+33 1 23 45 67 89", "+33 (0)1 23 45 67 89", "+49 30 1234567", "030 1234567", "(030) 1234567", "089/1234567",
        "+34 912 34 56 78", "912 34 56 78", "91 234 56 78", "912 345 678", "+49 171 123 45 67", "+1 (017) 555-7713",
    ):
        for text in (f"tel {v}.", f"{v}, or", f"call {v} now"):
            new, found = pii.pseudonymise(text, KEY)
            assert [(k, text[s:e]) for k, s, e, _ in found] == [("phone", v)], text
            assert [x[:3] for x in pii.find_pii(new, KEY)] == [x[:3] for x in found], new
    spellings = ["+33123456789", "+33 1 23 45 67 89", "+33 (0)1 23 45 67 89", "0033 1 23 45 67 89", "0033123456789", "+33-1-23-45-67-89"]
    national = set()
    for v in spellings:
        (found,) = pii.find_pii(f"call {v} now", KEY)
        digits = re.sub(r"\D", "", found[3]).removeprefix("00")
        assert found[:3] == ("phone", 5, 5 + len(v)) and digits.startswith("33")
        national.add(digits[2:].removeprefix("0") if "(0)" in v else digits[2:])
    assert len(national) == 1  # equal values stay linked, in each format
    assert [x[0] for x in pii.find_pii("ring 0123456789.", KEY)] == ["phone"]
    assert [x[:3] for x in pii.find_pii("+33 1 23 45 67 89 12 apples", KEY)] == [("phone", 0, 17)]
    assert pii.find_pii("10 20 30 40 50 and 000-12-3456, 1 234 567", KEY) == []
    assert [x[0] for x in pii.find_pii("01-02-2023 05.06.2020 01/02/2023", KEY)] == ["date"] * 3
    images = {pii.pseudonymise(f"01 23 45 67 {i:02d}", KEY)[0] for i in range(100)}
    assert len(images) == 100


def test_pii_cases(spark):
    data = [*rows(), (50, "ip 10.0.0.1 and 10.0.0.1", None, "s", 1, "", "", "", ""), (51, "10.0.0.1", None, "s", 1, "", "", "", "")]
    got = pii.pseudonymise_documents(frame(spark, data), "k").collect()
    want = sorted(((r[0], pii.pseudonymise(r[1], KEY)[0]) for r in data), key=str)
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == want
    linked = {r.text for r in got if r.doc_id == 51} | {x for r in got if r.doc_id == 50 for x in re.findall(r"[\d.]{7,}", r.text)}
    assert len(linked) == 1
    assert pii.pseudonymise_documents(spark.createDataFrame([], SCHEMA), "k").count() == 0


def luhn_ok(digits):
    total = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def test_pii_against_planted_values():
    """Values made here, with checks of their own, are found where they were put, and nothing else is."""
    rng = random.Random(3)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        while not luhn_ok(n := "4" + digits(15)):
            pass
        return n

    def iban():
        body = digits(18)
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    makers = {
        "email": lambda: f"{rng.choice(['ana', 'bo.li', 'C_d'])}{digits(2)}@mail{digits(2)}.example.org", "card": card, "iban": iban,
        "ssn": lambda: f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}",
        "ipv4": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        "phone": lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", "date": lambda: f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
    }
    images = {k: {} for k in makers}
    for _ in range(150):
        parts, want, at = [], [], 0
        for _ in range(rng.randint(0, 5)):
            kind = rng.choice(list(makers))
            for piece, k in ((rng.choice(["said so: ", "word ", "12 apples, "]), None), (makers[kind](), kind), (rng.choice([". ", ", ", " and "]), None)):
                if k:
                    want.append((k, at, at + len(piece), piece))
                parts.append(piece)
                at += len(piece)
        text = "".join(parts)
        new, found = pii.pseudonymise(text, KEY)
        assert [x[:3] for x in found] == [x[:3] for x in want], text
        shift = 0
        for (kind, s, e, value), (*_, image) in zip(want, found, strict=True):
            assert new[s + shift : e + shift] != value or kind == "ipv4"
            shift += len(image) - len(value)
            assert images[kind].setdefault(value, image) == image
            if kind == "card":
                assert luhn_ok(image)
            if kind == "iban":
                assert int(image[4:] + "1314" + image[2:4]) % 97 == 1
    for by in images.values():
        assert len(set(by.values())) == len(by)


def test_pii_dates_keep_their_format_apart():
    day, images = date(1900, 1, 1), {}
    while day.year < 2100:
        d, m, y = day.day, day.month, day.year
        for v in {f"{d:02d}/{m:02d}/{y}", f"{m:02d}/{d:02d}/{y}", f"{d}/{m}/{y}", f"{d}.{m:02d}.{y}", f"{y}-{m:02d}-{d:02d}", f"{y}-{m}-{d}"}:
            image = pii._date(v, KEY)
            assert re.sub(r"\d", "9", image) == re.sub(r"\d", "9", v) and images.setdefault(image, v) == v
        day += timedelta(7)


def test_pii_odd_and_long_names():
    assert [x[:3] for x in pii.find_pii("İstanbul@example.com", KEY)] == [("email", 0, 20)]
    names = ["a" * 40, "a" * 39 + "b", "b" + "a" * 39, "A" * 40, "a" * 41]
    images = [pii.permute_word(n, KEY, b"t") for n in names]
    assert len({x.lower() for x in images}) == 4 and images[3].lower() == images[0] and [len(x) for x in images] == [len(x) for x in names]
    assert sum(x != y for x, y in zip(images[0], images[1], strict=True)) > 20  # the last letter changes all blocks
    began = time.perf_counter()
    assert len(pii.find_pii("x" * 100_000 + "@example.com", KEY)) == 1
    assert len(pii.find_pii(" ".join(f"10.{i // 250}.{i % 250}.7" for i in range(5000)), KEY)) == 5000
    assert time.perf_counter() - began < 20


# --- Quality -----------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark, sf_dir):
    from weftline.llm.queries import op3_quality
    from weftline.plans.runtime import read_table

    sf = sf_dir.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in op3_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in read_table(spark, sf, "labels").collect()}
    assert len(got) == read_table(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    held = [d for d in labels if got[d].held_out]
    assert np.mean([got[d].predicted == labels[d] for d in held]) >= 0.95


def test_quality_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0), (7, 1, 0), (7, 0, 0), (99, 0, 1)], none.schema)):
        model = quality.fit_quality(frame(spark), labels)
        got = quality.score_quality(frame(spark), model).collect()
        assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
        by = {}
        for r, (_, text, *_) in zip(sorted(got, key=lambda r: str(r.doc_id)), sorted(rows(), key=lambda r: str(r[0])), strict=True):
            if r.doc_id is not None:
                assert by.setdefault(text, r.score) == r.score  # nothing but the text counts
        assert quality.keep_quality(frame(spark), model).columns == frame(spark).columns
        assert quality.score_quality(spark.createDataFrame([], SCHEMA), model).count() == 0
    model = quality.fit_quality(spark.createDataFrame([], SCHEMA), none)
    assert model.temperature == 1.0


def test_quality_ignores_held_out_labels(spark):
    """Labels of fold 0 don't change the model."""
    docs = [(i, ("good text number " if i % 2 else "BAD!! $$$ ") * 5 + str(i), "en", "s", 1, "", "", "", "") for i in range(120)]
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    flip = [(i, (i % 2) if fold(i) else 1 - i % 2, 0) for i in range(120)]
    true = [(i, i % 2, 0) for i in range(120)]
    schema = "doc_id long, quality int, toxic int"
    scores = []
    for labels in (flip, true):
        model = quality.fit_quality(frame(spark, docs), spark.createDataFrame(labels, schema))
        scores.append({r.doc_id: r.score for r in quality.score_quality(frame(spark, docs), model).collect()})
    assert scores[0] == scores[1]
    assert np.mean([(scores[0][i] >= 0.3) == (i % 2) for i in range(120)]) > 0.95


# --- Licenses ----------------------------------------------------------------------------


def test_licenses(spark):
    texts = {
        "Licensed under the Apache License, Version 2.0.": ["Apache-2.0"], "Released under the MIT License.": ["MIT"],
        "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0"],
        "This work is licensed under the GNU General Public License, version 2.": ["GPL-2.0"],
        "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"], "Licensed under CC BY 4.0.": ["CC-BY-4.0"], "All rights reserved.": ["all-rights-reserved"],
        "SPDX-License-Identifier: BSD-2-Clause": ["BSD-2-Clause"], "a driving license is needed": [], "All rights are reserved by nobody": [], "": [],
        "some prose\nreleased under the MIT license\nmore prose\n\nAll rights reserved.": ["MIT", "all-rights-reserved"],
    }
    data = [*rows(), *((100 + i, t, None, "s", 1, "", "", "", "") for i, t in enumerate(texts))]
    got = {r.doc_id: [x.license for x in r.found] for r in licenses.scan_licenses(frame(spark, data)).collect()}
    assert [got[100 + i] for i in range(len(texts))] == list(texts.values())
    assert not any(got[i] for i in got if i is None or i < 100)
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_wording_finds_its_license():
    t = licenses.Templates()
    for name, wordings in licenses.WORDINGS.items():
        for w in wordings:
            text = w.replace("{", "").replace("}", "")
            assert name in [x[0] for x in licenses.find_licenses(f"Prose before it.\n{text}.\n\nProse after it.", t)], (name, text)


@pytest.mark.parametrize("n", [20, 1_000, 3_000, 20_000])
def test_notice_inside_a_long_line(n):
    t = licenses.Templates()
    rng = np.random.default_rng(n)
    words = ["".join(map(chr, rng.integers(97, 123, k))) for k in rng.integers(2, 9, n // 2)]
    found = licenses.find_licenses(" ".join([*words, "Released under the MIT License.", *words]), t)
    assert [x[0] for x in found] == ["MIT"] and found[0][3] > 0 and found[0][4] == 0
    text = " ".join([*words, licenses.WORDINGS["ISC"][0].replace("{", "").replace("}", ""), *words, "for the purpose or without", *words])
    assert [x[0] for x in licenses.find_licenses(text, t)] == ["ISC"]


@pytest.mark.parametrize("lead", ["", " * ", "# "])
def test_wrapped_wordings(lead):
    t = licenses.Templates()
    for name, wordings in licenses.WORDINGS.items():
        for w in wordings:
            text = textwrap.fill(w.replace("{", "").replace("}", "") + ".", 72, initial_indent=lead, subsequent_indent=lead)
            for before in ("Prose before it.\n\n", "Copyright 2020 Somebody, who wrote this\nand all the rest of it.\n", "x " * 5_000 + "\n"):
                found = licenses.find_licenses(f"{before}{text}\n\nProse after it.", t)
                assert name in [x[0] for x in found], (name, text)
    assert [x[0] for x in licenses.find_licenses("(c) 2020 All rights\nreserved.", t)] == ["all-rights-reserved"]
    assert licenses.find_licenses("All rights\n\nreserved.", t) == []


BSD_3 = """Copyright (c) 2020, Jane

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

Other prose that has nothing to do with it at all.
"""


def test_licenses_as_published():
    t = licenses.Templates()
    (found,) = licenses.find_licenses(BSD_3, t)
    assert found[0] == "BSD-3-Clause" and BSD_3[found[1] : found[2]].endswith("prior written permission.")
    for name, text in licenses.FULL_TEXTS.items():
        for before, after in (("", ""), ("Prose.\n\n", "\n\nProse after it.")):
            wrapped = textwrap.fill(text, 76)
            assert [x[0] for x in licenses.find_licenses(before + wrapped + after, t)] == [name]
    assert licenses.find_licenses("It is not licensed under the MIT License", t) == []
    both = licenses.FULL_TEXTS["Zlib"] + "\n\nReleased under the MIT License"
    assert [x[0] for x in licenses.find_licenses(both, t)] == ["Zlib", "MIT"]


def test_licenses_against_a_plain_finder():
    """Notices at random places of random prose, with a word changed now and then, against a search for their words."""
    rng, t = random.Random(4), licenses.Templates()
    prose = ["stone", "river", "the", "of", "under", "software", "public", "license", "permission", "version", "copy"]
    notices = {n: w[0].replace("{", "").replace("}", "") for n, w in licenses.WORDINGS.items()}
    for _ in range(120):
        want, paragraphs = [], []
        for _ in range(rng.randint(1, 4)):
            words = rng.choices(prose, k=rng.randint(0, 40))
            if rng.random() < 0.5:
                name = rng.choice(list(notices))
                words[rng.randint(0, len(words)) : 0] = [*notices[name].split(), "."]
                want.append(name)
            paragraphs.append(" ".join(words))
        got = [x[0] for x in licenses.find_licenses("\n\nx\n\n".join(paragraphs), t)]
        assert Counter(want) - Counter(got) == Counter(), (want, got)
        for extra in set(got) - set(want):
            marks = [set(re.findall(r"\{([^}]*)\}", w.lower())) for w in licenses.WORDINGS[extra]]
            assert any(m <= set(re.findall(r"[\w.-]+", " ".join(paragraphs).lower())) for m in marks)


# --- HTML --------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>menu</ul></nav>
<div class="ad">buy</div><article><h1>Ti&amp;tle</h1><p><b>One <i>two</i><br><p>Three&nbsp;four
five</p><script>var a="</p>";</script><form>send</form><div class="comments"><p>first!</p></div><p>Last one here.</p></article>
<aside>side</aside><footer>&copy; x</footer></body></html>"""


def test_html_extraction():
    assert html_text.extract(PAGE, "/body/article") == "Ti&tle\nOne two\nThree four five\nLast one here."
    assert html_text.extract(PAGE, "/absent") == html_text.extract(PAGE, None) == html_text.extract(PAGE, "/body/article")
    assert html_text.extract(None, "/body") == html_text.extract("", None) == ""
    assert html_text.extract("just text", None) == "just text"
    assert html_text.extract(PAGE[: PAGE.index("Last")], "/body/article").endswith("Three four five")


def test_html_depth_and_open_quotes():
    """Time and memory stay in proportion to the page."""
    began = time.perf_counter()
    assert html_text.extract("<div>" * 80_000 + "deep" + "</div>" * 80_000, None) == "deep"
    assert html_text.extract("<div>t" * 20_000, None).count("t") == 20_000
    assert html_text.extract("<p>kept</p>" + "<a b='" * 40_000, None) == "kept"
    assert html_text.extract("<ul>" * 20_000 + "<li>x", None) == "x"
    assert time.perf_counter() - began < 30
    assert html_text.extract('<p>a <a title="x>y">b</a> c</p><p title="open>d</p><p>e</p>', None) == "a b c\nd\ne"


def test_html_article_parts():
    page = "<body><header><h1>Site</h1></header><article><header><h1>Headline</h1></header><p>E = <math><mi>m</mi></math> end</p>{}</article></body>"
    assert html_text.extract(page.format("<section class='search-results'><p>Rows.</p></section>"), None) == "Headline\nE = m end\nRows."
    assert html_text.extract(page.format("<div class='search-form'><p>Rows.</p></div>"), None) == "Headline\nE = m end"
    assert html_text.extract("<div class=c><div class=text><p>" + "First part. " * 9 + "</p></div><p>Short</p></div>", None).endswith("\nShort")


def test_html_ties_and_missing_urls(spark):
    """Equal votes go to the larger score, then to the smaller path; a null url is a host of its own."""
    page = lambda c, n: f"<body><div class={c}><p>{'word ' * n}</p></div><div class=z><p>{'tail ' * 3}</p></div></body>"
    data = [(1, "http://h.org/1", page("b", 30)), (2, "http://h.org/2", page("a", 30)), (3, None, page("c", 30)), (4, "nohost", page("c", 30)), (5, "http://h.org/3", None)]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r.page_id: r for r in html_text.main_text(df).collect()}
    assert got[1].path == got[2].path == got[5].path == "/body/div.a" and got[3].path == got[4].path == "/body/div.c"
    assert got[5].text == "" and got[1].text.startswith("word") and got[3].url is None


def test_html_layouts():
    long = "Some running text of the story. " * 12
    want = "\n".join(["Title", "Intro here.", long.strip(), "Tail here."])
    inner = f"<h1>Title</h1><p>Intro here.</p>{{}}<p>{long}</p>{{}}<p>Tail here.</p>"
    nav = "<nav><a href=x>menu</a></nav><div class=footer>foot</div>"
    links = "<div class=list>" + "<a href=x>another story of the site</a> " * 9 + "</div>"
    for page in (
        *(f'<body><div class="{c}"><article>{inner.format("", "")}</article></div>{nav}</body>' for c in ("layout with-sidebar", "has-comments", "page-header")),
        f'<body><div class="with-sidebar"><div>{inner.format("", "")}</div></div>{nav}</body>',
        f'<body><div class="with-sidebar"><article>{inner.format("", "")}</article><div class="comments"><article>first!</article></div></div>{nav}</body>',
        f'<body>{nav}<div class="content">{inner.format("<section>", "</section>")}</div>{links}</body>',
        f'<body>{nav}<div class="w-1/2">{inner.format("<section class=a>", "</section><section class=b>").replace("Tail here.</p>", "Tail here.</p></section>")}</div></body>',
        f'<body>{nav}<article>{inner.format("<div><div>", "</div></div>")}</article></body>',
        f'<body>{nav}{inner.format("<section>", "</section>")}</body>',
        f'<body>{nav}<article>{inner.format("", "")}</article><div class="cookie-consent">{long * 3}</div></body>',
    ):
        for path in (None, html_text.best_path(page)):
            assert html_text.extract(page, path) == want, page


def test_host_consensus(spark):
    wrap = lambda c, n: f'<body><div class="{c}"><p>{"long text " * n}</p></div><div class="blurb"><p>{"x " * 30}</p></div></body>'
    pages = [(i, f"http://H.example/{i}", wrap(f"post-{i}", 20)) for i in range(5)]
    pages += [(9, "https://u@h.example:80/z", wrap("post-9", 1)), (10, "h2", None), (11, None, ""), (12, "http://one.example", wrap("p", 20)), (12, "http://one.example", wrap("p", 20))]
    df = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, host int")
    got = {r.page_id: r for r in html_text.main_text(df).collect()}
    # Page 9 alone would choose the blurb; its host's other pages decide.
    assert got[9].text == "long text" and got[9].path == "/body/div.post-#"
    assert got[10].text == "" and got[11].text == "" and html_text.main_text(df).count() == len(pages)
    assert html_text.main_text(df.limit(0)).count() == 0


def test_pages_match_a_plain_reading(spark, sf_dir):
    import html

    from weftline.llm.queries import op9_html
    from weftline.plans.runtime import read_table

    pages = {r.page_id: r.html for r in read_table(spark, sf_dir, "pages").collect()}
    for r in op9_html(spark, sf_dir).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


# --- Secrets -----------------------------------------------------------------------------


def test_base_patterns():
    find = lambda t: [(k, t[s:e]) for k, s, e in secrets.find_secrets(t) if k != "guess"]
    assert find('x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y') == [
        ("assign", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962'), ("hex", "04dbebab91ab85687d33eeaaf9ac699e1188f962"),
    ]
    assert find("PassWord:abcde") == [] and find("PassWord:abcdef") == [("assign", "PassWord:abcdef")]
    assert find("token:token :abcdefgh") == []  # the short match still consumes its text
    assert find("AKIA" + "A" * 15) == [] and find("zAKIA" + "A" * 16) == [("access", "AKIA" + "A" * 16)]
    assert find("0" * 23) == [] and find("g" + "0" * 24 + "g") == [("hex", "0" * 24)]
    assert find("toKen:abcdefg ſecret:abcdefg") == [("assign", "toKen:abcdefg")]  # letters in ASCII case only
    assert secrets.find_secrets(None) == secrets.find_secrets("") == []


def test_guess_costs():
    cost = secrets.guess_cost
    assert cost("password") < 2 and cost("qwertyuiop") < 5 and cost("aaaaaaaaaaaa") < 5 and cost("abcabcabcabc") < 6
    assert cost("19991231") < 6 and cost("p@ssword") < 3 and cost("") == 0
    assert cost("x9$Kq!7vLw2#") > 12 and cost("zq" * 2 + "x8Kp!mW3") > cost("zqzq")
    assert cost("ab" * 50_000) < 20  # linear in the length


def test_guess_spans():
    find = lambda t: [(k, t[s:e]) for k, s, e in secrets.find_secrets(t)]
    assert find("the pwd is x9$Kq!7vLw2# ok") == [("guess", "x9$Kq!7vLw2#")]
    assert find("the password is password1 ok") == [] and find("his token is required here") == []
    assert secrets.redact_secrets("pwd: x9$Kq!7vLw2#!") == "pwd: [secret]!"


def test_several_credentials_without_white_space():
    find = lambda t: [t[s:e] for k, s, e in secrets.find_secrets(t) if k == "guess"]
    a, b, c = "Tr0ub4dor&3xQ", "k9#Lm2$Qz!v7", "x9$Kq!7vLw2#"
    assert find(f'{{"pwd":"{a}","private_key":"{b}","n":1,"passphrase":"{c}"}}') == [a, b, c]
    assert find(f"{{'access_key':'{a}','x':{{'password':'{b}'}},'credentials':{{'token':'{c}'}}}}") == [a, b, c]
    assert find(f"u=me&pwd={a}&private_key={b}&passphrase={c}") == [a, b, c]
    assert find(f"https://h.example/?pwd={a}&amp;access_key={b}&amp;n=1") == [a, b]
    assert find(f"pwd={a};private_key={b};n=1") == find(f"pwd:{a},private_key:{b},n:1") == [a, b]
    assert find(f'{{"pwd":"abc","secret":"{b}","bearer":"x9$Kq\\"7vLw2#"}}') == [b, 'x9$Kq\\"7vLw2#']
    assert find(f'{{"pwd":"password1","private_key":"{b}"}}') == [b]
    assert find("&".join([f"pwd={b}"] * 2_000)) == [b] * 2_000


def exhaustive_cost(value, ranks):
    """The cheapest of all segmentations, each segment priced from its definition."""
    leet = str.maketrans("@4301$5!7", "aaeoissit")
    rows_ = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
    at = {c: (r, i) for r, row in enumerate(rows_) for i, c in enumerate(row)}
    unshift = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))
    key = lambda c: at.get(unshift.get(c, c.lower()))
    near = lambda a, b: key(a) and key(b) and abs(key(a)[0] - key(b)[0]) + abs(key(a)[1] - key(b)[1]) == 1
    step = lambda a, b: (a + b).isascii() and a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1
    size_of = lambda c: 10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100

    def segment(i, j):
        part, out = value[i:j], []
        if j - i == 1:
            out.append(size_of(part) * (1.5 if part.isupper() else 1))
        for form in (part.lower(), part.lower().translate(leet)):
            if form in ranks and j - i >= 2:
                out.append(2 * ranks[form] * (1 if part in ranks else 2))
                break
        if (m := secrets.DATE.match(value, i)) and m.end() == j:
            out.append(2 * 36500)
        for follows, guesses in ((str.__eq__, 95), (near, 94), (step, 62)):
            if j - i >= 3 and all(follows(value[k], value[k + 1]) for k in range(i, j - 1)):
                if j - i == 3 or j == len(value) or not follows(value[j - 1], value[j]):
                    out.append(2 * guesses * (j - i))
        for block in range(2, 9):
            if (j - i) % block == 0 and j - i >= 2 * block and part == part[:block] * ((j - i) // block) and not value[j:].startswith(part[:block]):
                out.append(2 * math.prod(map(size_of, part[:block])) * (j - i) / block)
        return min(out, default=math.inf)

    def best(i):
        return 1 if i == len(value) else min(segment(i, j) * best(j) for j in range(i + 1, len(value) + 1))

    return math.log10(best(0))


def test_guess_cost_is_the_cheapest_segmentation():
    rng = random.Random(6)
    ranks = {"pass": 3, "word": 9, "password": 1, "ord": 40, "horse": 200, "se": 12}
    parts = ["pass", "word", "P4ss", "horse", "a", "Z", "7", "#", "é", "aaa", "qwe", "abc", "xyxy", "1999", "121212", "se", "$e"]
    for _ in range(150):
        value = "".join(rng.choices(parts, k=rng.randint(1, 4)))[:11]
        assert secrets.guess_cost(value, ranks) == pytest.approx(exhaustive_cost(value, ranks)), value


def test_secrets_against_planted_values():
    """Values put into prose in every way that names a credential, against their places."""
    rng, ranks = random.Random(8), secrets.RANK | {"correct": 300, "horse": 301}
    alphabet = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"
    for _ in range(200):
        out, want, at = [], [], 0
        for _ in range(rng.randint(1, 4)):
            value = "".join(rng.choices(alphabet, k=rng.randint(14, 30)))
            name = rng.choice(["pwd", "passphrase", "private_key", "access-key", "credentials", "bearer"])
            before = rng.choice(["see ", "the\n", "a, "]) + name + rng.choice([": ", "=", " => "])
            kind = rng.choice(["guess", "none", "assign"])
            if kind == "none":
                value = rng.choice(["correcthorse", "password1", "aaaaaaaaaa", "qwertyuiop"])
            if kind == "assign":
                before = "x api_key="
                want.append(("assign", at + 2, at + len(before) + len(value)))
            if kind == "guess":
                want.append(("guess", at + len(before), at + len(before) + len(value)))
            out += [before, value, "\n"]
            at += len(before) + len(value) + 1
        assert secrets.find_secrets("".join(out), ranks=ranks) == want, "".join(out)


def test_secret_cases(spark):
    data = [*rows(), (60, "api-key: Zk8#pQ2!mT5x secret=abcdef", None, "s", 1, "", "", "", "")]
    got = secrets.scan_secrets(frame(spark, data)).collect()
    assert sorted(((r.doc_id, [tuple(x) for x in r.found]) for r in got), key=str) == sorted(((r[0], secrets.priced_secrets(r[1])) for r in data), key=str)
    ranks = secrets.word_ranks(frame(spark, data))
    counts = Counter(w for r in data for w in re.findall(r"[^\W\d_]+", (r[1] or "").lower()) if 3 <= len(w) <= 20 and w not in secrets.RANK)
    assert list(ranks)[len(secrets.RANK) :] == sorted(counts, key=lambda w: (-counts[w], w))
    assert sorted(((r.doc_id, [tuple(x)[:3] for x in r.found]) for r in secrets.scan_secrets(frame(spark, data), ranks=ranks).collect()), key=str) == sorted(((r[0], secrets.find_secrets(r[1], ranks=ranks)) for r in data), key=str)
    assert secrets.scan_secrets(spark.createDataFrame([], SCHEMA)).count() == 0


def test_secrets_do_not_depend_on_other_documents(spark):
    """Alphabetic secrets are found however few or many documents there are, and however often one leaks."""
    planted = [(1, "pwd: qzxkvjwhptmb"), (2, "passphrase = xkcdvbnwqpzjhg"), (3, "pwd: correct-horse"), (4, "secret=Zx9!kq#7"), (5, "no value here")]
    tables = [planted, planted * 40, [*planted, *[(100 + i, f"filler text {i} qzxkvjwhptmb") for i in range(3000)]]]
    schema = "doc_id long, text string"
    found = [{(r.doc_id, tuple(map(tuple, r.found))) for r in secrets.scan_secrets(spark.createDataFrame(t, schema)).where("doc_id < 100").collect()} for t in tables]
    assert found[0] == found[1] == found[2]
    assert {i: [x[0] for x in f] for i, f in found[0]} == {1: ["guess"], 2: ["guess"], 3: ["guess"], 4: ["guess"], 5: []}


def test_base_spans_are_priced():
    calls = secrets.priced_secrets("password=hunter2000 AKIA" + "A1B2C3D4" * 2 + " " + "deadbeef" * 4)
    assert [x[0] for x in calls] == ["assign", "access", "hex"]
    assert all(x[3] == pytest.approx(secrets.guess_cost(v)) for x, v in zip(calls, ["hunter2000", "AKIA" + "A1B2C3D4" * 2, "deadbeef" * 4], strict=True))


BODY = "<h1>Title of it</h1><p>" + "The long body of the page goes on for a while. " * 6 + "</p>"


@pytest.mark.parametrize(("page", "want"), [
    (f"<html><body><form id=aspnetForm><nav>Menu</nav>{BODY}<input name=x></form></body></html>", True),
    (f"<html><body><form><article>{BODY}</article></form><footer>F</footer></body></html>", True),
    (f"<html><body><article>{BODY}<form><p>Send us your mail</p><input></form></article></body></html>", True),
    ("<html><body><form><input></form></body></html>", False),
])
def test_forms_around_the_text_stay(page, want):
    text = html_text.extract(page, html_text.best_path(page))
    assert ("The long body" in text) == want and "Send us" not in text and "Menu" not in text


def test_labels_and_adverts_inside_an_article_go():
    page = f"<html><body><article>{BODY}<label>Your name</label><div class='adsbygoogle'>Buy now</div></article></body></html>"
    text = html_text.extract(page, html_text.best_path(page))
    assert "Your name" not in text and "Buy now" not in text and "The long body" in text


def test_licenses_of_one_family_stay_apart():
    notice = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    )
    found = lambda name: {x[0] for x in licenses.find_licenses(notice.format(name), licenses.Templates(licenses.WORDINGS))}
    assert not any(x.startswith("GPL") for x in found("Affero General Public License") | found("Lesser General Public License"))
    assert any(x.startswith("GPL") for x in found("General Public License"))
