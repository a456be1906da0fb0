"""License scans by conditional compression.

Paragraphs that speak of licensing are compressed with zstandard, piece by piece, once without
help and once with each license's wordings and text as a raw dictionary.  The licenses are
ranked by how much smaller their dictionary makes a piece.  The best decides which paragraphs
after it belong to the block; and going down the ranking a license holds if the words by which
the block differs from one of its wordings are few and leave the words that identify the license
untouched.  The ranking has no lower end: a wording of three words in a long piece may save no
byte at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import small_batches

_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
#: Public wordings of license notices by SPDX id (fixed values).  Words in braces identify
#: the license: a block that lacks one of them doesn't hold it.
WORDINGS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the {Apache} License, Version {2.0}",
        "Licensed under the {Apache} License, Version {2.0} (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "SPDX-License-Identifier: {Apache-2.0}",
    ),
    "MIT": (
        "Released under the {MIT} License",
        "Licensed under the {MIT} License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, {sublicense}, and/or sell "
        "copies of the Software",
        "SPDX-License-Identifier: {MIT}",
    ),
    "GPL-2.0": (
        "This work is licensed under the {GNU} {General} Public License, version {2}",
        "you can redistribute it and/or modify it under the terms of the {GNU} {General} Public License as "
        "published by the Free Software Foundation; either version {2} of the License",
        "SPDX-License-Identifier: {GPL-2.0}",
    ),
    "GPL-3.0": (
        "This work is licensed under the {GNU} {General} Public License, version {3}",
        "you can redistribute it and/or modify it under the terms of the {GNU} {General} Public License as "
        "published by the Free Software Foundation, either version {3} of the License",
        "SPDX-License-Identifier: {GPL-3.0}",
    ),
    "LGPL-3.0": (
        "This work is licensed under the {GNU} {Lesser} General Public License, version {3}",
        "SPDX-License-Identifier: {LGPL-3.0}",
    ),
    "AGPL-3.0": (
        "This work is licensed under the {GNU} {Affero} General Public License, version {3}",
        "SPDX-License-Identifier: {AGPL-3.0}",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the {Mozilla} Public License, v. {2.0}",
        "SPDX-License-Identifier: {MPL-2.0}",
    ),
    "Zlib": ("This software is provided {as-is}, without any express or implied warranty. In no event will the authors be held "
             "{liable} for any damages arising from the use of this software",
             "SPDX-License-Identifier: {Zlib}"),
    "BSL-1.0": ("Distributed under the {Boost} {Software} License, Version {1.0}", "SPDX-License-Identifier: {BSL-1.0}"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: {Neither} the {name} of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products",
        _BSD_CONDITIONS + " 3. {Neither} the {name} of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission",
        "Released under the {BSD} {3-Clause} License",
        "SPDX-License-Identifier: {BSD-3-Clause}",
    ),
    "BSD-2-Clause": (
        "{Redistribution} and use in source and {binary} forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Released under the {BSD} {2-Clause} License",
        "SPDX-License-Identifier: {BSD-2-Clause}",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any {purpose} with or without {fee} is "
        "hereby granted",
        "Released under the {ISC} License",
        "SPDX-License-Identifier: {ISC}",
    ),
    "CC-BY-4.0": ("Licensed under {CC} {BY} {4.0}", "This work is licensed under a Creative Commons {Attribution} {4.0} International License"),
    "CC-BY-SA-4.0": ("Licensed under {CC} {BY-SA} {4.0}", "This work is licensed under a Creative Commons {Attribution-ShareAlike} {4.0} International License"),
    "CC-BY-NC-4.0": ("Licensed under {CC} {BY-NC} {4.0}", "This work is licensed under a Creative Commons {Attribution-NonCommercial} {4.0} International License"),
    "CC-BY-ND-4.0": ("Licensed under {CC} {BY-ND} {4.0}", "This work is licensed under a Creative Commons {Attribution-NoDerivatives} {4.0} International License"),
    "CC0-1.0": ("Dedicated to the public domain under {CC0} {1.0}", "Licensed under {CC0} {1.0}"),
    "Unlicense": ("This is free and {unencumbered} software released into the public {domain}",),
    "all-rights-reserved": ("{All} {rights} {reserved}",),
}

_NO_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Public texts of short licenses (fixed values): what follows a notice's first words belongs
#: to the notice if its license's text explains it.
FULL_TEXTS: dict[str, str] = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the Software. " + _NO_WARRANTY,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
    "AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
    "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}",
    "BSD-3-Clause": f"{_BSD_CONDITIONS} 3. Neither the name of the copyright holder nor the names of its contributors may be used "
    f"to endorse or promote products derived from this software without specific prior written permission. {_BSD_DISCLAIMER}",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means. " + _NO_WARRANTY,
    "Zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable "
    "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
    "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
    "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is "
    "not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
    "original software. 3. This notice may not be removed or altered from any source distribution.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.",
}

#: A block is scanned if it says one of these.
CANDIDATE = re.compile(
    r"licen[cs]|spdx|rights\s+reserved|permission\s+(?:is\s+hereby|to\s+use)|redistribut|unencumbered"
    r"|without\s+any\s+express|public\s+domain|creative\s+commons|copyleft|\bGPL|\bCC[\s-](?:BY|0)|\bCC0\b",
    re.I,
)
_HINT = ("icen", "ICEN", "pdx", "PDX", "ights", "IGHTS", "ermission", "ERMISSION", "edistrib", "EDISTRIB", "ncumber", "NCUMBER", "xpress", "XPRESS",
         "ublic", "UBLIC", "ommons", "OMMONS", "opyleft", "OPYLEFT", "GPL", "gpl", "CC", "cc ", "cc-", "cc0",
         "cc\n", "cc\r", "cc\t")
#: A word; after a hyphen it may go on in the next line, behind indents and comment marks.
WORD = re.compile(r"[A-Za-z0-9]+(?:(?:\.|-(?:\r?\n[ \t>*#/;%]*)?)[A-Za-z0-9]+)*")
_BREAK = re.compile(r"\s[\s>*#/;%]*")
#: Share of a wording's words that may differ.
MOST_DIFFERENCES = 0.15
#: Blocks are compressed in overlapping pieces of so many characters, three times the longest
#: wording; larger inputs get other parameters with and without a dictionary.
PIECE, STEP = 1024, 512


def _words(text: str) -> list[str]:
    return [_BREAK.sub("", w).lower() for w in WORD.findall(text)]


#: A paragraph that follows a notice belongs to it if the license's dictionary takes so much off it.
CONTINUES = 0.4
#: What denies the words after it.
DENIALS = frozenset("not never nor no isn wasn aren".split())


class Templates:
    """The wordings with their dictionaries, ready to scan; built once per task."""

    def __init__(self, wordings: dict[str, tuple[str, ...]] = WORDINGS, full_texts: dict[str, str] = FULL_TEXTS) -> None:
        self.wordings, self.with_dict = {}, {}
        self.full = {name: _words(text) for name, text in full_texts.items()}
        for name, texts in wordings.items():
            self.wordings[name] = [
                (_words(t.replace("{", " ").replace("}", " ")), {x.lower() for x in re.findall(r"\{([^}]*)\}", t)}) for t in texts
            ]
            texts = [full_texts.get(name, ""), *texts]
            raw = "\n".join(t.replace("{", "").replace("}", "") for t in texts).encode()
            held = zstandard.ZstdCompressionDict(raw.ljust(8, b"\n"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_dict[name] = zstandard.ZstdCompressor(level=3, dict_data=held, write_content_size=False)
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)

    def rank(self, block: str) -> list[tuple[int, str]]:
        """(bytes saved in the piece that saves most, license) most saved first; ties by name."""
        saved: dict[str, int] = {}
        for at in range(0, max(1, len(block) - (PIECE - STEP)), STEP):
            raw = block[at : at + PIECE].encode("utf-8", "surrogatepass")
            alone = len(self.plain.compress(raw))
            for n, c in self.with_dict.items():
                gain = alone - len(c.compress(raw))
                saved[n] = max(gain, saved.get(n, gain))
        return sorted(((gain, n) for n, gain in saved.items()), key=lambda x: (-x[0], x[1]))

    def continues(self, name: str, paragraph: str) -> bool:
        """Whether the license's text explains the paragraph."""
        raw = paragraph.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        return alone - len(self.with_dict[name].compress(raw)) >= CONTINUES * alone

    def confirm(self, name: str, block_words: list[str], places: dict[str, list[int]] | None = None) -> tuple[int, int] | None:
        """The fewest words by which the block differs from a wording of ``name``, and that wording's number; None: too many.

        Differences are counted in the stretch of words that agree which has the fewest; a
        wording's words outside that stretch count as missing.  A stretch right behind a
        denial doesn't count.  ``places`` are the positions of each word of the block.  Of
        wordings with equally few differences the longest is taken.
        """
        places, best = word_places(block_words) if places is None else places, None
        for number, (wording, marks) in enumerate(self.wordings[name]):
            if not all(m in places for m in marks):
                continue
            for lo, hi in _windows(wording, marks, len(block_words), places):
                differ = _differ(wording, marks, block_words, lo, hi)
                if differ is not None and differ <= MOST_DIFFERENCES * len(wording):
                    rank = (differ, -len(wording), number)
                    best = rank if best is None or rank < best else best
        return best and (best[0], best[2])

    def covers(self, outer: str, name: str, number: int) -> bool:
        """Whether the text of ``outer`` holds every word of a wording of ``name`` in a row."""
        x, y = self.full.get(outer, []), self.wordings[name][number][0]
        return outer != name and len(y) < len(x) and any(x[i : i + len(y)] == y for i in range(len(x) - len(y) + 1))


#: Words that name another license of a family, so a wording without them isn't that license (fixed values).
RELATIVES = frozenset("affero lesser library".split())


def word_places(words: list[str]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(w, []).append(i)
    return out


def _windows(wording: list[str], marks: set[str], n: int, places: dict[str, list[int]]) -> Iterator[tuple[int, int]]:
    """Stretches of the block, of which each confirmable place of the wording lies in one.

    Such a place holds all marks and at most as many other words as may differ, so it lies
    around one of the places of the rarest mark.  Wordings without marks are tried everywhere.
    """
    size, slack = len(wording), int(MOST_DIFFERENCES * len(wording))
    if not marks:
        for at in range(0, n, max(1, size)):
            yield max(0, at - slack), at + 2 * size + slack
        return
    rarest = min(marks, key=lambda m: (len(places[m]), m))
    offsets = [i for i, w in enumerate(wording) if w == rarest]
    if offsets:
        for at in places[rarest]:
            yield max(0, at - offsets[-1] - slack), at + size - offsets[0] + slack


def _differ(wording: list[str], marks: set[str], block: list[str], lo: int, hi: int) -> int | None:
    """The fewest words that differ over the stretches of ``block[lo:hi]`` that hold all marks and aren't denied."""
    words = block[lo:hi]
    if not marks <= set(words):
        return None
    equal = [o for o in SequenceMatcher(None, wording, words, autojunk=False).get_matching_blocks() if o.size]
    best = None
    for i in range(len(equal)):
        first = lo + equal[i].b
        if DENIALS & set(block[max(0, first - 2) : first]):
            continue
        agree, kept = 0, set()
        for last in equal[i:]:
            agree += last.size
            kept.update(wording[last.a : last.a + last.size])
            if marks <= kept:
                if RELATIVES & set(block[first : lo + last.b + last.size]) - set(wording):
                    break  # and so does every longer stretch
                differ = max(len(wording) - agree, last.b + last.size - equal[i].b - agree)
                best = differ if best is None or differ < best else best
    return best


def paragraphs(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, speaks of licensing) of the paragraphs, runs of lines up to blank ones."""
    if not any(h in text for h in _HINT):
        return []
    out, at, start, end = [], 0, None, 0
    for line in [*text.split("\n"), ""]:
        if line and not line.isspace():
            start = at if start is None else start
            end = at + len(line)
        elif start is not None:
            out.append((start, end, CANDIDATE.search(text, start, end) is not None))
            start = None
        at += len(line) + 1
    return out


def _confirmed(block: str, templates: Templates) -> list[tuple[str, int, int, int]]:
    """(license, bytes saved, words that differ, wording) of a block, most saved first."""
    ws = _words(block)
    places = word_places(ws)
    found = []
    for saved, name in templates.rank(block):
        if best := templates.confirm(name, ws, places):
            found.append((name, saved, *best))
    return [x for x in found if not any(templates.covers(y[0], x[0], x[3]) for y in found)]


def find_licenses(text: str | None, templates: Templates) -> list[tuple[str, int, int, int, int]]:
    """(license, start, end, bytes saved, words that differ) by block, in order; a license once a block.

    A block is a paragraph that speaks of licensing, with the paragraphs after it that the
    text of its best license explains and that hold no license of their own.  A license whose
    wording is part of another confirmed license's text belongs to that license.
    """
    found = paragraphs(text) if text else []
    out, at = [], 0
    while at < len(found):
        start, end, speaks = found[at]
        at += 1
        if not speaks:
            continue
        ranking = templates.rank(text[start:end])
        while at < len(found) and ranking and templates.continues(ranking[0][1], text[found[at][0] : found[at][1]]):
            if found[at][2] and _confirmed(text[found[at][0] : found[at][1]], templates):
                break
            end = found[at][1]
            at += 1
        out += [(name, start, end, saved, differ) for name, saved, differ, _ in _confirmed(text[start:end], templates)]
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", wordings: dict | None = None) -> DataFrame:
    """One row per input row: doc_id and ``found``, an array of (license, start, end, saved, differ).

    A block may hold several licenses.  Null and empty texts hold none; whole texts of any
    length are scanned; repeated rows give repeated results; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    table = wordings or WORDINGS
    kind = pa.list_(pa.struct([("license", pa.string()), *((k, pa.int32()) for k in ("start", "end", "saved", "differ"))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(table)
        for b in batches:
            found = [
                [dict(zip(("license", "start", "end", "saved", "differ"), x, strict=True)) for x in find_licenses(t, templates)]
                for t in b.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)], names=["doc_id", "found"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {id_type}, found array<struct<license:string,start:int,end:int,saved:int,differ:int>>"
    )
