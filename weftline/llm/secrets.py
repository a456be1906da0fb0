"""Secret scans: fixed patterns, and guess-cost estimates for values in credential contexts.

The patterns find assignments, access keys and hexadecimal runs.  They and whatever else
stands where a credential would stand are priced: dynamic programming finds the cheapest way
to spell the value as words, dates, repeats, keyboard walks and brute-force spans, and a
value that even the cheapest spelling leaves expensive to guess is a secret.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import Scratch, small_batches

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Kinds in the order in which spans with equal starts are listed.
KINDS = ("assign", "access", "hex", "guess")

#: Where a credential stands: a name, a separator, perhaps a quote, then the value, of which
#: only the start is matched.
CONTEXT = re.compile(
    r"(?:pass(?:word|phrase|wd|code)?|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key"
    r"|client[ _-]?secret|auth(?:orization)?|bearer|credentials?)[\"']?"
    r"(?:\x20*(?:=>|:=|[:=])\x20*|(?P<prose>\x20+is\x20+))(?:bearer\x20+)?(?P<quote>[\"'`]?)(?P<value>(?=\S{6}))",
    re.I | re.A,
)
_NAME = r"[\"'`]?[A-Za-z_$][\w.$-]*[\"'`]?(?:=>|:|=(?=[^\s=]))"
#: Values end at white space; quoted ones at their quote, unquoted ones before the next name.
_NEXT = re.compile(rf"(?:&amp;|[&;,])[{{\[]*{_NAME}|\s|\Z", re.A)
_QUOTED = {q: re.compile(rf"(?:\\\S|[^\s{q}\\])*\\?") for q in "\"'`"}
#: A list or object whose members have names of their own.
_NESTED = re.compile(rf"[{{\[]+{_NAME}", re.A)

#: log10 of the guesses from which a value counts as a secret.
MIN_GUESSES = 9.0

#: Common passwords and words of credential contexts, most frequent first (fixed values).
COMMON = (
    "password 123456 12345678 qwerty abc123 monkey letmein dragon 111111 baseball iloveyou trustno1 1234567 "
    "sunshine master welcome shadow ashley football jesus michael ninja mustang admin login user root guest "
    "secret token test example changeme default hello freedom whatever dummy none null true false your my the "
    "key pass word apikey api access private public client auth bearer value string here insert placeholder "
    "and for with this that from have not you are was but all can had her one our out day get has him his how "
    "man new now old see two way who boy did its let put say she too use time year people"
).split()
RANK = {w: i + 1 for i, w in reversed(list(enumerate(COMMON)))}
#: Words that :func:`word_ranks` takes from the documents at most.
RANKED_WORDS = 20_000
#: Lengths of the words that are counted.
WORD_LENGTHS = (3, 20)

#: Keyboard rows (fixed values); a walk moves along a row, or up and down a column.
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_AT = {c: (r, i) for r, row in enumerate(KEYBOARD) for i, c in enumerate(row)}
_SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))
_LEET = str.maketrans("@4301$5!7", "aaeoissit")

DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")


def _adjacent(a: str, b: str) -> bool:
    """Neighbouring keys of a keyboard."""
    x = _AT.get(_SHIFTED.get(a, a.lower()))
    y = _AT.get(_SHIFTED.get(b, b.lower()))
    return bool(x and y and abs(x[0] - y[0]) + abs(x[1] - y[1]) == 1)


def _charset(c: str) -> float:
    """log10 of the size of the class that a brute-force search would try for ``c``."""
    if c.isdigit():
        return 1.0
    if c.isascii() and c.isalpha():
        return math.log10(26)
    return math.log10(33) if c.isascii() else 2.0


def guess_cost(value: str, ranks: dict[str, int] = RANK) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs.

    Segments are words (their rank in ``ranks``, times 2 for capitals or substitutions), dates (36,500 days),
    repeats of one character or of a block, keyboard walks and sequences, and single
    characters tried by brute force.  Every segment costs a factor 2 more than its guesses,
    for not knowing where it ends.  Linear in the length, as segments are words, dates, runs
    or single characters.
    """
    n = len(value)
    low = value.lower()
    plain = low.translate(_LEET)
    link = math.log10(2)
    best = [0.0] + [math.inf] * n
    run_same = _runs(value, lambda i: value[i] == value[i - 1])
    run_walk = _runs(value, lambda i: _adjacent(value[i - 1], value[i]))
    run_step = _runs(
        value, lambda i: value[i].isascii() and value[i].isalnum() and abs(ord(value[i]) - ord(value[i - 1])) == 1
    )
    again = {block: _again(value, block) for block in BLOCKS}
    for i in range(n):
        here = best[i]
        best[i + 1] = min(best[i + 1], here + _charset(value[i]) + (math.log10(1.5) if value[i].isupper() else 0.0))
        for size in range(2, min(WORD_LENGTHS[1], n - i) + 1):
            rank = ranks.get(low[i : i + size]) or ranks.get(plain[i : i + size])
            if rank:
                odd = 2 if value[i : i + size] not in ranks else 1
                best[i + size] = min(best[i + size], here + math.log10(rank * odd) + link)
        m = DATE.match(value, i)
        if m:
            best[m.end()] = min(best[m.end()], here + math.log10(365 * 100) + link)
        for run, guesses in ((run_same, 95.0), (run_walk, 94.0), (run_step, 62.0)):
            if run[i] >= 3:
                for size in {3, run[i]}:
                    cost = here + math.log10(guesses * size) + link
                    best[i + size] = min(best[i + size], cost)
        for block in BLOCKS:
            size = (again[block][i] + block) // block * block if i + block <= n else 0
            if size >= 2 * block:
                cost = here + sum(map(_charset, value[i : i + block])) + math.log10(size / block) + link
                best[i + size] = min(best[i + size], cost)
    return best[n]


def _runs(value: str, same) -> list[int]:
    """Length of the run that starts at each position."""
    n = len(value)
    out = [1] * n
    for i in range(n - 2, -1, -1):
        if same(i + 1):
            out[i] = out[i + 1] + 1
    return out


#: Lengths of the blocks whose repetition is recognised.
BLOCKS = (2, 3, 4, 5, 6, 7, 8)


def _again(value: str, block: int) -> list[int]:
    """How many characters from each position on equal those ``block`` further."""
    n = len(value)
    out = [0] * (n + 1)
    for i in range(n - block - 1, -1, -1):
        out[i] = out[i + 1] + 1 if value[i] == value[i + block] else 0
    return out


def priced_secrets(text: str | None, min_guesses: float = MIN_GUESSES, ranks: dict[str, int] = RANK) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, log10 of the guesses) of all secrets, code points, end exclusive, in listing order.

    Base kinds are leftmost and non-overlapping each and stay whatever their price; ``guess``
    spans are values in credential contexts whose price is high and which no base span covers
    exactly.  An assignment is priced by its value, the others by their whole span.
    """
    if not text:
        return []
    out: list[tuple[str, int, int, float]] = []
    price = lambda start, end: guess_cost(text[start:end], ranks)
    has_sep = ":" in text or "=" in text
    values: set[tuple[int, int]] = set()
    if has_sep:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                values.add(m.span(2))
                out.append(("assign", m.start(), m.end(), price(*m.span(2))))
    if "AKIA" in text:
        out += [("access", *m.span(), price(*m.span())) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span(), price(*m.span())) for m in LONG_HEX.finditer(text)]
    if has_sep or " is " in text or " IS " in text or " Is " in text:
        bare = {(s, e) for _, s, e, _ in out} | values
        at = 0
        while m := CONTEXT.search(text, at):
            quote, start = m["quote"], m.start("value")
            at = start
            if not quote and _NESTED.match(text, start):
                continue
            stop = _QUOTED[quote].match(text, start).end() if quote else _NEXT.search(text, start).start()
            value = text[start:stop].rstrip("\"'`,;.!?)]}>")
            at = start + len(value)
            if m["prose"] and not quote and value.isalpha():
                continue  # "is" before a bare word is prose
            if len(value) >= 6 and (start, at) not in bare and (cost := guess_cost(value, ranks)) >= min_guesses:
                out.append(("guess", start, at, cost))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def find_secrets(text: str | None, min_guesses: float = MIN_GUESSES, ranks: dict[str, int] = RANK) -> list[tuple[str, int, int]]:
    """(kind, start, end) of :func:`priced_secrets`."""
    return [x[:3] for x in priced_secrets(text, min_guesses, ranks)]


#: ``HEX`` with its length test: runs are maximal, so both find the same.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")


def word_ranks(docs: DataFrame, text_col: str = "text", most: int = RANKED_WORDS) -> dict[str, int]:
    """Ranks of words: the common passwords first, then the ``most`` most frequent words of all documents.

    Words are runs of letters in lower case, of any language, with ``WORD_LENGTHS`` characters;
    ties go to the smaller word.  Counts are combined before the shuffle and only the ``most``
    winners reach the driver.
    """
    words = docs.select(F.explode(F.split(F.lower(text_col), r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(*WORD_LENGTHS))
    # Written first: collecting the limit at once would send the first ``most`` of every task to the driver.
    top = words.groupBy("word").count().orderBy(F.col("count").desc(), "word").limit(most)
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.write(top, "words").collect()
    ranks = dict(RANK)
    for r in sorted(rows, key=lambda r: (-r["count"], r["word"])):
        ranks.setdefault(r["word"], len(ranks) + 1)
    return ranks


def scan_secrets(
    docs: DataFrame, min_guesses: float = MIN_GUESSES, id_col: str = "doc_id", text_col: str = "text", ranks: dict[str, int] | None = None
) -> DataFrame:
    """One row per input row: doc_id and ``found``, an array of (kind, start, end, cost).

    ``cost`` is the log10 of the guesses that the cheapest spelling of the value needs, with
    ``ranks``, by default the common passwords: a fixed list, so what is found in a document
    doesn't depend on the others.  :func:`word_ranks` gives those of a corpus, which belongs
    to other documents than those searched, as a secret among its words is cheap.

    Null and empty texts have none; whole texts are searched, of any length.  Other columns
    are ignored; repeated rows give repeated results.
    """
    small_batches(docs.sparkSession)
    ranks = RANK if ranks is None else ranks
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("cost", pa.float64())]))
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e, "cost": c} for k, s, e, c in priced_secrets(t, min_guesses, ranks)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "found"])

    return source.mapInArrow(run, f"doc_id {id_type}, found array<struct<kind:string,start:int,end:int,cost:double>>")


def redact_secrets(text: str | None, mask: str = "[secret]", min_guesses: float = MIN_GUESSES, ranks: dict[str, int] = RANK) -> str | None:
    """The text with every found span replaced; overlapping spans share one mask."""
    if not text:
        return text
    out, at = [], 0
    for _, s, e in sorted(find_secrets(text, min_guesses, ranks), key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])
