"""Personal data: format-preserving pseudonyms from a keyed Feistel permutation.

Validated values (cards by Luhn, IBANs by modulus 97, dates by calendar, addresses and phone
numbers by range) are mapped within their own format: each value of a format goes to exactly
one other value of that format, so equal values stay linked across documents, different
values stay different, and the pseudonym validates like the original.  A date keeps its order,
separator and padding; formats that can write the same dates share one permutation.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import small_batches

KINDS = ("email", "iban", "card", "ssn", "ipv4", "phone", "date")
ROUNDS = 10


def feistel(x: int, size: int, key: bytes, tweak: bytes) -> int:
    """A keyed permutation of 0 .. size-1.

    ``x`` splits into two halves of about the root of ``size``; each round adds a keyed hash
    of one half to the other.  Results outside the domain walk on until they fall inside,
    which keeps it a permutation.  ``tweak`` separates formats.
    """
    if size < 2:
        return x
    a = int(size**0.5) if size < 1 << 50 else _root(size)
    while a * a < size:
        a += 1
    b = -(-size // a)
    width = (max(a, b).bit_length() + 7) // 8 + 8
    while True:
        left, right = divmod(x, b)
        for r in range(ROUNDS):
            if r % 2:
                right = (right + _prf(key, tweak, r, left, width)) % b
            else:
                left = (left + _prf(key, tweak, r, right, width)) % a
        x = left * b + right
        if x < size:
            return x


def unfeistel(y: int, size: int, key: bytes, tweak: bytes) -> int:
    """The inverse of :func:`feistel`, for whoever holds the key."""
    if size < 2:
        return y
    a = int(size**0.5) if size < 1 << 50 else _root(size)
    while a * a < size:
        a += 1
    b = -(-size // a)
    width = (max(a, b).bit_length() + 7) // 8 + 8
    while True:
        left, right = divmod(y, b)
        for r in reversed(range(ROUNDS)):
            if r % 2:
                right = (right - _prf(key, tweak, r, left, width)) % b
            else:
                left = (left - _prf(key, tweak, r, right, width)) % a
        y = left * b + right
        if y < size:
            return y


def _root(n: int) -> int:
    x = 1 << (n.bit_length() + 1) // 2
    while x * x > n:
        x = (x + n // x) // 2
    return x


def _prf(key: bytes, tweak: bytes, r: int, half: int, width: int) -> int:
    text = b"|".join((len(key).to_bytes(2, "big") + key, tweak, bytes([r]), half.to_bytes(width, "big")))
    return int.from_bytes(hashlib.shake_256(text).digest(width), "big")


def permute_digits(digits: str, key: bytes, tweak: bytes) -> str:
    n = len(digits)
    return str(feistel(int(digits), 10**n, key, tweak + b"%d" % n)).zfill(n) if n else digits


#: Letters and digits that are permuted together; longer words go block by block.
BLOCK_CHARS = 16


def permute_word(word: str, key: bytes, tweak: bytes) -> str:
    """ASCII letters map to letters and digits to digits; the rest and the case pattern stay.

    Words with more than ``BLOCK_CHARS`` letters and digits are permuted in blocks, first
    forwards, each block under a tweak from the block before it, and then backwards: still one
    permutation of the words of this format, in time proportional to their length.
    """
    at = [i for i, c in enumerate(word) if c.isascii() and c.isalnum()]
    radix = [10 if word[i].isdigit() else 26 for i in at]
    values = [ord(word[i]) - 48 if n == 10 else (ord(word[i]) | 32) - 97 for i, n in zip(at, radix, strict=True)]
    shape = "".join("9" if c.isascii() and c.isdigit() else "a" if c.isascii() and c.isalpha() else c for c in word)
    base = tweak + hashlib.sha256(shape.encode("utf-8", "surrogatepass")).digest()
    starts = range(0, len(at), BLOCK_CHARS)
    for sweep in (starts, reversed(starts)) if len(starts) > 1 else (starts,):
        chained = b"" if sweep is starts else b"back"
        for s in sweep:
            part = slice(s, s + BLOCK_CHARS)
            values[part] = _permute_block(values[part], radix[part], key, base + b"%d" % s + chained)
            chained = bytes(values[part]) + (b"" if sweep is starts else b"back")
    out = list(word)
    for i, n, v in zip(at, radix, values, strict=True):
        out[i] = chr(48 + v) if n == 10 else chr(65 + v) if word[i].isupper() else chr(97 + v)
    return "".join(out)


def _permute_block(values: list[int], radix: list[int], key: bytes, tweak: bytes) -> list[int]:
    size, x = 1, 0
    for v, n in zip(values, radix, strict=True):
        size, x = size * n, x * n + v
    x = feistel(x, size, key, tweak)
    out = []
    for n in reversed(radix):
        x, v = divmod(x, n)
        out.append(v)
    return out[::-1]


def luhn_digit(payload: str) -> str:
    """The check digit that completes ``payload``."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(original: str, new: str) -> str:
    """``original`` with its ASCII letters and digits replaced in turn by those of ``new``."""
    it = iter(new)
    return "".join(next(it) if c.isascii() and c.isalnum() else c for c in original)


def _compact(text: str) -> str:
    return "".join(c for c in text if c.isascii() and c.isalnum())


def _email(value: str, key: bytes) -> str | None:
    local, _, host = value.partition("@")
    name, _, top = host.rpartition(".")
    return f"{permute_word(local, key, b'local')}@{permute_word(name, key, b'host')}.{top}"


def _card(value: str, key: bytes) -> str | None:
    digits = _compact(value)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = permute_digits(digits[:-1], key, b"card")
    return _refill(value, body + luhn_digit(body))


def _ssn(value: str, key: bytes) -> str | None:
    area, group, serial = value.split("-")
    if not _ssn_ok(area, group, serial):
        return None
    areas = 898  # 001-899 without 666
    x = (int(area) - 1 - (int(area) > 666)) * 99 * 9999 + (int(group) - 1) * 9999 + int(serial) - 1
    x = feistel(x, areas * 99 * 9999, key, b"ssn")
    x, s = divmod(x, 9999)
    a, g = divmod(x, 99)
    a += 1 + (a + 1 >= 666)
    return f"{a:03d}-{g + 1:02d}-{s + 1:04d}"


def _ssn_ok(area: str, group: str, serial: str) -> bool:
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _ipv4(value: str, key: bytes) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = feistel(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, b"ipv4")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _phone(value: str, key: bytes) -> str | None:
    digits = _compact(value)
    if not 8 <= len(digits) <= 15:
        return None
    outside = digits[2:] if value.startswith("00") else digits if value[0] == "+" else ""
    country = country_code(outside)
    fixed = digits[: len(digits) - len(outside)] + country
    if country and re.match(rf"(?:\+|00)[ .-]?{'[ .-]?'.join(country)}[ .-]?\(0\)", value):
        fixed += "0"
    body = digits[len(fixed) :]
    most = NATIONAL.get(country, 15)
    if len(body.lstrip("0")) > most:
        return None
    new = permute_digits(body, key, b"phone" + country.encode())
    # Walking on within numbers of the same kind keeps it a permutation.
    while len(new.lstrip("0")) > most or not country and _trunk(new) != _trunk(body):
        new = permute_digits(new, key, b"phone" + country.encode())
    return _refill(value, fixed + new)


#: Country calling codes of two digits; 1 and 7 stand alone, all others have three (fixed values).
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98".split()
)


def country_code(digits: str) -> str:
    """The calling code that international digits begin with, however they are spaced."""
    return digits[: 1 if digits[:1] in ("1", "7") else 2 if digits[:2] in TWO_DIGIT_CODES else 3]


#: Most digits of a national number, by country code.
NATIONAL = {"1": 10, "33": 9, "34": 9}


def _trunk(digits: str) -> str:
    """What the first digits of a national number say: a long-distance call, a Spanish number, or nothing."""
    if re.match("0[1-9]", digits):
        return "0"
    return "6-9" if len(digits) == 9 and digits[0] in "6789" else ""


def _iban(value: str, key: bytes) -> str | None:
    text = _compact(value).upper()
    turned = text[4:] + text[:4]
    if not 15 <= len(text) <= 34 or int("".join(str(int(c, 36)) for c in turned)) % 97 != 1:
        return None
    body = permute_word(text[4:], key, b"iban")
    rest = int("".join(str(int(c, 36)) for c in body + text[:2] + "00")) % 97
    return _refill(value, f"{text[:2]}{98 - rest:02d}{body}")


#: Dates permute within 1900-2099.
FIRST, LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


@lru_cache(maxsize=16)
def _dates(month_first: bool, day_width: int, month_width: int) -> array:
    """Ordinals of the dates that a format can write, in order.

    A field of one character holds 1 to 9.  Values are read month first only if they aren't dates
    when read day first, so the two have no value in common.
    """
    days = map(date.fromordinal, range(FIRST, LAST + 1))
    return array("l", (
        d.toordinal() for d in days
        if (day_width > 1 or d.day < 10) and (month_width > 1 or d.month < 10) and (not month_first or d.day > 12)
    ))


def _date(value: str, key: bytes) -> str | None:
    sep = next(c for c in value if not c.isdigit())
    parts = value.split(sep)
    for order in ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy"):
        text = dict(zip(order, parts, strict=True))
        try:
            day = date(int(text["y"]), int(text["m"]), int(text["d"])).toordinal()
        except ValueError:
            continue
        if not FIRST <= day <= LAST:
            return None
        domain = _dates(order == "mdy", len(text["d"]), len(text["m"]))
        # One permutation for each set of dates, so a date stays linked over formats that write the same dates.
        tweak = f"date{'mdy' if order == 'mdy' else ''}{len(text['d'])}{len(text['m'])}".encode()
        at = feistel(bisect_left(domain, day), len(domain), key, tweak)
        new = date.fromordinal(domain[at])
        fields = {"y": f"{new.year:04d}", "m": f"{new.month:0{len(text['m'])}d}", "d": f"{new.day:0{len(text['d'])}d}"}
        return sep.join(fields[f] for f in order)
    return None


#: Characters of an IBAN by country (fixed values).
IBAN_LENGTH = {
    c: int(n)
    for c, n in (
        x.split(":")
        for x in (
            "AD:24 AT:20 BE:16 BG:22 CH:21 CY:28 CZ:24 DE:22 DK:18 EE:20 ES:24 FI:18 FR:27 GB:22 GR:27 HR:21 HU:28 IE:22 "
            "IS:26 IT:27 LI:21 LT:20 LU:20 LV:21 MC:27 MT:31 NL:18 NO:15 PL:28 PT:25 RO:24 SE:24 SI:19 SK:24 SM:27 TR:26"
        ).split()
    )
}
_GAP = re.compile(r"[ ./-]+")


def _ends(kind: str, m: re.Match) -> list[int]:
    """Where the value may end: for an IBAN after its country's length, then from the longest to shorter groups."""
    ends = [m.end()]
    if kind in ("iban", "phone"):
        ends += [g.start() for g in reversed([*_GAP.finditer(m.string, m.start(), m.end())])]
    if kind == "iban":
        size = IBAN_LENGTH.get(m[0][:2])
        ends.sort(key=lambda e: len(_compact(m.string[m.start() : e])) != size)
    return ends


#: Pattern and mapping by kind; a mapping answers None where the value doesn't validate.
RULES: dict[str, tuple[re.Pattern, Callable[[str, bytes], str | None]]] = {
    "email": (re.compile(r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"), _email),
    "iban": (re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", re.A), _iban),
    "card": (re.compile(r"(?<![\d.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\d])", re.A), _card),
    "ssn": (re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", re.A), _ssn),
    "ipv4": (re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", re.A), _ipv4),
    "phone": (
        re.compile(
            r"(?<![\w+])(?:"
            r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w|[ .-]\d{2}[ .-]\d{2}(?!\w))"
            r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,5}(?:[ ./-]\d{2,8}){1,5}(?!\w)"
            r"|(?!\d{3}-\d{2}-\d{4}(?!\w))(?:0[1-9](?:[ .-]\d{2}){4}|\(0[1-9]\d{0,3}\)[ .-]?\d{5,8}|0[1-9]\d{0,3}[ /-]\d{5,8}"
            r"|[6-9]\d{2}(?:[ .-]\d{2}){3}|[6-9]\d[ .-]\d{3}(?:[ .-]\d{2}){2})(?!\w|[.-]\d)"
            r"|\+\d{8,15}(?!\w)|00[1-9]\d{7,13}(?!\w|[.-]\d)|00[1-9]\d{0,2}[ .-]?(?:\(0\)[ .-]?)?\d{1,5}(?:[ ./-]\d{2,8}){1,5}(?!\w)"
            r"|0[1-9]\d{8}(?!\w|[.-]\d))",
            re.A,
        ),
        _phone,
    ),
    "date": (re.compile(r"(?<![\d./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\d]|[./-]\d)", re.A), _date),
}
_DIGIT = re.compile(r"\d", re.A)


def find_pii(text: str | None, key: bytes) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of validated values, in order, without overlaps.

    Kinds earlier in ``KINDS`` win where values overlap.
    """
    if not text:
        return []
    digits = _DIGIT.search(text) is not None
    taken: list[tuple[str, int, int, str]] = []
    for kind in KINDS:
        if not digits if kind != "email" else "@" not in text:
            continue
        pattern, convert = RULES[kind]
        ends = [x[2] for x in taken]  # those of the earlier kinds, in order
        own = []
        at = 0
        while m := pattern.search(text, at):
            start, at = m.start(), m.start() + 1
            next_ = bisect_right(ends, start)
            limit = taken[next_][1] if next_ < len(taken) else len(text)
            for end in _ends(kind, m):
                if end > limit or end < m.end() and not pattern.fullmatch(text, start, end):
                    continue
                new = convert(text[start:end], key)
                if new is not None:
                    own.append((kind, start, end, new))
                    at = end
                    break
        taken = sorted(taken + own, key=lambda x: x[1])
    return taken


def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, list[tuple[str, int, int, str]]]:
    """The text with every found value replaced, and the values found."""
    found = find_pii(text, key)
    out, at = [], 0
    for _, s, e, new in found:
        out += [text[at:s], new]
        at = e
    return ("".join([*out, text[at:]]) if found else text), found


def pseudonymise_documents(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text (pseudonymised) and ``found`` (kind, start, end).

    Offsets are code points in the original text.  Null stays null, empty stays empty; whole
    texts of any length are searched; repeated rows give repeated results, and equal values
    get equal pseudonyms everywhere.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    secret = key.encode()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = [], []
            for t in b.column("text").to_pylist():
                new, found = pseudonymise(t, secret)
                texts.append(new)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e, _ in found])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(texts, pa.string()), pa.array(spans, kind)], names=["doc_id", "text", "found"]
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, text string, found array<struct<kind:string,start:int,end:int>>")
