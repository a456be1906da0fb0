"""Text cleaning and inspection as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.profiles import SHAD, DOUBLE_SHAD, TER_TSHEG, TIBETAN, TSHEG, ScriptProfile

#: White space as Python's ``str`` counts it, for Java's regular expressions.
SPACE = r"[\s\x1c-\x1f\x85   -     　]"
_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def sanitize_filename(name: Column) -> Column:
    """A name without its extension and with ``<>:"/\\|?*`` replaced by ``_``."""
    return strip(F.regexp_replace(F.regexp_replace(name, r"(?<=[^/.])\.[^./]*$", ""), r'[<>:"/\\|?*]', "_"))


def sanitize_text(text: Column) -> Column:
    """Without control characters other than tab, line feed and carriage return."""
    return F.regexp_replace(text, _CONTROL, "")


def clean_foreign(text: Column, profile: ScriptProfile = TIBETAN) -> Column:
    """Only the script's characters and white space, the latter collapsed to single spaces."""
    kept = F.regexp_replace(text, rf"[^{profile.script}{SPACE[1:-1]}]+", "")
    # Single spaces, nearly all there are, stay as they are; then no other white space is left.
    return F.trim(F.regexp_replace(kept, rf"{SPACE}{{2,}}|[{SPACE[1:-1]}&&[^ ]]", " "))


def remove_script_spaces(text: Column) -> Column:
    """Without the spaces inside Tibetan text and before its punctuation.

    Spaces between two Tibetan characters go in one pass from left to right, so the second
    of two spaces around a single character stays.
    """
    out = F.regexp_replace(text, rf"([ༀ-࿿]){SPACE}+([ༀ-࿿])", "$1$2")
    for mark in (TSHEG, SHAD, DOUBLE_SHAD, TER_TSHEG):
        out = F.regexp_replace(out, rf"{SPACE}+{mark}", mark)
    return strip(F.regexp_replace(out, "  +", " "))


def normalize_spaces(text: Column) -> Column:
    """:func:`remove_script_spaces`, and no white space around ``_`` and ``/``."""
    out = remove_script_spaces(text)
    for mark in ("_", "/"):
        out = F.regexp_replace(out, rf"{SPACE}*{mark}{SPACE}*", mark)
    return strip(F.regexp_replace(out, "  +", " "))


def normalize_text(text: Column, remove_spaces: bool = True) -> Column:
    return normalize_spaces(text) if remove_spaces else text


def syllable_count(text: Column, profile: ScriptProfile = TIBETAN) -> Column:
    """Number of syllable separators."""
    return F.length(text) - F.length(F.replace(text, F.lit(profile.separator), F.lit("")))


def last_syllable(text: Column, profile: ScriptProfile = TIBETAN) -> Column:
    """What follows the last separator, white space at the end left out."""
    return F.substring_index(F.regexp_replace(text, rf"{SPACE}+$", ""), profile.separator, -1)


def last_word(text: Column, profile: ScriptProfile = TIBETAN) -> Column:
    """The last syllable before trailing delimiters; empty if the text ends with a separator."""
    marks = "".join("\\" + c for c in profile.delimiters)
    return last_syllable(F.regexp_replace(text, rf"[{marks}{SPACE[1:-1]}]+$", ""), profile)


def split_parts(text: Column, profile: ScriptProfile = TIBETAN) -> Column:
    """Delimiter runs and the text between them, in order, as an array."""
    marks = "".join("\\" + c for c in profile.delimiters)
    return F.regexp_extract_all(text, F.lit(rf"([{marks}]+|[^{marks}]+)"), 1)


def is_strong(delimiter: Column, profile: ScriptProfile = TIBETAN) -> Column:
    """Whether a delimiter run ends a segment whatever stands around it."""
    out = F.lit(profile.always)
    for c in profile.strong_chars:
        out = out | delimiter.contains(c)
    for c, n in profile.strong_runs:
        out = out | (F.length(delimiter) - F.length(F.replace(delimiter, F.lit(c), F.lit(""))) >= n)
    return out


def transliterated_tokens(text: Column) -> Column:
    """Tokens of transliterated text: ``/`` counts as white space."""
    return F.filter(F.split(text, rf"(?:/|{SPACE})+"), lambda t: t != F.lit(""))


def coalesced_text(text: Column, content: Column) -> Column:
    """``text``, else ``content``; null where both are null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.nullif(content, F.lit("")))


def segment_id(line: Column, order: Column) -> Column:
    """``{line}_{order + 1}``, as downstream files name segments."""
    return F.concat_ws("_", line, order + 1)


def segment_position(segment: Column) -> Column:
    """The 0-based row a segment id points to; 0 without a ``_``."""
    return F.when(segment.contains("_"), F.substring_index(segment, "_", -1).cast("int") - 1).otherwise(F.lit(0))
