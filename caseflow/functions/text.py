"""Text functions as column expressions; none of them leaves the JVM.

The ``(?U)`` flag makes ``\\w``, ``\\s`` and ``\\S`` follow Unicode, so a no-break space
counts as white space and an accented letter as part of a word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define the cleaning rules.
MENTION_WORD = r"@\w+"
MENTION_NON_SPACE = r"@\S+"
URL_OR_WWW = r"https?://\S+|www\.\S+"
URL = r"https?://\S+"
NOT_KEPT = r"[^a-zA-Z0-9\s$.,!?'-]"
SIGN_OFF = r"[\^–-][A-Z]{1,3}\s*$"


def _sub(col: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col, "(?U)" + pattern, replacement)


def strip(col: Column) -> Column:
    """Drop white space of every kind at both ends (``trim`` drops spaces only)."""
    return _sub(col, r"^\s+|\s+$", "")


def collapse(col: Column) -> Column:
    return strip(_sub(col, r"\s+", " "))


def is_blank(col: Column) -> Column:
    """Null counts as not blank here; callers count nulls on their own."""
    return F.coalesce(col.rlike(r"(?U)^\s*$"), F.lit(False))


def clean(col: Column) -> Column:
    """Message text for the models: no handles, links or unusual characters; case kept."""
    without_links = _sub(_sub(col, MENTION_WORD, ""), URL_OR_WWW, "")
    return F.coalesce(collapse(_sub(without_links, NOT_KEPT, " ")), F.lit(""))


def normalize_for_counts(col: Column) -> Column:
    """Lower-cased text with handles and links cut out, for duplicate counts."""
    return F.coalesce(
        collapse(F.lower(_sub(_sub(col, MENTION_NON_SPACE, ""), URL, ""))), F.lit("")
    )


def normalize_for_topics(col: Column) -> Column:
    """As above, but a handle or a link leaves a space behind."""
    return F.coalesce(
        F.lower(collapse(_sub(_sub(col, MENTION_NON_SPACE, " "), URL, " "))), F.lit("")
    )


def words(col: Column) -> Column:
    return F.filter(F.split(col, " "), lambda w: w != "")


def word_count(col: Column) -> Column:
    return F.size(words(normalize_for_topics(col))).cast("long")


def scrub_reply(col: Column) -> Column:
    """An agent's reply without handles and without the initials that sign it."""
    return strip(_sub(collapse(_sub(col, MENTION_WORD, "")), SIGN_OFF, ""))


def contains_any(col: Column, needles: list[str]) -> Column:
    """True where ``col`` holds one of the substrings; null text gives false."""
    hit = F.lit(False)
    for needle in needles:
        hit = hit | col.contains(needle)
    return F.coalesce(hit, F.lit(False))


def case_id(component: Column) -> Column:
    return F.concat(F.lit("case_"), component.cast("string"))


def golden_id(position: Column) -> Column:
    """``g0001`` and so on; numbers above 9999 keep all their digits."""
    digits = position.cast("string")
    return F.concat(
        F.lit("g"), F.when(F.length(digits) >= 4, digits).otherwise(F.lpad(digits, 4, "0"))
    )


def merge_notes(old: Column, new: Column) -> Column:
    """``old | new``; a missing or empty part leaves no bar behind."""
    parts = [F.when(part != "", part) for part in (strip(old), strip(new))]
    return F.concat_ws(" | ", *parts)


def seeded_hash(seed: int, *ids: Column) -> Column:
    """The 'random' order of every sample: equal on every run and every engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def fill(template: str, *values: Column) -> Column:
    """A sentence with ``{}`` in it, filled with text columns; null if one of them is."""
    pieces = template.split("{}")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [value, F.lit(piece)]
    return F.concat(*parts)
