"""Text column functions (cleaning, trimming, integer parsing, templates)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CLEAN_PATTERN  # noqa: F401  (the rule, as written; see DELETE_CLASS)

# What Python's str.split()/str.strip() treat as whitespace, as one regex class:
# ASCII whitespace, the file/group/record/unit separators, NEL and Unicode separators.
_WS = r"[\s\x1c-\x1f\x85\p{Z}]"
# an optionally signed decimal integer, surrounded by optional whitespace
_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters CLEAN_PATTERN deletes, spelled as the ranges between the kept
# ones (Java's \s is [\t\n\x0B\f\r ]): the same result, but Java's regex
# engine tests one positive range list ~7x faster than the negated union.
# tests/test_functions.py checks both agree on every code point.
DELETE_CLASS = ("[\\x00-\\x08\\x0E-\\x1F\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60"
                "\\x7B-\\uABFF\\uD7A4-\\x{10FFFF}]")


def clean_text(c) -> Column:
    """Delete every character that is not a Hangul syllable, ASCII letter, digit
    or whitespace (D1)."""
    return F.regexp_replace(_c(c), DELETE_CLASS, "")


def strip_ws(c) -> Column:
    """Trim leading/trailing whitespace the way Python's ``str.strip`` does."""
    return F.regexp_replace(_c(c), f"^{_WS}+|{_WS}+$", "")


def collapse_ws(c) -> Column:
    """Collapse whitespace runs to one space and trim (C4, ``" ".join(s.split())``)."""
    return F.trim(F.regexp_replace(_c(c), f"{_WS}+", " "))


def join_paragraphs(parts, sep: str = " ") -> Column:
    """Trim each piece of an array of strings and join with ``sep``."""
    return F.array_join(F.transform(_c(parts), strip_ws), sep)


def strip_suffix(c, suffix: str) -> Column:
    """If the text ends with ``suffix``, drop it and trim the rest."""
    c = _c(c)
    head = F.left(c, F.length(c) - F.lit(len(suffix)))
    return F.when(c.endswith(F.lit(suffix)), strip_ws(head)).otherwise(c)


def parse_count(c) -> Column:
    """"1,234" -> 1234; anything that is not an integer -> 0."""
    s = F.regexp_replace(_c(c).cast("string"), ",", "")
    v = F.when(s.rlike(_INT_TEXT), F.trim(s).try_cast("bigint"))
    return F.coalesce(v, F.lit(0).cast("bigint"))


def parse_score(c, on_failure: int | None = 0) -> Column:
    """Integer score out of model text: trimmed, integer-only; else ``on_failure``
    (D9). ``on_failure=None`` keeps the failure visible as NULL."""
    s = _c(c).cast("string")
    v = F.when(s.rlike(_INT_TEXT), F.trim(s).try_cast("int"))
    return v if on_failure is None else F.coalesce(v, F.lit(on_failure).cast("int"))


def score_from_response(c, path: str = "$.choices[0].message.content",
                        on_failure: int | None = 0) -> Column:
    """Model response JSON -> integer score: the text at ``path``, parsed like
    ``parse_score``; a malformed response or missing path -> ``on_failure`` (D9)."""
    return parse_score(F.get_json_object(_c(c), path), on_failure)


def absolute_link(c, base: str, prefix: str = "/") -> Column:
    """Prefix relative links that start with ``prefix`` with ``base`` (C9). A link that
    starts with ``//`` names its own host and stays."""
    c = _c(c)
    return F.when(c.startswith(prefix) & ~c.startswith("//"), F.concat(F.lit(base), c)).otherwise(c)


def render_prompt(template: str, *cols) -> Column:
    """Fill a ``%s`` template with column values (D8); NULL renders as "null"."""
    return F.format_string(template, *[_c(x) for x in cols])
