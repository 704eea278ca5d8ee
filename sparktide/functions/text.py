"""Text columns: matching under a collation, padding, replacing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def collated(col: Column, collation: str | None) -> Column:
    """``col`` under a Spark collation, or as it is when none is named."""
    return col if collation is None else F.collate(col, collation)


def like_regex(pattern: str) -> str:
    """The regular expression of a pattern with ``%``, ``_`` and ``[...]``; nothing else is special."""
    parts, at = [], 0
    while at < len(pattern):
        c = pattern[at]
        close = pattern.find("]", at + 2 + (pattern[at + 1 : at + 2] == "^")) if c == "[" else -1
        if close > 0:
            body = pattern[at + 1 : close]
            negated = body.startswith("^")
            inner = re.sub(r"([\\\[\]&^])", r"\\\1", body[negated:])
            parts.append(f"[{'^' * negated}{inner}]")
            at = close + 1
            continue
        parts.append({"%": ".*", "_": "."}.get(c) or (c if c.isalnum() else f"\\x{{{ord(c):x}}}"))
        at += 1
    return "(?s)^" + "".join(parts) + r"\z"


def like(col: Column, pattern: str, collation: str | None = None) -> Column:
    """``LIKE`` in which a backslash is a character like any other and ``[...]`` is a set.

    Sets are matched by a regular expression; under a collation that ignores
    case, so is the expression.
    """
    if "[" in pattern:
        ignore = "(?iu)" if collation and "CI" in collation.upper() or collation == "UTF8_LCASE" else ""
        return F.rlike(col.cast("string"), F.lit(ignore + like_regex(pattern)))
    # An escape character is needed; one that the pattern doesn't hold escapes nothing.
    unused = next(c for c in map(chr, range(1, 32)) if c not in pattern)
    return F.like(collated(col, collation), F.lit(pattern), F.lit(unused))


def repeated(text: str, times: int) -> Column:
    return F.repeat(F.lit(text), times)


def replaced(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def joined(*cols: Column) -> Column:
    """Concatenation; null as soon as one part is null."""
    return F.concat(*cols)


def first_chars(col: Column, n: int) -> Column:
    return F.left(col, F.lit(n))
