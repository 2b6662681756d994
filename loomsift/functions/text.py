"""Text column functions. All stay on the JVM.

Patterns carry ``(?U)`` so that classes follow Unicode; lengths and cuts count code
points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode text tools see it, with the four ASCII separators.
_SPACE = r"[\s\x1c-\x1f]"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def drop_tags(x: Column) -> Column:
    """Remove ``<...>``; entities and what stands inside script or style stay."""
    return F.regexp_replace(x, "<[^>]+>", "")


def collapse(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U){_SPACE}+", " ")


def head(x: Column, n: int) -> Column:
    return F.substring(x, 1, n)


def html_summary(x: Column, n: int = 500) -> Column:
    return head(strip(drop_tags(strip(F.coalesce(x, F.lit(""))))), n)


def title_key(title: Column, n: int = 50) -> Column:
    """Lower-case, only a-z and 0-9, cut. Titles without any share the empty key."""
    return head(F.regexp_replace(F.lower(title), "[^a-z0-9]", ""), n)


def digest16(x: Column) -> Column:
    return head(F.sha2(x, 256), 16)


def fingerprint(given: Column, content: Column) -> Column:
    """The given one, or that of the first 200 characters where it is missing."""
    return F.coalesce(F.nullif(given, F.lit("")), digest16(head(F.coalesce(content, F.lit("")), 200)))


def record_fingerprint(category: Column, index: Column, content: Column, prefix: str = "") -> Column:
    return digest16(F.concat(F.lit(prefix), F.concat_ws("-", category, index.cast("string"), head(content, 200))))


def record_id(prefix: str, category: Column, index: Column) -> Column:
    return F.format_string(f"{prefix}-%s-%06d", category, index)


def drop_thinking(x: Column) -> Column:
    return F.regexp_replace(x, r"(?sU)<think>.*?</think>\s*", "")


def any_of(terms: Sequence[str]) -> str:
    """Terms as whole words, in any case. Terms are patterns; inflected forms don't
    match unless a term says so."""
    return rf"(?iU)\b({'|'.join(terms)})\b"


def holds_any(x: Column, terms: Sequence[str]) -> Column:
    return F.coalesce(F.rlike(x, F.lit(any_of(terms))), F.lit(False))


def count_any(x: Column, terms: Sequence[str]) -> Column:
    return F.regexp_count(x, F.lit(any_of(terms))).cast("long")


def iso_utc(epoch_seconds: Column) -> Column:
    """Epoch seconds to ``2024-01-31T12:00:00+00:00``; the session is in UTC."""
    return F.date_format(F.timestamp_seconds(epoch_seconds), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
