"""Redaction and term scanning over text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Redaction patterns and their replacement text, applied in this order. The third
# entry is a character every match contains; texts without it skip the pattern.
REDACTIONS = (
    (r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}", "<redacted-email>", "@"),
    (r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "<redacted-guid>", "-"),
    (
        r'(?i)Endpoint=sb://[^"\s]+;SharedAccessKeyName=[^;"\s]+;SharedAccessKey=[^;"\s]+',
        "<redacted-event-hubs-connection>",
        ";",
    ),
    (r'(?i)(sig|se|sp|sv|sr)=[^&"\s]+', "$1=<redacted>", "="),
)


def redact(text: Column, patterns: Sequence[tuple[str, str, str]] = REDACTIONS) -> Column:
    """Replace e-mail addresses, GUIDs, connection strings and signed-URL parameters."""

    def apply(found: Column, rule: tuple[str, str, str]) -> Column:
        pattern, replacement, needed = rule
        return F.when(found.contains(needed), F.regexp_replace(found, pattern, replacement)).otherwise(found)

    return reduce(apply, patterns, text)


def terms_found(lowered: Column, terms: Sequence[str]) -> Column:
    """The terms that occur in a lower-cased text. A projection: no join with the term list."""
    wanted = sorted({t.lower() for t in terms})
    return F.array_compact(F.array(*[F.when(lowered.contains(t), F.lit(t)) for t in wanted]))


def contains_all_filters(status: Column, wanted_status: str, parts: Sequence[Column], query: str) -> Column:
    """Status equals (or ALL) and the lower-cased parts contain the trimmed query."""
    needle = query.strip().lower()
    by_status = F.lit(True) if wanted_status == "ALL" else status == wanted_status
    by_text = F.lit(True) if not needle else F.lower(F.concat_ws(" ", *parts)).contains(needle)
    return by_status & by_text
