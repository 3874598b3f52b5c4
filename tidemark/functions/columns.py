"""Column builders shared by the operators. All are native expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def canonical_json(columns: Iterable[str], keep_nulls: bool = True) -> Column:
    """One JSON text per row with the columns in name order."""
    packed = F.struct(*[F.col(f"`{c}`") for c in sorted(columns)])
    return F.to_json(packed, {"ignoreNullFields": str(not keep_nulls).lower()})


def joined_text(columns: Sequence[Column | str]) -> Column:
    """Columns as text joined by a bar, NULL written as a mark, for digests compared across engines."""
    return F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK)) for c in columns])


def digest(text: Column | str) -> Column:
    return F.sha2(text, 256)


def first_match(cases: Sequence[tuple[Column, Column | str]], otherwise: Column | None = None) -> Column:
    """Ordered cases folded into one CASE expression; the first TRUE case decides."""
    if not cases:
        return otherwise if otherwise is not None else F.lit(None).cast("string")
    (condition, value), *rest = cases
    chain = reduce(
        lambda acc, case: acc.when(case[0], _as_column(case[1])),
        rest,
        F.when(condition, _as_column(value)),
    )
    return chain if otherwise is None else chain.otherwise(otherwise)


def _as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def expected_value(kind: Column, mapping: dict[str, str]) -> Column:
    """Lookup of a small fixed mapping; an unmapped kind gives a typed NULL."""
    return first_match([(kind == k, v) for k, v in mapping.items()], F.lit(None).cast("string"))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds of both instants, difference in minutes."""
    seconds = end.cast("timestamp").cast("long") - start.cast("timestamp").cast("long")
    return seconds / F.lit(60.0)
