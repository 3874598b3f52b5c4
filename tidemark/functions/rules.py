"""Rules and expectations as data.

A rule names a reason and a condition for rejection. A list of rules compiles to one CASE
expression, so routing any table costs one projection. A condition that evaluates to NULL does not
reject: missing optional values pass unless a rule asks for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import expected_value, first_match


@dataclass(frozen=True)
class Rule:
    """Reject a row with ``reason`` where ``rejects`` is TRUE."""

    reason: str
    rejects: Column


@dataclass(frozen=True)
class Expectation:
    """A named predicate; only TRUE passes."""

    name: str
    predicate: Column

    @property
    def holds(self) -> Column:
        return F.coalesce(self.predicate, F.lit(False))


def missing(column: str, reason: str) -> Rule:
    return Rule(reason, F.col(column).isNull())


def any_missing(columns: Sequence[str], reason: str) -> Rule:
    condition = F.lit(False)
    for column in columns:
        condition = condition | F.col(column).isNull()
    return Rule(reason, condition)


def differs(column: str, other: str, reason: str) -> Rule:
    return Rule(reason, F.col(column) != F.col(other))


def outside(column: str, low: float, high: float, reason: str, only: Column | None = None) -> Rule:
    """Inclusive bounds; ``only`` limits the rule to some rows."""
    wrong = ~F.col(column).between(low, high)
    return Rule(reason, wrong if only is None else only & wrong)


def wrong_unit(
    kind: str, unit: str, units: Mapping[str, str], reason: str, unknown_kind_rejects: bool
) -> Rule:
    """The unit must be the one mapped to the kind. A NULL unit passes."""
    expected = expected_value(F.col(kind), dict(units))
    mismatch = F.col(unit) != expected
    return Rule(reason, expected.isNull() | mismatch if unknown_kind_rejects else mismatch)


def flagged(flag: str, reason: str) -> Rule:
    return Rule(reason, F.col(flag))


def reason_of(rules: Sequence[Rule]) -> Column:
    """The first matching reason, else NULL."""
    return first_match([(rule.rejects, rule.reason) for rule in rules])
