"""Alert rules: an event is an alert if ANY rule holds (SQL three-valued OR)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the alert thresholds.
SPEED_LIMIT = 120
RPM_LIMIT = 6000


@dataclass(frozen=True)
class Rule:
    """A named predicate; ``build()`` returns the Column (built lazily, per session)."""

    name: str
    build: Callable[[], Column]


def overspeed(limit: float = SPEED_LIMIT, column: str = "speed") -> Rule:
    return Rule("overspeed", lambda: F.col(column) > F.lit(limit))


def high_rpm(limit: int = RPM_LIMIT, column: str = "rpm") -> Rule:
    return Rule("high_rpm", lambda: F.col(column) > F.lit(limit))


def gear_mismatch(actual: str = "gear", expected: str = "expected_gear") -> Rule:
    # Plain inequality, not null-safe: a NULL gear never mismatches by itself.
    return Rule("gear_mismatch", lambda: F.col(actual) != F.col(expected))


# Evaluation order only: OR is commutative, NULLs included, and no rule can raise, so the
# rule most often TRUE goes first and short-circuits the others for most rows (a gear
# mismatch holds for ~5 in 6 events when gears are uniform, overspeed ~1 in 3, high rpm less).
DEFAULT_RULES: tuple[Rule, ...] = (gear_mismatch(), overspeed(), high_rpm())


def any_rule(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    if not rules:
        raise ValueError("at least one rule is needed")
    return reduce(lambda a, b: a | b, [r.build() for r in rules])


def detect(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Keep rows where any rule is TRUE; a row whose rules are all FALSE/NULL is dropped."""
    return df.where(any_rule(rules))
