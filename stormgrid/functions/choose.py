"""First-match choice."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(cases: Iterable[tuple[Column, object]]) -> Column:
    """CASE WHEN over (condition, value) pairs, null when none holds."""
    (condition, value), *rest = list(cases)
    choice = F.when(condition, value)
    for condition, value in rest:
        choice = choice.when(condition, value)
    return choice
