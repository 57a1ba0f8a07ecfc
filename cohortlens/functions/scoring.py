"""Explainable scoring: flags to points, points to levels, flags to a driver."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_points(flag_points: Iterable[tuple[str, int]]) -> Column:
    """Sum of the points of all raised flags; a NULL flag adds nothing."""
    return reduce(add, [F.when(F.col(flag), points).otherwise(0) for flag, points in flag_points])


def factor_count(factors: Iterable[Column]) -> Column:
    """How many of the conditions hold; an unknown condition does not count."""
    return reduce(add, [F.when(factor, 1).otherwise(0) for factor in factors])


def band_below(measure: Column, limits: Sequence[tuple[float, str]], top: str) -> Column:
    """First label whose limit lies above the measure, else ``top``.

    Limits are exclusive upper bounds in rising order. NULL lands in ``top``.
    """
    (limit, label), *rest = limits
    band = F.when(measure < limit, F.lit(label))
    for limit, label in rest:
        band = band.when(measure < limit, F.lit(label))
    return band.otherwise(F.lit(top))


def score_level(score: Column, high: int, medium: int) -> Column:
    return F.when(score >= high, "HIGH").when(score >= medium, "MEDIUM").otherwise("LOW")


def _raised(flag_labels: Iterable[tuple[str, str]]) -> list[Column]:
    return [F.when(F.col(flag), F.lit(label)) for flag, label in flag_labels]


def last_label(flag_labels: Iterable[tuple[str, str]]) -> Column:
    """Alphabetically last label among the raised flags; NULL if none is raised.

    This is the established driver rule. It ignores the flags' weights.
    """
    return F.greatest(*_raised(flag_labels))


def first_label_by_priority(flag_labels: Iterable[tuple[str, str]]) -> Column:
    """Label of the first raised flag in the given order; NULL if none is raised."""
    return F.coalesce(*_raised(flag_labels))
