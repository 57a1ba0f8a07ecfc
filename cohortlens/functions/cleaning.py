"""Column cleaning rules.

Each function takes and returns a ``Column``. NULL handling is part of the
contract and stated per function; NaN sorts above every number in Spark, so an
upper bound catches it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(condition: Column) -> Column:
    """The condition as a flag that is never NULL: unknown counts as False."""
    return F.coalesce(condition, F.lit(False))


def trim_all(names: Iterable[str]) -> dict[str, Column]:
    """``withColumns`` argument that strips blanks from both ends of each column."""
    return {name: F.trim(name) for name in names}


def keep_if_in(c: Column, allowed: Iterable[str], default: str) -> Column:
    """Values of a closed domain; anything else, NULL included, becomes ``default``."""
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))


def upper_or(c: Column, default: str) -> Column:
    """Trimmed upper case; NULL becomes ``default``."""
    return F.coalesce(F.upper(F.trim(c)), F.lit(default))


def to_boolean(c: Column) -> Column:
    """True for true/yes/y in any case and padding, False for all else.

    Total: an unknown word or NULL is False instead of a cast error. Takes booleans too.
    """
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "yes", "y"), F.lit(False))


def impute_or_cap(c: Column, fill: Column, low: float, high: float) -> Column:
    """NULL or below ``low`` takes ``fill``; above ``high`` (or NaN) takes ``high``."""
    return F.when(c.isNull() | (c < low), fill).when(c > high, F.lit(high)).otherwise(c)


def clamp(c: Column, low: float, high: float) -> Column:
    """Bound to [low, high]. NULL stays NULL, which ``greatest``/``least`` would lose."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def bound_count(count: Column, total: Column) -> Column:
    """A part that cannot be negative or exceed its total; NULL counts as 0.

    An unknown total bounds nothing.
    """
    return F.when(count.isNull() | (count < 0), F.lit(0)).when(count > total, total).otherwise(count)


def positive_or(c: Column, default: int) -> Column:
    """Denominator repair: NULL, zero and negative values become ``default``."""
    return F.when(c.isNull() | (c <= 0), F.lit(default)).otherwise(c)


def percentage(part: Column, total: Column) -> Column:
    return F.round(part / total * 100, 2)


def right_closed_band(c: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the interval (edge, next edge] that holds the value; NULL outside all."""
    band = F.when(c <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        band = band.when(c <= upper, F.lit(label))
    return band
