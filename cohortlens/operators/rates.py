"""Counts, shares and one-pass breakdowns. All combine map-side first."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate(part: str, total: str) -> Column:
    """Share rounded to four places; NULL instead of an error when there is no row."""
    return F.round(F.try_divide(F.col(part), F.col(total)), 4)


def counts_by(df: DataFrame, by: Iterable[str], total: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Row count plus one conditional count per entry, per group or overall."""
    measures = [F.count("*").alias(total)]
    measures += [F.count_if(condition).alias(name) for name, condition in conditions.items()]
    by = list(by)
    return df.groupBy(*by).agg(*measures) if by else df.agg(*measures)


def global_mean(df: DataFrame, column: str, valid: Column | None = None) -> Column:
    """Mean over the whole table as a scalar subquery: part of the plan, no driver trip."""
    value = F.col(column) if valid is None else F.when(valid, F.col(column))
    return df.select(F.avg(value)).scalar()


def group_count(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value. NULL is a group of its own.

    With a ``weight`` column a row counts that many times.
    """
    counted = df.groupBy(column).agg(_counted(weight).alias("count"))
    return counted.orderBy(F.desc("count"), F.asc_nulls_first(column))


def breakdown(df: DataFrame, columns: list[str], weight: str | None = None) -> DataFrame:
    """Rows per value of each column in one scan: ``(dimension, value, count)``.

    One GROUPING SETS aggregation instead of a scan per column. ``grouping``
    tells a NULL value from a column that is not part of the set.
    """
    dimension = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in columns])
    value = F.coalesce(*[F.when(F.grouping(c) == 0, F.col(c).cast("string")) for c in columns])
    return (
        df.groupingSets([[c] for c in columns], *columns)
        .agg(dimension.alias("dimension"), value.alias("value"), _counted(weight).alias("count"))
        .select("dimension", "value", "count")
    )


def _counted(weight: str | None) -> Column:
    return F.count("*") if weight is None else F.sum(weight)
