"""Running totals and neighbours over a whole ordered table, cut into ranges.

A window without a partition would sort the table in one task. Here the rows are dealt by
range and stored, windows run inside a range, and what a range needs from those before it
(a total, a last row) is one row per range: as many rows as the table has partitions,
whatever its size. Only those pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources.tables import written

RANGE = "_range"
# Up to this many ranges, what is carried between them is part of the plan.
MOST_INLINE = 200


def by_range(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """``df`` dealt by range of ``order``, stored with the number of its range."""
    return written(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()))


def _carried(ranged: DataFrame, rows: list[tuple], fields: list[T.StructField]) -> DataFrame:
    """Adds what each range needs (a row per range): written into the plan if short, else joined."""
    if len(rows) <= MOST_INLINE:
        place = F.array_position(F.array(*[F.lit(r[0]) for r in rows]).cast("array<int>"), F.col(RANGE)).cast("int")
        lists = {
            f.name: F.get(F.array(*[F.lit(r[i]).cast(f.dataType) for r in rows]).cast(T.ArrayType(f.dataType)), place - 1)
            for i, f in enumerate(fields, 1)
        }
        return ranged.withColumns(lists)
    schema = T.StructType([T.StructField(RANGE, T.IntegerType()), *fields])
    carried = written(ranged.sparkSession.createDataFrame(rows, schema).coalesce(1))
    return ranged.join(F.broadcast(carried), RANGE, "left")


def running_totals(df: DataFrame, order: list[str], sums: Iterable[str]) -> DataFrame:
    """Adds ``<name>_before`` for each named whole-number column: its sum over all rows before.

    ``order`` must tell rows apart. NULL counts as 0.
    """
    names = list(sums)
    ranged = by_range(df, order)
    zero = lambda c: F.coalesce(F.col(c).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    rows, so_far = [], [0] * len(names)
    for r in ranged.groupBy(RANGE).agg(*[F.sum(zero(c)).alias(c) for c in names]).orderBy(RANGE).collect():
        rows.append((r[RANGE], *so_far))
        so_far = [int(a) + int(r[c]) for a, c in zip(so_far, names, strict=True)]
    rows = [(r[0], *[_decimal(x) for x in r[1:]]) for r in rows]
    fields = [T.StructField(f"_start_{c}", T.DecimalType(38, 0)) for c in names]
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("decimal(38,0)")
    before = {f"{c}_before": F.coalesce(F.sum(zero(c)).over(inside), none) + F.col(f"_start_{c}") for c in names}
    return _carried(ranged, rows, fields).withColumns(before).drop(RANGE, *[f.name for f in fields])


def _decimal(x: int):
    from decimal import Decimal

    return Decimal(x)


def previous(df: DataFrame, order: list[str], values: Mapping[str, str]) -> DataFrame:
    """Adds each named column with the value that its source column has in the row before.

    ``order`` must tell rows apart; the first row has NULL.
    """
    ranged = by_range(df, order)
    sources = list(values.values())
    last = F.max_by(F.struct(*sources), F.struct(*order)).alias("last")
    rows, before = [], None
    for r in ranged.groupBy(RANGE).agg(last).orderBy(RANGE).collect():
        rows.append((r[RANGE], before is not None, *(before or [None] * len(sources))))
        before = tuple(r["last"])
    fields = [T.StructField("_carried", T.BooleanType())]
    fields += [T.StructField(f"_last_{i}", df.schema[c].dataType) for i, c in enumerate(sources)]
    inside = Window.partitionBy(RANGE).orderBy(*order)
    first = F.row_number().over(inside) == 1

    def before_row(i: int, source: str) -> Column:
        return F.when(first, F.col(f"_last_{i}")).otherwise(F.lag(source).over(inside))

    added = {name: before_row(i, source) for i, (name, source) in enumerate(values.items())}
    return _carried(ranged, rows, fields).withColumns(added).drop(RANGE, *[f.name for f in fields])
