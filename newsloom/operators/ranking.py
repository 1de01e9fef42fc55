"""Ranks and pages over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.joins import equi_join, lookup_join
from newsloom.session import spool


#: Rows that one task may put in order.
ONE_TASK_ROWS = 1_000_000


def ranked(
    df: DataFrame,
    order_by: Sequence[tuple[str, str]],
    partition_by: Sequence[str] = (),
    alias: str = "rank",
    aggregated: bool = False,
) -> DataFrame:
    """Add RANK over ``order_by``, pairs of column and direction such as ("n", "desc").

    A direction is any sort method of a column: asc, desc, desc_nulls_first...
    The distinct values are cut into ranges, counted per range, and each value
    is placed after the ranges before its own, so a group may have any size.
    ``aggregated`` says that ``df`` has a row per name or the like. Its rows are
    counted, and while they are few enough for one task to put in order it is
    a plain window; beyond, it is cut as well.
    """
    df = spool(df, "to-rank")
    if aggregated and df.count() <= ONE_TASK_ROWS:
        window = Window.partitionBy(*partition_by).orderBy(*_sort(order_by))
        return df.withColumn(alias, F.rank().over(window).cast("long"))
    keys = [*partition_by, *[name for name, _ in order_by]]
    values = df.groupBy(*keys).agg(F.count("*").alias("_ties"))
    places = spool(
        _rows_before(values, _sort(order_by), partition_by, "_ties").select(
            *keys, (F.col("_before") + 1).alias(alias)
        ),
        "places",
    )
    return lookup_join(df, places, keys, "left", null_safe=True)


def page(
    df: DataFrame,
    order_by: Sequence[tuple[str, str]],
    number: int = 1,
    size: int = 10,
) -> DataFrame:
    """Rows of page ``number``, counted from 1, in the order of a unique key.

    Only the key's columns are cut into ranges and counted; the keys of the
    page, ``size`` rows, are then taken from the ranges it lies in, and the
    rows with these keys are read by the first column's bounds.
    """
    first = (number - 1) * size
    names = [name for name, _ in order_by]
    cut = spool(
        df.select(*names).repartitionByRange(*_sort(order_by)).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before, wanted, skipped = 0, [], 0
    for row in sorted(cut.groupBy("_range").count().collect()):  # a row for each range
        if before + row["count"] > first and before < first + size:
            skipped = before if not wanted else skipped
            wanted.append(row["_range"])
        before += row["count"]
    keys = cut.where(F.col("_range").isin(wanted)).drop("_range").orderBy(*_sort(order_by))
    keys = spool(keys.offset(first - skipped).limit(size), "page")
    low, high, nulls = keys.agg(F.min(names[0]), F.max(names[0]), F.count_if(F.col(names[0]).isNull())).first()
    inside = F.col(names[0]).between(low, high) if low is not None else F.lit(False)
    rows = df.where(inside | F.col(names[0]).isNull() if nulls else inside)
    return equi_join(rows, F.broadcast(keys), names, "left_semi", null_safe=True).orderBy(*_sort(order_by))


def _sort(order_by: Sequence[tuple[str, str]]) -> list[Column]:
    return [getattr(F.col(name), direction)() for name, direction in order_by]


def _rows_before(
    df: DataFrame, order: list[Column], partition_by: Sequence[str], weight: str
) -> DataFrame:
    """Add ``_before``: the sum of ``weight`` over all rows sorting earlier in the group.

    ``df`` is spooled after the range shuffle, so that its cuts stay as they
    are. The sums per range are one row per range and group.
    """
    ranges = [F.col(c) for c in partition_by] + order
    cut = spool(
        df.repartitionByRange(*ranges).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    group = [*partition_by, "_range"]
    earlier = Window.partitionBy(*partition_by).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        cut.groupBy(*group)
        .agg(F.sum(weight).alias("_rows"))
        .select(*group, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = cut.withColumn("_within", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return (
        lookup_join(within, spool(starts, "starts"), group, "left", null_safe=True)
        .withColumn("_before", F.col("_start") + F.col("_within"))
        .drop("_start", "_within", "_range")
    )
