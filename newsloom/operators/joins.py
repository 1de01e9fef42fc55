"""Joins of a large frame with a lookup table, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from newsloom.session import spool

# A lookup table is broadcast when its values, measured, take at most this much.
BROADCAST_BYTES = 64 << 20

# A key is hot when it holds more rows than this, or than this share of all
# rows if that is more, so there are at most 1 / HOT_SHARE hot keys however
# large the data.
HOT_ROWS = 1_000_000
HOT_SHARE = 1 / 100_000


def measured_bytes(df: DataFrame) -> int:
    """Size of all values of ``df``: one aggregate over it, one number to the driver."""
    width = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            width = width + F.octet_length(F.to_json(F.struct(field.name)))
    return df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0


def small_enough(df: DataFrame, limit: int | None = None) -> bool:
    """Whether ``df`` may be broadcast. Costs a pass over ``df``: spool what is expensive first."""
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    limit: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` with a lookup table on equally named columns, kept once.

    A right side measured as small is broadcast, so ``left`` is not shuffled.
    Beyond that the join is shuffled, with the hot keys of ``left`` split.
    ``how`` is inner, left, left_semi or left_anti.
    """
    if small_enough(right, limit):
        return equi_join(left, F.broadcast(right), on, how, null_safe)
    return salted_join(left, right, on, how, null_safe, hot=hot)


def hot_keys(df: DataFrame, on: Sequence[str], rows: int | None = None) -> DataFrame:
    """The keys with more than ``rows`` rows and the number of ``_parts`` each is cut into.

    At most 1 / HOT_SHARE keys: the limit rises with the number of all rows.
    """
    counts = df.groupBy(*on).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("total")).scalar()
    limit = F.greatest(F.lit(HOT_ROWS if rows is None else rows).cast("double"), total * F.lit(HOT_SHARE))
    hot = counts.where(F.col("_rows") > limit)
    return spool(hot.select(*on, F.ceil(F.col("_rows") / limit).cast("int").alias("_parts")), "hot-keys")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Shuffled equi-join in which every hot key of ``left`` is cut into parts of about ``rows`` rows.

    The part is a hash of the whole left row, so a task that is run again
    sends every row to the same place. Right rows of a hot key are repeated
    once per part; there are few hot keys, and all other rows stay single.
    ``hot`` gives the hot keys and their ``_parts`` where they are known already.
    """
    hot = F.broadcast(hot_keys(left, on, rows) if hot is None else hot)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    others = [F.col(c) for c in left.columns if c not in on]
    spreader = F.xxhash64(*others) if others else F.spark_partition_id()
    spread = (
        equi_join(left, hot, on, "left", null_safe=True)
        .withColumn("_salt", F.pmod(spreader, parts).cast("int"))
        .drop("_parts")
    )
    repeated = (
        equi_join(right, hot, on, "left", null_safe=True)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    return equi_join(spread, repeated, [*on, "_salt"], how, null_safe).drop("_salt")


def equi_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, null_safe: bool = False
) -> DataFrame:
    """Join on equally named columns, kept once; ``null_safe`` pairs null with null."""
    if not null_safe:
        return left.join(right, list(on), how)
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    joined = left.join(renamed, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.columns[: len(on)])
