"""Constraint checks. Each gives the rows that break the rule."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.joins import lookup_join


class ConstraintError(ValueError):
    """Rows break a constraint and the caller asked to stop."""


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(_any_null(columns))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys used more than once, with the number of their rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is set but has no parent."""
    known = parents.select(F.col(parent_key).alias(key)).where(F.col(key).isNotNull())
    return lookup_join(df.where(F.col(key).isNotNull()), known, [key], "left_anti")


def range_violations(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Values outside [low, high]; null is allowed."""
    return df.where(~F.col(column).between(low, high))


def split_valid(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a row-wise rule, and the others."""
    met = F.coalesce(rule, F.lit(False))
    return df.where(met), df.where(~met)


def require_none(violations: DataFrame, what: str) -> None:
    """Stop when there is any violation."""
    if not violations.isEmpty():
        raise ConstraintError(what)


def cascade_delete(facts: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Facts left after the dimension rows with the keys in ``deleted`` are removed."""
    return lookup_join(facts, deleted.select(key).where(F.col(key).isNotNull()), [key], "left_anti")


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
