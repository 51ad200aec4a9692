"""Aggregations per key, per element and overall.

All of them are declarative ``groupBy().agg()`` plans, so Spark runs a partial
(map-side) aggregate before the shuffle and a final one after it: a key that
holds a third of all rows is summed inside each input task first and then ships
one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "sum_per_key", "count_per_key", "count_per_element", "count_globally",
    "sum_and_count_per_key", "group_by_key", "null_safe_join_condition",
]


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sum_per_key(df: DataFrame, keys: str | Sequence[str], value: str | Column,
                alias: str = "total") -> DataFrame:
    """``CombinePerKey(sum)``: one row per key with the sum of ``value``."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_keys(keys)).agg(F.sum(v).alias(alias))


def count_per_key(df: DataFrame, keys: str | Sequence[str], alias: str = "n") -> DataFrame:
    """``Count.PerKey()``: rows per key."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(alias))


def count_per_element(df: DataFrame, cols: Sequence[str] | None = None, alias: str = "n") -> DataFrame:
    """``Count.PerElement()``: how often each distinct element (all of ``cols``,
    default every column) occurs."""
    return df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias(alias))


def count_globally(df: DataFrame, alias: str = "n") -> DataFrame:
    """``Count.Globally()``: one row, 0 for an empty input."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def sum_and_count_per_key(df: DataFrame, keys: str | Sequence[str], value: str | Column,
                          sum_alias: str = "total", count_alias: str = "n") -> DataFrame:
    """Sum and count of one filtered input side by side, in a single pass and a
    single shuffle (rather than two aggregates joined on the key)."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_keys(keys)).agg(F.sum(v).alias(sum_alias), F.count(F.lit(1)).alias(count_alias))


def null_safe_join_condition(left: DataFrame, right: DataFrame, keys: Sequence[str],
                             right_names: Sequence[str] | None = None) -> Column:
    """``left.k <=> right.k`` for every key, so NULL keys meet as in a group-by."""
    right_names = right_names or keys
    cond = F.lit(True)
    for k, rk in zip(keys, right_names):
        cond = cond & left[k].eqNullSafe(right[rk])
    return cond


def group_by_key(df: DataFrame, keys: str | Sequence[str], values: str | Sequence[str],
                 count_col: str = "n") -> DataFrame:
    """``GroupByKey()`` in long form: ``keys..., values..., n``, each distinct value
    of a key with how often it occurs.

    The multiset is exact and whole, one scan and one shuffle: duplicates are
    counted inside each task first, and rows are dealt by key *and* value, so a
    key with a third of all rows has the same shape as any other and meets no
    single task. A group is never one list; further per-key work is an
    aggregate over these rows.
    """
    values = [values] if isinstance(values, str) else list(values)
    return df.groupBy(*_keys(keys), *values).agg(F.count(F.lit(1)).alias(count_col))
