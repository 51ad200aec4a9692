"""Co-group, match and union of several keyed inputs.

Co-grouping is a tagged union followed by one grouping: every input is shuffled
once, NULL keys meet (as in a group-by, unlike ``=`` in a join) and a key that is
absent on one side has no row of that side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyreport.operators.keyed import _keys, null_safe_join_condition

__all__ = ["tagged_union", "cogroup", "cogroup_values", "match", "union_all"]

TAG = "__tag"


def _value_cols(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def tagged_union(sides: Mapping[str, DataFrame], keys: str | Sequence[str]) -> DataFrame:
    """Long form of a co-group, no shuffle: ``keys..., __tag, <tag>`` where the
    column named after each tag holds that side's values as a struct (NULL on the
    other sides' rows)."""
    keys = _keys(keys)
    parts = [df.select(*keys, F.lit(tag).alias(TAG),
                       F.struct(*_value_cols(df, keys)).alias(tag))
             for tag, df in sides.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def cogroup(sides: Mapping[str, DataFrame], keys: str | Sequence[str],
            require_all: bool = False, count_col: str = "n") -> DataFrame:
    """``CoGroupByKey`` in long form: ``keys..., __tag, <tag>..., n``.

    One row per key, side and distinct value of that side, with its count; the
    column named after the side holds the values as a struct (NULL in the other
    sides' rows). Each input is scanned and shuffled once, dealt by key and value,
    so the shape doesn't depend on a group's size and a hot key meets no single task.

    ``require_all`` keeps only keys present on every side, by a semi-join with one
    row per key that is aggregated from these rows (NULL keys meet).
    """
    keys = _keys(keys)
    tags = list(sides)
    long = tagged_union(sides, keys)
    out = long.groupBy(*keys, TAG, *tags).agg(F.count(F.lit(1)).alias(count_col))
    if not require_all:
        return out
    # Both uses of ``out`` need all its columns, so its one scan and shuffle serves both.
    has = [F.max(F.when(F.col(TAG) == t, F.col(count_col))).alias(f"__has_{i}") for i, t in enumerate(tags)]
    present = out.groupBy(*keys).agg(*has)
    for i in range(len(tags)):
        present = present.where(F.col(f"__has_{i}") > 0)
    names = [f"__k{i}" for i in range(len(keys))]
    present = present.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    return out.join(present, null_safe_join_condition(out, present, keys, names), "left_semi")


def cogroup_values(sides: Mapping[str, DataFrame], keys: str | Sequence[str],
                   require_all: bool = False) -> DataFrame:
    """Co-group of inputs that hold at most one row per key (such as the outputs
    of per-key aggregates): ``keys..., <tag>_<col>...`` with NULL where a side
    has no row for the key, or only keys on every side with ``require_all``.

    One shuffle of the tagged union with a partial aggregate; NULL keys meet.
    """
    keys = _keys(keys)
    long = tagged_union(sides, keys)
    aggs, present = [], []
    for t, df in sides.items():
        for v in _value_cols(df, keys):
            aggs.append(F.first(F.col(t)[v], ignorenulls=True).alias(f"{t}_{v}"))
        present.append(F.max((F.col(TAG) == t).cast("int")).alias(f"__has_{t}"))
    out = long.groupBy(*keys).agg(*aggs, *present)
    if require_all:
        for t in sides:
            out = out.where(F.col(f"__has_{t}") == 1)
    return out.drop(*[f"__has_{t}" for t in sides])


def match(left: DataFrame, right: DataFrame, keys: str | Sequence[str], null_safe: bool = True) -> DataFrame:
    """Inner match of two inputs on their keys (a co-group filtered to keys
    present on both sides, when each side has unique keys).

    ``null_safe`` (default) lets NULL keys meet, as in a co-group; that join
    condition is not the inputs' hash partitioning, so both sides are shuffled
    once more. With ``null_safe=False`` (keys known to be non-NULL) the join
    reuses the partitioning of per-key aggregates on both sides: no extra
    shuffle. A plain join either way, so Spark picks broadcast or sort-merge by
    size and AQE splits a skewed key.
    """
    keys = _keys(keys)
    if not null_safe:
        return left.join(right, keys, "inner")
    renamed = [f"__r{i}" for i in range(len(keys))]
    r = right.select(*[F.col(k).alias(n) for k, n in zip(keys, renamed)],
                     *[c for c in right.columns if c not in keys])
    return left.join(r, null_safe_join_condition(left, r, keys, renamed)).drop(*renamed)


def union_all(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """``Flatten()``: all rows of all inputs, duplicates kept (UNION ALL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)
