"""User functions as table functions, for SQL text and lateral joins.

``as_table_function`` makes a generator over the arguments of one row a table function,
``as_group_function`` an accumulator over the rows of one partition of a table:
``SELECT * FROM f(TABLE(t) PARTITION BY k ORDER BY ts)``. The first crosses into Python in Arrow
batches; the second in pickled rows, because the Arrow form makes a batch of each row's
output (0.3 ms a row). A partition's rows arrive one after another in one task and aren't kept, but they are not
dealt over tasks either: for keys that hold a large share of the rows use
``operators.groups.run_groups``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["as_table_function", "as_group_function", "register", "lateral"]


def as_table_function(fn: Callable[..., Iterable[tuple]], schema: T.StructType | str):
    """A table function from ``fn(*args)``, which yields rows (tuples) for one input row."""

    class Rows:
        def eval(self, *args):
            yield from fn(*args)

    return F.udtf(Rows, returnType=schema, useArrow=True)


def as_group_function(start: Callable[[], object], step: Callable[[object, T.Row], tuple[object, Iterable[tuple]]],
                      end: Callable[[object], Iterable[tuple]], schema: T.StructType | str):
    """A table function over the rows of a table argument, partition by partition:
    ``step(state, row)`` gives the next state and output rows, ``end(state)`` the rows
    behind the partition's last one. Their values are of the schema's Python types: an
    int for a double isn't converted."""

    class Group:
        def __init__(self):
            self.state = start()

        def eval(self, row):
            self.state, out = step(self.state, row)
            yield from out

        def terminate(self):
            yield from end(self.state)

    return F.udtf(Group, returnType=schema, useArrow=False)


def register(spark: SparkSession, name: str, table_function) -> None:
    """Make a table function callable by name from SQL in this session."""
    spark.udtf.register(name, table_function)


def lateral(df: DataFrame, table_function, *args: str | Column, keep_empty: bool = False) -> DataFrame:
    """``df`` beside the rows that the table function gives for each of its rows;
    ``keep_empty`` keeps rows without any."""
    columns = [(F.col(a) if isinstance(a, str) else a).outer() for a in args]
    if keep_empty:
        return df.lateralJoin(table_function(*columns), F.lit(True), "left")
    return df.lateralJoin(table_function(*columns))
