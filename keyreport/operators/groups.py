"""Python over the ordered rows of each group, as a stream of Arrow batches.

``run_groups`` passes every group through a ``GroupFn`` in the order of some columns: a
running total, a gap to the row before, a state machine. A group is never a list: rows
arrive sorted, batch by batch, and the function keeps a small state between them.

A group may hold a third of all rows. Groups of more than ``piece_rows`` rows are cut at
quantiles of the first order column into pieces for different tasks. What the earlier rows
amount to is itself a state, so a first pass over these groups only reduces each piece to
one state, states are merged along each group, and every piece starts from the state
before it. The rows that come out are the same as with one task per group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from keyreport.session import bounded_broadcast, scratch_dir

__all__ = ["GroupFn", "run_groups", "PIECE_ROWS", "PIECES"]

# Rows of a group from which it is cut, and into how many pieces.
PIECE_ROWS = 4_000_000
PIECES = 256


class GroupFn:
    """A function over the ordered rows of a group.

    ``state_type`` (a DDL type) is what earlier rows amount to; ``schema`` the DDL of the
    columns that come out. ``add`` and ``merge`` must agree: the state of rows A then B is
    ``merge(state of A, state of B)``."""

    state_type: str
    schema: str

    def create(self):
        """The state before any row."""
        return None

    def add(self, state, rows: pa.RecordBatch):
        """The state after ``rows``, which follow those of ``state``."""
        raise NotImplementedError

    def merge(self, before, after):
        """The state of the rows of ``before`` followed by those of ``after``."""
        raise NotImplementedError

    def rows(self, state, rows: pa.RecordBatch) -> pa.RecordBatch:
        """What ``rows`` give, with ``state`` of all earlier rows of the group."""
        raise NotImplementedError


_GROUP = ["__g1", "__g2"]


def _number(df: DataFrame, name: str) -> Column:
    """An order column as a number in the same order; NULL comes first, as in a sort."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        c = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif not isinstance(kind, T.NumericType):
        raise TypeError(f"the first order column must be a number, date or timestamp, not {kind.simpleString()}")
    return F.coalesce(c.cast("double"), F.lit(float("-inf")))


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The stretches of one group's piece: (group and piece, their rows)."""
    keys = np.stack([batch.column(c).to_numpy() for c in [*_GROUP, "__piece"]])
    cut = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [keys.shape[1]]])
    for a, b in itertools.pairwise(cut):
        yield tuple(keys[:, a].tolist()), batch.slice(a, b - a)


def _given(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The caller's columns."""
    row = batch.column("__row")
    return pa.RecordBatch.from_arrays(row.flatten(), names=[f.name for f in row.type])


def _reduced(fn: GroupFn, state_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(done):
            columns = [pa.array([k[i] for k, _ in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([s for _, s in done], state_type)],
                                              names=[*_GROUP, "__piece", "__state"])

        at, state = None, None
        for batch in batches:
            for key, part in _stretches(batch) if batch.num_rows else ():
                if key != at:
                    if at is not None:
                        yield sent([(at, state)])
                    at, state = key, fn.create()
                state = fn.add(state, _given(part))
        if at is not None:
            yield sent([(at, state)])

    return run


def _carried(fn: GroupFn, state_type: pa.DataType):
    """The state before each piece but the first, from the pieces' own states."""
    def run(states: pa.Table) -> pa.Table:
        states = states.sort_by("__piece")
        each, before = states.column("__state").to_pylist(), []
        for state in each[:-1]:
            before.append(state if not before else fn.merge(before[-1], state))
        return states.slice(1).select([*_GROUP, "__piece"]).append_column("__state", pa.array(before, state_type))

    return run


def _streamed(fn: GroupFn):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for key, part in _stretches(batch) if batch.num_rows else ():
                if key != at:
                    at, state = key, fn.create()
                if not part.column("__is_row")[0].as_py():
                    # A piece's state comes before its rows.
                    state, part = part.column("__state")[0].as_py(), part.slice(1)
                if part.num_rows:
                    rows = _given(part)
                    out.append(fn.rows(state, rows))
                    state = fn.add(state, rows)
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return run


def run_groups(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], fn: GroupFn,
               piece_rows: int = PIECE_ROWS, pieces: int = PIECES) -> DataFrame:
    """``fn.rows`` of every group of ``keys``, its rows sorted by ``order`` (NULLs first).

    The first order column is a number, date or timestamp; rows equal in it stay in one
    piece, so their order among themselves is that of the further columns. NULL keys are a
    group. Shuffles: one of all rows by group and piece, and for groups that are cut one
    more of their rows to get the states. Empty input gives no rows.
    """
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    state_type = to_arrow_type(spark.createDataFrame([], f"x {fn.state_type}").schema["x"].dataType)
    piece_schema = f"{', '.join(f'{g} long' for g in _GROUP)}, __piece int, __state {fn.state_type}"

    def kept(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(spark, "groups", name)
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    def dealt(frame: DataFrame, *first: str) -> DataFrame:
        sort = [*_GROUP, "__piece", *first, *[F.col(f"__row.`{o}`").asc_nulls_first() for o in order]]
        return frame.repartition(*_GROUP, "__piece").sortWithinPartitions(*sort)

    group = [F.xxhash64(F.lit(seed), *keys).alias(name) for seed, name in enumerate(_GROUP)]
    rows = df.select(*group, _number(df, order[0]).alias("__at"), F.struct("*").alias("__row"))
    counts = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("__n"))
    large = kept(counts.where(F.col("__n") > piece_rows).select(*_GROUP), "large")
    # Quantiles may differ from job to job, so they are written before rows are dealt by them.
    of_large = rows.join(bounded_broadcast(large), _GROUP, "left_semi")
    bounds = kept(of_large.groupBy(*_GROUP).agg(F.percentile_approx(
        "__at", [i / pieces for i in range(1, pieces)]).alias("__bounds")), "bounds")
    piece = F.size(F.filter("__bounds", lambda b: b < F.col("__at")))
    cut = rows.join(bounded_broadcast(bounds), _GROUP, "left").withColumn("__piece", F.coalesce(piece, F.lit(0)))
    states = dealt(cut.where("__bounds IS NOT NULL").select(*_GROUP, "__piece", "__row")).mapInArrow(
        _reduced(fn, state_type), piece_schema)
    before = kept(states.groupBy(*_GROUP).applyInArrow(_carried(fn, state_type), piece_schema), "states")
    both = cut.select(*_GROUP, "__piece", F.lit(True).alias("__is_row"), "__row").unionByName(
        before.select(*_GROUP, "__piece", F.lit(False).alias("__is_row"), "__state"), allowMissingColumns=True)
    return dealt(both, "__is_row").mapInArrow(_streamed(fn), fn.schema)
