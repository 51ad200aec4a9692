"""User functions on DataFrames, for logic the built-in Columns cannot state.

The built-in Column form is always preferred; these wrap Python code in
Arrow-batched pandas calls so that a batch, not a row, crosses into Python.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

__all__ = ["map_values", "flat_map", "filter_rows", "par_do", "per_record", "combine_per_key", "combine_accumulators",
           "CombineFn", "DoFn", "RecordDoFn"]


def map_values(fn: Callable[..., pd.Series], return_type: T.DataType | str, **arguments) -> Callable[..., Column]:
    """``Map(fn, **arguments)`` 1 → 1 on Series batches: a scalar pandas UDF."""
    def call(s: pd.Series) -> pd.Series:
        return fn(s, **arguments)

    return F.pandas_udf(call if arguments else fn, returnType=return_type)


def flat_map(df: DataFrame, fn: Callable[..., pd.DataFrame | Iterable[pd.DataFrame]],
             schema: T.StructType | str, **arguments) -> DataFrame:
    """``FlatMap(fn, **arguments)`` 1 → 0..n: ``fn`` maps a batch of rows to a batch of
    output rows (any number), or yields such batches. See ``per_record`` for a
    function of one record."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from _frames(fn(pdf, **arguments))

    return df.mapInPandas(run, schema)


def _frames(out: pd.DataFrame | Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    return [out] if isinstance(out, pd.DataFrame) else out


# Output records gathered into one batch by the per-record forms.
RECORDS = 10_000


def per_record(fn: Callable[..., Iterable[dict]]) -> Callable[..., Iterator[pd.DataFrame]]:
    """A batch function from a generator over one record (a dict): records cross
    into Python in Arrow batches, and what is yielded leaves in batches of at most
    ``RECORDS``. A field that is missing is NULL."""

    def run(pdf: pd.DataFrame, **arguments) -> Iterator[pd.DataFrame]:
        rows: list[dict] = []
        names = list(pdf.columns)
        for values in pdf.itertuples(index=False, name=None):
            for out in fn(dict(zip(names, values)), **arguments):
                rows.append(out)
                if len(rows) >= RECORDS:
                    yield pd.DataFrame(rows)
                    rows = []
        if rows:
            yield pd.DataFrame(rows)

    return run


def filter_rows(df: DataFrame, fn: Callable[..., pd.Series], *cols: str, **arguments) -> DataFrame:
    """``Filter(fn, **arguments)``: keep rows where ``fn`` over Series of ``cols`` is
    truthy (NULL or false drops)."""
    def call(*series: pd.Series) -> pd.Series:
        return fn(*series, **arguments)

    @F.pandas_udf(T.BooleanType())
    def keep(rows: pd.DataFrame) -> pd.Series:
        return call(*(rows[c] for c in cols))

    return df.where(keep(F.struct(*[F.col(c) for c in cols])))


class DoFn:
    """``ParDo`` body over a batch: ``process(pdf)`` returns the output rows of
    that batch as a DataFrame, or an iterable of them."""

    def setup(self) -> None:  # once per task, before the first batch
        pass

    def process(self, batch: pd.DataFrame) -> pd.DataFrame | Iterable[pd.DataFrame]:
        raise NotImplementedError


class RecordDoFn(DoFn):
    """``ParDo`` body over one record: ``process(record)`` yields output records
    (dicts); batched on both sides, see ``per_record``."""

    def process(self, record: dict) -> Iterable[dict]:
        raise NotImplementedError


def par_do(df: DataFrame, do_fn: DoFn, schema: T.StructType | str) -> DataFrame:
    """``ParDo(DoFn)``: per partition, batches through ``do_fn.process``; works
    on streaming frames too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        do_fn.setup()
        process = per_record(do_fn.process) if isinstance(do_fn, RecordDoFn) else do_fn.process
        for pdf in batches:
            yield from _frames(process(pdf))

    return df.mapInPandas(run, schema)


class CombineFn:
    """A combiner with an accumulator of its own type: ``create``, ``add`` a batch of
    values, ``merge`` accumulators in any order and grouping, ``extract`` the result.

    ``state_type`` and ``result_type`` are DDL types; a struct is a dict and an array a
    list in Python. Values come as an Arrow array without NULLs."""

    state_type: str
    result_type: str

    def create(self):
        return None

    def add(self, state, values: pa.Array):
        raise NotImplementedError

    def merge(self, states: list):
        raise NotImplementedError

    def extract(self, state):
        return state


class _Plain(CombineFn):
    """One function of a Series, for values, partial results and the result alike."""

    def __init__(self, combine: Callable[[pd.Series], object], result_type: str):
        self.combine, self.state_type, self.result_type = combine, result_type, result_type

    def add(self, state, values: pa.Array):
        return self.combine(values.to_pandas())

    def merge(self, states: list):
        # Through Arrow, so that whole numbers stay such.
        return self.combine(pa.array(states).to_pandas())


# Keys a task holds before it sends their accumulators on.
HELD_KEYS = 100_000


def combine_accumulators(df: DataFrame, keys: str | Sequence[str], value: str, fn: CombineFn,
                         alias: str = "combined", merge_tasks: int = 1) -> DataFrame:
    """``CombinePerKey(fn)`` with an accumulator: ``keys..., alias``.

    One scan and one shuffle: each input task adds its values batch by batch, at most
    ``HELD_KEYS`` keys at a time, and sends an accumulator per key, never values;
    accumulators of a key are merged behind the shuffle. ``merge_tasks`` above 1 merges
    in that many tasks per key first, for large accumulators of hot keys. NULL keys are a
    key. NULL values are left out; a key with NULLs only has a NULL result.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    codes = [f"__k{i}" for i in range(len(keys))]
    types = [f"`{c}` {df.schema[k].dataType.simpleString()}" for c, k in zip(codes, keys)]
    state_schema = ", ".join([*types, f"__state {fn.state_type}"])
    arrow_type = to_arrow_type(df.sparkSession.createDataFrame([], f"x {fn.state_type}").schema["x"].dataType)

    def grouped(table: pa.Table) -> tuple[pa.Table, list[pa.Array]]:
        # Keys are numbered in Arrow, so a NULL among them changes no type.
        number = table.select(codes).append_column("__n", pa.array(np.arange(table.num_rows)))
        groups = number.group_by(codes, use_threads=False).aggregate([("__n", "list")])
        rows = groups.column("__n_list").combine_chunks()
        cut = rows.offsets.to_numpy()
        return groups.select(codes), [rows.values.slice(a, b - a) for a, b in itertools.pairwise(cut)]

    def with_states(groups: pa.Table, states: list) -> pa.Table:
        return groups.append_column("__state", pa.array(states, arrow_type, from_pandas=True))

    def added(batch: pa.RecordBatch) -> pa.Table:
        table = pa.Table.from_batches([batch])
        groups, rows = grouped(table)
        values = batch.column("__value")
        parts = [values.take(r).drop_null() for r in rows]
        return with_states(groups, [fn.add(fn.create(), v) if len(v) else None for v in parts])

    def merged(tables: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(tables)
        groups, rows = grouped(table)
        states = table.column("__state").to_pylist()
        return with_states(groups, [_merge(fn, [states[i] for i in r.to_numpy()]) for r in rows])

    def map_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows:
                parts.append(added(batch))
            if len(parts) >= 64 or sum(p.num_rows for p in parts) > HELD_KEYS:
                parts = [merged(parts)]
                if parts[0].num_rows > HELD_KEYS:
                    yield from parts.pop().to_batches()
        if parts:
            yield from merged(parts).to_batches()

    def merge_all(states: pa.Array) -> object:
        return _merge(fn, states.to_pylist())

    def final(states: pa.Array) -> object:
        state = _merge(fn, states.to_pylist())
        return None if state is None else fn.extract(state)

    for call in (merge_all, final):
        call.__annotations__ = {"states": pa.Array, "return": object}
    rows = df.select(*[F.col(k).alias(c) for k, c in zip(keys, codes)], F.col(value).alias("__value"))
    partial = rows.mapInArrow(map_side, state_schema)
    if merge_tasks > 1:
        salted = partial.withColumn("__salt", F.spark_partition_id() % merge_tasks)
        partial = salted.groupBy(*codes, "__salt").agg(F.arrow_udf(merge_all, fn.state_type)("__state").alias("__state"))
    found = partial.groupBy(*codes).agg(F.arrow_udf(final, fn.result_type)("__state").alias(alias))
    return found.select(*[F.col(c).alias(k) for c, k in zip(codes, keys)], alias)


def _merge(fn: CombineFn, states: list):
    known = [s for s in states if s is not None]
    return known[0] if len(known) == 1 else fn.merge(known) if known else None


def combine_per_key(df: DataFrame, keys: str | Sequence[str], value: str,
                    combine: Callable[[pd.Series], object], return_type: T.DataType | str,
                    alias: str = "combined") -> DataFrame:
    """``CombinePerKey(fn)`` with a Python combine function.

    ``combine`` maps a Series of values to one value and, as for any combiner,
    must be associative and commutative (``combine`` of partial results equals
    ``combine`` of all values). It is a ``CombineFn`` whose accumulator is the result: see
    ``combine_accumulators`` for the plan. NULL values are left out before Python sees
    them (so a BIGINT stays one); a key with NULLs only has a NULL result.
    """
    rtype = return_type if isinstance(return_type, str) else return_type.simpleString()
    return combine_accumulators(df, keys, value, _Plain(combine, rtype), alias)
