"""Predicates as boolean Columns (NULL counts as false in ``where``)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyreport.functions.shaping import DIGIT_CLASS

__all__ = ["equals", "in_set", "in_set_join", "bloom_filter", "maybe_in", "in_large_set", "positive", "has_digit", "all_present"]


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def equals(col: str | Column, value) -> Column:
    """Field equality (``record[i] == v``)."""
    return _c(col) == F.lit(value)


def in_set(col: str | Column, values: Iterable) -> Column:
    """Exact membership in a small literal list (case and punctuation count)."""
    return _c(col).isin(list(values))


def in_set_join(df: DataFrame, col: str, values: DataFrame, values_col: str | None = None) -> DataFrame:
    """Membership against a large list held as a DataFrame: a left-semi join, so
    the planner picks broadcast or shuffle by the list's size."""
    vc = values_col or values.columns[0]
    v = values.select(F.col(vc).alias("__member")).distinct()
    return df.join(v, _c(col) == F.col("__member"), "left_semi")


# Blocks of eight 64-bit words: 8 MB of filter, one value in a hundred let through in
# error at about six million values.
BLOOM_BLOCKS = 1 << 17
_WORDS = 8


def _bloom_places(value: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a value, and its bit in each of the block's words."""
    bits = F.xxhash64(F.lit(1), value)
    return F.pmod(F.xxhash64(value), F.lit(blocks)).cast("int"), [
        F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(_WORDS)]


def bloom_filter(values: DataFrame, col: str, blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """A Bloom filter of ``col`` as a table of at most ``blocks`` rows, ``block, w0..w7``: one
    aggregate, combined in every task, whose size doesn't depend on the number of values."""
    block, bits = _bloom_places(F.col(col), blocks)
    rows = values.where(F.col(col).isNotNull()).select(block.alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
    return rows.groupBy("block").agg(*[F.bit_or(F.expr(f"shiftleft(1L, b{i})")).alias(f"w{i}") for i in range(_WORDS)])


def maybe_in(df: DataFrame, col: str | Column, bloom: DataFrame, blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """Rows of ``df`` whose ``col`` may be among the filter's values: all that are, and few
    others. The filter is broadcast, its size is bounded by ``blocks``; ``df`` isn't shuffled."""
    names = {f.name: f"__bloom_{f.name}" for f in bloom.schema.fields}
    table = bloom.select(*[F.col(a).alias(b) for a, b in names.items()])
    block, bits = _bloom_places(_c(col), blocks)
    met = df.join(F.broadcast(table), block == F.col("__bloom_block"))
    for i, bit in enumerate(bits):
        met = met.where(F.getbit(F.col(f"__bloom_w{i}"), bit) == 1)
    return met.drop(*names.values())


def in_large_set(df: DataFrame, col: str, values: DataFrame, values_col: str | None = None,
                 blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """``in_set_join`` for a long list beside a longer input: a Bloom filter of fixed size
    goes to all tasks and drops nearly all rows that aren't in the list where they are
    read; the exact semi-join then shuffles the rest only. The values' type must be
    ``col``'s. NULL is in no list."""
    vc = values_col or values.columns[0]
    if values.schema[vc].dataType != df.schema[col].dataType:
        raise TypeError(f"{vc} is {values.schema[vc].dataType.simpleString()}, {col} is {df.schema[col].dataType.simpleString()}")
    return in_set_join(maybe_in(df, col, bloom_filter(values, vc, blocks), blocks), col, values, vc)


def positive(col: str | Column) -> Column:
    """``x > 0`` (after a cast when the field is text)."""
    return _c(col) > 0


def has_digit(col: str | Column) -> Column:
    """Text holds a decimal digit of any script (``re.search(r'\\d', s)``)."""
    return _c(col).rlike(DIGIT_CLASS)


def all_present(*list_cols: str | Column) -> Column:
    """Every list is non-empty (a list ``[0.0]`` counts as present)."""
    cond = F.lit(True)
    for c in list_cols:
        cond = cond & (F.coalesce(F.size(_c(c)), F.lit(0)) > 0)
    return cond
