"""Record shaping as Column expressions.

Each builder returns a Column (or a DataFrame for whole-record reshapes), so it
works the same on batch and streaming frames and stays inside codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "WHITESPACE_CLASS", "SPLIT_PATTERN", "DIGIT_CLASS", "literal_regex", "split_fields", "tokens",
    "explode_tokens", "named_record", "zip_to_map", "map_names", "map_columns", "with_year_month", "year_month",
    "composite_key", "unpack_key", "key_by", "clamp_min", "round_half_up", "python_round", "join_fields",
    "nest", "flatten_struct", "first_of_lists", "decode_fields", "encode_row",
    "parse_int", "parse_number",
]

# Fixed values. Whitespace as Python's ``str.split()`` with no argument sees it:
# U+0009..U+000D, U+001C..U+001F, U+0020, U+0085, U+00A0, U+1680,
# U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# The class is written so that Java regex and RE2 read it the same way.
WHITESPACE_CLASS = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# The same set for Java's regex engine, about twice as fast there: with (?U),
# \s is Unicode White_Space, which is Python's set without U+001C..U+001F.
# (RE2, e.g. DuckDB's, reads (?U) differently, so SQL uses WHITESPACE_CLASS.)
SPLIT_PATTERN = r"(?U)[\s\x{1C}-\x{1F}]+"
# A decimal digit of any script, as Python's ``re`` ``\d`` on text.
DIGIT_CLASS = r"\p{Nd}"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def literal_regex(sep: str) -> str:
    """A regex that matches ``sep`` literally (Spark's ``split`` takes a regex)."""
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def split_fields(col: str | Column, sep: str) -> Column:
    """Split on a literal delimiter and keep every field, trailing empties too
    (``str.split(sep)``)."""
    return F.split(_c(col), literal_regex(sep), -1)


def tokens(col: str | Column) -> Column:
    """Whitespace tokens without empties (``str.split()``) as an array."""
    parts = F.split(_c(col), SPLIT_PATTERN, -1)
    return F.filter(parts, lambda t: t != F.lit(""))


def explode_tokens(df: DataFrame, col: str, out: str = "token",
                   keep: Sequence[str] = ()) -> DataFrame:
    """One row per whitespace token of ``col``: the whole text, every token.

    Explodes the split and drops the empty pieces (only possible at the ends of
    a text) afterwards, which keeps the work in codegen rather than in an array
    lambda.
    """
    pieces = df.select(*keep, F.explode(F.split(F.col(col), SPLIT_PATTERN, -1)).alias(out))
    return pieces.where(F.col(out) != "")


def named_record(arr: str | Column, names: Sequence[str], strict: bool = False) -> list[Column]:
    """Columns named ``names`` from the positions of an array (``zip``): extra
    fields are ignored.

    Tolerant (default): a short array gives NULL for the missing names. Strict:
    an array shorter than ``names`` raises, as indexing a short record does.
    """
    a = _c(arr)
    if strict:
        a = F.when(F.size(a) >= len(names), a).otherwise(
            F.raise_error(F.concat(F.lit(f"expected at least {len(names)} fields, got "),
                                   F.size(a).cast("string"))))
    return [F.get(a, i).alias(n) for i, n in enumerate(names)]


def zip_to_map(names: str | Column, values: str | Column) -> Column:
    """``dict(zip(names, values))`` of two arrays, for names that are data: the shorter one
    decides, of a repeated name the last value counts, NULL names are left out."""
    n, v = _c(names), _c(values)

    def pairs(both: Column) -> Column:
        size = F.least(F.size(both["n"]), F.size(both["v"]))
        used = F.slice(both["n"], 1, size)
        entries = F.transform(used, lambda name, i: F.struct(name.alias("k"), F.get(both["v"], i).alias("x"), i.alias("i")))
        last = lambda e: F.array_position(F.reverse(used), e["k"]) == size - e["i"]
        kept = F.filter(entries, lambda e: e["k"].isNotNull() & last(e))
        return F.map_from_arrays(kept["k"], kept["x"])

    # The lambda's variable holds both arrays, so they are computed once per row.
    return F.get(F.transform(F.array(F.struct(n.alias("n"), v.alias("v"))), pairs), 0)


def map_names(df: DataFrame, col: str, alias: str = "n") -> DataFrame:
    """The names that occur in a map column, with the number of rows that have them."""
    return df.select(F.explode(F.map_keys(col)).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias(alias))


def map_columns(df: DataFrame, col: str, names: Sequence[str] | None = None, max_names: int = 1000) -> DataFrame:
    """A map column as one column per name, beside the other columns; NULL where a row has
    no such name. Without ``names`` they are found in the data first (one aggregate), sorted;
    more than ``max_names`` are an error, as no table is that wide."""
    if names is None:
        found = map_names(df, col).select("name").orderBy("name").limit(max_names + 1).collect()
        if len(found) > max_names:
            raise ValueError(f"{col} holds more than {max_names} names")
        names = [r["name"] for r in found]
    others = [c for c in df.columns if c != col]
    return df.select(*[F.col(f"`{c}`") for c in others], *[F.try_element_at(col, F.lit(n)).alias(n) for n in names])


def year_month(date_col: str | Column) -> Column:
    """``YYYY-MM`` from a date text (first two ``-`` parts) or a date/timestamp."""
    c = _c(date_col)
    return F.substring_index(c.cast("string"), "-", 2)


def with_year_month(df: DataFrame, date_col: str, out: str = "year_month") -> DataFrame:
    """Add ``out`` = year-month of ``date_col``; input fields are kept."""
    return df.withColumn(out, year_month(date_col))


def composite_key(*cols: str | Column, sep: str = "-") -> Column:
    """A single text key from several fields (``f"{a}-{b}"``)."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def unpack_key(key: str | Column, names: Sequence[str], sep: str = "-") -> list[Column]:
    """Split a composite key back into named fields."""
    return named_record(split_fields(key, sep), names)


def clamp_min(col: str | Column, floor: float = 0) -> Column:
    """``max(x, floor)``; NULL stays NULL, NaN stays NaN (as ``x < 0`` is false
    for NaN in Python). ``greatest`` alone would turn NULL into ``floor``."""
    c = _c(col)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def round_half_up(col: str | Column, scale: int = 1) -> Column:
    """Round half away from zero, once, in the column's own type: a decimal keeps
    all its places until then, a double is rounded on its shortest decimal text."""
    return F.round(_c(col), scale)


def python_round(col: str | Column, ndigits: int = 1) -> Column:
    """Python's ``round(x, ndigits)`` on doubles, bit for bit: the exact binary
    value rounded half-to-even (``0.35`` → ``0.3``, ``0.25`` → ``0.2``), which
    neither ``round`` nor ``bround`` gives. Arrow-batched Python, the slow path:
    use ``round_half_up`` on decimals unless exact parity is asked for."""

    @F.pandas_udf(T.DoubleType())
    def _round(s: pd.Series) -> pd.Series:
        return s.map(lambda v: v if v != v else round(v, ndigits))

    x = _c(col).cast("double")
    # pandas cannot tell NaN from NULL on the way back, so NaN bypasses the UDF
    return F.when(F.isnan(x), x).otherwise(_round(x))


def join_fields(cols: Sequence[str | Column], sep: str = ";", null_as: str = "") -> Column:
    """Join fields into one text line; NULL prints as ``null_as`` (``concat_ws``
    alone would drop it and shift the fields)."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(null_as)) for c in cols])


def key_by(df: DataFrame, key: str | Sequence[str], name: str = "record") -> DataFrame:
    """Key each record by a field and keep the whole record:
    ``(key, struct(all fields))``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def nest(key: str, fields: Sequence[str | Column], key_name: str = "key", struct_name: str = "value") -> list[Column]:
    """Pair a key with a struct of fields: ``{key_name: key, struct_name: {...}}``."""
    return [F.col(key).alias(key_name), F.struct(*[_c(f) for f in fields]).alias(struct_name)]


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Flatten nested structs into top-level columns joined by ``sep``
    (``a.b.c`` → ``a_b_c``). Arrays and maps are kept as they are."""

    def walk(dtype: T.DataType, path: list[str]) -> list[Column]:
        if isinstance(dtype, T.StructType):
            out: list[Column] = []
            for f in dtype.fields:
                out += walk(f.dataType, path + [f.name])
            return out
        ref = F.col(".".join(f"`{p}`" for p in path))
        return [ref.alias(sep.join(path))]

    return df.select(*walk(df.schema, []))


def first_of_lists(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keep ``keep`` and replace each list column by its first element (NULL
    when the list is empty)."""
    return df.select(*keep, *[F.get(F.col(c), 0).alias(c) for c in cols])


def decode_fields(col: str | Column, sep: str = ",", charset: str = "UTF-8",
                  strip_newline: bool = True) -> Column:
    """Message bytes → text → fields. Malformed bytes raise (ANSI ``decode``)."""
    text = F.decode(_c(col), charset)
    if strip_newline:
        text = F.regexp_replace(text, r"[\r\n]+$", "")
    return split_fields(text, sep)


def encode_row(*cols: str | Column, charset: str = "UTF-8") -> Column:
    """A row as UTF-8 JSON bytes (the topic sink's ``value``); a NULL field is null."""
    return F.encode(F.to_json(F.struct(*[_c(c) for c in cols]), {"ignoreNullFields": "false"}), charset)


def parse_int(col: str | Column, strict: bool = True) -> Column:
    """``int(text)``: strict raises on bad text (ANSI cast), tolerant gives NULL."""
    c = _c(col)
    return c.cast("int") if strict else c.try_cast("int")


def parse_number(col: str | Column, strict: bool = True, dtype: str = "double") -> Column:
    """``float(text)``; see ``parse_int`` for strictness."""
    c = _c(col)
    return c.cast(dtype) if strict else c.try_cast(dtype)
