"""Batch writers. Output is one part file per partition (the shard files);
``coalesce`` only a result known to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyreport.functions.shaping import join_fields

__all__ = ["write_lines", "write_delimited", "cast_to_schema", "append_table", "show"]


def write_lines(df: DataFrame, path: str, line: str | Column | None = None, mode: str = "overwrite",
                compression: str | None = None) -> None:
    """``WriteToText``: one text line per row (the only column, or ``line``)."""
    col = F.col(line) if isinstance(line, str) else line
    out = df if col is None else df.select(col.alias("value"))
    w = out.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = False,
                    mode: str = "overwrite", cols: Sequence[str] | None = None) -> None:
    """``WriteToText(..., file_name_suffix='.csv')`` of joined fields: a
    ``sep``-delimited file per partition, NULL written as an empty field."""
    cols = list(cols or df.columns)
    if header:
        df.select(*cols).write.mode(mode).csv(path, sep=sep, header=True, quote="\u0000")
    else:
        write_lines(df, path, join_fields(cols, sep), mode=mode)


def cast_to_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Project and cast to a declared schema (``name:TYPE, ...`` or a StructType)."""
    if isinstance(schema, str):
        fields = [f.strip().split(":") for f in schema.split(",")]
        schema = T.StructType([T.StructField(n.strip(), _type(t.strip()), True) for n, t in fields])
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _type(name: str) -> T.DataType:
    # Warehouse type names of a declared table schema, mapped to Spark types.
    return {"STRING": T.StringType(), "INTEGER": T.LongType(), "INT64": T.LongType(),
            "FLOAT": T.DoubleType(), "FLOAT64": T.DoubleType(), "NUMERIC": T.DecimalType(38, 9),
            "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "DATE": T.DateType(),
            "TIMESTAMP": T.TimestampType(), "BYTES": T.BinaryType()}[name.upper()]


def append_table(df: DataFrame, table: str, schema: T.StructType | str | None = None,
                 path: str | None = None, fmt: str = "parquet") -> None:
    """``WriteToBigQuery(WRITE_APPEND, CREATE_IF_NEEDED)``: cast to the declared
    schema and append, creating the table on first write. ``path`` makes it an
    external table in shared storage."""
    out = cast_to_schema(df, schema) if schema is not None else df
    w = out.write.mode("append").format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def show(df: DataFrame, n: int = 20) -> None:
    """``Map(print)``: print rows (a bounded preview)."""
    df.show(n, truncate=False)
