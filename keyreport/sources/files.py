"""Batch readers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyreport.functions.shaping import named_record, split_fields, zip_to_map
from keyreport.session import bounded_broadcast, scratch_dir

__all__ = ["create", "read_lines", "read_delimited", "read_delimited_marked", "read_delimited_with_rejects", "read_report",
           "read_table", "all_string_schema", "REJECT_COL", "read_text_lines", "read_fields", "read_records"]

REJECT_COL = "_rejected_line"


def create(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """``Create(iterable)``: a small in-memory collection with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``ReadFromText``: one row per line in column ``value``, blank lines kept.
    Large files are split across tasks."""
    return spark.read.text(path)


def all_string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _schema(spark: SparkSession, schema: T.StructType | str | Sequence[str]) -> T.StructType:
    if isinstance(schema, str):
        return spark.createDataFrame([], schema).schema
    return schema if isinstance(schema, T.StructType) else all_string_schema(schema)


def _parsed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, sep: str,
            header: bool) -> tuple[DataFrame, Column]:
    """The lines with their typed fields in one struct column, and whether a line is
    whole: the schema's number of fields, each empty or castable. Validity reads
    every field whatever columns are selected later."""
    lines = read_text_lines(spark, path, header).where("value <> ''")
    raw = lines.select("value", split_fields("value", sep).alias("f"))
    text = [F.nullif(F.get("f", i), F.lit("")) for i in range(len(schema.fields))]
    typed = [x.try_cast(f.dataType).alias(f.name) for x, f in zip(text, schema.fields)]
    whole = F.size("f") == len(schema.fields)
    for x, f in zip(text, schema.fields):
        whole = whole & (x.isNull() | x.try_cast(f.dataType).isNotNull())
    return raw.select("value", F.struct(*typed).alias("row"), whole.alias("whole")), F.col("whole")


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | Sequence[str],
                   sep: str = ",", header: bool = False, strict: bool = True) -> DataFrame:
    """Delimited text with a declared schema (never inferred).

    ``header=True`` skips the first line of *each file* (``skip_header_lines=1``).
    Quotes are not special, as with a plain ``split``. Empty fields read as NULL and
    blank lines are skipped. Strict mode fails on a malformed line (wrong number of
    fields, bad number) whatever columns are selected, ``count()`` included;
    tolerant mode turns missing and bad fields into NULL.
    """
    schema = _schema(spark, schema)
    parsed, whole = _parsed(spark, path, schema, sep, header)
    if strict:
        # A filter, so no column pruning can leave the check out.
        parsed = parsed.where(F.when(whole, True).otherwise(
            F.raise_error(F.concat(F.lit("malformed line: "), F.col("value"))).cast("boolean")))
    return parsed.select("row.*")


def read_delimited_marked(spark: SparkSession, path: str | Sequence[str],
                          schema: T.StructType | str | Sequence[str], sep: str = ",", header: bool = False) -> DataFrame:
    """Tolerant read in one pass: the declared columns of every line, and its text in
    ``_rejected_line`` if it is malformed (NULL if not)."""
    parsed, whole = _parsed(spark, path, _schema(spark, schema), sep, header)
    return parsed.select("row.*", F.when(~whole, F.col("value")).alias(REJECT_COL))


def read_delimited_with_rejects(spark: SparkSession, path: str | Sequence[str],
                                schema: T.StructType | str | Sequence[str], sep: str = ",",
                                header: bool = False) -> tuple[DataFrame, DataFrame]:
    """Tolerant read that keeps what it could not parse: ``(good, rejects)``.

    ``good`` has the declared columns; ``rejects`` has the raw text of each
    malformed line in ``_rejected_line`` next to whatever fields did parse. Both
    are filters of one parse by the same validity, so every line is in exactly one
    of them whatever columns are selected. Using both reads the text twice;
    ``read_delimited_marked`` gives both in one pass.
    """
    parsed, whole = _parsed(spark, path, _schema(spark, schema), sep, header)
    return parsed.where(whole).select("row.*"), parsed.where(~whole).select("row.*", F.col("value").alias(REJECT_COL))


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the first line of each file: a task reads the splits of files one after the
    other, so it is the first row behind a change of split, if that split starts the file."""
    before = None
    for batch in batches:
        if batch.num_rows:
            file, start = batch.column("__id").to_numpy(), batch.column("__start").to_numpy()
            new = np.concatenate([[before != (file[0], start[0])], (file[1:] != file[:-1]) | (start[1:] != start[:-1])])
            before = file[-1], start[-1]
            kept = [batch.column(c) for c in batch.schema.names if c not in ("__id", "__start")]
            names = [c for c in batch.schema.names if c not in ("__id", "__start")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(new & (start == 0))], names=[*names, "is_first"])


def _marked_lines(spark: SparkSession, path: str | Sequence[str], file: bool = False) -> DataFrame:
    """``value, is_first`` (and ``file``) of every line, by the file metadata of its split."""
    lines = spark.read.text(path)
    wanted = ["value"] + ([F.col("_metadata.file_path").alias("file")] if file else [])
    rows = lines.select(*wanted, F.xxhash64("_metadata.file_path").alias("__id"),
                        F.col("_metadata.file_block_start").alias("__start"))
    return rows.mapInArrow(_first_lines, "value string, " + ("file string, " if file else "") + "is_first boolean")


def read_text_lines(spark: SparkSession, path: str | Sequence[str], header: bool = False) -> DataFrame:
    """Lines as ``value``, verbatim, blank ones too; ``header=True`` drops the first line of
    each file, whatever it holds. Large files are split across tasks either way; with a
    header the lines pass through one Arrow step that looks at their splits."""
    if not header:
        return spark.read.text(path)
    return _marked_lines(spark, path).where(~F.col("is_first")).select("value")


def read_records(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited text whose field names are known only from the files: ``record`` (a map from
    name to text) and ``file`` per line, by the names in the first line of its own file.

    As ``dict(zip(names, fields))``: the shorter of both decides, of a repeated name the
    last field counts. Blank lines give a record of one empty field. The header lines are read in a
    scan of their own and meet the lines by a broadcast only if they are small."""
    marked = _marked_lines(spark, path, file=True)
    heads = scratch_dir(spark, "files", "headers")
    marked.where("is_first").select(F.col("file").alias("__file"), split_fields("value", sep).alias("__names")) \
        .write.parquet(heads)
    names = bounded_broadcast(spark.read.schema("__file string, __names array<string>").parquet(heads))
    lines = marked.where(~F.col("is_first")).join(names, F.col("file") == F.col("__file"))
    return lines.select(zip_to_map("__names", split_fields("value", sep)).alias("record"), "file")


def read_fields(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                sep: str = ",", header: bool = False, strict: bool = True) -> DataFrame:
    """Delimited text with the exact semantics of splitting each line on ``sep``
    and indexing the fields: empty fields stay ``''`` for text columns, extra
    fields are ignored.

    Strict: a short line or a field that does not cast (``''`` or ``'x'`` for
    a number) fails the job, as ``int(field)`` does. Tolerant: NULL instead.
    All of it is Column expressions over the split line.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    lines = read_text_lines(spark, path, header)
    named = lines.select(*named_record(split_fields("value", sep), [f.name for f in schema.fields], strict))
    return named.select(*[
        (F.col(f.name) if isinstance(f.dataType, T.StringType)
         else F.col(f.name).cast(f.dataType) if strict else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def read_report(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | Sequence[str],
                sep: str = ";") -> DataFrame:
    """Read back a report written by ``sinks.write_delimited`` (no header line)."""
    return read_delimited(spark, path, schema, sep=sep, header=False)


def read_table(spark: SparkSession, base: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A parquet table ``{base}/{name}.parquet``; naming ``columns`` up front keeps
    the scan's ReadSchema narrow (Catalyst prunes anyway when they are used)."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
