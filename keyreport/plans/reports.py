"""The report families, over delimited text inputs and message streams.

* Flight delay report: delayed flights per destination, total delay and count
  (batch), also as a warehouse row and per event-time window (stream).
* Two-fact monthly report: cases and rainfall per state and month, matched,
  as ``uf;ano;mes;chuva;dengue`` lines.

Each report is one declarative plan: a single read, column expressions, one
aggregate per side and (for two facts) one join. The reference's extra passes
(reading a file twice for sum and count, grouping all records of a state before
summing them) are folded away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyreport.functions.predicates import has_digit, positive
from keyreport.functions.shaping import (
    clamp_min, composite_key, decode_fields, encode_row, first_of_lists, flatten_struct, join_fields,
    key_by, named_record, nest, parse_number, python_round, round_half_up, unpack_key, year_month,
)
from keyreport.operators.cogroup import match
from keyreport.operators.keyed import sum_and_count_per_key, sum_per_key
from keyreport.sinks.files import cast_to_schema
from keyreport.sources.files import all_string_schema, read_fields
from keyreport.streaming.windows import windowed_aggregate

# Field layouts of the inputs.
# Flights: 12 comma-separated fields, no names in the source; ours.
FLIGHT_FIELDS = ["flight_date", "airline_id", "flight_no", "origin", "dest", "dep_time",
                 "dep_delay", "arr_time", "arr_delay", "air_time", "distance", "row_id"]
FLIGHT_SCHEMA = T.StructType(
    [T.StructField("flight_date", T.StringType())]
    + [T.StructField(n, T.IntegerType()) for n in ["airline_id", "flight_no"]]
    + [T.StructField(n, T.StringType()) for n in ["origin", "dest"]]
    + [T.StructField(n, T.IntegerType()) for n in FLIGHT_FIELDS[5:]])
# Cases: 9 '|'-separated fields, one header line.
CASES_FIELDS = ["id", "data_iniSE", "casos", "ibge_code", "cidade", "uf", "cep", "latitude", "longitude"]
# Rain: 3 ','-separated fields, one header line.
RAIN_FIELDS = ["data", "mm", "uf"]
# Sums of readings are exact decimals.
EXACT = "decimal(38,10)"
# Declared warehouse schema of the delay table.
DELAY_TABLE_SCHEMA = "airport:STRING, lista_Qtd_Atrasos:INTEGER, lista_Tempo_Atrasos:INTEGER"


# ------------------------------------------------------------------ flights

def read_flights(spark: SparkSession, path: str | Sequence[str], header: bool = False,
                 strict: bool = True) -> DataFrame:
    """Flights text, typed, with split semantics (``read_fields``): a blank or
    non-integer number fails in strict mode. ``header=True`` drops the first
    line of each file."""
    return read_fields(spark, path, FLIGHT_SCHEMA, sep=",", header=header, strict=strict)


def delayed_flights(flights: DataFrame, key: str = "dest", delay: str = "arr_delay") -> DataFrame:
    """``(key, delay)`` pairs of flights that arrived late (delay > 0)."""
    return flights.where(positive(delay)).select(F.col(key).alias("key"), F.col(delay).alias("delay"))


def flight_delay_report(flights: DataFrame, key: str = "dest", delay: str = "arr_delay") -> DataFrame:
    """Per ``key``: ``total_delay`` and ``n_delayed`` in one aggregate."""
    pairs = delayed_flights(flights, key, delay)
    return sum_and_count_per_key(pairs, "key", "delay", "total_delay", "n_delayed") \
        .withColumnRenamed("key", key)


def flight_delay_table(flights: DataFrame, key: str = "dest", delay: str = "arr_delay") -> DataFrame:
    """The warehouse row per airport: count and sum from one aggregate over one
    read, nested as ``{airport, lista: {Qtd_Atrasos: [..], Tempo_Atrasos: [..]}}``,
    flattened with ``_`` and reduced to the first element of each list, then cast
    to the declared schema."""
    return delay_rows(flight_delay_report(flights, key, delay), key)


def delay_rows(report: DataFrame, key: str) -> DataFrame:
    """Rows of a delay report (``key, total_delay, n_delayed``) as warehouse rows."""
    nested = report.select(*nest(key, [F.array("n_delayed").alias("Qtd_Atrasos"),
                                       F.array("total_delay").alias("Tempo_Atrasos")], "airport", "lista"))
    flat = first_of_lists(flatten_struct(nested), ["lista_Qtd_Atrasos", "lista_Tempo_Atrasos"], ["airport"])
    return cast_to_schema(flat, DELAY_TABLE_SCHEMA)


def flights_from_messages(messages: DataFrame) -> DataFrame:
    """Message bytes (one flights line each, maybe ending in a newline) → typed
    flights plus the message time ``ts``. Malformed UTF-8 or a non-integer field
    fails the query, as in the source."""
    fields = messages.select(decode_fields("value").alias("f"), "ts")
    named = fields.select(*named_record("f", FLIGHT_FIELDS), "ts")
    return named.select(*[F.col(f.name).cast(f.dataType) for f in FLIGHT_SCHEMA.fields], "ts")


def windowed_delay_report(messages: DataFrame, size: str, period: str | None = None,
                          lateness: str = "0 seconds", key: str = "dest") -> DataFrame:
    """Per window and ``key``: total delay and count of delayed flights, plus the
    row as UTF-8 JSON bytes in ``value`` for a topic sink. Fixed windows when
    ``period`` is None, sliding otherwise; one stateful aggregate for both
    measures."""
    pairs = flights_from_messages(messages).where(positive("arr_delay"))
    out = windowed_aggregate(pairs, "ts", [key], size,
                             {"total_delay": F.sum("arr_delay"), "n_delayed": F.count(F.lit(1))},
                             period=period, lateness=lateness)
    return out.withColumn("value", encode_row("window_start", "window_end", key, "total_delay", "n_delayed"))


# ----------------------------------------------------- two-fact monthly report

def read_cases(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Cases text, every field as text (``''`` stays ``''``), header skipped."""
    return read_fields(spark, path, all_string_schema(CASES_FIELDS), sep="|", header=True)


def read_rain(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Rain text, every field as text, header skipped."""
    return read_fields(spark, path, all_string_schema(RAIN_FIELDS), sep=",", header=True)


def cases_per_month(cases: DataFrame) -> DataFrame:
    """``uf, ano_mes, dengue``: the exact decimal sum of ``casos`` per state and
    month; a row whose ``casos`` holds no digit is skipped (a zero is kept). The
    records are keyed by state with the record kept, as in the source."""
    rows = key_by(cases, "uf").where(has_digit("record.casos")).select(
        "uf", year_month("record.data_iniSE").alias("ano_mes"),
        parse_number("record.casos", dtype=EXACT).alias("casos"))
    return sum_per_key(rows, ["uf", "ano_mes"], "casos", "dengue")


def rain_per_month(rain: DataFrame, python_rounding: bool = False) -> DataFrame:
    """``uf, ano_mes, chuva``: rainfall per state and month, negative readings
    counted as 0, summed exactly and rounded half-up to 0.1.

    ``python_rounding`` instead sums doubles and rounds as Python's ``round``
    does (half-to-even on the binary value), for bit parity with a float
    report; the double sum then depends on the order of the rows.
    """
    mm = clamp_min(parse_number("mm", dtype="double" if python_rounding else EXACT), 0)
    rows = rain.select(composite_key("uf", year_month("data")).alias("key"), mm.alias("mm"))
    s = sum_per_key(rows, "key", "mm", "chuva")
    uf, ano, mes = unpack_key("key", ["uf", "ano", "mes"])
    s = s.select(uf, F.concat_ws("-", ano, mes).alias("ano_mes"), "chuva")
    return s.withColumn("chuva", python_round("chuva", 1) if python_rounding else round_half_up("chuva", 1))


def monthly_report(cases: DataFrame, rain: DataFrame, python_rounding: bool = False) -> DataFrame:
    """Months with both rain and cases per state: ``uf, ano, mes, chuva,
    dengue`` and the ``;`` line. A key missing on either side is dropped."""
    m = match(rain_per_month(rain, python_rounding), cases_per_month(cases), ["uf", "ano_mes"])
    ano, mes = named_record(F.split("ano_mes", "-"), ["ano", "mes"])  # NULL, not an error, when short
    out = m.select("uf", ano, mes, "chuva", "dengue")
    return out.withColumn("line", join_fields(["uf", "ano", "mes", plain_number("chuva"), plain_number("dengue")], ";"))


def plain_number(col: str) -> Column:
    """A number's text without exponent, its decimal places cut to the first one or
    the last that isn't 0."""
    return F.regexp_replace(F.col(col).cast(EXACT).cast("string"), r"(\.\d+?)0+$", "$1")
