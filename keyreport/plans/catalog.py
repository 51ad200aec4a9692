"""The registered queries: each operator family of the library run over the
driver's parquet tables, with the equivalent DuckDB SQL beside it.

Every query reads whole tables (no id subsets, no row caps) so that its work
grows with the data. ``QUERIES[name](spark, sf_dir)`` returns a DataFrame;
``ORACLE_SQL[name]`` computes the same rows with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyreport.functions.predicates import equals, has_digit, in_set, positive
from keyreport.functions.shaping import (
    WHITESPACE_CLASS, clamp_min, decode_fields, encode_row, explode_tokens, first_of_lists,
    flatten_struct, join_fields, named_record, round_half_up, split_fields, year_month,
)
from keyreport.operators.cogroup import TAG, cogroup, cogroup_values, match, union_all
from keyreport.operators.keyed import (
    count_globally, count_per_element, count_per_key, group_by_key, sum_and_count_per_key,
    sum_per_key,
)
from keyreport.operators.limits import first_rows
from keyreport.operators.userfn import (
    DoFn, RecordDoFn, combine_per_key, filter_rows, flat_map, map_values, par_do, per_record,
)
from keyreport.plans.reports import (
    CASES_FIELDS, DELAY_TABLE_SCHEMA, FLIGHT_FIELDS, RAIN_FIELDS, delay_rows, flight_delay_report, flight_delay_table,
    read_cases, read_flights, read_rain, windowed_delay_report,
)
from keyreport.plans.reports import monthly_report as text_monthly_report
from keyreport.session import bounded_broadcast, scratch_dir
from keyreport.sinks.files import append_table, write_delimited, write_lines
from keyreport.sinks.streams import publish_table, write_messages
from keyreport.sources.files import (
    REJECT_COL, read_delimited, read_delimited_marked, read_lines, read_report, read_table,
)
from keyreport.sources.streams import consume, read_file_stream, read_messages, read_table_stream
from keyreport.streaming.windows import (
    count_of, pane_aggregate, run_to_files, sum_of, windowed_aggregate, windowed_cogroup, windowed_tagged_aggregate,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# The word list of the membership filter.
WORDS = ["the", "The", "de", "der", "que"]

# Window sizes for the events table (10,000 rows over 30 days at sf0.01).
FIXED_SIZE = "6 hours"
SLIDE_SIZE, SLIDE_PERIOD = "1 day", "12 hours"
_US = {"6 hours": 6 * 3600 * 10**6, "1 day": 86400 * 10**6, "12 hours": 12 * 3600 * 10**6}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return register


def t(spark: SparkSession, sf: str, name: str, *cols: str) -> DataFrame:
    return read_table(spark, sf, name, cols or None)


def dim(spark: SparkSession, sf: str, name: str, *cols: str) -> DataFrame:
    """A dimension table, broadcast only once its size is proven small."""
    return bounded_broadcast(t(spark, sf, name, *cols))


# ---------------------------------------------------------------- shared parts

def signed_delays(spark: SparkSession, sf: str, *order_cols: str) -> DataFrame:
    """lineitem ⋈ orders per line: ``l_returnflag, l_shipdate, o_orderdate, delay``
    (days from order to shipment, may be negative) and ``order_cols``.

    The two largest tables meet first, each shuffled once on the order key (AQE
    splits a skewed key). Nation-level reports aggregate per customer right
    after this join (``per_customer_to_nation``) and attach the customer after
    the aggregate.
    """
    li = t(spark, sf, "lineitem", "l_orderkey", "l_returnflag", "l_shipdate")
    o = t(spark, sf, "orders", "o_orderkey", "o_orderdate", *order_cols)
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select("l_returnflag", "l_shipdate", "o_orderdate", *order_cols,
                    F.datediff("l_shipdate", "o_orderdate").alias("delay")))


def per_customer_to_nation(spark: SparkSession, sf: str, per_customer: DataFrame,
                           keys: list[str], measures: list[str]) -> DataFrame:
    """Roll per-customer partial sums (``o_custkey, keys..., measures...``) up
    to ``c_nationkey, keys...``.

    The per-customer aggregate runs first, map-side combined, so a customer
    holding a third of all orders arrives here as one row per key: the customer
    join sees no skew and shuffles one narrow row per customer rather than one
    per line.
    """
    c = t(spark, sf, "customer", "c_custkey", "c_nationkey")
    j = per_customer.join(c, per_customer.o_custkey == c.c_custkey)
    return j.groupBy("c_nationkey", *keys).agg(*[F.sum(m).alias(m) for m in measures])


def delayed_per_nation(spark: SparkSession, sf: str) -> DataFrame:
    """``c_nationkey, total_delay, n_delayed`` over lines shipped after the
    order date."""
    delayed = signed_delays(spark, sf, "o_custkey").where(positive("delay"))
    per_cust = sum_and_count_per_key(delayed, "o_custkey", "delay", "total_delay", "n_delayed")
    return per_customer_to_nation(spark, sf, per_cust, [], ["total_delay", "n_delayed"])


_DELAYS_SQL = """
    SELECT c.c_nationkey, l.l_returnflag, l.l_shipdate, o.o_orderdate,
           CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS delay
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey"""


# ------------------------------------------------------ delay report (flagship)

@query("delay_report", f"""
SELECT n.n_nationkey, n.n_name, CAST(SUM(d.delay) AS BIGINT) AS total_delay, COUNT(*) AS n_delayed
FROM ({_DELAYS_SQL}) d JOIN nation n ON d.c_nationkey = n.n_nationkey
WHERE d.delay > 0
GROUP BY n.n_nationkey, n.n_name
""")
def delay_report(spark: SparkSession, sf: str) -> DataFrame:
    """Delayed lines per customer nation: total delay days and count.

    Aggregated on the nation key before the nation names are attached, so the
    name join touches one row per nation.
    """
    per = delayed_per_nation(spark, sf)
    n = dim(spark, sf, "nation", "n_nationkey", "n_name")
    return per.join(n, per.c_nationkey == n.n_nationkey).select(
        "n_nationkey", "n_name", F.col("total_delay").cast("bigint"), "n_delayed")


@query("sum_per_key", """
SELECT l.l_returnflag, CAST(SUM(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) AS BIGINT) AS total_delay
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) > 0
GROUP BY l.l_returnflag
""")
def q_sum_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """G1: sum of positive delays per return flag."""
    delayed = signed_delays(spark, sf).where(positive("delay"))
    return sum_per_key(delayed, "l_returnflag", "delay", "total_delay").select(
        "l_returnflag", F.col("total_delay").cast("bigint"))


@query("count_per_key", """
SELECT l.l_returnflag, COUNT(*) AS n_delayed
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) > 0
GROUP BY l.l_returnflag
""")
def q_count_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """Delayed lines per return flag."""
    delayed = signed_delays(spark, sf).where(positive("delay"))
    return count_per_key(delayed, "l_returnflag", "n_delayed")


@query("count_per_element", """
SELECT event_type, user_id, COUNT(*) AS n FROM events GROUP BY event_type, user_id
""")
def q_count_per_element(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrences of each distinct (event_type, user_id)."""
    return count_per_element(t(spark, sf, "events", "event_type", "user_id"))


@query("count_globally", """
SELECT COUNT(*) AS n FROM events WHERE value > 10
""")
def q_count_globally(spark: SparkSession, sf: str) -> DataFrame:
    """One count over the filtered input."""
    return count_globally(t(spark, sf, "events", "value").where(F.col("value") > 10))


@query("group_values", """
SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, COUNT(*) AS n
FROM orders GROUP BY ALL
""")
def q_group_values(spark: SparkSession, sf: str) -> DataFrame:
    """The orders' (status, date) values per customer, as an exact multiset."""
    o = t(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderdate")
    return group_by_key(o.withColumn("o_orderdate", F.to_date("o_orderdate")), "o_custkey",
                        ["o_orderstatus", "o_orderdate"])


_COGROUP_SQL = """
SELECT nationkey, tag, segment, balance, COUNT(*) AS n FROM (
  SELECT c_nationkey * 2 AS nationkey, 'customers' AS tag, c_mktsegment AS segment,
         CAST(floor(c_acctbal / 100) AS BIGINT) AS balance FROM customer
  UNION ALL
  SELECT s_nationkey * 3, 'suppliers', '', CAST(floor(s_acctbal / 100) AS BIGINT) FROM supplier)
"""


def _cogrouped(spark: SparkSession, sf: str, require_all: bool) -> DataFrame:
    c = t(spark, sf, "customer", "c_nationkey", "c_mktsegment", "c_acctbal").select(
        (F.col("c_nationkey") * 2).alias("nationkey"), F.col("c_mktsegment").alias("segment"),
        F.floor(F.col("c_acctbal") / 100).alias("balance"))
    s = t(spark, sf, "supplier", "s_nationkey", "s_acctbal").select(
        (F.col("s_nationkey") * 3).alias("nationkey"), F.floor(F.col("s_acctbal") / 100).alias("balance"))
    g = cogroup({"customers": c, "suppliers": s}, "nationkey", require_all=require_all)
    return g.select("nationkey", F.col(TAG).alias("tag"), F.coalesce("customers.segment", F.lit("")).alias("segment"),
                    F.coalesce("customers.balance", "suppliers.balance").alias("balance"), "n")


@query("cogroup_full", _COGROUP_SQL + "GROUP BY ALL")
def q_cogroup_full(spark: SparkSession, sf: str) -> DataFrame:
    """All customers and all suppliers per key, keys from either side. The keys
    are multiples of the nation numbers, so that some lack one side."""
    return _cogrouped(spark, sf, False)


@query("cogroup_present", _COGROUP_SQL + """
WHERE nationkey IN (SELECT c_nationkey * 2 FROM customer) AND nationkey IN (SELECT s_nationkey * 3 FROM supplier)
GROUP BY ALL
""")
def q_cogroup_present(spark: SparkSession, sf: str) -> DataFrame:
    """J1 + F6: the same, keys with both sides only."""
    return _cogrouped(spark, sf, True)


# ------------------------------------------------- two-fact monthly report

def _months_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    """``o_custkey, ym, v, late``: order value by order month and late days by ship
    month, per customer. Both measures are rows of one tagged union with one
    aggregate, combined map-side, so no raw order or line is dealt by customer."""
    o = t(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    placed = o.select("o_custkey", year_month(F.to_date("o_orderdate")).alias("ym"),
                      F.col("o_totalprice").cast(T.DecimalType(18, 2)).alias("v"), F.lit(None).cast("int").alias("late"))
    late = signed_delays(spark, sf, "o_custkey").select(
        "o_custkey", year_month(F.to_date("l_shipdate")).alias("ym"), F.lit(None).cast(T.DecimalType(18, 2)).alias("v"),
        clamp_min("delay", 0).alias("late"))
    return union_all(placed, late).groupBy("o_custkey", "ym").agg(F.sum("v").alias("v"), F.sum("late").alias("late"))


_MONTHS_SQL = """
WITH oc AS (SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, n.n_name
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
            JOIN nation n ON c.c_nationkey = n.n_nationkey),
placed AS (SELECT n_name, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
                  SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM oc GROUP BY ALL),
late AS (SELECT oc.n_name, strftime(l.l_shipdate, '%Y') AS year, strftime(l.l_shipdate, '%m') AS month,
                SUM(GREATEST(CAST(l.l_shipdate AS DATE) - CAST(oc.o_orderdate AS DATE), 0)) AS d
         FROM lineitem l JOIN oc ON l.l_orderkey = oc.o_orderkey GROUP BY ALL)
SELECT p.n_name, p.year, p.month, CAST(l.d AS BIGINT) AS late_days,
       CAST(ROUND(p.v, 1) AS DOUBLE) AS order_value,
       p.n_name || ';' || p.year || ';' || p.month || ';' || CAST(CAST(l.d AS BIGINT) AS VARCHAR)
         || ';' || CAST(ROUND(p.v, 1) AS VARCHAR) AS line
FROM placed p JOIN late l ON p.n_name = l.n_name AND p.year = l.year AND p.month = l.month
"""


def monthly_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per nation and month: late-shipment days (clamped at 0) matched with the
    order value (rounded to 0.1), as columns and as a ``;`` line (P4 P8 P9 P10
    P11 J2 F6)."""
    n = dim(spark, sf, "nation", "n_nationkey", "n_name")
    per = per_customer_to_nation(spark, sf, _months_per_customer(spark, sf), ["ym"], ["v", "late"])
    # A month lacks a side where no row of that side was summed.
    both = per.join(n, per.c_nationkey == n.n_nationkey).groupBy("n_name", "ym").agg(
        F.sum("v").alias("order_value"), F.sum("late").alias("late_days"))
    m = both.where(F.col("order_value").isNotNull() & F.col("late_days").isNotNull())
    value = round_half_up("order_value", 1)
    year, month = (F.get(F.split("ym", "-"), i) for i in (0, 1))
    return m.select(
        "n_name", year.alias("year"), month.alias("month"),
        F.col("late_days").cast("bigint").alias("late_days"), value.cast("double").alias("order_value"),
        join_fields([F.col("n_name"), year, month, F.col("late_days").cast("bigint"), value], ";").alias("line"))


query("match_months", _MONTHS_SQL)(monthly_report)


# ------------------------------------------------------------------- unions

@query("stack_union", """
SELECT 'customer' AS source, c_name AS name FROM customer
UNION ALL SELECT 'supplier' AS source, s_name AS name FROM supplier
UNION ALL SELECT 'nation' AS source, n_name AS name FROM nation
""")
def q_stack_union(spark: SparkSession, sf: str) -> DataFrame:
    """Names of three tables stacked, duplicates kept."""
    parts = [t(spark, sf, tb, col).select(F.lit(tb).alias("source"), F.col(col).alias("name"))
             for tb, col in [("customer", "c_name"), ("supplier", "s_name"), ("nation", "n_name")]]
    return union_all(*parts)


# -------------------------------------------------------------- text tokens

_TOKENS_SQL = f"""
SELECT token, COUNT(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '{WHITESPACE_CLASS}+')) AS token FROM documents)
WHERE token <> '' GROUP BY token
"""


@query("tokens", _TOKENS_SQL)
def q_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """P2 + G3: every whitespace token of every whole document, counted."""
    docs = t(spark, sf, "documents", "text")
    return count_per_element(explode_tokens(docs, "text"), ["token"])


@query("token_in_set", f"""
SELECT token, COUNT(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '{WHITESPACE_CLASS}+')) AS token FROM documents)
WHERE token IN ({", ".join("'" + w + "'" for w in WORDS)}) GROUP BY token
""")
def q_token_in_set(spark: SparkSession, sf: str) -> DataFrame:
    """P2 + F2: tokens that are exactly one of a few words, counted per word."""
    toks = explode_tokens(t(spark, sf, "documents", "text"), "text")
    return count_per_element(toks.where(in_set("token", WORDS)), ["token"])


@query("has_digit", r"""
SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '\p{Nd}')
""")
def q_has_digit(spark: SparkSession, sf: str) -> DataFrame:
    """documents whose text holds a digit."""
    docs = t(spark, sf, "documents", "doc_id", "lang", "text")
    return docs.where(has_digit("text")).select("doc_id", "lang")


@query("equals_field", """
SELECT event_id, user_id, value FROM events WHERE event_type = 'error'
""")
def q_equals_field(spark: SparkSession, sf: str) -> DataFrame:
    """rows whose field equals a literal (pushed into the parquet scan)."""
    return t(spark, sf, "events", "event_id", "user_id", "value", "event_type") \
        .where(equals("event_type", "error")).select("event_id", "user_id", "value")


# ---------------------------------------------------------- record shaping

@query("split_fields", """
SELECT line, CAST(string_split(line, '|')[1] AS BIGINT) AS o_orderkey, string_split(line, '|')[2] AS o_orderstatus,
       CAST(string_split(line, '|')[3] AS BIGINT) AS o_custkey, len(string_split(line, '|')) AS n_fields
FROM (SELECT concat_ws('|', o_orderkey, o_orderstatus, o_custkey) AS line FROM orders)
""")
def q_split_fields(spark: SparkSession, sf: str) -> DataFrame:
    """P11 → P1 → P3: fields joined into a line, split back, named."""
    lines = t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_custkey").select(
        join_fields(["o_orderkey", "o_orderstatus", "o_custkey"], "|").alias("line"))
    parts = lines.select("line", split_fields("line", "|").alias("f"))
    named = parts.select("line", *named_record("f", ["k", "o_orderstatus", "c"]),
                         F.size("f").cast("bigint").alias("n_fields"))
    return named.select("line", F.col("k").cast("bigint").alias("o_orderkey"), "o_orderstatus",
                        F.col("c").cast("bigint").alias("o_custkey"), "n_fields")


@query("year_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS year_month, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders GROUP BY 1
""")
def q_year_month(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per year-month."""
    o = t(spark, sf, "orders", "o_orderdate", "o_totalprice").select(
        year_month(F.to_date("o_orderdate")).alias("year_month"),
        F.col("o_totalprice").cast(T.DecimalType(18, 2)).alias("p"))
    return o.groupBy("year_month").agg(F.count(F.lit(1)).alias("n_orders"),
                                       F.sum("p").cast("double").alias("total_price"))


@query("clamp_negative", """
SELECT c_nationkey, CAST(ROUND(SUM(GREATEST(CAST(c_acctbal AS DECIMAL(18,2)), 0)), 1) AS DOUBLE) AS balance
FROM customer GROUP BY c_nationkey
""")
def q_clamp_negative(spark: SparkSession, sf: str) -> DataFrame:
    """P8 + P9: balances clamped at 0, summed per nation, rounded to 0.1."""
    c = t(spark, sf, "customer", "c_nationkey", "c_acctbal").select(
        "c_nationkey", clamp_min(F.col("c_acctbal").cast(T.DecimalType(18, 2)), 0).alias("b"))
    s = sum_per_key(c, "c_nationkey", "b", "balance")
    return s.select("c_nationkey", round_half_up("balance", 1).cast("double").alias("balance"))


@query("flatten_nested", """
SELECT c_custkey AS key, c_name AS customer_name, n_nationkey AS customer_nation_key, n_name AS customer_nation_name
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q_flatten_nested(spark: SparkSession, sf: str) -> DataFrame:
    """P12 + P13: a nested record built, then flattened by a schema walk."""
    c = t(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    n = dim(spark, sf, "nation", "n_nationkey", "n_name")
    nested = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("key"),
        F.struct(F.col("c_name").alias("name"),
                 F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")).alias("nation"))
        .alias("customer"))
    return flatten_struct(nested)


_DELAY_TABLE_SQL = f"""
SELECT n.n_name AS airport, COUNT(*) AS lista_Qtd_Atrasos, CAST(SUM(d.delay) AS BIGINT) AS lista_Tempo_Atrasos
FROM ({_DELAYS_SQL}) d JOIN nation n ON d.c_nationkey = n.n_nationkey
WHERE d.delay > 0 GROUP BY n.n_name
"""


def delay_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The warehouse report before its write: one sum-and-count aggregate, nested,
    flattened and reduced to the first element of each list."""
    per = delayed_per_nation(spark, sf)
    n = dim(spark, sf, "nation", "n_nationkey", "n_name")
    rows = per.join(n, per.c_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("airport"), "total_delay", "n_delayed")
    both = rows.groupBy("airport").agg(F.sum("total_delay").alias("total_delay"), F.sum("n_delayed").alias("n_delayed"))
    return delay_rows(both, "airport")


@query("delay_table", _DELAY_TABLE_SQL)
def q_delay_table(spark: SparkSession, sf: str) -> DataFrame:
    """The warehouse report appended to a table with the declared schema and read
    back (P12 P13 P14 K3)."""
    flat = delay_table_rows(spark, sf)
    path = scratch_dir(spark, "tables", "delay_table")
    table = "delay_table_" + path.rsplit("/", 1)[-1]
    append_table(flat, table, DELAY_TABLE_SCHEMA, path)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    return spark.read.parquet(path)


@query("bytes_roundtrip", """
SELECT CAST(string_split(msg, ',')[1] AS BIGINT) AS o_orderkey, string_split(msg, ',')[2] AS o_orderstatus,
       octet_length(encode(msg)) AS msg_bytes, octet_length(encode(js)) AS json_bytes
FROM (SELECT concat_ws(',', o_orderkey, o_orderstatus) AS msg,
             CAST(to_json({'o_orderkey': o_orderkey, 'known': CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END})
                  AS VARCHAR) AS js FROM orders)
""")
def q_bytes_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """P15 + P16: rows to UTF-8 message bytes and back to fields; a NULL field stays
    in the message."""
    o = t(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    known = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("known")
    msgs = o.select(F.encode(join_fields(["o_orderkey", "o_orderstatus"], ","), "UTF-8").alias("value"),
                    encode_row("o_orderkey", known).alias("json"))
    f = msgs.select(decode_fields("value").alias("f"), F.octet_length("value").cast("bigint").alias("msg_bytes"),
                    F.octet_length("json").cast("bigint").alias("json_bytes"))
    return f.select(F.col("f")[0].cast("bigint").alias("o_orderkey"), F.col("f")[1].alias("o_orderstatus"),
                    "msg_bytes", "json_bytes")


@query("first_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 5
""")
def q_first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """L1: the first five orders by key (a top-n, not a full sort)."""
    o = t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return first_rows(o, ["o_orderkey"], 5)


# ------------------------------------------------------------------ windows

def _bucket_sql(size: str) -> str:
    return f"(epoch_us(ts) // {_US[size]}) * {_US[size]}"


_FIXED_SQL = f"""
SELECT make_timestamp(s) AS window_start, make_timestamp(s + {_US[FIXED_SIZE]}) AS window_end,
       event_type, COUNT(*) AS n
FROM (SELECT {_bucket_sql(FIXED_SIZE)} AS s, event_type FROM events) GROUP BY ALL
"""

def _sliding_starts_sql(cols: str, where: str = "") -> str:
    """Rows of ``events`` once per sliding window holding them: one UNION ALL
    branch per offset ``k`` in ``0 .. size/period - 1`` (start = bucket - k·period)."""
    n = _US[SLIDE_SIZE] // _US[SLIDE_PERIOD]
    return "\n      UNION ALL ".join(
        f"SELECT {_bucket_sql(SLIDE_PERIOD)} - {k * _US[SLIDE_PERIOD]} AS s, {cols} FROM events {where}"
        for k in range(n))


_SLIDING_SQL = f"""
SELECT make_timestamp(s) AS window_start, make_timestamp(s + {_US[SLIDE_SIZE]}) AS window_end,
       event_type, CAST(SUM(v) AS DOUBLE) AS total, COUNT(*) AS n
FROM ({_sliding_starts_sql("event_type, CAST(value AS DECIMAL(18,2)) AS v")})
GROUP BY ALL
"""

# How far out of order events may arrive; windows close that much behind the latest.
LATENESS = "1 day"
_LATEST = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events)"
_CLOSED = f"WHERE window_end <= {_LATEST}"


def _fixed_counts(df: DataFrame, lateness: str | None) -> DataFrame:
    return windowed_aggregate(df, "ts", ["event_type"], FIXED_SIZE, {"n": F.count(F.lit(1))},
                              lateness=lateness)


def _sliding_sums(df: DataFrame, lateness: str | None) -> DataFrame:
    """Two windows hold each row: on a stream that costs less than a second stateful step."""
    out = windowed_aggregate(
        df.withColumn("v", F.col("value").cast(T.DecimalType(18, 2))), "ts", ["event_type"],
        SLIDE_SIZE, {"total": F.sum("v"), "n": F.count(F.lit(1))}, period=SLIDE_PERIOD, lateness=lateness)
    return out.withColumn("total", F.col("total").cast("double"))


@query("fixed_window", _FIXED_SQL)
def q_fixed_window(spark: SparkSession, sf: str) -> DataFrame:
    """W1 + W4: events per type in fixed 6-hour windows (batch)."""
    return _fixed_counts(t(spark, sf, "events", "ts", "event_type"), None)


@query("sliding_window", _SLIDING_SQL)
def q_sliding_window(spark: SparkSession, sf: str) -> DataFrame:
    """W2 + W3 + W4: value sum and count per type in 1-day windows every 12 h, over panes."""
    ev = t(spark, sf, "events", "ts", "event_type", "value").withColumn("v", F.col("value").cast(T.DecimalType(18, 2)))
    out = pane_aggregate(ev, "ts", ["event_type"], SLIDE_SIZE, SLIDE_PERIOD, {"total": sum_of("v"), "n": count_of()}, None)
    return out.withColumn("total", F.col("total").cast("double"))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table read as a file stream (each file once, batches by bytes)."""
    schema = t(spark, sf, "events").schema
    return read_table_stream(spark, sf, "events", schema)


@query("stream_fixed", f"SELECT * FROM ({_FIXED_SQL}) {_CLOSED}")
def q_stream_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed-window counts as a streaming query with a
    watermark; append mode emits each window once it is closed."""
    return run_to_files(spark, _fixed_counts(event_stream(spark, sf), LATENESS), "stream_fixed")


@query("stream_sliding", f"SELECT * FROM ({_SLIDING_SQL}) {_CLOSED}")
def q_stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """The sliding-window sums as a streaming query."""
    return run_to_files(spark, _sliding_sums(event_stream(spark, sf), LATENESS), "stream_sliding")


_STREAM_COGROUP_SQL = f"""
SELECT * FROM (
  SELECT make_timestamp(s) AS window_start, make_timestamp(s + {_US[SLIDE_SIZE]}) AS window_end, user_id,
         CAST(SUM(CASE WHEN event_type = 'purchase' THEN v END) AS DOUBLE) AS purchase_total,
         COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchase_n,
         CAST(SUM(CASE WHEN event_type = 'view' THEN v END) AS DOUBLE) AS view_total,
         COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS view_n
  FROM ({_sliding_starts_sql("user_id, event_type, CAST(value AS DECIMAL(18,2)) AS v",
                              "WHERE event_type IN ('purchase', 'view')")})
  GROUP BY ALL) {_CLOSED}
"""


def _totals_as_double(out: DataFrame) -> DataFrame:
    return out.withColumn("purchase_total", F.col("purchase_total").cast("double")) \
              .withColumn("view_total", F.col("view_total").cast("double"))


@query("stream_cogroup", _STREAM_COGROUP_SQL)
def q_stream_cogroup(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + W8: purchases and views of one event stream co-grouped per sliding
    window and user: one scan of the stream, one stateful aggregate."""
    ev = event_stream(spark, sf).withColumn("value", F.col("value").cast(T.DecimalType(18, 2)))
    out = windowed_tagged_aggregate(ev, "ts", ["user_id"], "event_type", ["purchase", "view"], "value",
                                    SLIDE_SIZE, SLIDE_PERIOD, LATENESS)
    return run_to_files(spark, _totals_as_double(out), "stream_cogroup")


@query("stream_two_inputs", _STREAM_COGROUP_SQL)
def q_stream_two_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """J3 on two stream inputs: purchases and views, each a stream of its own, meet
    in one stateful aggregate per sliding window and user."""
    sides = {kind: event_stream(spark, sf).where(F.col("event_type") == kind)
             .withColumn("value", F.col("value").cast(T.DecimalType(18, 2))) for kind in ("purchase", "view")}
    out = windowed_cogroup(sides, "ts", ["user_id"], "value", SLIDE_SIZE, SLIDE_PERIOD, LATENESS)
    return run_to_files(spark, _totals_as_double(out), "stream_two_inputs")


@query("stream_late_rows", f"""
WITH mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY AS seen FROM events WHERE event_id % 10 <> 0)
SELECT window_start, window_end, event_type, COUNT(*) AS n FROM (
  SELECT make_timestamp(s) AS window_start, make_timestamp(s + {_US[FIXED_SIZE]}) AS window_end, event_type, event_id
  FROM (SELECT {_bucket_sql(FIXED_SIZE)} AS s, event_type, event_id FROM events))
WHERE (event_id % 10 <> 0 OR window_end > (SELECT seen FROM mark)) AND window_end <= {_LATEST}
GROUP BY ALL
""")
def q_stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """W6 with late rows: a tenth of all events arrives after the others. Rows whose
    window had closed by then are dropped, the others are counted. The second run
    resumes from the first one's checkpoint."""
    base = scratch_dir(spark, "streams", "late")
    events = t(spark, sf, "events", "event_id", "event_type", "ts")
    late = F.col("event_id") % 10 == 0
    out = None
    for wave in (events.where(~late), events.where(late)):
        wave.write.mode("append").parquet(f"{base}/in")
        stream = read_file_stream(spark, f"{base}/in", events.schema)
        out = run_to_files(spark, _fixed_counts(stream, LATENESS), "stream_late_rows", base=base)
    return out


@query("stream_foreach_batch", """
SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type
""")
def q_stream_foreach_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A per-batch consumer. Each micro-batch is counted and written
    under its batch id (overwrite, so a replayed batch is not counted twice);
    the offsets are committed after the handler returns."""
    base = scratch_dir(spark, "streams", "foreach_batch")

    def handle(batch: DataFrame, batch_id: int) -> None:
        count_per_key(batch, "event_type").write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    stream = read_table_stream(spark, sf, "events", t(spark, sf, "events").schema)
    q = consume(stream, handle, f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    parts = spark.read.schema("event_type string, n bigint, batch_id int").parquet(f"{base}/out")
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"))


@query("message_roundtrip", f"SELECT * FROM ({_FIXED_SQL}) {_CLOSED}")
def q_message_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K5 → S5 → P15 → W1 W4 → P16 → K4: every event published as a UTF-8
    message with its event time, read back as a message stream, decoded,
    counted per fixed window, written to the message sink as JSON bytes, and
    those messages decoded again."""
    base = scratch_dir(spark, "streams", "messages")
    events = t(spark, sf, "events", "event_id", "user_id", "event_type", "value", "ts")
    publish_table(events.select(F.encode(join_fields(["event_id", "user_id", "event_type"], ","), "UTF-8")
                                .alias("value"), F.col("ts").alias("timestamp")),
                  fmt="parquet", path=f"{base}/topic")
    msgs = read_messages(spark, "parquet", "value binary, timestamp timestamp_ntz", path=f"{base}/topic")
    fields = msgs.select(decode_fields("value").alias("f"), "ts")
    rows = fields.select(F.get("f", 2).alias("event_type"), "ts")
    counts = windowed_aggregate(rows, "ts", ["event_type"], FIXED_SIZE, {"n": F.count(F.lit(1))}, lateness=LATENESS)
    out = counts.select(encode_row("window_start", "window_end", "event_type", "n").alias("value"))
    q = write_messages(out, f"{base}/checkpoint", fmt="parquet", available_now=True, path=f"{base}/out")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, event_type string, n bigint"
    decoded = spark.read.schema("value binary").parquet(f"{base}/out").select(
        F.from_json(F.decode("value", "UTF-8"), schema).alias("m"))
    return decoded.select("m.*")


# ----------------------------------------------------------- user functions

class KeepAbove(DoFn):
    """A batch filter: rows whose ``value`` exceeds ``limit``."""

    def __init__(self, limit: float):
        self.limit = limit

    def process(self, batch: pd.DataFrame) -> pd.DataFrame:
        return batch[batch["value"] > self.limit][["event_id", "event_type", "value"]]


@query("process_rows", """
SELECT event_type, COUNT(*) AS n FROM events WHERE value > 10 GROUP BY event_type
""")
def q_process_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A ParDo filter over Arrow batches, then a count per key."""
    ev = t(spark, sf, "events", "event_id", "event_type", "value")
    kept = par_do(ev, KeepAbove(10.0), "event_id long, event_type string, value double")
    return count_per_key(kept, "event_type")


@query("map_values", """
SELECT event_type, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM events GROUP BY event_type
""")
def q_map_values(spark: SparkSession, sf: str) -> DataFrame:
    """A vectorized Python map (value → cents), then a built-in sum."""
    cents = map_values(lambda s: np.round(s * 100).astype("int64"), T.LongType())
    ev = t(spark, sf, "events", "event_type", "value")
    return ev.groupBy("event_type").agg(F.sum(cents(F.col("value"))).alias("total_cents"))


def _lines_of(pdf: pd.DataFrame) -> pd.DataFrame:
    lines = pdf.assign(line=pdf["text"].str.split("\n", regex=False)).explode("line")
    return lines[["doc_id", "line"]]


@query("flat_map", """
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE line = '') AS n_blank
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id
""")
def q_flat_map(spark: SparkSession, sf: str) -> DataFrame:
    """One output row per line of each whole document (a Python flat map
    over Arrow batches), counted per document."""
    docs = t(spark, sf, "documents", "doc_id", "text")
    lines = flat_map(docs, _lines_of, "doc_id long, line string")
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.count(F.when(F.col("line") == "", 1)).alias("n_blank"))


@query("filter_rows", """
SELECT event_id, event_type, value FROM events WHERE value > 100
""")
def q_filter_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A vectorized Python predicate."""
    ev = t(spark, sf, "events", "event_id", "event_type", "value")
    return filter_rows(ev, lambda v: v > 100, "value")


@query("combine_custom", """
SELECT event_type, max(value) AS max_value FROM events GROUP BY event_type
""")
def q_combine_custom(spark: SparkSession, sf: str) -> DataFrame:
    """A Python combine function per key, combined map-side first."""
    ev = t(spark, sf, "events", "event_type", "value")
    return combine_per_key(ev, "event_type", "value", lambda s: float(s.max()), T.DoubleType(), "max_value")


@query("combine_bigint", """
SELECT event_type, max(CASE WHEN event_id % 2 = 0 THEN event_id + 9007199254740993 END) AS largest
FROM events GROUP BY event_type
""")
def q_combine_bigint(spark: SparkSession, sf: str) -> DataFrame:
    """X5 over a BIGINT with NULLs, beyond what a double holds."""
    ev = t(spark, sf, "events", "event_type", "event_id").select(
        "event_type", F.when(F.col("event_id") % 2 == 0, F.col("event_id") + 9007199254740993).alias("v"))
    return combine_per_key(ev, "event_type", "v", lambda s: int(s.max()), T.LongType(), "largest")


def _pieces(row: dict, sep: str, least: int):
    for word in row["text"].split(sep):
        if len(word) >= least:
            yield {"doc_id": row["doc_id"], "word": word}


@query("flat_map_records", """
SELECT doc_id, word, COUNT(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
WHERE length(word) >= 18 GROUP BY ALL
""")
def q_flat_map_records(spark: SparkSession, sf: str) -> DataFrame:
    """X2 with a generator over single records and keyword arguments."""
    docs = t(spark, sf, "documents", "doc_id", "text")
    found = flat_map(docs, per_record(_pieces), "doc_id long, word string", sep=" ", least=18)
    return count_per_element(found)


class AboveByType(RecordDoFn):
    """A per-record body: keeps records of a type above a limit."""

    def process(self, record: dict):
        if record["value"] is not None and record["value"] > 50 and record["event_type"] == "click":
            yield {"event_id": record["event_id"], "value": record["value"]}


@query("process_records", """
SELECT event_id, value FROM events WHERE value > 50 AND event_type = 'click'
""")
def q_process_records(spark: SparkSession, sf: str) -> DataFrame:
    """X4 with ``process(record)``."""
    ev = t(spark, sf, "events", "event_id", "event_type", "value")
    return par_do(ev, AboveByType(), "event_id long, value double")


@query("round_places", """
SELECT event_type, CAST(ROUND(SUM(CAST(CAST(value AS DECIMAL(18,2)) * CAST('0.00390625' AS DECIMAL(9,8)) AS DECIMAL(38,10))), 1)
       AS DOUBLE) AS total FROM events GROUP BY event_type
""")
def q_round_places(spark: SparkSession, sf: str) -> DataFrame:
    """Sums with ten decimal places, rounded once to 0.1."""
    ev = t(spark, sf, "events", "event_type", "value").select("event_type", (
        F.col("value").cast(T.DecimalType(18, 2)) * F.lit("0.00390625").cast(T.DecimalType(9, 8)))
        .cast(T.DecimalType(38, 10)).alias("v"))
    s = sum_per_key(ev, "event_type", "v", "total")
    return s.select("event_type", round_half_up("total", 1).cast("double").alias("total"))


# --------------------------------------------------------- files round trip

_CUSTOMER_FIELDS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
_CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"


@query("text_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
""")
def q_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K1 → S2 → P1 → P3: rows written as text lines, read back, split, named."""
    path = scratch_dir(spark, "files", "text")
    write_lines(t(spark, sf, "customer"), path, join_fields(_CUSTOMER_FIELDS, ","))
    f = read_lines(spark, path).select(split_fields("value", ",").alias("f"))
    named = f.select(*named_record("f", _CUSTOMER_FIELDS, strict=True))
    return named.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("int"),
                        "c_mktsegment")


@query("csv_header_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
""")
def q_csv_header_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K2 (with a header line) → S3: the header of each part file is skipped."""
    path = scratch_dir(spark, "files", "csv")
    write_delimited(t(spark, sf, "customer", *_CUSTOMER_FIELDS), path, sep="|", header=True)
    return read_delimited(spark, path, _CUSTOMER_SCHEMA, sep="|", header=True)


@query("bad_lines", """
SELECT 'good' AS kind, CAST(o_orderkey AS VARCHAR) AS line, strftime(o_orderdate, '%Y-%m-%d') AS placed
FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus <> 'F'
UNION ALL
SELECT 'reject', CASE WHEN o_orderkey % 3 = 0 THEN 'x' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d')
                      ELSE CAST(o_orderkey AS VARCHAR) END, ''
FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderstatus <> 'F')
""")
def q_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """S3 with malformed lines: short ones and bad numbers come out as rejects, the
    others typed."""
    path = scratch_dir(spark, "files", "bad")
    o = t(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus")
    key, date = F.col("o_orderkey").cast("string"), F.to_date("o_orderdate").cast("string")
    whole = F.col("o_orderkey") % 3 == 0
    line = F.when(whole & (F.col("o_orderstatus") != "F"), F.concat_ws("|", key, date)) \
        .when(whole, F.concat(F.lit("x"), key, F.lit("|"), date)).otherwise(key)
    write_lines(o, path, line)
    rows = read_delimited_marked(spark, path, "o_orderkey bigint, o_orderdate date", sep="|")
    good = F.col(REJECT_COL).isNull()
    return rows.select(F.when(good, "good").otherwise("reject").alias("kind"),
                       F.when(good, F.col("o_orderkey").cast("string")).otherwise(F.col(REJECT_COL)).alias("line"),
                       F.when(good, F.col("o_orderdate").cast("string")).otherwise("").alias("placed"))


# ------------------------------------------------- report families over text

_FLIGHTS_SQL = """
SELECT o.o_orderpriority AS dest, CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) - 30 AS arr_delay, l.l_shipdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


def _flight_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines in the flights layout: 12 fields, delay against 30 days."""
    li = signed_delays(spark, sf, "o_orderpriority")
    given = {"flight_date": F.to_date("l_shipdate").cast("string"), "origin": F.col("l_returnflag"),
             "dest": F.col("o_orderpriority"), "arr_delay": F.col("delay") - 30}
    return li.select(join_fields([given.get(f, F.lit(1)) for f in FLIGHT_FIELDS], ",").alias("value"), "l_shipdate")


def _flight_files(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark, "files", "flights")
    write_lines(_flight_lines(spark, sf).select("value"), path)
    return path


@query("text_delay_report", f"""
SELECT dest, CAST(SUM(arr_delay) AS BIGINT) AS total_delay, COUNT(*) AS n_delayed
FROM ({_FLIGHTS_SQL}) WHERE arr_delay > 0 GROUP BY dest
""")
def q_text_delay_report(spark: SparkSession, sf: str) -> DataFrame:
    """The delay report over text lines (S2 P1 P3 P6 F3 G6; ``int()`` by strict cast)."""
    return flight_delay_report(read_flights(spark, _flight_files(spark, sf)))


@query("text_delay_table", f"""
SELECT dest AS airport, COUNT(*) AS lista_Qtd_Atrasos, CAST(SUM(arr_delay) AS BIGINT) AS lista_Tempo_Atrasos
FROM ({_FLIGHTS_SQL}) WHERE arr_delay > 0 GROUP BY dest
""")
def q_text_delay_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same as warehouse rows, from one read of the text."""
    return flight_delay_table(read_flights(spark, _flight_files(spark, sf)))


@query("text_stream_report", f"""
SELECT make_timestamp(s) AS window_start, make_timestamp(s + {_US["1 day"]}) AS window_end, dest,
       CAST(SUM(arr_delay) AS BIGINT) AS total_delay, COUNT(*) AS n_delayed
FROM (SELECT dest, arr_delay, (epoch_us(CAST(l_shipdate AS TIMESTAMP)) // {_US["1 day"]}) * {_US["1 day"]} AS s
      FROM ({_FLIGHTS_SQL}) WHERE arr_delay > 0)
WHERE s + {_US["1 day"]} <= (SELECT max(epoch_us(CAST(l_shipdate AS TIMESTAMP))) FROM ({_FLIGHTS_SQL}) WHERE arr_delay > 0)
GROUP BY ALL
""")
def q_text_stream_report(spark: SparkSession, sf: str) -> DataFrame:
    """The delay report over a message stream, per one-day window (S5 P15 P6 F4 W1
    W3 W4 W6)."""
    base = scratch_dir(spark, "streams", "flights")
    lines = _flight_lines(spark, sf).select(F.encode("value", "UTF-8").alias("value"),
                                            F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"))
    publish_table(lines, fmt="parquet", path=f"{base}/topic")
    msgs = read_messages(spark, "parquet", "value binary, timestamp timestamp_ntz", path=f"{base}/topic")
    out = windowed_delay_report(msgs, "1 day").drop("value")
    return run_to_files(spark, out, "text_stream_report")


@query("text_monthly_report", """
WITH cases AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS uf, strftime(o_orderdate, '%Y') AS ano, strftime(o_orderdate, '%m') AS mes,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS dengue
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' GROUP BY ALL
), rain AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS uf, strftime(l_shipdate, '%Y') AS ano, strftime(l_shipdate, '%m') AS mes,
         ROUND(SUM(GREATEST(CAST(s_acctbal AS DECIMAL(18,2)) / 64, 0)), 1) AS chuva
  FROM (SELECT s_nationkey, s_acctbal, l_shipdate FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) GROUP BY ALL
)
SELECT uf, ano, mes, CAST(chuva AS DOUBLE) AS chuva, CAST(dengue AS DOUBLE) AS dengue
FROM cases JOIN rain USING (uf, ano, mes)
""".replace("CAST(s_acctbal AS DECIMAL(18,2)) / 64", "CAST(CAST(s_acctbal AS DECIMAL(18,2)) * CAST('0.0156250' AS DECIMAL(8,7)) AS DECIMAL(38,10))"))
def q_text_monthly_report(spark: SparkSession, sf: str) -> DataFrame:
    """The two-fact report over delimited text with headers (S3 P1 P3 P4 P5 P7 P8 P9
    P10 P11 F5 F6 J2): order values as cases (none, as ``-``, for one status), a
    64th of supplier balances, seven places, as rain."""
    c = t(spark, sf, "customer", "c_custkey", "c_nationkey")
    o = t(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    value = F.col("o_totalprice").cast(T.DecimalType(18, 2)).cast("string")
    given = {"data_iniSE": F.to_date("o_orderdate").cast("string"), "uf": F.col("c_nationkey").cast("string"),
             "casos": F.when(F.col("o_orderstatus") == "P", "-").otherwise(value)}
    cases = scratch_dir(spark, "files", "cases")
    write_delimited(o.join(c, o.o_custkey == c.c_custkey).select(
        *[given.get(f, F.lit("1")).alias(f) for f in CASES_FIELDS]), cases, sep="|", header=True)
    s = t(spark, sf, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    li = t(spark, sf, "lineitem", "l_suppkey", "l_shipdate")
    mm = F.col("s_acctbal").cast(T.DecimalType(18, 2)) * F.lit("0.0156250").cast(T.DecimalType(8, 7))
    rain = scratch_dir(spark, "files", "rain")
    write_delimited(li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.to_date("l_shipdate").cast("string").alias(RAIN_FIELDS[0]), mm.cast("string").alias(RAIN_FIELDS[1]),
        F.col("s_nationkey").cast("string").alias(RAIN_FIELDS[2])), rain, sep=",", header=True)
    out = text_monthly_report(read_cases(spark, cases), read_rain(spark, rain))
    return out.select("uf", "ano", "mes", F.col("chuva").cast("double").alias("chuva"),
                      F.col("dengue").cast("double").alias("dengue"))


@query("report_roundtrip", f"SELECT n_name, year, month, late_days, order_value FROM ({_MONTHS_SQL})")
def q_report_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K2 → S7: the monthly report written as ``;`` lines and read back typed."""
    path = scratch_dir(spark, "files", "report")
    write_delimited(monthly_report(spark, sf).drop("line"), path, sep=";")
    return read_report(spark, path, "n_name string, year string, month string, late_days bigint, order_value double")


# Further queries register themselves here.
from keyreport.plans import catalog_functions, catalog_records, catalog_streams  # noqa: E402,F401
