"""Registered queries: accumulators, ordered groups and table functions."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyreport.operators.groups import GroupFn, run_groups
from keyreport.operators.keyed import count_per_element
from keyreport.operators.tablefn import as_group_function, as_table_function, lateral, register
from keyreport.operators.userfn import CombineFn, combine_accumulators
from keyreport.plans.catalog import query, t


# ------------------------------------------------------------- accumulators

class Mean(CombineFn):
    """The mean of whole numbers: total and count, then a double."""

    state_type, result_type = "struct<total: decimal(38,0), n: long>", "double"

    def add(self, state, values: pa.Array):
        return {"total": pc.sum(values.cast(pa.decimal128(38, 0))).as_py(), "n": len(values)}

    def merge(self, states: list):
        return {"total": sum(s["total"] for s in states), "n": sum(s["n"] for s in states)}

    def extract(self, state):
        return float(state["total"]) / state["n"]


class Largest(CombineFn):
    """The ``n`` largest values, joined to a string."""

    state_type, result_type = "array<long>", "string"

    def __init__(self, n: int):
        self.n = n

    def add(self, state, values: pa.Array):
        best = pc.select_k_unstable(values, self.n, sort_keys=[("x", "descending")])
        return values.take(best).to_pylist()

    def merge(self, states: list):
        return sorted((v for s in states for v in s), reverse=True)[:self.n]

    def extract(self, state):
        return ",".join(map(str, state))


@query("combine_mean", """
SELECT event_type, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS mean_cents FROM events GROUP BY event_type
""")
def q_combine_mean(spark: SparkSession, sf: str) -> DataFrame:
    """X5 with an accumulator of another type than the result: a mean."""
    ev = t(spark, sf, "events", "event_type", "value").select("event_type", F.round(F.col("value") * 100).cast("long").alias("c"))
    return combine_accumulators(ev, "event_type", "c", Mean(), "mean_cents")


@query("combine_top", """
SELECT user_id, string_agg(event_id, ',' ORDER BY event_id DESC) AS latest FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r <= 3
GROUP BY user_id
""")
def q_combine_top(spark: SparkSession, sf: str) -> DataFrame:
    """The three largest event numbers per user, accumulated as a list."""
    return combine_accumulators(t(spark, sf, "events", "user_id", "event_id"), "user_id", "event_id", Largest(3), "latest")


# ----------------------------------------------------------- ordered groups

class RunningTotal(GroupFn):
    """Number of the row, running total and time since the row before, per event."""

    state_type = "struct<n: long, total: long, last: long>"
    schema = "event_id long, event_type string, n long, total long, gap_us long"

    def create(self):
        return {"n": 0, "total": 0, "last": None}

    def add(self, state, rows: pa.RecordBatch):
        return {"n": state["n"] + rows.num_rows, "total": state["total"] + (pc.sum(rows.column("cents")).as_py() or 0),
                "last": rows.column("us")[-1].as_py()}

    def merge(self, before, after):
        return {"n": before["n"] + after["n"], "total": before["total"] + after["total"], "last": after["last"]}

    def rows(self, state, rows: pa.RecordBatch) -> pa.RecordBatch:
        us = rows.column("us")
        first = us[:1] if state["last"] is None else pa.array([state["last"]], pa.int64())
        gap = pc.subtract(us, pa.concat_arrays([first, us[:-1]]))
        n = pa.array(range(state["n"] + 1, state["n"] + 1 + rows.num_rows), pa.int64())
        total = pc.add(pc.cumulative_sum(rows.column("cents")), state["total"])
        return pa.RecordBatch.from_arrays([rows.column("event_id"), rows.column("event_type"), n, total, gap],
                                          names=["event_id", "event_type", "n", "total", "gap_us"])


# Rows from which a group is cut: a few hundred events per type and piece at sf0.01.
CUT_ROWS, CUT_PIECES = 1000, 8


@query("group_running", """
SELECT event_id, event_type, row_number() OVER w AS n, CAST(SUM(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS total,
       epoch_us(ts) - coalesce(lag(epoch_us(ts)) OVER w, epoch_us(ts)) AS gap_us
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def q_group_running(spark: SparkSession, sf: str) -> DataFrame:
    """G5 as a stream of each group's ordered rows, large groups cut over tasks."""
    ev = t(spark, sf, "events", "event_id", "event_type", "value", "ts").select(
        "event_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"), "ts",
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("us"))
    return run_groups(ev, "event_type", ["ts", "event_id"], RunningTotal(), CUT_ROWS, CUT_PIECES)


# ---------------------------------------------------------- table functions

def _long_words(text: str | None, sep: str, least: int):
    for word in (text or "").split(sep):
        if len(word) >= least:
            yield (word, len(word))


@query("table_function_sql", """
SELECT doc_id, word, length(word) AS size, COUNT(*) AS n
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE length(word) >= 18 GROUP BY ALL
""")
def q_table_function_sql(spark: SparkSession, sf: str) -> DataFrame:
    """X2 called from SQL text as a lateral table function."""
    register(spark, "long_words", as_table_function(_long_words, "word string, size int"))
    return spark.sql("""SELECT doc_id, word, CAST(size AS BIGINT) AS size, COUNT(*) AS n
                        FROM {docs} d, LATERAL long_words(d.text, ' ', 18) GROUP BY doc_id, word, size""",
                     docs=t(spark, sf, "documents", "doc_id", "text"))


@query("table_function_join", """
SELECT c_mktsegment, word, COUNT(*) AS n
FROM (SELECT c_mktsegment, unnest(string_split(c_name, '#')) AS word FROM customer) GROUP BY ALL
""")
def q_table_function_join(spark: SparkSession, sf: str) -> DataFrame:
    """X4 as a table function in a lateral join of the DataFrame API."""
    parts = as_table_function(lambda text, sep: ((w,) for w in text.split(sep)), "word string")
    found = lateral(t(spark, sf, "customer", "c_name", "c_mktsegment"), parts, "c_name", F.lit("#"))
    return count_per_element(found, ["c_mktsegment", "word"])


def _visit(state, row):
    """Visits end with a pause of an hour."""
    at = row["ts"]
    if state and at - state[2] <= dt.timedelta(hours=1):
        return (state[0], state[1], at, state[3] + 1), ()
    return (row["user_id"], at, at, 1), ([state] if state else ())


@query("table_function_groups", """
WITH v AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS starts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT user_id, ts, SUM(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS visit FROM v)
SELECT user_id, min(ts) AS started, max(ts) AS ended, COUNT(*) AS n FROM n GROUP BY user_id, visit
""")
def q_table_function_groups(spark: SparkSession, sf: str) -> DataFrame:
    """X4 as a table function over a partitioned and ordered table argument."""
    register(spark, "visits", as_group_function(
        lambda: None, _visit, lambda state: [state] if state else [],
        "user_id long, started timestamp_ntz, ended timestamp_ntz, n long"))
    return spark.sql("SELECT * FROM visits(TABLE({events}) PARTITION BY user_id ORDER BY ts)",
                     events=t(spark, sf, "events", "user_id", "ts"))
