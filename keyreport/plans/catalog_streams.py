"""Registered queries: panes, stream joins, several sinks and what a stream leaves behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyreport.operators.keyed import count_per_key
from keyreport.plans.catalog import (
    _CLOSED, _FIXED_SQL, _LATEST, _US, FIXED_SIZE, LATENESS, _bucket_sql, _fixed_counts, event_stream, query, t,
)
from keyreport.session import scratch_dir
from keyreport.sinks.streams import batch_folder, fan_out
from keyreport.sources.streams import read_file_stream
from keyreport.streaming.state import late_rows, open_windows
from keyreport.streaming.windows import (
    count_of, max_of, mean_of, min_of, pane_aggregate, run_to_files, sum_of, windowed_outer_join,
)

# A day every half an hour: 48 windows hold each row.
DENSE_SIZE, DENSE_PERIOD = "1 day", "30 minutes"
_DENSE, _STEP = 86400 * 10**6, 1800 * 10**6
_MONEY = T.DecimalType(18, 2)

_PANES_SQL = f"""
SELECT make_timestamp(s) AS window_start, make_timestamp(s + {_DENSE}) AS window_end, event_type,
       CAST(SUM(v) AS DOUBLE) AS total, COUNT(*) AS n, MIN(value) AS least, MAX(value) AS most,
       CAST(SUM(v) AS DOUBLE) / COUNT(v) AS mean
FROM (SELECT (epoch_us(ts) // {_STEP}) * {_STEP} - k * {_STEP} AS s, event_type, value, CAST(value AS DECIMAL(18,2)) AS v
      FROM events, range({_DENSE // _STEP}) r(k))
GROUP BY ALL
"""


def _dense_windows(df: DataFrame, lateness: str | None) -> DataFrame:
    df = df.withColumn("v", F.col("value").cast(_MONEY))
    out = pane_aggregate(df, "ts", ["event_type"], DENSE_SIZE, DENSE_PERIOD,
                         {"total": sum_of("v"), "n": count_of(), "least": min_of("value"), "most": max_of("value"),
                          "mean": mean_of("v")}, lateness)
    return out.withColumn("total", F.col("total").cast("double"))


@query("sliding_panes", _PANES_SQL)
def q_sliding_panes(spark: SparkSession, sf: str) -> DataFrame:
    """W2 by panes: every event is aggregated once, and 48 windows share its pane."""
    return _dense_windows(t(spark, sf, "events", "ts", "event_type", "value"), None)


@query("stream_panes", f"SELECT * FROM ({_PANES_SQL}) {_CLOSED}")
def q_stream_panes(spark: SparkSession, sf: str) -> DataFrame:
    """The same on a stream: two chained stateful aggregates."""
    return run_to_files(spark, _dense_windows(event_stream(spark, sf), LATENESS), "stream_panes")


# A tenth of all events comes in a second wave, late.
_MARK_SQL = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events WHERE event_id % 10 <> 0)"


def _two_waves(spark: SparkSession, sf: str, name: str, shaped, run) -> tuple[str, DataFrame]:
    """Run ``run(shaped(stream))`` on the first wave, then resume it with the late one;
    gives the folder and the last result."""
    base = scratch_dir(spark, "streams", name)
    events = t(spark, sf, "events", "event_id", "user_id", "event_type", "value", "ts")
    late = F.col("event_id") % 10 == 0
    out = None
    for wave in (events.where(~late), events.where(late)):
        wave.write.mode("append").parquet(f"{base}/in")
        out = run(shaped(read_file_stream(spark, f"{base}/in", events.schema)), base)
    return base, out


def _join_mark_sql(where: str) -> str:
    """The watermark of two inputs is the earlier one of both."""
    latest = ", ".join(f"(SELECT max(ts) FROM events WHERE event_type = '{kind}' AND {where})" for kind in ("purchase", "error"))
    return f"(SELECT date_trunc('millisecond', least({latest})) - INTERVAL 1 DAY)"


@query("stream_outer_join", f"""
WITH w AS (SELECT {_bucket_sql(FIXED_SIZE)} AS s, * FROM events),
kept AS (SELECT * FROM w WHERE event_id % 10 <> 0 OR make_timestamp(s + {_US[FIXED_SIZE]}) > {_join_mark_sql('event_id % 10 <> 0')}),
p AS (SELECT s, user_id, max(value) AS purchase_most, count(DISTINCT value) AS purchase_values FROM kept
      WHERE event_type = 'purchase' GROUP BY ALL),
e AS (SELECT s, user_id, min(value) AS error_least, max(event_id) AS error_last FROM kept
      WHERE event_type = 'error' GROUP BY ALL)
SELECT make_timestamp(s) AS window_start, make_timestamp(s + {_US[FIXED_SIZE]}) AS window_end, user_id,
       purchase_most, coalesce(purchase_values, 0) AS purchase_values, error_least, coalesce(error_last, -1) AS error_last
FROM p FULL JOIN e USING (s, user_id) WHERE make_timestamp(s + {_US[FIXED_SIZE]}) <= {_join_mark_sql('true')}
""")
def q_stream_outer_join(spark: SparkSession, sf: str) -> DataFrame:
    """J3 as a stream-stream full outer join: purchases and errors per window and user,
    each with aggregates that aren't sums, one-sided users included; late rows come in
    a second run."""
    def shaped(stream: DataFrame) -> DataFrame:
        out = windowed_outer_join(
            {"purchase": (stream.where("event_type = 'purchase'"),
                          {"most": F.max("value"), "values": F.size(F.collect_set("value")).cast("long")}),
             "error": (stream.where("event_type = 'error'"),
                       {"least": F.min("value"), "last": F.max("event_id")})},
            "ts", ["user_id"], FIXED_SIZE, lateness=LATENESS)
        return out.withColumns({"purchase_values": F.coalesce("purchase_values", F.lit(0)),
                                "error_last": F.coalesce("error_last", F.lit(-1))})

    return _two_waves(spark, sf, "outer_join", shaped,
                      lambda out, base: run_to_files(spark, out, "stream_outer_join", base=base))[1]


@query("stream_two_sinks", """
SELECT 'count' AS sink, event_type AS item, COUNT(*) AS n FROM events GROUP BY event_type
UNION ALL SELECT 'error', CAST(event_id AS VARCHAR), user_id FROM events WHERE event_type = 'error'
""")
def q_stream_two_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """One read of the events feeds two sinks, counts per type and the error rows."""
    base = scratch_dir(spark, "streams", "two_sinks")

    def counts(batch: DataFrame, batch_id: int) -> None:
        count_per_key(batch, "event_type").write.mode("overwrite").parquet(batch_folder(f"{base}/counts", batch_id))

    def errors(batch: DataFrame, batch_id: int) -> None:
        (batch.where("event_type = 'error'").select("event_id", "user_id")
         .write.mode("overwrite").parquet(batch_folder(f"{base}/errors", batch_id)))

    q = fan_out(event_stream(spark, sf), {"counts": counts, "errors": errors}, f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    per = spark.read.schema("event_type string, n bigint, batch_id int").parquet(f"{base}/counts")
    found = spark.read.schema("event_id bigint, user_id bigint, batch_id int").parquet(f"{base}/errors")
    return per.groupBy(F.lit("count").alias("sink"), F.col("event_type").alias("item")).agg(F.sum("n").alias("n")).union(
        found.select(F.lit("error"), F.col("event_id").cast("string"), F.col("user_id").cast("long")))


@query("stream_late_audit", f"""
SELECT event_id, event_type, make_timestamp(s + {_US[FIXED_SIZE]}) AS window_end
FROM (SELECT {_bucket_sql(FIXED_SIZE)} AS s, * FROM events)
WHERE event_id % 10 = 0 AND make_timestamp(s + {_US[FIXED_SIZE]}) <= {_MARK_SQL}
""")
def q_stream_late_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Every row that the windowed counts dropped as late, from the query's own
    checkpoint."""
    base, _ = _two_waves(spark, sf, "late_audit", lambda s: _fixed_counts(s, LATENESS),
                         lambda out, base: run_to_files(spark, out, "late_audit", base=base))
    rows = spark.read.schema(t(spark, sf, "events").select("event_id", "event_type", "ts").schema).parquet(f"{base}/in")
    gone = late_rows(spark, f"{base}/checkpoint", rows, "ts", FIXED_SIZE)
    return gone.select("event_id", "event_type", F.to_timestamp_ntz(F.date_format("dropped_from.end", "yyyy-MM-dd HH:mm:ss"))
                       .alias("window_end"))


@query("stream_open_windows", f"SELECT *, window_end > {_LATEST} AS is_open FROM ({_FIXED_SQL})")
def q_stream_open_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The windows that append mode emitted and those that the state store still
    holds; together they are the batch answer."""
    base = scratch_dir(spark, "streams", "open")
    closed = run_to_files(spark, _fixed_counts(event_stream(spark, sf), LATENESS), "open", base=base)
    held = open_windows(spark, f"{base}/checkpoint", ["event_type"], {"n": "count"}, ntz=True)
    return closed.withColumn("is_open", F.lit(False)).union(held.withColumn("is_open", F.lit(True)))
