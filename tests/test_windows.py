import datetime as dt
import os

from pyspark.sql import functions as F

from keyreport.plans import reports as R
from keyreport.session import scratch_dir
from keyreport.streaming import windows as W
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
# (second, key, delay) per file; one file per micro-batch.
FILES = [[(1, "A", 3), (4, "A", 5), (7, "A", 2), (12, "B", 4)],
         [(18, "B", 9)],
         [(2, "A", 100), (16, "A", 7)],
         [(60, "Z", 1)]]


def message(sec, key, delay):
    line = f"2024-01-01,1,{sec},X,{key},0,0,0,{delay},0,0,{sec}\n"
    return (bytearray(line.encode()), T0 + dt.timedelta(seconds=sec))


def test_batch_fixed_and_sliding_membership(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), k, d) for f in FILES[:2] for s, k, d in f]
                               + [(T0 + dt.timedelta(seconds=16), "A", 7)], "ts timestamp_ntz, k string, d int")
    fixed = W.windowed_aggregate(df, "ts", ["k"], "5 seconds", {"s": F.sum("d"), "n": F.count("*")}, lateness=None)
    got = rows(fixed.select(F.second("window_start"), "k", "s", "n"))
    assert got == [(0, "A", 8, 2), (10, "B", 4, 1), (15, "A", 7, 1), (15, "B", 9, 1), (5, "A", 2, 1)]
    slide = W.windowed_aggregate(df, "ts", ["k"], "10 seconds", {"m": F.array_sort(F.collect_list("d"))},
                                 period="5 seconds", lateness=None)
    members = {(r[0], r[1]): r[2] for r in slide.select(
        (F.unix_timestamp(F.col("window_start").cast("timestamp")) - F.unix_timestamp(F.lit(T0).cast("timestamp")))
        .cast("int"), "k", "m").collect()}
    assert members == {(-5, "A"): [3, 5], (0, "A"): [2, 3, 5], (5, "A"): [2], (10, "A"): [7], (15, "A"): [7],
                       (5, "B"): [4], (10, "B"): [4, 9], (15, "B"): [9]}


def test_window_bounds_ignore_session_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1, 30),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        r = W.windowed_aggregate(df, "ts", [], "6 hours", {"n": F.count("*")}, lateness=None).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r["window_start"], r["window_end"]) == (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 6, 0))


def run_files(spark, src, out, ckpt, files, lateness="0 seconds"):
    stream = spark.readStream.schema("value binary, ts timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    report = R.windowed_delay_report(stream, "5 seconds", lateness=lateness, key="dest")
    q = (report.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ckpt).start())
    dropped = 0
    try:
        for rows_ in files:
            spark.createDataFrame([message(*r) for r in rows_], "value binary, ts timestamp") \
                .coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
        for p in q.recentProgress:
            for op in p.get("stateOperators", []):
                dropped += op.get("numRowsDroppedByWatermark", 0)
    finally:
        q.stop()
    return dropped


def read_out(spark, out):
    df = spark.read.parquet(out)
    return rows(df.select(F.second("window_start"), "dest", "total_delay", "n_delayed"))


EXPECTED = [(0, "A", 8, 2), (10, "B", 4, 1), (15, "A", 7, 1), (15, "B", 9, 1), (5, "A", 2, 1)]


def test_stream_drops_late_row_and_keeps_open_window(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    base = scratch_dir(spark, "test", "stream")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    os.makedirs(src.replace("file:", ""), exist_ok=True)
    dropped = run_files(spark, src, out, ckpt, FILES)
    assert spark.conf.get("spark.sql.session.timeZone") == old
    assert read_out(spark, out) == EXPECTED  # Z's window is still open
    assert dropped >= 1


def test_stream_restart_adds_no_duplicates(spark):
    base = scratch_dir(spark, "test", "restart")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    os.makedirs(src.replace("file:", ""), exist_ok=True)
    run_files(spark, src, out, ckpt, FILES[:2])
    run_files(spark, src, out, ckpt, FILES[2:])  # a new query on the same checkpoint
    assert read_out(spark, out) == EXPECTED


def test_stream_equals_batch_on_closed_windows(spark):
    msgs = spark.createDataFrame([message(*r) for f in FILES for r in f if r[0] != 2], "value binary, ts timestamp")
    batch = R.windowed_delay_report(msgs, "5 seconds", lateness=None, key="dest")
    closed = batch.where(F.col("window_end") <= F.lit(T0 + dt.timedelta(seconds=60)).cast("timestamp"))
    assert rows(closed.select(F.second("window_start"), "dest", "total_delay", "n_delayed")) == EXPECTED


def test_message_source_to_windowed_report(spark, tmp_dir):
    from keyreport.sources.streams import read_messages
    topic = f"{tmp_dir}/topic"
    msgs = [message(*r) for f in FILES for r in f if r[0] != 2]
    spark.createDataFrame(msgs, "value binary, timestamp timestamp").write.parquet(topic)
    stream = read_messages(spark, "parquet", schema="value binary, timestamp timestamp", path=topic)
    out = W.run_to_files(spark, R.windowed_delay_report(stream, "5 seconds"), "test_messages")
    assert rows(out.select(F.second("window_start"), "dest", "total_delay", "n_delayed")) == EXPECTED
    first = [bytes(r["value"]).decode() for r in out.where("dest = 'B'").orderBy("window_start").collect()][0]
    assert first.startswith('{"window_start":') and '"dest":"B"' in first


def test_sliding_stream_matches_membership(spark):
    base = scratch_dir(spark, "test", "sliding")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    os.makedirs(src.replace("file:", ""), exist_ok=True)
    stream = spark.readStream.schema("value binary, ts timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    q = (R.windowed_delay_report(stream, "10 seconds", "5 seconds").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt).start())
    try:
        for rows_ in FILES:
            spark.createDataFrame([message(*r) for r in rows_], "value binary, ts timestamp") \
                .coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
    finally:
        q.stop()
    got = rows(spark.read.parquet(out).select(
        (F.unix_timestamp("window_start") - F.unix_timestamp(F.lit(T0).cast("timestamp"))).cast("int"),
        "dest", "total_delay", "n_delayed"))
    # late (2, A, 100) falls only in closed windows and is dropped; (16, A, 7) is kept
    assert got == [(-5, "A", 8, 2), (0, "A", 10, 3), (10, "A", 7, 1), (10, "B", 13, 2), (15, "A", 7, 1),
                   (15, "B", 9, 1), (5, "A", 2, 1), (5, "B", 4, 1)]


def test_lateness_keeps_a_late_row(spark):
    base = scratch_dir(spark, "test", "lateness")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    os.makedirs(src.replace("file:", ""), exist_ok=True)
    dropped = run_files(spark, src, out, ckpt, FILES, lateness="20 seconds")
    # watermark = max event time - 20 s: (2, A, 100) is still in time for window [0, 5)
    assert read_out(spark, out) == [(0, "A", 108, 3), (10, "B", 4, 1), (15, "A", 7, 1), (15, "B", 9, 1),
                                    (5, "A", 2, 1)]
    assert dropped == 0


def test_windowed_cogroup_of_two_inputs(spark):
    a = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), k, v) for s, k, v in
                               [(1, "A", 3), (4, "A", 5), (12, "B", 4)]], "ts timestamp_ntz, k string, v int")
    b = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), k, v) for s, k, v in
                               [(2, "A", 10), (7, "C", 1)]], "ts timestamp_ntz, k string, v int")
    out = W.windowed_cogroup({"a": a, "b": b}, "ts", ["k"], "v", "5 seconds", lateness=None)
    got = rows(out.select(F.second("window_start"), "k", "a_total", "a_n", "b_total", "b_n"))
    assert got == [(0, "A", 8, 2, 10, 1), (10, "B", 4, 1, None, 0), (5, "C", None, 0, 1, 1)]
    one = W.windowed_tagged_aggregate(a.unionByName(b.withColumn("k", F.lit("A"))), "ts", [], "k", ["A"], "v",
                                      "5 seconds", lateness=None)
    assert rows(one.select(F.second("window_start"), "A_total", "A_n")) == [(0, 18, 3), (5, 1, 1)]
