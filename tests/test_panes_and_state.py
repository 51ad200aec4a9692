"""Panes, stream joins, several sinks, and what a stream leaves in its checkpoint."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keyreport.session import scratch_dir
from keyreport.sinks.streams import batch_folder, fan_out
from keyreport.sources.streams import read_file_stream
from keyreport.streaming import state as S
from keyreport.streaming import windows as W
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, k string, v long"


def at(*events):
    return [(T0 + dt.timedelta(seconds=s), k, v) for s, k, v in events]


def waves(spark, name, *parts):
    """Write each part as one file and give its folder, one part per call of next()."""
    base = scratch_dir(spark, "tests", name)
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        yield base


def stream(spark, base):
    schema = spark.createDataFrame([], SCHEMA).schema
    return read_file_stream(spark, f"{base}/in", schema)


def measures():
    return {"total": W.sum_of("v"), "n": W.count_of(), "known": W.count_of("v"), "least": W.min_of("v"),
            "most": W.max_of("v"), "mean": W.mean_of("v")}


def plain():
    return {"total": F.sum("v"), "n": F.count("*"), "known": F.count("v"), "least": F.min("v"), "most": F.max("v"),
            "mean": F.avg("v")}


@pytest.mark.parametrize("size,period", [("10 seconds", "5 seconds"), ("9 seconds", "6 seconds"), ("1 minute", "1 second"),
                                         ("7 seconds", "7 seconds"), ("1 hour", "25 minutes")])
def test_panes_give_the_rows_of_sliding_windows(spark, size, period):
    data = at(*[((i * i * 37) % 4000, "ab"[i % 2] if i % 9 else None, None if i % 5 == 0 else i) for i in range(400)],
              (1, "only null", None))
    df = spark.createDataFrame(data, SCHEMA)
    got = W.pane_aggregate(df, "ts", ["k"], size, period, measures(), None)
    assert rows(got) == rows(W.windowed_aggregate(df, "ts", ["k"], size, plain(), period=period, lateness=None))


def test_rows_are_not_copied_before_the_first_aggregate(spark):
    df = spark.createDataFrame(at((1, "a", 1)), SCHEMA)
    plan = W.pane_aggregate(df, "ts", ["k"], "1 day", "1 minute", measures(), None)._jdf.queryExecution().optimizedPlan().toString()
    lowest = plan[plan.rindex("Aggregate"):]
    assert plan.count("Expand") <= 1 and "Expand" not in lowest


def test_only_fixed_intervals_make_panes(spark):
    df = spark.createDataFrame(at((1, "a", 1)), SCHEMA)
    for bad in ("1 month", "soon"):
        with pytest.raises(ValueError):
            W.pane_aggregate(df, "ts", [], bad, "1 day", measures())


def test_pane_state_is_one_row_per_open_pane(spark):
    base = next(waves(spark, "panes", at(*[(s, "a", s) for s in range(0, 3600)])))
    out = W.pane_aggregate(stream(spark, base), "ts", ["k"], "20 minutes", "1 minute", measures(), "10 minutes")
    closed = W.run_to_files(spark, out, "panes", base=base)
    assert closed.agg(F.max("window_end")).first()[0] == T0 + dt.timedelta(minutes=49)
    # Watermark at 49:59: minutes 49 to 59 are open panes, windows that end from 50:00 on are open.
    assert S.state_rows(spark, f"{base}/checkpoint", operator=1).count() == 11
    ends = S.state_rows(spark, f"{base}/checkpoint").agg(F.min("key.window.end")).first()[0]
    assert ends == T0 + dt.timedelta(minutes=50)


def test_outer_join_of_streams_with_late_and_one_sided_rows(spark):
    first = at((1, "both", 1), (2, "both", -1), (3, "left", 2), (4, "right", -2), (5, None, 3), (6, None, -3), (30, "mark", 9),
               (31, "mark", -9))
    late = at((2, "both", 50), (21, "kept", 5), (60, "mark", 9), (61, "mark", -9))
    got = None
    for base in waves(spark, "outer", first, late):
        s = stream(spark, base)
        out = W.windowed_outer_join({"plus": (s.where("v > 0"), {"most": F.max("v")}),
                                     "minus": (s.where("v < 0"), {"least": F.min("v"), "n": F.count("*")})},
                                    "ts", ["k"], "10 seconds", lateness="10 seconds")
        got = W.run_to_files(spark, out, "outer", base=base)
    start = lambda r: (r["window_start"] - T0).seconds
    found = sorted(((start(r), str(r["k"]), r["plus_most"], r["minus_least"], r["minus_n"]) for r in got.collect()), key=str)
    assert found == sorted([(0, "both", 1, -1, 1), (0, "left", 2, None, None), (0, "right", None, -2, 1), (0, "None", 3, -3, 1),
                            (20, "kept", 5, None, None), (30, "mark", 9, -9, 1)], key=str)


def test_two_sinks_and_a_failure_between_them(spark):
    base = next(waves(spark, "sinks", at((1, "a", 1), (2, "b", 2))))
    calls = []

    def first(batch, batch_id):
        calls.append("first")
        batch.write.mode("append").parquet(f"{base}/first")  # would repeat rows on a replay

    def second(batch, batch_id):
        calls.append("second")
        if calls.count("second") == 1:
            raise RuntimeError("second sink is down")
        batch.groupBy("k").count().write.mode("overwrite").parquet(batch_folder(f"{base}/second", batch_id))

    for attempt in range(3):  # fails, is replayed, has nothing to do
        q = fan_out(stream(spark, base), {"first": first, "second": second}, f"{base}/checkpoint", available_now=True)
        if attempt == 0:
            with pytest.raises(Exception, match="second sink is down"):
                q.awaitTermination()
        else:
            q.awaitTermination()
    assert calls == ["first", "second", "second"]
    assert spark.read.parquet(f"{base}/first").count() == 2
    assert rows(spark.read.parquet(f"{base}/second").select("k", "count")) == [("a", 1), ("b", 1)]


def test_a_batch_is_read_once_for_all_sinks(spark):
    base = next(waves(spark, "once", at((1, "a", 1))))
    kept = []
    q = fan_out(stream(spark, base), {n: lambda b, i: kept.append(b.storageLevel.useMemory) for n in "xy"},
                f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    assert kept == [True, True]


@pytest.mark.parametrize("period", [None, "5 seconds"])
def test_late_rows_come_back_whole(spark, period):
    parts = [at((1, "a", 1), (40, "a", 2)), at((2, "late", 3), (24, "late", 4), (33, "in time", 5)), at((50, "a", 6)),
             at((34, "later", 7), (45, "in time", 8))]
    out = None
    for base in waves(spark, "late", *parts):
        counts = W.windowed_aggregate(stream(spark, base), "ts", ["k"], "10 seconds", {"n": F.count("*")}, period, "10 seconds")
        out = W.run_to_files(spark, counts, "late", base=base)
    read = spark.read.schema(SCHEMA).parquet(f"{base}/in")
    gone = S.late_rows(spark, f"{base}/checkpoint", read, "ts", "10 seconds", period)
    assert gone.columns == ["ts", "k", "v", "batch_id", "dropped_from"]
    ends = sorted((r["k"], r["v"], r["dropped_from"]["end"].second) for r in gone.collect())
    if period is None:  # watermarks: 30 s, then 40 s
        assert ends == [("late", 3, 10), ("late", 4, 30), ("later", 7, 40)]
    # What came out, what is still held, and what was dropped make up all rows' windows.
    held = S.open_windows(spark, f"{base}/checkpoint", ["k"], {"n": "count"})
    total = sum(r["n"] for r in out.collect()) + sum(r["n"] for r in held.collect()) + len(ends)
    assert total == read.count() * (1 if period is None else 2)


def test_closed_and_open_windows_are_the_batch_answer(spark):
    base = next(waves(spark, "open", at(*[(s, "ab"[s % 2], s) for s in range(100)])))
    aggs = {"n": F.count("*"), "most": F.max("v")}
    closed = W.run_to_files(spark, W.windowed_aggregate(stream(spark, base), "ts", ["k"], "10 seconds", aggs), "open", base=base)
    held = S.open_windows(spark, f"{base}/checkpoint", ["k"], {"n": "count", "most": "max"}, ntz=True)
    batch = W.windowed_aggregate(spark.read.schema(SCHEMA).parquet(f"{base}/in"), "ts", ["k"], "10 seconds", aggs, lateness=None)
    assert rows(closed.union(held)) == rows(batch) and held.count() == 2
    # The state after the first batch held them all.
    assert S.state_rows(spark, f"{base}/checkpoint", batch_id=0).count() == batch.count()


def test_rows_of_a_forgotten_batch_fail_the_audit(spark):
    old = spark.conf.get("spark.sql.streaming.minBatchesToRetain")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    try:
        for base in waves(spark, "forgotten", *[at((100 * i, "a", i)) for i in range(1, 7)], at((1, "late", 0))):
            counts = W.windowed_aggregate(stream(spark, base), "ts", ["k"], "10 seconds", {"n": F.count("*")})
            W.run_to_files(spark, counts, "forgotten", base=base)
    finally:
        spark.conf.set("spark.sql.streaming.minBatchesToRetain", old)
    read = spark.read.schema(SCHEMA).parquet(f"{base}/in")
    known = S.batch_files(spark, f"{base}/checkpoint").where("batch_id IS NOT NULL").count()
    assert 0 < known < 7
    with pytest.raises(Exception, match="no watermark is kept"):
        S.late_rows(spark, f"{base}/checkpoint", read, "ts", "10 seconds").collect()
