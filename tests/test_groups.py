"""Functions over ordered groups, whole or cut into pieces."""

import datetime as dt

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from keyreport.operators.groups import GroupFn, run_groups


class Running(GroupFn):
    """Number, running total and the value before, per row."""

    state_type = "struct<n: long, total: long, last: long>"
    schema = "k string, i long, n long, total long, last long"

    def create(self):
        return {"n": 0, "total": 0, "last": None}

    def add(self, state, rows):
        v = rows.column("v")
        return {"n": state["n"] + len(v), "total": state["total"] + (pc.sum(v).as_py() or 0), "last": v[-1].as_py()}

    def merge(self, before, after):
        return {"n": before["n"] + after["n"], "total": before["total"] + after["total"], "last": after["last"]}

    def rows(self, state, rows):
        v = rows.column("v")
        last = pa.array([state["last"], *v.to_pylist()[:-1]], pa.int64())
        total = pc.add(pc.cumulative_sum(pc.fill_null(v, 0)), state["total"])
        n = pa.array(range(state["n"] + 1, state["n"] + 1 + len(v)), pa.int64())
        return pa.RecordBatch.from_arrays([rows.column("k"), rows.column("i"), n, total, last],
                                          names=["k", "i", "n", "total", "last"])


def frame(spark, n=3000):
    """A group with two thirds of all rows, a NULL group, small ones, ties and NULL values."""
    data = []
    for i in range(n):
        k = "hot" if i % 3 else (None if i % 9 == 0 else f"k{i % 50}")
        data.append((k, i, (i * 7919) % 500, None if i % 11 == 0 else i))
    return spark.createDataFrame(data, "k string, i long, at int, v long").repartition(7), data


def brute(data):
    out, groups = [], {}
    for row in sorted(data, key=lambda r: (r[2], r[1])):
        groups.setdefault(row[0], []).append(row)
    for k, rows in groups.items():
        total, last = 0, None
        for n, (_, i, _, v) in enumerate(rows, 1):
            total += v or 0
            out.append((k, i, n, total, last))
            last = v
    return sorted(out, key=lambda r: r[1])


@pytest.mark.parametrize("piece_rows,pieces", [(10**6, 8), (500, 8), (0, 3), (100, 200)])
def test_equals_one_list_per_group(spark, piece_rows, pieces):
    df, data = frame(spark)
    out = run_groups(df, "k", ["at", "i"], Running(), piece_rows, pieces)
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[1]) == brute(data)


def test_small_arrow_batches(spark):
    df, data = frame(spark, 500)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = run_groups(df, "k", ["at", "i"], Running(), 50, 5).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted((tuple(r) for r in out), key=lambda r: r[1]) == brute(data)


class Where(GroupFn):
    state_type, schema = "long", "k string, task int"

    def add(self, state, rows):
        return 0

    def merge(self, before, after):
        return 0

    def rows(self, state, rows):
        from pyspark import TaskContext

        task = pa.array([TaskContext.get().partitionId()] * rows.num_rows, pa.int32())
        return pa.RecordBatch.from_arrays([rows.column("k"), task], names=["k", "task"])


def test_a_large_group_is_dealt_over_tasks(spark):
    df, _ = frame(spark, 20_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = lambda **kw: (run_groups(df, "k", ["at", "i"], Where(), **kw).where("k = 'hot'")
                              .groupBy("task").count().collect())
        assert len(tasks()) == 1
        cut = tasks(piece_rows=1000, pieces=64)
        assert len(cut) >= 4 and max(r["count"] for r in cut) < 20_000 * 2 / 3 / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(10,2)"])
def test_order_types(spark, kind):
    value = {"timestamp": lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i % 300),
             "timestamp_ntz": lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i % 300),
             "date": lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i % 300), "double": lambda i: i % 300 / 4,
             "decimal(10,2)": lambda i: __import__("decimal").Decimal(i % 300) / 4}[kind]
    data = [("a", i, None if i % 50 == 0 else value(i * 37), i) for i in range(400)]
    df = spark.createDataFrame(data, f"k string, i long, at {kind}, v long")
    out = run_groups(df, "k", ["at", "i"], Running(), 20, 6)
    first = value(0).__class__
    order = sorted(data, key=lambda r: (r[2] is not None, r[2] if r[2] is not None else first.min if hasattr(first, "min") else 0, r[1]))
    assert [r["i"] for r in sorted(out.collect(), key=lambda r: r["n"])] == [r[1] for r in order]


def test_order_must_be_a_number_or_time(spark):
    df, _ = frame(spark, 10)
    with pytest.raises(TypeError):
        run_groups(df, "k", "k", Running())


def test_empty_input(spark):
    df, _ = frame(spark, 10)
    assert run_groups(df.limit(0), "k", "at", Running()).collect() == []
    assert df.select(F.count("*")).first()[0] == 10
