"""Combine functions with accumulators, and table functions."""

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from keyreport.operators import tablefn as TF
from keyreport.operators import userfn as U
from keyreport.plans.catalog_functions import Largest, Mean
from tests.conftest import rows


class Spread(U.CombineFn):
    state_type, result_type = "struct<low: double, high: double>", "double"

    def add(self, state, values: pa.Array):
        m = pc.min_max(values)
        return {"low": m["min"].as_py(), "high": m["max"].as_py()}

    def merge(self, states):
        return {"low": min(s["low"] for s in states), "high": max(s["high"] for s in states)}

    def extract(self, state):
        return state["high"] - state["low"]


def data(spark):
    return spark.createDataFrame([("a", 1, 1.5), ("a", 2, None), ("a", 5, 4.0), ("b", 7, None), (None, 3, -1.0), (None, None, 2.0)],
                                 "k string, v long, d double").repartition(4)


@pytest.mark.parametrize("merge_tasks", [1, 3])
def test_states_of_other_types(spark, merge_tasks):
    df = data(spark)
    assert rows(U.combine_accumulators(df, "k", "v", Mean(), "m", merge_tasks)) == [("a", 8 / 3), ("b", 7.0), (None, 3.0)]
    assert rows(U.combine_accumulators(df, ["k"], "d", Spread(), "s", merge_tasks)) == [("a", 2.5), ("b", None), (None, 3.0)]
    assert rows(U.combine_accumulators(df, "k", "v", Largest(2), "top", merge_tasks)) == [("a", "5,2"), ("b", "7"), (None, "3")]


def test_many_keys_leave_the_task_early(spark, monkeypatch):
    monkeypatch.setattr(U, "HELD_KEYS", 10)
    df = spark.range(0, 5000, numPartitions=3).selectExpr("id % 700 AS k", "id AS v")
    got = U.combine_accumulators(df, "k", "v", Largest(1), "m")
    assert rows(got) == rows(df.groupBy("k").agg(F.max("v").cast("string")))


def test_one_scan_and_one_shuffle(spark):
    path = "/root/testdata/sf0.001/events.parquet"
    df = spark.read.parquet(path)
    for out in (U.combine_accumulators(df, "event_type", "event_id", Mean()),
                U.combine_per_key(df, "event_type", "value", lambda s: float(s.max()), "double")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_empty_input(spark):
    assert U.combine_accumulators(data(spark).limit(0), "k", "v", Mean()).collect() == []


def test_table_functions_keep_rows_without_output(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "i int, t string")
    words = TF.as_table_function(lambda t: ((w,) for w in (t or "").split()), "w string")
    assert rows(TF.lateral(df, words, "t").select("i", "w")) == [(1, "a"), (1, "b")]
    kept = TF.lateral(df, words, "t", keep_empty=True).select("i", "w")
    assert rows(kept) == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_group_function_over_an_ordered_table(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 5), (None, 2), ("a", 2)], "k string, v int")

    def step(state, row):
        return (row["k"], state[1] + [row["v"]]), ()

    TF.register(spark, "in_order", TF.as_group_function(
        lambda: (None, []), step, lambda s: [(s[0], ",".join(map(str, s[1])))] if s[1] else [], "k string, vs string"))
    got = spark.sql("SELECT * FROM in_order(TABLE({d}) PARTITION BY k ORDER BY v)", d=df)
    assert rows(got) == [("a", "1,2,3"), ("b", "5"), (None, "2")]


def test_group_function_makes_no_batch_per_row(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, v long")
    TF.register(spark, "row_sums", TF.as_group_function(
        lambda: 0, lambda s, r: (s + r["v"], [(r["k"], s + r["v"])]), lambda s: [], "k string, total long"))
    got = spark.sql("SELECT * FROM row_sums(TABLE({d}) PARTITION BY k ORDER BY v)", d=df)
    assert rows(got) == [("a", 1), ("a", 4), (None, 2)]
    # The Arrow form of an evaluated table function makes a batch of every row's output.
    assert "ArrowEvalPythonUDTF" not in got._jdf.queryExecution().toString()
