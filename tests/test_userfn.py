import pandas as pd
from pyspark.sql import types as T

from keyreport.operators import userfn as U
from tests.conftest import rows


def data(spark):
    return spark.createDataFrame([("a", 1.0), ("a", 5.0), ("b", 2.0), (None, 4.0), ("b", -1.0)] * 3,
                                 "k string, v double").repartition(3)


def test_map_values(spark):
    double = U.map_values(lambda s: s * 2, T.DoubleType())
    df = data(spark).select(double("v").alias("w"))
    assert sorted(r[0] for r in df.collect()) == sorted([2.0, 10.0, 4.0, 8.0, -2.0] * 3)


def test_flat_map_and_filter(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "")], "id long, text string")
    out = U.flat_map(df, lambda p: p.assign(w=p.text.str.split(" ")).explode("w")[["id", "w"]],
                     "id long, w string")
    assert rows(out) == [(1, "x"), (1, "y"), (2, "")]
    kept = U.filter_rows(data(spark), lambda v: v > 1.5, "v")
    assert kept.count() == 9


class Positive(U.DoFn):
    def process(self, batch: pd.DataFrame):
        yield batch[batch.v > 0]


def test_par_do(spark):
    out = U.par_do(data(spark), Positive(), "k string, v double")
    assert out.count() == 12


def test_combine_per_key_two_levels(spark):
    out = U.combine_per_key(data(spark), "k", "v", lambda s: float(s.sum()), T.DoubleType(), "total")
    assert rows(out) == [("a", 18.0), ("b", 3.0), (None, 12.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan  # map-side combine before the shuffle


def test_combine_per_key_keeps_large_integers_beside_nulls(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(1, big), (1, None), (None, big), (None, 3), (2, None), (2**53 + 3, 1)], "k long, v long")
    out = U.combine_per_key(df, "k", "v", lambda s: int(s.max()), T.LongType(), "m")
    assert out.columns == ["k", "m"]
    assert rows(out) == rows(spark.createDataFrame([(1, big), (None, big), (2, None), (2**53 + 3, 1)], "k long, m long"))


def test_arguments_and_records(spark):
    df = spark.createDataFrame([("a b", 1), ("c", 2), (None, 3)], "t string, v int")
    plus = U.map_values(lambda s, by: s + by, T.IntegerType(), by=10)
    assert rows(df.select(plus("v"))) == [(11,), (12,), (13,)]
    assert U.filter_rows(df, lambda v, least: v >= least, "v", least=2).count() == 2

    def tokens(record, sep):
        for t in (record["t"] or "").split(sep):
            yield {"t": t, "v": record["v"]}

    assert rows(U.flat_map(df, U.per_record(tokens), "t string, v int", sep=" ")) == [("", 3), ("a", 1), ("b", 1), ("c", 2)]

    class Even(U.RecordDoFn):
        def process(self, record):
            if record["v"] % 2 == 0:
                yield {"v": record["v"]}

    assert rows(U.par_do(df, Even(), "v int")) == [(2,)]
