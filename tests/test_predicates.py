from pyspark.sql import functions as F

from keyreport.functions import predicates as P
from tests.conftest import rows


def test_equals_and_positive(spark):
    df = spark.createDataFrame([("LAX", 3), ("JFK", 0), ("LAX", -1)], "o string, d int")
    assert rows(df.where(P.equals("o", "LAX"))) == [("LAX", -1), ("LAX", 3)]
    assert rows(df.where(P.positive("d"))) == [("LAX", 3)]


def test_in_set_is_exact(spark):
    df = spark.createDataFrame([(w,) for w in ["blue", "Blue", "blue.", "grün", "grun"]], "w string")
    assert rows(df.where(P.in_set("w", ["blue", "grün"]))) == [("blue",), ("grün",)]


def test_in_set_join_large_list(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "x int")
    members = spark.range(0, 1000, 7).select(F.col("id").cast("int").alias("m"))
    got = sorted(r[0] for r in P.in_set_join(df, "x", members).collect())
    assert got == sorted(x for x in range(100) if x % 7 == 0)


def members(spark, n=3_000_000):
    return spark.range(0, n, numPartitions=8).select((F.col("id") * 7 - n).alias("m"))


def test_bloom_filter_has_a_fixed_size_and_loses_nothing(spark):
    bloom = P.bloom_filter(members(spark), "m", 1 << 16).cache()
    assert bloom.count() <= 1 << 16 and len(bloom.columns) == 9
    df = spark.range(-3_500_000, 3_500_000, 1, 8).select(F.col("id").alias("x"))
    inside = (F.pmod(F.col("x") + 3_000_000, F.lit(7)) == 0) & (F.col("x") >= -3_000_000)
    passed = P.maybe_in(df, "x", bloom, 1 << 16).select(F.count("*"), F.count(F.when(inside, 1))).first()
    true = df.where(inside).count()
    assert passed[1] == true and passed[0] - true < 0.02 * 7_000_000


def test_large_set_shuffles_what_the_filter_leaves(spark):
    df = spark.range(0, 2_000_000, 1, 8).select((F.col("id") + 10**12).alias("x"), F.lit("y").alias("y"))
    few = spark.createDataFrame([(10**12 + 5,), (10**12 + 5,), (7,), (None,)], "m long")
    out = P.in_large_set(df, "x", few)
    assert [tuple(r) for r in out.collect()] == [(10**12 + 5, "y")]
    plan = out._jdf.queryExecution().executedPlan()
    final = plan.executedPlan().toString() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan.toString()
    # The input meets the broadcast filter below its exchange.
    assert final.index("__bloom_block") > 0 and "BroadcastHashJoin" in final
    left = P.maybe_in(df, "x", P.bloom_filter(few, "m")).count()
    assert left < 2_000_000 / 1000


def test_large_set_of_texts_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("B",), (None,), ("",), ("a",)], "x string")
    assert rows(P.in_large_set(df, "x", spark.createDataFrame([("a",), ("",), (None,)], "m string"))) == [("",), ("a",), ("a",)]
    assert P.in_large_set(df, "x", spark.createDataFrame([], "m string")).count() == 0
    try:
        P.in_large_set(df, "x", members(spark, 3))
        raise AssertionError("types must be the same")
    except TypeError:
        pass


def test_has_digit_any_script(spark):
    df = spark.createDataFrame([("12",), ("",), ("abc",), ("٣",), ("x9",), (None,)], "s string")
    assert rows(df.where(P.has_digit("s"))) == [("12",), ("x9",), ("٣",)]


def test_all_present(spark):
    df = spark.createDataFrame([([0.0], [1.0]), ([], [1.0]), (None, [2.0])], "a array<double>, b array<double>")
    assert rows(df.where(P.all_present("a", "b"))) == [([0.0], [1.0])]
