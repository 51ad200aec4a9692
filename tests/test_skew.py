"""One key holding a third of all rows: results stay whole and exact, and the
plans split or pre-aggregate the hot key."""

import collections
import contextlib
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyreport.operators.cogroup import cogroup, match
from keyreport.operators.keyed import group_by_key, sum_and_count_per_key
from keyreport.operators.userfn import combine_per_key

N = 30_000


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark):
    # every third row has key 0
    return spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                 F.col("id").alias("v"))


def test_aqe_splits_hot_key_in_match(spark):
    # a sort-merge join whatever the sizes: no static or runtime broadcast
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                        "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        right = spark.range(N).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
        df = match(skewed(spark), right, "k").groupBy().agg(F.sum("w").alias("w"), F.sum("v").alias("v"),
                                                             F.count("*").alias("n"))
        got = df.collect()[0]
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    assert got["n"] == N
    assert got["w"] == 10 * sum(i for i in range(N) if i % 3) and got["v"] == sum(range(N))


def test_keyed_operators_exact_under_skew(spark):
    df = skewed(spark)
    want_sum = collections.Counter()
    want_n = collections.Counter()
    for i in range(N):
        k = 0 if i % 3 == 0 else i
        want_sum[k] += i
        want_n[k] += 1
    got = {r["k"]: (r["total"], r["n"]) for r in sum_and_count_per_key(df, "k", "v").collect()}
    assert got == {k: (want_sum[k], want_n[k]) for k in want_n}
    comb = {r["k"]: r["c"] for r in combine_per_key(df, "k", "v", lambda s: int(s.sum()), T.LongType(), "c")
            .collect()}
    assert comb == dict(want_sum)


def test_group_and_cogroup_bound_the_hot_key(spark):
    rnd = random.Random(11)
    rows = [(0 if i % 3 == 0 else i % 97 + 1, rnd.randrange(5000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, v long")
    g = group_by_key(df, "k", "v").collect()
    assert sum(r["n"] for r in g) == len(rows)
    assert len([r for r in g if r["k"] == 0]) == len({v for k, v in rows if k == 0})
    c = cogroup({"a": df, "b": df.where("k <> 0")}, "k").collect()
    assert sum(r["n"] for r in c if r["__tag"] == "a") == len(rows)
    assert sum(r["n"] for r in c if r["__tag"] == "b") == len([r for r in rows if r[0] != 0])
