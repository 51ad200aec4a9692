"""Property tests: many random cases per test, all checked in one Spark job
against plain Python."""

import collections
import decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from keyreport.functions import shaping as S
from keyreport.operators.cogroup import cogroup
from keyreport.operators.keyed import group_by_key

TEXT = st.text(alphabet=st.sampled_from(list("ab ,|;.-\t\n  \x1cçé9")), max_size=30)
SETTINGS = settings(max_examples=5, deadline=None)


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=60), st.sampled_from([",", "|", ";", ".", "-", "ab"]))
def test_split_fields_and_tokens_equal_python(spark, texts, sep):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = df.select("i", S.split_fields("s", sep).alias("f"), S.tokens("s").alias("t")).collect()
    for r in got:
        assert r["f"] == texts[r["i"]].split(sep)
        assert r["t"] == texts[r["i"]].split()


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None, "hot"]), st.integers(0, 30)), min_size=1, max_size=300))
def test_group_by_key_is_the_exact_multiset(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    got = collections.defaultdict(collections.Counter)
    for r in group_by_key(df, "k", "v").collect():
        got[r["k"]][r["v"]] += r["n"]
    want = collections.defaultdict(collections.Counter)
    for k, v in rows:
        want[k][v] += 1
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 5)), max_size=80),
       st.lists(st.tuples(st.sampled_from(["y", "z", None]), st.integers(0, 5)), max_size=80),
       st.booleans())
def test_cogroup_equals_brute_force(spark, left, right, require_all):
    a = spark.createDataFrame(left, "k string, v int")
    b = spark.createDataFrame(right, "k string, v int")
    got = collections.defaultdict(lambda: (collections.Counter(), collections.Counter()))
    for r in cogroup({"a": a, "b": b}, "k", require_all=require_all).collect():
        got[r["k"]]["ab".index(r["__tag"])][r[r["__tag"]]["v"]] += r["n"]
    want = collections.defaultdict(lambda: (collections.Counter(), collections.Counter()))
    for k, v in left:
        want[k][0][v] += 1
    for k, v in right:
        want[k][1][v] += 1
    if require_all:
        want = {k: v for k, v in want.items() if v[0] and v[1]}
    assert dict(got) == dict(want)


@SETTINGS
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=12, allow_nan=False), min_size=1, max_size=50))
def test_round_half_up_equals_decimal_quantize(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x decimal(24,12)")
    for r in df.select("i", S.round_half_up("x", 1).alias("r")).collect():
        want = values[r["i"]].quantize(decimal.Decimal("0.1"), rounding=decimal.ROUND_HALF_UP)
        assert r["r"] == want
