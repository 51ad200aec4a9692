import collections
import random

from keyreport.operators import cogroup as C
from tests.conftest import rows


def sides(spark):
    chuvas = spark.createDataFrame([("CE-2015-02", 55.0), ("SP-2014-02", 4.2), ("RJ-2017-01", 3.3),
                                    (None, 1.0)], "k string, mm double")
    dengue = spark.createDataFrame([("CE-2015-02", 337.0), ("SP-2014-02", 8.0), ("AC-2016-03", 0.0),
                                    (None, 2.0)], "k string, casos double")
    return {"Chuvas": chuvas, "Dengue": dengue}


def sides_of(frame, **field):
    got = {}
    for r in frame.collect():
        lists = got.setdefault(r["k"], tuple([] for _ in field))
        i = list(field).index(r[C.TAG])
        lists[i].append((r[r[C.TAG]][field[r[C.TAG]]], r["n"]))
    return got


def test_cogroup_full_keys_and_missing_sides(spark):
    assert sides_of(C.cogroup(sides(spark), "k"), Chuvas="mm", Dengue="casos") == {
        "CE-2015-02": ([(55.0, 1)], [(337.0, 1)]),
        "SP-2014-02": ([(4.2, 1)], [(8.0, 1)]),
        "RJ-2017-01": ([(3.3, 1)], []),
        "AC-2016-03": ([], [(0.0, 1)]),
        None: ([(1.0, 1)], [(2.0, 1)]),  # NULL keys meet
    }


def test_cogroup_require_all_keeps_zero_values(spark):
    got = {r["k"] or "" for r in C.cogroup(sides(spark), "k", require_all=True).collect()}
    assert got == {"", "CE-2015-02", "SP-2014-02"}


def test_cogroup_require_all_keeps_every_value(spark):
    rnd = random.Random(3)
    a = [("hot", rnd.randrange(1000)) for _ in range(2000)] + [("only_a", 1)]
    b = [("hot", 5)]
    got = sides_of(C.cogroup({"a": spark.createDataFrame(a, "k string, v int"),
                              "b": spark.createDataFrame(b, "k string, v int")}, "k", require_all=True), a="v", b="v")
    assert set(got) == {"hot"}
    assert dict(got["hot"][0]) == collections.Counter(v for k, v in a if k == "hot")
    assert got["hot"][1] == [(5, 1)]


def test_cogroup_values_and_match(spark):
    s = sides(spark)
    got = rows(C.cogroup_values(s, "k"))
    assert ("RJ-2017-01", 3.3, None) in got and ("AC-2016-03", None, 0.0) in got and len(got) == 5
    assert rows(C.cogroup_values(s, "k", require_all=True)) == [
        ("CE-2015-02", 55.0, 337.0), ("SP-2014-02", 4.2, 8.0), (None, 1.0, 2.0)]
    m = C.match(s["Chuvas"], s["Dengue"], "k")
    assert rows(m) == [("CE-2015-02", 55.0, 337.0), ("SP-2014-02", 4.2, 8.0), (None, 1.0, 2.0)]


def test_union_all_keeps_duplicates(spark):
    a = spark.createDataFrame([("Ana",), ("Bia",)], "name string")
    b = spark.createDataFrame([("Ana",)], "name string")
    c = spark.createDataFrame([("Caio",)], "name string")
    assert rows(C.union_all(a, b, c)) == [("Ana",), ("Ana",), ("Bia",), ("Caio",)]
