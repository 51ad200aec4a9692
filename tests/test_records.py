"""Lines below headers, and records whose names are data."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from keyreport.functions import shaping as S
from keyreport.operators import cogroup as C
from keyreport.sources import files as R
from tests.conftest import rows

FILES = {
    "a.txt": "h1\n\nx\u0001y\n h1 \nh1\n", "b.txt": "h2", "c.txt": "", "d.txt": "\n\n\nlast", "e.txt": '"q,\n"open\n\\\n',
    "f.txt": "head\r\none\r\n",
}


def write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}", "w", newline="") as f:
            f.write(text)
    return folder


def below(text):
    return text.replace("\r\n", "\n").removesuffix("\n").split("\n")[1:] if text else []


def test_only_the_first_line_of_each_file_goes(spark, tmp_dir):
    path = write(f"{tmp_dir}/in", FILES)
    got = sorted(r[0] for r in R.read_text_lines(spark, path, header=True).collect())
    assert got == sorted(x for t in FILES.values() for x in below(t))


@pytest.mark.parametrize("size", ["64", "1000", "134217728"])
def test_files_are_split_and_packed(spark, tmp_dir, size):
    files = {f"{i}.txt": "".join(f"line {i} {j}\n" if j % 5 else "\n" for j in range(60 + i)) for i in range(9)}
    path = write(f"{tmp_dir}/in", files)
    with gzip.open(f"{path}/z.txt.gz", "wt") as f:
        f.write("packed head\npacked line\n")
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines = R.read_text_lines(spark, path, header=True)
        got = sorted(r[0] for r in lines.collect())
        if size == "64":
            assert lines.rdd.getNumPartitions() > len(files)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted([x for t in files.values() for x in below(t)] + ["packed line"])


def test_small_arrow_batches_keep_the_place(spark, tmp_dir):
    path = write(f"{tmp_dir}/in", {f"{i}.txt": "head\n" + "line\n" * 23 for i in range(5)})
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert rows(R.read_text_lines(spark, path, header=True)) == [("line",)] * 115
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_records_take_the_names_of_their_own_file(spark, tmp_dir):
    path = write(f"{tmp_dir}/in", {"a.csv": "id,name\n1,x\n2\n\n3,y,more\n", "b.csv": "name,id,name\nu,4,v\n", "c.csv": "only\n"})
    got = sorted(tuple(sorted(r["record"].items())) for r in R.read_records(spark, path).collect())
    assert got == sorted([(("id", "1"), ("name", "x")), (("id", "2"),), (("id", ""),), (("id", "3"), ("name", "y")),
                          (("id", "4"), ("name", "v"))])


def test_zip_to_map_is_dict_of_zip(spark):
    cases = [(["a", "b"], [1, 2]), (["a"], [1, 2]), (["a", "b"], [1]), ([], []), (["a", "b", "a"], [1, 2, 3]),
             (["a", "b", "a"], [1, 2]), ([None, "b"], [1, 2]), (None, [1])]
    df = spark.createDataFrame([(i, n, v) for i, (n, v) in enumerate(cases)], "i int, n array<string>, v array<int>")
    got = {r["i"]: r["m"] for r in df.select("i", S.zip_to_map("n", "v").alias("m")).collect()}
    for i, (n, v) in enumerate(cases):
        assert got[i] == (None if n is None else {k: x for k, x in dict(zip(n, v)).items() if k is not None})


def test_map_columns_are_found_in_the_data(spark):
    df = spark.createDataFrame([(1, {"b": "x", "a": "y"}), (2, {"c d": "z"}), (3, {}), (4, None)], "i int, m map<string,string>")
    assert rows(S.map_names(df, "m")) == [("a", 1), ("b", 1), ("c d", 1)]
    wide = S.map_columns(df, "m")
    assert wide.columns == ["i", "a", "b", "c d"]
    assert rows(wide) == [(1, "y", "x", None), (2, None, None, "z"), (3, None, None, None), (4, None, None, None)]
    assert S.map_columns(df, "m", ["b"]).columns == ["i", "b"]
    with pytest.raises(ValueError):
        S.map_columns(df, "m", max_names=2)


def scans(frame):
    """How many scans ran, without those of reused exchanges."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan =="):plan.index("== Initial Plan ==")] if "== Final Plan ==" in plan else plan
    return final.count("FileScan")


def test_bad_lines_are_parsed_once(spark, tmp_dir):
    path = write(f"{tmp_dir}/in", {"a.txt": "1|2024-01-01\nx|2024-01-01\n2\n\n3|\n"})
    marked = R.read_delimited_marked(spark, path, "k bigint, d date", sep="|")
    got = {r["k"]: r[R.REJECT_COL] for r in marked.collect()}
    assert got == {1: None, None: "x|2024-01-01", 2: "2", 3: None}
    assert scans(marked) == 1


def test_presence_is_derived_from_one_scan_per_side(spark):
    base = "/root/testdata/sf0.001"
    c = spark.read.parquet(f"{base}/customer.parquet").select(F.col("c_nationkey").alias("k"), "c_name")
    s = spark.read.parquet(f"{base}/supplier.parquet").select((F.col("s_nationkey") * 2).alias("k"), "s_name")
    both = C.cogroup({"c": c, "s": s}, "k", require_all=True)
    assert scans(both) == 2
    keys = {r[0] for r in c.select("k").collect()} & {r[0] for r in s.select("k").collect()}
    assert {r["k"] for r in both.collect()} == keys
