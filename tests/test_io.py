import os

from pyspark.sql import functions as F

from keyreport import sinks, sources
from keyreport.session import bounded_broadcast, checkpoint_root, scratch_dir
from tests.conftest import rows


def test_checkpoint_root_is_session_setting(spark):
    root = checkpoint_root(spark)
    assert root and scratch_dir(spark, "x").startswith(root)


def test_lines_round_trip_keeps_blank_lines(spark, tmp_dir):
    df = spark.createDataFrame([("a b",), ("",), ("ção",)], "value string")
    sinks.write_lines(df, f"{tmp_dir}/out")
    assert rows(sources.read_lines(spark, f"{tmp_dir}/out")) == [("",), ("a b",), ("ção",)]


def test_delimited_report_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("CE", "2015", "02", 55.0, 337.0), ("SP", "2014", "02", None, 8.0)],
                               "uf string, ano string, mes string, chuva double, dengue double")
    sinks.write_delimited(df, f"{tmp_dir}/rep", sep=";")
    text = sorted(r[0] for r in sources.read_lines(spark, f"{tmp_dir}/rep").collect())
    assert text == ["CE;2015;02;55.0;337.0", "SP;2014;02;;8.0"]
    back = sources.read_report(spark, f"{tmp_dir}/rep", df.schema)
    assert rows(back) == rows(df)


def test_append_table_twice(spark, tmp_dir):
    df = spark.createDataFrame([("JFK", 4, 220)], "a string, q int, t int")
    schema = "airport:STRING, lista_Qtd_Atrasos:INTEGER, lista_Tempo_Atrasos:INTEGER"
    df = df.select(F.col("a").alias("airport"), F.col("q").alias("lista_Qtd_Atrasos"),
                   F.col("t").alias("lista_Tempo_Atrasos"))
    sinks.append_table(df, "t_append_test", schema, path=f"{tmp_dir}/tbl")
    sinks.append_table(df, "t_append_test", schema, path=f"{tmp_dir}/tbl")
    assert spark.table("t_append_test").count() == 2
    assert dict(spark.table("t_append_test").dtypes)["lista_Qtd_Atrasos"] == "bigint"


def test_bounded_broadcast(spark):
    small = spark.range(10)
    big = spark.range(1000)
    hinted = bounded_broadcast(small, 1000)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    plan = big.join(hinted, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert bounded_broadcast(big, 1000) is big  # over the bound: no hint, the planner decides


def test_bounded_broadcast_measures_bytes_not_rows(spark):
    wide = spark.range(3).selectExpr("id", "repeat('x', 100000) AS t", "array(id) AS a")
    assert bounded_broadcast(wide, 10_000) is wide
    assert bounded_broadcast(wide.select("id"), 10_000) is not wide


def test_checkpoint_root_refuses_a_local_folder_on_a_cluster():
    import pytest

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


def test_file_stream_and_consumer(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    spark.createDataFrame([(bytearray(b"x"),)], "value binary").write.parquet(f"{src}/f1")
    seen = []
    stream = sources.read_file_stream(spark, src, spark.read.parquet(f"{src}/f1").schema,
                                      recursiveFileLookup="true")
    q = sources.consume(stream, lambda b, i: seen.append(b.count()), f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination()
    assert sum(seen) == 1
    assert os.path.isdir(f"{tmp_dir}/ckpt")


def test_create_and_show(spark, capsys):
    df = sources.create(spark, [("Ana", 32), ("Bia", 21)], "name string, age int")
    sinks.show(df)
    assert "Ana" in capsys.readouterr().out and df.count() == 2


def test_publish_then_stream_to_message_sink(spark, tmp_dir):
    table = spark.createDataFrame([("a,1",), ("b,2",)], "line string").select(F.encode("line", "UTF-8").alias("value"))
    sinks.publish_table(table, fmt="parquet", path=f"{tmp_dir}/topic")
    stream = sources.read_file_stream(spark, f"{tmp_dir}/topic", table.schema)
    q = sinks.write_messages(stream, f"{tmp_dir}/ckpt", fmt="parquet", available_now=True, path=f"{tmp_dir}/out")
    q.awaitTermination()
    got = sorted(bytes(r[0]).decode() for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == ["a,1", "b,2"]


def test_preview_batches(spark, tmp_dir, capsys):
    spark.createDataFrame([(1,), (2,)], "x int").write.parquet(f"{tmp_dir}/src")
    stream = sources.read_file_stream(spark, f"{tmp_dir}/src", spark.read.parquet(f"{tmp_dir}/src").schema)
    sinks.preview_batches(stream, f"{tmp_dir}/ckpt", n=1, available_now=True).awaitTermination()
    assert "batch 0" in capsys.readouterr().out


def test_rejects_do_not_depend_on_the_columns_selected(spark, tmp_dir):
    import pytest

    from keyreport.sources.files import read_delimited, read_delimited_with_rejects

    spark.createDataFrame([("1,2",), ("x,2",), ("3",), ("4,5,6",)], "value string").coalesce(1).write.text(tmp_dir + "/b")
    good, rejects = read_delimited_with_rejects(spark, tmp_dir + "/b", "a int, b int")
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert [tuple(r) for r in good.select("a").collect()] == [(1,)] and good.count() == 1
    assert sorted(r[0] for r in rejects.select("_rejected_line").collect()) == ["3", "4,5,6", "x,2"] and rejects.count() == 3
    for use in (lambda d: d.count(), lambda d: d.select("a").collect(), lambda d: d.collect()):
        with pytest.raises(Exception, match="malformed line"):
            use(read_delimited(spark, tmp_dir + "/b", "a int, b int"))
    loose = read_delimited(spark, tmp_dir + "/b", "a int, b int", strict=False)
    assert sorted(map(str, loose.collect())) == sorted(["Row(a=1, b=2)", "Row(a=None, b=2)", "Row(a=3, b=None)", "Row(a=4, b=5)"])


def test_null_fields_stay_in_a_message(spark):
    from keyreport.functions.shaping import encode_row

    df = spark.createDataFrame([(1, None)], "a int, b string").select(encode_row("a", "b").alias("v"))
    assert bytes(df.first()["v"]) == b'{"a":1,"b":null}'
