import pytest
from pyspark.sql import functions as F

from keyreport.functions import shaping as S
from tests.conftest import rows


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0]["r"]


def test_split_keeps_trailing_empties(spark):
    assert one(spark, S.split_fields("s", ","), "a,,b,,") == "a,,b,,".split(",")
    assert one(spark, S.split_fields("s", "|"), "x|y||") == ["x", "y", "", ""]
    assert one(spark, S.split_fields("s", "."), "1.2.3") == ["1", "2", "3"]


@pytest.mark.parametrize("text", [
    "  Há quatro  quadros\ttrês ", "a b c", "x\x1cy", "", "   ", "line1\nline2\r\n",
    "sem-espaço", "word. word,", "　lead",
])
def test_tokens_equal_python_split(spark, text):
    assert one(spark, S.tokens("s"), text) == text.split()


def test_explode_tokens_counts_whole_text(spark):
    df = spark.createDataFrame([(1, "a b  a"), (2, " b ")], "id int, text string")
    assert rows(S.explode_tokens(df, "text", keep=["id"])) == [(1, "a"), (1, "a"), (1, "b"), (2, "b")]


def test_named_record_tolerant_and_strict(spark):
    df = spark.createDataFrame([(["1", "2"],), (["1", "2", "3", "4"],)], "a array<string>")
    got = rows(df.select(*S.named_record("a", ["x", "y", "z"])))
    assert got == [("1", "2", "3"), ("1", "2", None)]
    with pytest.raises(Exception):
        df.select(*S.named_record("a", ["x", "y", "z"], strict=True)).collect()


def test_year_month(spark):
    df = spark.createDataFrame([("2015-02-01", 1), ("2016", 2)], "d string, i int")
    assert rows(S.with_year_month(df, "d", "ano_mes").select("ano_mes", "i")) == [("2015-02", 1), ("2016", 2)]
    ts = spark.sql("select timestamp_ntz'2024-03-05 10:00:00' as t, date'2024-12-31' as d")
    assert ts.select(S.year_month(F.to_date("t")), S.year_month("d")).collect()[0] == ("2024-03", "2024-12")


def test_composite_and_unpack_key(spark):
    df = spark.createDataFrame([("SP", "2014-02")], "uf string, ym string")
    k = df.select(S.composite_key("uf", "ym").alias("k"))
    assert k.collect()[0]["k"] == "SP-2014-02"
    assert k.select(*S.unpack_key("k", ["uf", "ano", "mes"])).collect()[0] == ("SP", "2014", "02")


def test_clamp_min_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(-1.0,), (2.5,), (None,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(S.clamp_min("x", 0)).collect()]
    assert got[:3] == [0.0, 2.5, None] and got[3] != got[3]


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (12.45,), (4.2222222,), (-0.25,)], "x double")
    got = [float(r[0]) for r in df.select(S.round_half_up("x", 1)).collect()]
    assert got == [0.3, 0.4, 12.5, 4.2, -0.3]


def test_join_fields_prints_null_as_empty(spark):
    df = spark.createDataFrame([("CE", None, 55.0)], "a string, b string, c double")
    assert df.select(S.join_fields(["a", "b", "c"], ";")).collect()[0][0] == "CE;;55.0"


def test_flatten_struct_and_first_of_lists(spark):
    df = spark.sql("select 'JFK' as airport, named_struct('Qtd', array(4L), 'Tempo', array(220L),"
                   " 'inner', named_struct('x', 1)) as lista")
    flat = S.flatten_struct(df)
    assert flat.columns == ["airport", "lista_Qtd", "lista_Tempo", "lista_inner_x"]
    first = S.first_of_lists(flat, ["lista_Qtd", "lista_Tempo"], ["airport"])
    assert first.collect()[0] == ("JFK", 4, 220)
    empty = spark.sql("select cast(array() as array<int>) as l")
    assert S.first_of_lists(empty, ["l"]).collect()[0][0] is None


def test_decode_fields_and_encode_row(spark):
    df = spark.createDataFrame([(bytearray("a,b,ç\n".encode()),)], "v binary")
    assert df.select(S.decode_fields("v")).collect()[0][0] == ["a", "b", "ç"]
    bad = spark.createDataFrame([(bytearray(b"\xff\xfe,1"),)], "v binary")
    with pytest.raises(Exception):
        bad.select(S.decode_fields("v")).collect()
    row = spark.createDataFrame([("JFK", 4)], "k string, n int").select(S.encode_row("k", "n"))
    assert bytes(row.collect()[0][0]).decode() == '{"k":"JFK","n":4}'


def test_parse_int_strict_and_tolerant(spark):
    df = spark.createDataFrame([(" 7\n",), ("x",)], "s string")
    assert [r[0] for r in df.select(S.parse_int("s", strict=False)).collect()] == [7, None]
    with pytest.raises(Exception):
        df.select(S.parse_int("s")).collect()


def test_split_pattern_equals_python_whitespace_on_every_code_point(spark):
    import duckdb
    cps = [c for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, "a" + chr(c) + "b") for c in cps], "cp int, s string")
    spark_ws = {r["cp"] for r in df.where(F.size(S.tokens("s")) == 2).collect()}
    python_ws = {c for c in cps if chr(c).isspace()}
    assert spark_ws == python_ws
    con = duckdb.connect()
    con.execute("CREATE TABLE t(cp INTEGER, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(c, "a" + chr(c) + "b") for c in cps if c != 0])
    duck_ws = {r[0] for r in con.execute(
        f"SELECT cp FROM t WHERE len(regexp_split_to_array(s, '{S.WHITESPACE_CLASS}+')) = 2").fetchall()}
    assert duck_ws == python_ws - {0}


def test_key_by_keeps_record(spark):
    df = spark.createDataFrame([("SP", "2014-02-03", "8.0")], "uf string, d string, casos string")
    r = S.key_by(df, "uf").collect()[0]
    assert r["uf"] == "SP" and r["record"].asDict() == {"uf": "SP", "d": "2014-02-03", "casos": "8.0"}


def test_python_round_has_float_parity(spark):
    values = [0.25, 0.35, 0.15, 12.45, 4.2222222, -0.35, 2.675, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(S.python_round("x", 1)).collect()]
    want = [round(v, 1) for v in values]
    assert got[:-1] == want[:-1] and got[-1] != got[-1]
    assert got[:4] == [0.2, 0.3, 0.1, 12.4]
