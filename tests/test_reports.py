import os

from keyreport.plans import reports as R
from tests.conftest import rows

# Own flights rows: date, airline, flight, origin, dest, dep, dep_delay, arr, arr_delay, air, dist, id
FLIGHTS = """2021-03-01,100,1,AAA,BBB,800,5,1000,10,120,900,1
2021-03-01,100,2,BBB,AAA,900,-3,1100,-5,120,900,2
2021-03-01,100,3,AAA,CCC,1000,0,1300,0,150,1200,3
2021-03-01,100,4,CCC,BBB,1100,20,1500,25,200,1500,4
2021-03-01,100,5,AAA,BBB,1200,2,1400,7,120,900,5
2021-03-01,100,6,BBB,CCC,1300,40,1700,33,180,1200,6
"""


def write(dirname, name, text):
    path = os.path.join(dirname, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_flight_delay_report_with_and_without_header(spark, tmp_dir):
    p = write(tmp_dir, "flights.csv", FLIGHTS)
    no_skip = R.flight_delay_report(R.read_flights(spark, p, header=False))
    assert rows(no_skip) == [("BBB", 42, 3), ("CCC", 33, 1)]
    skip = R.flight_delay_report(R.read_flights(spark, p, header=True))
    assert rows(skip) == [("BBB", 32, 2), ("CCC", 33, 1)]  # first line is dropped


def test_header_skipped_per_file(spark, tmp_dir):
    write(tmp_dir, "a.csv", FLIGHTS)
    write(tmp_dir, "b.csv", FLIGHTS)
    df = R.read_flights(spark, tmp_dir, header=True)
    assert df.count() == 10


def test_bad_integer_fails_in_strict_mode(spark, tmp_dir):
    p = write(tmp_dir, "bad.csv", FLIGHTS + "2021-03-01,100,7,AAA,BBB,800,5,1000,late,120,900,7\n")
    import pytest
    with pytest.raises(Exception):
        R.flight_delay_report(R.read_flights(spark, p)).collect()
    tolerant = R.flight_delay_report(R.read_flights(spark, p, strict=False))
    assert rows(tolerant) == [("BBB", 42, 3), ("CCC", 33, 1)]


def test_delay_table_matches_declared_schema(spark, tmp_dir):
    p = write(tmp_dir, "flights.csv", FLIGHTS)
    t = R.flight_delay_table(R.read_flights(spark, p))
    assert t.columns == ["airport", "lista_Qtd_Atrasos", "lista_Tempo_Atrasos"]
    assert [f.dataType.simpleString() for f in t.schema.fields] == ["string", "bigint", "bigint"]
    assert rows(t) == [("BBB", 3, 42), ("CCC", 1, 33)]


CASES = """id|data_iniSE|casos|ibge_code|cidade|uf|cep|latitude|longitude
1|2015-02-01|300.0|1|c1|CE|0|0|0
2|2015-02-08|37.0|1|c1|CE|0|0|0
3|2014-02-03|8.0|2|c2|SP|0|0|0
4|2014-02-10||2|c2|SP|0|0|0
5|2016-01-03||3|c3|TO|0|0|0
6|2016-03-06|0.0|4|c4|AC|0|0|0
"""
RAIN = """data,mm,uf
2015-02-01,50.0,CE
2015-02-02,5.0,CE
2015-02-03,-9999.0,CE
2014-02-01,4.2222222,SP
2016-01-24,4.2,TO
2016-03-01,-1.0,AC
2017-01-01,3.3,RJ
"""


def test_monthly_report(spark, tmp_dir):
    cases = R.read_cases(spark, write(tmp_dir, "cases.txt", CASES))
    rain = R.read_rain(spark, write(tmp_dir, "rain.csv", RAIN))
    lines = sorted(r["line"] for r in R.monthly_report(cases, rain).collect())
    assert lines == ["AC;2016;03;0.0;0.0", "CE;2015;02;55.0;337.0", "SP;2014;02;4.2;8.0"]


def test_cases_skip_rows_without_digit(spark, tmp_dir):
    cases = R.read_cases(spark, write(tmp_dir, "cases.txt", CASES))
    assert rows(R.cases_per_month(cases)) == [
        ("AC", "2016-03", 0.0), ("CE", "2015-02", 337.0), ("SP", "2014-02", 8.0)]


def test_tolerant_read_keeps_rejects(spark, tmp_dir):
    from keyreport.sources.files import read_delimited_with_rejects
    bad_lines = ["2021-03-01,100,7,AAA,BBB,800,5,1000,late,120,900,7", "2021-03-01,100,8,AAA"]
    p = write(tmp_dir, "mixed.csv", FLIGHTS + "\n".join(bad_lines) + "\n")
    good, rejects = read_delimited_with_rejects(spark, p, R.FLIGHT_SCHEMA)
    assert rows(R.flight_delay_report(good)) == [("BBB", 42, 3), ("CCC", 33, 1)]
    assert sorted(r["_rejected_line"] for r in rejects.collect()) == sorted(bad_lines)


def test_flights_edge_rows(spark, tmp_dir):
    import pytest
    extra = "2021-03-01,100,9,AAA,BBB,800,5,1000,4,120,900,9,extra\n"   # extra field: ignored
    no_dest = "2021-03-01,100,10,AAA,,800,5,1000,6,120,900,10\n"       # empty key: its own group ''
    p = write(tmp_dir, "edge.csv", FLIGHTS + extra + no_dest)
    assert rows(R.flight_delay_report(R.read_flights(spark, p))) == [("", 6, 1), ("BBB", 46, 4), ("CCC", 33, 1)]
    blank = write(tmp_dir, "blank.csv", FLIGHTS + "2021-03-01,100,11,AAA,BBB,800,5,1000,,120,900,11\n")
    with pytest.raises(Exception):
        R.flight_delay_report(R.read_flights(spark, blank)).collect()   # int('') fails
    assert rows(R.flight_delay_report(R.read_flights(spark, blank, strict=False))) == [("BBB", 42, 3), ("CCC", 33, 1)]
    short = write(tmp_dir, "short.csv", FLIGHTS + "2021-03-01,100,12,AAA\n")
    with pytest.raises(Exception):
        R.read_flights(spark, short).collect()


def test_read_fields_keeps_empty_text(spark, tmp_dir):
    from keyreport.sources.files import read_fields
    p = write(tmp_dir, "t.txt", "h1|h2|h3\na||c\n|b|\n")
    got = rows(read_fields(spark, p, "x string, y string, z string", sep="|", header=True))
    assert got == [("", "b", ""), ("a", "", "c")]


def test_monthly_report_with_python_rounding(spark, tmp_dir):
    cases = R.read_cases(spark, write(tmp_dir, "cases.txt", CASES))
    rain = R.read_rain(spark, write(tmp_dir, "rain.csv", RAIN + "2015-02-04,0.05,CE\n"))
    half_up = sorted(r["line"] for r in R.monthly_report(cases, rain).collect())
    python = sorted(r["line"] for r in R.monthly_report(cases, rain, python_rounding=True).collect())
    assert "CE;2015;02;55.1;337.0" in half_up          # 55.05 → 55.1 (exact decimal, half up)
    assert "CE;2015;02;55.0;337.0" in python           # float 55.05 is 55.0499… → 55.0, as Python rounds
